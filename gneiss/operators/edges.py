"""Edges: declarative rules over node tables, joined on the document they come from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.functions.text import strip
from gneiss.schemas import TABLES


@dataclass(frozen=True)
class EdgeRule:
    """An edge type: which table gives its rows, what its ends are, which lookups by source_id it needs."""

    rel_type: str
    table: str
    start: tuple[str, str, str]  # label, key, column
    end: tuple[str, str, str]
    needs: tuple[str, ...] = ()


# The edge vocabulary.
RULES: tuple[EdgeRule, ...] = (
    EdgeRule("FROM_SOURCE", "publication", ("Publication", "pub_id", "pub_id"), ("SourceFile", "source_id", "source_id")),
    EdgeRule("HAS_PUBLICATION", "publication", ("Application", "appln_id", "appln_id"), ("Publication", "pub_id", "pub_id"), ("application",)),
    EdgeRule("OF_APPLICATION", "publication", ("Publication", "pub_id", "pub_id"), ("Application", "appln_id", "appln_id"), ("application",)),
    EdgeRule("HAS_IPC", "ipc", ("Publication", "pub_id", "pub_id"), ("IPC", "long_code", "ipc_long_code"), ("publication",)),
    EdgeRule("HAS_CPC", "cpc", ("Publication", "pub_id", "pub_id"), ("CPC", "long_code", "cpc_long_code"), ("publication",)),
    EdgeRule("APPLIES_FOR", "applicant", ("Organisation", "org_key", "org_key"), ("Application", "appln_id", "appln_id"), ("application",)),
    EdgeRule("INVENTED", "inventor", ("Person", "person_key", "person_key"), ("Application", "appln_id", "appln_id"), ("application",)),
    EdgeRule("REPRESENTS", "attorney", ("Person", "person_key", "person_key"), ("Application", "appln_id", "appln_id"), ("application",)),
)

LOOKUPS = {"publication": "pub_id", "application": "appln_id"}


def first_by_source(rows: DataFrame, value: str, order: Sequence[str] = ()) -> DataFrame:
    """source_id to the value that came first for it."""
    ok = rows.where((F.col("source_id") != "") & (F.col(value) != ""))
    pick = F.min_by(value, F.struct(*order)) if order else F.min(value)
    return ok.groupBy("source_id").agg(pick.alias(value))


def first_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def valid_edges(edges: DataFrame, free: Sequence[str] = TABLES["edge"]) -> DataFrame:
    """Columns stripped (those of `free`, the others being constants); an edge needs all but its source_id."""
    clean = edges.select(*[(strip(F.col(c)) if c in free else F.col(c)).alias(c) for c in TABLES["edge"]])
    return clean.where(reduce(lambda a, b: a & b, [F.col(c) != "" for c in TABLES["edge"] if c != "source_id"]))


def edges(tables: dict[str, DataFrame], rules: Sequence[EdgeRule] = RULES) -> DataFrame:
    """All edges of the rules, each once per source document.

    Rows and lookups are dealt by source_id over all shuffle partitions: by itself the session may put as many of them into one
    task as its compressed bytes allow, and these rows compress far better than they sort.
    """

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_id")

    needed = {need for rule in rules for need in rule.needs}
    lookups = {t: first_by_source(dealt(tables[t]), c) for t, c in LOOKUPS.items() if t in tables and t in needed}
    parts = []
    for rule in rules:
        rows = tables[rule.table].where("source_id <> ''")
        rows = dealt(rows) if rule.needs else rows
        for need in rule.needs:
            rows = rows.join(lookups[need], "source_id")
        (a, b, c), (x, y, z) = rule.start, rule.end
        parts.append(rows.select(F.lit(a).alias("from_label"), F.lit(b).alias("from_key"), F.col(c).alias("from_id"), F.lit(rule.rel_type).alias("rel_type"), F.lit(x).alias("to_label"), F.lit(y).alias("to_key"), F.col(z).alias("to_id"), "source_id"))
    valid = valid_edges(reduce(DataFrame.unionByName, parts))
    return dealt(valid).dropDuplicates()


def edges_in_row(parsed: DataFrame, types: Sequence[str] | None = None, *, once: bool = False, keys: T.Keys = T.Keys()) -> DataFrame:
    """The same edges (of the given types) out of each parsed row alone, with no join: both ends come from one document.

    Rows with equal source_id must be one document; then this equals `edges` and its only shuffle is the dedupe. With
    `once`, no source_id comes twice: edges are deduplicated within the row and nothing is shuffled. Within a row, edges of
    one type differ in one end alone, so it is enough to tell those ids apart.
    """
    r = F.col("root")
    publication = F.when((r["country"] != "") & (r["doc_number"] != "") & (r["kind"] != ""), T.publication_id(r["country"], r["doc_number"], r["kind"]))
    # ids are stripped and told apart within the arrays: done behind the explode, it made a method too long for the JVM to compile
    fields = [f for f in fields_for([rule.rel_type for rule in RULES]) if f != "root"]
    rows = parsed.where("source_id <> ''").select(strip(publication).alias("pub"), strip(r["id"]).alias("app"), strip(F.col("source_id")).alias("source_id"), *fields)
    pub, app, source = F.col("pub"), F.col("app"), F.col("source_id")
    by = {rule.rel_type: rule for rule in RULES}

    def of(rel, a, b):
        (al, ak, _), (bl, bk, _) = by[rel].start, by[rel].end
        return F.struct(F.lit(al).alias("from_label"), F.lit(ak).alias("from_key"), a.alias("from_id"), F.lit(rel).alias("rel_type"), F.lit(bl).alias("to_label"), F.lit(bk).alias("to_key"), b.alias("to_id"))

    def one(rel, a, b):
        return F.when((a != "") & (b != ""), F.array(of(rel, a, b)))

    def many(rel, fixed, field, key, at_start, valid=None):
        made = F.transform(F.filter(field, valid) if valid else F.col(field), key)
        ids = F.array_distinct(F.filter(F.transform(made, strip), lambda x: x != ""))
        return F.when(fixed != "", F.transform(ids, lambda x: of(rel, x, fixed) if at_start else of(rel, fixed, x)))

    def party(rel, field, key):
        return many(rel, app, field, key, True, lambda p: p["name"] != "")

    makers = {
        "FROM_SOURCE": lambda: one("FROM_SOURCE", pub, source),
        "HAS_PUBLICATION": lambda: one("HAS_PUBLICATION", app, pub),
        "OF_APPLICATION": lambda: one("OF_APPLICATION", pub, app),
        "HAS_IPC": lambda: many("HAS_IPC", pub, "ipc", T.ipc_long, False),
        "HAS_CPC": lambda: many("HAS_CPC", pub, "cpc", T.cpc_long, False),
        "APPLIES_FOR": lambda: party("APPLIES_FOR", "applicants", lambda p: keys.organisation(p["iid"], p["name"], p["ctry"])),
        "INVENTED": lambda: party("INVENTED", "inventors", lambda p: keys.inventor(p["name"], p["city"], p["ctry"])),
        "REPRESENTS": lambda: party("REPRESENTS", "attorneys", lambda p: keys.attorney(p["iid"], p["name"], p["city"], p["ctry"])),
    }
    every = F.concat(*[F.coalesce(makers[t](), F.array()) for t in types or makers])
    # outer: before a plain explode the optimizer puts a filter that makes all edges of the row once or twice more
    out = rows.select(F.explode_outer(every).alias("e"), "source_id").where("e is not null").select("e.*", "source_id")
    return out if once else out.dropDuplicates()


def edges_of_documents(parsed: DataFrame, keys: T.Keys = T.Keys()) -> DataFrame:
    """edges_in_row with `sure`: both ends are vertices that node_tables (with the same keys) makes of the same row.

    Rows whose source_id is theirs alone, as nearly always, give each edge once, with no shuffle of edges. Where stripping
    changes a source_id, the edge's id of the source may be no vertex's; those rows' edges are not sure. `parsed` is read
    several times.
    """
    from gneiss.sources.tables import set_aside

    source = F.col("source_id")
    twice = set_aside(parsed.where("source_id <> ''").groupBy(strip(source).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "twice")
    plain = strip(source) == source
    if twice.isEmpty():
        alone, others = parsed.where(plain), parsed.where(~plain)
    else:
        alone = parsed.where(plain).join(twice, source == twice["id"], "left_anti")
        others = parsed.where(~plain).unionByName(parsed.where(plain).join(twice, source == twice["id"], "left_semi"))
    return edges_in_row(alone, once=True, keys=keys).withColumn("sure", F.lit(True)).unionByName(edges_in_row(others, keys=keys).withColumn("sure", F.lit(False)))


def fields_for(types: Sequence[str]) -> tuple[str, ...]:
    """The nested fields of a parsed row that edges of these types (and the ends they lead to) need."""
    of = {"publication": (), "ipc": ("ipc",), "cpc": ("cpc",), "applicant": ("applicants",), "inventor": ("inventors",), "attorney": ("attorneys",)}
    return ("root", *dict.fromkeys(f for rule in RULES if rule.rel_type in types for f in of[rule.table]))


def shape_counts(rows: DataFrame) -> DataFrame:
    """Edges per shape; shapes with a blank part are left out."""
    shape = ["from_label", "from_key", "rel_type", "to_label", "to_key"]
    return rows.where(reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit("")) != "" for c in shape])).groupBy(*shape).agg(F.count(F.lit(1)).alias("n"))
