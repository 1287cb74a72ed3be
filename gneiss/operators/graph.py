"""The property graph: keyed vertices, resolved edges, bulk and incremental merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.operators.edges import RULES, edges_in_row
from gneiss.schemas import TABLES, VERTICES

ENDS = ("from_label", "from_key", "from_id", "rel_type", "to_label", "to_key", "to_id")

# Which vertices the edge vocabulary means, by (label, edge type or None).
ALIASES: dict[tuple[str, str | None], tuple[str, str]] = {
    ("IPC", None): ("IpcClassification", "ipc_long_code"),
    ("CPC", None): ("CpcClassification", "cpc_long_code"),
    ("Organisation", None): ("Applicant", "org_key"),
    ("Person", "INVENTED"): ("Inventor", "person_key"),
    ("Person", "REPRESENTS"): ("Attorney", "person_key"),
}


def last_rows(rows: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Per key the whole row that comes last: a partial aggregate, so a key with very many versions is combined before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def vertices_of(rows: DataFrame, table: str, order: list[str]) -> DataFrame:
    """Vertices of one table: rows with a non-blank key, last one per key, blanks included."""
    _, key = VERTICES[table]
    return last_rows(rows.where(F.coalesce(F.col(key), F.lit("")) != ""), key, order).select(*TABLES[table])


def vertex_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """(label, key, id) of all vertices."""
    parts = [tables[t].select(F.lit(label).alias("label"), F.lit(key).alias("key"), F.col(key).alias("id")) for t, (label, key) in VERTICES.items() if t in tables]
    return reduce(DataFrame.unionByName, parts).where("id <> ''").distinct()


def vertex_ids_in_row(parsed: DataFrame, keys: T.Keys = T.Keys()) -> DataFrame:
    """The same (label, key, id) out of each parsed row: one pass and one shuffle for all kinds of vertices."""
    r = F.col("root")
    pub = F.when((r["country"] != "") & (r["doc_number"] != "") & (r["kind"] != ""), T.publication_id(r["country"], r["doc_number"], r["kind"]))

    def named(field: str, key) -> Column:
        return F.transform(F.filter(field, lambda p: p["name"] != ""), key)

    ids = {
        "publication": F.array(pub),
        "application": F.array(r["id"]),
        "ipc": F.transform("ipc", T.ipc_long),
        "cpc": F.transform("cpc", T.cpc_long),
        "applicant": named("applicants", lambda p: keys.organisation(p["iid"], p["name"], p["ctry"])),
        "inventor": named("inventors", lambda p: keys.inventor(p["name"], p["city"], p["ctry"])),
        "attorney": named("attorneys", lambda p: keys.attorney(p["iid"], p["name"], p["city"], p["ctry"])),
        "source_file": F.array(F.when(pub.isNotNull(), F.col("source_id"))),
    }

    def of(table: str) -> Column:
        label, key = VERTICES[table]
        return F.transform(F.coalesce(ids[table], F.array().cast("array<string>")), lambda x: F.struct(F.lit(label).alias("label"), F.lit(key).alias("key"), x.alias("id")))

    every = F.array_distinct(F.concat(*[of(t) for t in VERTICES]))
    return parsed.select(F.explode(every).alias("v")).select("v.*").where("id <> ''").distinct()


def _aliased(label: str, key: str) -> tuple[Column, Column]:
    """Label and key of the vertices that an end of an edge means, by label alone or by label and edge type."""

    def known(which: int, old: str) -> Column:
        # those by label and type first; cases, as looking up maps of constants took tens of microseconds a row
        out = F.when(F.lit(False), F.col(old))
        for (of, rel), to in sorted(ALIASES.items(), key=lambda x: x[0][1] is None):
            out = out.when((F.col(label) == of) & (F.lit(True) if rel is None else F.col("rel_type") == rel), to[which])
        return out.otherwise(F.col(old))

    return known(0, label), known(1, key)


def resolve(edges: DataFrame, vertices: DataFrame, *, aliases: bool = True) -> DataFrame:
    """Edges of which both ends are vertices, each once whatever document it came from.

    aliases: read the edge vocabulary as the vertices'; without it, edges to labels that no vertex has vanish.
    """
    if aliases:
        (fl, fk), (tl, tk) = _aliased("from_label", "from_key"), _aliased("to_label", "to_key")
        edges = edges.select(fl.alias("from_label"), fk.alias("from_key"), "from_id", "rel_type", tl.alias("to_label"), tk.alias("to_key"), "to_id")
    merged = edges.select(*ENDS).distinct()
    for side in ("from", "to"):
        v = vertices.select(F.col("label").alias(f"{side}_label"), F.col("key").alias(f"{side}_key"), F.col("id").alias(f"{side}_id"))
        merged = merged.join(v, [f"{side}_label", f"{side}_key", f"{side}_id"], "left_semi")
    return merged.select(*ENDS)


def resolved_types(*, aliases: bool = True) -> dict[str, tuple[tuple[str, str], tuple[str, str]]]:
    """Edge types of which both ends are kinds of vertices, with the labels and keys of those."""
    out = {}
    for rule in RULES:
        ends = [rule.start[:2], rule.end[:2]]
        if aliases:
            ends = [ALIASES.get((label, rule.rel_type), ALIASES.get((label, None), (label, key))) for label, key in ends]
        if all(e in VERTICES.values() for e in ends):
            out[rule.rel_type] = tuple(ends)
    return out


def resolve_sure(edges: DataFrame, *, aliases: bool = True) -> DataFrame:
    """What `resolve` makes of edges whose ends are known to be vertices as far as their labels are: no join."""
    ends = resolved_types(aliases=aliases)
    return _with_ends(edges.where(F.col("rel_type").isin(*ends)).select("rel_type", "from_id", "to_id").distinct(), ends)


def _with_ends(rows: DataFrame, ends: dict[str, tuple[tuple[str, str], tuple[str, str]]]) -> DataFrame:
    """(rel_type, from_id, to_id) with the labels and keys that the ends of their type have."""

    def named(side: int, part: int) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for rel, e in ends.items():
            out = out.when(F.col("rel_type") == rel, e[side][part])
        return out

    named_ends = {f"{side}_{part}": named(i, j).alias(f"{side}_{part}") for i, side in enumerate(("from", "to")) for j, part in enumerate(("label", "key"))}
    return rows.select(*[named_ends.get(c, F.col(c)) for c in ENDS])


def resolve_in_row(parsed: DataFrame, *, aliases: bool = True) -> DataFrame:
    """What `resolve` makes of edges_in_row(once=True) and vertex_ids_in_row of the same parsed rows, without its joins.

    Both ends of an edge come from its row, and so do the vertices they name: an edge of a type whose ends are kinds of
    vertices at all is resolved. Only a source_id that stripping changes may name no vertex and is looked up. Edges of a
    publication can come again only from a row of the same publication; rows whose publication is theirs alone give
    each edge once, and only the others' edges, and those of parties, are compared. `parsed` is read several times.
    """
    from gneiss.sources.tables import set_aside

    ends = resolved_types(aliases=aliases)
    of_pub = [r.rel_type for r in RULES if r.rel_type in ends and "Publication" in (r.start[0], r.end[0])]
    parties = [r for r in ends if r not in of_pub]
    root = F.col("root")
    valid = (root["country"] != "") & (root["doc_number"] != "") & (root["kind"] != "")
    pub = T.publication_id(root["country"], root["doc_number"], root["kind"])
    shared = set_aside(parsed.where(valid).groupBy(pub.alias("pub_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pub_id"), "shared")
    plain = T.strip(F.col("source_id")) == F.col("source_id")
    rows = parsed.where(valid).withColumn("pub_id", pub)

    def links(of: DataFrame, types: list[str]) -> DataFrame:
        return edges_in_row(of, types, once=True).select("rel_type", "from_id", "to_id")

    alone = links(rows.where(plain).join(shared, "pub_id", "left_anti"), of_pub)
    again = [links(rows.where(plain).join(shared, "pub_id", "left_semi"), of_pub)]
    if parties:
        again.append(links(parsed, parties))
    odd = rows.where(~plain)
    again.append(links(odd, [r for r in of_pub if r != "FROM_SOURCE"]))
    files = parsed.where(valid).select(F.col("source_id").alias("to_id"))
    again.append(links(odd, ["FROM_SOURCE"]).join(files, "to_id", "left_semi").select("rel_type", "from_id", "to_id"))
    # an odd row's edges may also be those of a plain row of the same publication
    mixed = reduce(DataFrame.unionByName, again).distinct()
    return _with_ends(alone.unionByName(mixed), ends)


def merge(target: DataFrame, source: DataFrame, key: list[str], *, keep: tuple[str, ...] = ()) -> DataFrame:
    """target with the rows of source (one per key) set over it.

    A matched row takes the source's values, nulls and blanks included, but for the columns in `keep`, which stay as
    they are unless null. Unmatched rows of either side stay.
    """
    t = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("t"))
    s = source.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("s"))
    both = t.join(s, key, "full_outer")

    def value(c: str) -> Column:
        if c in keep:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        return F.when(F.col("s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return both.select(*[F.col(c) if c in key else value(c).alias(c) for c in target.columns])


def merge_edges(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.select(*ENDS).unionByName(source.select(*ENDS)).distinct()


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that break uniqueness; empty for a good vertex table."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def constraint(label: str, key: str) -> str:
    """The uniqueness constraint of a graph store, safe to run again."""
    return f"CREATE CONSTRAINT IF NOT EXISTS FOR (n:{label}) REQUIRE n.{key} IS UNIQUE"


def constraints() -> list[str]:
    return [constraint(*v) for v in VERTICES.values()]


def new_source_ids(tables: dict[str, DataFrame], loaded: DataFrame) -> DataFrame:
    """Source ids in any table that are neither blank nor loaded yet."""
    ids = reduce(DataFrame.unionByName, [t.select("source_id") for t in tables.values()])
    return ids.where("source_id <> ''").distinct().join(loaded.select("source_id").distinct(), "source_id", "left_anti")


def sources_by_run(tables: dict[str, DataFrame], loaded: DataFrame) -> DataFrame:
    """(run, source_id, fresh): each run's sources that are not blank, and whether they are not loaded yet.

    Sources of edges that are `sure` come with a vertex as well.
    """
    rows = [t.where("sure is null or not sure") if "sure" in t.columns else t for t in tables.values()]
    ids = reduce(DataFrame.unionByName, [t.select("run", "source_id") for t in rows]).where("source_id <> ''").distinct()
    known = loaded.select("source_id").distinct().withColumn("known", F.lit(True))
    return ids.join(known, "source_id", "left").select("run", "source_id", F.col("known").isNull().alias("fresh"))


def only_fresh(tables: dict[str, DataFrame], sources: DataFrame) -> dict[str, DataFrame]:
    """Rows of the sources that `sources_by_run` calls fresh. Runs without any are not read; only runs that hold both kinds
    are joined, so what was loaded before costs nothing."""
    runs = sources.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.count_if("fresh").alias("fresh")).collect()
    whole, mixed = [r["run"] for r in runs if r["fresh"] == r["n"]], [r["run"] for r in runs if 0 < r["fresh"] < r["n"]]
    out = {n: t.where(F.col("run").isin(*whole) & (F.col("source_id") != "")) for n, t in tables.items()}
    if mixed:
        ids = sources.where(F.col("fresh") & F.col("run").isin(*mixed)).select("source_id").distinct()
        out = {n: t.unionByName(tables[n].where(F.col("run").isin(*mixed)).join(ids, "source_id", "left_semi").select(*t.columns)) for n, t in out.items()}
    return out


def only_sources(tables: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """Rows of the given sources."""
    return {n: t.join(ids, "source_id", "left_semi").select(*t.columns) for n, t in tables.items()}


def batch_ids(rows: DataFrame, order: list[str], size: int, folder: str | None = None) -> DataFrame:
    """rows with batch (from 0) of at most `size` rows each in the given order, which must tell all rows apart.

    Row numbers are made of per-partition counts of a range partitioning, so no task orders all rows. Counts and numbers
    come from one partitioning: the placed rows are written to `folder` (else to the session's checkpoint folder).
    """
    from pyspark.sql import Window

    from gneiss.sources.tables import set_aside

    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = set_aside(rows.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id()), "batches", folder)
    numbered = placed.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1)
    counts = placed.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    first = counts.select("__p", (F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).alias("__f"))  # one row per partition
    return numbered.join(F.broadcast(first), "__p").withColumn("batch", F.floor((F.coalesce("__f", F.lit(0)) + F.col("__n")) / F.lit(size)).cast("long")).drop("__p", "__n", "__f")
