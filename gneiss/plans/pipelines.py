"""The dataflows: parse once, derive node tables, edges, graph and full text; bulk and incremental."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from gneiss.functions.text import Keys
from gneiss.operators import fulltext as ft
from gneiss.operators import graph as g
from gneiss.operators.edges import EdgeRule, edges, edges_in_row, edges_of_documents
from gneiss.operators.nodes import NODE_TABLES, node_tables
from gneiss.operators.parse import FIELDS, parse, split_failures
from gneiss.operators.status import done_rows, failed_rows, latest_status, pending_of_many
from gneiss.schemas import FULLTEXT, PARSED, STATUS, TABLES, VERTICES, empty, record, schema_of
from gneiss.sources.stores import Connection, GraphSession, ensure_constraints, put_edges, put_vertices, upsert_sql
from gneiss.sources.tables import exists, forget, merge_buckets, nothing, read_parquet, set_aside, write_node_tables

log = logging.getLogger("gneiss")


@dataclass(frozen=True)
class Config:
    """Where tables lie and how strict extraction is. The faithful profile is strict and without aliases."""

    folder: str
    languages: tuple[str, ...] = ("en",)
    strict_application: bool = False
    strict_ipc: bool = False
    aliases: bool = True
    fail_fast: bool = False
    stop_after: int | None = None
    csv_folder: str | None = None
    batch_size: int = 500
    buckets: int = 64
    keys: Keys = Keys()
    extractors: Mapping[str, Callable[..., DataFrame]] | None = None  # other ways to make node tables
    rules: Sequence[EdgeRule] | None = None  # other edge rules; these are joined, not made in the row
    sink: Callable[[str, DataFrame], None] | None = None  # is given every table that an export writes
    connect: Callable[[], Connection] | None = None  # a SQL database that full text goes to as well
    graph: Callable[[], GraphSession] | None = None  # a graph store that the graph goes to as well

    def at(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"


#: What an export can make, and where its documents' status is kept.
PARTS = {"graph": "status", "fulltext": "status_fulltext"}


def status_table(spark: SparkSession, cfg: Config, part: str = "graph") -> DataFrame:
    log = read_parquet(spark, cfg.at(PARTS[part]), StructType([*STATUS.fields, StructField("seq", LongType())]))
    return latest_status(log, ["seq"])


def take_successes(good: DataFrame, n: int | None) -> DataFrame:
    """The first n good documents in delivery order."""
    return good if n is None else good.orderBy("batch_id", "member_path").limit(n)


def export(spark: SparkSession, documents: DataFrame, cfg: Config, batch_id: int = 0, parts: Sequence[str] = ("graph", "fulltext")) -> dict[str, int]:
    """One run over (source_id, member_path, xml, and error where an archive could not be read): new documents are parsed
    once; tables (part graph), full text (part fulltext) and status are written.

    Documents that all parts have done before are skipped without being parsed; failed ones are tried again. What a part
    has done already it does not do again. Returns rows per table and documents done and failed.
    """
    if not parts or set(parts) - set(PARTS):
        raise ValueError(f"unknown parts {parts}")
    known = [status_table(spark, cfg, p).where("status = 'done'").select("source_id") for p in parts]
    both = reduce(lambda a, b: a.join(b, "source_id", "left_semi"), known).withColumn("status", F.lit("done"))
    todo = pending_of_many(documents.withColumn("batch_id", F.lit(batch_id).cast("long")), both)
    bronze = cfg.at(f"parsed/{'-'.join(parts)}/batch_id={batch_id}")
    wanted = None if "fulltext" in parts else [f for f in FIELDS if f not in ("abstracts", "description", "claims")]
    if "graph" not in parts:
        wanted = ["root", "appl", "ipc", "abstracts", "description", "claims"]
    parse(todo, wanted).drop("batch_id").write.mode("overwrite").parquet(bronze)
    parsed = spark.read.parquet(bronze).withColumn("batch_id", F.lit(batch_id).cast("long")).select(*PARSED.names)
    good, bad = split_failures(parsed, strict_application=cfg.strict_application, strict_ipc=cfg.strict_ipc)
    if cfg.fail_fast and (first := bad.head()):
        raise ValueError(f"{first['source_id']}: {first['error']}")
    good = take_successes(good, cfg.stop_after)
    counts = {}

    def counted(rows: DataFrame, name: str, path: str) -> None:
        seen = Observation(name)
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        counts[name] = seen.get["n"]

    for part, of in zip(parts, known, strict=True):
        own = good.join(of, "source_id", "left_anti") if len(parts) > 1 else good
        if part == "graph":
            tables = node_tables(own, ordered=True, keys=cfg.keys, extractors=cfg.extractors)
            if cfg.rules is not None:
                links = edges(tables, cfg.rules)
            else:
                plain = cfg.keys == Keys() and not cfg.extractors
                links = edges_of_documents(own) if plain else edges_in_row(own, keys=cfg.keys)
            for name, rows in [*tables.items(), ("edge", links)]:
                counted(rows, name, cfg.at(f"silver/{name}/run={batch_id}"))
                if cfg.sink:
                    cfg.sink(name, spark.read.parquet(cfg.at(f"silver/{name}/run={batch_id}")).drop("sure"))
            if cfg.csv_folder:
                held = {n: spark.read.parquet(cfg.at(f"silver/{n}/run={batch_id}")).select(*TABLES[n]) for n in [*tables, "edge"]}
                write_node_tables({**held, "citation": empty(spark, "citation")}, cfg.csv_folder)
        else:
            batch = ft.collapse_batch(ft.fulltext(own, cfg.languages, ordered=True))
            counted(batch, "patent_fulltext", cfg.at(f"silver/fulltext/run={batch_id}"))
            batch = spark.read.schema(FULLTEXT).parquet(cfg.at(f"silver/fulltext/run={batch_id}"))
            if cfg.sink:
                cfg.sink("patent_fulltext", batch)
            merge_buckets(spark, cfg.at("fulltext"), FULLTEXT, ("pub_id", "lang"), batch, ft.upsert, cfg.buckets)
            if cfg.connect:
                upsert_sql(batch, cfg.connect, "patent_fulltext", ("pub_id", "lang"), keep=("appln_id",), batch=cfg.batch_size)
        news = done_rows(own).unionByName(failed_rows(bad)).withColumn("seq", F.lit(batch_id).cast("long"))
        news.write.mode("overwrite").parquet(cfg.at(f"{PARTS[part]}/run={batch_id}"))
    for r in spark.read.parquet(cfg.at(f"{PARTS[parts[0]]}/run={batch_id}")).groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[f"documents_{r['status']}"] = r["n"]
    return counts


#: What a node table on disk has besides its columns: which row is the later one.
ORDER = StructType([StructField("batch_id", LongType()), StructField("member_path", ArrayType(StringType())), StructField("ordinal", IntegerType())])


def silver(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """All runs' node tables and edges, with their run. Edges that are `sure` are between vertices of the same run."""
    out = {}
    for name in [*NODE_TABLES, "edge"]:
        schema = StructType([*schema_of(name), StructField("sure", BooleanType())] if name == "edge" else [*schema_of(name), *ORDER])
        if exists(spark, cfg.at(f"silver/{name}")):
            out[name] = spark.read.schema(StructType([*schema, StructField("run", LongType())])).parquet(cfg.at(f"silver/{name}"))
        else:
            out[name] = nothing(spark, schema).withColumn("run", F.lit(0).cast("long"))
    return out


def graph_vertices(spark: SparkSession, cfg: Config, table: str) -> DataFrame:
    return read_parquet(spark, cfg.at(f"graph/vertices/{table}"), schema_of(table)).select(*TABLES[table])


def graph_edges(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_parquet(spark, cfg.at("graph/edges"), record(*g.ENDS)).select(*g.ENDS)


STEPS = ("schema", "nodes", "relationships", "all")


def build_graph(spark: SparkSession, cfg: Config, mode: str = "bulk", step: str = "all") -> dict[str, int]:
    """Merge silver tables into the graph's vertices and edges, and into a graph store if cfg.graph names one.

    bulk takes all rows, incremental those of sources not loaded yet; edges resolve against all vertices, old and new,
    after these are merged. Only those parts of a table are rewritten that new rows touch. Loaded sources are noted last,
    in both modes. `step` schema makes the store's constraints and checks that no key of the vertices comes twice. Returns
    rows put per table.
    """
    if mode not in ("bulk", "incremental") or step not in STEPS:
        raise ValueError(f"unknown mode {mode} or step {step}")
    counts: dict[str, int] = {}
    if step in ("schema", "all") and cfg.graph:
        counts["constraints"] = ensure_constraints(cfg.graph)
    if step == "schema":
        return counts | check_keys(spark, cfg)
    tables = silver(spark, cfg)
    loaded = read_parquet(spark, cfg.at("graph/loaded"), schema_of("source_file"))
    sources = set_aside(g.sources_by_run(tables, loaded), "sources")
    if mode == "incremental":
        tables = g.only_fresh(tables, sources)
    if step in ("nodes", "all"):
        for name in VERTICES:
            _, key = VERTICES[name]
            now = set_aside(g.vertices_of(tables[name], name, ["batch_id", "member_path", "ordinal"]), name)
            merge_buckets(spark, cfg.at(f"graph/vertices/{name}"), schema_of(name), [key], now, lambda old, new, k=key, n=name: g.merge(old, new, [k]).select(*TABLES[n]), cfg.buckets)
            counts[name] = put_vertices(now, name, cfg.graph, cfg.batch_size) if cfg.graph else now.count()
            forget(now)
    if step in ("relationships", "all"):
        found = tables["edge"]
        # without vertices merged just now, none are sure
        open_ends = found.where("sure is null or not sure") if step == "all" else found
        parts = [g.resolve_sure(found.where("sure"), aliases=cfg.aliases)] if step == "all" else []
        if not parts or not open_ends.isEmpty():
            everything = g.vertex_ids({n: graph_vertices(spark, cfg, n) for n in VERTICES})
            parts.append(g.resolve(open_ends, everything, aliases=cfg.aliases))
        now = set_aside(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).distinct(), "edges")
        merge_buckets(spark, cfg.at("graph/edges"), record(*g.ENDS), g.ENDS, now, g.merge_edges, cfg.buckets)
        counts["edge"] = sum(put_edges(now, cfg.graph, cfg.batch_size).values()) if cfg.graph else now.count()
        forget(now)
    if step == "all":
        sources.where("fresh").select("source_id").distinct().write.mode("append").parquet(cfg.at("graph/loaded"))
        check_keys(spark, cfg)
    forget(sources)
    return counts


def check_keys(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Raise if a key of a vertex table comes twice; vertices per table."""
    keys = reduce(DataFrame.unionByName, [graph_vertices(spark, cfg, name).select(F.lit(name).alias("table"), F.col(key).alias("key")) for name, (_, key) in VERTICES.items()])
    seen = keys.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("table").agg(F.sum("n").alias("rows"), F.max_by("key", "n").alias("key"), F.max("n").alias("n")).collect()
    for x in seen:
        if x["n"] > 1:
            raise ValueError(f"{x['table']}: key {x['key']} comes {x['n']} times")
    return dict.fromkeys(VERTICES, 0) | {x["table"]: x["rows"] for x in seen}


#: The stages of a whole run, in order.
STAGES = ("ingest", "graph", "fulltext", "load")


def run(spark: SparkSession, documents: DataFrame | None, cfg: Config, mode: str = "initial", batch_id: int = 0, *, stages: Sequence[str] = STAGES[1:], before: Callable[[], tuple[dict[str, int], DataFrame]] | None = None) -> dict[str, int]:
    """initial or weekly: ingest (by `before`, which also gives the documents), graph tables and full text, then a bulk or an
    incremental merge into the graph. The first failing stage ends the run. Graph tables and full text, if both are
    wanted, are made of one parse. Returns counts.
    """
    if mode not in ("initial", "weekly"):
        raise ValueError(f"unknown mode {mode}")
    if set(stages) - set(STAGES):
        raise ValueError(f"unknown stages {stages}")
    counts: dict[str, int] = {}

    def stage(name: str, work: Callable[[], dict[str, int]]) -> None:
        began = time.monotonic()
        log.info("[%s] starting", name)
        try:
            done = work()
        except Exception:
            log.error("[%s] failed after %.1f s", name, time.monotonic() - began)
            raise
        log.info("[%s] done in %.1f s: %s", name, time.monotonic() - began, done)
        counts.update(done if name != "load" else {f"loaded_{k}": v for k, v in done.items()})

    if "ingest" in stages and before is not None:
        found: list[DataFrame] = []

        def first() -> dict[str, int]:
            said, rows = before()
            found.append(rows)
            return said

        stage("ingest", first)
        documents = found[0]
    parts = [p for p in PARTS if p in stages]
    if parts:
        if documents is None:
            raise ValueError("no documents to export")
        stage("+".join(parts), lambda: export(spark, documents, cfg, batch_id, parts))
    if "load" in stages:
        stage("load", lambda: build_graph(spark, cfg, "bulk" if mode == "initial" else "incremental"))
    return counts


def languages_of(value: str | None, default: Sequence[str] = ("en",)) -> tuple[str, ...]:
    """Languages from a comma list."""
    return tuple(x.strip() for x in value.split(",") if x.strip()) if value else tuple(default)
