"""Tables on disk, whole runs, increments and the stream."""

import pytest
from pyspark.sql import functions as F

from gneiss.plans.fixtures import patents
from gneiss.plans.pipelines import Config, build_graph, check_keys, export, graph_edges, graph_vertices, languages_of, run, status_table
from gneiss.schemas import CSV_NAMES, MANIFEST, TABLES, VERTICES, schema_of
from gneiss.sources import tables as TB
from gneiss.streaming.incremental import run_available
from tests.test_archives import tree, zipped
from tests.test_parse import FULL, head


def read(spark, cfg):
    edges = sorted(tuple(x) for x in graph_edges(spark, cfg).collect())
    vertices = {n: sorted(tuple(x) for x in graph_vertices(spark, cfg, n).collect()) for n in VERTICES}
    return edges, vertices


def sample(spark):
    xml = {"full": FULL, "bad": "<a>", "again": FULL.replace("Bonn", "Köln"), "other": head('<abstract lang="en">t</abstract>', 'country="EP" doc-number="9" kind="B1" id="EP9"')}
    return spark.createDataFrame([(f"T.zip::DOC/{i}{k}.xml", ["T.zip", f"DOC/{i}{k}.xml"], v.encode()) for i, (k, v) in enumerate(xml.items())], "source_id string, member_path array<string>, xml binary")


def test_run_and_rerun(spark, tmp_path):
    cfg = Config(f"{tmp_path}/w", ("en", "de"), csv_folder=f"{tmp_path}/csv")
    counts = run(spark, sample(spark), cfg)
    assert counts["publication"] == 3 and counts["applicant"] == 4 and counts["patent_fulltext"] == 3
    edges, vertices = read(spark, cfg)
    assert {x[3] for x in edges} == {"FROM_SOURCE", "HAS_PUBLICATION", "OF_APPLICATION", "HAS_IPC", "HAS_CPC", "APPLIES_FOR", "INVENTED", "REPRESENTS"}
    assert [x[5] for x in vertices["applicant"] if x[0] == "9"] == ["Köln"]
    assert {x["status"]: x["n"] for x in status_table(spark, cfg).groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()} == {"done": 3, "failed": 1}
    assert set(TB.read_node_tables(spark, cfg.csv_folder)) == set(CSV_NAMES)
    assert TB.read_node_tables(spark, cfg.csv_folder)["publication"].count() == 3
    assert run(spark, sample(spark), cfg, "weekly", 1)["publication"] == 0
    assert read(spark, cfg) == (edges, vertices)


def test_increments_equal_one_run(spark, tmp_path):
    a, b = Config(f"{tmp_path}/a"), Config(f"{tmp_path}/b")
    docs = patents(spark, "/root/testdata/sf0.001").withColumn("member_path", F.split("source_id", "::"))
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").where(F.col("source_id").rlike("[05]\\.xml$"))
    run(spark, docs, a)
    run(spark, docs.where(F.col("source_id").rlike("0\\.xml$")), b)
    run(spark, docs, b, "weekly", 1)
    (edges, vertices), (edges2, vertices2) = read(spark, a), read(spark, b)
    keys = lambda v: {n: sorted(x[TABLES[n].index(VERTICES[n][1])] for x in rows) for n, rows in v.items()}
    assert edges == edges2 and keys(vertices) == keys(vertices2)
    known = {(VERTICES[n][0], k) for n, ks in keys(vertices).items() for k in ks}
    assert all((x[0], x[2]) in known and (x[4], x[6]) in known for x in edges)


def test_options(spark, tmp_path):
    with pytest.raises(ValueError):
        export(spark, sample(spark), Config(f"{tmp_path}/f", fail_fast=True))
    assert export(spark, sample(spark), Config(f"{tmp_path}/s", stop_after=1))["publication"] == 1
    strict = Config(f"{tmp_path}/t", strict_application=True, strict_ipc=True, aliases=False)
    assert export(spark, sample(spark), strict)["publication"] == 2
    build_graph(spark, strict)
    assert {x[3] for x in read(spark, strict)[0]} == {"FROM_SOURCE", "HAS_PUBLICATION", "OF_APPLICATION"}
    with pytest.raises(ValueError):
        run(spark, sample(spark), strict, "monthly")
    with pytest.raises(ValueError):
        from gneiss.operators.fulltext import fulltext

        fulltext(spark.range(1), [])
    assert languages_of(" en, de,") == ("en", "de") and languages_of(None) == ("en",)


def test_stream(spark, tmp_path):
    folder, cfg = tmp_path / "in", Config(f"{tmp_path}/w")
    folder.mkdir()
    (folder / "a.zip").write_bytes(zipped(**{"DOC/EP1.xml": FULL.encode()}))
    assert run_available(spark, str(folder), cfg, f"{tmp_path}/cp") == 1
    (folder / "b.zip").write_bytes(zipped(**{"DOC/EP2.xml": head("", 'country="EP" doc-number="2" kind="A1" id="EP2"').encode(), "DOC/n.zip": tree()}))
    assert run_available(spark, str(folder), cfg, f"{tmp_path}/cp") == 1
    assert run_available(spark, str(folder), cfg, f"{tmp_path}/cp") == 0
    assert {x[0] for x in read(spark, cfg)[1]["publication"]} == {"EP123A1", "EP2A1"}


def test_csv(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    assert TB.read_csv(spark, path, schema_of("source_file")).collect() == []
    df = spark.createDataFrame([(' a "q", \n', None)], "a string, b string")
    TB.write_csv(df, path)
    TB.write_csv(df, path)
    assert [tuple(x) for x in TB.read_csv(spark, path, df.schema).collect()] == [(' a "q", \n', "")] * 2
    TB.write_csv(df.limit(0), f"{tmp_path}/e.csv")
    assert [x["value"] for x in spark.read.text(f"{tmp_path}/e.csv").collect()] == ["a,b"]


def test_manifest_file(spark, tmp_path):
    path = f"{tmp_path}/m.csv"
    m = spark.createDataFrame([("b", *[""] * 6), ("a", *["x"] * 6)], MANIFEST)
    TB.write_manifest(m, path)
    assert [x["filename"] for x in TB.read_manifest(spark, path).orderBy("row").collect()] == ["a", "b"] 
    TB.write_manifest(m.limit(1), path)
    assert [x["filename"] for x in TB.read_manifest(spark, path).collect()] == ["b"] and sorted(p.name for p in (tmp_path / "m.csv").glob("v=*")) == ["v=1", "v=2"]


def test_id_list(spark, tmp_path):
    path = f"{tmp_path}/ids"
    for batch in (["a", " b "], ["b", "", "c"]):
        TB.append_ids(spark.createDataFrame([(x,) for x in batch], "source_id string"), path)
    assert sorted(x[0] for x in spark.read.text(path).collect()) == ["a", "b", "c"] == sorted(x[0] for x in TB.read_id_list(spark, path).collect())


def test_arguments():
    from gneiss.__main__ import arguments

    assert arguments(["--archives-dir", "d", "--output-dir", "o"]).mode == "initial"
    for bad in (["--archives-dir", "d", "--xml-dir", "e", "--output-dir", "o"], ["--output-dir", "o"], ["--xml-dir", "x"]):
        with pytest.raises(SystemExit):
            arguments(bad)


def test_manifest_is_sorted_in_parts(spark, tmp_path):
    """One file sorted by name, of many parts: no task takes all rows; odd texts and an empty manifest come back."""
    path = str(tmp_path / "manifest")
    names = F.concat(F.lit("f"), F.col("id").cast("string"))
    rows = spark.range(500).repartition(7).select(names.alias("filename"), F.lit('a "b",\nc').alias("status"), *[F.lit(c).alias(f.name) for f, c in zip(MANIFEST.fields[2:], ["", " x ", "2", "3", "é"])])
    tasks = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("manifest", "manifest")
    TB.write_manifest(rows, path)
    most = max(tasks.getStageInfo(s).numTasks for j in tasks.getJobIdsForGroup("manifest") for s in tasks.getJobInfo(j).stageIds[-1:])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = [tuple(r) for r in TB.read_manifest(spark, path).orderBy("row").collect()]
    assert [g[0] for g in got] == sorted(f"f{i}" for i in range(500)) and [g[-1] for g in got] == list(range(500))
    assert {g[1:-1] for g in got} == {('a "b",\nc', "", " x ", "2", "3", "é")} and most > 1
    TB.write_manifest(rows.limit(0), path)
    assert TB.read_manifest(spark, path).count() == 0


def test_loading_joins_no_edges(spark, tmp_path, monkeypatch):
    """q46: edges made in the row of their vertices are loaded without looking the vertices up; new runs alone are read."""
    from gneiss.plans import pipelines

    cfg = Config(f"{tmp_path}/w", buckets=2)
    docs = sample(spark).where("source_id not like '%again%'").localCheckpoint()
    first = docs.where("source_id like '%full%'")
    export(spark, first, cfg, 0, ("graph",))
    export(spark, docs, cfg, 1, ("graph",))
    with monkeypatch.context() as m:
        m.setattr(pipelines.g, "resolve", None)
        m.setattr(pipelines.g, "only_sources", None)
        build_graph(spark, cfg, "incremental")
    got = {tuple(x) for x in graph_edges(spark, cfg).collect()}
    found = pipelines.silver(spark, cfg)["edge"]
    everything = pipelines.g.vertex_ids({n: graph_vertices(spark, cfg, n) for n in VERTICES})
    assert got == {tuple(x) for x in pipelines.g.resolve(found, everything).collect()} and len({x[3] for x in got}) == 8
