"""SQL and graph-store sinks, bucketed tables behind a pointer, and the one command over file URLs."""

import json
import sqlite3
from functools import partial

import pytest
from pyspark.sql import functions as F

from gneiss.__main__ import arguments, main, sqlite
from gneiss.operators import edges as E
from gneiss.operators import graph as G
from gneiss.operators import nodes as N
from gneiss.operators.parse import FIELDS, parse
from gneiss.plans.fixtures import patents
from gneiss.plans.ingest import IngestConfig, ingest, ingest_one
from gneiss.plans.pipelines import Config, build_graph, check_keys, export, graph_edges, graph_vertices, run, status_table
from gneiss.schemas import FULLTEXT, VERTICES, record
from gneiss.sources import http, stores
from gneiss.sources import tables as TB
from gneiss.sources.archives import filter_archive, read_archives
from tests.test_archives import tree, zipped
from tests.test_flows import sample
from tests.test_parse import FULL


class Recorder:
    """A graph session that writes what it runs to a file."""

    def __init__(self, path):
        self.path = path

    def run(self, statement, **parameters):
        with open(self.path, "a") as f:
            f.write(json.dumps([statement, parameters]) + "\n")

    def close(self):
        pass


def record_to(path):
    return Recorder(path)


def said(path):
    with open(path) as f:
        return [json.loads(line) for line in f]


def test_upsert_sql(spark, tmp_path):
    connect = partial(sqlite, f"{tmp_path}/x.db")
    rows = spark.createDataFrame([(f"P{i % 7}", "en", None if i < 3 else f"A{i}", f"text {i}") for i in range(7)], "pub_id string, lang string, appln_id string, abstract_text string")
    put = partial(stores.upsert_sql, connect=connect, table="t", key=("pub_id", "lang"), keep=("appln_id",), batch=2, writers=1)
    assert put(rows) == 7 and put(rows) == 7
    more = rows.limit(4).select("pub_id", "lang", F.lit("new").alias("appln_id"), F.lit(None).cast("string").alias("abstract_text"))
    assert put(more) == 4 and put(rows.limit(0)) == 0
    got = {r[0]: r[1:] for r in connect().execute("select pub_id, appln_id, abstract_text from t")}
    assert got == {f"P{i}": (("new" if i < 3 else f"A{i}"), None if i < 4 else f"text {i}") for i in range(7)}
    bad = rows.withColumn("lang", F.when(F.col("pub_id") != "P6", F.col("lang")))
    with pytest.raises(Exception, match="NOT NULL"):
        put(bad)


def test_graph_store(spark, tmp_path):
    cfg = Config(f"{tmp_path}/w", buckets=4, batch_size=2, graph=partial(record_to, f"{tmp_path}/log"))
    run(spark, sample(spark), cfg)
    lines = said(f"{tmp_path}/log")
    assert [s for s, _ in lines[:8]] == G.constraints()
    merged = [(s, r) for s, p in lines[8:] for r in p["rows"] if s.startswith("UNWIND $rows AS row MERGE (n:")]
    linked = [(s, r) for s, p in lines[8:] for r in p["rows"] if "MATCH" in s]
    assert max(len(p["rows"]) for _, p in lines[8:]) == 2
    assert {(s.split("(n:")[1].split(" ")[0]) for s, _ in merged} == {label for label, _ in VERTICES.values()}
    assert len(merged) == sum(graph_vertices(spark, cfg, t).count() for t in VERTICES) and len(linked) == graph_edges(spark, cfg).count()
    assert any("[:HAS_IPC]" in s and "(b:IpcClassification {long_code" not in s and "ipc_long_code: row.to_id" in s for s, _ in linked)
    before = len(lines)
    assert build_graph(spark, cfg, "incremental") and all(not p.get("rows") for _, p in said(f"{tmp_path}/log")[before:])
    assert build_graph(spark, cfg, step="schema")["publication"] == graph_vertices(spark, cfg, "publication").count()
    for bad in (dict(mode="some"), dict(step="some")):
        with pytest.raises(ValueError):
            build_graph(spark, cfg, **bad)


def test_duplicate_keys_are_found(spark, tmp_path):
    cfg = Config(f"{tmp_path}/w", buckets=2)
    run(spark, sample(spark), cfg)
    rows = graph_vertices(spark, cfg, "publication")
    TB.overwrite(rows.union(rows.limit(1)), cfg.at("graph/vertices/publication"))
    with pytest.raises(ValueError, match="publication"):
        check_keys(spark, cfg)


def test_merge_buckets(spark, tmp_path):
    """Only touched buckets are written; readers of the old state are not disturbed; a broken run leaves no trace."""
    schema, path = record("k", "v"), f"{tmp_path}/t"

    def rows(pairs):
        return spark.createDataFrame([(str(k), v) for k, v in pairs], schema)

    def put(pairs, combine=lambda a, b: G.merge(a, b, ["k"])):
        return TB.merge_buckets(spark, path, schema, ["k"], rows(pairs), combine, 16)

    def now():
        return {r["k"]: r["v"] for r in TB.read_parquet(spark, path, schema).collect()}

    assert now() == {} and put([]) == 0
    assert put([(i, "a") for i in range(200)]) == 16 and len(now()) == 200
    old = TB.read_parquet(spark, path, schema)
    assert put([(5, "b"), (900, None)]) <= 2
    assert {r["k"]: r["v"] for r in old.collect()} == {str(i): "a" for i in range(200)}
    assert now() == {**{str(i): "a" for i in range(200)}, "5": "b", "900": None}
    state = TB.pointer(spark, path)
    with pytest.raises(ZeroDivisionError):
        put([(6, "c")], lambda a, b: 1 / 0)
    assert TB.pointer(spark, path) == state and now()["6"] == "a"
    assert put([(6, "c")]) == 1 and now()["6"] == "c" and len(now()) == 201
    only = {r["k"] for r in TB.read_parquet(spark, path, schema, [0]).collect()}
    assert 0 < len(only) < 40


def test_versions(spark, tmp_path):
    path, schema = f"{tmp_path}/t", record("k")
    for i in range(3):
        was = TB.read_parquet(spark, path, schema)
        TB.overwrite(was.union(spark.createDataFrame([(str(i),)], schema)), path)
    assert sorted(r[0] for r in TB.read_parquet(spark, path, schema).collect()) == ["0", "1", "2"]
    assert sorted(r[0] for r in was.collect()) == ["0", "1"]  # the version before is still there


def test_broken_archives_are_told(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good a.zip").write_bytes(tree())
    (tmp_path / "in" / "junk.ZIP").write_bytes(b"junk")
    (tmp_path / "in" / "b.tar.gz").write_bytes(b"junk")
    (tmp_path / "in" / "notes.txt").write_bytes(b"no archive")
    docs = read_archives(spark, str(tmp_path / "in"))
    by_path = read_archives(spark, str(tmp_path / "in"), most_bytes=10)
    key = lambda rows: sorted((r["archive"], r["source_id"], r["xml"] and bytes(r["xml"]), r["error"]) for r in rows.collect())
    assert key(docs) == key(by_path) and len(key(docs)) == 8
    cfg = Config(f"{tmp_path}/w", buckets=2)
    counts = export(spark, docs, cfg)
    failed = {r["source_id"]: r["error"] for r in status_table(spark, cfg).where("status = 'failed'").collect()}
    assert set(failed) == {"good a.zip::DOC/bad.zip", "junk.ZIP", "b.tar.gz"} and failed["junk.ZIP"].startswith("BadZipFile")
    assert counts["documents_failed"] == 3 and counts["documents_done"] == 5


def test_parts_and_stages(spark, tmp_path):
    cfg = Config(f"{tmp_path}/w", buckets=2, connect=partial(sqlite, f"{tmp_path}/f.db"))
    docs = sample(spark)
    assert "patent_fulltext" not in run(spark, docs, cfg, stages=["graph"])
    counts = run(spark, docs, cfg, stages=["fulltext"], batch_id=1)
    assert counts["patent_fulltext"] == 2 and "publication" not in counts
    both = run(spark, docs, cfg, "weekly", 2)
    assert both["publication"] == 0 and both["patent_fulltext"] == 0
    with sqlite3.connect(f"{tmp_path}/f.db") as c:
        rows = {r[0]: r[1] for r in c.execute("select pub_id, abstract_text from patent_fulltext")}
    held = {r["pub_id"]: r["abstract_text"] for r in TB.read_parquet(spark, cfg.at("fulltext"), FULLTEXT).collect()}
    assert rows == held and len(rows) == 2
    for bad in (dict(stages=["some"]), dict(mode="monthly")):
        with pytest.raises(ValueError):
            run(spark, docs, cfg, **bad)
    with pytest.raises(ValueError):
        run(spark, None, cfg)
    with pytest.raises(ValueError):
        export(spark, docs, cfg, parts=())


def served(tmp_path):
    files = {"1": ("a.zip", zipped(**{"DOC/EP1.xml": FULL.encode(), "DOC/us.xml": b"<b/>"})), "2": ("b.zip", zipped(**{"x.txt": b"-"})), "3": ("c.zip", b"junk"), "5": ("e.rar", b"")}
    for i, (_, body) in files.items():
        p = tmp_path / "served" / "32" / "delivery" / "d" / "file" / i
        p.mkdir(parents=True)
        (p / "download").write_bytes(body)
    return {"deliveries": [{"id": "d", "files": [{"id": i, "name": n} for i, (n, _) in files.items()]}]}


def test_ingest_writes_its_manifest(spark, tmp_path):
    meta = served(tmp_path)
    (tmp_path / "served" / "33").write_text(json.dumps(meta))
    cfg = IngestConfig(f"file://{tmp_path}/served", "32", *(f"{tmp_path}/{d}" for d in ("raw", "staging", "final")), clock=lambda: 7)
    for _ in range(2):
        assert ingest(spark, cfg, meta) == {"archives": 4, "moved": 1, "empty": 1, "failed": 1, "skipped": 1}
    rows = {r["filename"]: r for r in TB.read_manifest(spark, cfg.manifest_path).orderBy("row").collect()}
    assert list(rows) == ["a.zip", "b.zip", "c.zip", "e.rar"] and rows["a.zip"]["status"] == "moved" and rows["e.rar"]["raw_size"] == ""
    fewer = {"deliveries": [{"id": "d", "files": meta["deliveries"][0]["files"][:1]}]}
    assert ingest(spark, cfg, fewer) == {"archives": 1, "moved": 1}
    assert TB.read_manifest(spark, cfg.manifest_path).count() == 4  # what is no longer listed stays told
    with pytest.raises(Exception):
        ingest(spark, IngestConfig(f"file://{tmp_path}/none", "1", "r", "s", "f"))


def test_ingest_with_own_validators_and_mover(tmp_path):
    served(tmp_path)
    moved = []

    def mover(a, b):
        moved.append((a.name, b.name))
        http.move(a, b)

    def check(path):
        if b"us.xml" in path.read_bytes():
            raise ValueError("not filtered")

    cfg = IngestConfig(f"file://{tmp_path}/served", "32", *(f"{tmp_path}/{d}" for d in ("raw", "staging", "final")), mover=mover)
    got = ingest_one("d", "1", "a.zip", None, cfg)
    assert got["status"] == "moved" and got["message"] == "xml 1, nested 0 of 0" and moved == [("a.zip", "a.zip")]
    strict = IngestConfig(f"file://{tmp_path}/served", "32", *(f"{tmp_path}/2/{d}" for d in ("raw", "staging", "final")), validators=lambda name: (check,))
    assert ingest_one("d", "1", "a.zip", None, strict)["message"].startswith("download: ValueError")


def test_filter_keeps_dates_modes_and_counts(tmp_path):
    import io
    import tarfile
    import zipfile

    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w:gz") as t:
        info = tarfile.TarInfo("EP9.xml")
        info.mtime, info.mode, info.size = 1234567890, 0o640, 4
        t.addfile(info, io.BytesIO(b"<a/>"))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"of the archive"
        member = zipfile.ZipInfo("DOC/EP1.xml", (2001, 2, 3, 4, 5, 6))
        member.external_attr, member.comment = 0o604 << 16, b"of the member"
        z.writestr(member, b"<a/>")
        z.writestr("DOC/n.tgz", inner.getvalue())
        z.writestr("DOC/none.zip", zipped(**{"x.txt": b"-"}))
    out = io.BytesIO()
    kept = filter_archive(raw, "a.zip", out, match={"prefix": "ep"})
    assert (kept.xml, kept.nested_seen, kept.nested_kept) == (2, 2, 1)
    with zipfile.ZipFile(out) as z:
        one, nested = z.getinfo("DOC/EP1.xml"), z.getinfo("DOC/n.tgz")
        assert z.comment == b"of the archive" and one.date_time == (2001, 2, 3, 4, 5, 6) and one.external_attr >> 16 == 0o604 and one.comment == b"of the member"
        assert nested.compress_type == zipfile.ZIP_STORED and z.namelist() == ["DOC/EP1.xml", "DOC/n.tgz"]
        with tarfile.open(fileobj=io.BytesIO(z.read(nested))) as t:
            assert [(m.name, m.mtime, m.mode) for m in t.getmembers()] == [("EP9.xml", 1234567890, 0o640)]


def test_one_command(spark, tmp_path, monkeypatch, capsys):
    """From a product's metadata to the graph, and again as a weekly run that finds nothing new."""
    meta = served(tmp_path)
    monkeypatch.setattr("gneiss.plans.ingest.get_json", lambda url, headers=None: meta if url.endswith("/32") else None)
    dirs = [x for d in ("raw", "staging", "final", "log") for x in (f"--{d}-dir", f"{tmp_path}/{d}")]
    args = ["--base-url", f"file://{tmp_path}/served", "--product-id", "32", *dirs, "--output-dir", f"{tmp_path}/w", "--sqlite", f"{tmp_path}/f.db"]
    assert main(args) == 0
    counts = dict(line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line)
    assert counts["archives"] == "4" and counts["archives_moved"] == "1" and counts["publication"] == "1" and counts["patent_fulltext"] == "1" and counts["loaded_publication"] == "1"
    assert main([*args, "--mode", "weekly", "--batch-id", "1"]) == 0
    again = dict(line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line)
    assert again["publication"] == "0" and again["loaded_publication"] == "0"
    assert main(["--stage", "load", "--step", "schema", "--output-dir", f"{tmp_path}/w"]) == 0
    assert "publication\t1" in capsys.readouterr().out
    assert main(["--xml-dir", f"{tmp_path}/none", "--output-dir", f"{tmp_path}/v"]) == 1
    assert any("[ingest] done" in p.read_text() for p in (tmp_path / "log").glob("pipeline_*.log"))


def test_stage_arguments(monkeypatch):
    assert arguments(["--archives-dir", "d", "--output-dir", "o"]).stage == ["graph", "fulltext", "load"]
    got = arguments(["--base-url", "u", "--product-id", "1", "--output-dir", "o"])
    assert got.stage == ["ingest", "graph", "fulltext", "load"] and got.archives_dir == got.final_dir == "data/final"
    monkeypatch.setenv("PIPELINE_FINAL_DIR", "/env")
    assert arguments(["--base-url", "u", "--product-id", "1", "--output-dir", "o"]).final_dir == "/env"
    assert arguments(["--base-url", "u", "--product-id", "1", "--output-dir", "o", "--final-dir", "/arg"]).final_dir == "/arg"
    for bad in (["--stage", "ingest", "--output-dir", "o"], ["--base-url", "u", "--product-id", "1", "--xml-dir", "x", "--output-dir", "o"], ["--stage", "graph", "--output-dir", "o"], ["--stage", "some", "--output-dir", "o"]):
        with pytest.raises(SystemExit):
            arguments(bad)


def test_edges_and_vertices_in_row(spark):
    """One pass over the parsed rows gives what the tables and joins give; pruned fields give the same edges."""
    docs = patents(spark, "/root/testdata/sf0.001")
    parsed = parse(docs).cache()
    assert sorted(map(tuple, G.vertex_ids_in_row(parsed).collect())) == sorted(map(tuple, G.vertex_ids(N.node_tables(parsed)).collect()))
    whole = sorted(map(tuple, E.edges_in_row(parsed).collect()))
    assert sorted(map(tuple, E.edges_in_row(parsed, once=True).collect())) == whole
    for types in (("HAS_IPC",), ("INVENTED", "FROM_SOURCE"), tuple(r.rel_type for r in E.RULES)):
        pruned = parse(docs, E.fields_for(types))
        assert sorted(map(tuple, E.edges_in_row(pruned, types, once=True).collect())) == [x for x in whole if x[3] in types]
    parsed.unpersist()


def test_parse_of_some_fields(spark):
    docs = spark.createDataFrame([("a", FULL.encode(), None), ("b", b"<a>", None), ("c", None, "BadZipFile: x")], "source_id string, xml binary, error string")
    whole = {r["source_id"]: r for r in parse(docs).collect()}
    some = {r["source_id"]: r for r in parse(docs, ["ipc", "root"]).collect()}
    assert whole["c"]["error"] == "BadZipFile: x" and whole["b"]["error"].startswith("ParseError")
    for i, row in some.items():
        assert (row["error"], row["root"], row["ipc"]) == (whole[i]["error"], whole[i]["root"], whole[i]["ipc"])
        assert all(row[f] is None for f in FIELDS if f not in ("root", "ipc"))
    with pytest.raises(ValueError):
        parse(docs, ["some"])


def test_own_keys_extractors_rules_and_sink(spark, tmp_path):
    from gneiss.functions.text import Keys

    def shout(ident, name, country):
        return F.upper(F.concat(F.lit("K:"), name))

    def no_attorneys(parsed, *keep):
        return N.attorneys(parsed, *keep).where("false")

    seen = {}
    cfg = Config(f"{tmp_path}/w", buckets=2, keys=Keys(organisation=shout), extractors={"attorney": no_attorneys}, sink=lambda name, rows: seen.update({name: rows.count()}))
    counts = run(spark, sample(spark), cfg)
    assert counts["attorney"] == 0 == seen["attorney"] and set(seen) == {*N.NODE_TABLES, "edge", "patent_fulltext"} and all(seen[n] == counts[n] for n in seen)
    keys = {r["org_key"] for r in graph_vertices(spark, cfg, "applicant").collect()}
    assert keys and all(k.startswith("K:") and k == k.upper() for k in keys)
    types = {r["rel_type"] for r in graph_edges(spark, cfg).collect()}
    assert "APPLIES_FOR" in types and "REPRESENTS" not in types
    few = Config(f"{tmp_path}/v", buckets=2, rules=[r for r in E.RULES if r.rel_type == "FROM_SOURCE"])
    run(spark, sample(spark), few)
    assert {r["rel_type"] for r in graph_edges(spark, few).collect()} == {"FROM_SOURCE"}


def test_namespaces_and_progress(tmp_path):
    import xml.etree.ElementTree as ET

    from gneiss.operators.parse import own_text, qualified

    root = ET.fromstring('<r xmlns:e="urn:e"><e:a> x <b/> y</e:a></r>')
    assert own_text(root, "e:a", {"e": "urn:e"}) == "x" == own_text(root, qualified("urn:e", "a")) and own_text(root, "a") == "" and qualified(None, "a") == "a"
    (tmp_path / "f").write_bytes(b"x" * 10)
    told = []
    assert http.download(f"file://{tmp_path}/f", tmp_path / "g", piece=3, every=4, progress=lambda *x: told.append(x)) == 10
    assert [n for n, _ in told] == [6, 9] and http.progress_text(1 << 29, 1 << 30) == "0.50 GiB of 1.00 GiB (50.0 %)" and http.progress_text(3 << 30) == "3.00 GiB"
