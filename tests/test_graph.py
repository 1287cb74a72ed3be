"""Vertices, resolved edges, merges, status and manifest."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gneiss.operators import fulltext as FT
from gneiss.operators import graph as G
from gneiss.operators import status as S
from gneiss.operators.edges import edges_in_row, edges_of_documents, first_by_source, valid_edges
from gneiss.operators.ingest import archive_refs, ingest_state
from gneiss.operators.parse import parse
from gneiss.schemas import FULLTEXT, TABLES, VERTICES, ddl

EDGE = ", ".join(f"{c} string" for c in TABLES["edge"])


def rows(df, *columns):
    return sorted(tuple(x) for x in df.select(*columns).collect())


def test_last_and_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, ""), ("a", 2, "y"), ("b", 1, None)], "k string, seq int, v string")
    assert rows(G.last_rows(df, "k", ["seq"]), "k", "seq", F.coalesce("v", F.lit("-"))) == [("a", 3, ""), ("b", 1, "-")]
    got = first_by_source(df.select(F.col("k").alias("source_id"), F.col("v").alias("pub_id"), "seq"), "pub_id", ["seq"])
    assert rows(got, "source_id", "pub_id") == [("a", "x")]


def test_path_order_is_by_parts(spark):
    df = spark.createDataFrame([("k", ["T.zip", "DOC/a.zip", "z"], 1), ("k", ["T.zip", "DOC/a.zip2"], 2)], "k string, member_path array<string>, n int")
    assert G.last_rows(df, "k", ["member_path"]).first()["n"] == 2


def test_valid_edges(spark):
    e = spark.createDataFrame([(" A ", "k", "1", "R", "B", "k", "2", ""), ("A", "k", " ", "R", "B", "k", "2", "s"), ("A", "k", None, "R", "B", "k", "2", "s")], EDGE)
    assert [tuple(x) for x in valid_edges(e).collect()] == [("A", "k", "1", "R", "B", "k", "2", "")]


def test_resolution(spark):
    v = spark.createDataFrame([("Publication", "pub_id", "p"), ("IpcClassification", "ipc_long_code", "c"), ("Application", "appln_id", "a"), ("Inventor", "person_key", "i"), ("Attorney", "person_key", "t")], "label string, key string, id string")
    e = spark.createDataFrame(
        [("Publication", "pub_id", "p", "HAS_IPC", "IPC", "long_code", "c", "s1"), ("Publication", "pub_id", "p", "HAS_IPC", "IPC", "long_code", "c", "s2"), ("Person", "person_key", "i", "INVENTED", "Application", "appln_id", "a", "s"), ("Person", "person_key", "i", "REPRESENTS", "Application", "appln_id", "a", "s"), ("Publication", "pub_id", "p", "OF_APPLICATION", "Application", "appln_id", "a", "s"), ("Publication", "pub_id", "q", "OF_APPLICATION", "Application", "appln_id", "a", "s")],
        EDGE,
    )
    assert rows(G.resolve(e, v), "rel_type", "from_label", "to_label") == [("HAS_IPC", "Publication", "IpcClassification"), ("INVENTED", "Inventor", "Application"), ("OF_APPLICATION", "Publication", "Application")]
    assert rows(G.resolve(e, v, aliases=False), "rel_type") == [("OF_APPLICATION",)]


def test_merge_rules(spark):
    fields = [f.name for f in FULLTEXT]

    def record(**x):
        return tuple(x.get(f) for f in fields)

    t = spark.createDataFrame([record(pub_id="p", lang="en", appln_id="A", abstract_text="old", source_id="1"), record(pub_id="q", lang="en", appln_id="Q", source_id="1")], FULLTEXT)
    s = spark.createDataFrame([record(pub_id="p", lang="en", appln_id="B", source_id="2"), record(pub_id="p", lang="de", appln_id="B", source_id="2")], FULLTEXT)
    assert rows(FT.upsert(t, s), "pub_id", "lang", "appln_id", F.coalesce("abstract_text", F.lit("-")), "source_id") == [("p", "de", "B", "-", "2"), ("p", "en", "A", "-", "2"), ("q", "en", "Q", "-", "1")]
    again = FT.upsert(FT.upsert(t, s), s)
    assert rows(again, *[F.coalesce(f, F.lit("-")) for f in fields]) == rows(FT.upsert(t, s), *[F.coalesce(f, F.lit("-")) for f in fields])


def test_collapse_keeps_first_application(spark):
    data = [("s1", "A1", "p", "en", "old", None, None, None, 0, ["a"]), ("s2", "A2", "p", "en", None, "d", None, None, 0, ["b"])]
    df = spark.createDataFrame(data, "source_id string, appln_id string, pub_id string, lang string, abstract_text string, description_text string, claims_text string, claims_json string, batch_id long, member_path array<string>")
    (x,) = FT.collapse_batch(df).collect()
    assert (x["appln_id"], x["source_id"], x["abstract_text"], x["description_text"]) == ("A1", "s2", None, "d")


def test_incremental_ids(spark):
    t = spark.createDataFrame([("a",), ("b",), ("",), ("a",)], "source_id string")
    done = spark.createDataFrame([("a",)], "source_id string")
    ids = G.new_source_ids({"x": t, "y": t}, done)
    assert rows(ids, "source_id") == [("b",)] and rows(G.only_sources({"x": t}, ids)["x"], "source_id") == [("b",)]
    assert rows(S.add_ids(done, t), "source_id") == [("",), ("b",)]


def test_constraints():
    found = G.constraints()
    assert len(found) == len(VERTICES) == 8
    assert all("IF NOT EXISTS" in c and "IS UNIQUE" in c for c in found) and any("(n:Publication)" in c and "n.pub_id" in c for c in found)
    assert ddl("t", FULLTEXT, ("pub_id", "lang"), ("source_id",))[0].count("NOT NULL") == 2


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(G.duplicate_keys(df, "k"), "k", "n") == [("a", 2)]


@pytest.mark.parametrize("n,size,sizes", [(11, 5, [5, 5, 1]), (10, 5, [5, 5]), (0, 5, [])])
def test_batches(spark, n, size, sizes):
    got = G.batch_ids(spark.range(n), ["id"], size).groupBy("batch").agg(F.count(F.lit(1)).alias("c")).orderBy("batch")
    assert [x["c"] for x in got.collect()] == sizes


def test_status(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    bad = S.failed_rows(spark.createDataFrame([("b", "e" * 5000), (" ", None)], "source_id string, error string"), F.lit(" ctx "))
    assert sorted((x["source_id"][:22], len(x["error"]), x["context"]) for x in bad.collect()) == [("__invalid_source_id__:", 0, "ctx"), ("b", 2000, "ctx")]
    log = S.done_rows(docs.where("source_id = 'a'")).unionByName(bad).withColumn("seq", F.lit(1))
    assert rows(S.pending(docs, S.latest_status(log, ["seq"])), "source_id") == [("b",), ("c",)]
    log = log.unionByName(S.done_rows(docs.where("source_id = 'b'")).withColumn("seq", F.lit(2)))
    now = S.latest_status(log, ["seq"])
    assert rows(S.pending(docs, now), "source_id") == [("c",)] and now.where("source_id = 'b'").first()["error"] is None
    assert S.invalid_source_ids(docs.union(spark.createDataFrame([(None,), (" ",)], "source_id string"))).count() == 2


def test_manifest(spark):
    raw = spark.createDataFrame([(" a.zip ", "downloaded", "10", 1), ("a.zip", "moved", None, 2), ("", "failed", "1", 3), ("b.zip", "odd", "2", 4)], "filename string, status string, raw_size string, row int")
    m = S.manifest_rows(raw, ["row"])
    assert rows(m, "filename", "status", "raw_size", "message") == [("a.zip", "moved", "", ""), ("b.zip", "odd", "2", "")]
    assert rows(S.unknown_states(m), "filename") == [("b.zip",)]
    news = m.where("filename = 'b.zip'").withColumns({"status": F.lit("moved"), "raw_size": F.lit("")})
    assert rows(S.set_manifest(m, news), "filename", "status", "raw_size") == [("a.zip", "moved", ""), ("b.zip", "moved", "")]


def test_archive_refs(spark):
    data = '{"deliveries":[{"id":1,"files":[{"id":"f","name":"a.zip","size":5},{"uuid":0,"filename":"","expected_size":"6"},{"id":"x"},7]},{"id":null,"uuid":"u","files":[]},{"files":[{"id":1,"name":"n"}]},"s",{"id":2,"files":"no"},{"delivery_id":"d","files":[{"file_id":2,"originalName":"b","size":"1.5"}]}]}'
    df = spark.createDataFrame([(data,), ('{"deliveries":{}}',), ("{}",), (None,), ("not json",)], "metadata string")
    assert [tuple(x) for x in archive_refs(df).collect()] == [("1", "f", "a.zip", 5), ("1", "0", "", 6), ("d", "2", "b", None)]


STATES = [
    (("a.rar", 1, 1, 1, 1, 1, 1, 1), "skipped"),
    (("a.zip", 1, 0, 0, 0, 0, 0, 0), "moved"),
    (("a.zip", 0, 1, 0, 0, 0, 0, 1), "moved"),
    (("a.zip", 0, 1, 0, 0, 0, 0, 0), "failed"),
    (("a.zip", 0, 0, 0, 0, 1, 1, 1), "failed"),
    (("a.tgz", 0, 0, 1, 0, 0, 1, 1), "failed"),
    (("a.tar", 0, 0, 0, 1, 1, 0, 1), "empty"),
    (("a.zip", 0, 0, 1, 0, 1, 1, 1), "moved"),
]


def test_ingest_states(spark):
    data = [(x[0], *map(bool, x[1:])) for x, _ in STATES]
    df = spark.createDataFrame(data, "f string, a boolean, b boolean, c boolean, d boolean, e boolean, g boolean, h boolean")
    got = df.select(ingest_state(*map(F.col, ("f", "a", "b", "c", "d", "e", "g", "h")))["status"].alias("s")).collect()
    assert [x["s"] for x in got] == [s for _, s in STATES]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3)), max_size=12), st.integers(0, 12))
def test_two_merges_equal_one(spark, items, cut):
    def table(part, start):
        df = spark.createDataFrame([(k, str(v), i + start) for i, (k, v) in enumerate(part)], "k string, v string, seq int")
        return G.last_rows(df, "k", ["seq"]).select("k", "v")

    none = spark.createDataFrame([], "k string, v string")
    whole = G.merge(none, table(items, 0), ["k"])
    halves = G.merge(G.merge(none, table(items[:cut], 0), ["k"]), table(items[cut:], cut), ["k"])
    assert rows(whole, "k", "v") == rows(halves, "k", "v")


def test_sure_edges(spark):
    """Edges of rows that come alone are sure; with those that are looked up they are what looking all up gives."""
    from tests.test_parse import FULL, head

    other = head("", 'country="EP" doc-number="9" kind="B1" id="EP9"')
    docs = [("a", FULL), ("a ", FULL), ("b", other), (" c", other), ("d", FULL.replace("Bonn", "Ulm")), ("e", "<a>"), ("b2", other), ("t", other), ("t", other), ("", other), (None, other)]
    parsed = parse(spark.createDataFrame([(i, x.encode()) for i, x in docs], "source_id string, xml binary")).where("error is null").localCheckpoint()
    made = edges_of_documents(parsed).localCheckpoint()
    whole = edges_in_row(parsed)
    assert sorted(map(tuple, made.drop("sure").collect())) == sorted(map(tuple, whole.collect()))
    assert {x["source_id"] for x in made.where("sure").collect()} == {"b", "d", "b2"}
    for aliases in (True, False):
        v = G.vertex_ids_in_row(parsed)
        got = G.resolve_sure(made.where("sure"), aliases=aliases).unionByName(G.resolve(made.where("not sure"), v, aliases=aliases)).distinct()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, G.resolve(whole, v, aliases=aliases).collect()))


def test_fresh_runs(spark):
    t = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b"), (1, ""), (2, "c"), (2, ""), (2, None), (3, "")], "run long, source_id string")
    e = t.withColumn("sure", F.col("source_id") == "c")
    done = spark.createDataFrame([("a",)], "source_id string")
    got = G.only_fresh({"t": t, "e": e}, G.sources_by_run({"t": t, "e": e}, done))
    want = G.only_sources({"t": t, "e": e}, G.new_source_ids({"t": t, "e": e}, done))
    for name in want:
        assert rows(got[name], "run", "source_id") == rows(want[name], "run", "source_id") == [(1, "b"), (2, "c")]
