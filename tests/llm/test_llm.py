"""Training-data operators against brute force, exact round trips and held-out accuracy, with odd rows of all kinds."""

import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gneiss.llm import common, html, mixing, neardup, ngram, packing, sharding, suffix, topk, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `__id` string"


def documents(spark, rows, clash=True):
    """rows of (doc_id, text, source); with extra columns whose names the operators use themselves."""
    data = [(i, t, "en", s, None if t is None else len(t), 0.5, "x") for i, t, s in rows]
    return spark.createDataFrame(data, DOCS)


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(words))


def odd(spark):
    long = prose(1, 30_000)
    return documents(spark, [(1, None, "a"), (2, "", "a"), (3, "  \n ", None), (4, long, "b"), (5, prose(2, 60), None), (5, prose(2, 60), None), (None, prose(3, 70), "b"), (7, prose(2, 60), "c"), (8, "word", "c")])


# ---- top-k


def brute_topk(rows, k=10):
    out = {}
    live = {i: np.floor(1024 * np.array(v, float)).astype(np.int64) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    for q in live:
        if q % 100 == 0:
            s = sorted(((-int(live[q] @ v), i) for i, v in live.items() if i != q and len(v) == len(live[q])))[:k]
            out[q] = [(r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return out


@pytest.mark.parametrize("cells", [1024, 3, 1])
def test_topk_brute_force(spark, cells):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(0, 0.2, 8).round(2).astype(np.float32).tolist()) for i in range(700)]
    rows[3] = (3, rows[100][1])  # ties
    rows += [(900, None), (901, []), (902, [float("nan")] * 8), (903, [1.0] * 7 + [None]), (904, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("id", F.lit("x"))
    got = defaultdict(list)
    for x in topk.top_k(df, shard_rows=100, most_cells=cells, sample_rows=300, query_block=3, leaf=8).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    assert dict(got) == brute_topk(rows)


def test_topk_small(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.5]), (None, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(x) for x in topk.top_k(df).collect()] == [(0, 1, 5, 1024 * 512)]
    assert topk.top_k(df.limit(0)).collect() == []


def test_topk_large_components(spark):
    """Every finite component takes part; scores are exact beyond what doubles hold; one that fits no long is an error."""
    rows = [(0, [2.9e6, 0.0]), (1, [2.9e6, 0.0]), (2, [2097151.0, 1.0]), (100, [2.5e6 + 1 / 1024, 3.0]), (3, [float(2**10) + 1 / 1024, 0.0]), (4, [-1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for x in topk.top_k(df.where("vec_id <> 4"), k=3).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    live = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i != 4}
    for q in (0, 100):
        want = sorted(((-sum(a * b for a, b in zip(live[q], live[i])), i) for i in live if i != q))[:3]
        assert got[q] == [(i, -s) for s, i in want]
    assert [x["vec_id"] for x in topk.top_k(df, k=1).where("query_id = 0").collect()] == [1]
    with pytest.raises(Exception, match="does not fit"):
        topk.top_k(df, k=5).collect()


def test_topk_skips_shards(spark, monkeypatch):
    """Queries go on only to cells whose boxes can reach their k-th score, and find the same rows."""
    r = np.random.default_rng(3)
    rows = [(i, [r.uniform(-4, 4), *r.normal(0, 0.02, 3).tolist()]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = []
    real = topk.written
    monkeypatch.setattr(topk, "written", lambda d, name: [x := real(d, name), name == "topk-asked" and sent.append(x.count())][0])
    got = defaultdict(list)
    for x in topk.top_k(df, shard_rows=100, leaf=16).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    assert dict(got) == brute_topk(rows)
    assert sent[0] == 16 and sent[1] < 16 * 4


def test_topk_of_equal_vectors(spark):
    """A table of one vector: no split parts it, its cell is parted by hash, ties go to the smaller key."""
    df = spark.range(500).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).alias("embedding"))
    got = topk.top_k(df, shard_rows=50, leaf=8).where("query_id = 100").orderBy("rank").collect()
    assert [x["vec_id"] for x in got] == list(range(10)) and {x["score"] for x in got} == {512 * 512 + 256 * 256}


def test_kdtree_bounds():
    r = np.random.default_rng(1)
    points = r.integers(-50, 50, (500, 5)).astype(float)
    tree, q = topk.KDTree(points, 16), r.integers(-50, 50, (4, 5)).astype(float)
    bounds = topk.most_product(q, tree.low, tree.high)
    for node, (begin, end) in enumerate(tree.span):
        own = tree.points[begin:end]
        assert (tree.low[node] == own.min(0)).all() and (tree.high[node] == own.max(0)).all()
        assert (bounds[:, node][:, None] >= q @ own.T).all()
        a, b = tree.child[node]
        assert a < 0 or (tree.span[a][0], tree.span[a][1], tree.span[b][1]) == (begin, tree.span[b][0], end) and abs(int(np.diff(tree.span[a])[0]) - int(np.diff(tree.span[b])[0])) <= 1
    assert sorted(tree.order) == list(range(500)) and (tree.points == points[tree.order]).all()


def test_cells_of_a_sample():
    r = np.random.default_rng(5)
    points = r.normal(0, 1, (4000, 3))
    cell = topk.cell_of(points, topk.cells_of(points, 16))
    assert sorted(np.bincount(cell)) == [250] * 16
    assert set(topk.cell_of(np.ones((5, 3)), topk.cells_of(np.ones((9, 3)), 16))) == {0}


# ---- near duplicates


def groups(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_near_duplicates_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.normal(0, 1, (40, 6))
    v = np.concatenate([base + r.normal(0, s, base.shape) for s in (0, 0.1, 0.2, 0.4)])
    v = np.concatenate([v, v[:5], 3 * v[5:8]])  # equal vectors, and ones of equal direction
    rows = [(i + 10, x.tolist()) for i, x in enumerate(v)]
    rows += [(1, None), (2, [0.0] * 6), (3, [float("nan")] * 6), (4, [None] * 6), (5, []), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("weight", F.lit(3)).withColumn("cell", F.lit("x"))
    got = {x["vec_id"]: x for x in neardup.near_duplicates(df, block_rows=16).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    close = u @ u.T >= 0.95
    links = [(i + 10, j + 10) for i in range(len(v)) for j in range(len(v)) if i != j and close[i, j]]
    n, label = Counter(a for a, _ in links), groups(got, links)
    assert len(got) == len(rows) - 1 and len(links) > 50
    for i, x in got.items():
        assert (x["n_links"], x["component_id"], x["kept"]) == (n[i], label[i], label[i] == i), i


def brute_links(v, least=0.95):
    u = v / np.abs(v).max(1)[:, None]
    u = u / np.linalg.norm(u, axis=1)[:, None]
    return [(int(i), int(j)) for i, j in zip(*np.nonzero(u @ u.T >= least)) if i != j]


def test_near_duplicates_of_clusters(spark):
    """Among clusters many pivots are taken, few vectors are copied and few pairs compared; links are those of all pairs."""
    r = np.random.default_rng(8)
    middle = r.normal(0, 1, (60, 24))
    v = middle[r.integers(0, 60, 1500)] + r.normal(0, 0.12, (1500, 24))
    report = []
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {x["vec_id"]: x for x in neardup.near_duplicates(df, report=report).collect()}
    links = brute_links(v)
    n, label = Counter(a for a, _ in links), groups(got, links)
    assert len(links) > 1000 and all((x["n_links"], x["component_id"]) == (n[i], label[i]) for i, x in got.items())
    (said,) = report
    assert said["pivots"] >= 4 and said["compared"] < 0.35 * said["all"]


def test_rings_lose_no_link():
    r = np.random.default_rng(9)
    v = np.concatenate([r.normal(0, 1, (700, 5)), r.normal(0, 0.1, (300, 5)) + 1])
    a, b, compared = neardup.links_between(v, v, 0.95, math.sqrt(0.1))
    assert sorted((int(x), int(y)) for x, y in zip(a, b) if x != y) == sorted(brute_links(v)) and compared < len(v) ** 2


def test_near_duplicates_of_extreme_components(spark):
    rows = [(1, [1e200, 0.0]), (2, [2e200, 1e180]), (3, [1e-200, 0.0]), (4, [5e-324, 0.0]), (5, [0.0, 1e308]), (6, [1.0, 1e-320]), (7, [0.0, -1e-300])]
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{i: (4, 1) for i in (1, 2, 3, 4, 6)}, 5: (0, 5), 7: (0, 7)}


def test_near_duplicates_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neardup.near_duplicates(df).collect() == []
    assert [tuple(x) for x in neardup.near_duplicates(spark.createDataFrame([(3, None)], "vec_id long, embedding array<float>")).collect()] == [(3, 0, 3, True)]


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 430)] + [(500, 500)]
    got = {x["id"]: x["component"] for x in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups({i for e in links for i in e}, links)
    touched = {i for a, b in links if a != b for i in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_intermediates_are_cleared(spark, tmp_path):
    import os

    there = common.written(spark.range(3), "there")
    with common.intermediates() as kept:
        gone, stays = common.written(spark.range(3), "gone"), common.written(spark.range(3), "stays")
        kept.append(stays)
        rows = ngram.jaccard_join(documents(spark, near_copies())).collect()
    assert len(rows) == len(near_copies()) and there.count() == stays.count() == 3
    at = lambda df: df._gneiss_path.removeprefix("file:")
    assert os.path.exists(at(there)) and os.path.exists(at(stays)) and not os.path.exists(at(gone))
    common.forget(there)
    common.forget(stays)


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            sc = staticmethod(lambda: Context)

        class getCheckpointDir:
            isEmpty = staticmethod(lambda: True)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError):
        common.shared_folder(Session)


# ---- n-gram join


def near_copies():
    rows = []
    for g in range(12):
        base = prose(100 + g, 80 + 20 * g).split()
        for k in range(5):
            w = list(base)
            for c in range(k):
                w[(c * 37 + 11) % len(w)] = f"changed{g}-{c}"
            rows.append((g * 10 + k, " ".join(w), "s"))
    return rows + [(500, rows[0][1], "s"), (501, rows[0][1].replace(" ", "\n "), "s"), (502, None, "s"), (503, "", "s"), (504, "two words", "s"), (505, "two  words", "s"), (506, "one two three four five", "s")]


def brute_jaccard(rows, least=0.8):
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, t, _ in rows if (w := (t or "").split())}
    ids = sorted(sets)
    return {i for i, *_ in rows}, [(i, j) for i in ids for j in ids if i != j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9]


@pytest.mark.parametrize("block", [512, 4])
def test_jaccard_join_brute_force(spark, block):
    rows = near_copies()
    ids, links = brute_jaccard(rows)
    n, label = Counter(a for a, _ in links), groups(ids, links)
    joined = ngram.jaccard_join(documents(spark, rows), block_rows=block)
    got = {x["doc_id"]: x for x in joined.collect()}
    assert set(got) == ids and len(links) > 40
    for i, x in got.items():
        assert (x["n_links"], x["component_id"], x["kept"]) == (n[i], label[i], label[i] == i), i
    kept = {x["doc_id"] for x in ngram.keep_one(documents(spark, rows), joined).collect()}
    assert kept == {i for i in ids if label[i] == i}


def test_jaccard_odd_rows(spark):
    got = ngram.jaccard_join(odd(spark)).collect()
    by = {x["doc_id"]: x for x in got}
    assert len(got) == 9 and by[7]["component_id"] == 5 and by[5]["n_links"] == 2 and not by[7]["kept"]
    assert by[1]["n_links"] == by[2]["n_links"] == by[3]["n_links"] == 0
    assert sorted(x["doc_id"] or 0 for x in ngram.keep_one(odd(spark), ngram.jaccard_join(odd(spark))).collect()) == [0, 1, 2, 3, 4, 5, 8]
    assert ngram.jaccard_join(odd(spark).limit(0)).collect() == []


def test_keep_one_of_shared_and_null_ids(spark):
    a, b, c, d = (prose(700 + k, 60) for k in range(4))
    near = " ".join([*a.split()[:-1], "changed"])
    rows = [(None, b, "s"), (None, b, "s"), (None, c, "s"), (None, None, "s"), (1, a, "s"), (2, near, "s"), (2, b, "s"), (5, c, "s"), (5, c, "s"), (5, d, "s"), (6, a + " x", "s"), (6, near, "s"), (7, prose(710, 60), "s"), (7, prose(711, 60), "s"), (8, "", "s"), (8, "", "s"), (9, prose(712, 60), "s"), (9, prose(712, 60) + " x", "s")]
    docs = documents(spark, rows)
    out = ngram.keep_one(docs, ngram.jaccard_join(docs))
    assert out.columns == docs.columns
    got = Counter((x["doc_id"], x["text"]) for x in out.collect())
    want = Counter({(None, b): 2, (None, c): 1, (None, None): 1, (1, a): 1, (2, b): 1, (5, c): 1, (5, d): 1, (7, rows[12][1]): 1, (7, rows[13][1]): 1, (8, ""): 1})
    nine = [t for i, t in got if i == 9]
    assert len(nine) == 1 and got[9, nine[0]] == 1
    assert Counter({k: n for k, n in got.items() if k[0] != 9}) == want


def forest_ties(spark, sets, least=0.8, recall=0.9999, node_rows=2048, trees=24):
    forest = ngram.Forest(trees, 8)
    rows = []
    for i, x in enumerate(sets):
        s = forest.signature(np.unique(x))
        hi, lo = forest.words(s)
        rows.append((i, hi.tolist(), lo.tolist(), forest.bytes_of(s)))
    ties, said = ngram.candidates(spark.createDataFrame(rows, "cid long, hi array<long>, lo array<long>, sig binary"), forest, least, recall, node_rows)
    return [(x["a"], x["b"]) for x in ties.collect()], said


def numbers(seed, n):
    return np.random.default_rng(seed).integers(0, 1 << 63, n).astype(np.uint64)


def test_forest_recall_and_depth(spark):
    """Near copies of several likenesses are tied; alike ones stop the shortening early, ones at the threshold do not."""

    def pairs(same, count, first):
        sets = []
        for k in range(count):
            a = numbers(first + k, 200)
            b = a.copy()
            new = round(200 * (1 - same) / (1 + same))
            b[:new] = numbers(first + k + 100_000, new)
            sets += [a, b]
        return sets

    alike, close = pairs(0.97, 60, 0), pairs(0.805, 300, 1000)
    ties, said = forest_ties(spark, alike)
    assert {frozenset(t) for t in ties} == {frozenset((2 * k, 2 * k + 1)) for k in range(60)} and [d for d, *_ in said] == [8]
    ties, said = forest_ties(spark, close)
    assert len({frozenset(t) for t in ties} & {frozenset((2 * k, 2 * k + 1)) for k in range(300)}) >= 299
    assert len(said) > 1 and said[0][2] < 0.9999 and [n for _, n, _ in said] == sorted(n for _, n, _ in said)


def test_forest_does_not_chain_weak_likeness(spark):
    """Each set shares three tenths with the next: many meet in some trie's node of a short prefix, none is tied."""
    sets = [np.concatenate([numbers(k, 100), numbers(k + 1, 100)[:86]]) for k in range(400)]
    ties, _ = forest_ties(spark, sets, least=0.8, trees=100)
    assert ties == []


@pytest.mark.parametrize("node_rows", [2048, 7])
def test_forest_large_node(spark, node_rows):
    """One large group of near copies: a spanning forest, whatever the blocks, never all pairs."""
    base = numbers(1, 300)
    sets = [np.concatenate([base, numbers(10 + k, 6)]) for k in range(120)]
    ties, _ = forest_ties(spark, sets, node_rows=node_rows)
    assert set(groups(range(120), ties).values()) == {0}
    assert len(ties) < 24 * (120 if node_rows > 120 else 120 + 18 * 18)


def test_ties_across_blocks():
    """Ties of blocks and between blocks connect what direct ties of all rows connect."""
    r = np.random.default_rng(14)
    for _ in range(40):
        base = r.integers(0, 3, (6, 20), dtype=np.uint8)
        sig = base[r.integers(0, 6, 40)]
        noise = r.random(sig.shape) < 0.15
        sig[noise] = r.integers(0, 3, noise.sum())
        block, links = r.integers(0, 3, 40), []
        for lo in range(3):
            at = np.flatnonzero(block == lo)
            for x, y, _ in zip(*ngram.tied(sig[at], 15)):
                links += zip(at[x], at[y])
            for hi in range(lo + 1, 3):
                both = np.flatnonzero((block == lo) | (block == hi))
                x, y, n = ngram.tied_across(sig[both], block[both] == hi, 15)
                assert ((sig[both[x]] == sig[both[y]]).sum(1) == n).all() and (block[both[x]] != block[both[y]]).all()
                links += zip(both[x], both[y])
        every = [(i, j) for i in range(40) for j in range(40) if i != j and (sig[i] == sig[j]).sum() >= 15]
        assert groups(range(40), links) == groups(range(40), every)


def test_shortest_prefix():
    d = ngram.shortest_prefix(0.8, 24, 8, 0.9999)
    assert ngram.collision(0.8, 24, d) >= 0.9999 > ngram.collision(0.8, 24, d + 1)


# ---- suffixes


def brute_passages(rows, least=50):
    seen, found = set(), defaultdict(set)
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        w = (t or "").split()
        for k in range(len(w) - least + 1):
            run = tuple(w[k : k + least])
            if run in seen:
                found[i].update(range(k, k + least))
            seen.add(run)
    return found


def passages():
    shared = [prose(900 + k, 55 + 9 * k) for k in range(4)]
    rows = [(i, f"{prose(i, 40 + i)} {shared[i % 4]} {prose(1000 + i, 30)}", "s") for i in range(40)]
    rows += [(50, rows[3][1], "s"), (51, "a b c " * 60, "s"), (52, None, "s"), (53, " ".join(shared[0].split()[:49]), "s"), (54, " ".join(shared[0].split()[:50]), "s")]
    return rows


def test_repeated_passages_brute_force(spark):
    rows = passages()
    got = defaultdict(set)
    for x in suffix.repeated_passages(documents(spark, rows)).collect():
        span = range(x["span_start"], x["span_start"] + x["span_words"])
        assert not got[x["doc_id"]] & set(span)
        got[x["doc_id"]].update(span)
    assert dict(got) == dict(brute_passages(rows))


def test_cut_passages(spark):
    rows = passages()
    docs = documents(spark, rows)
    out = suffix.without_passages(docs, suffix.repeated_passages(docs))
    assert out.columns == docs.columns
    left = {x["doc_id"]: x for x in out.collect()}
    found = brute_passages(rows)
    for i, t, _ in rows:
        w = (t or "").split()
        rest = [x for k, x in enumerate(w) if k not in found.get(i, ())]
        if i not in found:
            assert left[i]["text"] == t
        elif rest:
            assert left[i]["text"].split() == rest and left[i]["n_chars"] == len(left[i]["text"])
        else:
            assert i not in left


def test_suffix_odd_rows(spark):
    got = [tuple(x) for x in suffix.repeated_passages(odd(spark)).where("doc_id <> 4").collect()]
    assert got == [(7, 0, 60)]
    assert suffix.repeated_passages(odd(spark).limit(0)).collect() == []


def test_retained_suffixes_of_equal_runs():
    r = np.random.default_rng(4)
    a, b = r.integers(0, 50, 300).astype(np.uint64), r.integers(0, 50, 300).astype(np.uint64)
    b[100:160] = a[20:80]
    of = {}
    for name, w in (("a", a), ("b", b)):
        place, first, last, key = suffix.retained(w, 50, 16)
        assert first[0] == 0 and last[-1] == 250 and (first[1:] == last[:-1] + 1).all()
        of[name] = {s: (p - s, k) for p, f, e, k in zip(place, first, last, key) for s in range(f, e + 1)}
        assert all(0 <= p <= 34 for p, _ in of[name].values())
    assert all(of["a"][s] == of["b"][s + 80] for s in range(20, 80 - 50 + 1))
    assert len(suffix.retained(a[:49], 50, 16)[0]) == 0


def suffix_rows(texts, vocabulary, chunk, most, cuts):
    """Passages found by `_compare` and the second sort alone, over partitions cut at `cuts`, as sets of words."""
    import pyarrow as pa

    rows = []
    for doc, w in enumerate(texts):
        words = " ".join(f"x{i}" for i in w).encode()
        batch = pa.record_batch([pa.array([doc], pa.int64()), pa.array([words.decode()]), pa.array([list(range(len(w)))])], names=["doc_id", "text", "nth"])
        for b in suffix._suffixes(iter([batch]), 50, 16):
            rows += zip(*(c.to_pylist() for c in b.columns))
    rows.sort()
    names = ["gram_key", "behind", "before", "doc_id", "start", "runs"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
    found, opened = defaultdict(set), defaultdict(list)
    edges = [0, *sorted(c % (len(rows) + 1) for c in cuts), len(rows)]
    for lo, hi in zip(edges, edges[1:]):
        part = [pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 7]), kinds)], names=names) for i in range(lo, hi, 7) if rows[i : min(i + 7, hi)]]
        part = [b.slice(0, min(7, hi - lo - 7 * n)) for n, b in enumerate(part)]
        for b in suffix._compare(iter(part), 34, chunk, most):
            left = b.filter(pa.compute.equal(b.column(0), suffix.OPEN))
            for o in suffix._opened(iter([pa.record_batch(left.columns[1:], names=names)]), 34):
                for h1, h2, doc, start in zip(*(c.to_pylist() for c in o.columns)):
                    opened[h1, h2].append((doc, start))
            for kind, *_, doc, start, runs in zip(*(c.to_pylist() for c in b.columns)):
                if kind == suffix.AGAIN:
                    found[doc].update(range(start, start + runs + 49))
    for own in opened.values():
        for doc, start in sorted(own)[1:]:
            found[doc].update(range(start, start + 50))
    return dict(found)


@pytest.mark.parametrize("seed", range(12))
def test_sorted_suffixes_brute_force(seed):
    """Texts pieced together from shared passages of all lengths, few words in all, cut anywhere into partitions."""
    r = random.Random(seed)
    vocabulary = r.choice((2, 5, 1000))
    shared = [[r.randrange(vocabulary) for _ in range(r.randrange(10, 140))] for _ in range(5)]
    texts = []
    for _ in range(14):
        w = []
        while len(w) < 150:
            w += r.choice(shared)[r.randrange(8) :] if r.random() < 0.6 else [r.randrange(vocabulary) for _ in range(r.randrange(1, 40))]
        texts.append(w)
    want = brute_passages([(i, " ".join(f"x{k}" for k in w), "s") for i, w in enumerate(texts)])
    for chunk, most, cuts in ((10**6, 10**6, ()), (20, 10**6, (r.randrange(1000),)), (5, 9, tuple(r.randrange(1000) for _ in range(6)))):
        assert suffix_rows(texts, vocabulary, chunk, most, cuts) == dict(want)


def test_large_group_of_suffixes_is_not_held_whole():
    """Memory for one group of equal first words and 35 runs a suffix stays the same from 20,000 to 60,000 suffixes."""
    import tracemalloc

    import pyarrow as pa

    names = ["gram_key", "behind", "before", "doc_id", "start", "runs"]

    def batches(n):
        for i in range(0, n + 1000, 500):  # the group between two others, which stay open as a partition's first and last
            key, words = (0 if i == 0 else 1 if i <= n else 2), np.arange(i * 34, (i + 500) * 34, dtype=">u4").reshape(500, 34)
            columns = [np.full(500, key), [b"w" * 136] * 500, [w.tobytes() for w in words], np.arange(i, i + 500), np.zeros(500), np.full(500, 35)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()))], names=names)

    peaks, opened = [], []
    for n in (20_000, 60_000):
        tracemalloc.start()
        kinds = Counter(k for b in suffix._compare(batches(n), 34) for k in b.column(0).to_pylist())
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        opened.append(kinds[suffix.OPEN])
    assert peaks[1] < 1.2 * peaks[0]
    assert opened == [21_000, 61_000]  # no suffix is lost: all go on to the second sort


# ---- packing


def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return P, t


HARD = ["", " ", "a", "Hello  world\n\n x\t y ", "don't we'll 12345 --- !!", "naïve Ünïcode 漢字かな 😀 x", "a b c ​", "trailing ", " lead", "x\n y", "tab\t z", "é" * 50, "<|endoftext|> here", "\x1c \x85 ok"]


def test_encoder_equals_tokenizer():
    P, t = tokenizer()
    e = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    r = random.Random(5)
    more = ["".join(r.choice("ab é.,'\n\t1世 -") for _ in range(60)) for _ in range(200)]
    for text in HARD + more:
        assert np.frombuffer(e(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_pack_round_trip(spark):
    _, t = tokenizer()
    rows = [(i, prose(i, 1 + 37 * i % 3000), "s") for i in range(60)] + [(100, None, "s"), (101, "", "s"), (102, prose(9, 5000), "s")]
    docs = documents(spark, rows).repartition(3)
    ids = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for i, x, _ in rows}
    pieces = packing.pack(docs).toPandas()
    assert set(pieces["doc_id"]) == set(ids)
    for i, g in pieces.groupby("doc_id"):
        at = 0
        for p in g.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids[i]) and zlib.crc32(ids[i][at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids[i])
    for _, g in pieces.groupby("sequence_id"):
        g = g.sort_values("offset")
        total = int(g["length"].sum())
        assert g["offset"].tolist() == [0, *g["length"].cumsum()[:-1]] and total <= 2048 and (total == 2048 or total & (total - 1) == 0)
        assert set(g["sequence_tokens"]) == {total}


def test_pack_added_tokens(spark):
    P, _ = tokenizer()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "end<|endoftext|>", "plain <|endoftext text", "a  b <|endoftext|>\n é"]
    assert 50256 in t.encode(texts[0], add_special_tokens=False).ids
    got = packing.pack(documents(spark, [(i, x, "s") for i, x in enumerate(texts)]).coalesce(1), window=64).toPandas()
    for i, x in enumerate(texts):
        ids = t.encode(x, add_special_tokens=False).ids + [1]
        own = got[got["doc_id"] == i].sort_values("start")
        assert set(own["doc_tokens"]) == {len(ids)}
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_pack_odd_rows(spark):
    got = packing.pack(odd(spark)).toPandas()
    assert got["length"].sum() == got.drop_duplicates(["doc_id", "doc_tokens"])["doc_tokens"].sum() + got[got["doc_id"] == 5]["doc_tokens"].iloc[0]
    assert packing.pack(odd(spark).limit(0)).collect() == []


def test_levels_choose_least_squares():
    r = random.Random(6)
    levels = packing.Levels(32)
    counts = [0] * 33
    for _ in range(500):
        size = r.randrange(1, 33)
        before = sum(c * c for c in counts[1:32])
        options = []
        for h in [0] + [h for h in range(1, 33 - size) if counts[h]]:
            c = list(counts)
            c[h] -= h > 0
            c[h + size] += 1
            options.append((sum(x * x for x in c[1:32]), -h))
        _, h = levels.place(size)
        assert (min(options)) == (min(o for o in options if o[1] == -h)), before
        counts[h] -= h > 0
        counts[h + size] += 1
        counts[32] = 0


# ---- WARC


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a/x", "<title>T &amp; u</title><p>Hi <b>there</b><p>more<a href='/y'>y</a>"), (2, None, None), (3, "http://b\r\n/", ""), (1, "http://a/x", "<title>T &amp; u</title><p>Hi <b>there</b><p>more<a href='/y'>y</a>")], "page_id long, url string, html string")
    responses = warc.responses_of(pages)
    source = {}
    for x in responses.collect():
        (headers, block), = warc.read_records(bytes(x["content"]))
        source[x["key"]] = headers, block
    rows = warc.derive(responses).collect()
    assert len(rows) == 8
    for x in rows:
        headers, block = source[x["key"]]
        (own, content), = warc.read_records(bytes(x["record"]))
        assert own["WARC-Refers-To"] == headers["WARC-Record-ID"] == x["refers_to"]
        assert own["WARC-Block-Digest"] == warc.digest(content) == x["block_digest"] and int(own["Content-Length"]) == len(content)
        assert x["source_payload_digest"] == warc.digest(warc.split_http(block)[2])
        assert own["WARC-Date"] == headers["WARC-Date"] and own.get("WARC-Target-URI") == headers.get("WARC-Target-URI")
        if x["key"] == 1 and x["record_type"] == "conversion":
            assert content.decode() == "Hi there\nmorey" or content.decode() == "T & u\nHi there\nmorey"
        if x["key"] == 1 and x["record_type"] == "metadata":
            facts = json.loads(content)["Envelope"]
            assert facts["WARC-Header-Metadata"] == headers
            page = facts["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert page["HTML-Metadata"]["Head"]["Title"] == "T & u" and page["HTML-Metadata"]["Links"] == [{"path": "A@/href", "url": "/y"}]
            assert ["Content-Type", "text/html; charset=utf-8"] in page["Headers"]


def test_warc_gzip_and_foreign(spark):
    import gzip

    a = warc.make_record({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>"}, b"HTTP/1.0 200 OK\r\nContent-Type: text/plain\r\n\r\nplain\ntext")
    b = warc.make_record({"WARC-Type": "request", "WARC-Record-ID": "<urn:y>"}, b"GET /")
    rows = [(1, gzip.compress(a) + gzip.compress(b)), (2, b"nothing"), (3, None), (4, b""), (5, (a + a)[:-30])]
    got = warc.derive(spark.createDataFrame(rows, "key long, content binary")).collect()
    assert Counter((x["key"], x["record_type"]) for x in got) == {(1, "metadata"): 1, (1, "conversion"): 1, (5, "metadata"): 1, (5, "conversion"): 1}
    assert all(bytes(x["record"]).endswith(b"plain\ntext\r\n\r\n") for x in got if x["record_type"] == "conversion")


def test_warc_query_returns_records(spark, tmp_path):
    from gneiss.llm import queries

    page = "<title>T &amp; u</title><p>Hi <b>there</b><p>more<a href='/y'>y</a>"
    spark.createDataFrame([(1, "http://a/x", page), (2, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = queries.op4_warc(spark, str(tmp_path)).collect()
    assert Counter((x["page_id"], x["record_type"]) for x in rows) == {(i, t): 1 for i in (1, 2) for t in ("metadata", "conversion")}
    for x in rows:
        (own, content), = warc.read_records(bytes(x["record"]))
        assert own["WARC-Record-ID"] == x["record_id"] and warc.digest(content) == x["block_digest"] and len(content) == x["content_length"]
        if x["page_id"] == 1 and x["record_type"] == "conversion":
            assert content.decode().endswith("Hi there\nmorey")
        if x["page_id"] == 1 and x["record_type"] == "metadata":
            assert "T & u" in content.decode() and '"url": "/y"' in content.decode()


HTTP = b"HTTP/1.1 200 OK\r\n"


def test_warc_codings_and_broken_files(spark):
    """Bytes written by hand: lower-case names, chunks, compressed payloads, strange charsets and sizes, broken gzip."""
    import gzip

    def record(http, payload, size=None, name=b"WARC-Type"):
        block = HTTP + http + b"\r\n\r\n" + payload
        return b"WARC/1.0\r\n" + name + b": response\r\nwarc-record-id: <urn:x>\r\ncontent-length: " + (size or str(len(block)).encode()) + b"\r\n\r\n" + block + b"\r\n\r\n"

    kind = b"Content-Type: text/plain"
    chunks = b"5\r\nab cd\r\n3;x=y\r\n ef\r\n0\r\n\r\n"
    files = {
        1: (record(kind, b"plain", name=b"warc-type"), "plain"),
        2: (record(kind + b"\r\ntransfer-encoding: chunked", chunks), "ab cd ef"),
        3: (record(kind + b"\r\nContent-Encoding: gzip", gzip.compress(b"packed")), "packed"),
        4: (record(kind + b"\r\nContent-Encoding: deflate", zlib.compress(b"deflated")), "deflated"),
        5: (record(kind + b"\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked", b"%x\r\n%s\r\n0\r\n\r\n" % (len(z := gzip.compress(b"both")), z)), "both"),
        6: (record(kind + b"; charset=undefined", b"odd"), "odd"),
        7: (record(kind + b"; charset=base64", b"odd"), "odd"),
        8: (record(kind + b"; charset=latin-1", b"\xe9"), "é"),
        9: (record(kind + b"\r\nTransfer-Encoding: chunked", b"add more\r\nnot chunked"), "add more\r\nnot chunked"),
        10: (record(kind, b"x", size="²".encode()), None),
        11: (record(kind, b"x", size=b"-5"), None),
        12: (b"\x1f\x8b\x08 not gzip at all", None),
        13: (gzip.compress(record(kind, b"whole")) + gzip.compress(record(kind, b"cut"))[:-12], "whole"),
        14: (gzip.compress(record(kind, b"whole")) + b"foreign", "whole"),
        15: (gzip.compress(b"a" * 100)[:15], None),
        16: (record(kind, b"long " * 400_000), "long " * 400_000),
    }
    rows = [(k, bytes(c)) for k, (c, _) in files.items()]
    table = spark.createDataFrame(rows, "key long, content binary").withColumn("record", F.lit(1)).withColumn("headers", F.lit("x"))
    got = defaultdict(list)
    for x in warc.derive(table).where("record_type = 'conversion'").collect():
        got[x["key"]].append(bytes(x["record"]).split(b"\r\n\r\n", 1)[1][:-4].decode())
    assert {k: v[0] for k, v in got.items()} == {k: t for k, (_, t) in files.items() if t is not None}
    assert all(len(v) == 1 for v in got.values())
    assert warc.derive(table.limit(0)).collect() == []


def visible(page):
    """Words of a page by another parser: its text outside of scripts, styles, templates and the head."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.hidden = [], 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "template", "head")
            if tag in html.BLOCK or tag == "br":
                self.out.append(" ")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style", "template", "head")
            if tag in html.BLOCK:
                self.out.append(" ")

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    return "".join(reader.out).split()


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no test data")
def test_warc_of_all_pages(spark):
    """Every page's records, taken apart by the library for mail headers, say what other libraries find in the page."""
    import base64
    import hashlib
    from email.parser import BytesParser

    from gneiss.llm import queries

    pages = {x["page_id"]: x for x in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op4_warc(spark, SF).collect()
    assert Counter((x["page_id"], x["record_type"]) for x in rows) == {(i, t): 1 for i in pages for t in ("metadata", "conversion")}
    assert len({x["record_id"] for x in rows}) == len(rows)
    for x in rows:
        page, whole = pages[x["page_id"]], bytes(x["record"])
        version, _, rest = whole.partition(b"\r\n")
        head, _, block = rest.partition(b"\r\n\r\n")
        said = BytesParser().parsebytes(head + b"\r\n\r\n")
        payload = (page["html"] or "").encode()
        sha = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert version == b"WARC/1.0" and block.endswith(b"\r\n\r\n") and int(said["Content-Length"]) == len(block) - 4 == x["content_length"]
        assert (said["WARC-Type"], said["WARC-Record-ID"], said["WARC-Refers-To"]) == (x["record_type"], x["record_id"], x["refers_to"])
        assert said["WARC-Block-Digest"] == sha(block[:-4]) == x["block_digest"] and said["WARC-Refers-To-Payload-Digest"] == sha(payload) == x["source_payload_digest"]
        assert said["WARC-Target-URI"] == page["url"] == x["target_uri"]
        assert x["source_headers"] == f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
        if x["record_type"] == "conversion":
            assert block[:-4].decode().split() == visible(page["html"])
        else:
            facts = json.loads(block)["Envelope"]
            found = facts["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert found["Entity-Length"] == len(payload) and facts["WARC-Header-Metadata"]["WARC-Record-ID"] == x["refers_to"]
            import re

            assert [y["url"] for y in found["HTML-Metadata"]["Links"] if y["path"] == "A@/href"] == re.findall('<a href="([^"]*)"', page["html"])
            title = __import__("html").unescape(re.search("<title>(.*?)</title>", page["html"], re.S)[1]).split()
            assert found["HTML-Metadata"]["Head"]["Title"].split() == title


# ---- toxicity


def test_toxicity_held_out(spark):
    r = random.Random(7)
    bad = ["zorgblat", "frumpwick", "skrendle"]
    rows, labels = [], []
    for i in range(600):
        w = prose(2000 + i, r.randrange(20, 200)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(w) // 30):
                w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(toxic)))
    rows += [(10_000, prose(1, 40) + " zorgb1at frumpwwick " + prose(2, 10), "s"), (10_001, None, "s"), (10_002, "", "s"), (None, "fine words here", "s")]
    labels += [(10_000, None), (None, 1)]
    out = toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas()
    assert len(out) == len(rows) and out["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(int(i)).encode()) % 5 == 0) for i, h in zip(out["doc_id"], out["held_out"]) if i == i)
    test = out[out["held_out"]].merge(pd.DataFrame(labels[:600], columns=["doc_id", "toxic"]), on="doc_id")
    assert ((test["predicted"] == test["toxic"]).mean()) >= 0.97
    by = out.set_index("doc_id")["predicted"]
    assert by[10_000] == 1 and by[10_001] == 0 and by[10_002] == 0


def test_toxicity_trains_on_whole_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fitted", lambda texts, labels, shape: seen.append(Counter(zip(texts, labels, strict=True))))
    keys = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:20]
    rows = [(i, f"{prose(i, 25_000)} zorgblat{i}", "s") for i in keys]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(keys)], "doc_id long, toxic int")
    docs, whole = documents(spark, rows), Counter((t, k % 2) for k, (_, t, _) in enumerate(rows))
    assert all(len(t) > 100_000 for t, _ in whole)
    toxicity.fit(docs, labels)
    toxicity.fit(docs, labels, most_chars=9 * max(len(t) for t, _ in whole))
    assert seen[0] == whole
    assert not seen[1] - whole and (sum(y for _, y in seen[1]), len(seen[1])) in ((3, 9), (3, 10))


def test_toxicity_without_labels(spark):
    docs, none = odd(spark), spark.createDataFrame([], "doc_id long, toxic int")
    assert {x["predicted"] for x in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), none).collect() == []
    kept = toxicity.scored(docs, toxicity.train([], []))
    assert kept.columns.count("score") == 1
    clash = docs.withColumn("__text", F.lit("x")).withColumn("scored_text", F.lit("y"))
    assert toxicity.scored(clash, toxicity.train([], []), score="new").columns == [*clash.columns, "new"]


def test_scores_by_hand():
    """A text's score, computed bag by bag and n-gram by n-gram without the stream, is the model's."""
    r = random.Random(13)
    shape = toxicity.Shape(bits=10, window=8, step=4, filled=16)
    value = np.random.default_rng(3).normal(0, 1, 1 << shape.bits)
    model = toxicity.Model(value, -0.7, shape)
    words = ["a", "zorg", "zorg", "frump-wick", "don't", "naïve", "漢字", "b2b", "x" * 30, "wordy", "other", "thing"]

    def bucket(gram):
        h = 0
        for k, c in enumerate(gram):
            h = (ord(c) if c != "\0" else 0) if not k else (h * 0x100000001B3 + (ord(c) if c != "\0" else 0)) & (2**64 - 1)
        return int(common.mixed(np.array([(h + len(gram)) & (2**64 - 1)], np.uint64))[0]) >> 64 - shape.bits

    def grams(word):
        w = f"\0{word}\0"
        return [bucket(w[i : i + n]) for n in range(shape.least, shape.most + 1) for i in range(len(w) - n + 1)]

    def by_hand(text):
        own, last = [], {}
        for i, w in enumerate(text.split()):
            if w not in last or i - last[w] > shape.window:
                own.append(w)
            last[w] = i
        bags = -(-(len(own) - shape.window) // shape.step) + 1 if len(own) > shape.window else min(len(own), 1)
        best = [-0.7] if not bags else []
        for k in range(bags):
            start = max(0, min(k * shape.step, len(own) - shape.window))
            g = [x for w in own[start : start + shape.window] for x in grams(w)]
            best.append(sum(value[x] for x in g) / max(len(g), shape.filled) - 0.7)
        return 1 / (1 + math.exp(-max(best)))

    texts = ["", "zorg", *(" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(60))]
    assert model.score(texts) == pytest.approx([by_hand(t) for t in texts], abs=1e-9)


def test_toxicity_few_labels(spark):
    """A single text of a label neither fails nor moves the border."""
    one = toxicity.fitted(["zorgblat here", "fine words", "other words", "more of them", "and again"], [1, 0, 0, 0, 0])
    assert one.bias <= -1 and 0 < one.score(["fine words"])[0] < 0.5


# ---- mixing


def test_mixing(spark):
    rows = [(i, prose(i, 5 + i % 40), "big" if i % 2 else f"s{i % 6}") for i in range(3000)] + [(9000, None, None), (9001, "", None)]
    docs = documents(spark, rows)
    n = {i: len((t or "").split()) + 1 for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    tokens = Counter()
    for i in n:
        tokens[of[i]] += n[i]
    plan = {x["source"]: x for x in mixing.mixing_plan(docs, target_entropy=None, max_repeats=2.0).collect()}
    total = sum(tokens.values())
    x = 1 - math.log(2) / (math.log(max(tokens.values())) - math.log(min(tokens.values())))
    z = sum((t / total) ** x for t in tokens.values())
    for s, t in tokens.items():
        assert plan[s]["tokens"] == t and abs(plan[s]["weight"] - (t / total) ** x / z) < 1e-6
    assert min(p["budget"] / p["tokens"] for p in plan.values()) == pytest.approx(1, abs=1e-6) and max(p["budget"] / p["tokens"] for p in plan.values()) == pytest.approx(2, abs=1e-5)
    out = mixing.mix(docs, target_entropy=None, block_tokens=4000).toPandas()
    assert set(out["doc_id"]) == set(n) and (out["n_tokens"] == out["doc_id"].map(n)).all()
    assert not out.duplicated(["doc_id", "mix_pass"]).any()
    for s, p in plan.items():
        own = out[out["source"].isna()] if s is None else out[out["source"] == s]
        assert p["budget"] - max(n[i] for i in own["doc_id"]) - 1 <= own["n_tokens"].sum() <= p["budget"] + 1e-6 * p["tokens"] + 1
        if own["block"].max() > 1:
            full = own[own["block"] < own["block"].max()].groupby("block")["n_tokens"].sum()
            assert (abs(full - p["weight"] * 4000) <= 2 * max(n[i] for i in own["doc_id"])).all()
    copies = mixing.with_copies(docs, mixing.mixing_plan(docs, target_entropy=None))
    assert copies.drop("mix_pass").columns == docs.columns and copies.count() == len(out)


def test_mixing_entropy_and_budget(spark):
    docs = documents(spark, [(i, "a b c", "x" if i < 800 else "y" if i < 950 else "z") for i in range(1000)])
    plan = mixing.mixing_plan(docs, target_entropy=0.8, max_repeats=None).collect()
    assert -sum(p["weight"] * math.log(p["weight"]) for p in plan) / math.log(3) == pytest.approx(0.8, abs=1e-6)
    fixed = mixing.mix(docs, target_entropy=None, max_repeats=None, budget_tokens=2000)
    assert 2000 - 12 <= fixed.agg(F.sum("n_tokens")).first()[0] <= 2000
    assert mixing.mix(docs.limit(0)).collect() == []
    assert {x["doc_id"] for x in mixing.mix(odd(spark)).collect()} == {1, 2, 3, 4, 5, None, 7, 8}
    clash = odd(spark).withColumn("mix_pass", F.lit(1)).withColumn("salt", F.lit("x")).withColumn("key", F.lit(0)).withColumn("row", F.lit(0)).withColumn("k", F.lit(0))
    assert mixing.mix(clash).count() >= 9
    with pytest.raises(ValueError):
        mixing.with_copies(clash, mixing.mixing_plan(clash))
    assert mixing.with_copies(clash, mixing.mixing_plan(clash), mix_pass="nth").columns == [*clash.columns, "nth"]


def test_mix_order(spark, tmp_path):
    """The copies are those of the plan; written files hold the blocks in order, each with the target weights."""
    r = random.Random(12)
    rows = [(i, prose(i, 20 + r.randrange(20)), "big" if i < 3000 else "small" if i < 4000 else None) for i in range(4400)] + [(None, "x y", "big"), (7, None, "big")]
    docs = documents(spark, rows).withColumn("mix_block", F.lit("mine")).withColumn("mix_pass", F.lit(3))
    plan = mixing.mixing_plan(docs, target_entropy=None)
    ordered = mixing.in_mix_order(docs, plan, block_tokens=12_000)
    assert ordered.columns == docs.columns and {tuple(x) for x in ordered.select("mix_block", "mix_pass").distinct().collect()} == {("mine", 3)}
    copies = Counter((x["doc_id"], x["text"]) for x in mixing.with_copies(docs, plan, mix_pass="nth").collect())
    ordered.write.parquet(f"{tmp_path}/mix")
    files = sorted((tmp_path / "mix").glob("part-*"))
    got = [x for f in files for x in spark.read.parquet(str(f)).coalesce(1).collect()]
    assert Counter((x["doc_id"], x["text"]) for x in got) == copies
    weights = {x["source"]: x["weight"] for x in plan.collect()}
    total, at, share = 0, 0, defaultdict(lambda: defaultdict(int))
    for x in got:
        n = len((x["text"] or "").split()) + 1
        share[total // 24_000][x["source"]] += n
        total += n
    for own in list(share.values())[:-1]:
        assert all(abs(own[s] / sum(own.values()) - w) < 0.08 for s, w in weights.items())
    assert len(share) > 4


def test_mixing_of_rows_without_keys(spark):
    """Rows that are all alike, without a key, are laid out in many hash ranges and over all blocks."""
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    out = mixing.mix(docs, block_tokens=8000).toPandas()
    assert len(out) == 20_000 and sorted(out["block"].unique()) == list(range(10)) and (out.groupby("block").size() == 2000).all()
    assert mixing.ranges_of(20_000) > 2 and out["block_key"].nunique() > 19_000


# ---- HTML


def test_main_text():
    page = """<!doctype html><html><head><title>T</title><script>var x="<p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies, and more, and more, and more.</p></div>
    <div id="main"><div class="post"><h2>Head &amp; line</h2><p>First, with <a href=x>a link</a>,<br>and   more&nbsp;text; enough, surely, to count as one.<p>Second <b>bold</b>text, also long, and with commas, too.
    <ul><li>one<li>two</ul><form><p>Sign up, please, now</p></form><aside>side, bar</aside><table><tr><td>cell<td>next</table></div></div>
    <div class="sidebar"><p>Short, teaser</p></div><div id=comments><p>Great article, I think, really, truly, so long a comment.</p></div><footer>&copy; foot</footer></body></html>"""
    assert html.main_text(page) == "Head & line\nFirst, with a link, and more text; enough, surely, to count as one.\nSecond boldtext, also long, and with commas, too.\none\ntwo\ncell\nnext"


def test_main_text_of_an_article():
    body = "".join(f"<p>Paragraph {i}, with commas, and words enough to be taken for text.</p>" for i in range(30))
    page = f"""<body><div><a href=1>Home</a> <a href=2>News</a></div><ul><li><a href=3>One</a><li><a href=4>Two</a></ul><main><article><header><h1>Title</h1><p class=byline>By A</p></header>
    <div class=body>{body}<p>See <a href=x>this</a>.</p><ul><li><a href=5>Ref</a><li><a href=6>Other</a></ul></div><div class="share-buttons">share</div><section id="reader-comments"><p>Nice, really, very, very nice text.</p></section></article></main>
    <div role=complementary><p>side, side, side</p></div><div class=ad-slot>Buy, now, here</div></body>"""
    lines = html.main_text(page).split("\n")
    assert lines[:2] == ["Title", "By A"] and lines[-3:] == ["See this.", "Ref", "Other"] and len(lines) == 35


def test_main_text_without_an_article():
    page = """<body><div><a href=1>Home</a> <a href=2>News</a></div><div id=wrap><h1>Title</h1><div class=text><p>One, two, three, and so on for a while, so that it counts.</p><p>Four, five, six.</p></div><div class=comments><p>Nice, nice, nice</p></div></div>
    <div><ul><li><a href=3>One</a><li><a href=4>Two</a></ul></div></body>"""
    assert html.main_text(page) == "Title\nOne, two, three, and so on for a while, so that it counts.\nFour, five, six."


TEXT = "<p>One, two, three, and so on for a while, so that it counts.</p><p>Four, five, six, and more of it.</p>"
LINES = "One, two, three, and so on for a while, so that it counts.\nFour, five, six, and more of it."
LONG = "The law on this matter, as it stood, was changed many times, and not always for the better, as courts found."


@pytest.mark.parametrize(
    "page,text",
    [
        (f'<body><div class="layout has-sidebar"><article>{TEXT}</article><div class="sidebar"><p>Short, teaser</p></div></div></body>', LINES),
        (f'<body><div class="sidebar-layout"><div class="text">{TEXT}</div><div class="sidebar"><p>Short, teaser</p></div></div></body>', LINES),
        (f'<article><div class="article-header"><h1>Headline</h1></div>{TEXT}</article>', f"Headline\n{LINES}"),
        (f'<article>{TEXT}<section id="legal-history"><h2>Law</h2><p>{LONG}</p></section><div class="post-comments"><p>{LONG}</p></div></article>', f"{LINES}\nLaw\n{LONG}"),
        (f'<body><form id="aspnetForm"><div class=nav><a href=1>Home</a></div><div class="text">{TEXT}</div></form></body>', LINES),
        (f'<body><div class="widget"><article>{TEXT}</article></div></body>', LINES),
        (f"<body><article>{TEXT}</article><div id=comments><article><p>{LONG * 3}</p></article></div></body>", LINES),
        (f"<body><div id=wrap>Loose <b>text</b> here<div>{TEXT * 4}</div><ul><li>one<li>two</ul><div>{LONG}</div><table><tr><td>cell</table><ul><li><a href=1>a</a><li><a href=2>b</a></ul>End</div></body>", "Loose text here\n" + f"{LINES}\n" * 4 + f"one\ntwo\n{LONG}\ncell\nEnd"),
    ],
)
def test_main_text_names_and_siblings(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<nav>x</nav>", ""), ("plain &lt; text", "plain < text"), ("<p>a</p><p>b", "a\nb"), ("<article><p><b>x<br></article><footer>f</footer>", "x"), ("<div><p>one</p>tail</div>", "one\ntail"), ("<p>a <i>b<p>c</i> d", "a b\nc d"), ("<", "<"), ("<!-- a", ""), ("<script>x", ""), ("<p>&#65;&unknown;", "A&unknown;")])
def test_main_text_odd(page, text):
    assert html.main_text(page) == text


N = 40_000
HOSTILE = {
    "cdata": "<![CDATA[" * N, "quotes": "<a '" * N, "closed quotes": "<a '" * N + ">", "mixed quotes": "<a \"'>" * N, "other closers": "<div>" * N + "</p>" * N, "inline closers": "<b>" * N + "</i>" * N,
    "blocks in inline": "<b>" * N + "<div></div>" * N, "items": "<li><ul>" + "<dl><dd>" * N + "<li></li>" * N, "nested text": "<span>" * N + "text, " * N, "openers": "<" * 10 * N, "nested names": '<div class="sidebar">' * N + "x", "tables": "<table><tr><td>" * N,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_main_text_of_hostile_pages(name):
    """About a megabyte each; time that grows with the square of the length would take minutes."""
    import time

    began = time.process_time()
    text = html.main_text(HOSTILE[name])
    assert time.process_time() - began < 10
    if name == "nested text":
        assert text == ("text, " * N).strip()


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>long text, here</p>"), (1, "u", "<p>long text, here</p>"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((x["page_id"] or 0, x["text"], x["n_chars"]) for x in html.extract_main_text(pages).collect()) == [(0, "", 0), (1, "long text, here", 15), (1, "long text, here", 15)]
    assert html.extract_main_text(pages.limit(0)).collect() == []


# ---- sharding


def brute_shard(key, shards, weights, rack=4, region=2, seed=0):
    """The walk of one key through the tree."""
    import hashlib

    def least(level, children, weight):
        drawn = []
        for c in children:
            h = int(hashlib.md5(f"{'' if key is None else int(key)}:{level}:{c}:{seed}".encode()).hexdigest()[:13], 16)
            if weight(c) > 0:
                drawn.append((-math.log((h + 0.5) / 2**52) / weight(c), c))
        return min(drawn)[1]

    def of(lo, hi):
        return sum(weights[lo:hi])

    wide = rack * region
    a = least(0, range(-(-shards // wide)), lambda c: of(c * wide, (c + 1) * wide))
    b = least(1, range(a * region, (a + 1) * region), lambda c: of(c * rack, (c + 1) * rack))
    return least(2, range(b * rack, (b + 1) * rack), lambda c: of(c, c + 1))


def test_sharding(spark):
    rows = [(i, prose(i, 3), "s") for i in range(4000)] + [(5000, None, "s"), (5001, "", "s"), (5001, "", "s"), (None, "é", "s"), (5002, prose(1, 100_000), "s")]
    clash = documents(spark, rows).withColumn("key", F.lit("x")).withColumn("row", F.lit(1)).withColumn("shard", F.lit(1))
    out = sharding.assign_shards(clash, bucket_rows=30).toPandas()
    assert len(out) == len(rows)
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    text = {i: t or "" for i, t, _ in rows}
    for x in out.dropna(subset="doc_id").itertuples():
        assert x.size == len(text[x.doc_id].encode()) + 1 and x.text_crc32 == zlib.crc32(text[x.doc_id].encode())
    for x in out.itertuples():
        key = None if x.doc_id != x.doc_id else x.doc_id
        assert (x.shard, x.grown_shard) == (brute_shard(key, 16, [1.0] * 16), brute_shard(key, 17, [1.0] * 17))
        assert (x.rack, x.region) == (x.shard // 4, x.shard // 8)
    assert ((out["grown_shard"] == out["shard"]) | (out["grown_shard"] == 16)).all() and 150 < (out["grown_shard"] == 16).sum() < 330
    assert out["shard"].value_counts().between(180, 330).all()
    other = sharding.assign_shards(clash.repartition(5), bucket_rows=200).toPandas()
    assert sorted(map(str, other.to_numpy().tolist())) == sorted(map(str, out.to_numpy().tolist()))  # slots are those of the rows, not of their places
    again = sharding.assign_shards(documents(spark, rows[:2000]), bucket_rows=30).toPandas().set_index("doc_id")["shard"]
    assert (again == out[out["doc_id"] < 2000].set_index("doc_id")["shard"].reindex(again.index)).all()
    assert sharding.assign_shards(clash.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.assign_shards(clash, shards=15)


def walked(keys, shards, **kw):
    return {x["id"]: x["s"] for x in sharding.descend(keys, "id", ("g", "r", "s"), shards, **kw).collect()}


def test_growth_of_the_tree(spark):
    """A region of its own takes keys only into itself; elsewhere keys move only into or within the region that grew."""
    keys = spark.range(2000)
    was = None
    for n in range(1, 26):
        now = walked(keys, n)
        if was is not None:
            grown = (n - 1) // 8
            assert all(now[k] == was[k] or now[k] // 8 == grown for k in now)
            if (n - 1) % 8 == 0:
                assert all(now[k] in (was[k], n - 1) for k in now) and n - 1 in now.values()
        was = now


def test_weights_confine_movement(spark):
    keys = spark.range(4000)
    a = [1.0] * 16
    x, y = walked(keys, 16, weights=a), walked(keys, 16, weights=[*a[:5], 3.0, *a[6:]])
    moved = {k for k in x if x[k] != y[k]}
    assert moved and all(y[k] // 8 == 0 for k in moved) and all(x[k] // 8 or y[k] // 4 == 1 for k in moved)
    assert abs(sum(s == 5 for s in y.values()) / 4000 - 3 / 18) < 0.03
    assert {s for s in walked(keys, 16, weights=[0.0] * 15 + [2.0]).values()} == {15}
    with pytest.raises(ValueError):
        walked(keys, 2, weights=[0, 0])


def test_sharding_of_one_repeated_row(spark, monkeypatch):
    """Rows that are all alike are counted, then written out again in many pieces."""
    monkeypatch.setattr(sharding, "TOGETHER", 64)
    rows = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")).union(spark.range(20).select("id", F.lit("other")))
    out = sharding.assign_shards(rows, bucket_rows=2).toPandas()
    assert len(out) == 3020 and out[out["doc_id"] == 7]["shard"].nunique() == 1
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


# ---- queries and pipeline


def test_queries_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    rows = near_copies()[:30] + [(300 + i, t, f"src{i % 3}") for i, t, _ in passages()[:30]]
    labels = []
    for i in range(200):
        w = prose(5000 + i, 60).split()
        if i % 3 == 0:
            for _ in range(4):
                w[r.randrange(60)] = "zorgblat"
        rows.append((1000 + i, " ".join(w), f"src{i % 3}"))
        labels.append((1000 + i, 1, int(i % 3 == 0)))
    unique = [prose(9000 + k, 70) for k in range(4)]
    rows += [(None, unique[0], "s"), (None, unique[1], None), (None, None, None), (2000, unique[2], "src1"), (2000, unique[3], "src1"), (2001, None, "src1"), (2002, "", None), (2003, prose(9100, 40), "src1"), (2003, prose(9100, 40), "src1")]
    docs = documents(spark, rows).withColumn("mix_pass", F.lit(1)).withColumn("__toxicity", F.lit("mine"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        got = f(spark, stage, str(tmp_path))
        assert got.columns == docs.columns, name
        got.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        ids = {x[0] for x in after.select("doc_id").collect()}
        assert {x[0] for x in after.select("mix_pass").distinct().collect()} == {1} and {x[0] for x in after.select("__toxicity").distinct().collect()} == {"mine"}, name
        texts = Counter((x["doc_id"], x["text"]) for x in after.collect())
        assert all(texts[i, t] >= 1 for i, t, _ in rows if t in unique or i == 2003) and (texts[2003, rows[-1][1]] == (2 if name == "toxicity" else 1) or name == "mixing"), name
        if name == "toxicity":
            gone = {x[0] for x in docs.select("doc_id").collect()} - ids
            bad = {1000 + i for i in range(200) if i % 3 == 0}
            assert len(gone & bad) >= 0.95 * len(bad) and len(gone - bad) <= 3
        elif name == "ngram_jaccard":
            left = [(x["doc_id"], x["text"], "s") for x in after.where("doc_id is not null and doc_id < 2000").collect()]
            assert not brute_jaccard(left)[1]
        elif name == "suffix_dedup":
            held = [x for x in stage.collect() if x["doc_id"] is not None and x["doc_id"] != 2000]
            cut = brute_passages([(x["doc_id"], x["text"], "s") for x in held])
            words = sum(len((x["text"] or "").split()) for x in after.collect() if x["doc_id"] is not None and x["doc_id"] != 2000)
            assert words == sum(len((x["text"] or "").split()) for x in held) - sum(map(len, cut.values()))
        else:
            assert ids == {x[0] for x in stage.select("doc_id").collect()}
        stage = after
    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(pieces["doc_id"].dropna()) == {x[0] for x in stage.select("doc_id").collect()} - {None}
    for name, f in corpus_pipeline.STAGES:
        empty = f(spark, docs.limit(0), str(tmp_path))
        assert empty.collect() == [] and (name == "packing" or empty.columns == docs.columns), name
