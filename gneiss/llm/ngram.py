"""N-gram Jaccard join by a MinHash LSH forest, its matched prefixes shortened adaptively, with exact verification."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import U64, Rolling, components, forget, mixed, small_batches, trimmed, unused, word_hashes, written
from gneiss.llm.neardup import star_forest

#: White space beyond ASCII, as str.split() knows it.
WIDE_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; a shorter text is one shingle of all its words."""
    text = text or ""
    if not text.isascii():
        text = WIDE_SPACE.sub(" ", text)
    _, _, w = word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(w):
        return w
    n = min(words, len(w))
    start = np.arange(len(w) - n + 1)
    return np.unique(Rolling(w).ranges(start, start + n))


def collision(similarity: float, trees: int, depth: int) -> float:
    """Chance that two sets of this Jaccard similarity share a prefix of `depth` in at least one of the trees."""
    return 1 - (1 - similarity**depth) ** trees


def shortest_prefix(similarity: float, trees: int, longest: int, recall: float) -> int:
    """The longest prefix by which even pairs just at the threshold are met with the wanted recall: none shorter is needed."""
    depth = longest
    while depth > 1 and collision(similarity, trees, depth) < recall:
        depth -= 1
    return depth


#: A trie's digits: bits of one, digits in each of the two words that hold a row's prefix, bits left for the tree's number.
DIGIT, DIGITS, TREE = 14, 4, 7


class Forest:
    """MinHash signatures as `trees` tries of `longest` digits each."""

    def __init__(self, trees: int, longest: int, seed: int = 1):
        if not (1 <= trees < 1 << TREE and 1 <= longest <= 2 * DIGITS):
            raise ValueError(f"under {1 << TREE} trees, of at most {2 * DIGITS} digits")
        rng = np.random.default_rng(seed)
        self.trees, self.longest = trees, longest
        self.a = rng.integers(0, 1 << 32, trees * longest, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, trees * longest, dtype=np.uint32)

    def signature(self, sets: np.ndarray) -> np.ndarray:
        """The least value of every hash function over a set of shingles."""
        x = (sets >> U64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 512):
            np.minimum(low, (x[i : i + 512, None] * self.a + self.b).min(0), out=low)
        return low

    def words(self, signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree its row in sort order: tree and first DIGITS digits in one number, the other digits in a second."""
        # the least of many hashes is small, so that digits come from mixed bits
        digits = np.zeros((self.trees, 2 * DIGITS), np.int64)
        digits[:, : self.longest] = (mixed(signature.astype(U64)) >> U64(64 - DIGIT)).astype(np.int64).reshape(self.trees, self.longest)
        shifts = DIGIT * np.arange(DIGITS - 1, -1, -1)
        return (np.arange(self.trees) << DIGIT * DIGITS) + (digits[:, :DIGITS] << shifts).sum(1), (digits[:, DIGITS:] << shifts).sum(1)

    def bytes_of(self, signature: np.ndarray) -> bytes:
        """One byte of every value, by which two signatures are compared."""
        return (mixed(signature.astype(U64)) & U64(255)).astype(np.uint8).tobytes()


SIGNED = "doc_id long, text_hash long, n int, f1 long, f2 long, hi array<long>, lo array<long>, sig binary"


def _sign(batches: Iterator[pa.RecordBatch], forest: Forest, words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, f1, f2, hi, lo, sig, ends = [], [], [], [], [], [], [0]
        for text in b.column(1).to_pylist():
            s = shingles(text, words)
            n.append(len(s))
            f1.append(s.sum(dtype=U64).astype(np.int64))
            f2.append(np.bitwise_xor.reduce(mixed(s)).astype(np.int64) if len(s) else 0)
            sig.append(None)
            if len(s):
                signature = forest.signature(s)
                for to, row in zip((hi, lo), forest.words(signature), strict=True):
                    to.append(row)
                sig[-1] = forest.bytes_of(signature)
            ends.append(ends[-1] + forest.trees * bool(len(s)))
        off = pa.array(ends, pa.int32())
        hi, lo = (pa.ListArray.from_arrays(off, pa.array(np.concatenate(x) if x else np.empty(0, np.int64))) for x in (hi, lo))
        yield pa.record_batch([b.column(0), b.column(2), pa.array(n, pa.int32()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), hi, lo, pa.array(sig, pa.binary())], names=["doc_id", "text_hash", "n", "f1", "f2", "hi", "lo", "sig"])


def common_digits(hi: np.ndarray, lo: np.ndarray, least: int, longest: int) -> np.ndarray:
    """Of each two rows that follow one another, the length of their common prefix (0 below `least`)."""
    out = np.zeros(max(0, len(hi) - 1), np.int8)
    whole = hi[1:] == hi[:-1]
    for d in range(least, longest + 1):
        if d <= DIGITS:
            same = hi[1:] >> DIGIT * (DIGITS - d) == hi[:-1] >> DIGIT * (DIGITS - d)
        else:
            same = whole & (lo[1:] >> DIGIT * (2 * DIGITS - d) == lo[:-1] >> DIGIT * (2 * DIGITS - d))
        out[same] = d
    return out


def _neighbours(batches: Iterator[pa.RecordBatch], least: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows (hi, lo, cid) in order, each with the longest prefix it shares with a neighbour; those that share none go.

    A partition's first and last row, whose neighbours lie elsewhere, are taken to share all of it.
    """
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        hi, lo, cid = (b.column(i).to_numpy() for i in range(3))
        if held is not None:
            hi, lo, cid = (np.concatenate([[h], x]) for h, x in zip(held[:3], (hi, lo, cid), strict=True))
        shared = common_digits(hi, lo, least, longest)
        before = np.concatenate([[longest if held is None else held[3]], shared]).astype(np.int8)
        held = hi[-1], lo[-1], cid[-1], before[-1]
        best = np.maximum(before[:-1], shared)
        yield _trie_rows(hi[:-1], lo[:-1], cid[:-1], best, least)
    if held is not None:
        yield _trie_rows(*(np.array([x]) for x in held[:3]), np.array([longest]), least)


def _trie_rows(hi, lo, cid, shared, least: int) -> pa.RecordBatch:
    at = shared >= least
    return pa.record_batch([pa.array(hi[at], pa.int64()), pa.array(lo[at], pa.int64()), pa.array(cid[at], pa.int64()), pa.array(shared[at], pa.int32())], names=["hi", "lo", "cid", "shared"])


def node_of(depth: int) -> Column:
    """The trie node, as one number, that a row reaches after `depth` digits."""
    first = F.shiftright("hi", DIGIT * max(0, DIGITS - depth))
    return F.xxhash64(first, F.shiftright("lo", DIGIT * (2 * DIGITS - depth)) if depth > DIGITS else F.lit(0).cast("long"))


def blocks_of(size: Column, block_rows: int) -> Column:
    """Blocks of a group: of at most about `block_rows` rows, and of fewer where that would leave it less than eight blocks."""
    return F.greatest(F.ceil(size / block_rows), F.least(F.lit(8), F.ceil(size * 8 / block_rows))).cast("int")


def tied(sig: np.ndarray, least: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the rows whose signatures agree in at least `least` places: positions, positions they hang on, agreements.

    Each tree is grown from its first row; what it reached is never compared again.
    """
    rest, a, b, n = np.arange(len(sig)), [], [], []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            same = (sig[rest] == sig[x]).sum(1)
            hit = same >= least
            if hit.any():
                got = rest[hit]
                a.append(got)
                b.append(np.full(len(got), x))
                n.append(same[hit])
                front.extend(got)
                rest = rest[~hit]
    return a, b, n


def roots(n: int, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """For each of n rows the row that its tree of `tied` was grown from."""
    out = np.arange(n)
    for x, y in zip(a, b, strict=True):  # a parent is tied before its children
        out[x] = out[y]
    return out


def tied_across(sig: np.ndarray, second: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ties the trees of one block to those of another (second: which rows are of it): one tie for each two trees that meet.

    Trees within a block are made alike wherever the block is compared, and are given out by the block alone.
    """
    tree = np.empty(len(sig), np.int64)
    for own in (np.flatnonzero(~second), np.flatnonzero(second)):
        a, b, _ = tied(sig[own], least)
        tree[own] = own[roots(len(own), a, b)]
    a, b, n = (np.concatenate(x) if x else np.empty(0, np.int64) for x in tied(sig, least))
    at = np.flatnonzero(second[a] != second[b])
    _, first = np.unique(np.stack([np.minimum(tree[a], tree[b])[at], np.maximum(tree[a], tree[b])[at]], 1), axis=0, return_index=True)
    at = at[first]
    return a[at], b[at], n[at]


def _ties(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, low, high, cid, block, sig) sorted by the first four: ties within each block of a node and between each two, one pair held at a time."""
    out: list[list[np.ndarray]] = [[], [], []]

    def grown(key: list | None, ids: list[int], blocks: list[int], sigs: list[bytes]) -> None:
        if len(ids) < 2:
            return
        own, sig = np.array(ids), np.frombuffer(b"".join(sigs), np.uint8).reshape(len(ids), -1)
        if key[1] == key[2]:
            a, b, n = (np.concatenate(x) if x else np.empty(0, np.int64) for x in tied(sig, least))
        else:
            a, b, n = tied_across(sig, np.array(blocks) == key[2], least)
        for to, values in zip(out, (np.maximum(own[a], own[b]), np.minimum(own[a], own[b]), n), strict=True):
            to.append(values)

    def flushed() -> pa.RecordBatch:
        columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
        for x in out:
            x.clear()
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "same"])

    key, ids, blocks, sigs = None, [], [], []
    for batch in batches:
        for *now, cid, block, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != key:
                grown(key, ids, blocks, sigs)
                key, ids, blocks, sigs = now, [], [], []
            ids.append(cid)
            blocks.append(block)
            sigs.append(sig)
        if len(out[0]) > 1000:
            yield flushed()
    grown(key, ids, blocks, sigs)
    yield flushed()


def candidates(classes: DataFrame, forest: Forest, least: float, recall: float, block_rows: int) -> tuple[DataFrame, list[tuple[int, int, float]]]:
    """Ties (a, b) of classes (cid, hi, lo, sig), and what was measured: (prefix length, ties so far, estimated recall).

    The rows of all tries are sorted once over all machines and compared with their neighbours; rows that share too short
    a prefix with them are alone and go. Prefixes start at full length and are shortened by one digit at a time. Rows of a
    node are compared by their signatures, those that agree too little are not tied; a node that holds no more than one
    longer prefix was compared before, and nodes of the same rows in several tries are compared once. A tie of similarity s
    was to be met with probability p(s) at this length, so the ties found stand for sum(1 / p) that there are: shortening
    ends once that estimate of the recall is reached, at the latest at the length that reaches it for pairs just at the
    threshold. Large nodes are compared block by block and in pairs of blocks, of which come only ties between trees.
    """
    places = forest.trees * forest.longest
    floor = shortest_prefix(least, forest.trees, forest.longest, recall)
    # a pair at the threshold agrees this little once in 10**7 times or less
    bound = math.floor(places * least - 5.2 * math.sqrt(places * least * (1 - least)))
    spark = classes.sparkSession
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = classes.select("cid", F.explode(F.arrays_zip("hi", "lo")).alias("w")).select(F.col("w.hi").alias("hi"), F.col("w.lo").alias("lo"), "cid")
    rows = rows.repartitionByRange(parts, "hi", "lo", "cid").sortWithinPartitions("hi", "lo", "cid")
    trie = written(rows.mapInArrow(lambda it: trimmed(_neighbours(it, floor, forest.longest)), "hi long, lo long, cid long, shared int"), "ngram-trie")
    sigs = classes.select(F.col("cid").alias("s_cid"), "sig")
    ties, said = None, []
    for depth in range(forest.longest, floor - 1, -1):
        here = trie.where(F.col("shared") >= depth).select("cid", node_of(depth).alias("node"), F.when(F.col("shared") > depth, node_of(min(depth + 1, forest.longest))).alias("finer"))
        nodes = here.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("x"), F.min("finer").alias("f0"), F.max("finer").alias("f1"), F.count("finer").alias("f"))
        nodes = nodes.where((F.col("size") > 1) & ((F.col("f") < F.col("size")) | (F.col("f0") < F.col("f1"))))
        nodes = written(nodes.groupBy("size", "s", "x").agg(F.min("node").alias("at_node")).select("at_node", F.ceil(F.col("size") / block_rows).cast("int").alias("blocks")), "ngram-nodes")
        member = here.join(nodes, F.col("node") == F.col("at_node")).select("node", "cid", "blocks", F.pmod(F.xxhash64(F.lit(2), "cid"), F.col("blocks")).cast("int").alias("block"))
        member = member.select("node", "cid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        member = member.join(sigs, F.col("cid") == F.col("s_cid")).select("node", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cid", "block", "sig")
        member = member.repartition(parts, "node", "low", "high").sortWithinPartitions("node", "low", "high", "cid")
        found = member.mapInArrow(lambda it: trimmed(_ties(it, bound)), "a long, b long, same long").dropDuplicates(["a", "b"])
        found = written(found if ties is None else found.union(ties).dropDuplicates(["a", "b"]), "ngram-ties")
        for old in (nodes, ties):
            if old is not None:
                forget(old)
        ties = found
        met = F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(F.col("same") / places, F.lit(float(depth))), F.lit(float(forest.trees)))
        n, of = ties.where(F.col("same") >= least * places).agg(F.count(F.lit(1)), F.sum(1 / met)).first()
        said.append((depth, n, n / of if n else 0.0))
        if n and said[-1][2] >= recall:
            break
    forget(trie)
    return ties, said


def similar_pairs(sets: list[np.ndarray], first: list[int], second: list[int], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs (first x second, or each pair once if they are the same list) of Jaccard >= least, counted exactly."""
    same = first is second
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(size) - size
    right = np.array(second)
    n = size[right]
    at = np.repeat(start[right] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    theirs, begin = code[at], np.cumsum(n) - n
    mark = np.zeros(int(code.max()) + 1, np.int32)
    a, b = [], []
    for k, i in enumerate(first):
        lo = k + 1 if same else 0
        if lo >= len(right):
            break
        own = code[start[i] : start[i] + size[i]]
        mark[own] = 1
        common = np.add.reduceat(mark[theirs[begin[lo] :]], begin[lo:] - begin[lo])
        mark[own] = 0
        hit = np.flatnonzero(common >= least * (size[i] + n[lo:] - common) - 1e-9) + lo
        a.append(np.full(len(hit), i))
        b.append(right[hit])
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _verify_group(rows: list[tuple], words: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """rows: (block pair, id, block, weight, text) of one pair of blocks."""
    low, high = rows[0][1], rows[0][2]
    first = [i for i, r in enumerate(rows) if r[4] == low]
    second = first if low == high else [i for i, r in enumerate(rows) if r[4] == high]
    if not first or not second or first is second and len(first) < 2:
        return None
    sets = [shingles(r[6], words) for r in rows]
    a, b = similar_pairs(sets, first, second, least)
    if not len(a):
        return None
    ids, weight = np.array([r[3] for r in rows]), np.array([r[5] for r in rows])
    n = np.bincount(a, weights=weight[b], minlength=len(rows)) + np.bincount(b, weights=weight[a], minlength=len(rows))
    leaf, root = star_forest(a, b, ids)
    counted = np.flatnonzero(n)
    return np.concatenate([ids[counted], leaf]), np.concatenate([n[counted].astype(np.int64), np.zeros(len(leaf), np.int64)]), np.concatenate([ids[counted], root])


def _verify(batches: Iterator[pa.RecordBatch], words: int, least: float) -> Iterator[pa.RecordBatch]:
    """Rows (group, low, high, id, block, weight, text) sorted by the first three; one group is held at a time."""
    rows, key = [], None

    def flush():
        got = _verify_group(rows, words, least) if rows else None
        if got is not None:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in got], names=["id", "n", "root"])

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r[:3] != key:
                yield from flush()
                rows, key = [], r[:3]
            if not rows or rows[-1][3] != r[3]:  # rows that repeat a key and a text come one after another
                rows.append(r)
    yield from flush()


def jaccard_join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, least: float = 0.8, trees: int = 24, longest: int = 8, recall: float = 0.9999, block_rows: int = 512, node_rows: int = 2048) -> DataFrame:
    """Link documents whose sets of `words`-word shingles have Jaccard similarity >= least.

    One row per document: doc_id, class_id (smallest id with the same shingles), n_links (other documents linked
    directly), component_id (smallest id reachable by links), kept (doc_id = component_id); for `keep_one` also
    text_hash and group_id, a number of the component that holds where rows share an id.

    Documents of equal shingle sets are one class and are joined once. Each class is signed by `trees` MinHash tries of
    `longest` digits; `candidates` shortens their common prefixes until the recall is reached and ties classes whose
    signatures agree. Components of ties are compared exactly, all pairs, in pairs of blocks of about `block_rows`; what
    leaves a pair of blocks is one count per document and one star link per document, never the pairs. Only texts that are
    alike by their signatures are tied, so loose likenesses do not chain into large components.

    Words are parted by white space; a text of fewer words is one shingle; a very long text is read whole. Null, empty or
    blank texts and null keys link with nothing (component_id is the key itself). Rows that repeat a key and a text are
    copies of each other and count as links of each other. Other columns are ignored; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    forest = Forest(trees, longest)
    lean = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    signed = written(lean.mapInArrow(lambda it: trimmed(_sign(it, forest, words)), SIGNED), "ngram-signed")
    full = signed.where("n > 0 and doc_id is not null")
    classes = written(full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min_by(F.struct("hi", "lo", "sig", "text_hash"), "doc_id").alias("of")).select("f1", "f2", "n", "rep", "weight", "of.hi", "of.lo", "of.sig", "of.text_hash", F.col("f1").bitwiseXOR(F.col("f2")).alias("cid")), "ngram-classes")
    ties, _ = candidates(classes, forest, least, recall, node_rows)
    groups = written(components(ties, "a", "b", "ngram-cc").select(F.col("id"), F.col("component").alias("grp")), "ngram-groups")
    sizes = groups.groupBy("grp").agg(blocks_of(F.count(F.lit(1)), block_rows).alias("blocks"))
    weights = classes.select(F.col("cid").alias("w_id"), "weight", "rep", F.col("text_hash").alias("rep_hash"))
    member = groups.join(sizes, "grp").join(weights, F.col("id") == F.col("w_id")).select("id", "rep", "rep_hash", "grp", "blocks", "weight", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")).dropDuplicates(["id"])
    found = lean.join(member, (lean["doc_id"] == member["rep"]) & (lean["text_hash"] == member["rep_hash"]))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = found.select("grp", "id", "block", "weight", "text", other).select("grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "block", "weight", "text")
    parts = max(12, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    paired = paired.repartition(parts, "grp", "low", "high").sortWithinPartitions("grp", "low", "high", "id")
    links = written(paired.mapInArrow(lambda it: trimmed(_verify(it, words, least)), "id long, n long, root long"), "ngram-links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n")).select(F.col("id").alias("n_id"), "n")
    comps = components(links, "id", "root", "ngram-cc2").select(F.col("id").alias("c_id"), F.col("component").alias("group_id"))
    comps = written(comps.distinct().join(classes.select("cid", F.col("rep").alias("c_rep")), F.col("c_id") == F.col("cid")).select("c_id", "group_id", "c_rep"), "ngram-groups2")
    least_id = comps.groupBy("group_id").agg(F.min("c_rep").alias("component"))
    comps = comps.join(least_id, "group_id").select("c_id", "group_id", "component")
    of = classes.join(counts, F.col("cid") == F.col("n_id"), "left").join(comps, F.col("cid") == F.col("c_id"), "left")
    links_of = F.coalesce(counts["n"], F.lit(0)) + F.col("weight") - 1
    of = of.select(F.col("f1").alias("o1"), F.col("f2").alias("o2"), classes["n"].alias("o3"), "rep", links_of.alias("links"), F.coalesce("component", "rep").alias("component"), F.coalesce("group_id", "cid").alias("group_id"))
    slim = signed.select("doc_id", "text_hash", "n", "f1", "f2")
    out = slim.join(of, (F.col("f1") == F.col("o1")) & (F.col("f2") == F.col("o2")) & (F.col("n") == F.col("o3")) & F.col("doc_id").isNotNull(), "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"), "text_hash", F.coalesce("group_id", "text_hash").alias("group_id"))


def keep_one(docs: DataFrame, joined: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the documents that another of their group stands for.

    Rows are told apart by key and text, so a text stays that shares its key with one that goes. Of rows that repeat a key
    and belong to one group (or are blank and equal) one stays. Rows without a key all stay. An empty table stays empty;
    other columns, whatever their names, stay as they are. docs are shuffled once to meet the marks, and the marked ones
    once more if any row repeats a key and a text.
    """
    name, mark, gone = unused("marked_id", docs), unused("marked_text", docs), unused("gone", docs)
    each = joined.where("doc_id is not null").groupBy("doc_id", "group_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    each = each.withColumn("first", F.min("text_hash").over(Window.partitionBy("doc_id", "group_id")))
    each = each.withColumn(gone, ~F.col("kept") | (F.col("text_hash") != F.col("first"))).where(F.col(gone) | (F.col("rows") > 1))
    marks = written(each.select(F.col("doc_id").alias(name), F.col("text_hash").alias(mark), gone), "ngram-gone")
    named = (docs[key].cast("long") == F.col(name)) & (F.xxhash64(docs[text].cast("string")) == F.col(mark))
    left = docs.join(marks.drop(gone).hint("merge"), named, "left_anti")
    repeated = marks.where(~F.col(gone)).drop(gone)
    if repeated.isEmpty():
        return left
    again = docs.join(repeated, named, "left_semi")
    return left.union(again.withColumn(mark, F.xxhash64(F.col(text).cast("string"))).dropDuplicates([key, mark]).drop(mark))
