"""Suffix-array dedup over sparse suffixes: repeated passages across all documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import BASE, U64, Rolling, mixed, powers, small_batches, trimmed, unused, word_hashes, words_of, written
from gneiss.llm.ngram import WIDE_SPACE


def narrow(text: str | None) -> bytes:
    """UTF-8 of a text, wide spaces replaced by as many bytes of plain ones, so that offsets stay."""
    text = text or ""
    if not text.isascii() and WIDE_SPACE.search(text):
        text = WIDE_SPACE.sub(lambda m: " " * len(m[0].encode("utf-8")), text)
    return text.encode("utf-8", "surrogatepass")


def minimiser_of(grams: np.ndarray, span: int) -> np.ndarray:
    """For every run of `span` grams the position of its least hash (of equal ones, the last): content alone selects it."""
    turned = grams[::-1]  # so that argmin's first is the last
    best = np.lib.stride_tricks.sliding_window_view(turned, span).argmin(1) + np.arange(len(grams) - span + 1)
    return len(grams) - 1 - best[::-1]


def retained(w: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of a text (its words' hashes) that are kept: place, first and last start of the runs of `least` words
    whose minimiser the place is, hash of the suffix's first `gram` words. Every run belongs to one suffix."""
    runs = len(w) - least + 1
    if runs < 1:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(U64)
    start = np.arange(len(w) - gram + 1)
    grams = Rolling(w).ranges(start, start + gram)
    at = minimiser_of(grams, least - gram + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    return at[first], first, np.append(first[1:], runs) - 1, grams[at[first]]


def _anchors(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Per document its number of words and the hashes of the first words of its retained suffixes, in order."""
    for b in batches:
        n, keys, ends = [], [], [0]
        for text in b.column(1).to_pylist():
            _, _, w = word_hashes(narrow(text))
            n.append(len(w))
            keys.append(retained(w, least, gram)[3])
            ends.append(ends[-1] + len(keys[-1]))
        k = np.concatenate(keys).astype(np.int64) if keys else np.empty(0, np.int64)
        yield pa.record_batch([b.column(0), b.column(2), b.column(3), pa.array(n, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(k, pa.int64()))], names=["doc_id", "t1", "t2", "n_words", "keys"])


#: A suffix: hash of its first words; the words behind them and, nearest first, those before it, as far as its runs
#: reach, four bytes each; where its first run starts and how many there are.
SUFFIX = "gram_key long, behind binary, before binary, doc_id long, start int, runs int"


def _suffixes(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The wanted suffixes of the documents."""
    for b in batches:
        out: list[list] = [[], [], [], [], [], []]
        for doc, text, wanted in zip(*(c.to_pylist() for c in b.columns), strict=True):
            _, _, w = word_hashes(narrow(text))
            place, first, last, key = retained(w, least, gram)
            wanted = np.array(wanted, np.int64)
            wanted = wanted[wanted < len(place)]
            ahead = (w >> U64(32)).astype(">u4").tobytes()
            back = (w[::-1] >> U64(32)).astype(">u4").tobytes()
            n = len(w)
            for p, f, e in zip(place[wanted].tolist(), first[wanted].tolist(), last[wanted].tolist(), strict=True):
                out[1].append(ahead[4 * (p + gram) : 4 * (e + least)])
                out[2].append(back[4 * (n - p) : 4 * (n - f)])
            out[0].append(key[wanted].astype(np.int64))
            out[3].append(np.full(len(wanted), doc, np.int64))
            out[4].append(first[wanted])
            out[5].append((last - first + 1)[wanted])
        flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (out[0], out[3], out[4], out[5])]
        yield pa.record_batch([pa.array(flat[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.int32()), pa.array(flat[3], pa.int32())], names=["gram_key", "behind", "before", "doc_id", "start", "runs"])


class Suffixes:
    """Suffixes in sorted order, as arrays."""

    def __init__(self, key, behind, before, doc, start, runs, reach: int):
        self.key, self.doc, self.start, self.runs, self.reach = key, doc, start, runs, reach
        self.behind, self.n_behind = self.matrix(behind)
        self.before, self.n_before = self.matrix(before)
        self.raw = behind, before

    def matrix(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words as rows of `reach` numbers, and how many there are in each."""
        n = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) // 4
        out = np.zeros((len(column), self.reach), np.uint32)
        out[np.arange(self.reach) < n[:, None]] = np.frombuffer(b"".join(column.to_pylist()), ">u4")
        return out, n

    def taken(self, at: np.ndarray) -> Suffixes:
        out = Suffixes.__new__(Suffixes)
        for name in ("key", "doc", "start", "runs", "behind", "n_behind", "before", "n_before"):
            setattr(out, name, getattr(self, name)[at])
        out.reach, out.raw = self.reach, tuple(c.take(pa.array(at)) for c in self.raw)
        return out

    def common_behind(self) -> np.ndarray:
        """Length of the common prefix of each suffix and the one before it, in words behind the gram; -1 if that differs."""
        if not len(self.key):
            return np.empty(0, np.int64)
        most = np.minimum(self.n_behind[1:], self.n_behind[:-1])
        same = (self.behind[1:] == self.behind[:-1]) & (np.arange(self.reach) < most[:, None])
        n = np.where(same.all(1), self.reach, same.argmin(1)) if self.reach else most * 0
        return np.concatenate([[-1], np.where(self.key[1:] == self.key[:-1], n, -1)])

    def again(self) -> np.ndarray:
        """Whether a suffix is, with all words behind and before it, the one before it in sorted order."""
        out = np.zeros(len(self.key), bool)
        out[1:] = (self.key[1:] == self.key[:-1]) & (self.n_behind[1:] == self.n_behind[:-1]) & (self.n_before[1:] == self.n_before[:-1])
        out[1:] &= (self.behind[1:] == self.behind[:-1]).all(1) & (self.before[1:] == self.before[:-1]).all(1)
        return out

    def run_hashes(self, n_runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the first n_runs runs of each suffix: its position, the run's start, a hash of gram, words before and words behind."""
        row = np.repeat(np.arange(len(self.key)), n_runs)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
        left = self.n_before[row] - nth  # words of the run before the gram; the rest of its reach lies behind it

        def sums(words: np.ndarray) -> np.ndarray:
            out = np.zeros((len(words), self.reach + 1), U64)
            np.cumsum((words.astype(U64) + U64(1)) * powers(BASE, self.reach), axis=1, out=out[:, 1:])
            return out

        h = mixed(sums(self.behind)[row, self.reach - left] + mixed(self.key.astype(U64))[row])
        return row, self.start[row] + nth, mixed(sums(self.before)[row, left] ^ (h + left.astype(U64)))


#: Kinds of rows that leave the sorted suffixes.
AGAIN, OPEN = 0, 1
COMPARED = f"kind int, {SUFFIX}"


def compared(s: Suffixes, is_open: np.ndarray) -> tuple[list[np.ndarray], Suffixes]:
    """Repeated runs (doc, start, number of runs) of sorted suffixes, and those suffixes of open groups that are left to compare.

    A suffix equal to its neighbour in all its words is repeated as a whole. Of the different ones of a group, a run can
    be repeated only if its words behind the gram are within the longest prefix common with a neighbour; these matches are
    extended to the left, by whole runs, the earliest of which stays. Groups that may go on elsewhere (is_open) are only
    reduced to their different suffixes, and these to the runs their neighbours allow.
    """
    again = s.again()
    origin = np.maximum.accumulate(np.where(again, 0, np.arange(len(again)))) if len(again) else np.empty(0, np.int64)
    moved = again & ((s.doc != s.doc[origin]) | (s.start != s.start[origin]))
    found = [[s.doc[moved]], [s.start[moved]], [s.runs[moved]]]
    d, is_open = s.taken(np.flatnonzero(~again)), is_open[~again]
    lcp = d.common_behind()
    after = np.append(lcp[1:], -1) if len(lcp) else lcp
    best = np.maximum(lcp, after)
    best[is_open & ((lcp < 0) | (after < 0))] = d.reach  # its neighbour may lie elsewhere
    runs = np.clip(d.n_before - d.reach + best + 1, 0, d.runs) * (best >= 0)
    closed = d.taken(at := np.flatnonzero(~is_open & (runs > 0)))
    row, start, h = closed.run_hashes(runs[at])
    doc = closed.doc[row]
    order = np.lexsort((start, doc, h))
    h, doc, start = h[order], doc[order], start[order]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    origin = np.maximum.accumulate(np.where(same, 0, np.arange(len(h)))) if len(h) else np.empty(0, np.int64)
    same &= (doc != doc[origin]) | (start != start[origin])
    for to, x in zip(found, (doc[same], start[same], np.ones(int(same.sum()), np.int64)), strict=True):
        to.append(x)
    left = d.taken(at := np.flatnonzero(is_open & (runs > 0)))
    left.runs = runs[at]
    return [np.concatenate(x) for x in found], left


def _compare(batches: Iterator[pa.RecordBatch], reach: int, chunk: int = 8_000, most: int = 16_000) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes, group by group of equal first words; a partition's first and last group, and very large ones, stay open.

    A group that is compared here is held whole, each of its suffixes with up to `reach` + 1 runs; one of `most` rows goes
    on to the second sort in parts, which need no more memory the larger it is.
    """
    held: list[pa.RecordBatch] = []
    open_key = None

    def done(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal open_key
        table = table.combine_chunks()
        columns = [table.column(i).chunk(0) if table.num_rows else pa.array([], f.type) for i, f in enumerate(table.schema)]
        key, doc, start, runs = (columns[i].to_numpy().astype(np.int64) for i in (0, 3, 4, 5))
        if open_key is None:
            open_key = key[0]
        is_open = key == open_key
        if last:
            is_open |= key == key[-1]
        (a, b, c), left = compared(Suffixes(key, columns[1], columns[2], doc, start, runs, reach), is_open)
        n, m = len(a), len(left.key)
        none = pa.nulls(n, pa.binary())
        yield pa.record_batch(
            [pa.array(np.repeat([AGAIN, OPEN], [n, m]), pa.int32()), pa.array(np.concatenate([np.zeros(n, np.int64), left.key])), pa.concat_arrays([none, left.raw[0]]), pa.concat_arrays([none, left.raw[1]]), pa.array(np.concatenate([a, left.doc])), pa.array(np.concatenate([b, left.start]), pa.int32()), pa.array(np.concatenate([c, left.runs]), pa.int32())],
            names=["kind", "gram_key", "behind", "before", "doc_id", "start", "runs"],
        )

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < chunk:
            continue
        table = pa.Table.from_batches(held)
        key = table.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:  # whole groups go, the last one may go on
            yield from done(table.slice(0, cut), False)
            table = table.slice(cut)
        if table.num_rows >= most:  # one group: its part so far goes as an open one
            open_key = key[-1]
            yield from done(table, False)
            table = table.slice(table.num_rows)
        held = table.to_batches()
        rows = table.num_rows
    if rows:
        yield from done(pa.Table.from_batches(held), True)


def _opened(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """The runs of suffixes of open groups, one row each."""
    for b in batches:
        if b.num_rows:
            key, doc, start, runs = (b.column(i).to_numpy().astype(np.int64) for i in (0, 3, 4, 5))
            s = Suffixes(key, b.column(1), b.column(2), doc, start, runs, reach)
            row, at, h = s.run_hashes(runs)
            yield pa.record_batch([pa.array(h.astype(np.int64)), pa.array(key[row]), pa.array(doc[row]), pa.array(at, pa.int32())], names=["h1", "h2", "doc_id", "start"])


#: Kinds of rows that leave the comparison of single runs.
REPEATED, FIRST, LAST = 0, 1, 2


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row with the one before it in sorted order.

    Rows of equal runs stand together, the earliest first; the others are repeated, but for copies of that very row (a
    table's repeated rows). A partition's first row is left open, and its first and last rows are
    told apart, so that runs over a partition's border can be closed afterwards.
    """
    part, before, origin = TaskContext.get().partitionId(), None, None

    def batch(h1, h2, doc, start, kind, part):
        return pa.record_batch([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(kind, pa.int32()), pa.array(np.full(len(h1), part), pa.int32())], names=["h1", "h2", "doc_id", "start", "kind", "part"])

    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, doc, start = (b.column(i).to_numpy() for i in range(4))
        same = np.zeros(len(h1), bool)
        same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        if before is None:
            yield batch(h1[:1], h2[:1], doc[:1], start[:1], [FIRST], part)
        else:
            same[0] = (h1[0], h2[0]) == before
        begins = np.maximum.accumulate(np.where(same, -1, np.arange(len(h1))))
        from_doc, from_start = doc[begins], start[begins]
        if same[0]:
            from_doc, from_start = np.where(begins < 0, origin[0], from_doc), np.where(begins < 0, origin[1], from_start)
        before, origin = (h1[-1], h2[-1]), (from_doc[-1], from_start[-1])
        same &= (doc != from_doc) | (start != from_start)
        last = h1[-1:], h2[-1:], doc[-1:], start[-1:]
        yield batch(h1[same], h2[same], doc[same], start[same], np.full(int(same.sum()), REPEATED), part)
    if before is not None:
        yield batch(*last, [LAST], part)


SPANS = "doc_id long, span_start int, span_words int"


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Repeated stretches of one document become its longest repeated passages: overlapping or touching ones are joined."""
    for b in batches:
        ids, begins, sizes = [], [], []
        for doc, starts, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
            s, n = np.array(starts, np.int64), np.array(runs, np.int64)
            order = np.argsort(s, kind="stable")
            s, end = s[order], np.maximum.accumulate((s + n + least - 1)[order])
            cut = np.flatnonzero(s[1:] > end[:-1])
            begin, end = s[np.concatenate([[0], cut + 1])], end[np.concatenate([cut, [len(s) - 1]])]
            ids.append(np.full(len(begin), doc))
            begins.append(begin)
            sizes.append(end - begin)
        if ids:
            yield pa.record_batch([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(begins), pa.int32()), pa.array(np.concatenate(sizes), pa.int32())], names=["doc_id", "span_start", "span_words"])


def repeated_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 50, gram: int = 16) -> DataFrame:
    """Passages of at least `least` words that occurred before, in an earlier document (by key) or earlier in their own.

    One row per passage: doc_id, span_start, span_words (in words). A word is in a passage exactly if some run of
    `least` words around it is equal to an earlier run; the first occurrence is never reported.

    Suffixes are retained only at minimisers of `gram`-word hashes: every run of `least` words has one, at the same place
    in equal runs. Retained suffixes whose first words occur nowhere else are done. The others, one row each with their
    words behind and before as far as their runs reach, are sorted over all machines by the words that follow and compared
    with their neighbours: equal ones are repeated as a whole; of the others the prefix common with a neighbour bounds the
    match to the right, and what it allows is extended to the left (`compared`). Ties in the sort are broken by key and
    position, so a passage that a third of all documents share is spread over the sort like any other rows; of groups that
    lie over a border of the sort, the different suffixes are compared run by run in a second sort. Words are compared by
    32-bit hashes one by one, the first ones of a suffix by one 64-bit hash. Documents of equal text are taken up once;
    later ones are one passage if they have `least` words.

    Words are parted by white space. Null, empty or short texts have no passages; very long ones are read whole; rows with
    a null key are left out; rows that repeat a key are taken as one document; other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    reach = least - gram
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    lean = docs.where(docs[key].isNotNull()).select(docs[key].cast("long").alias("doc_id"), body.alias("text"))
    asked = lean.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.crc32(F.encode("text", "UTF-8")).alias("t2"))
    anchors = written(asked.mapInArrow(lambda it: trimmed(_anchors(it, least, gram)), "doc_id long, t1 long, t2 long, n_words int, keys array<long>"), "suffix-anchors")
    long = anchors.where(F.col("n_words") >= least)
    firsts = written(long.groupBy("t1", "t2", "n_words").agg(F.min("doc_id").alias("first"), F.first("keys").alias("keys")), "suffix-firsts")
    copies = long.drop("keys").join(firsts.drop("keys"), ["t1", "t2", "n_words"]).where("doc_id <> first").select("doc_id", F.lit(0).alias("span_start"), F.col("n_words").alias("span_words"))
    sparse = firsts.select(F.col("first").alias("at_id"), F.col("t1").alias("at_text"), F.posexplode("keys").alias("nth", "gram_key"))
    # written, so that the join below has a shuffle of its own on both sides and a very common key can be split
    shared = written(sparse.groupBy("gram_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram_key"), "suffix-shared")
    wanted = sparse.join(shared, "gram_key", "left_semi").groupBy("at_id", "at_text").agg(F.collect_list("nth").alias("nth"))  # at most a document's own suffixes
    wanted = written(wanted, "suffix-wanted")
    distinct = lean.join(wanted, (lean["doc_id"] == wanted["at_id"]) & (F.xxhash64(lean["text"]) == wanted["at_text"]))
    suffixes = written(distinct.select("doc_id", "text", "nth").mapInArrow(lambda it: trimmed(_suffixes(it, least, gram)), SUFFIX), "suffix-rows")
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ("gram_key", "behind", "before", "doc_id", "start")
    in_order = suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = written(in_order.mapInArrow(lambda it: trimmed(_compare(it, reach)), COMPARED), "suffix-compared")
    opened = written(found.where(F.col("kind") == OPEN).drop("kind").mapInArrow(lambda it: trimmed(_opened(it, reach)), "h1 long, h2 long, doc_id long, start int"), "suffix-open")
    order = ("h1", "h2", "doc_id", "start")
    runs = written(opened.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours, "h1 long, h2 long, doc_id long, start int, kind int, part int"), "suffix-runs")
    # one first and one last row per partition: a first row whose run began in an earlier partition is repeated too
    opening, closing = runs.where(F.col("kind") == FIRST), runs.where(F.col("kind") == LAST).select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), F.col("part").alias("l_part"), F.col("doc_id").alias("l_doc"), F.col("start").alias("l_start"))
    late = opening.join(closing, (F.col("h1") == F.col("l1")) & (F.col("h2") == F.col("l2")) & (F.col("l_part") < F.col("part")) & ((F.col("l_doc") != F.col("doc_id")) | (F.col("l_start") != F.col("start"))), "left_semi")
    again = found.where(F.col("kind") == AGAIN).select("doc_id", "start", "runs")
    again = again.union(runs.where(F.col("kind") == REPEATED).select("doc_id", "start", F.lit(1))).union(late.select("doc_id", "start", F.lit(1)))
    merged = again.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("runs").alias("runs")).mapInArrow(lambda it: _merge(it, least), SPANS)
    return merged.union(copies.distinct())


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, starts, sizes in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if not starts:
                out.append(text)
                continue
            raw = (text or "").encode("utf-8", "surrogatepass")
            begin, end = words_of(narrow(text))
            kept, at = [], 0
            for s, n in sorted(zip(starts, sizes, strict=True)):
                if s < len(begin):
                    kept.append(raw[at : begin[s]])
                    at = end[min(s + n, len(end)) - 1]
            kept.append(raw[at:])
            pieces = [p for p in (k.decode("utf-8", "surrogatepass").strip() for k in kept) if p]
            out.append("\n".join(pieces))
        yield pa.record_batch([pa.array(out, pa.string()), *b.columns[3:]], schema=schema)


def without_passages(docs: DataFrame, passages: DataFrame, *, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """docs with the passages cut out of their texts (and n_chars counted anew); documents of which nothing is left go."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    per = passages.groupBy("doc_id").agg(F.collect_list(F.struct("span_start", "span_words")).alias("spans"))
    found, starts, sizes, cut = (unused(n, docs) for n in ("passages_of", "starts", "sizes", "is_cut"))
    per = per.select(F.col("doc_id").alias(found), F.col("spans.span_start").alias(starts), F.col("spans.span_words").alias(sizes))
    both = docs.join(per.hint("merge"), docs[key] == per[found], "left")
    rest = [c for c in docs.columns if c != text]
    lean = both.select(docs[text], per[starts], per[sizes], *[docs[c] for c in rest], per[starts].isNotNull().alias(cut))
    out = docs.select(text, *rest).schema.add(cut, "boolean")
    arrow = to_arrow_schema(out)
    done = lean.mapInArrow(lambda it: trimmed(_cut(it, arrow)), out).where(~F.col(cut) | (F.col(text) != ""))
    if n_chars in docs.columns:
        done = done.withColumn(n_chars, F.when(F.col(cut), F.length(text)).otherwise(F.col(n_chars)).cast(docs.schema[n_chars].dataType))
    return done.select(*docs.columns)
