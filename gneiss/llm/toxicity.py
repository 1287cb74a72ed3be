"""Toxicity: bags of character n-gram embeddings, averaged into a linear softmax and trained jointly in numpy."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import U64, Rolling, mixed, small_batches, trimmed, unused

#: Symbols that count as part of a word between two letters or digits, as in disguised spellings.
INNER = "@$!*0'-_+&%#|."


@cache
def word_characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: is it a letter or digit; is it one of INNER."""
    inner = np.zeros(0x10000, bool)
    inner[[ord(c) for c in INNER]] = True
    return np.array([chr(i).isalnum() for i in range(0x10000)]), inner


@dataclass(frozen=True)
class Shape:
    """Sizes of the model and of the windows in which a text is read."""

    bits: int = 17  # 2**bits n-gram vectors
    dim: int = 8
    least: int = 3  # n-gram lengths
    most: int = 5
    window: int = 32  # words in a bag
    step: int = 16
    filled: int = 128  # n-grams by which a shorter bag is averaged all the same


class Stream:
    """Texts as one run of lower-case code points, words parted by single zeros, with bags of words laid over each text.

    A word that stands among the `window` words before it is left out, so that no bag is filled by one word.
    """

    def __init__(self, texts: list[str], shape: Shape):
        lengths = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        plain, inner = word_characters()
        low = np.minimum(raw, 0xFFFF)
        word = plain[low] | (raw > 0xFFFF)
        doc_start = np.concatenate([[0], np.cumsum(lengths)])
        first = np.zeros(len(raw) + 1, bool)
        first[doc_start] = True
        first = first[:-1]
        joins = np.zeros(len(raw), bool)
        if len(raw) > 2:
            joins[1:-1] = inner[low[1:-1]] & word[:-2] & word[2:] & ~first[1:-1] & ~first[2:]
        word |= joins
        starts = word.copy()
        starts[1:] &= ~word[:-1] | first[1:]
        at = np.flatnonzero(starts)
        if len(at):
            ends = word.copy()
            ends[:-1] &= ~word[1:] | first[1:]
            name = Rolling(raw.astype(U64)).ranges(at, np.flatnonzero(ends) + 1) ^ mixed(np.searchsorted(doc_start, at, side="right").astype(U64))
            order = np.argsort(name, kind="stable")
            again = (name[order][1:] == name[order][:-1]) & (np.diff(order) <= shape.window)
            again = order[1:][again]
            gone = np.zeros(len(raw) + 1, np.int8)
            gone[at[again]] = 1
            gone[np.flatnonzero(ends)[again] + 1] -= 1
            word &= np.cumsum(gone[:-1]) == 0
            starts &= word
            at = np.flatnonzero(starts)
        kept = np.flatnonzero(word)
        # position of every kept character in the stream: one zero goes before each word
        place = np.arange(len(kept)) + np.cumsum(starts[kept])
        self.codes = np.zeros(len(kept) + len(at) + 1, U64)
        self.codes[place] = raw[kept]
        self.zero = place[np.searchsorted(kept, at)] - 1  # the zero before each word
        self.doc = np.searchsorted(doc_start, at, side="right") - 1
        counts = np.bincount(self.doc, minlength=len(texts)) if len(at) else np.zeros(len(texts), np.int64)
        bags = np.where(counts > shape.window, -(-(counts - shape.window) // shape.step) + 1, np.minimum(counts, 1))
        self.bag_doc = np.repeat(np.arange(len(texts)), bags)
        nth = np.arange(len(self.bag_doc)) - np.repeat(np.cumsum(bags) - bags, bags)
        base = (np.cumsum(counts) - counts)[self.bag_doc]
        end = base + counts[self.bag_doc]
        self.bag_start = np.maximum(base, np.minimum(base + nth * shape.step, end - shape.window))
        self.bag_end = np.minimum(self.bag_start + shape.window, end)
        self.n_docs, self.shape = len(texts), shape

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n: the bucket of the n-gram that starts at each place, and whether it lies within one word and its borders."""
        s, shape = self.codes, self.shape
        zero = s == 0
        h, fine = s, np.ones(len(s), bool)
        for n in range(2, shape.most + 1):
            h = h[:-1] * U64(0x100000001B3) + s[n - 1 :]
            if n > 2:
                fine = fine[: len(h)] & ~zero[n - 2 : n - 2 + len(h)]
            if n >= shape.least:
                yield (mixed(h + U64(n)) >> U64(64 - shape.bits)).astype(np.int64), fine[: len(h)]

    def bag_sums(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the n-grams' values and their number, for every bag."""
        total, count = np.zeros(len(self.codes) + 1), np.zeros(len(self.codes) + 1)
        for bucket, fine in self.grams():
            total[1 : len(bucket) + 1] += np.where(fine, value[bucket], 0)
            count[1 : len(bucket) + 1] += fine
        total, count = np.cumsum(total), np.cumsum(count)
        edge = np.append(self.zero, len(self.codes) - 1)
        a, b = edge[self.bag_start], edge[self.bag_end]
        return total[b] - total[a], count[b] - count[a]

    def bag_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all n-grams in order of place, and where each word's begin."""
        count = np.zeros(len(self.codes) + 1, np.int64)
        for _, fine in self.grams():
            count[1 : len(fine) + 1] += fine
        base = np.cumsum(count)
        out = np.empty(int(base[-1]), np.int32)
        begin = base[np.append(self.zero, len(self.codes) - 1)]
        for bucket, fine in self.grams():
            at = np.flatnonzero(fine)
            out[base[at]] = bucket[at]
            base[at] += 1
        return out, begin


@dataclass(frozen=True)
class Model:
    """The trained model as a scorer uses it: an n-gram's vector times the softmax's weights is one number."""

    value: np.ndarray
    bias: float
    shape: Shape

    def logits(self, texts: list[str]) -> np.ndarray:
        """Of each lower-case text, the logit of its likeliest bag of words; of a text without words that of an empty bag."""
        stream = Stream(texts, self.shape)
        logit = np.full(len(texts), -np.inf)
        if len(stream.bag_doc):
            total, count = stream.bag_sums(self.value)
            np.maximum.at(logit, stream.bag_doc, total / np.maximum(count, self.shape.filled) + self.bias)
        logit[np.isneginf(logit)] = self.bias
        return logit

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each lower-case text."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def misspelt(text: str, rng: np.random.Generator, rate: float) -> str:
    """The text with some of its words misspelt by one letter left out, doubled, swapped or replaced."""
    words = text.split(" ")
    for i in np.flatnonzero(rng.random(len(words)) < rate):
        w = words[i]
        if len(w) < 4:
            continue
        at, kind = int(rng.integers(1, len(w) - 1)), int(rng.integers(4))
        words[i] = w[:at] + ("" if kind == 0 else w[at] * 2 if kind == 1 else w[at + 1] + w[at] if kind == 2 else "0@1!3$x*"[int(rng.integers(8))]) + w[at + (2 if kind == 2 else 1) :]
    return " ".join(words)


def chunks(texts: list[str], most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def chunk_bags(texts: list[str], first: int, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the texts' n-grams; start and end of each bag that has any; the number of its text, from `first` on."""
    stream = Stream(texts, shape)
    buckets, border = stream.bag_grams()
    a, b = border[stream.bag_start], border[stream.bag_end]
    return buckets, a[b > a], b[b > a], stream.bag_doc[b > a] + first


def train(texts: list[str], labels: list[int], shape: Shape = Shape(), *, least_epochs: int = 4, steps: int = 2000, batch: int = 256, rate: float = 1.0, damping: float = 1e-6, bags_per_text: int = 16, hardest: int = 8, spoilt: float = 0.3, seed: int = 7) -> Model:
    """Fit n-gram vectors and softmax weights together on bags of words of labelled texts.

    A text is as toxic as its likeliest bag. So of a text of label 1 only the likeliest bag, and those already above one
    half, are shown as toxic (in the first epoch, up to bags_per_text drawn at random); of the others are shown
    bags_per_text bags drawn anew in each epoch and the `hardest`, those that are taken for toxic most. Each text is also
    shown with some words misspelt. Few texts are gone over more often, up to about `steps` batches. N-grams that were
    never seen keep a zero vector and say nothing; `damping` keeps the rare ones, seen by chance under one label, from
    moving as far as those that many texts agree on.
    """
    rng = np.random.default_rng(seed)
    size = 1 << shape.bits
    if not texts or len(set(labels)) < 2:
        p = min(max(sum(labels) / len(labels), 0.01), 0.99) if labels else 0.01
        return Model(np.zeros(size, np.float32), float(np.log(p / (1 - p))), shape)
    low = [t.lower() for t in texts]
    low += [misspelt(t, rng, spoilt) for t in low]
    grown, shift, bags = array("i"), [0], []  # the n-grams of all texts are held once, in a buffer that grows in place
    for i, j in chunks(low):
        own, *rest = chunk_bags(low[i:j], i, shape)
        bags.append([rest[0] + shift[-1], rest[1] + shift[-1], rest[2]])
        grown.frombytes(own.tobytes())
        shift.append(len(grown))
    buckets = np.frombuffer(grown, np.int32)
    a, b, doc = (np.concatenate(x) for x in zip(*bags, strict=True))
    y = np.array(list(labels) * 2)[doc]
    begin = np.searchsorted(doc, np.arange(len(low)))

    def logits_now() -> np.ndarray:
        value, out = vectors @ (weights[:, 1] - weights[:, 0]), []
        for lo, hi in zip(shift, shift[1:], strict=False):
            own = slice(*np.searchsorted(a, [lo, hi]))
            sums = np.concatenate([[0], np.cumsum(value[buckets[lo:hi]], dtype=np.float64)])
            out.append((sums[b[own] - lo] - sums[a[own] - lo]) / np.maximum(b[own] - a[own], shape.filled))
        return np.concatenate(out) + bias[1] - bias[0]

    def rank_in_text(by: np.ndarray) -> np.ndarray:
        order = np.lexsort((by, doc))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - begin[doc[order]]
        return rank

    vectors = np.zeros((size, shape.dim), np.float32)
    weights = rng.normal(0, 1, (shape.dim, 2)).astype(np.float32)
    bias = np.array([1.0, -1.0])
    seen, seen_w, seen_b = np.full(size, damping, np.float32), np.full(weights.shape, 1e-6), np.full(2, 1e-6)
    epoch, epochs = 0, 1
    while epoch < epochs:
        logit = logits_now()
        drawn, hard = rank_in_text(rng.random(len(doc))) < bags_per_text, rank_in_text(-logit)
        active = drawn if not epoch else np.where(y == 1, (hard == 0) | drawn & (logit > 0), drawn | (hard < hardest))
        batches = np.array_split(rng.permutation(np.flatnonzero(active)), max(1, int(active.sum()) // batch))
        epochs = max(least_epochs, min(40, -(-steps // len(batches))))
        for chosen in batches:
            n = (b - a)[chosen]
            row = np.repeat(np.arange(len(chosen)), n)
            g = buckets[np.repeat(a[chosen] - (np.cumsum(n) - n), n) + np.arange(len(row))]
            over = np.maximum(n, shape.filled)
            mean = np.add.reduceat(vectors[g], np.cumsum(n) - n, axis=0) / over[:, None]
            z = mean @ weights + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            err = p / len(chosen)
            # of two classes the errors are opposite, so a vector's gradient is one number times the weights' difference
            apart = weights[:, 1] - weights[:, 0]
            pull = np.bincount(g, weights=(err[:, 1] / over)[row], minlength=size).astype(np.float32)
            hit = np.flatnonzero(pull)
            grad = pull[hit, None] * apart
            seen[hit] += (grad * grad).mean(axis=1)
            vectors[hit] -= rate * grad / np.sqrt(seen[hit])[:, None]
            grad_w, grad_b = mean.T @ err, err.sum(axis=0)
            # an empty bag goes with every batch, as not toxic
            empty = 1 / (1 + np.exp(bias[0] - bias[1]))
            grad_b += 0.25 * empty * np.array([-1, 1])
            seen_w += grad_w * grad_w
            weights -= (0.03 * rate * grad_w / np.sqrt(seen_w)).astype(np.float32)
            seen_b += grad_b * grad_b
            bias -= 0.1 * rate * grad_b / np.sqrt(seen_b)
        epoch += 1
    return Model((vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]), shape)


def calibrated(model: Model, texts: list[str], labels: list[int], doubt: float = 4.0) -> Model:
    """The model with its bias moved towards the border that parts the labels of texts it was not trained on best.

    A wrongly accused text weighs twice as much as a missed one, in parts of its label's texts; of equally good borders
    the middle is taken. With n texts of the rarer label, the bias goes n / (n + doubt) of the way: few say little, none
    nothing.
    """
    y = np.array(labels, bool)
    n = int(min(y.sum(), (~y).sum()))
    shift = 0.0
    if n:
        logit = np.concatenate([model.logits([t.lower() for t in texts[i:j]]) for i, j in chunks(texts)])
        order = np.argsort(logit, kind="stable")
        cost = np.concatenate([[0], np.cumsum(y[order] / y.sum())]) + 2 * np.concatenate([np.cumsum((~y[order] / (~y).sum())[::-1])[::-1], [0]])
        edge = np.concatenate([[logit[order[0]] - 1], logit[order], [logit[order[-1]] + 1]])
        best = np.flatnonzero(cost <= cost.min() + 1e-12)
        run = best[: 1 + int(np.argmax(np.append(np.diff(best) != 1, True)))]
        shift = n / (n + doubt) * float(edge[run[0]] + edge[run[-1] + 1]) / 2
    # a text that says nothing is not toxic, wherever the border falls
    return Model(model.value, min(-1.0, model.bias - shift), model.shape)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = 1024, most_chars: int = 12_000_000, shape: Shape = Shape()) -> Model:
    """Train on at most `per_label` documents of label 1 and twice as many of label 0 (those of least hash), none held out.
    Texts are read whole: if those of a label exceed its part of `most_chars` characters, a third for label 1, fewer
    documents are taken.

    A quarter of them is kept for setting the border between the labels. The sample's keys are a bounded table and are broadcast; its texts come to the driver, where the model is trained.
    """
    known = labels.where(labels[key].isNotNull() & labels[label].isin(0, 1) & ~held_out(labels[key])).select(labels[key].alias("k"), labels[label].cast("int").alias("y")).groupBy("k").agg(F.max("y").alias("y"))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).withColumn("h", F.xxhash64("k")).orderBy("h", "k").limit(per_label * (2 - y))
        picked = part if picked is None else picked.union(part)
    of = docs.select(docs[key].alias("d"), docs[text].alias("t")).join(F.broadcast(picked), F.col("d") == F.col("k"))
    sizes = of.groupBy("y", "h").agg(F.sum(F.coalesce(F.length("t"), F.lit(0)))).collect()  # at most 3 * per_label keys
    within = F.lit(False)
    for y in (0, 1):
        hashes, chars = zip(*sorted((r[1], r[2]) for r in sizes if r[0] == y), strict=True) if any(r[0] == y for r in sizes) else ((), ())
        fit_in = int(np.searchsorted(np.cumsum(chars), most_chars * (2 - y) // 3, side="right"))
        if hashes:
            within |= (F.col("y") == y) & (F.col("h") <= hashes[max(0, min(fit_in, len(hashes)) - 1)])
    rows = of.where(within).select("d", "t", "y").collect()
    rows = sorted({(r["y"], r["d"], r["t"] or "") for r in rows})
    return fitted([r[2] for r in rows], [r[0] for r in rows], shape)


def fitted(texts: list[str], labels: list[int], shape: Shape = Shape()) -> Model:
    """Train on three of four texts of each label and set the border by the fourth."""
    nth = {0: 0, 1: 0}
    kept = []
    for y in labels:
        nth[y] += 1
        kept.append(nth[y] % 4 == 0)
    model = train([t for t, k in zip(texts, kept, strict=True) if not k], [y for y, k in zip(labels, kept, strict=True) if not k], shape)
    return calibrated(model, [t for t, k in zip(texts, kept, strict=True) if k], [y for y, k in zip(labels, kept, strict=True) if k])


def _score(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or "" for t in b.column(0).to_pylist()]
        scores = [model.score([t.lower() for t in texts[i:j]]) for i, j in chunks(texts)]
        s = pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())
        yield pa.record_batch([*b.columns[1:], s], schema=schema)


def scored(docs: DataFrame, model: Model, *, text: str = "text", score: str = "score") -> DataFrame:
    """docs with the column `score` added (a column of that name is replaced). Runs where the rows lie; whole texts are read."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() != score.lower()]
    lean = docs.select(docs[text].cast("string").alias(unused("scored_text", docs)), *[docs[c] for c in keep])
    out = docs.select(*[docs[c] for c in keep]).schema.add(score, "double")
    arrow = to_arrow_schema(out)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return lean.mapInArrow(lambda it: trimmed(_score(it, held.value, arrow)), out)


def toxicity(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = 1024, threshold: float = 0.5) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every document: doc_id, held_out, score, predicted.

    A score is the probability of the likeliest stretch of words of the whole text. Null texts count as empty; a text
    without words gets the score of an empty bag; null keys are scored and count as not held out; repeated rows are
    scored alike; other columns are ignored. A very long text is read in bags like any other; texts are taken in chunks of
    about 250,000 characters, a longer one by itself. Without labels of both kinds all scores are the labels' rate. An
    empty table of documents gives no rows. Of labels that contradict each other for a key, 1 holds.
    """
    model = fit(docs, labels, key=key, text=text, label=label, per_label=per_label)
    got = scored(docs.select(docs[key].alias("doc_id"), docs[text].alias("text")), model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
