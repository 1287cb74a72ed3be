"""Mixing sources to target weights by temperature (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import unused, written

#: Each round of the search looks at this many exponents at once: five bisections in one pass over the sources.
GRID = 32


def n_tokens(text: Column) -> Column:
    """Words of the text and one for its end, so that every document weighs something; null text counts as empty."""
    return (F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"\S+")) + 1).cast("long")


def weighed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows (key, source, n_tokens, salt) of docs, written: texts are read once, all else works on these.

    salt tells rows apart whose source and text are equal or whose keys are null: it is the hash of the text.
    """
    lean = docs.select(docs[key].alias("key"), docs[source].alias("source"), n_tokens(docs[text]).alias("n_tokens"), salt_of(docs[text]).alias("salt"))
    return written(lean, "mix-rows")


def salt_of(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def pass_key(key: Column, source: Column, salt: Column, seed: int, epoch: Column) -> Column:
    """The place of a document in its source's permutation of one pass."""
    return F.xxhash64(F.lit(seed), key, source, salt, epoch)


def ranges_of(rows: int, each: int = 4096) -> int:
    """Bits of the hash ranges that part a table of so many rows into pieces of at most about `each`."""
    return max(10, min(40, math.ceil(math.log2(max(1, rows) / each + 1))))


def source_tokens(lean: DataFrame) -> DataFrame:
    """Rows (source, tokens, n_docs, share): combined before the shuffle, so one huge source costs no task more than another."""
    per = written(lean.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "mix-sources")
    total = per.agg(F.sum("tokens")).first()[0] or 1
    return per.select("source", "tokens", "n_docs", (F.col("tokens") / F.lit(float(total))).alias("share"))


def exponent_for(shares: DataFrame, *, target_entropy: float | None, max_repeats: float | None, rounds: int = 8) -> float:
    """Bisect the exponent in [0, 1] of share ** exponent.

    target_entropy: wanted entropy of the weights as a part of its maximum, ln(sources); the entropy falls as the exponent
    rises, so the largest exponent that still reaches it is taken (0 if none does). max_repeats: no source may be passed
    over more than this often while the least repeated one is passed once; the largest ratio falls as the exponent rises,
    so the smallest exponent within the limit is taken. The limit wins over the entropy. Neither given, or no
    rows: 1. Only GRID rows per round reach the driver.
    """

    def search(good, below: bool) -> float:
        """The last exponent (below) or the first (not below) at which the figures are good; good holds on that side of one border."""
        low, high = 0.0, 1.0
        for _ in range(rounds):
            grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            each = shares.select("share", F.explode(F.array(*[F.lit(x) for x in grid])).alias("x"))
            power = F.pow("share", F.col("x"))
            figures = {r["x"]: r for r in each.groupBy("x").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("s"), F.min("share").alias("least"), F.max("share").alias("most"), F.count(F.lit(1)).alias("n")).collect()}
            if not figures:
                return 1.0
            fits = [good(x, figures[x]) for x in grid]
            if all(fits) or not any(fits):
                return high if below == fits[0] else low
            edge = fits.index(not fits[0])
            low, high = grid[edge - 1], grid[edge]
        return low if below else high

    def enough(x: float, r) -> bool:
        return math.log(r["z"]) - x * r["s"] / r["z"] >= target_entropy * math.log(r["n"]) - 1e-12

    def within(x: float, r) -> bool:
        return (1 - x) * (math.log(r["most"]) - math.log(r["least"])) <= math.log(max_repeats) + 1e-12

    wanted = 1.0 if target_entropy is None and max_repeats is None else 0.0 if target_entropy is None else search(enough, True)
    return wanted if max_repeats is None else max(wanted, search(within, False))


def mixing_plan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", target_entropy: float | None = 0.98, max_repeats: float | None = 2.0, budget_tokens: int | None = None, seed: int = 0, lean: DataFrame | None = None) -> DataFrame:
    """One row per source: tokens, n_docs, share, weight, budget, full_passes, cut_key.

    weight is share ** exponent, normalised. budget_tokens of None is the least budget at which every source is passed
    over at least once, so nothing is lost. A source of budget b and t tokens gives floor(b / t) whole passes and then
    the first documents of one more permutation, up to the last that ends within b: those whose pass_key is at most
    cut_key (null: none). Running sums are taken per hash range, of which there are the more the more rows there are, never
    over a whole source in one task. Rows of one key, source and text are taken or left as one. `lean` is the table that
    `weighed` gives, if there is one already. Null sources are a source of their own; an empty table gives no rows.
    """
    lean = weighed(docs, key=key, text=text, source=source) if lean is None else lean
    per = source_tokens(lean)
    x = exponent_for(per, target_entropy=target_entropy, max_repeats=max_repeats)
    power = F.pow("share", F.lit(x))
    z, steepest, rows = per.agg(F.sum(power), F.max(F.col("tokens") / power), F.sum("n_docs")).first()
    budget = float(budget_tokens) if budget_tokens is not None else (z or 1.0) * (steepest or 1.0)
    plan = (
        per.withColumn("weight", power / F.lit(z or 1.0))
        .withColumn("budget", F.col("weight") * F.lit(budget))
        .withColumn("full_passes", F.floor(F.col("budget") / F.col("tokens") + F.lit(1e-9)).cast("long"))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("budget") - F.col("full_passes") * F.col("tokens")))
        .select("source", "tokens", "n_docs", "share", "weight", "budget", "full_passes", "rest")
    )
    plan = written(plan, "mix-plan")
    asked = plan.where("rest > 0").select(F.col("source").alias("of"), "rest", "full_passes")
    at = lean.join(asked, F.col("source").eqNullSafe(F.col("of"))).select("of", "n_tokens", "rest", pass_key(F.col("key"), F.col("of"), F.col("salt"), seed, F.col("full_passes")).alias("k"))
    at = at.groupBy("of", "rest", "k").agg(F.sum("n_tokens").alias("n")).withColumn("range", F.shiftright("k", 64 - ranges_of(rows or 0)))
    sized = at.groupBy("of", "range").agg(F.sum("n").alias("n"))
    before = sized.select(F.col("of").alias("b_of"), F.col("range").alias("b_range"), (F.sum("n").over(Window.partitionBy("of").orderBy("range")) - F.col("n")).alias("before"))
    ends = at.join(before, F.col("of").eqNullSafe(F.col("b_of")) & (F.col("range") == F.col("b_range"))).withColumn("end", F.col("before") + F.sum("n").over(Window.partitionBy("of", "range").orderBy("k")))
    cut = ends.where("end <= rest").groupBy(F.col("of").alias("c_of")).agg(F.max("k").alias("cut_key"))
    out = plan.join(cut, F.col("source").eqNullSafe(F.col("c_of")), "left").select("source", "tokens", "n_docs", "share", "weight", "budget", "full_passes", "cut_key")
    return written(out, "mix-plan")


def with_copies(docs: DataFrame, plan: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, mix_pass: str = "mix_pass", salt: str | None = None) -> DataFrame:
    """docs as they are, each row as often as the plan passes over it, with the column `mix_pass` (from 0) added.

    docs must have no column of that name (ValueError). `salt` names a column that holds `salt_of` the text; without it the
    text is hashed anew.
    """
    if mix_pass.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {mix_pass} is there already")
    of, full, cut = (unused(n, docs) for n in ("mix_source", "mix_full", "mix_cut"))
    p = plan.select(F.col("source").alias(of), F.col("full_passes").alias(full), F.col("cut_key").alias(cut))
    mark = salt_of(docs[text]) if salt is None else docs[salt]
    more = F.coalesce(pass_key(docs[key], docs[source], mark, seed, p[full]) <= p[cut], F.lit(False))
    copies = p[full] + more.cast("long")
    seen = docs.join(p, docs[source].eqNullSafe(p[of])).where(copies > 0)
    return seen.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias(mix_pass))


def in_mix_order(docs: DataFrame, plan: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", block_tokens: int = 1 << 20, seed: int = 0) -> DataFrame:
    """The copies of docs that `with_copies` makes, with docs' own columns, in the order of the mix: block by block, each block permuted.

    A copy's place in its source's layout is read off its hash, which is where the permutation puts it but for the
    unevenness of hashes; the exact running sums of `mix` would need another join. So each block holds the target weights
    in expectation. The rows are range-partitioned by block and sorted; files written from the result keep that order. One
    shuffle of the copies; a block is the least that goes to one task.
    """
    nth, of, weight, tokens, k, block, at = (unused(n, docs) for n in ("mix_pass", "mix_source", "mix_weight", "mix_tokens", "mix_key", "mix_block", "mix_at"))
    p = plan.select(F.col("source").alias(of), F.col("weight").alias(weight), F.col("tokens").alias(tokens))
    copies = with_copies(docs, plan, key=key, text=text, source=source, seed=seed, mix_pass=nth)
    copies = copies.join(p, copies[source].eqNullSafe(F.col(of))).withColumn(k, pass_key(F.col(key), F.col(source), salt_of(F.col(text)), seed, F.col(nth)))
    start = (F.col(nth) + F.col(k).cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.col(tokens)
    copies = copies.withColumn(block, F.floor(start / (F.col(weight) * F.lit(float(block_tokens)))).cast("long")).withColumn(at, F.xxhash64(F.lit(seed + 1), F.col(k)))
    parts = max(12, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return copies.repartitionByRange(parts, block, at).sortWithinPartitions(block, at).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", target_entropy: float | None = 0.98, max_repeats: float | None = 2.0, budget_tokens: int | None = None, block_tokens: int = 1 << 20, seed: int = 0) -> DataFrame:
    """The whole mix, one row per use of a document: key, source, n_tokens, weight, mix_pass, block, block_key.

    Each source is laid out as its passes one after another, each pass a permutation by hash. Block b of the mix takes
    from each source the stretch [b, b + 1) * weight * block_tokens of that layout, by where a document starts, so every
    block holds the target weights to within a document; block_key permutes the rows within a block. Null sources are a
    source of their own; null or empty texts weigh one token; repeated rows and null keys are separate documents, told
    apart by a number that the written table gives each row, so that not even a third of all rows being alike puts them
    into one hash range; equal places are broken by that number. An empty table gives no rows; other columns, whatever
    their names, are left out.
    """
    lean = weighed(docs, key=key, text=text, source=source)
    plan = mixing_plan(docs, key=key, text=text, source=source, target_entropy=target_entropy, max_repeats=max_repeats, budget_tokens=budget_tokens, seed=seed, lean=lean)
    rows = lean.count()
    # uses are written, as row numbers hold within one reading only
    uses = with_copies(lean, plan, key="key", source="source", salt="salt", seed=seed).withColumn("row", F.monotonically_increasing_id())
    uses = uses.withColumn("k", pass_key(F.col("key"), F.col("source"), F.xxhash64("salt", "row"), seed, F.col("mix_pass"))).withColumn("range", F.shiftright("k", 64 - ranges_of(rows)))
    uses = written(uses.drop("salt"), "mix-uses")
    sized = uses.groupBy("source", "mix_pass", "range").agg(F.sum("n_tokens").alias("n"))
    before = sized.select(F.col("source").alias("b_source"), F.col("mix_pass").alias("b_pass"), F.col("range").alias("b_range"), (F.sum("n").over(Window.partitionBy("source").orderBy("mix_pass", "range")) - F.col("n")).alias("before"))
    placed = uses.join(before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("mix_pass") == F.col("b_pass")) & (F.col("range") == F.col("b_range"))).withColumn("start", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("source", "mix_pass", "range").orderBy("k", "row")) - F.col("n_tokens"))
    weights = plan.select(F.col("source").alias("w_source"), "weight")
    return placed.join(weights, F.col("source").eqNullSafe(F.col("w_source"))).select(
        F.col("key").alias(key), "source", "n_tokens", "weight", F.col("mix_pass").cast("int").alias("mix_pass"), F.floor(F.col("start") / (F.col("weight") * F.lit(float(block_tokens)))).cast("long").alias("block"), F.xxhash64(F.lit(seed + 1), F.col("key"), F.col("mix_pass"), F.col("row")).alias("block_key")
    )
