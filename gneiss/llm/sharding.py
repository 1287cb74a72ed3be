"""Sharding by a hierarchical weighted hash tree (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import written

REGION, RACK, SHARD = 0, 1, 2


def unit(*parts: Column) -> Column:
    """A number between 0 and 1 out of the parts' MD5: 52 bits of it, which SQL of any engine can draw alike."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def draw(key: Column, level: int, child: Column, weight: Column, seed: int) -> Column:
    """An exponential draw of rate `weight` from the hash of key, level and child: the least of several wins in proportion to weight."""
    return F.when(weight > 0, -F.log(unit(key, F.lit(level), child, F.lit(seed))) / weight)


def winner(key: Column, level: int, children: list[Column], weights: Column, seed: int) -> Column:
    """The child of the least draw; children without a weight (missing ones too) take no part."""
    drawn = [F.struct(F.coalesce(draw(key, level, c, F.coalesce(F.element_at(weights, c + 1), F.lit(0.0)), seed), F.lit(math.inf)).alias("draw"), c.cast("int").alias("child")) for c in children]
    return (drawn[0] if len(drawn) == 1 else F.least(*drawn)).getField("child")


def tree_weights(weights: Sequence[float], shards_per_rack: int, racks_per_region: int) -> tuple[list[float], list[float], list[float]]:
    """Weights of the shards, of the racks and of the regions, filled up with zeros to whole racks and regions."""
    own = [max(0.0, float(w)) for w in weights]
    own += [0.0] * (-len(own) % (shards_per_rack * racks_per_region))
    racks = [sum(own[i : i + shards_per_rack]) for i in range(0, len(own), shards_per_rack)]
    return own, racks, [sum(racks[i : i + racks_per_region]) for i in range(0, len(racks), racks_per_region)]


def descend(rows: DataFrame, key: str, into: Sequence[str], shards: int, *, shards_per_rack: int = 4, racks_per_region: int = 2, weights: Sequence[float] | None = None, seed: int = 0) -> DataFrame:
    """rows with the columns `into` (region, rack, shard) added: one weighted draw per child of the node that was reached.

    At the root the regions draw, then only the racks of the region that won, then only the shards of that rack; a child's
    draw depends on the key, the child and its weight alone. So a change of weight moves keys only into or out of the
    subtrees whose weight changed, at every level. A new shard that opens a region of its own takes keys only into itself
    (the law `key`); that is so for every shard count that is a multiple of shards_per_rack * racks_per_region. At other
    counts keys may move within the region and the rack that grew as well. A shard of weight 0 (or less) gets nothing; at
    least one weight must be positive. The draws per row are as many as the tree has regions, a region racks and a rack
    shards, not as many as there are shards.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    if len(weights) != shards or not any(w > 0 for w in weights):
        raise ValueError("one weight per shard, at least one of them positive")
    own, racks, regions = (F.array(*map(F.lit, x)) for x in tree_weights(weights, shards_per_rack, racks_per_region))
    count = -(-shards // (shards_per_rack * racks_per_region))
    region, rack, shard = into
    rows = rows.withColumn(region, winner(F.col(key), REGION, [F.lit(i) for i in range(count)], regions, seed))
    rows = rows.withColumn(rack, winner(F.col(key), RACK, [F.col(region) * racks_per_region + i for i in range(racks_per_region)], racks, seed))
    return rows.withColumn(shard, winner(F.col(key), SHARD, [F.col(rack) * shards_per_rack + i for i in range(shards_per_rack)], own, seed))


#: Repeated rows that are written out by one task at a time.
TOGETHER = 1 << 16


def assign_shards(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = 16, shards_per_rack: int = 4, racks_per_region: int = 2, weights: Sequence[float] | None = None, grown_weight: float = 1.0, bucket_rows: int = 4096, seed: int = 0) -> DataFrame:
    """Put every row into a shard by the law `key`: the key and the shard count decide.

    Returns key, size (UTF-8 bytes of the text plus 1), text_crc32, law, region, rack, shard, slot, grown_shard (the shard
    with one more of `grown_weight`). That one more takes rows only into itself holds where `shards` fills whole regions,
    as 16 does, see `descend`; other counts raise ValueError. slot numbers each shard's rows from 0 without gaps, in the
    order of a hash of key and text: rows fall into ranges of that hash of about `bucket_rows` rows, the running sum of the
    ranges' counts gives each its first slot, and only rows of one range are numbered together. Rows of equal key and text
    are counted before they are shuffled and written out again afterwards, `TOGETHER` at a time, so no task holds them all,
    however many. Null text counts as empty, a very long one is one row like any other. A null key is a key like any other:
    all such rows share a shard. Repeated rows each get a slot of their own. Other columns, whatever their names, are left
    out. An empty table gives an empty table.
    """
    if shards % (shards_per_rack * racks_per_region):
        raise ValueError("the law `key` needs shards to fill whole regions")
    more = [*([1.0] * shards if weights is None else weights), grown_weight]
    tree = dict(shards_per_rack=shards_per_rack, racks_per_region=racks_per_region, seed=seed)
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[key].alias("key"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    rows = rows.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("times")).withColumn("place", unit(F.col("key"), F.col("text_crc32"), F.lit(seed + 1)))
    rows = descend(rows, "key", ("region", "rack", "shard"), shards, weights=weights, **tree)
    rows = descend(rows, "key", ("grown_region", "grown_rack", "grown_shard"), shards + 1, weights=more, **tree).drop("grown_region", "grown_rack")
    rows = written(rows, "shard-rows")  # texts are read once
    n, most = rows.agg(F.count(F.lit(1)), F.max("times")).first()
    rows = rows.withColumn("bucket", F.floor(F.col("place") * max(1, -(-n // (shards * bucket_rows)))))
    counts = rows.groupBy("shard", "bucket").agg(F.sum("times").alias("n"))
    first = counts.select(F.col("shard").alias("f_shard"), F.col("bucket").alias("f_bucket"), (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("first"))
    nth = F.sum("times").over(Window.partitionBy("shard", "bucket").orderBy("place", "key", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("times")
    numbered = rows.withColumn("nth", nth).join(first, (F.col("shard") == F.col("f_shard")) & (F.col("bucket") == F.col("f_bucket"))).withColumn("slot", F.col("first") + F.col("nth"))
    if (most or 0) > TOGETHER:
        numbered = numbered.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(TOGETHER).cast("long"))))
        numbered = numbered.withColumn("slot", F.col("slot") + F.col("part")).withColumn("times", F.least(F.lit(TOGETHER).cast("long"), F.col("times") - F.col("part"))).repartition("shard", "slot")
    out = numbered.withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return out.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") + F.col("again")).alias("slot"), "grown_shard", "region", "rack")
