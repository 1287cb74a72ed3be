"""Exact top-k inner-product search with KD-trees per shard."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import small_batches, written


class KDTree:
    """Median splits down to leaves, a tight bounding box at every node; points lie in the order of the leaves."""

    def __init__(self, points: np.ndarray, leaf: int):
        low, high, child, span = [], [], [], []
        self.order = np.arange(len(points))
        stack = [(0, len(points), -1, 0)]
        while stack:
            begin, end, parent, side = stack.pop()
            own = points[self.order[begin:end]]
            me = len(child)
            low.append(own.min(0))
            high.append(own.max(0))
            child.append([-1, -1])
            span.append([begin, end])
            if parent >= 0:
                child[parent][side] = me
            widest = int(np.argmax(high[-1] - low[-1]))
            if end - begin <= leaf or low[-1][widest] == high[-1][widest]:
                continue
            half = (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(own[:, widest], half)]
            stack.append((begin, begin + half, me, 0))
            stack.append((begin + half, end, me, 1))
        self.points = points[self.order]
        self.low, self.high, self.child, self.span = np.array(low), np.array(high), np.array(child), np.array(span)


def most_product(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For every query and box, no less than the product of the query with any point in the box, whatever the rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        bound += 1e-9 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T)
    return np.where(np.isnan(bound), np.inf, bound)


def exactly(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as numbers whose products are exact: floats or 64-bit integers as long as these suffice, else Python's integers."""
    most = points.shape[1] * float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if most < 2**53:
        return points, queries
    if most < 2**62 and max(np.abs(points).max(initial=0), np.abs(queries).max(initial=0)) < 2**62:
        return points.astype(np.int64), queries.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(points), whole(queries)


def search(tree: dict[str, np.ndarray], queries: np.ndarray, query_ids: np.ndarray, query_own: np.ndarray, kth: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the rows (position, score) of this tree that can be among its k best, best first.

    Best-first: the node of the highest bound is opened next; the walk ends once that bound is below the k-th score
    known so far, in this tree or (kth) elsewhere. Equal bounds are still opened, as ties go to the smaller id.
    """
    out = []
    ids, own, child, span = tree["ids"], tree["own"], tree["child"], tree["span"]
    bound = most_product(queries, tree["low"], tree["high"])
    points, exact = exactly(tree["points"], queries)
    for q in range(len(queries)):
        b, least = bound[q].tolist(), float(kth[q])
        heap = [(-b[0], 0)]
        at, score = np.empty(0, np.int64), np.empty(0, points.dtype)
        while heap:
            top, node = heapq.heappop(heap)
            if -top < least:
                break
            if child[node][0] >= 0:
                for c in child[node]:
                    if b[c] >= least:
                        heapq.heappush(heap, (-b[c], c))
                continue
            begin, end = span[node]
            s = points[begin:end] @ exact[q]
            good = np.flatnonzero((s >= least) & ~((ids[begin:end] == query_ids[q]) & (own[begin:end] == query_own[q])))
            if len(good):
                at, score = np.concatenate([at, begin + good]), np.concatenate([score, s[good]])
                if len(at) > k:
                    best = np.lexsort((ids[at], -score))[:k] if score.dtype != object else np.array(sorted(range(len(at)), key=lambda i: (-score[i], ids[at[i]]))[:k])
                    at, score = at[best], score[best]
                if len(at) == k:
                    least = max(least, score.min().item() if score.dtype != object else score.min())
        out.append((at, score))
    return out


def cells_of(sample: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The top of the tree: median splits of a sample into at most `count` cells, as (axis, border, children) per node.

    A child below 0 is the cell -1 - child. Points up to the border go to the first child.
    """
    axis, border, child, cells = [], [], [], 0
    heap, n = [(-len(sample), 0, np.arange(len(sample)), -1, 0)], 1
    while heap:
        _, _, rows, parent, side = heapq.heappop(heap)
        own = sample[rows]
        spread = own.max(0) - own.min(0) if len(rows) else np.zeros(sample.shape[1])
        at = int(np.argmax(spread))
        cut = 0.0
        if spread[at] > 0:
            middle = float(np.partition(own[:, at], (len(rows) - 1) // 2)[(len(rows) - 1) // 2])
            cut = middle if (own[:, at] > middle).any() else float(own[:, at][own[:, at] < middle].max())
        if len(heap) + cells + 2 > count or len(rows) < 2 or not spread[at] > 0:
            me, cells = -1 - cells, cells + 1
        else:
            me = len(axis)
            axis.append(at)
            border.append(cut)
            child.append([0, 0])
            below = own[:, at] <= cut
            for s, part in ((0, rows[below]), (1, rows[~below])):
                heapq.heappush(heap, (-len(part), n, part, me, s))
                n += 1
        if parent >= 0:
            child[parent][side] = me
    return np.array(axis, np.int64), np.array(border), np.array(child, np.int64).reshape(-1, 2)


def cell_of(points: np.ndarray, top: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The cell of every point."""
    axis, border, child = top
    node = np.zeros(len(points), np.int64) if len(axis) else np.full(len(points), -1)
    while (open_ := np.flatnonzero(node >= 0)).size:
        now = node[open_]
        node[open_] = child[now, (points[open_, axis[now]] > border[now]).astype(np.int64)]
    return -1 - node


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _in_cells(batches: Iterator[pa.RecordBatch], top, dim: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell_of(_matrix(b.column(2), dim), top), pa.int32())], names=["id", "own", "v", "asks", "cell"])


def _built(table: pa.Table, dim: int, leaf: int) -> pa.Table:
    """The tree of one shard as one row."""
    points = _matrix(table["v"], dim)
    tree = KDTree(points, leaf)
    blob = io.BytesIO()
    np.savez(blob, points=tree.points, low=tree.low, high=tree.high, child=tree.child, span=tree.span, ids=table["id"].to_numpy()[tree.order], own=table["own"].to_numpy()[tree.order])
    return pa.table({"cell": table["cell"][:1], "sub": table["sub"][:1], "low": pa.array([tree.low[0].tolist()]), "high": pa.array([tree.high[0].tolist()]), "tree": pa.array([blob.getvalue()], pa.binary())})


def _boxed(table: pa.Table, dim: int) -> pa.Table:
    return pa.table({"cell": table["cell"][:1], "low": pa.array([_matrix(table["low"], dim).min(0).tolist()]), "high": pa.array([_matrix(table["high"], dim).max(0).tolist()])})


def _routed(batches: Iterator[pa.RecordBatch], cells: np.ndarray, low: np.ndarray, high: np.ndarray, dim: int) -> Iterator[pa.RecordBatch]:
    """Queries (id, own, v, kth or null, seen or null): without a k-th score to the cell of the highest bound, with one to all that can reach it."""
    for b in batches:
        seen = b.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
        bound = most_product(_matrix(b.column(2), dim), low, high)
        first = np.isnan(seen)
        kth = b.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
        to = bound >= np.where(np.isnan(kth), -np.inf, kth)[:, None]
        to[first] = False
        to[first, bound[first].argmax(1)] = True
        row, cell = np.nonzero(to)
        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in b.columns[:4]), pa.array(cells[cell], pa.int32())], names=["id", "own", "v", "kth", "cell"])


FOUND = "query_id long, query_own long, vec_id long, own long, score long, beyond boolean"


def _searched(asked: pa.Table, trees: pa.Table, dim: int, k: int) -> pa.Table:
    """Candidates of a block of queries in one shard; scores beyond a long are marked."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    if not asked.num_rows or not trees.num_rows:
        return pa.table({n: pa.array([], pa.bool_() if n == "beyond" else pa.int64()) for n in names})
    tree = dict(np.load(io.BytesIO(trees["tree"][0].as_py())))
    ids, own = asked["id"].to_numpy(), asked["own"].to_numpy()
    kth = np.nan_to_num(asked["kth"].to_numpy().astype(np.float64), nan=-np.inf)
    found = search(tree, _matrix(asked["v"], dim), ids, own, kth, k)
    n = [len(a) for a, _ in found]
    at = np.concatenate([a for a, _ in found])
    score = [int(x) for _, s in found for x in s]
    most = 2**63 - 1
    return pa.table([pa.array(np.repeat(ids, n)), pa.array(np.repeat(own, n)), pa.array(tree["ids"][at]), pa.array(tree["own"][at]), pa.array([max(-most, min(most, x)) for x in score], pa.int64()), pa.array([abs(x) > most for x in score], pa.bool_())], names=names)


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as doubles, which hold these whole numbers exactly."""

    def one(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(2.0**52), F.floor(F.when(F.abs(y) < F.lit(2.0**52), y)).cast("double")).otherwise(y)

    return F.transform(vector, one)


def usable(vector: Column, scale: float = 1.0) -> Column:
    """Whether a vector has components and all of them are finite numbers, when scaled too."""

    def fine(x: Column) -> Column:
        y = F.abs(x.cast("double")) * F.lit(float(scale))
        return x.isNotNull() & ~F.isnan(y) & (y < F.lit(float("inf")))

    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def top_k(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024, every: int = 100, shard_rows: int = 4096, most_cells: int = 1024, sample_rows: int = 16384, query_block: int = 8192, leaf: int = 128) -> DataFrame:
    """The k highest integer inner products of every query row with all other rows: query_id, rank, vec_id, score.

    Components become floor(scale * x). Queries are the rows whose key is divisible by `every`; ties go to the smaller
    key. The top of the KD-tree, median splits of a sample of `sample_rows` rows, parts the table into cells of about
    `shard_rows` rows, at most `most_cells`; a larger cell is parted further by hash. Each of these shards is indexed whole
    by a KD-tree that is built and written once. A query first goes to the cell of the highest bound; the k-th score it
    finds there travels with it, and it goes on only to cells whose bounding box can reach that score, and there only to
    nodes that can. What the driver holds and tasks are sent is one box per cell, at most `most_cells`. No group holds more
    than a shard and a block of `query_block` queries.

    Vectors that are null or empty, or hold null or non-finite components (scaled ones too) take no part, nor do null keys.
    All finite components do; a score among the k best that does not fit a long raises an error. Vectors are compared with
    those of as many components. Rows that repeat key and components are one vector stated twice, as a table holds that was
    loaded twice, and count once: else a query would find itself. Rows that share a key but differ are separate. Fewer than
    k candidates: all. Other columns are ignored; an empty table gives no rows.
    """
    small_batches(vectors.sparkSession)
    lean = vectors.where(vectors[key].isNotNull() & usable(vectors[vector], scale)).select(vectors[key].cast("long").alias("id"), scaled(vectors[vector], scale).alias("v"))
    lean = written(lean.dropDuplicates(["id", "v"]).select("id", F.xxhash64("v").alias("own"), "v", (F.pmod("id", F.lit(every)) == 0).alias("asks"), F.size("v").alias("dim")), "topk-rows")
    out = None
    for dim, n in sorted((r[0], r[1]) for r in lean.groupBy("dim").agg(F.count(F.lit(1))).collect()):
        found = _top_of(lean.where(F.col("dim") == dim).drop("dim"), dim, n, k, shard_rows, most_cells, sample_rows, query_block, leaf)
        out = found if out is None else out.union(found)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], FOUND)
    best = Window.partitionBy("query_id", "query_own").orderBy(F.desc("score"), "vec_id", "own")
    score = F.when(F.col("beyond"), F.raise_error(F.lit("a score does not fit a long")).cast("long")).otherwise(F.col("score"))
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def _top_of(rows: DataFrame, dim: int, n: int, k: int, shard_rows: int, most_cells: int, sample_rows: int, query_block: int, leaf: int) -> DataFrame:
    """Candidates among rows of one number of components."""
    sample = _matrix(pa.array([r[0] for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()], pa.list_(pa.float64())), dim)
    top = cells_of(sample, min(most_cells, -(-n // shard_rows)))
    placed = written(rows.mapInArrow(lambda it: _in_cells(it, top, dim), "id long, own long, v array<double>, asks boolean, cell int"), "topk-cells")
    sizes = {r["cell"]: -(-r["n"] // shard_rows) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # most_cells rows at most
    subs = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("cell"))
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("id", "own"), subs).cast("int"))
    trees = placed.select("cell", "sub", "id", "own", "v").groupBy("cell", "sub").applyInArrow(lambda t: _built(t, dim, leaf), "cell int, sub int, low array<double>, high array<double>, tree binary")
    trees = written(trees, "topk-trees")
    boxes = trees.select("cell", "low", "high").groupBy("cell").applyInArrow(lambda t: _boxed(t, dim), "cell int, low array<double>, high array<double>").collect()
    cells, low, high = np.array([r["cell"] for r in boxes]), np.array([r["low"] for r in boxes]), np.array([r["high"] for r in boxes])

    def searched(asked: DataFrame) -> DataFrame:
        """asked: id, own, v, kth, cell, sub. Large blocks of queries of one shard are parted, and its tree goes to each."""
        asked = written(asked, "topk-asked")
        blocks = asked.groupBy("cell", "sub").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("blocks"))
        asked = asked.join(blocks, ["cell", "sub"]).withColumn("block", F.pmod(F.xxhash64("id", "own"), F.col("blocks")).cast("int"))
        there = trees.join(blocks, ["cell", "sub"]).select("cell", "sub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree")
        by = ("cell", "sub", "block")
        return written(asked.drop("blocks").groupBy(*by).cogroup(there.groupBy(*by)).applyInArrow(lambda a, t: _searched(a, t, dim, k), FOUND), "topk-found")

    def routed(queries: DataFrame) -> DataFrame:
        return queries.mapInArrow(lambda it: _routed(it, cells, low, high, dim), "id long, own long, v array<double>, kth double, cell int")

    queries = placed.where("asks").select("id", "own", "v")
    nothing = F.lit(None).cast("double")
    one = F.pmod(F.xxhash64("own", "id"), subs).cast("int")
    first = searched(routed(queries.select("id", "own", "v", nothing.alias("kth"), nothing.alias("seen"))).withColumn("sub", one))
    best = first.groupBy(F.col("query_id").alias("q_id"), F.col("query_own").alias("q_own")).agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
    # a k-th score turned into a double must not end above itself
    least = F.when(F.col("n") >= k, F.col("least") - F.abs("least") * F.lit(1e-15))
    asked = queries.join(best, (F.col("id") == F.col("q_id")) & (F.col("own") == F.col("q_own")), "left").select("id", "own", "v", least.alias("kth"), F.lit(1.0).alias("seen"))
    asked = routed(asked).withColumn("sub", F.explode(F.sequence(F.lit(0), subs - 1)))
    # the shard that was searched first is left out by its bound's cell and the query's own place in it
    visited = routed(queries.select("id", "own", "v", nothing.alias("kth"), nothing.alias("seen"))).select(F.col("id").alias("s_id"), F.col("own").alias("s_own"), F.col("cell").alias("s_cell"))
    asked = asked.join(visited, (F.col("id") == F.col("s_id")) & (F.col("own") == F.col("s_own")) & (F.col("cell") == F.col("s_cell")) & (F.col("sub") == one), "left_anti")
    return first.union(searched(asked))
