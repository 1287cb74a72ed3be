"""Embedding near-duplicates: an exact metric range join over pivot cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import components, small_batches, written
from gneiss.llm.topk import usable

#: How far single-precision products may be from the truth, and more; what falls within is computed anew in double.
SLACK = 1e-4


def star_forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, root id) for all ids that links (a, b), given as positions, touch: the components of these links as stars."""
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        then = root.copy()
        np.minimum.at(then, root[a], low)
        np.minimum.at(then, root[b], low)
        then = then[then]
        if (then == root).all():
            break
        root = then
    touched = np.unique(np.concatenate([a, b]))
    return ids[touched], ids[root[touched]]


def scaled_rows(values: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component is near one and no square runs over or under."""
    _, exponent = np.frexp(np.abs(values).max(axis=1, initial=0))
    return np.ldexp(values, -exponent[:, None])


def unit_rows(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(1))[:, None]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * x @ y.T))


def reached(unit: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each vector, and whether a vector within reach of it can have its home in each cell."""
    far = distances(unit, pivots)
    home = far.argmin(1)
    near = far[np.arange(len(far)), home]
    # |x - y| <= reach and y at home in cell j give |x - p_j| <= |x - p_home| + 2 reach (triangle inequality);
    # among equal norms the plane between two pivots is a closer limit: x must lie within reach of it
    within = (far <= near[:, None] + 2 * reach + 1e-6) & (far**2 - near[:, None] ** 2 <= 2 * reach * distances(pivots, pivots)[home] + 1e-6)
    within[np.arange(len(far)), home] = True
    return home, within


def _pack_vectors(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, dim: int, reach: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (cell, home, id, weight, vector bytes): the home cell of each vector and the cells within reach of it."""
    for b in batches:
        values = scaled_rows(b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))
        home, within = reached(unit_rows(values), pivots, reach)
        row, cell = np.nonzero(within)
        raw = values.tobytes()
        size = 8 * dim
        blobs = [raw[i * size : (i + 1) * size] for i in range(len(values))]
        yield pa.record_batch([pa.array(cell, pa.int32()), pa.array(home[row] == cell), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array([blobs[i] for i in row], pa.binary())], schema=schema)


def rings(unit: np.ndarray, chunk: int = 512, sample: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray, float, float]]:
    """The second level: a cell's vectors by pivots of their own, about one per chunk, and in each by distance from it.

    Yields chunks of positions with their pivot and the least and largest distance from it.
    """
    pivots = far_apart(unit[np.linspace(0, len(unit) - 1, min(sample, len(unit))).astype(np.int64)], max(1, len(unit) // chunk))
    far = distances(unit, pivots)
    own = far.argmin(1)
    near = far[np.arange(len(far)), own]
    order = np.lexsort((near, own))
    for p in range(len(pivots)):
        at = order[np.searchsorted(own[order], p) : np.searchsorted(own[order], p, side="right")]
        for i in range(0, len(at), chunk):
            part = at[i : i + chunk]
            yield part, pivots[p], float(near[part[0]]), float(near[part[-1]])


def links_between(x: np.ndarray, y: np.ndarray, least: float, reach: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions (in x, in y) of all pairs of cosine >= least, and how many pairs were compared.

    x goes ring by ring; only the vectors of y whose distance from the ring's pivot is within reach of the ring are
    compared with it. Products are taken in single precision, close calls again in double.
    """
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    ux, uy = x / nx[:, None], y / ny[:, None]
    fx, fy = ux.astype(np.float32), uy.astype(np.float32)
    a, b, compared = [], [], 0
    pivot_of, to_pivot = None, None
    for part, pivot, low, high in rings(ux):
        if pivot_of is not pivot and (pivot_of is None or not np.array_equal(pivot_of, pivot)):
            pivot_of, to_pivot = pivot, distances(uy, pivot[None])[:, 0]
        at = np.flatnonzero((to_pivot >= low - reach - 1e-6) & (to_pivot <= high + reach + 1e-6))
        compared += len(part) * len(at)
        for j in range(0, len(at), 4096):
            there = at[j : j + 4096]
            c = fx[part] @ (fy[there] if len(there) < len(fy) else fy).T
            p, q = np.nonzero(c >= least - SLACK)
            if not len(p):
                continue
            sure = c[p, q] >= least + SLACK
            p, q = part[p], there[q]
            for t in np.array_split(np.flatnonzero(~sure), max(1, (len(sure) - sure.sum()) // 65536)):
                sure[t] = (x[p[t]] * y[q[t]]).sum(1) / (nx[p[t]] * ny[q[t]]) >= least
            a.append(p[sure])
            b.append(q[sure])
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b), compared) if a else (none, none, compared)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _join_cell(table: pa.Table, dim: int, least: float, reach: float) -> pa.Table:
    """Links of the home vectors of one block to the vectors of another: partial counts, and the links' components as stars.

    A row without an id tells the number of pairs that were compared.
    """
    home = np.asarray(table["home"])
    ids, weight = table["id"].to_numpy(), table["weight"].to_numpy()
    asked, there = np.flatnonzero(home), np.flatnonzero(~home)
    out: list[np.ndarray] = [np.empty(0, np.int64)] * 3
    compared = 0
    if len(asked) and len(there):
        v = _vectors(table["v"], dim)
        a, b, compared = links_between(v[asked], v[there], least, reach)
        a, b = asked[a], there[b]
        other = ids[a] != ids[b]
        a, b = a[other], b[other]
        if len(a):
            n = np.bincount(a, weights=weight[b], minlength=len(ids)).astype(np.int64)
            distinct, at = np.unique(ids, return_inverse=True)
            leaf, root = star_forest(at[a], at[b], distinct)
            counted = np.flatnonzero(n)
            out = [np.concatenate([ids[counted], leaf]), np.concatenate([n[counted], np.zeros(len(leaf), np.int64)]), np.concatenate([ids[counted], root])]
    ids, n, root = (x.tolist() for x in out)
    return pa.table({"id": pa.array([*ids, None], pa.int64()), "n": pa.array([*n, compared], pa.int64()), "root": pa.array([*root, None], pa.int64())})


def _joiner(dim: int, least: float, reach: float):
    return lambda table: _join_cell(table, dim, least, reach)


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots out of a sample: each is the one furthest from those chosen before."""
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        at = int(near.argmin())
        if near[at] > 1 - 1e-9:
            break
        chosen.append(at)
        near = np.maximum(near, sample @ sample[at])
    return sample[chosen]


def pivots_for(sample: np.ndarray, rows: int, reach: float, most_pivots: int, least_pivots: int = 4, ship: int = 2000) -> np.ndarray:
    """As many pivots as cost least: every copy of a vector is compared with a cell and costs `ship` more comparisons to send.

    What a number of pivots makes of copies is measured on the sample. Twice as many are tried each time, up to one per 16
    rows: where copies stay few, as among clusters, their number grows with the table; where every cell is within reach of
    almost every vector, as in many dimensions without clusters, more would only multiply the copies.
    """
    best, best_cost, count = None, math.inf, least_pivots
    pivots = far_apart(sample, max(least_pivots, min(most_pivots, rows // 16)))
    while True:
        own = pivots[:count]
        copies = reached(sample, own, reach)[1].sum(1).mean()
        cost = copies * (rows / len(own) + ship) + len(own)
        if cost < best_cost:
            best, best_cost = own, cost
        if count >= len(pivots):
            return best
        count *= 2


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, most_pivots: int = 1024, sample_rows: int = 4096, block_rows: int = 8192, report: list | None = None) -> DataFrame:
    """Link vectors of cosine >= `least` (double precision): vec_id, n_links, component_id, kept.

    Equal vectors are one class, joined once and counted as often as they occur. Unit vectors of cosine >= least lie
    within r = sqrt(2 - 2 least); pivots (`pivots_for`, chosen far apart in a sample of `sample_rows` rows, at least 4 and
    at most `most_pivots`) give each vector a home cell, and it is copied to the other cells that a vector within r of it
    can have as home. Each cell is joined by itself: home vectors against all, in blocks of `block_rows`, so that no task
    holds a whole large cell. Within a block the home vectors have pivots of their own and lie in rings around them;
    vectors further than r from a ring are not compared with it. Every home vector sees all its links exactly once. What
    leaves a block is at most one count per home vector and one star link per vector. `report`, if given, gets one dict per
    number of components: rows, pivots, copies, pairs compared and all pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different length; very large and very small components are scaled by powers of two. Rows that repeat key and components
    count once; a null key is returned as it is, unlinked. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    v = vectors[vector]
    fine = usable(v) & F.exists(v, lambda x: F.abs(x.cast("double")) > F.lit(0.0)) & vectors[key].isNotNull()
    rows = vectors.select(vectors[key].cast("long").alias("id"), F.when(fine, F.transform(v, lambda x: x.cast("double"))).alias("v")).dropDuplicates(["id", "v"])
    rows = written(rows.withColumn("class", F.xxhash64("v")), "near-rows")
    classes = written(rows.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "near-classes")
    parts = []
    reach = math.sqrt(max(0.0, 2 - 2 * least)) * (1 + 1e-9)
    for dim, n in sorted((r[0], r[1]) for r in classes.groupBy(F.size("v")).agg(F.count(F.lit(1))).collect()):
        own = classes.where(F.size("v") == dim)
        sample = np.array([r[0] for r in own.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()])
        pivots = pivots_for(unit_rows(scaled_rows(sample)), n, reach, most_pivots)
        schema = pa.schema([("cell", pa.int32()), ("home", pa.bool_()), ("id", pa.int64()), ("weight", pa.int64()), ("v", pa.binary())])
        cells = own.select("id", "weight", "v").mapInArrow(lambda it, p=pivots, d=dim, s=schema: _pack_vectors(it, p, d, reach, s), "cell int, home boolean, id long, weight long, v binary")
        cells = written(cells, "near-cells")
        sizes = {r["cell"]: (r["h"], r["n"]) for r in cells.groupBy("cell").agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("n")).collect()}  # most_pivots rows at most
        blocks = F.create_map(*[x for c, (h, a) in sizes.items() for x in (F.lit(c), F.struct(F.lit(max(1, -(-h // block_rows))).alias("h"), F.lit(max(1, -(-a // block_rows))).alias("a")))])
        cells = cells.withColumn("blocks", F.element_at(blocks, F.col("cell")))
        ask = cells.where("home").select("cell", F.pmod(F.xxhash64("id"), F.col("blocks.h")).alias("hb"), F.explode(F.sequence(F.lit(0), F.col("blocks.a") - 1)).alias("ab"), "home", "id", "weight", "v")
        there = cells.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks.h") - 1)).alias("hb"), F.pmod(F.xxhash64(F.lit(1), "id"), F.col("blocks.a")).alias("ab"), F.lit(False).alias("home"), "id", "weight", "v")
        found = written(ask.union(there).groupBy("cell", "hb", "ab").applyInArrow(_joiner(dim, least, reach), "id long, n long, root long"), "near-links")
        if report is not None:
            report.append({"rows": n, "pivots": len(pivots), "copies": sum(a for _, a in sizes.values()), "compared": found.where("id is null").agg(F.sum("n")).first()[0] or 0, "all": n * n})
        parts.append(found.where("id is not null"))
    if not parts:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    counts = found.groupBy("id").agg(F.sum("n").alias("n")).select(F.col("id").alias("n_id"), "n")
    comps = components(found, "id", "root", "near-cc").select(F.col("id").alias("c_id"), "component")
    of_class = classes.join(counts, F.col("id") == F.col("n_id"), "left").join(comps, F.col("id") == F.col("c_id"), "left").select(F.col("v").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(of_class, (F.col("class") == F.xxhash64("of")) & (F.col("v") == F.col("of")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
