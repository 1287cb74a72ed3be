"""Shared pieces of the training-data operators: numpy text hashing, written intermediates, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.sources.tables import shared_folder

U64 = np.uint64
#: Odd multiplier of the rolling polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


#: Tables in the shared folder that results may still read.
WRITTEN: list[DataFrame] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gneiss-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._gneiss_path = path
    WRITTEN.append(back)
    return back


def forget(df: DataFrame) -> None:
    """Delete the files of a `written` table that nothing reads any more."""
    path = getattr(df, "_gneiss_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        WRITTEN[:] = [x for x in WRITTEN if x is not df]
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def intermediates(*kept: DataFrame) -> Iterator[list[DataFrame]]:
    """Deletes, at its end, the tables that operators wrote within it, but for those appended to the list it gives.

    What is computed within must be written or collected within too.
    """
    before, keep = set(map(id, WRITTEN)), list(kept)
    try:
        yield keep
    finally:
        for df in list(WRITTEN):
            if id(df) not in before and not any(df is k for k in keep):
                forget(df)


def sweep() -> None:
    """Delete all tables that `written` left in the shared folder; for callers who have read their results."""
    for df in list(WRITTEN):
        forget(df)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every other."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base & (2**64 - 1), U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


class Rolling:
    """Hashes of any ranges of a sequence of 64-bit numbers from one prefix sum; equal ranges hash alike at any place."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * powers(base, n), out=self.sums[1:])
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def words_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a UTF-8 text: runs of bytes above the ASCII space (tabs, line ends and controls separate too)."""
    raw = np.frombuffer(blob, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = raw > 32
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of a text."""
    start, end = words_of(blob)
    return start, end, Rolling(np.frombuffer(blob, np.uint8).astype(U64)).ranges(start, end)


@cache
def _libc():
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.malloc_trim(0)
        return libc
    except (OSError, AttributeError):
        return None


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when they end, memory that the task freed goes back to the system, as workers live on for other tasks."""
    try:
        yield from batches
    finally:
        del batches
        gc.collect()
        pa.default_memory_pool().release_unused()
        if _libc():
            _libc().malloc_trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns, batch by batch."""
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def unused(name: str, df: DataFrame) -> str:
    """A column name that df does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows, and so the bytes, of what goes to Python at once: one bound for all operators, as plans are lazy."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of undirected links: rows (id, component), component the smallest id; only ids with a link.

    Alternates large-star and small-star steps. Each step is a minimum per id (combined before the shuffle) and a join
    with those minima. They are written first, so that both sides of the join are shuffled for it alone and adaptive
    execution can split a hub with very many links. Links stay in the shared folder.
    """

    def starred(pairs: DataFrame, both: bool) -> tuple[DataFrame, DataFrame]:
        """Point links at the smallest neighbour: of larger neighbours (both) or of the id and its smaller ones."""
        if both:
            sym = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = sym.groupBy("u").agg(F.min("v").alias("n")).select(F.col("u").alias("of"), F.least("n", "u").alias("m"))
            held = written(low, name)
            hung = sym.where("v > u").join(held, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            return written(hung.where("u <> v").distinct(), name), held
        held = written(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m"), name)
        hung = pairs.join(held, F.col("u") == F.col("of"))
        hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(held.select(F.col("of").alias("u"), F.col("m").alias("v")))
        return written(hung.where("u <> v").distinct(), name), held

    now = written(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v").distinct(), name)
    mark = None
    while True:
        grown, low = starred(now, True)
        then, least = starred(grown, False)
        for old in (now, grown, low, least):
            forget(old)
        now = then
        said = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if said == mark:
            break
        mark = said
    out = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return out.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
