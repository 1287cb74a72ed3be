"""Table sources and sinks: CSV, text lists, versioned Parquet, JDBC."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gneiss.functions.text import strip
from gneiss.schemas import CSV_NAMES, MANIFEST, TABLES, schema_of, stringified


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def nothing(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, so that the optimizer knows: joins with them go."""
    return spark.createDataFrame([], schema).limit(0)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV with header, all strings, blanks as ''; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("enforceSchema", False).csv(path).na.fill("")


#: CSV with a header; null is '', quotes are doubled, spaces stay.
CSV_WRITE = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """CSV with a header, even without rows; null is '', quotes are doubled, spaces stay."""
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def write_node_tables(tables: dict[str, DataFrame], folder: str, mode: str = "append") -> dict[str, int]:
    """Every table to its CSV; rows written per table."""
    from pyspark.sql import Observation

    counts = {}
    for name in TABLES:
        if name in tables:
            seen = Observation(name)
            rows = stringified(tables[name], name).observe(seen, F.count(F.lit(1)).alias("n"))
            write_csv(rows, f"{folder.rstrip('/')}/{CSV_NAMES[name]}", mode)
            counts[name] = seen.get["n"]
    return counts


def read_node_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: read_csv(spark, f"{folder.rstrip('/')}/{f}", schema_of(n)) for n, f in CSV_NAMES.items()}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's rows with `row`, their order in the file."""
    now = pointer(spark, path)["version"]
    rows = read_csv(spark, f"{path.rstrip('/')}/v={now}" if now else path, MANIFEST)
    return rows.withColumn("row", F.monotonically_increasing_id())


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One file sorted by name, as the next version of the manifest. A manifest has one row per archive.

    It is sorted and written in parts by all tasks; the driver then puts the parts' bytes one behind the other.
    """
    add_version(manifest, path, _write_sorted_file)


def _write_sorted_file(manifest: DataFrame, to: str) -> None:
    spark, aside = manifest.sparkSession, f"{to.rstrip('/')}-parts-{uuid.uuid4().hex[:8]}"
    ordered = manifest.select(*[f.name for f in MANIFEST])
    try:
        ordered.orderBy("filename").write.options(**{**CSV_WRITE, "header": False}).csv(aside)
        fs, p = _fs(spark, aside)
        parts = sorted((f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")), key=lambda x: x.getName())
        target = _fs(spark, f"{to.rstrip('/')}/part-00000.csv")[1]
        out = fs.create(target, True)
        try:
            out.writeBytes(",".join(ordered.columns) + "\n")
            for part in parts:
                body = fs.open(part)
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(body, out, 1 << 20, False)
                finally:
                    body.close()
        finally:
            out.close()
    finally:
        delete(spark, aside)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without one (as in tests) gets a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not named:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="gneiss-"))
            held = sc._jsc.sc().getCheckpointDir()
        named = held.get()
    return named.rstrip("/")


def set_aside(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, for plans that read it more than once."""
    path = f"{folder or shared_folder(df.sparkSession)}/gneiss-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._gneiss_path = path
    return back


def forget(df: DataFrame) -> None:
    """Delete what `set_aside` wrote."""
    if path := getattr(df, "_gneiss_path", None):
        delete(df.sparkSession, path)


#: Beside the folders v=1, v=2, ... of a table, the file that names the one that counts.
CURRENT = "_current"


def pointer(spark: SparkSession, path: str) -> dict:
    """What a table's pointer file says: version, and for a bucketed table the version of each bucket."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{CURRENT}")
    if not fs.exists(p):
        return {"version": 0, "buckets": {}, "old": []}
    stream = fs.open(p)
    try:
        return json.loads(stream.readLine())
    finally:
        stream.close()


def point_to(spark: SparkSession, path: str, said: dict) -> None:
    """Replace the pointer in one step: it is written aside and renamed over the old one."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{CURRENT}")
    aside = _fs(spark, f"{p.toString()}.{uuid.uuid4().hex[:8]}")[1]
    stream = fs.create(aside, True)
    try:
        stream.writeBytes(json.dumps(said) + "\n")
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(aside, p, options)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def add_version(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write a table's next version beside those that readers may hold, then point to it. The one before stays until the next."""
    spark, path = df.sparkSession, path.rstrip("/")
    now = pointer(spark, path)
    target = f"{path}/v={now['version'] + 1}"
    delete(spark, target)  # of a run that broke off
    write(df, target)
    point_to(spark, path, {"version": now["version"] + 1, "buckets": {}, "old": [f"v={now['version']}"]})
    for old in now["old"]:
        delete(spark, f"{path}/{old}")
    return target


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet table that df may itself read; readers see the old or the new one whole."""
    target = add_version(df, path, lambda d, to: d.write.parquet(to))
    return df.sparkSession.read.schema(df.schema).parquet(target)


def read_parquet(spark: SparkSession, path: str, schema: StructType, only: Iterable[int] | None = None) -> DataFrame:
    """A Parquet table as its pointer says, plain files if it has none, or an empty table. `only`: buckets of a bucketed one."""
    path, said = path.rstrip("/"), pointer(spark, path)
    if said["buckets"]:
        wanted = {str(b) for b in only} if only is not None else None
        at = [f"{path}/v={v}/bucket={b}" for b, v in said["buckets"].items() if wanted is None or b in wanted]
        return spark.read.schema(schema).parquet(*at) if at else nothing(spark, schema)
    at = f"{path}/v={said['version']}" if said["version"] else path
    return spark.read.schema(schema).parquet(at) if exists(spark, at) else nothing(spark, schema)


def merge_buckets(spark: SparkSession, path: str, schema: StructType, key: Sequence[str], news: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> int:
    """Set `news` over a table that lies in `buckets` parts by hash of its key: combine(old, new) of the parts that news touch.

    Other parts are neither read nor written. All parts change at once, by the pointer; those that were replaced stay until
    the next merge for readers that hold them. Returns how many parts were written. What the driver holds is one number per
    part.
    """
    path = path.rstrip("/")
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    aside = news if hasattr(news, "_gneiss_path") else set_aside(news, "news")
    touched = [r[0] for r in aside.select(bucket.alias("bucket")).distinct().collect()]
    if not touched:
        return 0
    now = pointer(spark, path)
    old = read_parquet(spark, path, schema, touched) if now["buckets"] else nothing(spark, schema)
    merged = combine(old, aside).withColumn("bucket", bucket)
    number = now["version"] + 1
    delete(spark, f"{path}/v={number}")
    # one file per part and task at most: rows of a part lie together, those of a large one in as many tasks as there are for it
    tasks = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
    share = F.pmod(F.shiftright(F.xxhash64(*key), 32), F.lit(tasks))
    merged.repartition("bucket", share).write.partitionBy("bucket").parquet(f"{path}/v={number}")
    replaced = [f"v={now['buckets'][str(b)]}/bucket={b}" for b in touched if str(b) in now["buckets"]]
    point_to(spark, path, {"version": number, "buckets": {**now["buckets"], **{str(b): number for b in touched}}, "old": replaced})
    for x in now["old"]:
        delete(spark, f"{path}/{x}")
    if aside is not news:
        forget(aside)
    return len(touched)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank lines, stripped, as source_id."""
    if not exists(spark, path):
        return spark.createDataFrame([], "source_id string")
    return spark.read.text(path).select(strip(F.col("value")).alias("source_id")).where("source_id <> ''").distinct()


def append_ids(ids: DataFrame, path: str) -> None:
    """Add ids that the list does not hold yet."""
    known = read_id_list(ids.sparkSession, path)
    new = ids.select(strip(F.col("source_id")).alias("source_id")).where("source_id <> ''").distinct().join(known, "source_id", "left_anti")
    new.select(F.col("source_id").alias("value")).write.mode("append").text(path)
