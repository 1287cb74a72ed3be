"""The same dataflow fed by a file stream: each trigger takes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.plans.pipelines import Config, build_graph, export
from gneiss.sources.archives import ARCHIVES, DOCUMENTS, _rows


def archive_stream(spark: SparkSession, folder: str, *, doc_only: bool = True, prefix: str = "", files_per_trigger: int = 64, mounted: bool = False) -> DataFrame:
    """Documents of archives as they arrive in a folder; a broken archive is a row with its error. With `mounted`,
    archives of any size are opened by path, for which executors must mount the folder; else each is one binary cell."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long").option("pathGlobFilter", ARCHIVES).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    opts = {"doc_only": doc_only, "prefix": prefix}
    return files.select("path", F.lit(None).cast("binary").alias("content")).mapInArrow(lambda it: _rows(it, opts), DOCUMENTS) if mounted else _content(spark, folder, files_per_trigger).mapInArrow(lambda it: _rows(it, opts), DOCUMENTS)


def _content(spark: SparkSession, folder: str, files_per_trigger: int) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", ARCHIVES).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return files.select("path", "content")


def run_available(spark: SparkSession, folder: str, cfg: Config, checkpoint: str, *, doc_only: bool = True, prefix: str = "", mounted: bool = False) -> int:
    """Take all archives that have come since the last call and return how many batches that took.

    A batch writes under its own number, so one that is repeated after a failure replaces itself; the status table keeps
    documents from being done twice.
    """
    seen = []

    def one(batch: DataFrame, batch_id: int) -> None:
        export(batch.sparkSession, batch.select("source_id", "member_path", "xml", "error"), cfg, batch_id)
        build_graph(batch.sparkSession, cfg, "incremental")
        seen.append(batch_id)

    stream = archive_stream(spark, folder, doc_only=doc_only, prefix=prefix, mounted=mounted)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(seen)
