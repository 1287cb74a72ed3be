"""Ingest as data: metadata to archive references, and the state of each archive from what is on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.text import archive_kind, size_or_null

# Names under which a field may come.
DELIVERY_ID = ("id", "deliveryId", "delivery_id", "uuid")
FILE_ID = ("id", "fileId", "file_id", "uuid")
FILE_NAME = ("name", "fileName", "filename", "originalName")
FILE_SIZE = ("size", "fileSize", "expectedSize", "expected_size")


def first_field(obj: Column, names: tuple[str, ...]) -> Column:
    """The first of the names that is there and not null, as a string; blank and 0 count."""
    return F.coalesce(*[F.get_json_object(obj, f"$.{n}") for n in names])


def archive_refs(metadata: DataFrame, column: str = "metadata") -> DataFrame:
    """(delivery_id, file_id, filename, expected_size) of product metadata given as JSON text.

    Deliveries and files that are no objects, lack ids or names, or lists that are no lists give nothing.
    """
    items = "array<string>"
    deliveries = metadata.select(F.explode(F.from_json(F.get_json_object(column, "$.deliveries"), items)).alias("d")).where(F.col("d").startswith("{"))
    files = deliveries.select(first_field(F.col("d"), DELIVERY_ID).alias("delivery_id"), F.explode(F.from_json(F.get_json_object("d", "$.files"), items)).alias("f")).where(F.col("f").startswith("{") & F.col("delivery_id").isNotNull())
    f = F.col("f")
    return files.select("delivery_id", first_field(f, FILE_ID).alias("file_id"), first_field(f, FILE_NAME).alias("filename"), size_or_null(first_field(f, FILE_SIZE)).alias("expected_size")).where("file_id is not null and filename is not null")


def paths(raw_dir: str, staging_dir: str, final_dir: str, filename: Column) -> tuple[Column, Column, Column]:
    return tuple(F.concat(F.lit(d.rstrip("/") + "/"), filename) for d in (raw_dir, staging_dir, final_dir))


def ingest_state(filename: Column, final_ok: Column, staging_ok: Column, raw_ok: Column, download_ok: Column, filter_ok: Column, kept: Column, move_ok: Column) -> Column:
    """struct(status, action) of one pass over an archive; the first rule that fits counts.

    raw_ok, staging_ok and final_ok: the file is there and valid. download_ok, filter_ok, move_ok: the step works if it
    is taken. kept: the filter keeps anything.
    """

    def end(status: str, action: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(action).alias("action"))

    moved = F.when(move_ok, end("moved", "move")).otherwise(end("failed", "move"))
    return (
        F.when(archive_kind(filename).isNull(), end("skipped", "none"))
        .when(final_ok, end("moved", "clean"))
        .when(staging_ok, moved)
        .when(~raw_ok & ~download_ok, end("failed", "download"))
        .when(~filter_ok, end("failed", "filter"))
        .when(~kept, end("empty", "none"))
        .otherwise(moved)
    )
