"""What was done: document status, loaded sources, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.text import context_text, error_text, safe_source_id
from gneiss.operators.graph import last_rows
from gneiss.schemas import MANIFEST, MANIFEST_STATES, STATUS


def done_rows(documents: DataFrame) -> DataFrame:
    return documents.select("source_id", F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("context"))


def failed_rows(failures: DataFrame, context: Column | None = None) -> DataFrame:
    """(source_id, error) as status rows: never without an id or an error, both cut to size."""
    return failures.select(safe_source_id(F.col("source_id"), F.lit("source_id is empty/blank (expected a non-empty string)")).alias("source_id"), F.lit("failed").alias("status"), error_text(F.col("error")).alias("error"), context_text(context if context is not None else F.lit(None).cast("string")).alias("context"))


def latest_status(log: DataFrame, order: list[str]) -> DataFrame:
    """The status log's last row per source."""
    return last_rows(log, "source_id", order).select(*[f.name for f in STATUS])


def pending(documents: DataFrame, status: DataFrame) -> DataFrame:
    """Documents not yet done; failed ones come again."""
    return documents.join(status.where("status = 'done'").select("source_id").distinct(), "source_id", "left_anti")


def pending_of_many(documents: DataFrame, status: DataFrame) -> DataFrame:
    """`pending` for wide documents: ids that are too many to be sent to all tasks are hashed, and no documents sorted."""
    from gneiss.sources.tables import set_aside

    done = set_aside(status.where("status = 'done'").select("source_id").distinct(), "done")
    n = done.count()
    if not n:
        return documents
    return documents.join(done.hint("shuffle_hash") if n > 100_000 else done, "source_id", "left_anti")


def invalid_source_ids(rows: DataFrame) -> DataFrame:
    from gneiss.functions.text import strip

    return rows.where(strip(F.col("source_id")) == "")


def add_ids(known: DataFrame, more: DataFrame) -> DataFrame:
    """Ids to append to an insert-or-ignore list."""
    return more.select("source_id").distinct().join(known.select("source_id"), "source_id", "left_anti")


def manifest_rows(raw: DataFrame, order: list[str]) -> DataFrame:
    """A manifest as it counts: trimmed, defaults for missing columns, no blank names, the last row per file."""
    cols = [f.name for f in MANIFEST]
    clean = raw.select(*[(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in raw.columns else F.lit("")).alias(c) for c in cols], *order)
    return last_rows(clean.where("filename <> ''"), "filename", order).select(*cols)


def unknown_states(manifest: DataFrame) -> DataFrame:
    return manifest.where(~F.col("status").isin(*MANIFEST_STATES))


def set_manifest(manifest: DataFrame, changes: DataFrame) -> DataFrame:
    """changes (one row per file) replace whole rows; sorted by name when written."""
    from gneiss.operators.graph import merge

    return merge(manifest, changes, ["filename"])
