"""The ingest run: each archive is downloaded, filtered and moved by one task, and told as a manifest row."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.ingest import archive_refs
from gneiss.operators.status import manifest_rows, set_manifest
from gneiss.schemas import MANIFEST
from gneiss.sources.archives import filter_file, kind_of
from gneiss.sources.http import Validator, archive_url, download, get_json, is_good, metadata_url, move, put, validators_for
from gneiss.sources.tables import read_manifest, write_manifest


@dataclass(frozen=True)
class IngestConfig:
    """Folders (on a store that all executors mount) and rules of one product's ingest."""

    base_url: str
    product_id: str
    raw_dir: str
    staging_dir: str
    final_dir: str
    prefix: str = "ep"
    strict: bool = True
    manifest: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    clock: Callable[[], float] = time.time
    validators: Callable[[str], tuple[Validator, ...]] = validators_for
    mover: Callable[[Path, Path], None] = move

    @property
    def manifest_path(self) -> str:
        return self.manifest or f"{self.final_dir.rstrip('/')}/_manifest.csv"


def ingest_one(delivery_id: str, file_id: str, filename: str, expected_size: int | None, cfg: IngestConfig) -> dict[str, str]:
    """Bring one archive as far as it gets; what was done in an earlier run is found on disk and not done again."""
    raw, staging, final = (Path(d, filename) for d in (cfg.raw_dir, cfg.staging_dir, cfg.final_dir))
    nothing_in = staging.with_name(filename + ".empty")

    def size(p: Path) -> str:
        return str(p.stat().st_size) if p.is_file() else ""

    def told(status: str, message: str = "") -> dict[str, str]:
        return {"filename": filename, "status": status, "timestamp": str(int(cfg.clock())), "raw_size": size(raw), "filtered_size": size(staging), "final_size": size(final), "message": message}

    def clean() -> None:
        for p in (raw, staging, raw.with_name(filename + ".part"), staging.with_name(filename + ".part")):
            with suppress(FileNotFoundError):
                p.unlink()

    def finish(message: str = "") -> dict[str, str]:
        try:
            cfg.mover(staging, final)
        except OSError as e:
            return told("failed", f"move: {e}")
        clean()
        return told("moved", message)

    if kind_of(filename) is None:
        return told("skipped", "unsupported archive")
    checks = cfg.validators(filename)
    if is_good(final, checks):
        clean()
        return told("moved")
    if is_good(staging, checks):
        return finish()
    if nothing_in.exists():
        return told("empty")
    if not is_good(raw, checks):
        try:
            download(archive_url(cfg.base_url, cfg.product_id, delivery_id, file_id), raw, headers=cfg.headers, expected_size=expected_size, validators=checks)
        except Exception as e:  # any failure of the net or the disk becomes a row
            return told("failed", f"download: {type(e).__name__}: {e}")
    try:
        kept = filter_file(raw, staging, prefix=cfg.prefix, strict=cfg.strict, validators=checks)
        if not kept.anything:
            put(nothing_in, b"")
    except Exception as e:
        return told("failed", f"filter: {type(e).__name__}: {e}")
    seen = f"xml {kept.xml}, nested {kept.nested_kept} of {kept.nested_seen}"
    return finish(seen) if kept.anything else told("empty", seen)


def run_ingest(refs: DataFrame, cfg: IngestConfig, tasks: int | None = None) -> DataFrame:
    """Manifest rows of all refs (delivery_id, file_id, filename, expected_size), each file once, spread over tasks."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [ingest_one(r.delivery_id, r.file_id, r.filename, None if pd.isna(r.expected_size) else int(r.expected_size), cfg) for r in pdf.itertuples()]
            yield pd.DataFrame(rows, columns=[f.name for f in MANIFEST])

    one = refs.dropDuplicates(["filename"])
    return one.repartition(tasks or refs.sparkSession.sparkContext.defaultParallelism, "filename").mapInPandas(work, MANIFEST)


def ingest(spark: SparkSession, cfg: IngestConfig, metadata: object | None = None, tasks: int | None = None) -> dict[str, int]:
    """One product's ingest: metadata, references, archives, manifest. Returns archives found and archives per status.

    Rows of the manifest are replaced as a whole by those of this run and stay for archives that are no longer listed. The
    rows are few, one per archive. `metadata` of None is fetched from the product's URL; HTTP errors are raised.
    """
    said = get_json(metadata_url(cfg.base_url, cfg.product_id), cfg.headers) if metadata is None else metadata
    refs = archive_refs(spark.createDataFrame([(json.dumps(said),)], "metadata string"))
    rows = [tuple(r) for r in run_ingest(refs, cfg, tasks).collect()]
    done = spark.createDataFrame(rows, MANIFEST)
    known = manifest_rows(read_manifest(spark, cfg.manifest_path), ["row"])
    write_manifest(set_manifest(known, done), cfg.manifest_path)
    out = {"archives": len(rows)}
    for r in done.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r["status"]] = r["n"]
    return out
