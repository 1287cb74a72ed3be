"""python -m gneiss --mode initial|weekly [--stage ingest|graph|fulltext|load ...] --archives-dir D | --xml-dir D | --base-url U --product-id P

Without --stage all stages run that have what they need: the ingest only with --base-url. Arguments win over the
environment, that over defaults.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
import time
from functools import partial

from pyspark.sql import SparkSession

from gneiss.plans.ingest import IngestConfig, ingest
from gneiss.plans.pipelines import STAGES, STEPS, Config, build_graph, languages_of, run
from gneiss.sources.archives import read_archives, read_xml_files


def sqlite(path: str):
    """A connection to an SQLite file."""
    import sqlite3

    return sqlite3.connect(path, timeout=60)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """Arguments win over the environment, that over defaults."""
    env = os.environ.get
    p = argparse.ArgumentParser(prog="gneiss")
    p.add_argument("--mode", choices=("initial", "weekly"), default="initial")
    p.add_argument("--stage", action="append", choices=STAGES, help="may be given more than once")
    source = p.add_mutually_exclusive_group()
    source.add_argument("--archives-dir")
    source.add_argument("--xml-dir")
    p.add_argument("--output-dir", default=env("PIPELINE_OUTPUT_DIR"))
    p.add_argument("--csv-dir", default=env("PIPELINE_CSV_DIR"))
    p.add_argument("--log-dir", default=env("PIPELINE_LOG_DIR"))
    p.add_argument("--languages", default=env("PIPELINE_LANGS"))
    p.add_argument("--xml-prefix", default=None)
    p.add_argument("--batch-id", type=int, default=0)
    p.add_argument("--batch-size", type=int, default=500)
    p.add_argument("--stop-after", type=int)
    p.add_argument("--fail-fast", action="store_true")
    p.add_argument("--strict", action="store_true", help="fail documents as the strict profile does and use no label aliases")
    p.add_argument("--step", choices=STEPS, default="all", help="of the stage load")
    p.add_argument("--sqlite", default=env("PIPELINE_SQLITE"), help="an SQLite file that full text goes to as well")
    i = p.add_argument_group("ingest")
    i.add_argument("--base-url", default=env("PIPELINE_BASE_URL"))
    i.add_argument("--product-id", default=env("PIPELINE_PRODUCT_ID"))
    i.add_argument("--raw-dir", default=env("PIPELINE_RAW_DIR", "data/raw"))
    i.add_argument("--staging-dir", default=env("PIPELINE_STAGING_DIR", "data/staging"))
    i.add_argument("--final-dir", default=env("PIPELINE_FINAL_DIR", "data/final"))
    i.add_argument("--manifest-path")
    i.add_argument("--non-strict", action="store_true", help="archives that cannot be filtered keep nothing instead of failing")
    a = p.parse_args(argv)
    if not a.output_dir:
        p.error("--output-dir or PIPELINE_OUTPUT_DIR is needed")
    if a.stage is None:
        a.stage = [s for s in STAGES if s != "ingest" or a.base_url]
    if "ingest" in a.stage:
        if not a.base_url or not a.product_id:
            p.error("the ingest needs --base-url and --product-id")
        if a.xml_dir:
            p.error("the ingest gives archives, not --xml-dir")
        a.archives_dir = a.archives_dir or a.final_dir
    if {"graph", "fulltext"} & set(a.stage) and not (a.archives_dir or a.xml_dir):
        p.error("--archives-dir, --xml-dir or an ingest is needed")
    return a


def log_to(folder: str | None) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if folder:
        os.makedirs(folder, exist_ok=True)
        handlers.append(logging.FileHandler(os.path.join(folder, time.strftime("pipeline_%Y%m%d_%H%M%S.log")), encoding="utf-8"))
    own = logging.getLogger("gneiss")
    own.setLevel(logging.INFO)
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(name)s | %(message)s"))
        own.addHandler(h)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    log_to(a.log_dir)
    spark = SparkSession.builder.appName("gneiss").getOrCreate()
    cfg = Config(a.output_dir, languages_of(a.languages), a.strict, a.strict, not a.strict, a.fail_fast, a.stop_after, a.csv_dir, a.batch_size, connect=partial(sqlite, a.sqlite) if a.sqlite else None)

    def documents():
        return read_archives(spark, a.archives_dir, prefix=a.xml_prefix or "") if a.archives_dir else read_xml_files(spark, a.xml_dir)

    def before():
        prefix = "ep" if a.xml_prefix is None else a.xml_prefix
        said = ingest(spark, IngestConfig(a.base_url, a.product_id, a.raw_dir, a.staging_dir, a.final_dir, prefix, not a.non_strict, a.manifest_path))
        return {f"archives_{k}" if k != "archives" else k: n for k, n in said.items()}, documents()

    try:
        if a.stage == ["load"]:
            counts = build_graph(spark, cfg, "bulk" if a.mode == "initial" else "incremental", a.step)
        else:
            exports = {"graph", "fulltext"} & set(a.stage)
            counts = run(spark, documents() if exports and "ingest" not in a.stage else None, cfg, a.mode, a.batch_id, stages=a.stage, before=before if "ingest" in a.stage else None)
    except Exception as e:
        logging.getLogger("gneiss").error("run ended: %s: %s", type(e).__name__, e)
        return 1
    for name, n in counts.items():
        print(f"{name}\t{n}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
