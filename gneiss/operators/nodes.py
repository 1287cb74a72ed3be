"""Node tables: projections and explodes of the parsed row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.schemas import SEQUENCE, TABLES, empty


def publications(parsed: DataFrame, *keep: str) -> DataFrame:
    r = F.col("root")
    ok = (r["country"] != "") & (r["doc_number"] != "") & (r["kind"] != "")
    return parsed.where(ok).select(
        T.publication_id(r["country"], r["doc_number"], r["kind"]).alias("pub_id"), r["country"].alias("country"), r["doc_number"].alias("pub_number"), r["kind"].alias("kind_code"), r["date_publ"].alias("publication_date"), r["lang"].alias("pub_language"), "source_id", *keep
    )


def applications(parsed: DataFrame, *keep: str) -> DataFrame:
    ident, a = F.col("root.id"), F.col("appl")
    country, number, kind = T.application_parts(ident)
    return parsed.where(ident != "").select(ident.alias("appln_id"), country.alias("appln_country"), number.alias("appln_number"), kind.alias("appln_kind_code"), a["filing_date"].alias("appln_filing_date"), a["gazette_date"].alias("gazette_date"), a["gazette_issue"].alias("gazette_issue"), "source_id", *keep)


def _codes(parsed: DataFrame, field: str, long, short, keep: tuple[str, ...]) -> DataFrame:
    raw = parsed.select(F.posexplode(field).alias("ordinal", "raw"), "source_id", *SEQUENCE)
    return raw.select(F.col("raw").alias(f"{field}_raw_code"), long(F.col("raw")).alias(f"{field}_long_code"), short(F.col("raw")).alias(f"{field}_short_code"), "source_id", *keep)


def ipc_codes(parsed: DataFrame, *keep: str) -> DataFrame:
    return _codes(parsed, "ipc", T.ipc_long, T.ipc_short, keep)


def cpc_codes(parsed: DataFrame, *keep: str) -> DataFrame:
    return _codes(parsed, "cpc", T.cpc_long, T.cpc_short, keep)


def _parties(parsed: DataFrame, field: str) -> DataFrame:
    return parsed.select(F.posexplode(field).alias("ordinal", "p"), "source_id", *SEQUENCE).where("p.name <> ''")


def applicants(parsed: DataFrame, *keep: str, keys: T.Keys = T.Keys()) -> DataFrame:
    p = F.col("p")
    return _parties(parsed, "applicants").select(
        keys.organisation(p["iid"], p["name"], p["ctry"]).alias("org_key"), p["name"].alias("applicant_name"), p["iid"].alias("applicant_epo_id"), p["irf"].alias("applicant_reference"), p["str"].alias("applicant_address"), p["city"].alias("applicant_city"), p["ctry"].alias("applicant_country"), "source_id", *keep
    )


def inventors(parsed: DataFrame, *keep: str, keys: T.Keys = T.Keys()) -> DataFrame:
    p = F.col("p")
    return _parties(parsed, "inventors").select(keys.inventor(p["name"], p["city"], p["ctry"]).alias("person_key"), p["name"].alias("inventor_name"), p["str"].alias("inventor_address"), p["city"].alias("inventor_city"), p["ctry"].alias("inventor_country"), "source_id", *keep)


def attorneys(parsed: DataFrame, *keep: str, keys: T.Keys = T.Keys()) -> DataFrame:
    p = F.col("p")
    return _parties(parsed, "attorneys").select(
        keys.attorney(p["iid"], p["name"], p["city"], p["ctry"]).alias("person_key"), p["name"].alias("attorney_name"), p["sfx"].alias("attorney_sfx"), p["iid"].alias("attorney_epo_id"), p["str"].alias("attorney_address"), p["city"].alias("attorney_city"), p["ctry"].alias("attorney_country"), "source_id", *keep
    )


def source_files(parsed: DataFrame, *keep: str) -> DataFrame:
    """Sources of valid publications, each once."""
    found = publications(parsed, *keep).where("source_id <> ''")
    return found.select("source_id", *keep).dropDuplicates(["source_id"]) if keep else found.select("source_id").distinct()


#: How each node table is made of parsed rows; a run may be given others (Config.extractors).
NODE_TABLES: dict[str, Callable[..., DataFrame]] = {"publication": publications, "application": applications, "ipc": ipc_codes, "cpc": cpc_codes, "applicant": applicants, "inventor": inventors, "attorney": attorneys, "source_file": source_files}
#: Tables with several rows per document, which have an ordinal.
REPEATED = ("ipc", "cpc", "applicant", "inventor", "attorney")
#: Tables of parties, which have keys.
KEYED = ("applicant", "inventor", "attorney")


def node_tables(parsed: DataFrame, *, ordered: bool = False, keys: T.Keys = T.Keys(), extractors: Mapping[str, Callable[..., DataFrame]] | None = None) -> dict[str, DataFrame]:
    """All node tables; `ordered` keeps the columns that say which row is the later one.

    `extractors` replaces how tables of some names are made: a function of the parsed rows and the names of further
    columns to keep, for repeated tables among them `ordinal`.
    """
    out = {}
    for name, make in {**NODE_TABLES, **(extractors or {})}.items():
        if name in KEYED and make is NODE_TABLES[name]:
            make = partial(make, keys=keys)
        keep = (*SEQUENCE, "ordinal") if name in REPEATED else SEQUENCE
        rows = make(parsed, *(keep if ordered else ()))
        out[name] = rows.withColumn("ordinal", F.lit(0)) if ordered and name not in REPEATED else rows if ordered else rows.select(*TABLES[name])
    if not ordered:
        out["citation"] = empty(parsed.sparkSession, "citation")
    return out
