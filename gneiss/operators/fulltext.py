"""Full text per publication and language."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.text import blank_to_null, claim_label, publication_id
from gneiss.operators.graph import merge
from gneiss.schemas import FULLTEXT, SEQUENCE


def abstract_text(lang: Column) -> Column:
    """Text of the first abstract that is of the language or of none, even if that text is empty (null then)."""
    fits = F.filter("abstracts", lambda a: (a["lang"] == "") | (a["lang"] == lang))
    return blank_to_null(F.get(fits, F.lit(0))["text"])


def description_text() -> Column:
    """The paragraphs, parted by blank lines, or else all text; in any language."""
    return F.coalesce(blank_to_null(F.array_join("description.paragraphs", "\n\n")), blank_to_null(F.col("description.flat")))


def claims_of(lang: Column) -> Column:
    """All non-empty claims of the blocks of exactly that language, in order."""
    of_lang = F.filter("claims", lambda b: b["lang"] == lang)
    return F.filter(F.flatten(F.transform(of_lang, lambda b: b["claims"])), lambda c: c["text"] != "")


def claims_text(claims: Column) -> Column:
    return blank_to_null(F.array_join(F.transform(claims, lambda c: claim_label(c["num"], c["text"])), "\n\n"))


def claims_json(claims: Column) -> Column:
    return F.when(F.size(claims) > 0, F.to_json(claims))


def fulltext(parsed: DataFrame, languages: Sequence[str] = ("en",), *, ordered: bool = False) -> DataFrame:
    """One record per valid publication and language that has any section."""
    if not languages:
        raise ValueError("at least one language is needed")
    r = F.col("root")
    rows = parsed.where((r["country"] != "") & (r["doc_number"] != "") & (r["kind"] != "")).withColumn("lang", F.explode(F.array(*[F.lit(x) for x in languages])))
    c = claims_of(F.col("lang"))
    rows = rows.select("source_id", r["id"].alias("appln_id"), publication_id(r["country"], r["doc_number"], r["kind"]).alias("pub_id"), "lang", abstract_text(F.col("lang")).alias("abstract_text"), description_text().alias("description_text"), claims_text(c).alias("claims_text"), claims_json(c).alias("claims_json"), *(SEQUENCE if ordered else ()))
    return rows.where("abstract_text is not null or description_text is not null or claims_text is not null")


def collapse_batch(records: DataFrame, order: Sequence[str] = SEQUENCE) -> DataFrame:
    """Records of one batch, one per (pub_id, lang): the last one's values, but the first one's appln_id."""
    at = F.struct(*order)
    rest = [f.name for f in FULLTEXT if f.name not in ("pub_id", "lang", "appln_id")]
    one = records.groupBy("pub_id", "lang").agg(F.min_by("appln_id", at).alias("appln_id"), F.max_by(F.struct(*rest), at).alias("r"))
    return one.select(*[F.col(f"r.{f.name}").alias(f.name) if f.name in rest else F.col(f.name) for f in FULLTEXT])


def upsert(target: DataFrame, batch: DataFrame) -> DataFrame:
    """target with a collapsed batch set over it; a record that was there keeps its appln_id."""
    return merge(target, batch, ["pub_id", "lang"], keep=("appln_id",))
