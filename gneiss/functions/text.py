"""Scalar functions: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends; null is ''."""
    plain = F.ascii(F.substring(c, 1, 1)).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)  # nothing to strip, as nearly always
    return F.when(plain, c).otherwise(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def collapse(c: Column) -> Column:
    """Runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)(\S+)"), F.lit(1))


def _first(parts: Column) -> Column:
    return F.coalesce(F.get(parts, F.lit(0)), F.lit(""))


def _first_two(raw: Column) -> Column:
    return F.rtrim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?Us)^\s*+(\S*+)\s*+(\S*+).*+$", "$1 $2"))


def ipc_long(raw: Column) -> Column:
    """The first two tokens."""
    return _first_two(raw)


def ipc_short(raw: Column) -> Column:
    """The first token."""
    return _first(tokens(raw))


def cpc_long(raw: Column) -> Column:
    """The first token; the first two if there are four or more."""
    two = _first_two(raw)
    return F.when(F.coalesce(raw, F.lit("")).rlike(r"(?U)^\s*+(?:\S++\s++){3}\S"), two).otherwise(F.substring_index(two, " ", 1))


def cpc_short(raw: Column) -> Column:
    return F.substring(cpc_long(raw), 1, 4)


def organisation_key(epo_id: Column, name: Column, country: Column) -> Column:
    return F.coalesce(blank_to_null(strip(epo_id)), F.concat(F.lit("NAME:"), strip_lower(name), F.lit("|CC:"), strip(country)))


def inventor_key(name: Column, city: Column, country: Column) -> Column:
    return F.concat(F.lit("INV:"), strip_lower(name), F.lit("|CITY:"), strip_lower(city), F.lit("|CC:"), strip(country))


def attorney_key(epo_id: Column, name: Column, city: Column, country: Column) -> Column:
    return F.coalesce(blank_to_null(strip(epo_id)), F.concat(F.lit("ATT:"), strip_lower(name), F.lit("|CITY:"), strip_lower(city), F.lit("|CC:"), strip(country)))


@dataclass(frozen=True)
class Keys:
    """How parties are keyed; tables, edges and vertices of a run must be made with the same."""

    organisation: Callable[[Column, Column, Column], Column] = organisation_key
    inventor: Callable[[Column, Column, Column], Column] = inventor_key
    attorney: Callable[[Column, Column, Column, Column], Column] = attorney_key


def application_parts(ident: Column) -> tuple[Column, Column, Column]:
    """Country, number and kind of an application id."""
    return F.substring(ident, 1, 2), F.substring(ident, 3, 8), F.substring(ident, 11, 1_000_000)


def publication_id(country: Column, number: Column, kind: Column) -> Column:
    return F.concat(country, number, kind)


def claim_label(num: Column, text: Column) -> Column:
    return F.when(num != "", F.concat(num, F.lit(". "), text)).otherwise(text)


def cut(c: Column, limit: int) -> Column:
    return F.substring(c, 1, limit)


def error_text(c: Column, limit: int = 2000) -> Column:
    return cut(F.coalesce(c, F.lit("")), limit)


def context_text(c: Column, limit: int = 2000) -> Column:
    return blank_to_null(cut(strip(c), limit))


def safe_source_id(c: Column, reason: Column) -> Column:
    """The id, or a made-up one that tells what was wrong with it."""
    return F.coalesce(blank_to_null(strip(c)), F.concat(F.lit("__invalid_source_id__:"), error_text(reason, 300)))


def size_or_null(c: Column) -> Column:
    """A whole number given as number or digits, else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def csv_list(c: Column) -> Column:
    """Items of a comma list, stripped, without blank ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda x: x != "")


def archive_kind(path: Column) -> Column:
    """zip, tar, tar.gz or null, by the name's end whatever its case."""
    p = F.lower(path)
    return F.when(p.endswith(".zip"), "zip").when(p.endswith(".tar.gz") | p.endswith(".tgz"), "tar.gz").when(p.endswith(".tar"), "tar")


def tar_mode(path: Column) -> Column:
    return F.when(archive_kind(path) == "tar.gz", "r:gz").when(archive_kind(path) == "tar", "r:")


def keeps_xml(path: Column, prefix: str = "ep", extension: str = ".xml") -> Column:
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return name.endswith(extension.lower()) & name.startswith(prefix.lower())


def under_doc(path: Column) -> Column:
    return F.concat(F.lit("/"), F.regexp_replace(path, r"^[./]+", "")).contains("/DOC/")


def download_url(base: str, delivery: Column, file: Column) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.lit("delivery"), delivery, F.lit("file"), file, F.lit("download"))


def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
