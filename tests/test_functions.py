"""Scalar functions against their definitions in Python."""

import pytest
from pyspark.sql import functions as F

from gneiss.functions import text as T

NBSP = chr(0xA0)


def value(spark, column, **given):
    row = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given)) if given else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw", [None, "", " a ", f"{NBSP}a\t b{NBSP}\n", "\n\n", "İß Σ"])
def test_strip(spark, raw):
    assert value(spark, T.strip(F.col("a")), a=raw) == (raw or "").strip()
    assert value(spark, T.collapse(F.col("a")), a=raw) == " ".join((raw or "").split())


@pytest.mark.parametrize("raw,long,short", [("", "", ""), ("  ", "", ""), ("G16B", "G16B", "G16B"), ("G16B  15/00", "G16B 15/00", "G16B"), (" G16B  15/00   2019 X", "G16B 15/00", "G16B"), (None, "", "")])
def test_ipc(spark, raw, long, short):
    assert (value(spark, T.ipc_long(F.col("a")), a=raw), value(spark, T.ipc_short(F.col("a")), a=raw)) == (long, short)


@pytest.mark.parametrize("raw,long,short", [("", "", ""), ("G16B", "G16B", "G16B"), ("G16B15 00", "G16B15", "G16B"), ("A61K 9/00 2013", "A61K", "A61K"), ("A61K 9/00 2013 L", "A61K 9/00", "A61K"), (None, "", "")])
def test_cpc(spark, raw, long, short):
    assert (value(spark, T.cpc_long(F.col("a")), a=raw), value(spark, T.cpc_short(F.col("a")), a=raw)) == (long, short)


def test_keys(spark):
    a, b, c, d = map(F.col, "abcd")
    assert value(spark, T.organisation_key(a, b, c), a=" 7 ", b="N", c="DE") == "7"
    assert value(spark, T.organisation_key(a, b, c), a=" ", b=" Acme GmbH ", c=" De") == "NAME:acme gmbh|CC:De"
    assert value(spark, T.inventor_key(b, c, d), b="Ann B", c=None, d="FR") == "INV:ann b|CITY:|CC:FR"
    assert value(spark, T.attorney_key(a, b, c, d), a=None, b="Ann", c="PARIS", d="FR") == "ATT:ann|CITY:paris|CC:FR"


@pytest.mark.parametrize("ident", ["", "E", "EP", "EP12345678A1", "EP123"])
def test_application_parts(spark, ident):
    assert tuple(value(spark, p, a=ident) for p in T.application_parts(F.col("a"))) == (ident[:2], ident[2:10], ident[10:])


def test_status_texts(spark):
    a, b = F.col("a"), F.col("b")
    assert len(value(spark, T.error_text(a), a="x" * 5000)) == 2000 and value(spark, T.error_text(a), a=None) == ""
    assert value(spark, T.context_text(a), a="  ") is None and value(spark, T.context_text(a), a=" c ") == "c"
    assert value(spark, T.safe_source_id(a, b), a=" s ", b="e") == "s"
    assert value(spark, T.safe_source_id(a, b), a=" ", b="e" * 400) == "__invalid_source_id__:" + "e" * 300


def test_small_ones(spark):
    a = F.col("a")
    assert [value(spark, T.size_or_null(a), a=x) for x in ("12", "1.5", "-3", "", None, "x")] == [12, None, None, None, None, None]
    assert value(spark, T.csv_list(a), a=" en, ,de ,") == ["en", "de"] and value(spark, T.csv_list(a), a=None) == []
    assert value(spark, T.claim_label(a, F.lit("t")), a="3") == "3. t" and value(spark, T.claim_label(a, F.lit("t")), a="") == "t"
    assert value(spark, T.download_url("http://h/", F.lit("d"), a), a="f") == "http://h/delivery/d/file/f/download"


@pytest.mark.parametrize("name,kind,mode", [("a.zip", "zip", None), ("A.ZIP", "zip", None), ("a.tar", "tar", "r:"), ("a.Tar.gz", "tar.gz", "r:gz"), ("a.tgz", "tar.gz", "r:gz"), ("a.gz", None, None), ("zip", None, None)])
def test_archive_names(spark, name, kind, mode):
    assert value(spark, T.archive_kind(F.col("a")), a=name) == kind and value(spark, T.tar_mode(F.col("a")), a=name) == mode


@pytest.mark.parametrize("path,prefix,keep", [("DOC/EP1.xml", "ep", True), ("x/ep.XML", "EP", True), ("EP/us.xml", "ep", False), ("ep.txt", "ep", False), ("any.xml", "", True)])
def test_keeps_xml(spark, path, prefix, keep):
    from gneiss.sources.archives import wanted

    assert value(spark, T.keeps_xml(F.col("a"), prefix), a=path) == keep == wanted(path, prefix)


@pytest.mark.parametrize("path,under", [("DOC/a", True), ("./DOC/a", True), ("../x/DOC/a", True), ("doc/a", False), ("DOCX/a", False), ("xDOC/a", False), ("a/DOC", False)])
def test_under_doc(spark, path, under):
    from gneiss.sources.archives import in_doc

    assert value(spark, T.under_doc(F.col("a")), a=path) == under == in_doc(path)
