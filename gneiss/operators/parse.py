"""The one step outside the JVM: XML bytes to a typed nested row, once per document, errors as data."""

from __future__ import annotations

import ctypes
import gc
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import repeat
from xml.parsers import expat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gneiss.functions.text import cut
from gneiss.schemas import PARSED

SPACE = re.compile(r"\s+")


def qualified(namespace: str | None, tag: str) -> str:
    """A tag as the parser names it in a namespace."""
    return f"{{{namespace}}}{tag}" if namespace else tag


def own_text(node: ET.Element | None, path: str, namespaces: dict[str, str] | None = None) -> str:
    """Stripped text before the first child of the first match; prefixes of the path are looked up in `namespaces`."""
    hit = None if node is None else node.find(path, namespaces)
    return (hit.text or "").strip() if hit is not None else ""


def all_text(node: ET.Element) -> str:
    """All text below a node, white space collapsed."""
    return SPACE.sub(" ", "".join(node.itertext())).strip()


def attribute(node: ET.Element, name: str) -> str:
    return (node.get(name) or "").strip()


def down(node: ET.Element | None, *steps: str) -> ET.Element | None:
    """Follow the first child of each name only."""
    for step in steps:
        node = None if node is None else node.find(step)
    return node


def _first_text(node: ET.Element, *steps: str) -> str:
    """As `own_text` of the steps joined by slashes, without a path to take apart for every element."""
    *above, last = steps
    for step in above:
        for child in node.findall(step):
            if child.find(last) is not None:
                node = child
                break
        else:
            return ""
    hit = node.find(last)
    return (hit.text or "").strip() if hit is not None else ""


def _codes(root: ET.Element, group: str, tag: str) -> list[str]:
    at = down(root, "SDOBI", "B500", group)
    return [] if at is None else [(hit.text or "").strip() for e in at.iter(tag) if (hit := e.find("text")) is not None]


def _parties(root: ET.Element, group: str, tag: str, **fields: str) -> list[dict]:
    at = down(root, "SDOBI", "B700", group)
    wanted = [(k, p.split("/")) for k, p in {"name": "snm", **fields, "str": "adr/str", "city": "adr/city", "ctry": "adr/ctry"}.items()]
    return [] if at is None else [{k: _first_text(e, *steps) for k, steps in wanted} for e in at.iter(tag)]


def _application(root: ET.Element) -> dict:
    b220, b405 = down(root, "SDOBI", "B200", "B220"), down(root, "SDOBI", "B400", "B405")
    return {"has_b220": b220 is not None, "has_b405": b405 is not None, "filing_date": own_text(b220, "date"), "gazette_date": own_text(b405, "date"), "gazette_issue": own_text(b405, "bnum")}


def _description(root: ET.Element) -> dict | None:
    at = root.find("description")
    return None if at is None else {"paragraphs": [t for p in at.findall("p") if (t := all_text(p))], "flat": all_text(at)}


#: Attributes of the root that a parsed row keeps.
ROOT = ("country", "doc_number", "kind", "date_publ", "lang", "id")

#: How each nested field of a parsed row is made.
FIELDS: dict[str, Callable[[ET.Element], object]] = {
    "root": lambda root: {k: attribute(root, k.replace("_", "-")) for k in ROOT},
    "appl": _application,
    "ipc": lambda root: _codes(root, "B510EP", "classification-ipcr"),
    "cpc": lambda root: _codes(root, "B520EP", "classification-cpc"),
    "applicants": lambda root: _parties(root, "B710", "B711", iid="iid", irf="irf"),
    "inventors": lambda root: _parties(root, "B720", "B721"),
    "attorneys": lambda root: _parties(root, "B740", "B741", sfx="sfx", iid="iid"),
    "abstracts": lambda root: [{"lang": attribute(e, "lang"), "text": all_text(e)} for e in root.iterfind(".//abstract")],
    "description": _description,
    "claims": lambda root: [{"lang": e.get("lang"), "claims": [{"id": attribute(c, "id"), "num": attribute(c, "num"), "text": all_text(c)} for c in e.findall("claim")]} for e in root.findall("claims")],
}


def parse_document(xml: bytes | None, fields: Iterable[str] = tuple(FIELDS)) -> dict:
    root = ET.fromstring(xml or b"")
    return {name: FIELDS[name](root) for name in fields}


#: Rows and bytes of XML that are parsed before their results leave Python.
CHUNK_ROWS, CHUNK_BYTES = 500, 4 << 20


@cache
def _trim() -> Callable[[int], int]:
    try:
        trim = ctypes.CDLL("libc.so.6").malloc_trim
        trim(0)
        return trim
    except (OSError, AttributeError):
        return lambda _: 0


def _root_only(xml: bytes) -> dict | None:
    """The root's attributes of well-formed XML, without a tree; None if a tree must tell (a DTD, or anything broken)."""
    seen: list[dict] = []
    odd: list[bool] = []
    reader = expat.ParserCreate(namespace_separator="}")

    def start(_: str, attributes: dict) -> None:
        seen.append(attributes)
        reader.StartElementHandler = None

    reader.StartElementHandler = start
    reader.StartDoctypeDeclHandler = lambda *_: odd.append(True)
    try:
        reader.Parse(xml, True)
    except (expat.ExpatError, ValueError, LookupError):
        return None
    return None if odd or not seen else {"root": {k: (seen[0].get(k.replace("_", "-")) or "").strip() for k in ROOT}}


def _chunks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded rows and, but for single long ones, bytes of XML."""
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(b.column(3)).to_pylist()):
        if i > start and (i - start >= CHUNK_ROWS or size + (n or 0) > CHUNK_BYTES):
            yield b.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if b.num_rows > start:
        yield b.slice(start)


def _parse(batches: Iterator[pa.RecordBatch], schema: pa.Schema, fields: tuple[str, ...] = tuple(FIELDS)) -> Iterator[pa.RecordBatch]:
    """Trees hold no cycles, so the collector need not look for any; at the end, freed memory goes back to the system."""
    collects = gc.isenabled()
    gc.disable()
    try:
        for b in batches:
            for chunk in _chunks(b):
                yield _parsed(chunk, schema, fields)
            del b, chunk
    finally:
        if collects:
            gc.enable()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()(0)


def _parsed(b: pa.RecordBatch, schema: pa.Schema, fields: tuple[str, ...]) -> pa.RecordBatch:
    columns, errors = {name: [] for name in fields}, []
    quick = fields == ("root",)
    for xml, broken in zip(b.column(3).to_pylist(), b.column(4).to_pylist() if b.num_columns > 4 else repeat(None)):
        if broken is not None:
            errors.append(broken)
            for values in columns.values():
                values.append(None)
            continue
        try:
            row = (quick and xml and _root_only(xml)) or parse_document(xml, fields)
            errors.append(None)
        except (ET.ParseError, ValueError, LookupError) as e:
            row = {}
            errors.append(f"{type(e).__name__}: {e}")
        for name, values in columns.items():
            values.append(row.get(name))
    nested = [pa.array(columns[n], schema.field(n).type) if n in columns else pa.nulls(b.num_rows, schema.field(n).type) for n in schema.names[4:]]
    return pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(errors, pa.string()), *nested], schema=schema)


def _small_batches(spark: SparkSession) -> None:
    """Bound what goes to Python at once, which else grows with the rows of a task up to 10,000 whole documents."""
    for name, most in (("maxRecordsPerBatch", CHUNK_ROWS), ("maxBytesPerBatch", 4 * CHUNK_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = re.sub(r"\D", "", spark.conf.get(name))
        if not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def parse(documents: DataFrame, fields: Iterable[str] | None = None) -> DataFrame:
    """documents (source_id, xml; batch_id and member_path if known) to PARSED rows. Broken XML fills `error` and nothing else,
    and so does an `error` that a document has already, as an archive that could not be read.

    Only the wanted nested `fields` are made (all, if None), the others are null: Catalyst cannot prune what Python makes.
    """
    wanted = tuple(FIELDS) if fields is None else tuple(fields)
    if unknown := set(wanted) - set(FIELDS):
        raise ValueError(f"unknown fields {sorted(unknown)}")
    batch = documents["batch_id"].cast("long") if "batch_id" in documents.columns else F.lit(0).cast("long")
    path = documents["member_path"] if "member_path" in documents.columns else F.split(documents["source_id"], "::")
    lean = documents.select("source_id", batch.alias("batch_id"), path.alias("member_path"), documents["xml"].cast("binary").alias("xml"), *([documents["error"].cast("string").alias("error")] if "error" in documents.columns else []))
    arrow = to_arrow_schema(PARSED)
    _small_batches(documents.sparkSession)
    return lean.mapInArrow(lambda it: _parse(it, arrow, wanted), PARSED)


def failure(strict_application: bool = False, strict_ipc: bool = False) -> Column:
    """Why a parsed document is failed, or null.

    strict_application: an application id without filing date or gazette section fails its document; strict_ipc: so does
    a blank classification text.
    """
    out = F.col("error")
    if strict_application:
        out = F.coalesce(out, F.when((F.col("root.id") != "") & ~(F.col("appl.has_b220") & F.col("appl.has_b405")), F.lit("UnboundLocalError: application without filing date or gazette section")))
    if strict_ipc:
        out = F.coalesce(out, F.when(F.exists("ipc", lambda x: x == ""), F.lit("IndexError: blank classification text")))
    return cut(out, 2000)


def split_failures(parsed: DataFrame, *, strict_application: bool = False, strict_ipc: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good documents, and (source_id, error) of the others, which contribute no rows to any table."""
    told = parsed.withColumn("error", failure(strict_application, strict_ipc))
    return told.where("error is null"), told.where("error is not null").select("source_id", "error")
