"""Archives of XML inside archives: a member walk, a Python data source, and the member filter."""

from __future__ import annotations

import io
import os
import shutil
import tarfile
import tempfile
import urllib.parse
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

DOCUMENTS = "archive string, source_id string, member_path array<string>, xml binary, error string"
#: What a broken archive can raise.
BROKEN = (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, zlib.error, RuntimeError, NotImplementedError)


def kind_of(name: str) -> str | None:
    low = name.lower()
    return next((k for k, ends in (("zip", (".zip",)), ("tar.gz", (".tar.gz", ".tgz")), ("tar", (".tar",))) if low.endswith(ends)), None)


def in_doc(path: str) -> bool:
    return "/DOC/" in "/" + path.lstrip("./")


def wanted(path: str, prefix: str = "", extension: str = ".xml") -> bool:
    name = path.rsplit("/", 1)[-1].lower()
    return name.endswith(extension.lower()) and name.startswith(prefix.lower())


def members(data: io.BufferedIOBase, kind: str) -> Iterator[tuple[str, object]]:
    """(path, a function that reads it) of the regular files of one archive, by name."""
    if kind == "zip":
        with zipfile.ZipFile(data) as z:
            for i in sorted((i for i in z.infolist() if not i.is_dir()), key=lambda i: i.filename):
                yield i.filename, lambda i=i: z.read(i)
    else:
        with tarfile.open(fileobj=data, mode="r:gz" if kind == "tar.gz" else "r:") as t:
            for m in sorted((m for m in t.getmembers() if m.isfile()), key=lambda m: m.name):
                yield m.name, lambda m=m: t.extractfile(m).read()


def walk(data: io.BufferedIOBase, name: str, chain: list[str], *, doc_only: bool, prefix: str, read: bool = True, crc: bool = False) -> Iterator[tuple[list[str], bytes | None, str | None]]:
    """(path from the top archive down, bytes, error) of each XML file, depth first in order of names.

    doc_only looks, at the top, only under DOC/. A nested archive that cannot be read gives one row with an error and
    the walk goes on. read=False leaves the bytes out. crc checks a zip's sums first.
    """
    kind = kind_of(name)
    if kind is None:
        yield chain, None, f"ValueError: unsupported archive {name}"
        return
    try:
        if crc and kind == "zip":
            with zipfile.ZipFile(data) as z:
                bad = z.testzip()
            if bad:
                raise zipfile.BadZipFile(f"bad CRC of {bad}")
            data.seek(0)
        for path, load in members(data, kind):
            if doc_only and not in_doc(path):
                continue
            if kind_of(path):
                body = load()
                if body:
                    yield from walk(io.BytesIO(body), path, [*chain, path], doc_only=False, prefix=prefix, read=read, crc=crc)
            elif wanted(path, prefix):
                yield [*chain, path], load() if read else None, None
    except BROKEN as e:
        yield chain, None, f"{type(e).__name__}: {e}"


#: The largest archive that is read as one binary cell; larger ones are opened by path.
MOST_BYTES = 1 << 30


def _opened(path: str, content: bytes | None):
    """The archive's bytes, or the file itself on a store that executors mount."""
    return io.BytesIO(content) if content is not None else open(urllib.parse.unquote(urllib.parse.urlsplit(path).path) if ":" in path.split("/", 1)[0] else path, "rb")


def _rows(batches, opts: dict):
    import pyarrow as pa

    names = _arrow().names

    def batch(part):
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in part], schema=_arrow())

    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            top = urllib.parse.unquote(path.rstrip("/").rsplit("/", 1)[-1])
            part: list[tuple] = []
            try:
                held = _opened(path, content)
            except OSError as e:
                yield batch([(top, top, [top], None, f"{type(e).__name__}: {e}")])
                continue
            with held:
                for chain, xml, error in walk(held, top, [top], **opts):
                    part.append((top, "::".join(chain), chain, xml, error))
                    if len(part) == 256:
                        yield batch(part)
                        part = []
            if part:
                yield batch(part)


def _arrow():
    import pyarrow as pa

    return pa.schema([("archive", pa.string()), ("source_id", pa.string()), ("member_path", pa.list_(pa.string())), ("xml", pa.binary()), ("error", pa.string())])


#: Names of archives, whatever their case.
ARCHIVES = "*{.[zZ][iI][pP],.[tT][aA][rR],.[tT][aA][rR].[gG][zZ],.[tT][gG][zZ]}"


def read_archives(spark: SparkSession, folder: str, *, doc_only: bool = True, prefix: str = "", read: bool = True, crc: bool = False, most_bytes: int = MOST_BYTES) -> DataFrame:
    """DOCUMENTS rows of the archives right in `folder`; a missing folder fails. Other files are not read.

    Archives of up to `most_bytes` may lie in any store that Spark reads; each is one binary cell. Larger ones are opened
    by path, for which executors must mount the folder. A broken archive is a row with its error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", False).option("pathGlobFilter", ARCHIVES).load(folder)
    opts = {"doc_only": doc_only, "prefix": prefix, "read": read, "crc": crc}
    small = files.where(F.col("length") <= most_bytes).select("path", "content")
    large = files.where(F.col("length") > most_bytes).select("path", F.lit(None).cast("binary").alias("content"))
    return small.union(large).mapInArrow(lambda it: _rows(it, opts), DOCUMENTS)


def read_xml_files(spark: SparkSession, folder: str) -> DataFrame:
    """(source_id, member_path, xml) of all *.xml files below a folder; source_id is the path from there."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(folder)
    top = folder.rstrip("/").removeprefix("file://").removeprefix("file:")
    name = F.regexp_replace(F.url_decode("path"), r"^[a-z]+:/+", "/")
    relative = F.expr(f"substring(__name, {len(top) + 2})")
    return files.withColumn("__name", name).select(relative.alias("source_id"), F.array(relative).alias("member_path"), F.col("content").alias("xml"))


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        flag = lambda name, default: str(options.get(name, default)).lower() == "true"
        self.folder, self.opts = options["path"], {"doc_only": flag("doc_only", True), "prefix": options.get("xml_prefix", ""), "crc": flag("crc", False)}

    def partitions(self) -> list[ArchivePartition]:
        import os

        return [ArchivePartition(os.path.join(self.folder, n)) for n in sorted(os.listdir(self.folder)) if kind_of(n)]

    def read(self, partition: ArchivePartition):
        top = partition.path.rsplit("/", 1)[-1]
        with open(partition.path, "rb") as f:
            for chain, xml, error in walk(f, top, [top], **self.opts):
                yield top, "::".join(chain), chain, xml, error


class XmlArchives(DataSource):
    """spark.read.format("xml_archives").load(folder): a partition per archive, opened by path on a mounted store."""

    @classmethod
    def name(cls) -> str:
        return "xml_archives"

    def schema(self) -> str:
        return DOCUMENTS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


#: Filtered nested archives up to this size stay in memory, larger ones go to a temporary file of the task.
SPOOL = 64 << 20
COPY = 8 << 20


@dataclass
class Kept:
    """What a filter saw and kept, nested archives included."""

    xml: int = 0
    nested_seen: int = 0
    nested_kept: int = 0

    @property
    def anything(self) -> bool:
        return bool(self.xml)


def _filter_zip(source, out, rules: dict, kept: Kept) -> None:
    with zipfile.ZipFile(source) as z, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as to:
        to.comment = z.comment
        for member in sorted((m for m in z.infolist() if not m.is_dir()), key=lambda m: m.filename):
            if kind_of(member.filename):
                with z.open(member) as body, _nested(body, member.filename, rules, kept) as inner:
                    if inner is not None:
                        _zip_member(to, member, inner, zipfile.ZIP_STORED)
            elif wanted(member.filename, **rules["match"]):
                with z.open(member) as body:
                    _zip_member(to, member, body, zipfile.ZIP_DEFLATED)
                kept.xml += 1


def _zip_member(to: zipfile.ZipFile, like: zipfile.ZipInfo, body, compression: int) -> None:
    """Copy a member piece by piece; it keeps its date, mode and comment."""
    info = zipfile.ZipInfo(like.filename, like.date_time)
    info.compress_type, info.external_attr, info.create_system, info.comment = compression, like.external_attr, like.create_system, like.comment
    with to.open(info, "w", force_zip64=True) as f:
        shutil.copyfileobj(body, f, COPY)


def _filter_tar(source, out, packed: bool, rules: dict, kept: Kept) -> None:
    with tarfile.open(fileobj=source, mode="r:gz" if packed else "r:") as t, tarfile.open(fileobj=out, mode="w:gz" if packed else "w") as to:
        for member in sorted((m for m in t.getmembers() if m.isfile()), key=lambda m: m.name):
            like = tarfile.TarInfo(member.name)
            like.mtime, like.mode, like.size = member.mtime, member.mode, member.size
            if kind_of(member.name):
                with t.extractfile(member) as body, _nested(body, member.name, rules, kept) as inner:
                    if inner is not None:
                        like.size = inner.seek(0, 2)
                        inner.seek(0)
                        to.addfile(like, inner)
            elif wanted(member.name, **rules["match"]):
                with t.extractfile(member) as body:
                    to.addfile(like, body)
                kept.xml += 1


@contextmanager
def _nested(body, name: str, rules: dict, kept: Kept):
    """The filtered nested archive as an open file at its start, or None if nothing of it is kept."""
    kept.nested_seen += 1
    with tempfile.SpooledTemporaryFile(SPOOL) as raw, tempfile.SpooledTemporaryFile(SPOOL) as out:
        shutil.copyfileobj(body, raw, COPY)
        inner = Kept()
        if raw.tell():
            raw.seek(0)
            inner = filter_archive(raw, name, out, **rules)
        kept.xml, kept.nested_seen, kept.nested_kept = kept.xml + inner.xml, kept.nested_seen + inner.nested_seen, kept.nested_kept + inner.nested_kept + inner.anything
        out.seek(0)
        yield out if inner.anything else None


def filter_archive(source, name: str, out, *, match: dict | None = None, strict: bool = True) -> Kept:
    """Write to the file `out` the archive that the file `source` holds, with only its wanted XML files; say what was kept.

    Nested archives of all kinds are filtered alike, empty ones left out. Members are copied piece by piece, so that no
    archive is held in memory. A broken archive or an unknown kind keeps nothing unless strict, where errors are raised.
    """
    kind, rules, kept = kind_of(name), {"match": match or {}, "strict": strict}, Kept()
    if kind is None:
        return kept
    try:
        if kind == "zip":
            _filter_zip(source, out, rules, kept)
        else:
            _filter_tar(source, out, kind == "tar.gz", rules, kept)
    except BROKEN:
        if strict:
            raise
        return Kept(nested_seen=kept.nested_seen)
    return kept


def filtered_archive(data: bytes, name: str, *, prefix: str = "ep", strict: bool = True) -> bytes:
    """`filter_archive` of bytes; b'' if nothing is kept."""
    out = io.BytesIO()
    return out.getvalue() if filter_archive(io.BytesIO(data), name, out, match={"prefix": prefix}, strict=strict).anything else b""


def filter_file(source: Path, target: Path, *, prefix: str = "ep", strict: bool = True, validators: Iterable[Callable[[Path], None]] = ()) -> Kept:
    """`filter_archive` from file to file: into `.part` first, checked, then renamed. Without anything kept there is no target."""
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    try:
        with source.open("rb") as f, part.open("wb") as out:
            kept = filter_archive(f, source.name, out, match={"prefix": prefix}, strict=strict)
            out.flush()
            os.fsync(out.fileno())
        if kept.anything:
            for check in validators:
                check(part)
            os.replace(part, target)
        return kept
    finally:
        part.unlink(missing_ok=True)
