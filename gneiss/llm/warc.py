"""WARC derivatives: linked metadata and plain-text conversion records of response records."""

from __future__ import annotations

import base64
import hashlib
import html as entities
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import small_batches
from gneiss.llm.html import Node, blocks, parse

FORMAT = "WARC/1.0"
LINKS = {"a": "href", "link": "href", "area": "href", "img": "src", "script": "src", "iframe": "src", "form": "action", "video": "src", "audio": "src", "source": "src"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """The same id for the same parts, so that a task that runs again writes the same record."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(parts).encode('utf-8', 'replace')).digest()[:16], version=5)}>"


def line_safe(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def make_record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {line_safe(v)}\r\n" for k, v in {**headers, "Content-Length": str(len(block))}.items())
    return f"{FORMAT}\r\n{head}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


class Fields(dict):
    """Header fields by name as written, the first of a name; found whatever the case."""

    def find(self, name: str) -> str | None:
        return next((v for k, v in self.items() if k.lower() == name.lower()), None)


def inflated(blob: bytes, kind: int) -> bytes:
    """What a run of compressed members holds (kind as in zlib), up to where it breaks off or turns into something else."""
    out, at = [], 0
    while at < len(blob):
        machine = zlib.decompressobj(kind)
        try:
            while at < len(blob) and not machine.eof:
                piece = blob[at : at + (1 << 16)]
                out.append(machine.decompress(piece))
                at += len(piece) - len(machine.unused_data)
        except zlib.error:
            break
    return b"".join(out)


GZIP = 16 + zlib.MAX_WBITS


def read_records(blob: bytes) -> Iterator[tuple[Fields, bytes]]:
    """Headers and block of every record of a WARC file, plain or with gzip members. What is cut off or broken is left out."""
    data = io.BytesIO(inflated(blob, GZIP) if blob[:2] == b"\x1f\x8b" else blob)
    while line := data.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers, last = Fields(), None
        while (line := data.readline()) and line.strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and last:
                headers[last] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            last = name.strip()
            headers.setdefault(last, value.strip())
        size = headers.find("Content-Length") or ""
        size = int(size) if re.fullmatch(r"[0-9]{1,18}", size) else -1
        block = data.read(size) if size >= 0 else b""
        if size >= 0 and len(block) == size:
            yield headers, block


def split_http(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, headers in order, payload of an HTTP response; a block without a header part is all payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    gap = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block[: gap.start()], block[gap.end() :]) if gap else (block, b"")
    lines = head.decode("utf-8", "replace").splitlines()
    return lines[0], [[p.strip() for p in x.split(":", 1)] for x in lines[1:] if ":" in x], payload


def unchunked(payload: bytes) -> bytes:
    """The chunks of a chunked transfer, as far as it goes; a payload that is none stays as it is."""
    out, at, head = [], 0, re.compile(rb"([0-9A-Fa-f]{1,15})[ \t]*(?:;[^\r\n]*)?\r?\n")
    while at < len(payload):
        m = head.match(payload, at)
        if not m:
            return payload
        size = int(m[1], 16)
        if not size:
            break
        out.append(payload[m.end() : m.end() + size])
        at = m.end() + size
        at += 2 if payload[at : at + 2] == b"\r\n" else payload[at : at + 1] == b"\n"
    return b"".join(out)


def entity(http: list[list[str]], payload: bytes) -> bytes:
    """The payload with chunked transfer and gzip or deflate coding undone; other codings stay."""
    said = {}
    for name, value in http:
        said[name.lower()] = f"{said[name.lower()]},{value}" if name.lower() in said else value
    codings = [c.strip().lower() for c in f"{said.get('content-encoding', '')},{said.get('transfer-encoding', '')}".split(",")]
    for coding in reversed(codings):
        if coding == "chunked":
            payload = unchunked(payload)
        elif coding in ("gzip", "x-gzip"):
            payload = inflated(payload, GZIP) if payload[:2] == b"\x1f\x8b" else payload
        elif coding == "deflate":
            payload = inflated(payload, zlib.MAX_WBITS) or inflated(payload, -zlib.MAX_WBITS) or payload
    return payload


def decoded(body: bytes, charset: str | None) -> str:
    """The text by the named charset; by UTF-8 where Python has no such text encoding or it fails."""
    try:
        return body.decode(charset or "utf-8", "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


def page_text(root: Node) -> str:
    return "\n".join(blocks([root]))


def page_metadata(root: Node) -> dict:
    title, metas, links, stack = "", [], [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "title" and not title:
            title = " ".join(entities.unescape("".join(p for p in node.parts if isinstance(p, str))).split())
        elif node.tag == "meta":
            metas.append(node.attributes())
        elif node.tag in LINKS and node.raw and (to := node.attributes().get(LINKS[node.tag])) is not None:
            links.append({"path": f"{node.tag.upper()}@/{LINKS[node.tag]}", "url": to})
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return {"Head": {"Title": title, "Metas": metas}, "Links": links}


def derive_record(headers: Fields, block: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of one response; other record types give none.

    Both refer to the response's WARC-Record-ID and keep its target, date, payload digest and, in the metadata, all WARC
    and HTTP headers. A response without a record id gets one made from its headers and block. Digest and length are
    those of the payload as stored; text and links are read after chunked, gzip and deflate codings are undone.
    """
    if (headers.find("WARC-Type") or "").lower() != "response":
        return []
    status, http, payload = split_http(block)
    source = headers.find("WARC-Record-ID") or record_id("response", sorted(headers.items()), digest(block))
    payload_digest = headers.find("WARC-Payload-Digest") or digest(payload)
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    charset = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    body = decoded(entity(http, payload), charset and charset[1])
    is_html = not kind or "html" in kind.lower()
    root = parse(body) if is_html else None
    text = (page_text(root) if root else body if kind.lower().startswith("text/") else "").encode("utf-8", "replace")
    facts = {
        "Envelope": {
            "WARC-Header-Metadata": headers,
            "Payload-Metadata": {"HTTP-Response-Metadata": {"Response-Message": status, "Headers": http, "Entity-Length": len(payload), "Entity-Digest": payload_digest, **({"HTML-Metadata": page_metadata(root)} if root else {})}},
            "Block-Digest": headers.find("WARC-Block-Digest") or digest(block),
        }
    }
    out = []
    for name, content, said in (("metadata", "application/json", json.dumps(facts, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace")), ("conversion", "text/plain; charset=utf-8", text)):
        own = {"WARC-Type": name, "WARC-Record-ID": record_id(name, source), "WARC-Refers-To": source}
        own |= {k: v for k in ("WARC-Target-URI", "WARC-Date") if (v := headers.find(k)) is not None}
        own |= {"WARC-Refers-To-Payload-Digest": payload_digest, "WARC-Block-Digest": digest(said), "Content-Type": content}
        out.append((own, said))
    return out


DERIVED = "key long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_payload_digest string, source_headers string, record binary"


def _derive(batches: Iterator[pa.RecordBatch], schema: pa.Schema, bodies: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for key, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for headers, block in read_records(blob or b""):
                status, http, _ = split_http(block)
                said = "\r\n".join([status, *(f"{k}: {v}" for k, v in http)]) if status else ""
                for own, content in derive_record(headers, block):
                    rows.append((key, own["WARC-Type"], own["WARC-Record-ID"], own["WARC-Refers-To"], own.get("WARC-Target-URI"), own.get("WARC-Date"), own["Content-Type"], len(content), own["WARC-Block-Digest"], own["WARC-Refers-To-Payload-Digest"], said, make_record(own, content) if bodies else None))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def derive(files: DataFrame, *, key: str = "key", content: str = "content", bodies: bool = True) -> DataFrame:
    """Derivatives of every response record in the WARC bytes of column `content`, plain or gzip.

    Two rows per response, `metadata` and `conversion`: the columns of DERIVED, `record` being the whole new record (null
    if not `bodies`). Null, empty, foreign or broken bytes give no rows, nor does an empty table; of a file that breaks off
    the whole records before give theirs. Repeated rows give repeated, identical records. Field names count whatever their
    case. A file's bytes, however long, are one cell and are read whole. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(files.sparkSession)
    lean = files.select(files[key].cast("long").alias("key"), files[content].alias("content"))
    schema = to_arrow_schema(StructType.fromDDL(DERIVED))
    return lean.mapInArrow(lambda it: _derive(it, schema, bodies), DERIVED)


def responses_of(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A WARC response record (key, content) for every page. Null html is an empty payload, a null url gives no target."""
    body = F.encode(F.coalesce(pages[source], F.lit("")), "UTF-8")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    ident = F.sha1(F.concat_ws("\t", pages[key].cast("string"), F.coalesce(pages[url], F.lit(""))))
    name = F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(ident, a, n)]], F.lit(">"))
    target = F.when(pages[url].isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(pages[url], r"[\r\n]+", " "), F.lit("\r\n"))).otherwise(F.lit(""))
    head = F.concat(F.lit(f"{FORMAT}\r\nWARC-Type: response\r\nWARC-Record-ID: "), name, F.lit("\r\n"), target, F.lit(f"WARC-Date: {date}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(pages[key].cast("long").alias("key"), F.concat(F.encode(head, "UTF-8"), F.encode(http, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8")).alias("content"))
