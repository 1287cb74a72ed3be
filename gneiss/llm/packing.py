"""Packing documents into token windows online by the sum of squares, in one pass over the table and without a shuffle."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gneiss.llm.common import small_batches, trimmed

WIDTH = 4  # bytes of a token id


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The byte-level BPE never joins what a space after a non-space parts, so a text is cut there and each piece is
    encoded once and remembered. New pieces of plain Latin text go through the rank file of the same vocabulary, which is
    the faster encoder and gives the same ids; all others go through the tokenizer itself. Texts with unusual white
    space are encoded whole by the tokenizer. With `added`, so are texts that hold one of its added tokens (such as
    <|endoftext|>), which then get that token's id as by default; without it these are ordinary text.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None, keep: int = 400_000, added: bool = False):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.slow.encode_special_tokens = not added
        self.added = [t.content for t in self.slow.get_added_tokens_decoder().values()] if added else []
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.keep, self.first, self.later = keep, {}, {}

    def whole(self, text: str) -> bytes:
        return array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, text: str) -> bytes:
        return array("I", self.fast(text)).tobytes() if self.fast and (text.isascii() or max(text) < "ɐ") else self.whole(text)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if any(t in text for t in self.added):
            return self.whole(text)
        parts = text.split(" ")
        if "" in parts or any(p[-1].isspace() for p in parts if not p.isalnum()):
            return self.whole(text)
        if len(self.later) + len(self.first) > self.keep:
            self.first.clear()
            self.later.clear()
        head = self.first.get(parts[0])
        if head is None:
            head = self.first[parts[0]] = self.piece(parts[0])
        later = self.later
        try:
            return head + b"".join([later[p] for p in parts[1:]])
        except KeyError:
            for p in parts[1:]:
                if p not in later:
                    later[p] = self.piece(" " + p)
            return head + b"".join([later[p] for p in parts[1:]])


class Levels:
    """Open windows by fill level. counts[h] is the level array: how many windows are filled to h."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.next = self.n_open = 0

    def raised(self, h: int, size: int) -> int:
        """Move a window from level h (0: a new one) up by size, to its number."""
        if h == 0:
            at, self.next, self.n_open = self.next, self.next + 1, self.n_open + 1
        else:
            at = self.open[h].pop()
            self.counts[h] -= 1
        if h + size < self.window:
            self.counts[h + size] += 1
            self.open[h + size].append(at)
        else:
            self.n_open -= 1
        return at

    def fullest(self) -> int:
        """The highest level of an open window."""
        return int(np.flatnonzero(self.counts)[-1])

    def place(self, size: int) -> tuple[int, int]:
        """Window and offset for a document of 0 < size <= window: the level at which the sum of squared counts ends least.

        Raising a window from level h to h + size changes the sum by 2 (N[h + size] - N[h]) + 2, to the full window by
        1 - 2 N[h] (a full window is not counted), and a new window by 2 N[size] + 1. Ties go to the fuller window.
        """
        n, w = self.counts, self.window
        change = 2 * (n[size : w + 1] - n[: w + 1 - size]) + 2
        change[w - size] -= 1
        change[0] = 2 * n[size] + 1 if size < w else 0
        usable = n[: w + 1 - size] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        h = len(change) - 1 - int(np.argmin(change[::-1]))
        return self.raised(h, size), h


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def _piece_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", kind), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"))])


def pack_stream(docs: Iterator[tuple], window: int, base: int, most_open: int = 64) -> Iterator[tuple]:
    """Pieces (doc, start, length, crc, doc_tokens, sequence, offset, tokens of the sequence) of (doc, id bytes).

    A document's whole windows are sequences of their own; the rest of it is placed by `Levels`. Whenever more than
    `most_open` windows are open, the fullest is completed first, with as much of the next document as it has room for
    (or with the whole of a shorter one), and only what remains of the document is placed. Pieces leave once their window
    is full. The at most `most_open` windows open when the stream ends are one run of tokens: it is cut into full windows
    and then into falling powers of two, which need no padding. Memory: the ids of the open windows.
    """
    levels, held = Levels(window), {}

    def row(doc, ids: bytes, start: int, total: int, at: int, offset: int, tokens: int) -> tuple:
        return doc, start, len(ids) // WIDTH, zlib.crc32(ids), total, base + at, offset, tokens

    def put(doc, ids: bytes, start: int, total: int, at: int, h: int) -> Iterator[tuple]:
        held.setdefault(at, []).append((doc, ids, start, total, h))
        if h + len(ids) // WIDTH == window:
            for d, i, s, t, o in held.pop(at):
                yield row(d, i, s, t, at, o, window)

    for doc, ids in docs:
        total = len(ids) // WIDTH
        whole = total - total % window
        for start in range(0, whole, window):
            at, levels.next = levels.next, levels.next + 1
            yield row(doc, ids[start * WIDTH : (start + window) * WIDTH], start, total, at, 0, window)
        while whole < total:
            if levels.n_open > most_open:
                h = levels.fullest()
                size = min(window - h, total - whole)
                at = levels.raised(h, size)
            else:
                size = total - whole
                at, h = levels.place(size)
            yield from put(doc, ids[whole * WIDTH : (whole + size) * WIDTH], whole, total, at, h)
            whole += size
    left = sum(len(i) for own in held.values() for _, i, *_ in own) // WIDTH
    sizes = [window] * (left // window) + [1 << b for b in range(window.bit_length(), -1, -1) if left % window >> b & 1]
    at, offset, room = levels.next - 1, 0, 0
    turn = iter(sizes)
    for own in held.values():
        for d, ids, s, t, _ in own:
            done = 0
            while done < len(ids) // WIDTH:
                if not room:
                    room, at, offset = next(turn), at + 1, 0
                    size = room
                take = min(room, len(ids) // WIDTH - done)
                yield row(d, ids[done * WIDTH : (done + take) * WIDTH], s + done, t, at, offset, size)
                done, room, offset = done + take, room - take, offset + take


def _pack(batches: Iterator[pa.RecordBatch], tokenizer: str, ranks: str | None, pattern: str | None, end_id: int, window: int, most_open: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    encoder, end, out = Encoder(tokenizer, ranks, pattern, added=True), array("I", [end_id]).tobytes(), []

    def docs():
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield doc, encoder(text or "") + end

    def batch(rows):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _piece_schema(kind), strict=True)], schema=_piece_schema(kind))

    for r in pack_stream(docs(), window, TaskContext.get().partitionId() << 40, most_open):
        out.append(r)
        if len(out) == 10_000:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def pack(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, ranks: str | None = None, pattern: str | None = None, end_id: int = 1, window: int = 2048, most_open: int = 64) -> DataFrame:
    """Pack every document, ids by `tokenizer` (added tokens in the text as it reads them) and then `end_id`, into sequences of at most `window` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens. Each partition
    of the table is packed as a stream by the sum of squares, so nothing is shuffled and a lost task is simply packed
    again; sequence_id is the partition's number in the high bits and a count below. A sequence holds `window` tokens or
    a power of two, so no token of padding is needed at all: a partition keeps at most `most_open` windows open, the fullest
    of which take a cut piece of the next document when there are more, and only those at its end are cut anew. Very
    long texts are tokenised whole, one at a time. Null or empty texts are the end id alone. Repeated rows are
    separate documents, each placed once. Null keys are kept. An empty table gives no rows. Other columns are ignored.
    `tokenizer` None: the public byte-level BPE of 50,257 ids, whose rank file then serves as its faster encoder.
    """
    if tokenizer is None:
        import public_tokenizers as P

        tokenizer, ranks, pattern = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    if window < 1:
        raise ValueError("window must be positive")
    small_batches(docs.sparkSession)
    lean = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    of = lean.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(of)
    return lean.mapInArrow(lambda it: trimmed(_pack(it, str(tokenizer), ranks and str(ranks), pattern, end_id, window, most_open, kind)), f"doc_id {of.simpleString()}, {PIECES}")
