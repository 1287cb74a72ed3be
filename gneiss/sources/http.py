"""Fetching product metadata and archives over HTTP (or any scheme urllib opens), safely and in pieces."""

from __future__ import annotations

import json
import os
import shutil
import urllib.request
import zipfile
import zlib
from collections.abc import Callable, Iterable
from contextlib import suppress
from pathlib import Path

Validator = Callable[[Path], None]
PIECE = 1 << 20
GIB = 1 << 30


def metadata_url(base: str, product_id: int | str) -> str:
    return f"{base.rstrip('/')}/{product_id}"


def archive_url(base: str, product_id: int | str, delivery_id: str, file_id: str) -> str:
    return f"{metadata_url(base, product_id)}/delivery/{delivery_id}/file/{file_id}/download"


def get_json(url: str, headers: dict[str, str] | None = None, timeout: float = 60) -> object:
    """The JSON behind a URL; HTTP errors are raised."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json", **(headers or {})}), timeout=timeout) as r:
        return json.load(r)


def check_zip(path: Path) -> None:
    """Raise unless the file is a zip whose sums are right."""
    with zipfile.ZipFile(path) as z:
        bad = z.testzip()
    if bad:
        raise zipfile.BadZipFile(f"bad CRC of {bad}")


def validators_for(name: str) -> tuple[Validator, ...]:
    return (check_zip,) if name.lower().endswith(".zip") else ()


def is_good(path: Path, validators: Iterable[Validator] | None = None) -> bool:
    """Whether an artifact is there and valid; only zips have validators of their own."""
    if not path.is_file():
        return False
    try:
        for check in validators_for(path.name) if validators is None else validators:
            check(path)
    except (zipfile.BadZipFile, zlib.error, OSError, EOFError, RuntimeError, ValueError):
        return False
    return True


def put(path: Path, data: bytes) -> None:
    """Write bytes aside, flush them to disk and rename."""
    part = path.with_name(path.name + ".part")
    with part.open("wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def move(source: Path, target: Path) -> None:
    """Move a file, also to another file system, without a half-written target."""
    target.parent.mkdir(parents=True, exist_ok=True)
    try:
        os.replace(source, target)
    except OSError:
        part = target.with_name(target.name + ".part")
        shutil.copyfile(source, part)
        os.replace(part, target)
        source.unlink()


def progress_text(size: int, total: int | None = None) -> str:
    """Bytes so far in GiB, and of how many."""
    return f"{size / GIB:.2f} GiB" + (f" of {total / GIB:.2f} GiB ({100 * size / total:.1f} %)" if total else "")


def download(url: str, target: Path, *, headers: dict[str, str] | None = None, expected_size: int | None = None, validators: Iterable[Validator] = (), timeout: float = 300, piece: int = PIECE, progress: Callable[[int, int | None], None] | None = None, every: int = GIB) -> int:
    """Stream a URL to a file: into `.part` first, size and validity checked, then renamed. Nothing is left of a failure.

    `progress` is told bytes so far and bytes in all (None if not known) whenever another `every` bytes have come.
    """
    target.parent.mkdir(parents=True, exist_ok=True)
    part, size = target.with_name(target.name + ".part"), 0
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept-Encoding": "identity", **(headers or {})}), timeout=timeout) as r, part.open("wb") as f:
            told = r.headers.get("Content-Length")
            while data := r.read(piece):
                f.write(data)
                size += len(data)
                if progress and size // every > (size - len(data)) // every:
                    progress(size, expected_size if expected_size is not None else int(told) if told and told.isdigit() else None)
            f.flush()
            os.fsync(f.fileno())
        for wanted in (expected_size, int(told) if told and told.isdigit() else None):
            if wanted is not None and wanted != size:
                raise OSError(f"{size} bytes came of {wanted}")
        for check in validators:
            check(part)
        os.replace(part, target)
    except BaseException:
        with suppress(FileNotFoundError):
            part.unlink()
        raise
    return size
