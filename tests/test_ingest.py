"""Downloading and the ingest run, over file URLs."""

import json

import pytest

from gneiss.operators.ingest import archive_refs
from gneiss.plans.ingest import IngestConfig, ingest_one, run_ingest
from gneiss.sources import http
from tests.test_archives import tree, zipped


def config(tmp_path):
    served = tmp_path / "served"
    files = {"1": zipped(**{"DOC/EP1.xml": b"<a/>", "DOC/us.xml": b"<b/>"}), "2": zipped(**{"x.txt": b"-"}), "3": b"junk"}
    for i, body in files.items():
        p = served / "32" / "delivery" / "d" / "file" / i
        p.mkdir(parents=True)
        (p / "download").write_bytes(body)
    return IngestConfig(f"file://{served}", "32", *(f"{tmp_path}/{d}" for d in ("raw", "staging", "final")), clock=lambda: 7)


def test_states(spark, tmp_path):
    cfg = config(tmp_path)
    meta = {"deliveries": [{"id": "d", "files": [{"id": i, "name": n} for i, n in (("1", "a.zip"), ("2", "b.zip"), ("3", "c.zip"), ("4", "d.zip"), ("5", "e.rar"))]}]}
    refs = archive_refs(spark.createDataFrame([(json.dumps(meta),)], "metadata string"))
    for _ in range(2):
        got = {x["filename"]: x for x in run_ingest(refs, cfg, 2).collect()}
        assert {n: x["status"] for n, x in got.items()} == {"a.zip": "moved", "b.zip": "empty", "c.zip": "failed", "d.zip": "failed", "e.rar": "skipped"}
        assert got["a.zip"]["timestamp"] == "7" and int(got["a.zip"]["final_size"]) > 0 and got["c.zip"]["message"].startswith("download: BadZipFile")
    assert sorted(p.name for p in tmp_path.glob("final/*")) == ["a.zip"] and not list(tmp_path.rglob("*.part")) and not (tmp_path / "raw" / "a.zip").exists()


def test_resume_from_staging(tmp_path):
    cfg = config(tmp_path)
    (tmp_path / "staging").mkdir()
    (tmp_path / "staging" / "z.zip").write_bytes(tree().replace(b"PK no", b"PK no"))
    assert ingest_one("d", "none", "z.zip", None, cfg)["status"] == "moved"


def test_download(tmp_path):
    (tmp_path / "f.json").write_text('{"a": 1}')
    url, to = f"file://{tmp_path}/f.json", tmp_path / "out" / "f"
    assert http.get_json(url) == {"a": 1} and http.download(url, to, expected_size=8, piece=3) == 8 and to.read_text() == '{"a": 1}'
    with pytest.raises(OSError):
        http.download(url, tmp_path / "g", expected_size=9)
    with pytest.raises(Exception):
        http.download(url, tmp_path / "g.zip", validators=[http.check_zip])
    assert not list(tmp_path.glob("g*")) and not http.is_good(tmp_path / "g") and http.is_good(to)
    assert http.archive_url("http://h/", 1, "d", "f") == "http://h/1/delivery/d/file/f/download"
    http.put(tmp_path / "p", b"x")
    http.move(tmp_path / "p", tmp_path / "q" / "r")
    assert (tmp_path / "q" / "r").read_bytes() == b"x"
