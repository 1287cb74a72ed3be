"""Archives in archives: walking, filtering, the two readers."""

import io
import tarfile
import zipfile

import pytest

from gneiss.sources.archives import XmlArchives, filtered_archive, read_archives, read_xml_files, walk


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for path, body in members.items():
            z.writestr(path, body)
    return out.getvalue()


def tarred(mode="w", **members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for path, body in members.items():
            info = tarfile.TarInfo(path)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return out.getvalue()


def names(data, name, **opts):
    opts = {"doc_only": True, "prefix": "", **opts}
    return [("::".join(c), x, e) for c, x, e in walk(io.BytesIO(data), name, [name], **opts)]


def tree():
    inner = zipped(**{"EP2.xml": b"<b/>", "sub/us1.XML": b"<c/>", "x.txt": b"t"})
    deep = tarred("w:gz", **{"EP3.xml": b"<d/>", "z.zip": zipped(**{"EP4.xml": b"<e/>"})})
    return zipped(**{"DOC/EP1.xml": b"<a/>", "INDEX/EP0.xml": b"<i/>", "./DOC/b.zip": inner, "DOC/c.tgz": deep, "DOC/empty.zip": b"", "DOC/bad.zip": b"PK no"})


def test_walk():
    got = names(tree(), "T.zip")
    assert [n for n, _, e in got if not e] == ["T.zip::./DOC/b.zip::EP2.xml", "T.zip::./DOC/b.zip::sub/us1.XML", "T.zip::DOC/EP1.xml", "T.zip::DOC/c.tgz::EP3.xml", "T.zip::DOC/c.tgz::z.zip::EP4.xml"]
    assert [n for n, _, e in got if e] == ["T.zip::DOC/bad.zip"]
    assert [n for n, _, _ in names(tree(), "T.zip", doc_only=False)][-1] == "T.zip::INDEX/EP0.xml"
    assert not any("us1" in n for n, _, _ in names(tree(), "T.zip", prefix="ep"))
    assert all(x is None for _, x, _ in names(tree(), "T.zip", read=False))


def test_walk_tar_and_errors():
    assert [n for n, _, _ in names(tarred(**{"DOC/a.zip": zipped(**{"q.xml": b"<q/>"})}), "T.tar")] == ["T.tar::DOC/a.zip::q.xml"]
    assert "unsupported" in names(b"", "T.rar")[0][2] and names(b"junk", "T.zip")[0][2].startswith("BadZipFile")
    whole = zipped(**{"DOC/a.xml": bytes(range(256))})
    data = whole.replace(bytes(range(65, 75)), bytes(range(75, 65, -1)), 1)
    assert data != whole and names(data, "T.zip", crc=True)[0][2].startswith("BadZipFile")


def test_filter():
    kept = filtered_archive(tree().replace(b"PK no", b"PK no"), "T.zip", strict=False)
    with zipfile.ZipFile(io.BytesIO(kept)) as z:
        assert sorted(z.namelist()) == ["./DOC/b.zip", "DOC/EP1.xml", "DOC/c.tgz", "INDEX/EP0.xml"]
        with zipfile.ZipFile(io.BytesIO(z.read("./DOC/b.zip"))) as n:
            assert n.namelist() == ["EP2.xml"]
    assert filtered_archive(zipped(**{"a.txt": b""}), "T.zip") == b"" and filtered_archive(b"x", "T.rar") == b""
    assert filtered_archive(b"junk", "T.zip", strict=False) == b""
    with pytest.raises(zipfile.BadZipFile):
        filtered_archive(b"junk", "T.zip")
    assert filtered_archive(tarred(**{"EP.xml": b"<a/>", "n.xml": b"<n/>"}), "T.tar")


def test_readers_agree(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(tree())
    (tmp_path / "B.ZIP").write_bytes(b"junk")
    (tmp_path / "c.txt").write_text("no")
    spark.dataSource.register(XmlArchives)
    a = read_archives(spark, str(tmp_path)).select("source_id", "xml").collect()
    b = spark.read.format("xml_archives").load(str(tmp_path)).select("source_id", "xml").collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 7
    with pytest.raises(Exception):
        read_archives(spark, str(tmp_path / "none")).collect()


def test_xml_files(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a b.xml").write_bytes(b"<a/>")
    (tmp_path / "s" / "c.txt").write_bytes(b"")
    assert [(x["source_id"], bytes(x["xml"])) for x in read_xml_files(spark, str(tmp_path)).collect()] == [("s/a b.xml", b"<a/>")]
