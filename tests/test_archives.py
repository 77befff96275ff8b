"""Archives in parts, volumes, damage, archives within archives."""

import io
import zipfile

import pytest

from glossaflow.plans import built
from glossaflow.sources import archives
from glossaflow.sources import files as sources


def rows_of(df):
    return sorted((r["archive"], r["member"] or "", r["at"] if r["at"] is not None else -1, bytes(r["content"] or b""), r["status"]) for r in df.collect())


def test_members_in_pieces_and_parts(spark, tmp_path):
    members = [(f"m{i}.txt", bytes([i]) * (i * 700)) for i in range(6)]
    (tmp_path / "a.zip").write_bytes(built.zipped(members))
    (tmp_path / "note.txt").write_text("not an archive")
    found = archives.read_archives(spark, str(tmp_path), pieceBytes=1000, partBytes=2000)
    assert found.rdd.getNumPartitions() > 2
    whole = {}
    for archive, member, at, content, status in rows_of(found):
        assert archive == "a.zip" and status == "OK" and len(content) <= 1000 and at == len(whole.get(member, b""))
        whole[member] = whole.get(member, b"") + content
    assert whole == dict(members)


def test_damage_is_a_row(spark, tmp_path):
    packed = built.zipped([("fine.txt", b"fine"), ("locked.txt", b"x"), ("bad.txt", b"y" * 5000)], locked=["locked.txt"], broken=["bad.txt"])
    (tmp_path / "a.zip").write_bytes(packed)
    (tmp_path / "cut.zip").write_bytes(packed[:-30])
    (tmp_path / "empty.zip").write_bytes(b"")
    (tmp_path / "other.7z").write_bytes(b"7z")
    found = rows_of(archives.read_archives(spark, str(tmp_path)))
    assert found == [
        ("a.zip", "bad.txt", -1, b"", "DAMAGED"), ("a.zip", "fine.txt", 0, b"fine", "OK"), ("a.zip", "locked.txt", -1, b"", "ENCRYPTED"),
        ("cut.zip", "", -1, b"", "DAMAGED"), ("empty.zip", "", -1, b"", "DAMAGED"), ("other.7z", "", -1, b"", "UNSUPPORTED"),
    ]
    assert [r["member"] for r in sources.read_zip(spark, str(tmp_path)).collect()] == ["fine.txt"]
    (tmp_path / "none").mkdir()
    assert archives.read_archives(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_damaged_streams(spark, tmp_path, method):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        archive.writestr("a.txt", bytes(range(256)) * 40)
        archive.writestr("b.txt", "sound")
    data = bytearray(out.getvalue())
    data[60:90] = b"\xff" * 30
    (tmp_path / "a.zip").write_bytes(data)
    assert [r[1:] for r in rows_of(archives.read_archives(spark, str(tmp_path)))] == [("a.txt", -1, b"", "DAMAGED"), ("b.txt", 0, b"sound", "OK")]


def test_volumes(tmp_path):
    from pyarrow import fs

    data = bytes(range(256)) * 20
    cuts = [0, 1, 1, 700, 5000, len(data)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        (tmp_path / f"v{n}").write_bytes(data[a:b])
    joined = io.BufferedReader(archives.Joined(fs.LocalFileSystem(), [(str(tmp_path / f"v{n}"), b - a) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]), 64)
    assert joined.read() == data
    for at in (0, 1, 699, 700, 4999, len(data) - 3):
        joined.seek(at)
        assert joined.read(1500) == data[at : at + 1500]
    joined.seek(-10, io.SEEK_END)
    assert joined.read() == data[-10:] and joined.read(1) == b""


def test_unpack(spark, tmp_path):
    leaf = built.zipped([("x/é قط.txt", b"leaf" * 500), ("none.txt", b"")])
    cut = len(leaf) // 2
    middle = built.zipped([("leaf.zip", leaf), ("leaf.rar", b"r"), ("v.zip.001", leaf[:cut]), ("v.zip.002", leaf[cut:]), ("sick.zip", b"sick"), ("nil.zip", b""), ("bad.zip", leaf)], broken=["bad.zip"])
    top = built.zipped([("in/middle.zip", middle), ("top.txt", b"top"), ("leaf.zip", leaf)])
    for n in range(3):
        third = -(-len(top) // 3)
        (tmp_path / f"top.zip.{n + 1:03}").write_bytes(top[n * third : (n + 1) * third])
    found = archives.unpack(spark, str(tmp_path), pieceBytes=300)
    whole, states = {}, set()
    for archive, member, _, content, status in rows_of(found):
        states.add((archive, member, status))
        whole[archive, member] = whole.get((archive, member), b"") + content
    leaves = [w for w in ("top.zip/leaf.zip", "top.zip/in/middle.zip/leaf.zip", "top.zip/in/middle.zip/v.zip")]
    sound = {(w, m, "OK") for w in leaves for m in ("x/é قط.txt", "none.txt")} | {("top.zip", "top.txt", "OK")}
    middle_way = "top.zip/in/middle.zip"
    assert states == sound | {(f"{middle_way}/leaf.rar", "", "UNSUPPORTED"), (f"{middle_way}/sick.zip", "", "DAMAGED"), (f"{middle_way}/nil.zip", "", "DAMAGED"), (middle_way, "bad.zip", "DAMAGED")}
    assert all(whole[w, "x/é قط.txt"] == b"leaf" * 500 and whole[w, "none.txt"] == b"" for w in leaves)
    with pytest.raises(ValueError, match="levels"):
        archives.unpack(spark, str(tmp_path), depth=1)


def test_small_archives_share_a_task_and_are_not_opened_to_plan(tmp_path, monkeypatch):
    for n in range(40):
        with zipfile.ZipFile(tmp_path / f"s{n}.zip", "w") as archive:
            archive.writestr("a.txt", "x" * 100)
    (tmp_path / "t.zip").write_bytes(b"no archive")
    reader = archives.ArchiveReader({"path": str(tmp_path)})
    opened = []
    plain = archives.ArchiveReader._opened
    monkeypatch.setattr(archives.ArchiveReader, "_opened", lambda self, v: opened.append(v) or plain(self, v))
    parts = reader.partitions()
    assert (len(parts), opened) == (1, [])
    rows = [r for b in reader.read(parts[0]) for r in b.to_pylist()]
    assert sorted(r["status"] for r in rows) == [archives.DAMAGED] + [archives.OK] * 40


def test_small_archives_in_archives_are_opened_where_they_are(spark, tmp_path, monkeypatch):
    """Each was written to the shared folder, piece by piece, and read again."""
    leaves = [(f"leaf{n}.zip", built.zipped([(f"{n}.txt", b"t" * n * 99), ("e.txt", b"")])) for n in range(4)]
    middle = built.zipped([*leaves, ("sick.zip", b"no"), ("lock.zip", leaves[0][1]), ("bad.zip", leaves[1][1])], locked=["lock.zip"], broken=["bad.zip"], stored=True)
    for n in range(3):
        (tmp_path / f"a{n}.zip").write_bytes(built.zipped([("in/m.zip", middle), ("t.txt", b"top"), ("leaf1.zip", leaves[1][1])]))
    written = []
    plain = archives.write_files
    monkeypatch.setattr(archives, "write_files", lambda files, folder: written.append(folder) or plain(files, folder))
    # The last holds the middle ones in pieces, but not the leaves in them.
    found = {size: rows_of(archives.unpack(spark, str(tmp_path), pieceBytes=500, nestedBytes=size)) for size in (0, 1 << 20, 250)}
    assert found[0] == found[1 << 20] == found[250] and len(found[0]) == 3 * (len(leaves) * 2 + 1 + 2 + 3)
    # Only the locked one, which nobody can open, is among those to be written.
    assert len(written) == 2 + 1 + 2
    for size in (0, 1 << 20):
        with pytest.raises(ValueError, match="levels"):
            archives.unpack(spark, str(tmp_path), depth=1, nestedBytes=size)
    parts = archives.ArchiveReader({"path": str(tmp_path), "nestedBytes": "1048576", "members": "others"})
    batches = [b for p in parts.partitions() for b in parts.read(p)]
    assert len(batches) == 1 and batches[0].num_rows == len(found[0]) - 3
