"""Versioned tables, ranged image files."""

import struct

import pytest
from pyspark.sql import functions as F

from quarry.sources import files, imagebytes, versions
from test_engine import jpeg, png, tiff


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def held(table, version=None):
    return sorted(r.k for r in table.read("k int", version).collect())


def test_versions(spark, tmp_path):
    table = versions.Table(spark, str(tmp_path / "t"))
    assert table.versions() == [] and held(table) == []
    assert table.append(rows(spark, 1, 2)) == 1 and table.append(rows(spark, 3)) == 2
    pinned = table.read("k int", 2)
    assert table.replace(table.read("k int").filter("k > 1").drop("_part")) == 3
    assert held(table) == [2, 3] and sorted(r.k for r in pinned.collect()) == [1, 2, 3] and held(table, 1) == [1, 2]
    stray = table.write(rows(spark, 99))  # a writer that fails before it commits
    assert held(table) == [2, 3]
    with pytest.raises(versions.Conflict):
        table.commit([stray], 2)
    assert table.versions() == [1, 2, 3] and held(table) == [2, 3]
    assert table.rollback(1) == 4 and held(table) == [1, 2]
    assert table.clean() == 2 and table.versions() == [3, 4] and held(table, 3) == [2, 3] and held(table) == [1, 2]
    with pytest.raises(ValueError):
        table.parts(1)


def test_compacted_log(spark, tmp_path):
    """Ten runs of captions, the last of each file counts; superseded runs aren't read."""
    log, want = files.CaptionLog(spark, str(tmp_path / "log"), fan=3), {}
    for run in range(10):
        own = {f"f{k}.png": f"run {run}" for k in range(run, 40, run + 1)}
        want |= own
        log.add(spark.createDataFrame(list(own.items()), "filename string, caption string").selectExpr("filename", "caption", "false AS should_reject", "array('x') AS reject_signals", "CAST(null AS string) AS error"))
        assert {r.filename: r.caption for r in log.latest().collect()} == want
        assert [p["level"] for p in log.table.parts()] == sorted((p["level"] for p in log.table.parts()), reverse=True)
    assert [p["level"] for p in log.table.parts()] == [2, 0]
    assert len(log.latest().inputFiles()) < 10


def test_ranges_of_images(spark, tmp_path):
    big = b"\0" * 3_000_000
    gps = b"\xff\xe2" + struct.pack(">H", 60_002) + b"\1" * 60_000  # a long segment to be skipped
    late = jpeg(640, 480, 9)
    data = {
        "plain.jpg": jpeg(64, 48, 12) + big,
        "late.JPG": late[:2] + gps * 3 + late[2:] + big,
        "a b%20c.png": png(30, 20) + big,
        "exif.png": png(31, 21)[:33] + struct.pack(">I", len(tiff())) + b"eXIf" + tiff() + b"\0\0\0\0" + struct.pack(">I", 9) + b"IDAT" + big,
        "end.webp": b"RIFF\0\0\0\0WEBPVP8X" + struct.pack("<I", 10) + b"\0\0\0\0" + (639).to_bytes(3, "little") + (479).to_bytes(3, "little") + b"VP8 " + struct.pack("<I", len(big)) + big + b"EXIF" + struct.pack("<I", len(tiff())) + tiff(),
        "short.jpg": late[:9], "text.png": b"no image" * 2000, "skip.txt": b"x",
    }
    (tmp_path / "sub").mkdir()
    for k, (name, content) in enumerate(data.items()):
        ((tmp_path / "sub" if k % 2 else tmp_path) / name).write_bytes(content)
    got = {r.filename: r for r in imagebytes.read_image_features(spark, str(tmp_path), files.MORE_IMAGES).collect()}
    assert set(got) == set(data) - {"skip.txt"}
    whole = {r.filename: r for r in imagebytes.image_features(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))).collect()}
    for name, r in got.items():
        assert {c: r[c] for c in whole[name].asDict()} == whole[name].asDict() and r.file_size == len(data[name])
    assert (got["late.JPG"].width, got["late.JPG"].camera_exif_tags, got["end.webp"].camera_exif_tags, got["exif.png"].has_generator_exif) == (640, ["Make"], ["Make"], True)
    assert all(r.bytes_read < 40_000 for r in got.values()) and got["plain.jpg"].bytes_read <= 8192 and got["short.jpg"].opened is False


def test_ranges_grow():
    class File:
        def __init__(self, data):
            self.data, self.at, self.reads = data, 0, []

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.reads.append((self.at, n))
            return self.data[self.at : self.at + n]

    raw = bytes(range(256)) * 400
    f = File(raw)
    data = imagebytes.Ranged(f, len(raw))
    assert data[0:10] == raw[:10] and data[4090:4100] == raw[4090:4100] and data[8190:8200] == raw[8190:8200]
    assert f.reads == [(0, 4096), (4096, 4096), (8192, 8192)]
    assert data[90_000:90_004] == raw[90_000:90_004] and data[len(raw) - 2 :] == raw[-2:] and data[len(raw) :] == b"" and data[5] == 5
    assert data.taken < 30_000
    with pytest.raises(IndexError):
        data[len(raw)]


def test_written_files_are_listed(spark, tmp_path):
    made = spark.range(20).select(F.concat("id", F.lit(".png")).alias("filename"), F.unhex(F.lit(png(7, 8).hex())).alias("content"))
    paths = imagebytes.write_files(made, f"file:{tmp_path}/out").collect()
    assert len(paths) == 20 and files.read_listing(spark, f"{tmp_path}/out", (".png",)).count() == 20
    assert {(r.width, r.height) for r in imagebytes.read_image_features(spark, f"{tmp_path}/out").collect()} == {(7, 8)}


def test_objects_written_line_by_line(spark, tmp_path):
    made = spark.range(100).select(F.concat(F.lit('k"'), "id").alias("k"), F.struct(F.concat(F.lit("é,}"), "id").alias("caption")).alias("v"))
    files.write_json_map(made.repartition(3), "k", "v", str(tmp_path / "o"))
    assert {r.filename: r.caption for r in files.read_captions(spark, str(tmp_path / "o")).collect()} == {f'k"{i}': f"é,}}{i}" for i in range(100)}
