"""Features of image files from their bytes: size, format, quantisation, camera and generator tags.

Headers alone are parsed, in ``mapInPandas`` batches; a file that can't be read has ``opened`` false and size 0.
``read_image_features`` reads no more of a file than that: Spark lists the folder (in parallel where it is deep), and tasks read
ranges, which grow where a header goes on.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import importable

# Numbers of the tags that rules name.
TAGS = {0x010F: "Make", 0x0110: "Model", 0x829A: "ExposureTime", 0x829D: "FNumber", 0x8827: "ISOSpeedRatings", 0x920A: "FocalLength", 0x013B: "Artist", 0x010E: "ImageDescription"}
EXIF_IFD = 0x8769
SCHEMA = "filename string, opened boolean, width int, height int, format string, file_size bigint, avg_quantization double, camera_exif_tags array<string>, has_generator_exif boolean"
FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
#: The largest width (and height) of a JPEG: a frame has two bytes for it.
WIDEST_JPEG = 0xFFFF
#: Bytes of a file's first range, and of the longest.
FIRST_RANGE, LONGEST_RANGE = 4 << 10, 1 << 20


class Ranged:
    """A file whose bytes are read where they are asked for: ``data[a:b]``.  A range beside one that was read is twice as long; one
    elsewhere starts short again."""

    def __init__(self, file: Any, size: int) -> None:
        self.file, self.size, self.taken = file, size, 0
        self.parts: list[tuple[int, bytes]] = []

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, key: slice | int) -> Any:
        if isinstance(key, int):
            found = self[key : key + 1]
            if not found:
                raise IndexError(key)
            return found[0]
        a, z = max(0, key.start or 0), min(self.size, self.size if key.stop is None else key.stop)
        if a >= z:
            return b""
        for at, held in self.parts:
            if at <= a and z <= at + len(held):
                return held[a - at : z - at]
        beside = next(((at, held) for at, held in self.parts if at <= a <= at + len(held)), None)
        if beside is None:
            at, held, length = a, b"", FIRST_RANGE
        else:
            at, held = beside
            length = min(LONGEST_RANGE, len(held))
        more_from = at + len(held)
        self.file.seek(more_from)
        more = self.file.read(min(self.size, max(z, more_from + length)) - more_from)
        self.taken += len(more)
        if beside is not None:
            self.parts.remove(beside)
        self.parts.append((at, held + more))
        return (held + more)[a - at : z - at]


def exif_tags(tiff: bytes) -> tuple[list[str], bool]:
    """Names of the known tags in the main and the Exif directory, and whether artist and a signature are there."""
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if order is None:
        return [], False

    def directory(at: int) -> dict[int, bytes]:
        (n,) = struct.unpack_from(order + "H", tiff, at)
        found = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", tiff, at + 2 + 12 * k)
            raw = tiff[at + 10 + 12 * k : at + 14 + 12 * k]
            if kind == 2 and count > 4:
                (place,) = struct.unpack(order + "I", raw)
                raw = tiff[place : place + count]
            found[tag] = raw
        return found

    main = directory(struct.unpack_from(order + "I", tiff, 4)[0])
    more = {}
    if EXIF_IFD in main:
        try:
            more = directory(struct.unpack(order + "I", main[EXIF_IFD])[0])
        except struct.error:
            pass  # a broken directory has no tags
    names = [TAGS[t] for t in dict.fromkeys([*main, *more]) if t in TAGS and TAGS[t] not in ("Artist", "ImageDescription")]
    signed = bool(main.get(0x013B, b"").strip(b"\0")) and b"Signature:" in main.get(0x010E, b"")
    return names, signed


def _jpeg(data: bytes | Ranged) -> dict[str, Any]:
    out: dict[str, Any] = {"format": "JPEG"}
    tables: dict[int, float] = {}
    at = 2
    while at + 4 <= len(data) and data[at] == 0xFF:
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xDA or marker == 0xD9:
            break
        if 0xD0 <= marker <= 0xD7 or marker == 0x01:
            at += 2
            continue
        (size,) = struct.unpack(">H", data[at + 2 : at + 4])
        body = data[at + 4 : at + 2 + size] if marker in (0xDB, 0xE1) or marker in FRAMES else b""
        if marker == 0xDB:
            while body:
                wide, number = body[0] >> 4, body[0] & 15
                n = 128 if wide else 64
                values = struct.unpack(">64H", body[1:129]) if wide else body[1:65]
                tables[number] = sum(values) / 64
                body = body[1 + n :]
        elif marker == 0xE1 and body[:6] == b"Exif\0\0":
            out["camera_exif_tags"], out["has_generator_exif"] = exif_tags(body[6:])
        elif marker in FRAMES and "width" not in out:
            out["height"], out["width"] = struct.unpack_from(">HH", body, 1)
        at += 2 + size
    if tables:
        out["avg_quantization"] = tables.get(0, next(iter(tables.values())))
    return out


def _png(data: bytes | Ranged) -> dict[str, Any]:
    out: dict[str, Any] = {"format": "PNG"}
    out["width"], out["height"] = struct.unpack(">II", data[16:24])
    at = 8
    while at + 8 <= len(data):
        (size,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        if kind == b"eXIf":
            out["camera_exif_tags"], out["has_generator_exif"] = exif_tags(data[at + 8 : at + 8 + size])
        if kind in (b"IDAT", b"IEND"):
            break
        at += 12 + size
    return out


def _webp(data: bytes | Ranged) -> dict[str, Any]:
    out: dict[str, Any] = {"format": "WEBP"}
    kind = data[12:16]
    if kind == b"VP8X":
        out["width"], out["height"] = (1 + int.from_bytes(data[a : a + 3], "little") for a in (24, 27))
    elif kind == b"VP8 ":
        out["width"], out["height"] = (x & 0x3FFF for x in struct.unpack("<HH", data[26:30]))
    elif kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        out["width"], out["height"] = (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    at = 12
    while at + 8 <= len(data):
        (size,) = struct.unpack("<I", data[at + 4 : at + 8])
        if data[at : at + 4] == b"EXIF":
            body = data[at + 8 : at + 8 + size]
            out["camera_exif_tags"], out["has_generator_exif"] = exif_tags(body[6:] if body[:6] == b"Exif\0\0" else body)
        at += 8 + size + (size & 1)
    return out


def features(data: bytes | Ranged) -> dict[str, Any]:
    """What a file's bytes say; only ``opened`` false if they aren't a known image."""
    try:
        if data[:2] == b"\xff\xd8":
            found = _jpeg(data)
        elif data[:8] == b"\x89PNG\r\n\x1a\n":
            found = _png(data)
        elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            found = _webp(data)
        else:
            found = {}
    except (struct.error, IndexError):
        found = {}
    return {"opened": True, **found} if found.get("width") else {"opened": False}


def _row(path: str, size: int, data: bytes | Ranged) -> dict[str, Any]:
    base = {"filename": path.rpartition("/")[2], "width": 0, "height": 0, "format": "UNKNOWN", "file_size": size, "avg_quantization": None, "camera_exif_tags": [], "has_generator_exif": False}
    return base | features(data)


def image_features(files: DataFrame, *kept: str) -> DataFrame:
    """Features of the files of a ``binaryFile`` scan (path, length, content), and columns that are ``kept`` (name and type)."""
    importable(files.sparkSession)
    schema = ", ".join([SCHEMA, *kept])
    names, more = [c.split()[0] for c in schema.split(", ")], [c.split()[0] for c in kept]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_row(path, size, bytes(content)) for path, size, content in zip(batch["path"], batch["length"], batch["content"], strict=True)]
            found = pd.DataFrame(rows, columns=names)
            found[more] = batch[more].to_numpy()
            yield found

    return files.select("path", "length", "content", *more).mapInPandas(parse, schema)


def opened(path: str) -> Any:
    """The file at a path as Spark lists it, for reading in ranges."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return open(path.removeprefix("file://").removeprefix("file:"), "rb")
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def read_image_features(spark: SparkSession, path: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """Features of a folder's files (of all, or those with these suffixes) and ``bytes_read``.  A file that can't be read counts as one that
    isn't an image; Spark lists no empty files."""
    importable(spark)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    if suffixes:
        listed = listed.filter(F.lower(F.regexp_extract("path", r"\.[^./]+$", 0)).isin(*suffixes))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, size in zip(batch["path"], batch["length"], strict=True):
                try:
                    with opened(name) as file:
                        data = Ranged(file, size)
                        rows.append(_row(name, size, data) | {"bytes_read": data.taken})
                except OSError:
                    rows.append(_row(name, size, b"") | {"bytes_read": 0})
            yield pd.DataFrame(rows, columns=[*(c.split()[0] for c in SCHEMA.split(", ")), "bytes_read"])

    return listed.mapInPandas(parse, f"{SCHEMA}, bytes_read bigint")


def write_files(rows: DataFrame, path: str) -> DataFrame:
    """Writes ``content`` under ``filename`` in a new folder that all tasks can reach, and returns ``filename, path, size``.  A task that runs again writes
    the same files again."""
    importable(rows.sparkSession)
    base = path.rstrip("/")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, content in zip(batch["filename"], batch["content"], strict=True):
                target = f"{base}/{name}"
                with created(target) as file:
                    file.write(bytes(content))
                out.append((name, target, len(content)))
            yield pd.DataFrame(out, columns=["filename", "path", "size"])

    return rows.select("filename", "content").mapInPandas(put, "filename string, path string, size bigint")


def created(path: str) -> Any:
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        local = path.removeprefix("file://").removeprefix("file:")
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    system, inside = fs.FileSystem.from_uri(path)
    system.create_dir(inside.rpartition("/")[0])
    return system.open_output_stream(inside)
