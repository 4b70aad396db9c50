"""Quoted text read in byte ranges side by side: a CSV file, or one JSON object, of any size is never one task's.

Spark's text source cuts files into ranges at a separator (a newline, or JSON's comma).  Whether a separator ends a unit (a record;
an entry of the object) depends on the quotes and brackets before it, in other ranges too.  So there are two passes, the first when the reader is made:

1. Each range sums up what it does to that state: its quotes' parity, and how its brackets change the depth, both for a start
   inside and outside of a string.  Running sums over a file's ranges, a row each, give every range the state it starts in.
2. Each range cuts its units.  A unit within one range is done; the pieces of one that crosses ranges are grouped by where it starts,
   and this step is left out where no range ends within a unit.

Only a unit longer than a task's memory is too long.  Ranges follow ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import importable

#: Ranges (short rows) up to which their table is broadcast.
BROADCAST_RANGES = 500_000
#: Bytes that are looked at together.
PIECE = 4 << 20


class Form(NamedTuple):
    """How units are separated.  ``escaped``: a backslash takes a quote its meaning; ``level``: the depth at which units end."""

    separator: str
    escaped: bool
    nested: bool
    level: int


CSV = Form("\n", False, False, 0)
JSON_OBJECT = Form(",", True, True, 1)


class State(NamedTuple):
    """After each of some segments: quotes so far (parity), and the depth if the first segment starts outside or inside a string."""

    quotes: np.ndarray
    outside: np.ndarray
    inside: np.ndarray


def follow(data: np.ndarray, at: np.ndarray, form: Form) -> State:
    """What the segments ``data[at[i]:at[i+1]]`` do to the state, from the first one's start on."""
    quote = data == 0x22
    if form.escaped and len(data):
        index = np.arange(len(data))
        plain = np.maximum.accumulate(np.where(data != 0x5C, index, -1))  # the last byte that is no backslash
        marks = np.flatnonzero(quote)
        after = marks[marks > 0]
        quote[after] = (after - 1 - plain[after - 1]) % 2 == 0
    before = np.concatenate(([0], np.cumsum(quote)))
    parity = before[at[1:]] & 1
    if not form.nested:
        return State(parity, np.zeros_like(parity), np.zeros_like(parity))
    step = np.isin(data, np.frombuffer(b"{[", np.uint8)).astype(np.int64) - np.isin(data, np.frombuffer(b"}]", np.uint8))
    in_string = before[:-1] & 1
    depth = [np.concatenate(([0], np.cumsum(step * (in_string == k))))[at[1:]] for k in (0, 1)]
    return State(parity, *depth)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]:
    """Stretches of one range's segments: the range, the first row in its batch, the batch, the segments, their bytes and offsets."""
    for batch in batches:
        if not len(batch):
            continue
        values = batch.column(0).cast(pa.large_string())
        file, block = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        _, offsets, data = values.buffers()
        at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        new = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        bounds = [0, *new.tolist(), len(values)]
        for a, z in zip(bounds[:-1], bounds[1:], strict=True):
            while a < z:
                b = min(z, max(a + 1, int(np.searchsorted(at, at[a] + PIECE, "right")) - 1))
                yield (int(file[a]), int(block[a])), a, batch, values.slice(a, b - a), raw[at[a] : at[b]], at[a : b + 1] - at[a]
                a = b


def _summed(form: Form) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each range: file, block, quotes, outside, inside (all it changes), low_outside, low_inside (the lowest depth at the end of a
    segment that is outside of strings, for both starts), and head (the first unit, of a file's first range)."""
    names = ["file", "block", "quotes", "outside", "inside", "low_outside", "low_inside", "head"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, head, ended = None, None, [], False

        def done() -> pa.RecordBatch:
            first = form.separator.join(head) if key[1] == 0 else None
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*key, *row)] + [pa.array([first], pa.string())], names=names)

        for now, _, _, values, data, at in _pieces(batches):
            if now != key:
                if key is not None:
                    yield done()
                key, row, head, ended = now, [0, 0, 0, None, None], [], now[1] != 0
            s = follow(data, at, form)
            quotes, outside, inside = row[:3]
            parity = s.quotes ^ quotes
            depth = (outside + (s.outside if quotes == 0 else s.inside), inside + (s.inside if quotes == 0 else s.outside))
            for k in (0, 1):
                ends = depth[k][parity == k]
                if len(ends):
                    low = int(ends.min())
                    row[3 + k] = low if row[3 + k] is None else min(low, row[3 + k])
            if not ended:
                last = np.flatnonzero((parity == 0) & (depth[0] <= form.level))
                ended = bool(len(last))
                head += values.slice(0, int(last[0]) + 1 if ended else len(values)).to_pylist()
            row[:3] = int(parity[-1]), int(depth[0][-1]), int(depth[1][-1])
        if key is not None:
            yield done()

    return run


def _cut(form: Form) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Units of each range.  Columns from the fourth on: parity, depth, start, mid (the range starts within a unit), head_id."""
    names = ["file", "start", "block", "whole", "first", "closes", "head_id", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pending = None, []
        parity = depth = start = head_id = 0
        mid = first = False
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int32(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)
            out.clear()
            return made

        def end_of_range() -> None:
            if pending:
                out.append((key[0], start, key[1], False, first, False, head_id, form.separator.join(pending)))
                pending.clear()

        for now, a, batch, values, data, at in _pieces(batches):
            if now != key:
                if key is not None:
                    end_of_range()
                key = now
                parity, depth, start, mid, head_id = (batch.column(3 + k)[a].as_py() for k in range(5))
                first = key[1] == 0
            s = follow(data, at, form)
            deep = depth + (s.outside if parity == 0 else s.inside)
            inside = s.quotes ^ parity
            segments, begin = values.to_pylist(), 0
            for end in np.flatnonzero((inside == 0) & (deep <= form.level)).tolist():
                text = segments[begin] if begin == end and not pending else form.separator.join([*pending, *segments[begin : end + 1]])
                pending.clear()
                out.append((key[0], start, key[1], not mid, first, bool(deep[end] < form.level), head_id, text))
                mid, first, start, begin = False, False, key[1], end + 1
            pending += segments[begin:]
            parity, depth = int(inside[-1]), int(deep[-1])
            if out:
                yield flush()
        if key is not None:
            end_of_range()
            if out:
                yield flush()

    return run


def units(spark: SparkSession, path: str, form: Form, scratch: str) -> tuple[DataFrame, list[str]]:
    """``text, first, closes, head_id``: a file's units in any order, whether one is its file's first, whether it ends below the level;
    and the different first units of files, by head_id.  ``scratch``: a new path for the table of ranges."""
    importable(spark)
    source = spark.read.option("lineSep", form.separator).text(path)
    segments = source.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    summed = segments.mapInArrow(_summed(form), "file bigint, block bigint, quotes bigint, outside bigint, inside bigint, low_outside bigint, low_inside bigint, head string")
    by_place = Window.partitionBy("file").orderBy("block")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    ranges = summed.withColumn("parity", total("quotes") % 2)
    ranges = ranges.withColumns({"change": F.when(F.col("parity") == 0, F.col("outside")).otherwise(F.col("inside")), "low": F.when(F.col("parity") == 0, F.col("low_outside")).otherwise(F.col("low_inside"))})
    ranges = ranges.withColumn("depth", total("change"))
    ends_unit = F.when(F.col("low") + F.col("depth") <= form.level, F.col("block"))
    ranges = ranges.withColumn("start", F.coalesce(F.last(ends_unit, ignorenulls=True).over(before), F.first("block").over(by_place)))
    ranges = ranges.withColumn("mid", (F.col("block") > F.first("block").over(by_place)) & ~((F.col("parity") == 0) & (F.col("depth") <= form.level)))
    ranges = ranges.withColumn("head", F.first("head").over(by_place))
    at_end = ((F.col("parity") + F.col("quotes")) % 2 == 0) & (F.col("depth") + F.col("change") <= form.level)
    ranges.select("file", "block", "parity", "depth", "start", "mid", "head", (~at_end).alias("open")).write.parquet(scratch)
    ranges = spark.read.parquet(scratch)
    heads = [r["head"] for r in ranges.filter("block = 0").select("head").distinct().orderBy("head").limit(1001).collect()] if form == CSV else []
    if len(heads) > 1000:
        raise ValueError("more than 1000 different header lines")
    head_id = F.coalesce(F.array_position(F.array(*map(F.lit, heads)), F.col("head")) - 1, F.lit(0)).cast("int") if heads else F.lit(0)
    held = ranges.agg(F.count("*").alias("n"), F.coalesce(F.max("open"), F.lit(False)).alias("crossed")).first()
    near = ranges.select("file", "block", "parity", "depth", "start", "mid", head_id.alias("head_id"))
    columns = ("value", "file", "block", "parity", "depth", "start", "mid", "head_id")
    if held.n <= BROADCAST_RANGES:
        met = segments.join(F.broadcast(near), ["file", "block"]).select(*columns)
    else:
        met = segments.withColumn("seq", F.monotonically_increasing_id()).join(near, ["file", "block"]).sortWithinPartitions("file", "block", "seq").select(*columns)
    cut = met.mapInArrow(_cut(form), "file bigint, start bigint, block bigint, whole boolean, first boolean, closes boolean, head_id int, text string")
    found = cut.filter("whole").select("text", "first", "closes", "head_id")
    put = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
    crossing = cut.filter("NOT whole").groupBy("file", "start").agg(F.array_join(put, form.separator).alias("text"), F.max("first").alias("first"), F.max("closes").alias("closes"), F.max("head_id").alias("head_id"))
    return (found.unionAll(crossing.select(*found.columns)) if held.crossed else found), heads


def csv_rows(spark: SparkSession, path: str, columns: list[str], scratch: str) -> DataFrame:
    """The named columns of CSV files as strings, by each file's own header line; absent fields are empty.  Empty lines are left out."""
    found, heads = units(spark, path, CSV, scratch)
    records = found.filter(~F.col("first")).withColumn("text", F.regexp_replace("text", r"\r\z", "")).filter("text <> ''")
    options = {"quote": '"', "escape": '"'}
    picked = []
    for k, head in enumerate(heads):
        names = next(csv.reader([head.removesuffix("\r")]), [])
        fields = F.from_csv("text", ", ".join(f"f{i} string" for i in range(max(1, len(names)))), options)
        values = F.struct(*(F.coalesce(fields[f"f{names.index(c)}"], F.lit("")).alias(c) if c in names else F.lit("").alias(c) for c in columns))
        picked.append((k, values))
    rows = F.lit(None).cast("struct<" + ", ".join(f"`{c}`: string" for c in columns) + ">")
    for k, values in reversed(picked):
        rows = values if k == len(heads) - 1 else F.when(F.col("head_id") == k, values).otherwise(rows)
    return records.select(rows.alias("row")).select("row.*")


def json_entries(spark: SparkSession, path: str, schema: str, scratch: str) -> DataFrame:
    """``key, value`` of JSON objects, one a file; ``schema``: that of the whole object, a map."""
    found, _ = units(spark, path, JSON_OBJECT, scratch)
    text = F.when(F.col("first"), F.regexp_replace("text", r"\A\s*\{", "")).otherwise(F.col("text"))
    text = F.when(F.col("closes"), F.regexp_replace(text, r"\}\s*\z", "")).otherwise(text)
    entries = found.select(text.alias("text")).filter(F.trim("text") != "")
    return entries.select(F.explode(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), schema)).alias("key", "value"))
