"""Periodic runs: every maximal stretch of a text's words that repeats itself with some period.

A run has a smallest period q, at least two periods and at least ``LEAST`` words, and ends where a neighbour breaks the period.
Texts are taken some at a time, as one row of words in which no two texts share a letter:

1. Suffix array by prefix doubling; the ranks of all doublings are kept.  They tell the longest common prefix (and,
   read backwards, suffix) of any two places, so also that of neighbours in the suffix array.
2. The longest previous factor at each place is shared with one of its two nearest neighbours, in the suffix array, that stand
   earlier in the text.  It gives the LZ blocks.
3. A run that meets a block's border has a period shorter than the two blocks beside that border together.  For each
   border and such a period, extensions to both sides give the maximal stretch; of equal stretches, the smallest period counts.
4. A run within a block is a copy of one in the block's source: runs, in buckets by their start, are copied from there.

A text in which all stretches of half of ``LEAST`` words differ has no run and needs none of this: a run holds its first such
stretch again, one period on.

One scan, no shuffle.  Time follows n log n words whatever the text; memory follows ``common.CHUNK_BYTES``, or the longest text.

Defined cases: a null or empty text, or one of white space, has no words and no runs.  A null id stays null, and its text isn't
changed where others' are.  Repeated rows are reported one by one.  Texts of any length are whole.  Other columns are ignored,
whatever their names.  An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LEAST = 12
#: Pairs of a border and a period that are looked at together.
PAIRS = 1 << 20


def doubled_ranks(letters: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: ranks of the stretches of 2^k letters from each place on, equal where these are; in the last all differ.
    The last letter must occur once.  A stretch's rank is the first place in the suffix array that begins with it."""
    n = len(letters)
    order = np.argsort(letters, kind="stable")
    new = np.ones(n, bool)
    new[1:] = letters[order[1:]] != letters[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width, left = [rank], 1, order[~(new & np.append(new[1:], True))]
    while len(left):
        own, after = rank[left].astype(np.int64), rank[np.minimum(left + width, n - 1)].astype(np.int64)
        key = own * n + after
        by = np.argsort(key, kind="stable")
        left, own, key, m = left[by], own[by], key[by], len(left)
        fresh, group = np.ones(m, bool), np.ones(m, bool)
        fresh[1:], group[1:] = key[1:] != key[:-1], own[1:] != own[:-1]
        at = np.arange(m)
        rank = rank.copy()
        rank[left] = own + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        levels.append(rank)
        left = left[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    return levels


def common_prefix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many letters from i and from j on are equal; i and j differ."""
    size = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size += (levels[k][i + size] == levels[k][j + size]).astype(np.int64) << k
    return size


def common_suffix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many letters before i and before j are equal; i < j."""
    size = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i - size - (1 << k), j - size - (1 << k)
        size += ((a >= 0) & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)])).astype(np.int64) << k
    return size


def previous_factors(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """At each place, the length of the longest stretch that also begins earlier, and where."""
    n = len(levels[0])
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    stack: list[int] = []
    before, after = [-1] * n, [-1] * n  # by place in the text
    for place in suffixes.tolist():
        while stack and stack[-1] > place:
            after[stack.pop()] = place
        if stack:
            before[place] = stack[-1]
        stack.append(place)
    size, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for found in (np.array(before), np.array(after)):
        at = np.flatnonzero(found >= 0)
        shared = common_prefix(levels, found[at], at)
        better = shared > size[at]
        size[at[better]], source[at[better]] = shared[better], found[at[better]]
    return size, source


def blocks(factors: np.ndarray) -> np.ndarray:
    """Where the LZ blocks begin, and the end of the last."""
    step, at, out = np.maximum(factors, 1).tolist(), 0, []
    while at < len(step):
        out.append(at)
        at += step[at]
    return np.array([*out, len(step)], np.int64)


def _at_borders(levels: list[np.ndarray], border: np.ndarray, least: int) -> np.ndarray:
    """Rows of start, end, period of the runs that meet a border between blocks."""
    n, found = len(levels[0]), [np.zeros((0, 3), np.int64)]
    reach = border[2:] - border[:-2]  # periods 1 to reach of borders 1, 2, ...
    ends = np.cumsum(reach)
    for a in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        flat = np.arange(a, min(a + PAIRS, int(ends[-1])))
        which = np.searchsorted(ends, flat, "right")
        period, at = flat - (ends - reach)[which] + 1, border[1:-1][which]
        for first in (at - period, at):
            inside = (first >= 0) & (first + period < n)
            i, p = first[inside], period[inside]
            # extensions of max(p, least - p) words in all, so of half of `least` at least: 2 or more on one side
            two = levels[min(1, len(levels) - 1)]
            near = (two[i] == two[i + p]) | ((i >= 2) & (two[i - 2] == two[i + p - 2]))
            i, p = i[near], p[near]
            back, on = common_suffix(levels, i, i + p), common_prefix(levels, i, i + p)
            keep = back + on >= np.maximum(p, least - p)
            found.append(np.stack([i - back, i + p + on, p], axis=1)[keep])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]


def find_runs(letters: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows of start, end (exclusive) and period, by start and period, of all runs of ``least`` letters or more.  The last letter must
    occur once."""
    levels = doubled_ranks(letters)
    size, source = previous_factors(levels)
    border = blocks(size)
    met = _at_borders(levels, border, least)
    starts, rows = met[:, 0].tolist(), met.tolist()
    copied: list[list[int]] = []
    copied_starts: list[int] = []
    for b in border[:-1][size[border[:-1]] >= least + 2].tolist():
        shift, end = b - int(source[b]), b + int(size[b])
        lists = ((starts, rows), (copied_starts, copied))
        span = [(bisect_right(s, b - shift), r) for s, r in lists]
        # of this block's own copies, those within the source again are met as they are appended
        new: list[list[int]] = []
        for k, r in span:
            while k < len(r) and r[k][0] < end - shift:
                if r[k][1] < end - shift and not (r is rows and r[k][0] > b):
                    new.append([r[k][0] + shift, r[k][1] + shift, r[k][2]])
                k += 1
        for run in new:  # grows
            if run[1] < end - shift:
                new.append([run[0] + shift, run[1] + shift, run[2]])
        new.sort()
        copied += new
        copied_starts += [r[0] for r in new]
    both = np.array(rows + copied, np.int64).reshape(-1, 3)
    return both[np.lexsort((both[:, 2], both[:, 0]))]


def _planted(h: int, n: int) -> tuple[int, int]:
    """Where a text of n words begins to repeat, and with which period."""
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: Column | None = None, least: int = LEAST) -> DataFrame:
    """One row for each document row: its id, ``n_words``, ``runs`` (``start, length, period``, by start and period) and ``collapsed``: its words, a
    space between, without those that a run has after its first period.

    Where ``planted`` is a number that ends in 0, the text's end is replaced by repetitions, as the test of this operator wants it.
    """
    C.importable(docs.sparkSession)
    names = ["id", "n_words", "runs", "collapsed"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    half = least // 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marks = batch.columns
            for i, j, data, at in C.chunks(texts):
                t = C.tokenize(data, at, C.SPACE_CLASS)
                first, source = t.first, np.arange(len(t.start))
                for d, h in enumerate(marks[i:j].to_pylist()):
                    n = int(first[d + 1] - first[d])
                    if h is not None and h % 10 == 0 and n:
                        a, p = _planted(h, n)
                        source[first[d] + a : first[d + 1]] = first[d] + a + np.arange(n - a) % p
                h = C.span_hashes(data, t.start, t.end, C.BYTE_VALUE)[source]
                doc = t.doc
                h = C.mix(h ^ C.mix(doc.astype(np.uint64) + np.uint64(1)))  # no two texts share a letter
                grams, place = C.grams(C.Tokens(data, t.start, t.end, h, first), half)
                order = np.argsort(grams, kind="stable")
                again = place[order[1:][grams[order[1:]] == grams[order[:-1]]]]
                some = np.unique(doc[again])
                found = np.zeros((0, 3), np.int64)
                if len(some):
                    sizes = (first[some + 1] - first[some]).astype(np.int64)
                    last = np.cumsum(sizes + 1) - 1  # where each text's end stands
                    move = np.repeat(first[some] - (last - sizes), sizes + 1)
                    where = np.arange(len(move)) + move
                    ending = np.zeros(len(move), bool)
                    ending[last] = True
                    _, letters = np.unique(h[np.where(ending, 0, where)], return_inverse=True)
                    letters[ending] = len(where) + np.arange(len(some))
                    found = find_runs(letters, least)
                    shift = move[found[:, 0]]
                    found[:, :2] += shift[:, None]
                dropped = np.zeros(len(t.start) + 1, np.int64)
                np.add.at(dropped, found[:, 0] + found[:, 2], 1)
                np.add.at(dropped, found[:, 1], -1)
                kept = np.flatnonzero(np.cumsum(dropped)[:-1] == 0)
                word = source[kept]
                raw, low, high = data.tobytes(), t.start[word].tolist(), t.end[word].tolist()
                words = [raw[a:z] for a, z in zip(low, high, strict=True)]
                parts = np.searchsorted(kept, first).tolist()
                collapsed = pa.array([b" ".join(words[a:z]) for a, z in zip(parts[:-1], parts[1:], strict=True)], pa.binary()).view(pa.string())
                counts = np.searchsorted(found[:, 0], first)
                begin = found[:, 0] - first[doc[found[:, 0]]]
                structs = pa.StructArray.from_arrays([pa.array(begin), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], fields=list(run))
                yield pa.RecordBatch.from_arrays([ids[i:j], pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), structs), collapsed], names=names)

    mark = F.lit(None) if planted is None else planted
    rows = docs.select(C.own(docs, id_col).alias("id"), C.own(docs, text_col).alias("text"), mark.cast("bigint").alias("mark"))
    schema = C.schema(rows, "id", n_words="bigint", runs="array<struct<start:bigint,length:bigint,period:bigint>>", collapsed="string")
    return rows.mapInArrow(C.released(find), schema).withColumnRenamed("id", id_col)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = periodic_runs(docs, planted=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumns({"best": best, "all": F.array_join(lines, "")})
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2("all", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE_SQL: dict[str, str] = {}
