"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash of a unit vector is the signed axis nearest to it after a pseudo-rotation: three rounds of random signs and
a fast Hadamard transform.  ``k`` such axes make a bucket.  Every vector is in one bucket of each of ``TABLES`` tables; a
query probes those buckets of each table whose axes are nearest to it.  How many follows from the data, at every size and
for every k: ``SAMPLED`` queries are answered by a scan of all vectors, and the probes are as many as reach the share
``REACHED`` of what they should find.  Of the least k whose buckets have ``BUCKET`` vectors at most, and the next, that one
is taken with which a query costs less, by what it ranks, probes and sends (``Range.cost``).  Candidates are ranked
exactly, by the inner product of the original vectors in double precision.

Vectors of different lengths are split into ranges of length, each ``RATIO`` times as long as the next; the last of the
``RANGES`` has all that are shorter.  Each range has tables of its own, which all queries probe.  In them vectors get one
more coordinate that fills them up to the longest of the range, so that the largest inner product is the nearest direction
(queries have 0 there).  So a few long vectors don't crowd the others into few buckets.

Buckets are dealt by a hash of their first axes into units of as many vectors as a task holds (``UNIT_BYTES``), so that a
query is sent to a unit once, with all buckets that it probes there.  A unit's vectors and queries are split by hash into
blocks (``BLOCK_BYTES`` of vectors, ``BLOCK`` queries); a task sees one block of each and returns each query's nearest there.  So no bucket is capped and none has to fit into a task.
Queries whose buckets hold fewer than ``top`` vectors are ranked against all vectors, in the same blocks.

Defined cases: vectors that are null or zero, hold nulls or non-finite numbers, have no id or not the commonest number of
dimensions take no part.  Of rows with the same id the smallest vector counts, once.  Equal scores go by the smaller id.
The result has columns of its own, whatever other columns there are.  An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

TABLES = 10
#: Queries of a block, and rows that a scan multiplies at a time.
BLOCK = 4096
#: Vectors that a bucket has on average, at most.
BUCKET = 8192
#: Bytes of vectors that a unit has on average, at most, and a block.
UNIT_BYTES, BLOCK_BYTES = 32 << 20, 48 << 20
#: What a probe and a copy of the query that is sent to a unit cost, in vectors ranked.
PROBE, COPY = 0.25, 20
#: Pairs that a task ranks at a time, about, and whose vectors it multiplies at a time.
PAIRS, PRODUCTS = 1 << 18, 1 << 14
BROADCAST_UNITS = 500_000
#: Queries that are answered by a scan to set the probes, and the share of their neighbours that these must reach.
SAMPLED, REACHED = 128, 0.95
RATIO, RANGES = 1.5, 12
#: Rows of a batch that a query's probes make, about.
EMITTED = 1 << 14


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part."""
    vec = C.own(vectors, vector_col).cast("array<double>")
    sound = F.forall(vec, lambda x: F.coalesce((x - x) == 0, F.lit(False))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(C.own(vectors, id_col).cast("bigint").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & F.col("vec").isNotNull()).filter(sound)
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).select("d").first()
    kept = rows.filter(F.size("vec") == (size.d if size else 0))
    return kept.groupBy("id").agg(F.min("vec").alias("vec"))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def pseudo_rotation(x: np.ndarray, table: int, part: int) -> np.ndarray:
    signs = np.random.default_rng([41, table, part])
    for _ in range(3):
        x = _hadamard(x * signs.choice([-1.0, 1.0], x.shape[1]))
    return x


def nearest_buckets(x: np.ndarray, table: int, k: int, probes: int) -> np.ndarray:
    """The ``probes`` buckets of a table nearest to each row, best first."""
    axes = 2 * x.shape[1]
    for part in range(k):
        turned = pseudo_rotation(x, table, part)
        value = np.concatenate((turned, -turned), axis=1)
        best = np.argsort(-value, axis=1, kind="stable")[:, : min(probes, axes)]
        near = np.take_along_axis(value, best, axis=1)
        if part:
            # of two sorted lists, only these places can be among the first sums
            i, j = np.nonzero(np.outer(np.arange(1, code.shape[1] + 1), np.arange(1, best.shape[1] + 1)) <= probes)  # noqa: F821
            near = score[:, i] + near[:, j]  # noqa: F821
            best = code[:, i] * axes + best[:, j]  # noqa: F821
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            best, near = np.take_along_axis(best, order, axis=1), np.take_along_axis(near, order, axis=1)
        score, code = near, best
    return code


def places(q: np.ndarray, x: np.ndarray, table: int, k: int) -> np.ndarray:
    """How many buckets of a table are nearer to the query ``q[i]`` than that of the vector ``x[i]``."""
    own, all_ = np.zeros(len(q)), []
    for part in range(k):
        value, held = (np.concatenate((v, -v), axis=1) for v in (pseudo_rotation(q, table, part), pseudo_rotation(x, table, part)))
        own += np.take_along_axis(value, held.argmax(axis=1)[:, None], axis=1)[:, 0]
        all_.append(value)
    out = np.zeros(len(q), np.int64)
    for i in range(len(q)):
        left, right = (functools.reduce(lambda a, b: np.add.outer(a, b).ravel(), [v[i] for v in some], np.zeros(1)) for some in (all_[: k // 2], all_[k // 2 :]))
        right = np.sort(right)
        out[i] = (len(right) - np.searchsorted(right, own[i] - left + 1e-12, "right")).sum()
    return out


class Range(NamedTuple):
    """Vectors of about one length: how many, in how many units, the longest, their tables ``first``, ``first + 1``, ...,
    axes of a bucket, probes."""

    size: int
    units: int
    longest: float
    first: int
    tables: int
    k: int
    probes: int

    def cost(self, axes: int) -> float:
        """What a query costs in a table, in vectors ranked: those of its buckets, its probes, its copies."""
        return self.probes * (self.size / axes**self.k + PROBE) + min(self.units, self.probes) * COPY

    def unit(self, bucket: np.ndarray, axes: int) -> np.ndarray:
        """Where buckets are sent: by as few of their first axes as tell enough units apart."""
        j = 1
        while j < self.k and axes**j < 4 * self.units:
            j += 1
        hashed = (bucket // axes ** (self.k - j) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((hashed >> np.uint64(32)) % np.uint64(self.units)).astype(np.int32)


def _scanned(rows: DataFrame, queries: pa.Table, top: int) -> pa.Table:
    """``query_id, vec, r`` of the ``top`` nearest of a few queries among all rows."""
    own, q = queries["id"].to_numpy(), queries["vec"].combine_chunks().flatten().to_numpy().reshape(len(queries), -1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, vec, kind = np.full((len(q), top), -np.inf), np.zeros((len(q), top, q.shape[1])), np.zeros((len(q), top), np.int32)
        for batch in batches:
            if not len(batch):
                continue
            ids, x, r = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(len(batch), -1), batch.column(2).to_numpy()
            for i in range(0, len(ids), BLOCK):
                new = q @ x[i : i + BLOCK].T
                new[own[:, None] == ids[None, i : i + BLOCK]] = -np.inf
                both = np.concatenate((score, new), axis=1)
                best = np.argpartition(-both, top - 1, axis=1)[:, :top]
                score = np.take_along_axis(both, best, axis=1)
                old = best < top
                kept, new = np.where(old, best, 0), i + np.where(old, 0, best - top)
                vec = np.where(old[:, :, None], np.take_along_axis(vec, kept[:, :, None], axis=1), x[new])
                kind = np.where(old, np.take_along_axis(kind, kept, axis=1), r[new])
        a, b = np.nonzero(score > -np.inf)
        vecs = pa.array(list(vec[a, b]), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(score[a, b]), vecs, pa.array(kind[a, b])], names=["query_id", "score", "vec", "r"])

    found = rows.select("id", "vec", "r").mapInArrow(C.released(scan), "query_id bigint, score double, vec array<double>, r int")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "vec", "r").toArrow()


def _widened(x: np.ndarray, width: int, longest: float | None = None) -> np.ndarray:
    """Vectors by the longest and filled up to its length; queries (no longest) to unit length."""
    norm = np.sqrt((x * x).sum(axis=1))
    wide = np.zeros((len(x), width))
    wide[:, : x.shape[1]] = x / (norm[:, None] if longest is None else longest)
    if longest is not None and width > x.shape[1]:
        wide[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (norm / longest) ** 2))
    return wide


def needed(q: np.ndarray, x: np.ndarray, of: Range) -> int:
    """Probes with which the queries ``q[i]`` reach the share ``REACHED`` of their neighbours ``x[i]``."""
    first = np.sort(np.min([places(q, x, t, of.k) for t in range(of.first, of.first + of.tables)], axis=0))
    return int(first[math.ceil(REACHED * len(first)) - 1]) + 1


def _bucketed(vectors: DataFrame, width: int, ranges: dict[int, Range], query: bool) -> DataFrame:
    """``id, vec, t, unit, buckets``: a row for each unit with buckets that a vector is in, or a query probes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vec, own = batch.column(1), batch.column(2).to_numpy()
            x = vec.flatten().to_numpy().reshape(len(batch), -1)
            for r, of in ranges.items():
                at = np.arange(len(x)) if query else np.flatnonzero(own == r)
                wide = _widened(x[at], width, None if query else of.longest)
                probes = of.probes if query else 1
                step = max(16, EMITTED // probes)
                for t, i in itertools.product(range(of.first, of.first + of.tables), range(0, len(at), step)):
                    b = nearest_buckets(wide[i : i + step], t, of.k, probes)
                    row, bucket = np.repeat(at[i : i + len(b)], b.shape[1]), b.ravel().astype(np.int64)
                    unit = of.unit(bucket, 2 * width)
                    order = np.lexsort((unit, row))
                    row, bucket, unit = row[order], bucket[order], unit[order]
                    starts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (unit[1:] != unit[:-1]))))
                    rows, lists = pa.array(row[starts]), pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)).astype(np.int32)), pa.array(bucket))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), vec.take(rows), pa.array(np.full(len(starts), t, np.int32)), pa.array(unit[starts]), lists], names=["id", "vec", "t", "unit", "buckets"]
                    )

    return vectors.select("id", "vec", "r").mapInArrow(C.released(place), "id bigint, vec array<double>, t int, unit int, buckets array<bigint>")


def _ranked(top: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table, pa.Table], pa.Table]:
    """Each query's ``top`` nearest of the vectors of a block that are in its buckets, equal scores by id."""

    def rank(key: tuple[pa.Scalar, ...], queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(block):
            ids, held = block["id"].to_numpy(), block["buckets"].combine_chunks().flatten().to_numpy()  # a vector is in one
            order = np.lexsort((ids, held))
            q, x = (t["vec"].combine_chunks().flatten().to_numpy().reshape(len(t), -1) for t in (queries, block))
            ids, x, held = ids[order], x[order], held[order]
            own, probed = queries["id"].to_numpy(), queries["buckets"].combine_chunks()
            asking, probed = np.repeat(np.arange(len(own)), probed.value_lengths().to_numpy()), probed.flatten().to_numpy()
            first = np.searchsorted(held, probed, "left")
            many = np.searchsorted(held, probed, "right") - first
            ends = np.cumsum(np.bincount(asking, many, len(own)).astype(np.int64))
            done = 0
            while done < len(own):
                # whole queries; one has no more pairs than the block has vectors
                to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
                a, b = np.searchsorted(asking, (done, to))
                n = many[a:b]
                i = np.repeat(asking[a:b], n)
                j = np.arange(len(i)) + np.repeat(first[a:b] - (np.cumsum(n) - n), n)
                other = ids[j] != own[i]
                i, j, done = i[other], j[other], to
                score = np.concatenate([np.einsum("pd,pd->p", q[i[m : m + PRODUCTS]], x[j[m : m + PRODUCTS]]) for m in range(0, len(i), PRODUCTS)] or [np.zeros(0)])
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                place = np.arange(len(i)) - np.searchsorted(i, i, "left")
                near = place < top
                out.append((own[i[near]], ids[j[near]], score[near]))
        a, b, s = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.Table.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["query_id", "vec_id", "score"])

    return rank


def neighbours(vectors: DataFrame, is_query: Column, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, block: int | None = None, bucket_size: int = BUCKET) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest found of each row for which ``is_query`` (of the column ``id``) holds."""
    rows = C.cut(usable(vectors, id_col, vector_col))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, d, shortest, longest = rows.agg(F.count("*"), F.max(F.size("vec")), F.min(norm), F.max(norm)).first()
    d, longest = d or 1, longest or 1.0
    same = n == 0 or longest - shortest <= 1e-4 * longest
    width = 1 << (d + (not same) - 1).bit_length()
    # logarithms are null for 0 and infinite beyond doubles; those lengths are in the last range and the first
    steps = F.coalesce(F.nanvl((F.lit(math.log(longest)) - F.ln(norm)) / math.log(RATIO), F.lit(0.0)), F.lit(float(RANGES)))
    rows = rows.withColumn("r", F.lit(0) if same else F.floor(F.greatest(F.lit(0.0), F.least(steps, F.lit(RANGES - 1.0)))).cast("int"))
    held = sorted(rows.groupBy("r").agg(F.count("*").alias("n"), F.max(norm).alias("longest")).collect())
    sample = rows.filter(is_query).orderBy(F.xxhash64("id"), "id").limit(SAMPLED).toArrow()
    found, at = _scanned(rows, sample, top) if len(sample) else None, {v: i for i, v in enumerate(sample["id"].to_pylist())}
    if found is not None:
        q, x = (c.combine_chunks().flatten().to_numpy().reshape(len(c), d) for c in (sample["vec"], found["vec"]))
        asking = _widened(q[[at[v] for v in found["query_id"].to_pylist()]], width)
    ranges: dict[int, Range] = {}
    for i, (r, size, most) in enumerate(held):
        k = 1
        while size > bucket_size * (2 * width) ** k:
            k += 1
        of = Range(size, -(-size * d * 8 // UNIT_BYTES), most or 1.0, i * tables, tables, k, 1)
        if found is not None and (mine := found["r"].to_numpy() == r).any():
            filled = _widened(x[mine], width, of.longest)
            both = [of._replace(k=k), of._replace(k=k + 1)]
            of = min((o._replace(probes=needed(asking[mine], filled, o)) for o in both), key=lambda o: o.cost(2 * width))
        ranges[r] = of
    inside, asked = _bucketed(rows, width, ranges, False), _bucketed(rows.filter(is_query), width, ranges, True)

    blocks = (block or BLOCK, block or max(1, BLOCK_BYTES // (8 * d)))
    near = C.cut(_best(_met(inside, asked, top, *blocks), top))
    counts = near.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("found"))
    short = rows.filter(is_query).join(counts, "id", "left").filter(F.coalesce("found", F.lit(0)) < min(top, n - 1)).select("id", "vec", "r")
    short = C.cut(short)
    if short.limit(1).count():
        one = [F.lit(-1).alias("t"), F.lit(0).alias("unit"), F.array(F.lit(0).cast("bigint")).alias("buckets")]  # all vectors as one bucket
        all_ = rows.select(F.col("id").alias("id"), F.col("vec").alias("vec"), *one)  # columns that short's can be told from
        rest = _best(_met(all_, short.select("id", "vec", *one), top, *blocks), top)
        near = near.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionAll(rest)
    return near


def _met(inside: DataFrame, asked: DataFrame, top: int, q_block: int, c_block: int) -> DataFrame:
    """``query_id, vec_id, score`` of the ``top`` nearest of each query in each block of its units."""

    def blocks(of: DataFrame, name: str, block: int) -> DataFrame:
        return of.groupBy("t", "unit").agg(F.ceil(F.count("*") / block).cast("int").alias(name))

    keys = ["t", "unit"]
    sizes = C.cut(blocks(inside, "c_blocks", c_block).join(blocks(asked, "q_blocks", q_block), keys))
    sizes = C.bounded_broadcast(sizes, sizes.count(), BROADCAST_UNITS)

    def dealt(of: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        placed = of.join(sizes, keys).withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        return placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("t", "unit", "q", "c", "id", "vec", "buckets")

    units = ["t", "unit", "q", "c"]
    left, right = dealt(asked, "q_blocks", "c_blocks", "q", "c").groupBy(*units), dealt(inside, "c_blocks", "q_blocks", "c", "q").groupBy(*units)
    return left.cogroup(right).applyInArrow(_ranked(top), "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, top: int) -> DataFrame:
    """Each query's ``top`` nearest of all that its blocks gave."""
    each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(C.table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {"op7_ann": op7_ann}
ORACLE_SQL: dict[str, str] = {}
