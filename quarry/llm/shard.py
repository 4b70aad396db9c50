"""Sharding: a two-pass external shuffle into shards that follow from the document id.

The law is ``key``: a document's shard is the one whose hash with its id is highest, so one more shard takes rows only
into itself, and nothing else moves.

1. Scatter: a seeded hash deals each shard's records uniformly into buckets whose number follows the shard's bytes, so
   that a bucket is about ``BUCKET_BYTES`` and fits in a task's memory.  This is the only shuffle of texts.  Records that
   are the same in all columns and together more than a part of a bucket are carried once with their number, and dealt
   copy by copy, so that they fill no bucket either.
2. Each bucket is put in a fixed order, shuffled by Fisher-Yates with a seed of its own and written.

A record's slot is its place in its bucket after the records of the shard's earlier buckets: gapless, and since the
scatter is uniform the whole shard is in random order.  A task that is lost is simply run again with the same outcome.

Defined cases: a null text has no bytes and the checksum of the empty text; a null id is a key of its own (its records
all belong to one shard but are dealt over its buckets by what else they hold).  A text longer than a bucket is a bucket's
whole content and more: the longest text bounds memory.  Records that are the same in all columns are interchangeable.
Input columns called shard or slot, in any case of letters, are replaced; any other name may have dots or be nested.  An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from . import common as C

SHARDS = 24
BUCKET_BYTES = 16 << 20
#: Buckets up to which their table of offsets is broadcast, and repeated records up to which theirs is.
BROADCAST_BUCKETS = 500_000
#: The part of a bucket beyond which a record's copies are dealt one by one.
PART = 4
OWN = ("shard", "slot")


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def _score(key: Column, shard: Column) -> Column:
    return F.xxhash64(key.isNull(), key, shard)


def shard_of(key: Column, n: int) -> Column:
    """The shard of highest score among 0 to n - 1, ties to the smaller."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: F.struct(_score(key, s).alias("score"), (-s).alias("s"))))
    return -best["s"]


def _hashable(c: Column, kind: DataType) -> Column:
    """Maps have no hash in Spark: as JSON."""
    return F.to_json(F.struct(c)) if "map<" in kind.simpleString() else c


def _shuffled(seed: int, columns: list[str]) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    """Fisher-Yates over one bucket, from an order that depends on its records alone."""

    def shuffle(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        shard, cell = (int(k.as_py()) for k in key)
        order = np.lexsort([bucket["__tie"].to_numpy(), bucket["__order"].to_numpy()])
        n = len(order)
        draws = (np.random.default_rng([seed, shard, cell]).random(n) * np.arange(1, n + 1)).astype(np.int64)
        for i in range(n - 1, 0, -1):
            j = draws[i]
            order[i], order[j] = order[j], order[i]
        slot = bucket["__offset"].to_numpy() + np.arange(n)
        out = bucket.select([f"__c{k}" for k in range(len(columns))]).take(pa.array(order)).rename_columns(columns)
        return out.append_column("shard", pa.array(np.full(n, shard, np.int32))).append_column("slot", pa.array(slot))

    return shuffle


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 29, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long), each bucket's rows together and in order."""
    C.importable(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in OWN]
    own = [C.own(docs, c).alias(f"__c{k}") for k, c in enumerate(kept)]
    hashed = [_hashable(C.own(docs, c), docs.schema[c].dataType) for c in kept]
    named = [x for c in hashed for x in (c.isNull(), c)]  # a null is not the same as nothing
    key, text = C.own(docs, id_col), C.own(docs, text_col)
    dealt = docs.select(shard_of(key, n_shards).alias("__shard"), F.xxhash64(F.lit(seed), *named).alias("__order"), F.xxhash64(*reversed(named)).alias("__tie"), size_of(text).alias("__size"), *own)
    bytes_of = {r["__shard"]: r.b for r in dealt.groupBy("__shard").agg(F.sum("__size").alias("b")).collect()}  # one row a shard
    heavy = dealt.groupBy("__order", "__tie").agg(F.count("*").alias("__n"), F.max("__size").alias("s")).filter((F.col("__n") > 1) & (F.col("__n") * F.col("s") > bucket_bytes // PART)).drop("s")
    heavy = C.cut(heavy)
    if n := heavy.count():  # at most PART for each bucket
        met = dealt.join(C.bounded_broadcast(heavy, n, BROADCAST_BUCKETS), ["__order", "__tie"], "left")
        once = met.filter("__n IS NOT NULL").dropDuplicates(["__order", "__tie"])
        copies = once.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).withColumn("__order", F.xxhash64("__order", "__copy"))
        dealt = met.filter("__n IS NULL").select(*dealt.columns).unionAll(copies.select(*dealt.columns))
    buckets = F.array(*(F.lit(max(1, -(-bytes_of.get(s, 0) // bucket_bytes))) for s in range(n_shards)))
    dealt = dealt.withColumn("__cell", F.pmod("__order", F.get(buckets, F.col("__shard"))))
    counts = dealt.groupBy("__shard", "__cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__shard", "__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    n = sum(max(1, -(-b // bucket_bytes)) for b in bytes_of.values())
    rows = dealt.join(C.bounded_broadcast(offsets, n, BROADCAST_BUCKETS), ["__shard", "__cell"])
    schema = C.struct({c: docs.schema[c].dataType for c in kept} | {"shard": "int", "slot": "bigint"})
    return rows.groupBy("__shard", "__cell").applyInArrow(_shuffled(seed, kept), schema)


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the shards to ``path``, a folder for each, and returns them as read again."""
    shard_documents(docs, **options).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = write_shards(docs, C.scratch(spark, "shards"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return shards.select("doc_id", size_of(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"))


QUERIES = {"op9_shard": op9_shard}
ORACLE_SQL: dict[str, str] = {}
