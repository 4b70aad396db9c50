"""Keys and groups larger than those of the smallest driver tables."""

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quarry.plans import landed  # noqa: F401  (adds its queries)
from quarry.plans import queries as plans
from quarry.streaming import incremental
from test_oracle import rows


def same_as_sql(spark, name, **tables):
    """Over tables that were written to these folders."""
    duck = duckdb.connect()
    for t, path in tables.items():
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    got, want = plans.QUERIES[name](spark, next(iter(tables.values()))), duck.execute(plans.ORACLE_SQL[name])
    assert rows(got.columns, got.collect()) == rows([d[0] for d in want.description], want.fetchall())


def test_images_wider_than_a_jpeg(spark, tmp_path):
    keys = [0, 1, 65_434, 65_435, 65_436, 65_437, 65_437, 130_969, 130_971, 130_973, 1_199_999, 1_200_001, 1_200_002]
    spark.createDataFrame([(k, i % 50 + 1) for i, k in enumerate(keys)], "p_partkey bigint, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    same_as_sql(spark, "binary_features", part=str(tmp_path))


def pages_of_orders(spark, path, n):
    """``lineitem`` of ``n`` orders of one listing and a few of another, in no order."""
    lines = spark.range(n).select((20 * F.floor(F.col("id") / 7) % 1000).alias("l_suppkey"), (3 * F.col("id") + (F.col("id") > n - 4).cast("long")).alias("l_orderkey"))
    few = spark.range(40).select(F.lit(1).cast("bigint").alias("l_suppkey"), (F.col("id") * F.col("id")).alias("l_orderkey"))
    lines.unionAll(few).orderBy(F.xxhash64("l_orderkey")).write.parquet(f"{path}/lineitem.parquet")


def test_streaks_of_more_pages_than_a_piece(spark, tmp_path):
    """A listing of 30,000 pages stops at the end of all; Spark hands it over in pieces of 10,000 in no order."""
    pages_of_orders(spark, tmp_path, 30_000)
    same_as_sql(spark, "stream_streaks", lineitem=str(tmp_path))


def test_streaks_of_a_run_of_many_files(spark, tmp_path):
    """More files than a batch took, in no order."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    pages_of_orders(spark, tmp_path, 900)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 120)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        same_as_sql(spark, "stream_streaks", lineitem=str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


class State:
    """What a listing's state is, as Spark would keep it."""

    hasTimedOut = False

    def __init__(self):
        self.get, self.exists = None, False

    def update(self, value):
        self.get, self.exists = value, True


def follow_of(monkeypatch, spark, most):
    """``follow`` of ``late_streaks`` with pages ``n`` that are their own numbers."""
    kept = []
    stream = spark.createDataFrame([], "q string, n long, page long, got boolean")
    monkeypatch.setattr(type(stream.groupBy("q")), "applyInPandasWithState", lambda self, f, *a: kept.append(f))
    incremental.late_streaks(stream, "q", "n", "page", "got", most)
    return kept[0]


def test_late_pages_behind_a_sure_stop_are_not_held(spark, monkeypatch):
    """300,000 pages of which the first never comes before the others: the state stays small, and what comes out is the same."""
    follow, state, rng = follow_of(monkeypatch, spark, 3), State(), np.random.default_rng(2)
    got = rng.random(300_000) < 0.4
    got[:8] = True
    dealt = np.append(rng.permutation(np.arange(1, len(got))), 0)
    out, most = [], 0
    for numbers in np.array_split(dealt, 3):
        frames = (pd.DataFrame({"n": x, "page": 10 * x, "got": got[x]}) for x in np.array_split(numbers, 10))
        out += [(r.page, r.streak, r.stop) for x in follow(("a",), frames, state) for r in x.itertuples()]
        most = max(most, len(str(state.get)))
    want, streak = [], 0
    for k, y in enumerate(got):
        streak = 0 if y else streak + 1
        want.append((10 * k, streak, streak >= 3))
        if streak >= 3:
            break
    assert out == want
    assert most < 20_000


def test_late_pages_that_may_all_count_are_held(spark, monkeypatch):
    """No page is dropped where no stop is sure; pages that come twice count once."""
    follow, state, rng = follow_of(monkeypatch, spark, 2), State(), np.random.default_rng(3)
    dealt = np.append(rng.permutation(np.arange(1, 50_000)), [5, 7, 0, 7])
    out = []
    for x in np.array_split(dealt, 4):
        out += [(r.page, r.streak) for y in follow(("a",), iter([pd.DataFrame({"n": x, "page": x, "got": x % 2 == 0})]), state) for r in y.itertuples()]
    assert out == [(k, k % 2) for k in range(50_000)]


def test_late_pages_of_many_orders(spark, tmp_path):
    pages_of_orders(spark, tmp_path, 9_000)
    same_as_sql(spark, "stream_late_pages", lineitem=str(tmp_path))
