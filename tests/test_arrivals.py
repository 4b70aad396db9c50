"""Arrivals against a version that goes one by one: chains, components, memory between batches."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import items
from quarry.sources import versions
from quarry.streaming import incremental
from test_engine import greedy


def outcomes(spark, pairs):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pairs)], "i int, url string, hash int").repartition(3)
    return [r.outcome for r in items.first_arrivals(df, "url", "hash", ["i"]).orderBy("i").collect()]


def test_a_long_chain_takes_few_jobs(spark):
    """Each item shares its URL with the one before it and its content with the one after: 100,000 in one chain."""
    n = 100_000
    pairs = spark.range(n).select(F.col("id").alias("i"), F.floor((F.col("id") + 1) / 2).alias("url"), F.floor(F.col("id") / 2).alias("hash"))
    began = time.time()
    got = items.first_arrivals(pairs, "url", "hash", ["i"]).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("i").alias("s")).collect()
    want = greedy([((i + 1) // 2, i // 2) for i in range(n)])
    assert {r.outcome: (r.n, r.s) for r in got} == {o: (want.count(o), sum(i for i, w in enumerate(want) if w == o)) for o in set(want)}
    assert time.time() - began < 60


@pytest.mark.parametrize("settle", [0, 6, 40])
def test_components_are_settled_apart(spark, monkeypatch, settle):
    monkeypatch.setattr(items, "SETTLE", settle)
    rng = np.random.default_rng(settle)
    pairs = [(f"u{k}" if (k := rng.integers(0, 30)) else None, int(h) if (h := rng.integers(0, 30)) else None) for _ in range(30)]
    pairs += [(f"c{(i + 1) // 2}", 1000 + i // 2) for i in range(8)]
    assert outcomes(spark, pairs) == greedy(pairs)


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100 + i, 101 + i) for i in range(30)] + [(-5, -5)]
    got = {r.node: r.component for r in items.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {v: v for e in edges for v in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == low


def test_small_images_are_not_remembered(spark):
    schema = "i int, url string, content_hash string, width int, height int"
    none = spark.createDataFrame([], schema)
    rows = [(1, "u1", "tiny", 10, 10), (2, "u1", "big", 2000, 2000), (3, "u2", "big", 2000, 2000), (4, "u2", "other", 900, 900)]
    assert sorted(r.i for r in items.new_items(spark.createDataFrame(rows, schema), none, ["i"]).collect()) == [2, 4]


def test_taken_until_the_target(spark):
    df = spark.createDataFrame([(k, "a" if k % 3 else None) for k in range(30)], "k int, by string").repartition(4)
    got = items.until_target(df, "by", ["k"], 12).collect()
    assert sorted(r.k for r in got) == sorted([k for k in range(30) if k % 3][:12] + [k for k in range(30) if k % 3 == 0])
    assert {(r.by, r.reached) for r in got} == {("a", True), (None, False)}


ITEM = "n int, url string, content_hash string, pixels int"


def land(spark, path, rows):
    spark.createDataFrame(rows, ITEM).coalesce(1).write.mode("append").parquet(path)


def test_memory_of_what_was_taken_alone(spark, tmp_path):
    rng, src = np.random.default_rng(9), str(tmp_path / "in")
    rows = [(k, f"u{rng.integers(0, 25)}", f"h{rng.integers(0, 25)}", int(rng.choice([10, 900]))) for k in range(90)]
    table = versions.Table(spark, str(tmp_path / "taken"), fan=2)
    for run in range(3):
        land(spark, src, rows[30 * run : 30 * run + 30])
        incremental.take_new(incremental.arriving(spark, src, ITEM), table, str(tmp_path / "mark"), ["n"], lambda df: df.filter("pixels > 100")).awaitTermination()
    large = [r for r in rows if r[3] > 100]
    want = [r[0] for r, o in zip(large, greedy([(r[1], r[2]) for r in large]), strict=True) if o == "ok"]
    assert sorted(r.n for r in table.read(ITEM).collect()) == want
    # a batch that is run again, since its commit was not noted, changes nothing
    before = table.versions()
    (tmp_path / "mark" / "commits" / "2").unlink()
    (tmp_path / "mark" / "commits" / ".2.crc").unlink(missing_ok=True)
    incremental.take_new(incremental.arriving(spark, src, ITEM), table, str(tmp_path / "mark"), ["n"], lambda df: df.filter("pixels > 100")).awaitTermination()
    assert table.versions() == before and sorted(r.n for r in table.read(ITEM).collect()) == want


def test_stream_stops_by_itself(spark, tmp_path):
    src = str(tmp_path / "in")
    for run in range(4):
        land(spark, src, [(10 * run + k, "u", "h", 1) for k in range(10)])
    table = versions.Table(spark, str(tmp_path / "taken"))
    assert incremental.take_until(incremental.arriving(spark, src, ITEM, files_per_batch=1), table, str(tmp_path / "mark"), ["n"], 23, 120) == 23
    assert sorted(r.n for r in table.read(ITEM).collect()) == list(range(23))
    assert incremental.take_until(incremental.arriving(spark, src, ITEM, files_per_batch=1), table, str(tmp_path / "mark"), ["n"], 30, 120) == 30
    assert sorted(r.n for r in table.read(ITEM).collect()) == [*range(23), *range(30, 37)]  # the rest of the cut batch is given up


def test_pages_in_any_order(spark, tmp_path):
    rng, src, out = np.random.default_rng(1), str(tmp_path / "in"), str(tmp_path / "out")
    pages = [(q, n, 100 + n, bool(rng.random() < 0.4)) for q in "abc" for n in range(20)]
    schema = "q string, number long, page int, got boolean"
    ordered = spark.createDataFrame(pages, schema)
    want = [(r.q, r.page, r.streak) for r in items.until_barren(ordered, ["q"], "number", F.col("got"), 3).collect()]
    shuffled = [pages[k] for k in rng.permutation(len(pages))]
    for run in range(4):
        spark.createDataFrame(shuffled[15 * run : 15 * run + 15] + shuffled[:5], schema).coalesce(1).write.mode("append").parquet(src)
        stream = incremental.late_streaks(incremental.arriving(spark, src, schema), "q", "number", "page", "got", 3)
        incremental.append_to(stream, out, str(tmp_path / "mark")).awaitTermination()
    assert sorted((r.q, r.page, r.streak) for r in spark.read.parquet(out).collect()) == sorted(want)


def test_mirror_by_digests(spark):
    from quarry.operators import sync

    rows = [(f"d{k % 9}/{k}.png", k % 5 if k % 11 else None) for k in range(500)]
    a = spark.createDataFrame([r for k, r in enumerate(rows) if k != 7] + [("top.png", 1)], "k string, v int")
    b = spark.createDataFrame([(n, v if k != 14 else 99) for k, (n, v) in enumerate(rows) if k not in (23, 32)] + [("d9/gone.png", 1)], "k string, v int")
    got = sorted(map(tuple, sync.sync_plan_by_digests(a, b, "k", "v", fine=8).collect()))
    assert got == sorted(map(tuple, sync.sync_plan(a, b, "k", "v").collect()))
    assert sorted({x for _, x in got}) == ["copy", "delete", "keep", "update"]
    assert {r.action for r in sync.sync_plan_by_digests(a, a, "k", "v").collect()} == {"keep"}
    assert sync.sync_plan_by_digests(a.limit(0), b, "k", "v").groupBy("action").count().collect()[0].action == "delete"
