"""Which items are taken: duplicates, size, hosts, caps, streaks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import session
from quarry.functions import text
from quarry.session import importable


def unseen(items: DataFrame, seen: DataFrame, on: str) -> DataFrame:
    """Items whose key isn't among those seen."""
    return items.join(seen.select(on).distinct(), on, "left_anti")


def present(items: DataFrame, listing: DataFrame, on: str = "filename") -> DataFrame:
    """Items that are also listed."""
    return items.join(listing.select(on).distinct(), on, "left_semi")


#: Items that one task settles one by one, in order of arrival.
SETTLE = 1_000_000


def _first_of_both(left: DataFrame) -> DataFrame:
    """Items that are the first of their URL and of their content."""
    first = {c: left.groupBy(F.col(c).alias(f"{c}_")).agg(F.min("at").alias(f"at_{c}")) for c in ("u", "h")}
    both = left.join(first["u"], (F.col("u") == F.col("u_")) & (F.col("at") == F.col("at_u"))).join(first["h"], (F.col("h") == F.col("h_")) & (F.col("at") == F.col("at_h")))
    return both.select(*left.columns)


def _settled(left: DataFrame, group: str) -> DataFrame:
    """``__id`` of the items that are taken where each group's are looked at one by one; no group has more than ``SETTLE``."""
    importable(left.sparkSession)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, urls, contents = None, set(), set()
        for batch in batches:
            taken = []
            for item, g, u, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != now:
                    now, urls, contents = g, set(), set()
                if u not in urls and h not in contents:
                    urls.add(u)
                    contents.add(h)
                    taken.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(taken, pa.int64())], names=["__id"])

    in_order = left.repartition(group).sortWithinPartitions(group, "at").select("__id", group, F.to_json("u").alias("u"), F.to_json("h").alias("h"))
    return in_order.mapInArrow(settle, "__id bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node that is connected with it) of undirected edges ``a, b`` of longs.  By stars: each node's
    neighbours are tied to the smallest of them, larger and smaller ones in turn, until nothing changes, which takes about as many rounds
    as the logarithm of the longest path, squared at worst.  Every round is written, so that lineage ends there."""
    now, state, step = session.written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None, 0

    def tied(pairs: DataFrame, all_of_them: bool) -> DataFrame:
        low = pairs.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low")).withColumn("low", F.least("n", "low"))
        met = pairs.join(low, F.col("a") == F.col("n"))
        if all_of_them:  # larger neighbours, of pairs in both directions
            return met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return met.select(F.col("a"), F.col("low").alias("b")).unionAll(met.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))

    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step += 1
        now = session.written(tied(tied(both, True).distinct(), False).filter("a <> b").distinct(), f"stars{step}")
        held = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if held == state:
            break
        state = held
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node"))).distinct()
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))


def first_arrivals(items: DataFrame, url: str, content_hash: str, order: Sequence[str]) -> DataFrame:
    """``outcome`` of each item in order of arrival: ok, dup_url or dup_hash.

    An item is taken unless one that was taken before has its URL or its content.  First, in one round: those that are the first of
    their URL and of their content are taken, and all that share either with them go.  Where a URL always has the same content,
    nothing is left.  What is left are chains of items that wait for each other: a counted number up to ``SETTLE`` is looked at one by
    one in a task; of more, each connected component of URLs and contents is, in tasks of its own; and the items of a
    component above ``SETTLE`` go through another round first.

    Nulls count as values.  Rows of equal order count in any order.
    """

    def rest_of(left: DataFrame, new: DataFrame) -> DataFrame:
        return left.join(new.select("u"), "u", "left_anti").join(new.select("h"), "h", "left_anti").select("__id", "u", "h", "at")

    every = session.written(items.withColumn("__id", F.monotonically_increasing_id()), "arrivals")
    left = every.select("__id", F.struct(url).alias("u"), F.struct(content_hash).alias("h"), F.struct(*order, "__id").alias("at"))
    taken = None
    while True:
        new = session.written(_first_of_both(left), "taken")
        taken = new if taken is None else taken.unionAll(new)
        left = session.written(rest_of(left, new), "left")
        n = left.count()
        if not n:
            break
        if n <= SETTLE:
            small, left = left.withColumn("__group", F.lit(0)), None
        else:
            keyed = left.withColumns({"a": F.xxhash64(F.lit("url"), "u"), "b": F.xxhash64(F.lit("content"), "h")})
            found = session.written(components(keyed.select("a", "b")), "components").withColumnRenamed("component", "__group")
            grouped = session.written(keyed.join(found, F.col("a") == F.col("node")).select(*left.columns, "__group"), "grouped")
            sizes = grouped.groupBy("__group").agg((F.count("*") <= SETTLE).alias("few"))
            small = grouped.join(sizes.filter("few"), "__group", "left_semi")
            left = session.written(grouped.join(sizes.filter("NOT few"), "__group", "left_semi").drop("__group"), "left")
        taken = taken.unionAll(session.written(small.join(_settled(small, "__group"), "__id", "left_semi").select(*taken.columns), "settled"))
        if left is None or left.isEmpty():
            break
    by_id, by_url = taken.select("__id", F.lit(True).alias("__ok")), taken.select(F.col("u").alias("__u"), F.col("at").alias("__at"))
    met = every.join(by_id, "__id", "left").join(by_url, F.struct(url) == F.col("__u"), "left")
    outcome = F.when(F.col("__ok"), "ok").when(F.col("__at") < F.struct(*order, "__id"), "dup_url").otherwise("dup_hash")
    return met.withColumn("outcome", outcome).select(*items.columns, "outcome")


def one_of_each(items: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first item of each key."""
    return items.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__n = 1").drop("__n")


def new_items(candidates: DataFrame, manifest: DataFrame, order: Sequence[str], min_pixels: int = 200_000) -> DataFrame:
    """Candidates (url, content_hash, width, height) to be taken: not too small, neither URL nor content in the manifest or among those
    taken before.  What is too small is not remembered: a URL that gives a large image later is taken then."""
    large = candidates.filter(large_enough(F.col("width").cast("bigint") * F.col("height"), min_pixels))
    fresh = unseen(unseen(large, manifest, "url"), manifest, "content_hash")
    return first_arrivals(fresh, "url", "content_hash", order).filter("outcome = 'ok'").drop("outcome")


def produced(*producers: DataFrame) -> DataFrame:
    """The items of several producers as one table."""
    out = producers[0]
    for p in producers[1:]:
        out = out.unionByName(p)
    return out


def until_target(items: DataFrame, by: str, order: Sequence[str], target: int) -> DataFrame:
    """The items that are taken until each group has its target: the first in order, with ``reached``.  Tasks drop the rest before the
    shuffle."""
    counts = items.groupBy(F.col(by).alias("__by")).agg((F.count("*") >= target).alias("reached"))
    taken = capped(items, [by], order, target)
    return taken.join(counts, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")


def page_counts(found: DataFrame, listing: str, page: str, key: str, order: Sequence[str]) -> DataFrame:
    """``found, duplicates, seen`` of each page of a listing: its items, those that came before, and whether all did."""
    first = F.row_number().over(Window.partitionBy(listing, key).orderBy(*order)) == 1
    counts = found.withColumn("__first", first).groupBy(listing, page).agg(F.count("*").alias("found"), F.count_if(~F.col("__first")).alias("duplicates"))
    return counts.withColumn("seen", F.col("found") == F.col("duplicates"))


def large_enough(pixels: Column, least: int) -> Column:
    """Items of too few pixels go; those that couldn't be decoded (0) stay."""
    return (pixels == 0) | (pixels >= least)


def allowed_host(url: Column, hosts: Sequence[str]) -> Column:
    return text.url_host(url).isin(*hosts) if hosts else F.lit(True)


def shown_large(w: Column, h: Column, least: int = 300) -> Column:
    return ~((w < least) & (h < least))


def capped(items: DataFrame, by: Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    """At most ``most`` items of each group, the first in order."""
    return items.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def numbered(items: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """``items`` with each one's place in its group, from 0, as ``name``.  Items are dealt by ranges of group and order; a range
    numbers its own, after the counts of the ranges before it.  So no task sees a whole group.  Rows of equal order are in
    one range and count in any order."""
    path = session.scratch(items.sparkSession, "numbered")
    items.repartitionByRange(F.col(by), F.col(order)).withColumn("__range", F.spark_partition_id()).write.parquet(path)
    dealt = items.sparkSession.read.parquet(path)
    before = Window.partitionBy("__by").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(F.col(by).alias("__by"), F.col("__range").alias("__r")).agg(F.count("*").alias("__count"))
    starts = counts.select("__by", "__r", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__range", by).orderBy(order)) - 1
    met = dealt.withColumn("__place", place).join(starts, (F.col("__range") == F.col("__r")) & F.col(by).eqNullSafe(F.col("__by")))
    return met.withColumn(name, F.col("__start") + F.col("__place")).select(*items.columns, name)


def combinations(left: DataFrame, right: DataFrame, keep: Column | None = None) -> DataFrame:
    """Query combinations of two small dimension tables."""
    both = left.crossJoin(F.broadcast(right))
    return both if keep is None else both.filter(keep)


def date_windows(start: Column, days: int) -> Column:
    """The ``days`` days before ``start``, the nearest first."""
    return F.transform(F.sequence(F.lit(1), F.lit(days)), lambda k: F.date_sub(start, k))


def until_barren(pages: DataFrame, by: Sequence[str], order: str, yielded: Column, most: int) -> DataFrame:
    """Pages of each listing up to the one that ends its first run of ``most`` without a yield.

    ``streak`` is the length of the barren run that ends at a page.
    """
    w = Window.partitionBy(*by).orderBy(order)
    counted = pages.withColumn("__island", F.sum(yielded.cast("int")).over(w))
    run = Window.partitionBy(*by, "__island").orderBy(order)
    barren = counted.withColumn("streak", F.sum((~yielded).cast("int")).over(run)).drop("__island")
    stopped = F.coalesce(F.max((F.col("streak") >= most).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return barren.withColumn("__stopped", stopped).filter("__stopped = 0").drop("__stopped")
