"""Reports over items: counts, shares, score statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import filled, platform


def breakdown(items: DataFrame, key: Column, name: str) -> DataFrame:
    """``name``, ``n`` and ``percent`` of all."""
    return _shares(items.groupBy(key.alias(name)).agg(F.count("*").alias("n")))


def _whole(counts: DataFrame) -> DataFrame:
    """One row: how many all keys have together, and the number of keys."""
    return F.broadcast(counts.agg(F.sum("n").alias("__all"), F.count("*").alias("__keys")))


def _shares(counts: DataFrame) -> DataFrame:
    return counts.crossJoin(_whole(counts)).withColumn("percent", F.col("n") * 100.0 / F.col("__all")).drop("__all", "__keys")


def _commonest(counts: DataFrame, name: str, top: int) -> DataFrame:
    """The ``top`` commonest keys with their ``rank``; each task keeps so many, so only these are sorted together."""
    order = [F.desc("n"), F.col(name)]
    return counts.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def source_breakdown(items: DataFrame) -> DataFrame:
    return breakdown(items, platform(F.col("source")), "source")


def version_breakdown(items: DataFrame) -> DataFrame:
    return breakdown(items, F.coalesce(F.nullif(filled(F.col("model_version")), F.lit("")), F.lit("unknown")), "model_version")


def top_and_others(counts: DataFrame, name: str, top: int, others: str = "(others)") -> DataFrame:
    """The ``top`` commonest, ties by name, and all the rest as one row.  ``counts``: name, n; a row for each key, however many."""
    first = _commonest(counts, name, top).select("rank", name, "n")
    of_first = F.broadcast(first.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__first")))
    rest = _whole(counts).filter(F.col("__keys") > top).crossJoin(of_first).select(F.lit(top + 1).alias("rank"), F.lit(others).alias(name), (F.col("__all") - F.col("__first")).alias("n"))
    return _shares(first.unionAll(rest))


def top_if_several(counts: DataFrame, name: str, top: int) -> DataFrame:
    """The ``top`` commonest, if there is more than one key.  They alone are sorted: two of them show that there are several."""
    first = _commonest(counts, name, max(top, 2))
    return first.withColumn("__keys", F.count("*").over(Window.partitionBy())).filter((F.col("__keys") > 1) & (F.col("rank") <= top)).drop("__keys")


def score_stats(scores: DataFrame, below: float = -2.0) -> DataFrame:
    """``total, detected, rate, mean_z`` over scores that are numbers (blank: the other column, else 0).  One row; nulls without scores."""
    texts = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("z_score", "zscore") if c in scores.columns]
    z = F.coalesce(*texts, F.lit("0")).try_cast("double")
    valid = scores.select(z.alias("z")).filter("z IS NOT NULL")
    n, hit = F.count("*"), F.count_if(F.col("z") < below)
    return valid.agg(n.alias("total"), hit.alias("detected"), F.try_divide(hit * 100.0, n).alias("rate"), F.avg("z").alias("mean_z"))


def state_counts(items: DataFrame, by: str = "dataset") -> DataFrame:
    """Items by state, total (accepted and staged) and pass rate in percent, for each ``by`` and over all (``overall``)."""
    in_state = lambda s: F.count_if(F.col("state") == s)
    counts = items.rollup(by).agg((F.grouping(by) == 1).alias("overall"), in_state("images").alias("images"), in_state("staging").alias("staging"), in_state("rejected").alias("rejected"))
    rate = F.coalesce(F.try_divide(F.col("images") * 100.0, F.col("images") + F.col("rejected")), F.lit(0.0))
    return counts.withColumn("total", F.col("images") + F.col("staging")).withColumn("pass_rate", rate)


def sample_counts(items: DataFrame, by: str, order: str, value: str, sample: int = 100) -> DataFrame:
    """Counts of ``value`` over the first ``sample`` items of each ``by``."""
    w = Window.partitionBy(by).orderBy(order)
    return items.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= sample).groupBy(by, value).agg(F.count("*").alias("n"))


def signal_counts(items: DataFrame, signals: str, top: int | None = None) -> DataFrame:
    """How often each signal occurs, the commonest first."""
    counts = items.select(F.explode_outer(signals).alias("signal")).filter("signal IS NOT NULL").groupBy("signal").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "signal")
    return counts if top is None else counts.limit(top)


def caption_buckets(captions: DataFrame) -> DataFrame:
    """Captions that failed, reject or pass, in this order of precedence."""
    kind = F.when(F.col("error").isNotNull(), "error").when(F.coalesce("should_reject", F.lit(False)), "rejected").otherwise("passed")
    return captions.groupBy(kind.alias("bucket")).agg(F.count("*").alias("n"))
