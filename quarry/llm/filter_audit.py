"""Filter interaction audit: what each of some filters removes, in every order in which they may be applied.

1. Each document gets a flag for each filter that it fails.  Identity to an earlier document is found from digests of
   whole texts: the smallest id of each digest is its first; only (id, digest, part, flags) is shuffled, never a text.
2. Documents are counted by part, flags and labels, which leaves a few rows for each part.
3. CUBE over the flags and the part: the grouping-set rows in which every selected flag is false count the documents that
   survive that subset of filters.
4. Each step of an order goes from one subset to the same with one filter more: these pairs of subsets are joined, and every
   order's steps are looked up among the pairs.  A filter's Shapley sum weighs each pair by the orders that contain it.

Work after step 2 follows the number of parts alone.  Counting by all columns first, with partial sums before the shuffle, keeps
a text or part that holds a third of all rows from filling a task; rows without an id don't take part in the joins.

Defined cases: a null text is empty; it has no words, so it fails A and, after another empty one, E.  A null part is the empty
string's part.  A row without an id is nobody's copy, makes nobody one and has no label.  Rows of one id are not copies of
each other; each counts.  Of several labels of an id, any that is 1 counts; a null label is none.  Texts of any length are whole.
Other columns are ignored, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

FLAGS = "ABCDE"
#: Rows of labels up to which they are broadcast.
BROADCAST_LABELS = C.BROADCAST_ROWS


def failures(text: Column) -> dict[str, Column]:
    """The failure conditions that depend on a document's own text, by name."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", copies: str = "E", labels: DataFrame | None = None, label_id: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``part``, a boolean column for each filter, ``good``, ``toxic`` and ``n``: the rows of ``docs`` with the same values of these."""
    text = F.coalesce(C.own(docs, text_col), F.lit(""))
    own = failures(text)
    each = docs.select(C.own(docs, id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.coalesce(C.own(docs, part_col).cast("string"), F.lit("")).alias("part"), *(c.alias(f) for f, c in own.items()))
    each = C.cut(each.groupBy("id", "digest", "part", *own).agg(F.count("*").alias("n")))
    named = each.filter("id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    named = named.join(first, ["digest", "id"], "left").withColumn(copies, F.col("first").isNull())
    if labels is not None:
        is_one = lambda c: F.max(F.coalesce(C.own(labels, c) == 1, F.lit(False)))
        known = labels.filter(C.own(labels, label_id).isNotNull()).groupBy(C.own(labels, label_id).alias("id")).agg(is_one(good).alias("good"), is_one(toxic).alias("toxic"))
        named = named.join(C.bounded_broadcast(known, labels.count(), BROADCAST_LABELS), "id", "left")
    else:
        named = named.withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    nameless = each.filter("id IS NULL").withColumns({copies: F.lit(False), "good": F.lit(False), "toxic": F.lit(False)})
    names = ["part", *own, copies]
    both = (x.select(*names, *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")), "n") for x in (named, nameless))
    return next(both).unionAll(next(both)).groupBy(*names, "good", "toxic").agg(F.sum("n").alias("n"))


def survivors(counted: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """``part, subset, n, good, toxic``: what survives each subset of the filters (bit k: the k-th) within each part, from CUBE's
    rows whose selected flags are all false.  Subsets that nothing survives have no row."""
    selected = sum((1 - F.grouping(f)).cast("int") * (1 << k) for k, f in enumerate(flags))
    sums = [F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")]
    cubed = counted.cube("part", *flags).agg(*sums, F.grouping("part").alias("all_parts"), selected.alias("subset"))
    none_fails = ~F.coalesce(F.greatest(*flags), F.lit(False))  # greatest leaves out the nulls of flags that aren't selected
    return cubed.filter((F.col("all_parts") == 0) & none_fails).select("part", "subset", "n", "good", "toxic")


def _subset(letters: Column, flags: Sequence[str]) -> Column:
    return sum(F.when(F.contains(letters, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(flags))


def steps(left: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """One row for each part, order of the filters and step, from ``survivors``' rows."""
    every = (1 << len(flags)) - 1
    bit: Mapping[str, int] = {f: 1 << k for k, f in enumerate(flags)}
    parts = left.filter("subset = 0").select("part", F.col("n").alias("total"))
    bits = F.element_at(F.create_map(*(F.lit(x) for f in flags for x in (f, bit[f]))), F.col("flag"))
    pairs = parts.withColumn("flag", F.explode(F.array(*map(F.lit, flags)))).withColumn("before", F.explode(F.sequence(F.lit(0), F.lit(every))))
    pairs = pairs.withColumn("bit", bits).filter(F.col("before").bitwiseAND(F.col("bit")) == 0).withColumn("after", F.col("before") + F.col("bit"))
    low, high = (left.select("part", F.col("subset").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "good", "toxic"))) for s in ("before", "after"))
    met = pairs.join(low, ["part", "before"], "left").join(high, ["part", "after"], "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    lost = {c: count(F.col(f"{c}_before")) - count(F.col(f"{c}_after")) for c in ("n", "good", "toxic")}
    met = met.select("part", "flag", "bit", "before", count(F.col("n_after")).alias("kept"), lost["n"].alias("removed"), lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"))
    met = C.cut(met)
    weight = F.element_at(F.array(*(F.lit(factorial(k) * factorial(len(flags) - 1 - k)) for k in range(len(flags)))), F.bit_count("before") + 1)
    of_filter = met.groupBy("part", "flag").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") + F.col("bit") == every, F.col("removed"))).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"),
    )
    ordered = parts.select("part", F.explode(F.split(F.lit(",".join("".join(p) for p in permutations(flags))), ",")).alias("filter_order"))
    ordered = ordered.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(flags)))).alias("step"))
    ordered = ordered.withColumns({"flag": F.substr("filter_order", F.col("step"), F.lit(1)), "before": _subset(F.substr("filter_order", F.lit(1), F.col("step") - 1), flags)})
    out = ordered.join(met, ["part", "flag", "before"]).join(of_filter, ["part", "flag"])
    return out.select("part", "filter_order", "step", "flag", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame | None = None, **columns: str) -> DataFrame:
    """``part, filter_order, step, flag, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of the five filters."""
    return steps(C.cut(survivors(flagged(docs, labels=labels, **columns))))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")).drop("flag")


QUERIES = {"op11_filter_audit": op11_filter_audit}

ORACLE_SQL = {
    "op11_filter_audit": r"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    d AS (
      SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS copy FROM texts
    ), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (
      SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
        CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS fails
      FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), each AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS x, substr(filter_order, 1, s - 1) AS before FROM orders, range(1, 6) t(s)),
    judged AS (
      SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS bad, fails = x AS alone, translate(fails, before, '') <> fails AS gone FROM f, each
    ), counted AS (
      SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
        coalesce(sum(n) FILTER (bad AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (bad AND NOT gone AND toxic), 0) AS toxic_lost
      FROM judged GROUP BY ALL
    )
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
      CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
      CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM counted
    """
}
