"""Mixing sources to target weights: pivotal dependent rounding, in DataFrame functions alone.

Every document of a source is wanted ``c = target / source_size`` times, so it is taken floor(c) times and once more with
probability frac(c).  The fractional parts are rounded dependently.  Two documents meet, words move at random from the
one's fraction to the other's until one of them is 0 or 1, and that one is done; the expectation of each stays what it
was and the words expected of the two together stay exactly the same.  The other goes on to the next meeting.

The meetings form a reduction tree.  Documents are dealt by a seeded hash into buckets of about ``BUCKET``; a bucket is
folded by ``aggregate`` and leaves one residual; residuals are dealt again, until a source has one bucket.  A hot source
only has more buckets.  Each level is one shuffle, of a ``BUCKET``-th of the rows before it; no text is shuffled.  In
the end one document of each source is left and is drawn with the probability it has come to, so that every document's
expectation is kept; a source misses its target by less than that one's size.

Rows with the same id, source and text form one unit of the tree (counted before any shuffle), and its copies are dealt out evenly.

Defined cases: a null text has size 0 and takes no words; a null source is a source of its own, the last.  A text of any
length is one unit, of its whole size.  Sources that fill up together do so in their order.  Other columns may have any
name.  An empty table gives an empty mix.  All randomness is hashes of the rows and ``seed``: reruns agree, whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BUCKET = 64
#: Sources up to which their table is broadcast: one short row each.
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(C.SPACE_CLASS)), F.lit(0)).cast("bigint")


def _keys(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits of hash of a row's id, source and text, nulls told apart."""
    named = [x for c in (id_col, source_col, text_col) for x in (C.own(docs, c).isNull(), C.own(docs, c))]
    return F.xxhash64(*named), F.xxhash64(F.lit("second"), *reversed(named))


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, units, target``: the share of all words by weight, no target above ``most`` times its source.

    The level at which the sources' targets, each its weight times the level or what it holds at most, come to that share is
    found by Newton's method: a round sums what the full ones hold and the others' weights, and gives the next level, until
    no source more is full.  The sum of targets is concave in the level, so rounds are few.  Turns are numbered by ranges of
    sources, each after the counts of those before it; the one window over all rows has a row for each range of
    ``C.ROWS_A_PARTITION`` sources.
    """
    sources = C.cut(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units")))
    n, words = sources.agg(F.count("*"), F.sum("source_size")).first()
    by = F.col("source").asc_nulls_last()
    dealt = C.cut(sources.repartitionByRange(max(1, -(-n // C.ROWS_A_PARTITION)), by).withColumn("range", F.spark_partition_id()))
    before = F.coalesce(F.sum("count").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("range").count().select("range", before.alias("start"))
    turn = (F.col("start") + F.row_number().over(Window.partitionBy("range").orderBy(by)) - 1) % len(weights)
    capacity = F.col("source_size") * F.lit(float(most))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    table = C.cut(dealt.join(starts, "range").withColumn("weight", weight).withColumn("capacity", capacity).drop("range", "start"))

    wanted, level = float(share) * (words or 0), 0.0
    while True:
        full = F.col("capacity") <= F.lit(level) * F.col("weight")
        held, rest = table.agg(F.sum(F.when(full, F.col("capacity"))), F.sum(F.when(~full, F.col("weight")))).first()
        rises = rest and (wanted - (held or 0.0)) / rest
        if not rises or rises <= level:
            break
        level = rises
    return table.select("source", "source_size", "units", F.when(full, F.col("capacity")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0**-53)


def _meet(a: Column, b: Column, level: int, seed: int) -> Column:
    """Two fractions meet: ``rest`` keeps the one still fractional, ``u1, u2, more`` is the one that is done."""
    words = F.struct(
        a.alias("a"),
        b.alias("b"),
        F.least(a["size"] * (1 - a["x"]), b["size"] * b["x"]).alias("up"),
        F.least(a["size"] * a["x"], b["size"] * (1 - b["x"])).alias("down"),
        _uniform(b["u1"], b["u2"], F.lit(level), F.lit(seed)).alias("draw"),
    )

    def moved(m: Column) -> Column:
        a, b, up, down = m["a"], m["b"], m["up"], m["down"]
        rises = m["draw"] * (up + down) < down
        a_done = F.when(rises, a["size"] * (1 - a["x"]) <= b["size"] * b["x"]).otherwise(a["size"] * a["x"] <= b["size"] * (1 - b["x"]))
        done, rest = F.when(a_done, a).otherwise(b), F.when(a_done, b).otherwise(a)
        sign = F.when(rises, up).otherwise(-down)
        x = F.when(a_done, b["x"] - sign / b["size"]).otherwise(a["x"] + sign / a["size"])
        more = F.when(rises == a_done, 1).otherwise(0)
        return F.struct(
            F.struct(rest["u1"].alias("u1"), rest["u2"].alias("u2"), rest["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)).alias("x")).alias("rest"),
            F.struct(done["u1"].alias("u1"), done["u2"].alias("u2"), more.alias("more")).alias("done"),
        )

    return F.get(F.transform(F.array(words), moved), F.lit(0))


ENTRY = "struct<u1:bigint,u2:bigint,size:bigint,x:double>"
DONE = "array<struct<u1:bigint,u2:bigint,more:int>>"


def _fold(entries: Column, level: int, seed: int) -> Column:
    """All entries of a bucket, one after another: its residual ``rest`` and those ``done``."""
    first = F.struct(F.get(entries, F.lit(0)).cast(ENTRY).alias("rest"), F.array().cast(DONE).alias("done"))

    def step(state: Column, e: Column) -> Column:
        met = F.transform(F.array(_meet(state["rest"], e, level, seed)), lambda m: F.struct(m["rest"].cast(ENTRY).alias("rest"), F.concat(state["done"], F.array(m["done"]).cast(DONE)).alias("done")))
        return F.get(met, F.lit(0))

    return F.aggregate(F.slice(entries, 2, F.greatest(F.size(entries) - 1, F.lit(0))), first, step)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17) -> DataFrame:
    """One row for each unit (rows with the same id, source and text): keys ``u1, u2``, id, source, ``size``, ``rows``,
    ``source_size``, ``target`` and ``copies``, the times its rows are taken together."""
    u1, u2 = _keys(docs, id_col, source_col, text_col)
    rows = docs.select(u1.alias("u1"), u2.alias("u2"), C.own(docs, id_col).alias("id"), C.own(docs, source_col).alias("source"), size_of(C.own(docs, text_col)).alias("size"))
    units = C.cut(rows.groupBy("u1", "u2", "id", "source", "size").agg(F.count("*").alias("rows")))
    targets = source_targets(units, weights, share, most)
    n, largest = targets.agg(F.count("*"), F.max("units")).first()
    near = C.bounded_broadcast(targets.withColumnRenamed("source", "its"), n, BROADCAST_SOURCES)
    wanted = F.when(F.col("source_size") > 0, F.col("rows") * F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = units.join(near, F.col("source").eqNullSafe(F.col("its"))).withColumn("wanted", wanted).withColumn("base", F.floor("wanted")).withColumn("x", F.col("wanted") - F.col("base"))

    active = placed.filter("size > 0 AND x > 0").select("source", "units", "u1", "u2", "size", "x")
    decided, level, buckets = [], 0, largest or 0
    while True:
        level, buckets = level + 1, -(-buckets // BUCKET)
        dealt = active.withColumn("bucket", F.pmod(F.xxhash64("u1", "u2", F.lit(level), F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("units") / F.lit(float(BUCKET**level))))))
        order = F.struct(F.xxhash64("u2", "u1", F.lit(level), F.lit(seed)).alias("o"), "u1", "u2", "size", "x")
        entries = F.transform(F.array_sort(F.collect_list(order)), lambda e: F.struct(e["u1"].alias("u1"), e["u2"].alias("u2"), e["size"].alias("size"), e["x"].alias("x")))
        folded = C.cut(dealt.groupBy("source", "bucket").agg(F.first("units").alias("units"), entries.alias("entries")).select("source", "units", _fold(F.col("entries"), level, seed).alias("f")), buckets * n * BUCKET)
        decided.append(folded.select(F.explode("f.done").alias("d")).select("d.u1", "d.u2", "d.more"))
        active = folded.select("source", "units", "f.rest.*")
        if buckets <= 1:
            break
    decided.append(active.select("u1", "u2", (_uniform(F.col("u2"), F.col("u1"), F.lit(level + 1), F.lit(seed)) < F.col("x")).cast("int").alias("more")))
    more = decided[0]
    for d in decided[1:]:
        more = more.unionAll(d)
    copies = (F.col("base") + F.coalesce("more", F.lit(0))).cast("bigint")
    return placed.join(more, ["u1", "u2"], "left").select("u1", "u2", F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "rows", "source_size", "target", copies.alias("copies"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as it is taken.  Rows with the same id, source
    and text stand for each other; one of them is repeated."""
    k1, k2, times, rows, copy = C.fresh(docs, "u1", "u2", "copies", "rows", "copy")
    mix = mix_sources(docs, id_col, text_col, source_col, **options).filter("copies > 0")
    mix = C.cut(mix.select(F.col("u1").alias(k1), F.col("u2").alias(k2), F.col("copies").alias(times), F.col("rows").alias(rows)))
    u1, u2 = _keys(docs, id_col, source_col, text_col)
    found = docs.withColumns({k1: u1, k2: u2}).join(C.bounded_broadcast(mix, mix.count(), C.BROADCAST_ROWS), [k1, k2])
    # only rows that are repeated have to meet, to leave one
    taken = found.filter(F.col(rows) == 1).unionAll(found.filter(F.col(rows) > 1).dropDuplicates([k1, k2]))
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).select(*(C.own(docs, c) for c in docs.columns))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(C.table(spark, sf_dir, "documents"))
    each = mix.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
    copies = F.expr("copies div rows") + (F.col("k") < F.col("copies") % F.col("rows")).cast("bigint")
    return each.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("copies"))


QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLE_SQL: dict[str, str] = {}
