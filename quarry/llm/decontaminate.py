"""Benchmark decontamination: a prefix-filtered set join of documents with windows of benchmark items.

A window is ``width`` consecutive words of an item (a shorter item that has words is one window).  Seen as a set of
shingles (runs of up to ``SHINGLE`` words), a window occurs in a document only if all of its shingles do, so with
containment 1 the necessary prefix is its single rarest shingle.

1. Shingles are ordered by rarity: their counts over all documents (ties by hash).
2. The documents' shingles are joined with the windows' prefix shingles.  A bitmap of fixed size thins the documents'
   side before the join, whatever the benchmark's size; the join itself is broadcast only if the prefix table's counted
   size allows it and is a shuffled join otherwise.
3. The prefix's offset fixes where the window would start; starts before the text or ends beyond it are dropped
   (positional and length bounds).
4. The item-sized window of the document is compared with the item's words, word for word.

Nothing is shuffled but those candidates and one small row for each document.  A document's hits are merged in order, in time linear
in them; the items of a window are joined last, by its number, so that a window which many items share is one row until then.

Defined cases: a null or empty text has no words and no hits.  Repeated document rows are reported one by one.  A null
item id counts for hits but not as an item; repeated items count once.  Texts and items of any length are whole; memory follows
the longest.  Columns are taken by their exact names, dots and all; the report has columns of its own, whatever others there are.
Empty tables give empty reports, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WIDTH = 13
SHINGLE = 3
#: Prefix rows up to which their table is broadcast: about 200 bytes each.
BROADCAST_ROWS = 100_000


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH, shingle: int = SHINGLE) -> DataFrame:
    """A row for each window of each item: ``item`` (its id as a string), ``words`` (joined by spaces), ``n`` and ``shingles``."""
    C.importable(benchmark.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, _, data, at in C.chunks(batch.column(1)):
                t = C.tokenize(data, at, C.WORD_CLASS)
                item, words, size, sets = [], [], [], []
                for d, (a, z) in enumerate(zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True)):
                    n = min(width, z - a)
                    if not n:
                        continue
                    k = min(shingle, n)
                    own = C.Tokens(t.data, t.start[a:z], t.end[a:z], t.hash[a:z], np.array([0, z - a]))
                    h = C.grams(own, k)[0].view(np.int64)
                    for s in range(a, z - n + 1):
                        item.append(ids[i + d])
                        words.append(t.words(s, s + n))
                        size.append(n)
                        sets.append(h[s - a : s - a + n - k + 1])
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(words, pa.string()), pa.array(size, pa.int32()), pa.array(sets, pa.list_(pa.int64()))], names=["item", "words", "n", "shingles"])

    rows = benchmark.select(C.own(benchmark, id_col).cast("string").alias("id"), C.own(benchmark, text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, words string, n int, shingles array<bigint>")


def distinct_windows(rows: DataFrame) -> DataFrame:
    """``window`` (a number), ``words``, ``n`` and ``shingles`` of the different windows; the items that share one are not gathered."""
    each = rows.groupBy("words").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    return C.cut(each.withColumn("window", F.monotonically_increasing_id()))


def _widths(windows: DataFrame, shingle: int) -> list[int]:
    """The shingle widths that occur: at most ``shingle`` of them."""
    return sorted(r.k for r in windows.select(F.least("n", F.lit(shingle)).alias("k")).distinct().collect())


def shingle_counts(docs: DataFrame, text_col: str, sent: Broadcast[np.ndarray], widths: list[int]) -> DataFrame:
    """How often the shingles in the bitmap ``sent`` occur in all documents: ``h``, ``count``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, _, data, at in C.chunks(batch.column(0)):
                t = C.tokenize(data, at, C.WORD_CLASS)
                for k in widths:
                    h, _ = C.grams(t, k)
                    found.append(h[C.in_bitmap(sent.value, h)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([C.long(h), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select(C.own(docs, text_col).alias("text")).mapInArrow(C.released(count), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("count"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest shingle ``h`` and that shingle's ``offset``: the prefix of length one."""
    each = windows.select("window", "words", "n", F.posexplode("shingles").alias("offset", "h"))
    ranked = each.join(counts, "h", "left").withColumn("rarity", F.struct(F.coalesce("count", F.lit(0)).alias("count"), "h", "offset"))
    return ranked.groupBy("window").agg(F.first("words").alias("words"), F.first("n").alias("n"), F.min("rarity").alias("prefix")).select("window", "words", "n", F.col("prefix.h").alias("h"), F.col("prefix.offset").alias("offset"))


def _candidates(rows: DataFrame, sent: Broadcast[np.ndarray], widths: list[int], reach: int) -> DataFrame:
    """For each document a row with its id, and one for each shingle in the bitmap ``sent`` (``candidate``): its place ``pos`` and
    the words from ``from`` on around it.  ``rows``: rid, id, text_key, text.  A document's own row has its rid as h, so
    that a join by h deals these rows evenly."""
    fields = {"rid": "bigint", "candidate": "boolean", "id": rows.schema["id"].dataType, "text_key": "bigint", "n_words": "bigint", "h": "bigint", "pos": "bigint", "from": "bigint", "around": "string"}
    schema, names = C.struct(fields), list(fields)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, ids, keys, texts = batch.columns
            rids = rid.to_numpy()
            for i, j, data, at in C.chunks(texts):
                t = C.tokenize(data, at, C.WORD_CLASS)
                n, none = j - i, pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([rid[i:j], pa.array(np.zeros(n, bool)), ids[i:j], keys[i:j], pa.array(np.diff(t.first)), rid[i:j], none, none, pa.nulls(n, pa.string())], names=names)
                doc = t.doc
                for k in widths:
                    h, p = C.grams(t, k)
                    hit = C.in_bitmap(sent.value, h)
                    h, p = h[hit], p[hit]
                    if not (n := len(h)):
                        continue
                    a, z = t.first[doc[p]], t.first[doc[p] + 1]
                    low, high = np.maximum(a, p - reach), np.minimum(z, p + reach + 1)
                    around = [t.words(x, y) for x, y in zip(low.tolist(), high.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(rids[i + doc[p]]), pa.array(np.ones(n, bool)), pa.nulls(n, ids.type), pa.nulls(n, pa.int64()), pa.array(z - a), C.long(h), pa.array(p - a), pa.array(low - a), pa.array(around, pa.string())], names=names)

    return rows.mapInArrow(C.released(find), schema)


def _merged(hits: DataFrame) -> DataFrame:
    """``rid, own, n_hit, spans, windows`` of each document from ``rid, own, start, end, window`` (a document's own row has no span).
    Spans that touch or overlap become one by a running maximum over the document's hits, in order of start."""
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("end").over(before)
    apart = F.col("start").isNotNull() & (reached.isNull() | (reached < F.col("start")))
    marked = hits.withColumn("new", apart.cast("int"))
    islands = marked.withColumn("island", F.sum("new").over(Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    each = islands.groupBy("rid", "island").agg(F.first("own", ignorenulls=True).alias("own"), F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("window").alias("windows"))
    span = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    return each.groupBy("rid").agg(
        F.first("own", ignorenulls=True).alias("own"),
        F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("n_hit"),
        F.array_sort(F.collect_list(span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, share: int = 20) -> DataFrame:
    """One row for each document row: its id, ``text_key`` (a hash of its text), ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``items`` (ids as sorted strings), ``spans`` (merged word ranges, end exclusive) and
    ``contaminated`` (n_hit > 0 and share * n_hit >= n_words)."""
    spark = docs.sparkSession
    C.importable(spark)
    of_items = benchmark_windows(benchmark, item_col, item_text_col, width)
    windows = distinct_windows(of_items)
    widths = _widths(windows, SHINGLE)
    asked = spark.sparkContext.broadcast(C.hash_bitmap(windows.select(F.explode("shingles").alias("h")), "h"))
    prefix = C.cut(prefixes(windows, shingle_counts(docs, text_col, asked, widths)))
    asked.unpersist()
    near = C.bounded_broadcast(prefix.select("window", "words", "n", F.col("h").alias("near_h"), "offset"), prefix.count(), BROADCAST_ROWS)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), C.own(docs, id_col).alias("id"), F.xxhash64(C.own(docs, text_col)).alias("text_key"), C.own(docs, text_col).alias("text"))
    thinned = spark.sparkContext.broadcast(C.hash_bitmap(prefix, "h"))
    found = _candidates(rows, thinned, widths, width - 1)
    start = F.col("pos") - F.col("offset")
    here = F.array_join(F.slice(F.split("around", " "), (start - F.col("from") + 1).cast("int"), F.col("n")), " ")
    joined = found.join(near, F.col("candidate") & (F.col("h") == F.col("near_h")), "left")
    placed = joined.filter(~F.col("candidate") | ((start >= 0) & (start + F.col("n") <= F.col("n_words"))))
    verified = placed.filter(~F.col("candidate") | (here == F.col("words")))
    own = F.when(~F.col("candidate"), F.struct("id", "text_key", "n_words"))
    hits = verified.select("rid", own.alias("own"), F.when(F.col("candidate"), start).alias("start"), F.when(F.col("candidate"), start + F.col("n")).alias("end"), F.when(F.col("candidate"), F.col("window")).alias("window"))
    by_doc = C.cut(_merged(hits))
    thinned.unpersist()

    # items are met by the number of the window, once for each document that has it
    named = of_items.select("words", "item").distinct().join(windows.select("words", "window"), "words").select("window", "item").filter("item IS NOT NULL")
    met = by_doc.select("rid", F.explode("windows").alias("window")).join(named, "window").groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    counted = by_doc.join(met, "rid", "left").select(F.col("own.id").alias(id_col), "own.text_key", "own.n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``decontaminate`` doesn't call contaminated."""
    found = decontaminate(docs, benchmark, id_col, text_col, **options).filter("contaminated")
    bad = found.select(C.own(found, id_col).alias("id"), "text_key").distinct()
    return C.matched(docs, bad, id_col, text_col, "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


QUERIES = {"op1_decontaminate": op1_decontaminate}

ORACLE_SQL = {
    "op1_decontaminate": """
    WITH d AS (
      SELECT doc_id, row_number() OVER () AS rid, {words} AS w FROM documents
    ), b AS (
      SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark
    ), windows AS (
      SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
      FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0
    ), places AS (
      SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
      FROM d, (SELECT DISTINCT n FROM windows) s, unnest(range(1, len(w) - n + 2)) AS t(i)
    ), hits AS (SELECT rid, i, p.n, item FROM places p JOIN windows v ON p.words = v.words AND p.n = v.n),
    covered AS (SELECT rid, count(DISTINCT x) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(x) GROUP BY rid),
    named AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hits GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
    """.replace("{words}", C.SQL_WORDS)
}
