"""Plans and pages made from listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import session
from quarry.operators.items import numbered


def sync_plan(source: DataFrame, target: DataFrame, key: str, version: str) -> DataFrame:
    """What would make ``target`` a mirror of ``source``: copy, update, delete or keep, by key.  Nothing is carried out."""
    s, t = source.select(key, F.col(version).alias("__s"), F.lit(1).alias("__in_s")), target.select(key, F.col(version).alias("__t"), F.lit(1).alias("__in_t"))
    action = F.when(F.col("__in_t").isNull(), "copy").when(F.col("__in_s").isNull(), "delete").when(F.col("__s").eqNullSafe(F.col("__t")), "keep").otherwise("update")
    return s.join(t, key, "full_outer").select(key, action.alias("action"))


def digests(rows: DataFrame, by: Sequence[str], key: str, version: str) -> DataFrame:
    """``by``, and a ``digest`` of each group's keys and versions that doesn't depend on their order: their number and two sums of hashes."""
    sums = [F.sum(F.xxhash64(F.lit(k), key, F.col(version).isNull(), version).cast("decimal(38,0)")) for k in (1, 2)]
    return rows.groupBy(*by).agg(F.struct(F.count("*").alias("n"), sums[0].alias("a"), sums[1].alias("b")).alias("digest"))


def sync_plan_by_digests(source: DataFrame, target: DataFrame, key: str, version: str, folder: Column | None = None, fine: int = 4096) -> DataFrame:
    """As ``sync_plan``, for trees that are alike for the most part: digests are compared by folder (by default the key up to its last slash), then
    within folders that differ by ``fine`` ranges of hash.  Only rows of ranges that differ are shuffled and joined; the others stay, as the
    source's scan gives them.  Keys are unique on either side."""
    folder = F.regexp_extract(F.col(key).cast("string"), "^(.*/)?", 0) if folder is None else folder

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.col(version).alias("__v"), F.xxhash64(folder).alias("__folder"), F.pmod(F.xxhash64(F.lit(7), key), F.lit(fine)).alias("__range"))

    def unequal(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
        both = digests(a, by, key, "__v").join(digests(b, by, key, "__v").withColumnRenamed("digest", "__other"), by, "full_outer")
        return both.filter(~F.col("digest").eqNullSafe(F.col("__other"))).select(*by)

    s, t = placed(source), placed(target)
    folders = session.written(unequal(s, t, ["__folder"]), "folders")
    ranges = session.written(unequal(s.join(folders, "__folder", "left_semi"), t.join(folders, "__folder", "left_semi"), ["__folder", "__range"]), "ranges")
    by = ["__folder", "__range"]
    differing = sync_plan(s.join(ranges, by, "left_semi"), t.join(ranges, by, "left_semi"), key, "__v")
    return differing.unionAll(s.join(ranges, by, "left_anti").select(key, F.lit("keep").alias("action")))


def contact_sheet(items: DataFrame, by: str, order: str, src: str, caption: str, page: int = 500) -> DataFrame:
    """HTML sheets of at most ``page`` images each: ``by, page, n, html``."""
    escape = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    cell = F.concat(F.lit('<figure><img src="'), escape(src), F.lit('"><figcaption>'), escape(caption), F.lit("</figcaption></figure>"))
    rows = numbered(items.select(*dict.fromkeys((by, order, src, caption))), by, order, "__n")
    cells = rows.select(by, F.floor(F.col("__n") / page).cast("int").alias("page"), F.struct(F.col("__n").alias("k"), cell.alias("html")).alias("c"))
    sheets = cells.groupBy(by, "page").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("c")).alias("cells"))
    return sheets.select(by, "page", "n", F.concat(F.lit("<main>"), F.array_join(F.transform("cells", lambda c: c["html"]), "\n"), F.lit("</main>")).alias("html"))
