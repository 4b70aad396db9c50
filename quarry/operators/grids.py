"""Composite images: which they are, and the rows of their four tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sizes of single images, width by height; a composite is twice as wide and high.
TILES = [
    (1024, 1024), (1456, 816), (816, 1456), (896, 1344), (1344, 896), (928, 1232), (1232, 928), (960, 1200), (1200, 960), (1456, 832), (832, 1456), (1680, 720),
    (720, 1680), (2176, 544), (544, 2176), (1904, 640), (640, 1904), (1536, 768), (768, 1536), (2112, 576), (576, 2112), (2016, 576), (576, 2016), (960, 1248),
    (1248, 960), (1344, 768), (768, 1344), (864, 1360), (1360, 864), (928, 1312), (1312, 928), (1376, 864), (864, 1376), (1424, 848), (848, 1424), (1024, 1040),
    (1040, 1024), (816, 1472), (1472, 816), (912, 1296), (1296, 912), (992, 1200), (1200, 992), (1712, 704), (704, 1712), (720, 1648), (1648, 720), (736, 1600),
    (1600, 736), (656, 448), (448, 656),
]
LARGE = 3_500_000


def dim_tile(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TILES, "w int, h int")


def classified(manifest: DataFrame) -> DataFrame:
    """The manifest with ``grid_class``: single, grid or unknown.  Sizes may be text; what isn't digits is unknown."""
    digits = lambda c: F.when(F.col(c).cast("string").rlike("^[0-9]+$"), F.col(c).try_cast("int"))
    spark = manifest.sparkSession
    single = F.broadcast(dim_tile(spark).select(F.col("w").alias("__w"), F.col("h").alias("__h"), F.lit(True).alias("__single")))
    double = F.broadcast(dim_tile(spark).select((F.col("w") * 2).alias("__w"), (F.col("h") * 2).alias("__h"), F.lit(True).alias("__double")))
    sized = manifest.withColumns({"__w": digits("width"), "__h": digits("height")}).join(single, ["__w", "__h"], "left").join(double, ["__w", "__h"], "left")
    even = (F.col("__w") % 2 == 0) & (F.col("__h") % 2 == 0) & (F.col("__w").cast("bigint") * F.col("__h") > LARGE)
    known = F.col("__w").isNotNull() & F.col("__h").isNotNull()
    kind = F.when(~known, "unknown").when(F.col("is_upscaled") == "true", "single").when(F.col("__single"), "single").when(F.col("__double") | even, "grid").otherwise("unknown")
    return sized.withColumn("grid_class", kind).drop("__w", "__h", "__single", "__double")


def tile_rows(grids: DataFrame) -> DataFrame:
    """Four rows for each composite: top left, top right, bottom left, bottom right; the later halves of odd sides are larger.

    Hash and size of the tiles need their pixels and are null.
    """
    tile = F.col("__tile")
    w, h = F.col("width").cast("int"), F.col("height").cast("int")

    def half(side: Column, second: Column) -> Column:
        first = F.floor(side / 2).cast("int")
        return F.when(second, side - first).otherwise(first)

    rows = grids.withColumn("__tile", F.explode(F.sequence(F.lit(0), F.lit(3))))
    changed = {
        "filename": F.concat(F.regexp_replace("filename", r"\.[^.]*$", ""), F.lit("_"), tile.cast("string"), F.lit(".png")),
        "width": half(w, tile % 2 == 1),
        "height": half(h, tile >= 2),
        "format": F.lit("PNG"),
        "flair": F.replace(F.col("flair"), F.lit(":grid"), F.concat(F.lit(":tile"), tile.cast("string"))),
        "content_hash": F.lit(None).cast("string"),
        "file_size": F.lit(None).cast("string"),
    }
    return rows.withColumns({k: v for k, v in changed.items() if k in grids.columns}).drop("__tile")


def split(manifest: DataFrame, limit: int | None = None) -> DataFrame:
    """The manifest with its composites replaced by their tiles.  Composites whose first tile is there already are dropped and not
    split again, so that running it twice changes nothing."""
    kept = manifest.columns
    marked = classified(manifest)
    grids = marked.filter("grid_class = 'grid'")
    first = F.concat(F.regexp_replace("filename", r"\.[^.]*$", ""), F.lit("_0.png"))
    fresh = grids.withColumn("__first", first).join(manifest.select(F.col("filename").alias("__first")), "__first", "left_anti").drop("__first")
    if limit is not None:
        fresh = fresh.orderBy("filename").limit(limit)
    singles = marked.filter("grid_class <> 'grid'") if limit is None else marked.join(fresh.select("filename"), "filename", "left_anti")
    types = {c: manifest.schema[c].dataType for c in kept}
    tiles = tile_rows(fresh).select(*(F.col(c).cast(types[c]) for c in kept))
    return singles.select(*kept).unionByName(tiles)


def class_counts(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Items of each class; those that aren't listed count as missing."""
    marked = classified(manifest).join(listing.select("filename").distinct().withColumn("__there", F.lit(True)), "filename", "left")
    return marked.groupBy(F.when(F.col("__there"), F.col("grid_class")).otherwise("missing").alias("grid_class")).agg(F.count("*").alias("n"))
