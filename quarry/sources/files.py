"""Tables on disk: manifests, metadata, captions, scores, listings, reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.session import importable, scratch
from quarry.sources import splitting, versions

CSV = {"header": True, "quote": '"', "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Files that validation looks at, and those that captioning takes besides.
IMAGES = (".jpg", ".jpeg", ".png")
MORE_IMAGES = (*IMAGES, ".webp", ".bmp")


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e.getCondition() or e)


def read_csv(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """Quoted text with newlines and quotes inside, in ranges side by side; columns by each file's header, absent fields empty."""
    columns = [c.split()[0] for c in schema.split(", ")]
    try:
        return splitting.csv_rows(spark, path, columns, scratch(spark, "ranges"))
    except AnalysisException as e:
        if not missing_ok or not _missing(e):
            raise
        return spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.MANIFEST, missing_ok)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.METADATA)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """``filename, z_score, is_fake, raw_score`` of a detector's output; without a file, none."""
    raw = read_csv(spark, path, schemas.SCORES, missing_ok=True)
    return parsed_scores(raw)


def parsed_scores(raw: DataFrame) -> DataFrame:
    """Scores by file name; the flag is true for ``True`` alone."""
    name = F.regexp_extract("file", r"[^/]*$", 0)
    return raw.select(name.alias("filename"), F.col("z_score").try_cast("double").alias("z_score"), (F.col("is_fake") == "True").alias("is_fake"), F.col("raw_score").try_cast("double").alias("raw_score"))


def read_json_map(spark: SparkSession, path: str, schema: str, missing_ok: bool = True) -> DataFrame:
    """``key, value`` of JSON objects, one a file, each read in ranges side by side."""
    try:
        return splitting.json_entries(spark, path, schema, scratch(spark, "ranges"))
    except AnalysisException as e:
        if not missing_ok or not _missing(e):
            raise
        return spark.createDataFrame([], f"key string, value {schema.removeprefix('map<string, ').removesuffix('>')}")


def write_json_map(rows: DataFrame, key: str, value: str, path: str) -> None:
    """``key: value`` entries as JSON objects, one a partition, line by line; no object is held in memory."""
    importable(rows.sparkSession)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "{"
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array([(mark if i == 0 else ",") + e for i, e in enumerate(batch.column(0).to_pylist())])], names=["value"])
                mark = ","
        yield pa.RecordBatch.from_arrays([pa.array(["{}" if mark == "{" else "}"])], names=["value"])

    entry = F.to_json(F.create_map(F.col(key), F.col(value)))
    rows.select(F.substr(entry, F.lit(2), F.length(entry) - 2).alias("value")).mapInArrow(lines, "value string").write.text(path)


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    return read_json_map(spark, path, schemas.CAPTIONS).select(F.col("key").alias("filename"), "value.*")


def read_classifications(spark: SparkSession, path: str) -> DataFrame:
    return read_json_map(spark, path, schemas.CLASSIFICATIONS).select(F.col("key").alias("filename"), F.col("value").alias("category"))


def read_listing(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """``filename, path, size`` of a folder's files; contents aren't read.  Spark lists no empty files."""
    found = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"[^/]*$", 0).alias("filename"), "path", F.col("length").alias("size"))
    return found.filter(F.lower(F.regexp_extract("filename", r"\.[^.]+$", 0)).isin(*suffixes)) if suffixes else found


def to_caption(listing: DataFrame, captions: DataFrame) -> DataFrame:
    """Listed images without a caption."""
    images = listing.filter(F.lower(F.regexp_extract("filename", r"\.[^.]+$", 0)).isin(*MORE_IMAGES))
    return images.join(captions.select("filename"), "filename", "left_anti")


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").options(**CSV).csv(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One CSV file, in the order given: a report for people, as long as a listing."""
    metadata.coalesce(1).write.mode("overwrite").options(**CSV).csv(path)


def write_captions(captions: DataFrame, path: str) -> None:
    """Adds captions as JSON lines; ``latest_captions`` reads what counts."""
    captions.write.mode("append").json(path)


def latest_captions(captions: DataFrame, key: str = "filename", order: str = "written") -> DataFrame:
    """The last caption written for each file."""
    return captions.groupBy(key).agg(F.max_by(F.struct(*(c for c in captions.columns if c != key)), order).alias("row")).select(key, "row.*")


class CaptionLog:
    """Captions by file, added run by run; the last of a file counts.  Runs are merged by levels, so that reading takes few of them and each
    caption is written again once a level."""

    SCHEMA = "filename string, caption string, should_reject boolean, reject_signals array<string>, error string"

    def __init__(self, spark: SparkSession, path: str, fan: int = 4) -> None:
        self.table = versions.Table(spark, path, fan)

    def add(self, captions: DataFrame) -> int:
        """Adds a run (one row a file at most) and merges where there are enough; the table's new version."""
        names = [c.split()[0] for c in self.SCHEMA.split(", ")]
        self.table.append(captions.select(*names))
        return self.table.compact(self.SCHEMA, lambda rows: latest_captions(rows, order="_part"))

    def latest(self, version: int | None = None) -> DataFrame:
        return latest_captions(self.table.read(self.SCHEMA, version), order="_part").drop("_part")


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").text(path)
