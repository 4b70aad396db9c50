"""Validation: structural flags, and the decision about each item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.config import DatasetConfig
from quarry.functions import shapes, text

#: Files that structural validation looks at.
SUFFIXES = (".jpg", ".jpeg", ".png")
DETECTED_BELOW = -2.0


def structural(items: DataFrame, config: DatasetConfig, native: Sequence[tuple[int, int]] = (), longest: int = 0, shortest: int = 0) -> DataFrame:
    """Items with ``flags`` (names alone, in a fixed order), ``structural_passed`` and ``bpp``.

    ``items``: width, height, format, file_size, avg_quantization, camera_exif_tags, and ``opened`` (false: nothing else is
    looked at).  A limit of 0 isn't asked for.
    """
    w, h, px = F.col("width"), F.col("height"), shapes.pixels(F.col("width"), F.col("height"))
    side = F.greatest(w, h)
    checks: list[tuple[str, Column]] = []
    if config.formats:
        checks.append(("unexpected_format", ~F.col("format").isin(config.formats)))
    if native:
        checks.append(("non_native_resolution", ~shapes.near_resolution(w, h, native)))
    if config.min_pixels:
        checks.append(("too_few_pixels", px < config.min_pixels))
    if config.max_pixels:
        checks.append(("too_many_pixels", px > config.max_pixels))
    if config.ratios:
        checks.append(("non_native_aspect_ratio", (w > 0) & (h > 0) & shapes.known_ratio(w, h, config.ratios, config.ratio_tolerance).isNull()))
    if longest:
        checks.append(("too_large", side > longest))
    if shortest:
        checks.append(("too_small", side < shortest))
    if config.max_avg_quantization:
        checks.append(("high_compression", (F.col("format") == "JPEG") & (F.col("avg_quantization") > config.max_avg_quantization)))
    if config.exif_tags:
        checks.append(("camera_exif", F.size(F.coalesce(F.array_intersect("camera_exif_tags", F.array(*map(F.lit, config.exif_tags))), F.array())) > 0))
    flags = text.named(checks)
    flagged = items.withColumn("flags", F.when(~F.col("opened"), F.array(F.lit("cannot_open"))).otherwise(flags))
    return flagged.withColumn("structural_passed", F.size("flags") == 0).withColumn("bpp", shapes.bits_per_pixel(F.col("file_size"), w, h))


def reclassified(captions: DataFrame, config: DatasetConfig) -> DataFrame:
    """Captions with their own reject signals and those of the dataset's rules, sorted.

    ``captions``: filename, caption, should_reject, reject_signals, error (all but the name may be null).
    """
    found = text.reject_signals(F.col("caption"), config.reject, config.paired, config.indicators)
    both = F.array_sort(F.array_union(F.coalesce("reject_signals", F.array().cast("array<string>")), F.when(F.col("caption").isNotNull(), found).otherwise(F.array().cast("array<string>"))))
    return captions.withColumn("reject_signals", both).withColumn("should_reject", F.coalesce("should_reject", F.lit(False)) | (F.size("reject_signals") > 0))


def content_rejected() -> Column:
    """Whether a caption rejects its item: by its signals, or since captioning failed."""
    return F.coalesce("should_reject", F.lit(False)) | (F.coalesce(F.size("reject_signals"), F.lit(0)) > 0) | F.col("error").isNotNull()


def decide(items: DataFrame, captions: DataFrame, scores: DataFrame, relaxed: bool = True, fsd_mode: str = "filter") -> DataFrame:
    """Each staged item's ``state`` (images, rejected, staging), ``reasons``, and ``tier`` of the decision: 0 by its caption,
    1 by structure and score, null if it stays.

    ``items``: filename and what ``structural`` adds; ``captions`` as ``reclassified`` gives them; ``scores``: filename, z_score,
    is_fake.  Of several captions of a name any that rejects counts; of several scores the lowest (a null above none, then not fake first).
    ``fsd_mode`` tag leaves scores out of the decision.
    """
    caption = captions.groupBy("filename").agg(F.max(content_rejected()).alias("__rejects")).withColumn("__captioned", F.lit(True))
    score = scores.groupBy("filename").agg(F.min(F.struct("z_score", "is_fake")).alias("s")).select("filename", "s.z_score", "s.is_fake", F.lit(True).alias("__scored"))
    any_caption = captions.limit(1).agg((F.count("*") > 0).alias("__any_caption"))  # one row
    joined = items.join(caption, "filename", "left").join(score, "filename", "left").crossJoin(F.broadcast(any_caption))
    has = lambda flag: F.array_contains("flags", flag)
    looked_at = F.lower(F.regexp_extract("filename", r"\.[^.]+$", 0)).isin(*SUFFIXES)
    tests = [("too_small", has("too_few_pixels")), ("too_large", has("too_many_pixels")), ("camera_exif", has("camera_exif")), ("bad_aspect_ratio", has("non_native_aspect_ratio"))]
    if not relaxed:
        tests.append(("high_compression", has("high_compression")))
    if fsd_mode == "filter":
        tests.append(("fsd_real", F.coalesce("__scored", F.lit(False)) & ~F.coalesce("is_fake", F.lit(False))))
    reasons = text.named(tests)
    rejected_first = F.coalesce("__rejects", F.lit(False))
    waiting = ~looked_at | (F.col("__any_caption") & F.col("__captioned").isNull())
    tier = F.when(rejected_first, 0).when(~waiting, 1)
    out = joined.withColumn("tier", tier).withColumn("reasons", F.when(F.col("tier") == 1, reasons).otherwise(F.array().cast("array<string>")))
    state = F.when(F.col("tier") == 0, "rejected").when(F.col("tier").isNull(), "staging").when(F.size("reasons") == 0, "images").otherwise("rejected")
    return out.withColumn("state", state).drop("__rejects", "__captioned", "__scored", "__any_caption")


def failures_first(flagged: DataFrame) -> DataFrame:
    """Results for reading: what failed, then the rest, by name."""
    return flagged.orderBy("structural_passed", "filename")


def reset(items: DataFrame) -> DataFrame:
    """Decided images go back to staging."""
    again = F.col("state").isin("images", "rejected") & F.lower(F.regexp_extract("filename", r"\.[^.]+$", 0)).isin(*SUFFIXES)
    return items.withColumn("state", F.when(again, "staging").otherwise(F.col("state")))


def reason_histogram(decided: DataFrame) -> DataFrame:
    """How many reasons of each kind, the commonest first."""
    kinds = decided.filter("tier = 1").select(F.explode("reasons").alias("r")).groupBy(F.split_part("r", F.lit(":"), F.lit(1)).alias("reason"))
    return kinds.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def report(decided: DataFrame, threshold: float = DETECTED_BELOW, relaxed: bool = True, at: Column | None = None) -> DataFrame:
    """One row of JSON: when it was made (``at``: else now), totals and reasons over what tier 1 decided."""
    made = text.iso_time(F.current_timestamp() if at is None else at)
    looked_at = decided.filter("tier = 1")
    totals = looked_at.agg(F.count("*").alias("total"), F.count_if(F.col("state") == "images").alias("passed"), F.count_if(F.col("state") == "rejected").alias("rejected"))
    reasons = reason_histogram(decided).agg(F.coalesce(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))).alias("rejection_reasons"))
    whole = totals.crossJoin(F.broadcast(reasons)).select(made.alias("timestamp"), "total", "passed", "rejected", F.lit(threshold).alias("fsd_threshold"), F.lit(relaxed).alias("relaxed_mode"), "rejection_reasons")
    return whole.select(F.to_json(F.struct("*")).alias("report"))


def report_images(decided: DataFrame) -> DataFrame:
    """The report's part by image: a row of JSON for each that tier 1 decided."""
    passed = F.size("reasons") == 0
    return decided.filter("tier = 1").select(F.to_json(F.struct("filename", passed.alias("passed"), F.col("state").alias("destination"), "reasons")).alias("image"))


def reviewed(items: DataFrame, classes: DataFrame) -> DataFrame:
    """Staged items after human review: ``ai_art`` is accepted, any other class rejected.  ``action``: moved, not_found (a class
    without an item) or none (an item without a class)."""
    both = items.join(classes.select("filename", "category"), "filename", "full_outer")
    staged = F.col("state") == "staging"
    state = F.when(staged & (F.col("category") == "ai_art"), "images").when(staged & F.col("category").isNotNull(), "rejected").otherwise(F.col("state"))
    action = F.when(F.col("category").isNull(), "none").when(staged, "moved").otherwise("not_found")
    return both.withColumn("action", F.coalesce(action, F.lit("not_found"))).withColumn("state", state)


def review_counts(reviewed_items: DataFrame) -> DataFrame:
    """How many items a review moved to each state, and how many classes had no item: ``action, state, n``."""
    state = F.when(F.col("action") == "moved", F.col("state"))
    return reviewed_items.groupBy("action", state.alias("state")).agg(F.count("*").alias("n"))
