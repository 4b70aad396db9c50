"""Model versions by source and flair, a ladder for each dataset; the first rung that holds decides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import filled

Rungs = list[tuple[Column, str]]

# Versions by flair.
FLUX1_VERSIONS = {"onsite:model_version:691639": "dev", "onsite:model_version:699279": "schnell", "onsite:model_version:922358": "pro_1.1", "onsite:model_version:1088507": "pro_1.1_ultra", "onsite:model_version:1892509": "kontext_pro", "onsite:model_version:2068000": "krea_dev"}
FLUX2_VERSIONS = {"onsite:model_version:2439047": "max", "onsite:model_version:2439067": "dev", "onsite:model_version:2439442": "pro", "onsite:model_version:2547175": "flex"}


def ladder(rungs: Rungs, otherwise: str) -> Column:
    out = F.when(*rungs[0])
    for condition, label in rungs[1:]:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def _has(part: str, *cols: Column) -> Column:
    out = cols[0].contains(part)
    for c in cols[1:]:
        out = out | c.contains(part)
    return out


def _onsite(source: Column, flair: Column, versions: dict[str, str]) -> Rungs:
    return [((source == "civitai") & (flair == k), label) for k, label in versions.items()]


def _grok(source: Column, flair: Column) -> Column:
    return ladder([(_has("grok_imagine", source), "grok"), (source == "civitai", "grok_civitai"), (source == "twitter", "grok_twitter")], "grok")


def _flux1(source: Column, flair: Column) -> Column:
    low, on_tensor, on_yodayo = F.lower(flair), source == "tensorart", _has("yodayo", source, flair)
    return ladder(
        [
            *_onsite(source, flair, FLUX1_VERSIONS),
            (_has("flux_kontext", source, flair), "kontext"),
            (source == "openart", "unknown_openart"),
            (on_tensor & low.contains("schnell"), "schnell"),
            (on_tensor & low.contains("dev"), "dev"),
            (on_tensor, "unknown_tensorart"),
            (on_yodayo & _has("schnell", low, F.lower(source)), "schnell"),
            (on_yodayo, "dev"),
        ],
        "unknown",
    )


def _flux2(source: Column, flair: Column) -> Column:
    return ladder([*_onsite(source, flair, FLUX2_VERSIONS), (_has("flux_2", flair, source), "dev")], "unknown")


def _midjourney(source: Column, flair: Column) -> Column:
    low = F.lower(flair)
    return ladder([(low.contains("v8"), "v8"), (low.contains("v7"), "v7"), (low.contains("vunknown"), "v7_default")], "v7")


def _soul2(source: Column, flair: Column) -> Column:
    low = F.lower(flair)
    return ladder([(low.contains("soul_v2"), "soul_v2"), (low.contains("soul_cinematic"), "soul_cinematic"), (low.contains("ai_influencer"), "ai_influencer"), (low.contains("soul"), "soul_v1")], "unknown")


def _nano_banana(source: Column, flair: Column) -> Column:
    return ladder([(_has("nano_banana_2", source, flair), "v2"), (_has("nano_banana", source, flair), "v1")], "unknown")


def _seedream4(source: Column, flair: Column) -> Column:
    low, src = F.lower(flair), F.lower(source)
    lite = _has("5.0_lite", low) | _has("5_lite", low) | _has("50_lite", src) | _has("v5_lite", low, src)
    return ladder([(lite, "seedream_5.0_lite"), (_has("4.5", low) | _has("v4_5", src) | _has("v45", src) | _has("model_version:2470991", flair), "seedream_4.5")], "seedream_4.0")


def _gpt_image(source: Column, flair: Column) -> Column:
    newer = _has("model_version:2512167", flair) | _has("openai_hazel", flair, source)
    return ladder([(newer, "gpt-image-1.5"), (_has("model_version:1733399", flair) | _has("text2image_gpt", flair, source), "gpt-image-1")], "unknown")


def _recraft(source: Column, flair: Column) -> Column:
    low = F.lower(flair)
    return ladder([(low.contains("recraftv4_pro"), "v4_pro"), (low.contains("recraftv4"), "v4"), (low.contains("recraftv3"), "v3")], "unknown")


LADDERS: dict[str, Callable[[Column, Column], Column]] = {
    "grok": _grok,
    "flux1": _flux1,
    "flux2": _flux2,
    "midjourney_v7": _midjourney,
    "soul2": _soul2,
    "nano_banana_1_2": _nano_banana,
    "seedream4": _seedream4,
    "gpt_image_1": _gpt_image,
    "recraft_3_4": _recraft,
    "instagram_ai_influencer": lambda source, flair: F.lit("unknown"),
}


def register_ladder(dataset: str, rule: Callable[[Column, Column], Column]) -> None:
    """Adds a dataset's rule: (source, flair) to a version."""
    LADDERS[dataset] = rule


def model_version(dataset: str, source: Column, flair: Column) -> Column:
    return LADDERS[dataset](filled(source), filled(flair)) if dataset in LADDERS else F.lit("unknown")


def build_metadata(manifest: DataFrame, listing: DataFrame, dataset: str) -> DataFrame:
    """The metadata of the manifest's items that are listed, by file name."""
    kept = manifest.join(listing.select("filename").distinct(), "filename", "left_semi")
    plain = ["width", "height", "format", "file_size", "url", "timestamp"]
    version = model_version(dataset, F.col("source"), F.col("flair"))
    return kept.select("filename", filled(F.col("source")).alias("source"), version.alias("model_version"), *(filled(F.col(c)).alias(c) for c in plain)).orderBy("filename")
