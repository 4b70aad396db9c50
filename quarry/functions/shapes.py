"""Expressions over image sizes: ratios, pixels, compression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.config import ratio_label


def pixels(w: Column, h: Column) -> Column:
    return w.cast("bigint") * h.cast("bigint")


def aspect(w: Column, h: Column) -> Column:
    """Width by height; null without a height."""
    return F.when(h != 0, w.cast("double") / h.cast("double"))


def bits_per_pixel(size: Column, w: Column, h: Column) -> Column:
    px = pixels(w, h)
    return F.when(px > 0, size.cast("double") * 8 / px).otherwise(0.0)


def known_ratio(w: Column, h: Column, ratios: Sequence[tuple[float, float]], tolerance: float) -> Column:
    """The label of the first known ratio within the tolerance; null if there is none, or a side is 0."""
    x = F.when((w != 0) & (h != 0), aspect(w, h))
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for rw, rh in ratios:
        expected = F.lit(rw) / F.lit(rh)
        out = out.when(F.abs(x - expected) / expected <= F.lit(tolerance), ratio_label(rw, rh))
    return out


def near_resolution(w: Column, h: Column, native: Sequence[tuple[int, int]], tolerance: int = 2) -> Column:
    """Whether both sides are within ``tolerance`` pixels of a native resolution."""
    out = F.lit(False)
    for nw, nh in native:
        out = out | ((F.abs(w - nw) <= tolerance) & (F.abs(h - nh) <= tolerance))
    return out
