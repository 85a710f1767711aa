"""Pansharpening: the detail of the panchromatic band, matched to the luminance, as a gain on the colours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.functions import pixel as px
from terrazzo.operators import stencil
from terrazzo.operators.stats import moments

DETAIL, GAINS = 0.65, (0.6, 1.6)


def joined(rgb: DataFrame, pan: DataFrame, ratio: int, scale: float) -> DataFrame:
    """PAN pixels with the colours of the same place, bilinear from `ratio` times coarser, both in 0..1; invalid as 0."""
    fine = stencil.upsample(rgb.where(px.valid()).select("x", "y", *px.BANDS), ratio, list(px.BANDS))
    scaled = [px.clip(F.coalesce(F.col(b) / scale, px.double(0.0)), 0.0, 1.0).alias(b) for b in px.BANDS]
    return pan.join(fine, ["x", "y"], "left").select("x", "y", (F.col("pan") / scale).alias("pan"), *scaled, ((F.col("pan") > 0) & F.col("b1").isNotNull()).alias("valid"))


def intensity():
    return (299 * F.col("b1") + 587 * F.col("b2") + 114 * F.col("b3")) / px.double(1000.0)


def statistics(both: DataFrame, tile: int = 2048, stride: int = 4, width: int = 1 << 20) -> DataFrame:
    """One row: mean and deviation of pan and of luminance over the valid pixels of every stride-th tile (row-major)."""
    across = -(-width // tile)
    index = F.floor(F.col("y") / tile) * across + F.floor(F.col("x") / tile)
    return moments(both.where(F.col("valid") & (index % stride == 0)), [], {"pan": F.col("pan"), "luma": intensity()})


def matched(both: DataFrame, stats: DataFrame) -> DataFrame:
    """The pan band with the mean and deviation of the luminance, as v; stats is one row."""
    v = (F.col("pan") - F.col("pan_mean")) * (F.col("luma_std") / F.greatest(F.col("pan_std"), px.double(1e-6))) + F.col("luma_mean")
    return both.crossJoin(stats).select(*both.columns, v.alias("v"))


def sharpen(rgb: DataFrame, pan: DataFrame, ratio: int, width: int, height: int, scale: float = 65535.0, strength: float = DETAIL, tile: int = 2048, stride: int = 4) -> DataFrame:
    """x, y, b1, b2, b3 at PAN resolution, whole numbers (cut after rounding to a millionth, so that the last bit of a sum in
    another order does not count); 0 where pan or colour is missing. width, height: of pan."""
    both = joined(rgb, pan, ratio, scale)
    m = matched(both, statistics(both, tile, stride, width))
    low = stencil.gaussian(m.select("x", "y", "v"), max(1.0, ratio / 2), width, height)
    out = m.join(low.withColumnRenamed("v", "low"), ["x", "y"])
    i = intensity()
    target = px.clip(i + strength * (F.col("v") - F.col("low")), 0.0, 1.0)
    gain = px.clip(F.when(i > 1e-6, target / F.greatest(i, px.double(1e-6))).otherwise(1.0), *GAINS)
    each = [F.when(F.col("valid"), px.truncated(F.round(px.clip(F.col(b) * gain, 0.0, 1.0) * scale, 6), int(scale))).otherwise(0).cast("long").alias(b) for b in px.BANDS]
    return out.select("x", "y", *each)
