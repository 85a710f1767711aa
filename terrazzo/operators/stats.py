"""Grouped statistics. Exact percentiles are taken from a value histogram: values are counted first (map-side combined, as
pixels have few distinct values), so no group's pixels are held in memory, only its distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions import pixel as px

LEVELS = ("low", "mid", "high")


def percentiles(df: DataFrame, keys: list[str], channels: dict[str, Column], at: list[float], weight: str | None = None) -> DataFrame:
    """keys, then for each channel `<channel>_p`, the array of its interpolated percentiles (0 to 100; null of nothing), and
    `pixels`, the number of rows, or the sum of their weights."""
    pairs = F.array(*(F.struct(F.lit(name).alias("channel"), c.cast("double").alias("v")) for name, c in channels.items()))
    weights = F.col(weight) if weight else F.lit(1)
    counted = df.select(*keys, weights.cast("long").alias("weight"), F.explode(pairs).alias("c")).groupBy(*keys, "c.channel", "c.v").agg(F.sum("weight").alias("n"))
    at_ = F.array(*(F.lit(p / 100) for p in at))
    each = [F.percentile(F.when(F.col("channel") == name, F.col("v")), at_, F.col("n")).alias(f"{name}_p") for name in channels]
    rows = F.sum(F.when(F.col("channel") == next(iter(channels)), F.col("n"))).alias("pixels")
    return counted.groupBy(*keys).agg(*each, rows)


def colours(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, b1, b2, b3 and `weight`, how many valid pixels have them: all that ranks, masks and profiles of colours need of a
    raster, from one scan with map-side combining."""
    return pixels.where(px.valid()).groupBy(*keys, *px.BANDS).agg(F.count("*").alias("weight"))


def band_profile(df: DataFrame, keys: list[str], low: float, high: float, names: tuple[str, ...] = px.BANDS, weight: str | None = None) -> DataFrame:
    """Colour profile: low, mid, high of each band and of luma, median colour ratios, and the number of pixels."""
    luma = px.brightness(names)
    channels = {n: F.col(n) for n in names} | {"luma": luma}
    ratios = {f"{n}_ratio": px.color_ratio(F.col(n), luma) for n in names}
    p = percentiles(df, keys, channels | ratios, [low, 50, high], weight)
    wide = [F.col(f"{c}_p")[i].alias(f"{c}_{level}") for c in channels for i, level in enumerate(LEVELS)]
    return p.select(*keys, *wide, *(F.col(f"{r}_p")[1].alias(r) for r in ratios), "pixels")


def limits(df: DataFrame, keys: list[str], low: float = 2.0, high: float = 98.0, names: tuple[str, ...] = px.BANDS) -> DataFrame:
    """`<band>_lo`, `<band>_hi`; a degenerate high becomes low + 1."""
    p = percentiles(df, keys, {n: F.col(n) for n in names}, [low, high])
    lo, hi = (lambda n: F.col(f"{n}_p")[0]), (lambda n: F.col(f"{n}_p")[1])
    pairs = [(lo(n).alias(f"{n}_lo"), F.when(hi(n) <= lo(n), lo(n) + 1).otherwise(hi(n)).alias(f"{n}_hi")) for n in names]
    return p.select(*keys, *(c for pair in pairs for c in pair))


def moments(df: DataFrame, keys: list[str], channels: dict[str, Column]) -> DataFrame:
    """`<channel>_mean`, `<channel>_std` by sums of values and squares, the variance at least 1e-6."""
    aggs = [a for n, c in channels.items() for a in (F.sum(c).alias(f"{n}_s"), F.sum(c * c).alias(f"{n}_q"))]
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *aggs)
    mean = lambda n: F.col(f"{n}_s") / F.col("n")
    out = [c for n in channels for c in (mean(n).alias(f"{n}_mean"), F.sqrt(F.greatest(F.col(f"{n}_q") / F.col("n") - mean(n) * mean(n), px.double(1e-6))).alias(f"{n}_std"))]
    return sums.select(*keys, *out, "n")


def histogram(df: DataFrame, keys: list[str], value: Column, low: float, high: float, bins: int) -> DataFrame:
    """Equal bins of low..high, the last one closed, with counts and densities."""
    width = (high - low) / bins
    counted = df.groupBy(*keys, F.least(F.lit(bins).cast("long"), F.floor((value - low) / width) + 1).alias("bin")).agg(F.count("*").alias("n"))
    total = counted.groupBy(*keys).agg(F.sum("n").alias("total"))
    joined = counted.join(total, keys) if keys else counted.crossJoin(total)  # one row
    return joined.select(*keys, "bin", "n", (F.col("n") / (F.col("total") * width)).alias("density"))
