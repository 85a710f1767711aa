"""Pixel masks ranked within a scene: per-scene percentiles of luma joined back to the pixels.

Each function takes pixels that are valid (and unique), adds its inputs and returns the pixels with a boolean column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions import pixel as px
from terrazzo.operators.stats import percentiles

BROAD = [2, 20, 92, 97, 98]
CLEAR = [1, 10, 20, 55, 82, 90, 96]


def ranked(df: DataFrame, keys: list[str], at: list[float], weight: str | None = None, **channels: Column) -> DataFrame:
    """Adds `<channel><percentile>` of each channel within keys; one small row for each key meets the pixels."""
    p = percentiles(df, keys, channels, at, weight)
    named = p.select(*keys, *(F.col(f"{c}_p")[i].alias(f"{c}{q}") for c in channels for i, q in enumerate(at)))
    return df.join(named, keys) if keys else df.crossJoin(named)  # one row


def within(luma: Column, low: Column, high: Column) -> Column:
    """Between two percentiles; everything if they coincide."""
    return (high <= low) | luma.between(low, high)


def extremes(df: DataFrame, keys: list[str], low: float = 2, high: float = 98) -> DataFrame:
    r = ranked(df.withColumn("luma", px.brightness()), keys, [low, high], p=F.col("luma"))
    return r.select(*df.columns, within(F.col("luma"), F.col(f"p{low}"), F.col(f"p{high}")).alias("mask"))


def broad_rule(luma: Column, sat: Column, p) -> Column:
    cloud = ((luma > p(92)) & (sat < 0.22)) | (luma > p(97)) | ((luma > p(20)) & (sat > 0.90))
    return within(luma, p(2), p(98)) & ~cloud


def clear_rule(r: Column, g: Column, b: Column, luma: Column, sat: Column, p) -> Column:
    blue = (b > 1.10 * r) & (b > 0.94 * g)
    cyan = (g > 1.08 * r) & (b > 1.04 * r)
    water = ((luma < p(55)) & (b > 1.04 * r) & (g > 0.92 * r)) | (cyan & (luma < p(90)) & (sat > 0.10)) | (blue & (luma < p(82)) & (sat > 0.16) & (r < 0.92 * g))
    shadow = luma < F.greatest(px.double(1.0), 0.60 * p(20))
    cloud = ((luma > p(90)) & (sat < 0.24)) | ((luma > p(96)) & (sat < 0.42)) | ((luma > p(90)) & blue & (sat < 0.38))
    return within(luma, p(1), p(96)) & ~water & ~shadow & ~cloud & ~((luma > p(10)) & (sat > 0.85))


def _lit(df: DataFrame) -> DataFrame:
    return df.withColumn("luma", px.brightness()).withColumn("sat", px.saturation(F.col("luma")))


def broad(df: DataFrame, keys: list[str]) -> DataFrame:
    r = ranked(_lit(df), keys, BROAD, p=F.col("luma"))
    return r.select(*df.columns, broad_rule(F.col("luma"), F.col("sat"), lambda q: F.col(f"p{q}")).alias("mask"))


def broad_and_extremes(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Both masks, b and e, from one ranking."""
    r = ranked(_lit(df), keys, BROAD, weight, p=F.col("luma"))
    return r.select(*df.columns, broad_rule(F.col("luma"), F.col("sat"), lambda q: F.col(f"p{q}")).alias("b"), within(F.col("luma"), F.col("p2"), F.col("p98")).alias("e"))


def clear_land(df: DataFrame, keys: list[str]) -> DataFrame:
    r = ranked(_lit(df), keys, CLEAR, p=F.col("luma"))
    return r.select(*df.columns, clear_rule(*px.bands(), F.col("luma"), F.col("sat"), lambda q: F.col(f"p{q}")).alias("mask"))


def stable(df: DataFrame, keys: list[str], least: int = 1000) -> DataFrame:
    """Pixels fit for harmonising: not extreme, not vivid, not blue; all of them where fewer than `least` are."""
    r = ranked(df.withColumn("luma", px.brightness()), keys, [1, 92], p=F.col("luma"))
    fit = F.col("luma").between(F.col("p1"), F.col("p92")) & (px.saturation_of_maximum() <= 0.88) & (px.blue_ratio() <= 0.55)
    marked = r.select(*df.columns, fit.alias("fit"))
    counts = marked.groupBy(*keys).agg(F.count_if("fit").alias("enough"))
    return marked.join(counts, keys).select(*df.columns, (F.col("fit") | (F.col("enough") < least)).alias("mask"))


def overlap(pairs: DataFrame, keys: list[str], least: int = 500) -> DataFrame:
    """For co-registered pairs (a1..a3, b1..b3, all valid): both clear land; where fewer than `least` are, both lumas within
    their own 5th to 95th percentile and either clear land. Percentiles are taken over the joint pixels."""
    sides = {"a": ("a1", "a2", "a3"), "b": ("b1", "b2", "b3")}
    out = pairs
    for s, names in sides.items():
        luma = px.brightness(names)
        out = out.withColumn(f"{s}_luma", luma)
        out = out.withColumn(f"{s}_sat", px.spread(names) / F.greatest(F.col(f"{s}_luma"), px.double(1.0)))
    out = ranked(out, keys, [*CLEAR, 5, 95], a_p=F.col("a_luma"), b_p=F.col("b_luma"))
    land = {s: clear_rule(*(F.col(n) for n in names), F.col(f"{s}_luma"), F.col(f"{s}_sat"), lambda q, s=s: F.col(f"{s}_p{q}")) for s, names in sides.items()}
    usual = [F.col(f"{s}_luma").between(F.col(f"{s}_p5"), F.col(f"{s}_p95")) for s in sides]
    marked = out.select(*pairs.columns, (land["a"] & land["b"]).alias("strict"), (usual[0] & usual[1] & (land["a"] | land["b"])).alias("relaxed"))
    counts = marked.groupBy(*keys).agg(F.count_if("strict").alias("enough"))
    return marked.join(counts, keys).select(*pairs.columns, F.when(F.col("enough") >= least, F.col("strict")).otherwise(F.col("relaxed")).alias("mask"))
