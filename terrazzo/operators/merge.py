"""Mosaics: overlapping pixels of scenes merged into one, by one aggregation on the location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions import pixel as px
from terrazzo.operators import stencil

METHODS = ("mean", "average", "first", "last", "min", "max")


def order_of(scene: Column, reference: int | None) -> Column:
    """The reference comes first, the others in input order."""
    return scene.cast("long") if reference is None else F.when(scene == reference, F.lit(-1).cast("long")).otherwise(scene.cast("long"))


def merge(pixels: DataFrame, method: str = "mean", reference: int | None = None, top: int = px.TOP) -> DataFrame:
    """x, y, b1, b2, b3. mean: over scenes valid in all bands, truncated; average: for each band over its own valid
    scenes, half to even; first, last, min, max: for each band over its own valid scenes. Locations without any stay out."""
    if method not in METHODS:
        raise ValueError(f"unknown merge method {method!r}; one of {', '.join(METHODS)}")
    if method == "mean":
        return pixels.where(px.valid()).groupBy("x", "y").agg(*(px.truncated(F.sum(b) / F.count("*"), top).alias(b) for b in px.BANDS))
    some = pixels.where(F.greatest(*px.bands()) > 0).withColumn("ord", order_of(F.col("scene_id"), reference))
    own = lambda b: F.when(F.col(b) > 0, F.col(b))
    # order and value (16 bits) in one number: a plain minimum, which aggregates by hash; a struct's would sort every pixel
    placed = lambda b: F.when(F.col(b) > 0, F.shiftleft("ord", 16).bitwiseOR(F.col(b).cast("long")))
    value = lambda c: c.bitwiseAND(F.lit(65535))
    each = {
        "average": lambda b: px.clip(F.rint(F.avg(own(b))), 0.0, float(top)).cast("long"),
        "first": lambda b: value(F.min(placed(b))),
        "last": lambda b: value(F.max(placed(b))),
        "min": lambda b: F.min(own(b)),
        "max": lambda b: F.max(own(b)),
    }[method]
    return some.groupBy("x", "y").agg(*(F.coalesce(each(b), F.lit(0)).cast("long").alias(b) for b in px.BANDS))


def stack(red: DataFrame, green: DataFrame, blue: DataFrame, crop: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, x, y, b1, b2, b3 from three single-band rasters (keys, x, y, dn): the common locations, or all of red's with 0
    elsewhere."""
    how, at = "inner" if crop else "left", [*keys, "x", "y"]
    g, b = green.select(*at, F.col("dn").alias("b2")), blue.select(*at, F.col("dn").alias("b3"))
    joined = red.select(*at, F.col("dn").alias("b1")).join(g, at, how).join(b, at, how)
    return joined.na.fill(0, list(px.BANDS))


def composite(bands: DataFrame, width: int, height: int, numbers: tuple[int, int, int] = (3, 2, 1)) -> DataFrame:
    """scene_id, x, y, b1, b2, b3 of all scenes of a band table (scene_id, band, x, y, dn) at once: in each of the red, green
    and blue bands (by number) missing pixels take the median of their neighbours, then the bands are stacked where all are."""
    filled = [stencil.median_fill(bands.where(F.col("band") == n).select("scene_id", "x", "y", "dn"), width, height) for n in numbers]
    return stack(*filled, keys=("scene_id",))
