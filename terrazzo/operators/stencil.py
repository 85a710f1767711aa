"""Neighbourhood operators. Each scatters a pixel's contribution to the locations it affects and aggregates there, so the
only shuffle is one aggregation with map-side combining; borders reflect with the edge doubled."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACTORS = (2, 4, 8, 16, 32)


def reflected(i: Column, n: Column) -> Column:
    return F.when(i < 0, -i - 1).when(i >= n, 2 * n - 1 - i).otherwise(i)


def median_fill(band: DataFrame, width: int, height: int, key: str = "scene_id", value: str = "dn") -> DataFrame:
    """Where the value is 0, the median of the 3 x 3 neighbourhood (zeros and absent pixels take part as 0). Only zero
    pixels look at their neighbours."""
    offsets = F.array(*(F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    holes = band.where(F.col(value) == 0).select(key, "x", "y", F.explode(offsets).alias("o"))
    near = holes.select(key, "x", "y", reflected(F.col("x") + F.col("o.i"), F.lit(width)).alias("nx"), reflected(F.col("y") + F.col("o.j"), F.lit(height)).alias("ny"))
    there = band.select(key, F.col("x").alias("nx"), F.col("y").alias("ny"), F.col(value).alias("v"))
    filled = near.join(there, [key, "nx", "ny"], "left").groupBy(key, "x", "y").agg(F.sort_array(F.collect_list(F.coalesce("v", F.lit(0))))[4].alias("m"))
    return band.join(filled, [key, "x", "y"], "left").select(key, "x", "y", F.coalesce("m", value).alias(value))


def kernel(deviation: float) -> list[float]:
    radius = int(4 * deviation + 0.5)
    w = [math.exp(-(i * i) / (2 * deviation * deviation)) for i in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def gaussian(df: DataFrame, deviation: float, width: int, height: int, value: str = "v") -> DataFrame:
    """Separable low-pass over the whole raster, absent pixels as 0; x, y, value of every location that is reached."""
    w = kernel(deviation)
    radius = len(w) // 2
    for axis, n in (("x", width), ("y", height)):
        steps = F.array(*(F.struct(F.lit(i - radius).cast("long").alias("i"), F.lit(k).alias("w")) for i, k in enumerate(w)))
        each = df.select("x", "y", value, F.explode(steps).alias("s"))
        at, i = F.col(axis), F.col("s.i")
        plain = at - i
        targets = F.filter(
            F.array(
                F.when(plain.between(0, n - 1), plain),
                F.when((-at - 1 - i).between(0, n - 1) & (-at - 1 < 0), F.when((-at - 1 - i) + i < 0, -at - 1 - i)),
                F.when((2 * n - 1 - at - i).between(0, n - 1), F.when((2 * n - 1 - at - i) + i >= n, 2 * n - 1 - at - i)),
            ),
            lambda t: t.isNotNull(),
        )
        other = "y" if axis == "x" else "x"
        df = each.select(other, F.explode(targets).alias(axis), (F.col(value) * F.col("s.w")).alias("c")).groupBy("x", "y").agg(F.sum("c").alias(value))
    return df


def upsample(df: DataFrame, factor: int, values: list[str]) -> DataFrame:
    """Bilinear, to `factor` times the resolution: each source pixel adds to the fine pixels whose four neighbours hold
    it; the weights of absent neighbours are left out. A single aggregation."""
    offsets = F.array(*(F.lit(i).cast("long") for i in range(-factor, 2 * factor)))
    weight = lambda f, c: 1 - F.abs((f + 0.5) / factor - 0.5 - c)
    fine = df.select("*", F.explode(offsets).alias("i")).withColumn("fx", F.col("x") * factor + F.col("i")).withColumn("wx", weight(F.col("fx"), F.col("x"))).where("wx > 0 and fx >= 0").drop("i")
    fine = fine.select("*", F.explode(offsets).alias("j")).withColumn("fy", F.col("y") * factor + F.col("j")).withColumn("wy", weight(F.col("fy"), F.col("y"))).where("wy > 0 and fy >= 0")
    w = F.col("wx") * F.col("wy")
    return fine.groupBy(F.col("fx").alias("x"), F.col("fy").alias("y")).agg(*((F.sum(F.col(v) * w) / F.sum(w)).alias(v) for v in values))


def overviews(df: DataFrame, factors: tuple[int, ...] = FACTORS) -> DataFrame:
    """factor, x, y and the values of every factor-th pixel (nearest); one pass over the pixels."""
    values = [c for c in df.columns if c not in ("x", "y")]
    each = df.select("*", F.explode(F.array(*(F.lit(f).cast("long") for f in factors))).alias("factor"))
    return each.where("x % factor = 0 and y % factor = 0").selectExpr("factor", "x div factor as x", "y div factor as y", *values)


def decimated(df: DataFrame, width: int, height: int, most: int) -> DataFrame:
    """Every k-th pixel, so that no side has more than `most`; unchanged if none has."""
    k = max(1, -(-max(width, height) // most))
    return df if k == 1 else df.where(f"x % {k} = 0 and y % {k} = 0").withColumns({"x": F.expr(f"x div {k}"), "y": F.expr(f"y div {k}")})


def tiles(width: int, height: int, side: int):
    """Windows in row-major order as SQL rows: index, row_off, col_off, height, width; the last ones are ragged."""
    across = -(-width // side)
    return f"select i as tile, (i div {across}) * {side} as row_off, (i % {across}) * {side} as col_off, least({side}L, {height}L - (i div {across}) * {side}) as height, least({side}L, {width}L - (i % {across}) * {side}) as width from range({across * -(-height // side)}) t(i)"
