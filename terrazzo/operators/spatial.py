"""Bounds, grids, polygons and map projections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions.pixel import double


def inside(pixels: DataFrame, edges: DataFrame) -> DataFrame:
    """Pixels whose centre is inside any of the polygons (an odd number of crossings of its own rings; edges without a
    polygon column are one polygon). Edges become crossings of scan lines: a row of the raster has a short list of them for
    each polygon, and meets its pixels by an equi-join on y."""
    if "polygon" not in edges.columns:
        edges = edges.withColumn("polygon", F.lit(0))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = edges.where("y1 <> y2").select("*", F.explode(F.sequence(F.ceil(low - 0.5), F.ceil(high - 0.5))).alias("y"))
    middle = F.col("y") + 0.5
    hit = lines.where((F.col("y1") > middle) != (F.col("y2") > middle))
    at = (F.col("x2") - F.col("x1")) * (middle - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    crossings = hit.groupBy("y", "polygon").agg(F.collect_list(at).alias("at")).groupBy("y").agg(F.collect_list("at").alias("rows"))
    joined = pixels.join(crossings, "y")
    return joined.where(F.exists("rows", lambda row: F.size(F.filter(row, lambda a: a > F.col("x") + 0.5)) % 2 == 1)).select(*pixels.columns)


def clip(pixels: DataFrame, edges: DataFrame) -> DataFrame:
    """Pixels within the polygons, moved so that their bounding box starts at 0; fails if there are none. The box is one row
    that the plan computes; only whether any pixel is inside is asked for beforehand."""
    own = inside(pixels, edges)
    if own.isEmpty():
        raise ValueError("the polygon is empty, or does not meet the raster")
    box = edges.agg(F.floor(F.min(F.least("x1", "x2"))).alias("x0"), F.floor(F.min(F.least("y1", "y2"))).alias("y0"))
    moved = own.crossJoin(F.broadcast(box))  # one row
    return moved.withColumns({"x": F.col("x") - F.col("x0"), "y": F.col("y") - F.col("y0")}).select(*pixels.columns)


def box_meets(edges: Column, left: Column, bottom: Column, right: Column, top: Column) -> Column:
    """Whether the inside of a box shares points with a polygon, given as an array of edges (x1, y1, x2, y2): an edge passes
    through the box, or the box's centre is inside."""
    cx, cy = (left + right) / 2, (bottom + top) / 2

    def passes(e: Column) -> Column:
        """The part of the edge within the box has length: it enters, on each axis, before it leaves."""
        into, out = [F.lit(0.0)], [F.lit(1.0)]
        ok = F.lit(True)
        for a, b, low, high in ((e["x1"], e["x2"], left, right), (e["y1"], e["y2"], bottom, top)):
            d = b - a
            flat = d == 0
            ok = ok & (~flat | ((a > low) & (a < high)))
            near, far = F.when(d > 0, low - a).otherwise(high - a), F.when(d > 0, high - a).otherwise(low - a)
            step = F.when(flat, F.lit(1.0)).otherwise(d)
            into.append(F.when(flat, F.lit(0.0)).otherwise(near / step))
            out.append(F.when(flat, F.lit(1.0)).otherwise(far / step))
        return ok & (F.greatest(*into) < F.least(*out))

    crossed = lambda e: ((e["y1"] > cy) != (e["y2"] > cy)) & (cx < (e["x2"] - e["x1"]) * (cy - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    return F.exists(edges, passes) | (F.size(F.filter(edges, crossed)) % 2 == 1)


def intersection(a: str, b: str) -> list[Column]:
    """Common bounds of two structs (left, bottom, right, top)."""
    c = lambda s, f: F.col(f"{s}.{f}")
    return [F.greatest(c(a, "left"), c(b, "left")).alias("left"), F.greatest(c(a, "bottom"), c(b, "bottom")).alias("bottom"), F.least(c(a, "right"), c(b, "right")).alias("right"), F.least(c(a, "top"), c(b, "top")).alias("top")]


def overlapping(a: str, b: str) -> Column:
    """Strictly: touching bounds do not overlap."""
    left, bottom, right, top = intersection(a, b)
    return (left < right) & (bottom < top)


def common_grid(bounds: DataFrame) -> DataFrame:
    """origin_left, origin_top, res_x, res_y: the finest resolution, the envelope snapped outwards to its multiples."""
    e = bounds.agg(F.min("left").alias("l"), F.max("top").alias("t"), F.min("res_x").alias("res_x"), F.min("res_y").alias("res_y"))
    return e.select((F.floor(F.col("l") / F.col("res_x")) * F.col("res_x")).alias("origin_left"), (F.ceil(F.col("t") / F.col("res_y")) * F.col("res_y")).alias("origin_top"), "res_x", "res_y")


def aligned(left: Column, bottom: Column, right: Column, top: Column, x0: Column, y0: Column, rx: Column, ry: Column) -> list[Column]:
    """Bounds snapped outwards to a grid, and the number of its cells they span, at least one each way."""
    al, ar = x0 + F.floor((left - x0) / rx) * rx, x0 + F.ceil((right - x0) / rx) * rx
    at, ab = y0 - F.floor((y0 - top) / ry) * ry, y0 - F.ceil((y0 - bottom) / ry) * ry
    return [al.alias("left"), at.alias("top"), F.greatest(F.lit(1).cast("long"), F.rint((ar - al) / rx).cast("long")).alias("width"), F.greatest(F.lit(1).cast("long"), F.rint((at - ab) / ry).cast("long")).alias("height")]


def window(left: Column, bottom: Column, right: Column, top: Column, x0: float, y0: float, res: float, width: int, height: int) -> list[Column]:
    """Bounds as a window of a raster, rounded and cut to it; null columns outside of it."""
    c0, r0 = F.rint((left - x0) / res).cast("long"), F.rint((y0 - top) / res).cast("long")
    c1, r1 = F.rint((right - x0) / res).cast("long"), F.rint((y0 - bottom) / res).cast("long")
    zero = F.lit(0).cast("long")
    a, b, c, d = F.greatest(c0, zero), F.greatest(r0, zero), F.least(c1, F.lit(width).cast("long")), F.least(r1, F.lit(height).cast("long"))
    ok = (a < c) & (b < d)
    return [F.when(ok, a).alias("col_off"), F.when(ok, b).alias("row_off"), F.when(ok, c - a).alias("width"), F.when(ok, d - b).alias("height")]


def to_map(x: Column, y: Column, x0: float, y0: float, res_x: float, res_y: float) -> list[Column]:
    return [(x0 + (x + 0.5) * res_x).alias("map_x"), (y0 - (y + 0.5) * res_y).alias("map_y")]


#: GRS 80, and the scale of transverse Mercator zones.
MAJOR, FLATTENING, SCALE = 6378137.0, 1 / 298.257222101, 0.9996


def to_utm(lon: Column, lat: Column, zone: int, south: bool = True) -> list[Column]:
    """Easting and northing (series to the sixth order, below a millimetre within a zone)."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep = e2 / (1 - e2)
    phi, dl = F.radians(lat), F.radians(lon - (6 * zone - 183))
    s, c, t = F.sin(phi), F.cos(phi), F.pow(F.tan(phi), 2)
    n, cc, a = MAJOR / F.sqrt(1 - e2 * s * s), ep * c * c, c * dl
    m = MAJOR * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - (35 * e2**3 / 3072) * F.sin(6 * phi))
    east = SCALE * n * (a + (1 - t + cc) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep) * F.pow(a, 5) / 120) + 500000.0
    north = SCALE * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * cc + 4 * cc * cc) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * cc - 330 * ep) * F.pow(a, 6) / 720)) + (10000000.0 if south else 0.0)
    return [east.alias("easting"), north.alias("northing")]


def from_utm(east: Column, north: Column, zone: int, south: bool = True) -> list[Column]:
    """Longitude and latitude in degrees."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (north - (10000000.0 if south else 0.0)) / (SCALE * MAJOR * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    s, c, t = F.sin(p), F.cos(p), F.pow(F.tan(p), 2)
    c1, w = ep * c * c, 1 - e2 * s * s
    n, r = MAJOR / F.sqrt(w), MAJOR * (1 - e2) / F.pow(w, 1.5)
    d = (east - 500000.0) / (n * SCALE)
    lat = p - (n * F.tan(p) / r) * (d * d / 2 - (5 + 3 * t + 10 * c1 - 4 * c1 * c1 - 9 * ep) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c1 + 45 * t * t - 252 * ep - 3 * c1 * c1) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t + c1) * F.pow(d, 3) / 6 + (5 - 2 * c1 + 28 * t - 3 * c1 * c1 + 8 * ep + 24 * t * t) * F.pow(d, 5) / 120) / c
    return [(F.degrees(lon) + (6 * zone - 183)).alias("lon"), F.degrees(lat).alias("lat")]


#: Source pixels along each axis that a kernel weighs.
TAPS = {"nearest": 1, "bilinear": 2, "cubic": 4}


def _weight(method: str, t: Column) -> Column:
    """Of a pixel at distance t; cubic is Keys' kernel with a = -1/2."""
    d = F.abs(t)
    if method == "bilinear":
        return 1 - d
    if method == "cubic":
        return F.when(d <= 1, (1.5 * d - 2.5) * d * d + 1).otherwise(((2.5 - 0.5 * d) * d - 4) * d + 2)
    return F.lit(1.0)


def reproject(pixels: DataFrame, bands: list[str], origin: tuple[float, float], step: float, zone: int, res: float, grid: tuple[float, float, int, int] | None = None, method: str = "cubic") -> DataFrame:
    """col, row and the bands of one geographic raster (left and top in origin, step in degrees) on a grid of its UTM zone:
    (left, top, width, height), by default the pixels' bounds snapped outwards to res; col and row count from the grid's
    corner. Every cell is mapped back to the source and takes the weighted mean of its valid neighbours (0 in all bands is
    no data), rounded to 0..65535. A cell is left out, as no data, if the pixel that holds its centre is missing or invalid."""
    if method not in TAPS:
        raise ValueError(f"unknown resampling {method}")
    x0, y0 = origin
    if grid is None:
        near = F.explode(F.array(*(F.struct((F.col("x") + i).alias("px"), (F.col("y") + j).alias("py")) for i in (0, 1) for j in (0, 1)))).alias("c")
        corners = pixels.select(near).select(*to_utm(x0 + F.col("c.px") * step, y0 - F.col("c.py") * step, zone))
        b = corners.agg(F.min("easting").alias("l"), F.max("easting").alias("r"), F.min("northing").alias("b"), F.max("northing").alias("t")).first()
        if b.l is None:
            return pixels.select(F.lit(0).cast("long").alias("col"), F.lit(0).cast("long").alias("row"), *bands).where("false")
        left, top = math.floor(b.l / res) * res, math.ceil(b.t / res) * res
        grid = left, top, math.ceil((b.r - left) / res), math.ceil((top - b.b) / res)
    left, top, width, height = grid
    cells = pixels.sparkSession.range(width * height).select((F.col("id") % width).alias("col"), F.expr(f"id div {width}").alias("row"))
    placed = cells.select("col", "row", *from_utm(left + (F.col("col") + 0.5) * res, top - (F.col("row") + 0.5) * res, zone))
    at = placed.select("col", "row", ((F.col("lon") - x0) / step).alias("u"), ((y0 - F.col("lat")) / step).alias("v"))
    taps = TAPS[method]

    def around(c: str) -> Column:
        first = F.floor(c) if taps == 1 else F.floor(F.col(c) - 0.5) - (taps // 2 - 1)
        return F.explode(F.transform(F.sequence(first, first + taps - 1), lambda i: F.struct(i.alias("i"), _weight(method, F.col(c) - 0.5 - i).alias("w"), (i == F.floor(c)).alias("own"))))

    wide = at.select("col", "row", "v", around("u").alias("a")).select("col", "row", "a", around("v").alias("b"))
    taken = wide.select("col", "row", F.col("a.i").alias("x"), F.col("b.i").alias("y"), (F.col("a.w") * F.col("b.w")).alias("w"), (F.col("a.own") & F.col("b.own")).alias("own"))
    valid = pixels.where(F.greatest(*bands, F.lit(0)) > 0).select("x", "y", *bands)
    mean = lambda c: F.greatest(F.lit(0), F.least(F.lit(65535), F.rint(F.sum(F.col("w") * F.col(c)) / F.sum("w")))).cast("long").alias(c)
    return taken.join(valid, ["x", "y"]).groupBy("col", "row").agg(F.max("own").alias("own"), *map(mean, bands)).where("own").drop("own")


def ensure_same_crs(pixels: DataFrame, bands: list[str], target: str, crs: dict[int, str], origin: tuple[float, float], step: float, zone: int, res: float) -> DataFrame:
    """scene_id, x, y and bands: scenes in the target's system as they are, geographic ones (EPSG:4674) reprojected
    bilinearly, each to its own default grid of the target's zone."""
    if unknown := {c for c in crs.values() if c not in (target, "EPSG:4674")}:
        raise ValueError(f"no projection from {sorted(unknown)}")
    other = sorted(s for s, c in crs.items() if c != target)
    out = pixels.where(~F.col("scene_id").isin(other)).select("scene_id", "x", "y", *bands)
    for s in other:
        moved = reproject(pixels.where(F.col("scene_id") == s), bands, origin, step, zone, res, method="bilinear")
        out = out.unionByName(moved.select(F.lit(s).cast("long").alias("scene_id"), F.col("col").alias("x"), F.col("row").alias("y"), *bands))
    return out
