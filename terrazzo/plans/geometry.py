"""Queries of bounds, grids, polygons and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.operators import spatial, stencil
from terrazzo.plans.mosaic import mosaic_scenes
from terrazzo.registry import query
from terrazzo.sources import raster
from terrazzo.sources.views import aoi_edges, px, scenes, with_views

INSIDE = "(select count(*) from aoi_edges e where (y1 > y + 0.5::double) <> (y2 > y + 0.5::double) and x + 0.5::double < (x2 - x1) * (y + 0.5::double - y1) / (y2 - y1) + x1) % 2 = 1"


@query(with_views(f"select x, y, b1, b2, b3 from px where scene_id = 0 and {INSIDE}", "px", "aoi_edges"))
def clip_polygon(spark: SparkSession, d: str) -> DataFrame:
    return spatial.inside(px(spark, d).where("scene_id = 0"), aoi_edges(spark)).drop("scene_id")


_PARTS = "(values (0, 10, 10, 40, 12), (0, 40, 12, 38, 44), (0, 38, 44, 12, 40), (0, 12, 40, 10, 10), (1, 30, 30, 58, 26), (1, 58, 26, 50, 60), (1, 50, 60, 30, 30)) t(polygon, a, b, c, d)"
PARTS = {"parts": f"select polygon, a::double as x1, b::double as y1, c::double as x2, d::double as y2 from {_PARTS}"}


def parts(spark: SparkSession) -> DataFrame:
    """Two polygons that overlap."""
    return spark.sql(f"select cast(polygon as bigint) as polygon, double(a) as x1, double(b) as y1, double(c) as x2, double(d) as y2 from {_PARTS}")


@query(with_views("select scene_id, x, y, b1 from px where exists (select 1 from parts e where (y1 > y + 0.5::double) <> (y2 > y + 0.5::double) and x + 0.5::double < (x2 - x1) * (y + 0.5::double - y1) / (y2 - y1) + x1 group by polygon having count(*) % 2 = 1)", "px", more=PARTS))
def polygon_union(spark: SparkSession, d: str) -> DataFrame:
    return spatial.inside(px(spark, d), parts(spark)).select("scene_id", "x", "y", "b1")


@query(with_views("select scene_id, x, y, b1, b2, b3 from px where greatest(b1, b2, b3) > 0", "px"))
def geotiff_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pixels to GeoTIFF tiles and back."""
    tiles = raster.tiles(px(spark, d), ["scene_id"], ["b1", "b2", "b3"], side=32)
    named = tiles.select(F.concat_ws("/", "scene_id", "tile_x", "tile_y").alias("path"), "content")
    part = lambda k: F.split_part("path", F.lit("/"), F.lit(k)).cast("long")
    return raster.pixels(named, 3).where("greatest(b1, b2, b3) > 0").select(part(1).alias("scene_id"), (F.col("x") + 32 * part(2)).alias("x"), (F.col("y") + 32 * part(3)).alias("y"), "b1", "b2", "b3")


@query(with_views("select scene_id, x // 16 as tile_x, y // 16 as tile_y, 16::bigint as width, 16::bigint as height, 3::bigint as bands, 31983::bigint as epsg, (scene_id + x // 16) % 2 = 0 as valid from px group by all", "px"))
def raster_headers(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and validity of files, every other one cut short."""
    tiles = raster.tiles(px(spark, d), ["scene_id"], ["b1", "b2", "b3"], side=16, epsg=31983, compression=raster.LZW)
    whole = F.expr("(scene_id + tile_x) % 2 = 0")
    at = raster.headers(tiles.select(F.concat_ws("/", "scene_id", "tile_x", "tile_y", whole.cast("string")).alias("path"), F.when(whole, F.col("content")).otherwise(F.expr("substring(content, 1, 40)")).alias("content")))
    part = lambda k: F.split_part("path", F.lit("/"), F.lit(k)).cast("long")
    fixed = {"width": 16, "height": 16, "bands": 3, "epsg": 31983}
    return at.select(part(1).alias("scene_id"), part(2).alias("tile_x"), part(3).alias("tile_y"), *(F.when(F.col("valid"), F.col(c)).otherwise(v).alias(c) for c, v in fixed.items()), "valid")


@query(with_views("select x - 4 as x, y - 4 as y, " + ", ".join(f"least(1023, trunc(sum({b}) / count(*)))::bigint as {b}" for b in ("b1", "b2", "b3")) + f" from px where least(b1, b2, b3) > 0 and {INSIDE} group by x, y", "px", "aoi_edges"))
def mosaic_clipped(spark: SparkSession, d: str) -> DataFrame:
    return mosaic_scenes(px(spark, d), match_colors=False, clip_to=aoi_edges(spark))


@query(with_views("select ring, min(least(x1, x2)) as left_, min(least(y1, y2)) as top_, max(greatest(x1, x2)) as right_, max(greatest(y1, y2)) as bottom_ from aoi_edges group by ring", "aoi_edges"))
def aoi_bounds(spark: SparkSession, d: str) -> DataFrame:
    return aoi_edges(spark).groupBy("ring").agg(F.min(F.least("x1", "x2")).alias("left_"), F.min(F.least("y1", "y2")).alias("top_"), F.max(F.greatest("x1", "x2")).alias("right_"), F.max(F.greatest("y1", "y2")).alias("bottom_"))


BOUNDS = {"bd": 'select scene_id, min(x)::double as "left", (-max(y + 1))::double as bottom, max(x + 1)::double as "right", (-min(y))::double as top from px group by 1'}


def bounds(spark: SparkSession, d: str) -> DataFrame:
    """Of each scene; y grows downwards in rasters and upwards in maps."""
    return px(spark, d).groupBy("scene_id").agg(F.min("x").cast("double").alias("left"), (-F.max(F.col("y") + 1)).cast("double").alias("bottom"), F.max(F.col("x") + 1).cast("double").alias("right"), (-F.min("y")).cast("double").alias("top"))


@query(with_views('select a.scene_id as a, b.scene_id as b, greatest(a."left", b."left") as left_, greatest(a.bottom, b.bottom) as bottom_, least(a."right", b."right") as right_, least(a.top, b.top) as top_ from bd a join bd b on a.scene_id < b.scene_id where greatest(a."left", b."left") < least(a."right", b."right") and greatest(a.bottom, b.bottom) < least(a.top, b.top)', "px", more=BOUNDS))
def bounds_intersection(spark: SparkSession, d: str) -> DataFrame:
    """Scenes are few: a row each, so all pairs of bounds are compared."""
    one = bounds(spark, d)
    a, b = (one.select(F.col("scene_id").alias(s), F.struct("left", "bottom", "right", "top").alias(f"s{s}")) for s in "ab")
    cells = lambda s: F.explode(F.sequence(F.floor(F.col(f"s{s}.left") / 1024), F.floor(F.col(f"s{s}.right") / 1024))).alias("cell")
    met = a.select("*", cells("a")).join(b.select("*", cells("b")), "cell").where("a < b").where(spatial.overlapping("sa", "sb")).dropDuplicates(["a", "b"])
    return met.select("a", "b", *(c.alias(n) for c, n in zip(spatial.intersection("sa", "sb"), ("left_", "bottom_", "right_", "top_"), strict=True)))


@query(with_views('select max("left") as left_, max(bottom) as bottom_, min("right") as right_, min(top) as top_, greatest(0, round_even(max("left"), 0))::bigint as col_off, greatest(0, round_even(-min(top), 0))::bigint as row_off from bd', "px", more=BOUNDS))
def intersection_window(spark: SparkSession, d: str) -> DataFrame:
    one = bounds(spark, d).agg(F.max("left").alias("left_"), F.max("bottom").alias("bottom_"), F.min("right").alias("right_"), F.min("top").alias("top_"))
    return one.select("*", F.greatest(F.lit(0).cast("long"), F.rint("left_").cast("long")).alias("col_off"), F.greatest(F.lit(0).cast("long"), F.rint(-F.col("top_")).cast("long")).alias("row_off"))


_FOOT = {"ft": "select event_id, path, minx10 / 10.0::double as \"left\", miny10 / 10.0::double as bottom, (minx10 + 5) / 10.0::double as \"right\", (miny10 + 5) / 10.0::double as top, 0.25::double * (1 + event_id % 2) as res_x, 0.25::double * (1 + event_id % 3) as res_y from scenes"}


def footprints(spark: SparkSession, d: str) -> DataFrame:
    return scenes(spark, d).select("event_id", "path", (F.col("minx10") / 10.0).alias("left"), (F.col("miny10") / 10.0).alias("bottom"), ((F.col("minx10") + 5) / 10.0).alias("right"), ((F.col("miny10") + 5) / 10.0).alias("top"), (0.25 * (1 + F.col("event_id") % 2)).alias("res_x"), (0.25 * (1 + F.col("event_id") % 3)).alias("res_y"))


@query(with_views('select floor(min("left") / min(res_x)) * min(res_x) as origin_left, ceil(max(top) / min(res_y)) * min(res_y) as origin_top, min(res_x) as res_x, min(res_y) as res_y from ft', "scenes", more=_FOOT))
def common_grid(spark: SparkSession, d: str) -> DataFrame:
    return spatial.common_grid(footprints(spark, d))


_GRID = {**_FOOT, "g": 'select event_id, -45.0::double + floor(("left" + 45) / 0.25::double) * 0.25::double as al, -45.0::double + ceil(("right" + 45) / 0.25::double) * 0.25::double as ar, -5.0::double - floor((-5.0::double - top) / 0.25::double) * 0.25::double as at_, -5.0::double - ceil((-5.0::double - bottom) / 0.25::double) * 0.25::double as ab from ft'}


@query(with_views('select event_id, round(al, 6) as "left", round(at_, 6) as top, greatest(1, round_even((ar - al) / 0.25::double, 0)::bigint) as width, greatest(1, round_even((at_ - ab) / 0.25::double, 0)::bigint) as height from g', "scenes", more=_GRID))
def aligned_grid(spark: SparkSession, d: str) -> DataFrame:
    f = footprints(spark, d)
    a = f.select("event_id", *spatial.aligned(F.col("left"), F.col("bottom"), F.col("right"), F.col("top"), F.lit(-45.0), F.lit(-5.0), F.lit(0.25), F.lit(0.25)))
    return a.select("event_id", F.round("left", 6).alias("left"), F.round("top", 6).alias("top"), "width", "height")


_WIN = {**_FOOT, "w0": 'select event_id, greatest(round_even(("left" + 41) / 0.25::double, 0)::bigint, 0) as c0, greatest(round_even((-17.0::double - top) / 0.25::double, 0)::bigint, 0) as r0, least(round_even(("right" + 41) / 0.25::double, 0)::bigint, 8) as c1, least(round_even((-17.0::double - bottom) / 0.25::double, 0)::bigint, 8) as r1 from ft'}


@query(with_views("select event_id, case when ok then c0 end as col_off, case when ok then r0 end as row_off, case when ok then c1 - c0 end as width, case when ok then r1 - r0 end as height from (select *, c0 < c1 and r0 < r1 as ok from w0)", "scenes", more=_WIN))
def window_of_bounds(spark: SparkSession, d: str) -> DataFrame:
    f = footprints(spark, d)
    return f.select("event_id", *spatial.window(F.col("left"), F.col("bottom"), F.col("right"), F.col("top"), -41.0, -17.0, 0.25, 8, 8))


@query(with_views("select scene_id, x, y, round(300000.0::double + (x + 0.5::double) * 8, 6) as map_x, round(7800000.0::double - (y + 0.5::double) * 8, 6) as map_y from px", "px"))
def pixel_to_map(spark: SparkSession, d: str) -> DataFrame:
    p = px(spark, d).select("scene_id", "x", "y", *spatial.to_map(F.col("x"), F.col("y"), 300000.0, 7800000.0, 8.0, 8.0))
    return p.select("scene_id", "x", "y", F.round("map_x", 6).alias("map_x"), F.round("map_y", 6).alias("map_y"))


@query(with_views('select event_id, round("left", 6) as lon, round(bottom, 6) as lat from ft', "scenes", more=_FOOT))
def reproject_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Corners to the map projection of their zone and back: the inverse has to undo the series."""
    f = footprints(spark, d).select("event_id", *spatial.to_utm(F.col("left"), F.col("bottom"), 24))
    back = f.select("event_id", *spatial.from_utm(F.col("easting"), F.col("northing"), 24))
    return back.select("event_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query()
def reproject_raster(spark: SparkSession, d: str) -> DataFrame:
    """Scene 0, as if on a geographic grid, on the map projection's 8 m grid (cubic, every cell mapped back)."""
    return spatial.reproject(px(spark, d).where("scene_id = 0"), ["b1", "b2", "b3"], (-40.0, -20.0), 1e-4, 24, 8.0)


@query(with_views("select scene_id, x, y, b1 from px", "px"))
def ensure_same_crs(spark: SparkSession, d: str) -> DataFrame:
    """All scenes share the target's system: the plan is the scan itself."""
    return spatial.ensure_same_crs(px(spark, d), ["b1"], "EPSG:31984", {}, (-40.0, -20.0), 1e-4, 24, 8.0)


TILES = "select i as tile, (i // 7) * 160 as row_off, (i % 7) * 160 as col_off, least(160, 777 - (i // 7) * 160) as height, least(160, 1000 - (i % 7) * 160) as width from range(35) t(i)"


@query(f"select tile::bigint as tile, row_off::bigint as row_off, col_off::bigint as col_off, height::bigint as height, width::bigint as width from ({TILES})")
def tile_index(spark: SparkSession, d: str) -> DataFrame:
    t = spark.sql(stencil.tiles(1000, 777, 160))
    return t.select(*(F.col(c).cast("long").alias(c) for c in t.columns))


@query(f"select tile::bigint as tile from ({TILES}) where tile % 4 = 0")
def tile_sample(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(stencil.tiles(1000, 777, 160)).where("tile % 4 = 0").select(F.col("tile").cast("long").alias("tile"))


@query("select round(greatest(abs(8.0::double / 2), abs(-8.0::double / -2)), 6) as ratio")
def resolution_ratio(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1).select(F.greatest(F.abs(F.lit(8.0) / 2), F.abs(F.lit(-8.0) / -2)).alias("ratio"))
