"""Scene catalogues: search, selection, band files, and the status of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.functions import text
from terrazzo.operators import spatial

COLLECTION = "CBERS4A_WPM_L4_DN"
BAND_NUMBERS = {"pan": 0, "blue": 1, "green": 2, "red": 3}
SIZE10 = 5  # side of a footprint, tenths of a degree


def bounds_meet(west: float, south: float, east: float, north: float) -> Column:
    """Footprints that share more than an edge with a box; whole tenths of degrees keep the comparison exact."""
    return (F.col("minx10") < east * 10) & (F.col("minx10") + SIZE10 > west * 10) & (F.col("miny10") < north * 10) & (F.col("miny10") + SIZE10 > south * 10)


def search(scenes: DataFrame, bbox: tuple[float, float, float, float], start: str, end: str, most_cloud: int, limit: int) -> DataFrame:
    """The clearest scenes of a box and period (bounds included); ties by date, then event."""
    day = F.col("datetime").cast("date")
    found = scenes.where(bounds_meet(*bbox) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("cloud_cover") <= most_cloud))
    return found.orderBy("cloud_cover", "datetime", "event_id").limit(limit)


def stac_search(scenes: DataFrame, bbox: tuple[float, float, float, float], period: str) -> DataFrame:
    start, end = (F.lit(p).cast("date") for p in period.split("/"))
    return scenes.where(bounds_meet(*bbox) & F.col("datetime").cast("date").between(start, end))


def best_scene(scenes: DataFrame) -> DataFrame:
    """One scene for each path and row: the least cloud (null last), then the earliest, then the smallest event."""
    w = Window.partitionBy("path", "row_no").orderBy(F.asc_nulls_last("cloud_cover"), "datetime", "event_id")
    return scenes.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def best_scene_ties(scenes: DataFrame) -> DataFrame:
    """All scenes of least cloud, and among them of the earliest time, for each path and row; null keys or cloud drop out."""
    w = Window.partitionBy("path", "row_no").orderBy("cloud_cover", "datetime")
    kept = scenes.where("path is not null and row_no is not null and cloud_cover is not null")
    return kept.withColumn("rank", F.rank().over(w)).where("rank = 1").drop("rank")


def within_area(scenes: DataFrame, areas: DataFrame, cell: int = 50) -> DataFrame:
    """Scenes whose footprint meets any area (left, bottom, right, top in tenths): boxes are dealt into grid cells, cells
    joined by equality, candidates tested exactly; a semi join, so no scene comes twice."""
    tiles = lambda a, b, c, d: F.explode(F.expr(f"flatten(transform(sequence(floor({a} / {cell}), floor({c} / {cell})), i -> transform(sequence(floor({b} / {cell}), floor({d} / {cell})), j -> struct(i, j))))"))
    s = scenes.select("event_id", "minx10", "miny10", tiles("minx10", "miny10", f"(minx10 + {SIZE10})", f"(miny10 + {SIZE10})").alias("cell"))
    a = areas.select("left", "bottom", "right", "top", tiles("left", "bottom", "right", "top").alias("cell"))
    hit = s.join(a, "cell").where((F.col("minx10") < F.col("right")) & (F.col("minx10") + SIZE10 > F.col("left")) & (F.col("miny10") < F.col("top")) & (F.col("miny10") + SIZE10 > F.col("bottom")))
    return scenes.join(hit.select("event_id"), "event_id", "left_semi")


def within_polygons(scenes: DataFrame, edges: DataFrame, cell: int = 50) -> DataFrame:
    """Scenes whose footprint shares area with any polygon (edges: polygon, x1, y1, x2, y2 in tenths of degrees): boxes of
    the polygons find candidates by grid cells, which are tested exactly against the edges; a semi join."""
    shapes = edges.groupBy("polygon").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"), *(f(g(f"{c}1", f"{c}2")).alias(f"{c}_{n}") for c in "xy" for n, f, g in (("low", F.min, F.least), ("high", F.max, F.greatest))))
    tiles = lambda a, b, c, d: F.explode(F.expr(f"flatten(transform(sequence(floor({a} / {cell}), floor({c} / {cell})), i -> transform(sequence(floor({b} / {cell}), floor({d} / {cell})), j -> struct(i, j))))"))
    s = scenes.select("event_id", "minx10", "miny10", tiles("minx10", "miny10", f"(minx10 + {SIZE10})", f"(miny10 + {SIZE10})").alias("cell"))
    p = shapes.select("edges", tiles("x_low", "y_low", "x_high", "y_high").alias("cell"))
    hit = s.join(p, "cell").where(spatial.box_meets(F.col("edges"), F.col("minx10"), F.col("miny10"), F.col("minx10") + SIZE10, F.col("miny10") + SIZE10))
    return scenes.join(hit.select("event_id"), "event_id", "left_semi")


def band_files(listing: DataFrame) -> DataFrame:
    """The first valid file of each scene and band: preferred places first, then by path. listing: id, band, path, priority,
    length."""
    w = Window.partitionBy("id", "band").orderBy("priority", "path")
    return listing.where("length > 0").withColumn("rank", F.row_number().over(w)).where("rank = 1").select("id", "band", "path")


def required(ids: DataFrame, bands: tuple[str, ...] = ("red", "green", "blue", "pan")) -> DataFrame:
    return ids.select("id").distinct().select("id", F.explode(F.array(*map(F.lit, bands))).alias("band"))


def missing_bands(ids: DataFrame, files: DataFrame) -> DataFrame:
    return required(ids).join(files, ["id", "band"], "left_anti")


def band_path(scene_id: Column, band: Column, folder: str) -> Column:
    """Where a scene's band is stored: folder/id/prefix_L4_BANDn.tif."""
    number = F.coalesce(*(F.when(band == name, F.lit(n)) for name, n in BAND_NUMBERS.items()))
    return F.concat(F.lit(f"{folder}/"), scene_id, F.lit("/"), text.band_prefix(scene_id), F.lit("_L4_BAND"), number.cast("string"), F.lit(".tif"))


def batch_status(ids: DataFrame, files: DataFrame, products: DataFrame, dry_run: bool = False) -> DataFrame:
    """The batch report: a row for each scene with its files (empty where missing) and its final state."""
    wide = files.groupBy("id").agg(*(F.max(F.when(F.col("band") == b, F.col("path"))).alias(b) for b in ("red", "green", "blue", "pan")))
    have = products.groupBy("id").agg(*(F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in ("rgb", "pansharp")))
    r = ids.select("id").distinct().join(wide, "id", "left").join(have, "id", "left")
    made = F.concat(F.lit("out/TRUE_COLOR_"), F.col("id"), F.lit(".tif"))
    rgb = F.coalesce("rgb", F.when(F.col("red").isNotNull() & F.col("green").isNotNull() & F.col("blue").isNotNull(), made))
    state = F.when(F.col("pansharp").isNotNull(), "pansharp_existente").when(rgb.isNull() | F.col("pan").isNull(), "sem_pansharp_por_falta_de_rgb_ou_pan").when(F.lit(dry_run), "dry_run_criaria_pansharp").otherwise("pansharp_criado")
    sharp = F.coalesce("pansharp", F.when(rgb.isNotNull() & F.col("pan").isNotNull() & F.lit(not dry_run), F.concat(F.lit("out/PANSHARP_"), F.col("id"), F.lit(".tif"))))
    empty = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return r.select(F.col("id").alias("scene_id"), *(empty(F.col(b), b) for b in ("red", "green", "blue", "pan")), empty(rgb, "rgb"), empty(sharp, "pansharp"), state.alias("status"))
