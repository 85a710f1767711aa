"""Invariants, guards and NumPy oracles of the raster operators."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from terrazzo.functions import text
from terrazzo.operators import merge, radiometry, spatial, stencil
from terrazzo.plans.mosaic import mosaic_scenes
from terrazzo.sources import ingest, views
from terrazzo.streaming import ingest as stream


def grid(spark, values, scene=0):
    return spark.createDataFrame([(scene, x, y, int(v)) for (y, x), v in np.ndenumerate(np.asarray(values))], "scene_id bigint, x bigint, y bigint, dn bigint")


def test_identity_gain_changes_nothing(spark):
    own = views.px(spark, DATA).where(F.least("b1", "b2", "b3") > 0)
    gains = own.select("scene_id").distinct().select("scene_id", *(F.lit(1.0).alias(f"gain_b{i}") for i in (1, 2, 3)), F.lit(0.0).alias("offset"))
    assert radiometry.applied(own, gains).exceptAll(own).isEmpty()


def test_mean_of_one_scene_is_the_scene(spark):
    one = views.px(spark, DATA).where("scene_id = 1 and least(b1, b2, b3) > 0")
    assert merge.merge(one).select("x", "y", "b1", "b2", "b3").exceptAll(one.select("x", "y", "b1", "b2", "b3")).isEmpty()


def test_merges_are_ordered(spark):
    good = views.px(spark, DATA).where("least(b1, b2, b3) > 0")
    m = {k: merge.merge(good, k).select("x", "y", F.col("b1").alias(k)) for k in ("min", "mean", "max")}
    joined = m["min"].join(m["mean"], ["x", "y"]).join(m["max"], ["x", "y"])
    assert joined.where("not (min <= mean and mean <= max)").isEmpty()


def test_guards(spark):
    px = views.px(spark, DATA)
    with pytest.raises(ValueError):
        merge.merge(px, "median")
    with pytest.raises(ValueError):
        mosaic_scenes(px, color_target="brightest")
    with pytest.raises(ValueError):
        spatial.clip(px, spark.createDataFrame([(0, 9e5, 9e5, 9e5 + 4, 9e5 + 9), (0, 9e5 + 4, 9e5 + 9, 9e5, 9e5)], "ring bigint, x1 double, y1 double, x2 double, y2 double"))
    with pytest.raises(ValueError):
        ingest.geometries({"type": "Nothing"})
    with pytest.raises(Exception, match="not a scene id"):
        spark.range(1).select(text.strict_scene_part(F.lit("LANDSAT"), 1)).collect()


def test_median_fill_against_numpy(spark):
    rng = random.Random(3)
    a = np.array([[rng.choice([0, 0, 1, 5, 9, 20]) for _ in range(7)] for _ in range(6)])
    p = np.pad(a, 1, mode="symmetric")
    want = np.array([[a[y, x] or np.median(p[y : y + 3, x : x + 3]) for x in range(7)] for y in range(6)])
    got = np.zeros_like(a)
    for r in stencil.median_fill(grid(spark, a), 7, 6).collect():
        got[r.y, r.x] = r.dn
    assert (got == want).all()


@pytest.mark.parametrize("deviation", [1.0, 2.0])
def test_gaussian_against_numpy(spark, deviation):
    a = np.random.default_rng(2).integers(0, 99, (19, 23)).astype(float)
    k = np.array(stencil.kernel(deviation))
    r = len(k) // 2
    p = np.pad(a, r, mode="symmetric")
    want = np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), 0, np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), 1, p))
    got = np.zeros_like(a)
    for row in stencil.gaussian(grid(spark, a).select("x", "y", F.col("dn").cast("double").alias("v")), deviation, 23, 19).collect():
        got[row.y, row.x] = row.v
    assert np.allclose(got, want)


def test_projection_round_trip_and_equator(spark):
    df = spark.createDataFrame([(-41.8, -21.3), (-39.7, -17.9), (-39.0, -0.001)], "lon double, lat double")
    m = df.select("lon", "lat", *spatial.to_utm(F.col("lon"), F.col("lat"), 24))
    for r in m.select("lon", "lat", F.struct(*spatial.from_utm(F.col("easting"), F.col("northing"), 24)).alias("b"), "easting").collect():
        assert abs(r.lon - r.b.lon) < 1e-8 and abs(r.lat - r.b.lat) < 1e-8
    central = spark.range(1).select(*spatial.to_utm(F.lit(-39.0), F.lit(0.0), 24)).first()
    assert abs(central.easting - 500000) < 1e-6 and abs(central.northing - 10000000) < 1e-6


def ramp(spark, n=12):
    return spark.createDataFrame([(s, x, y, 100 + 40 * x + 7 * y, 900 - 20 * x) for s in (0, 1) for x in range(n) for y in range(n)], "scene_id bigint, x bigint, y bigint, b1 bigint, b2 bigint")


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic"])
def test_reprojection_fills_its_grid(spark, method):
    """A ramp stays a ramp in all bands, and no cell inside the footprint is missing."""
    one = ramp(spark).where("scene_id = 0")
    corner = spark.range(1).select(*spatial.to_utm(F.lit(-40.0 + 3e-4), F.lit(-20.0 - 3e-4), 24)).first()
    grid = corner.easting, corner.northing, 7, 6
    cells = spatial.reproject(one, ["b1", "b2"], (-40.0, -20.0), 1e-4, 24, 8.0, grid, method)
    back = cells.select("*", *spatial.from_utm(grid[0] + (F.col("col") + 0.5) * 8, grid[1] - (F.col("row") + 0.5) * 8, 24)).collect()
    assert sorted((r.col, r.row) for r in back) == [(c, r) for c in range(7) for r in range(6)]
    for r in back:
        u, v = (r.lon + 40) / 1e-4, (-20 - r.lat) / 1e-4
        u, v = (np.floor(u), np.floor(v)) if method == "nearest" else (u - 0.5, v - 0.5)
        assert abs(r.b1 - (100 + 40 * u + 7 * v)) <= 0.51 and abs(r.b2 - (900 - 20 * u)) <= 0.51
    assert spatial.reproject(one, ["b1"], (-40.0, -20.0), 1e-4, 24, 8.0, None, method).count() > 1.3 * one.count()


def test_scenes_of_another_system_are_reprojected(spark):
    both = ramp(spark)
    args = ["b1", "b2"], "EPSG:31984", {0: "EPSG:31984", 1: "EPSG:4674"}, (-40.0, -20.0), 1e-4, 24, 8.0
    out = spatial.ensure_same_crs(both, *args)
    assert out.where("scene_id = 0").exceptAll(both.where("scene_id = 0")).isEmpty() and out.where("scene_id = 0").count() == 144
    want = spatial.reproject(both.where("scene_id = 1"), ["b1", "b2"], (-40.0, -20.0), 1e-4, 24, 8.0, method="bilinear")
    assert out.where("scene_id = 1").select("x", "y", "b1", "b2").exceptAll(want).isEmpty() and want.count() > 144
    with pytest.raises(ValueError):
        spatial.ensure_same_crs(both, args[0], args[1], {0: "EPSG:3857"}, *args[3:])


def test_overlap_tree_moves_scenes_together(spark):
    px = views.px(spark, DATA)
    out = radiometry.match_by_overlap(px, 0, [0, 1], least=300)
    both = lambda df: radiometry.overlap_pairs(df, 0).where("b = 1").agg(F.abs(F.avg("a1") - F.avg("b1"))).first()[0]
    assert both(out) < both(px.where("scene_id < 2"))


def test_geojson_and_report(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    value = [{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[ring]]}}]}]
    edges = ingest.polygon_edges(spark, value)
    assert edges.count() == 4
    assert spatial.inside(grid(spark, np.ones((6, 6))), edges).count() == 16
    f = spark.createDataFrame([("a", 7, '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,1],[0,0]]]}')], "id string, cloud int, geometry string")
    ingest.write_geojson(f, str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g")).first().properties.cloud == 7
    ingest.write_report(spark.createDataFrame([("x", None)], "scene_id string, rgb string"), str(tmp_path / "r"))
    assert "".join(p.read_text() for p in (tmp_path / "r").glob("*.csv")).split() == ["scene_id,rgb", "x,"]


def test_tiff_header():
    entries = [(256, 4, 1, 3), (257, 4, 1, 2), (258, 3, 1, 8), (273, 4, 1, 86), (279, 4, 1, 6), (277, 3, 1, 1)]
    body = struct.pack("<2sHIH", b"II", 42, 8, len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + struct.pack("<I", 0)
    data = body + bytes(86 - len(body)) + bytes(6)
    assert ingest.tiff_header(data) == ingest.TiffHeader(3, 2, 1, 8, 1)
    assert ingest.tiff_header(data[:-1]) is None and ingest.tiff_header(b"") is None and ingest.tiff_header(b"PK" + data) is None


def test_scene_stream(spark, tmp_path):
    rows = views.scenes(spark, DATA).select("event_id", "id", "path", "row_no", F.col("datetime").cast("timestamp").alias("datetime"), "cloud_cover")
    rows.unionByName(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = stream.best_so_far(stream.arriving(spark, str(tmp_path / "in"), "9999 days")).writeStream.format("memory").queryName("best").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("best").agg(F.count("*"), F.sum("event_id")).first()[:] == (15, 6028)  # FIXTURES.md, 4
