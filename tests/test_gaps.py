"""Clip arguments, states, GeoJSON of every type, layout, validation."""

from __future__ import annotations

import json

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from terrazzo.functions import text
from terrazzo.operators import spatial
from terrazzo.plans.mosaic import mosaic_scenes
from terrazzo.sources import ingest, views

RING = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
SHAPES = {
    "Point": [1, 2], "MultiPoint": [[1, 2], [3, 4]], "LineString": [[0, 0], [1, 1]], "MultiLineString": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]],
    "Polygon": [RING], "MultiPolygon": [[RING], [RING]],
}


def test_geojson_of_every_type(spark, tmp_path):
    rows = [(k, 1, json.dumps({"type": k, "coordinates": v})) for k, v in SHAPES.items()] + [("none", 2, None), ('a"b', None, json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}]}))]
    ingest.write_geojson(spark.createDataFrame(rows, "id string, cloud int, geometry string"), str(tmp_path / "g"))
    got = [json.loads(line) for p in (tmp_path / "g").glob("part-*") for line in p.read_text().splitlines()]
    assert {g["id"]: g["geometry"] for g in got} == {i: g and json.loads(g) for i, _, g in rows}
    assert all(g["type"] == "Feature" and g["properties"] == ({} if g["id"] == 'a"b' else {"cloud": 1 + (g["id"] == "none")}) for g in got)


def test_edges_know_their_polygons(spark):
    value = {"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": [RING]}, {"type": "MultiPolygon", "coordinates": [[RING], [RING]]}, {"type": "Point", "coordinates": [1, 1]}]}
    assert {(r.polygon, r.n) for r in ingest.polygon_edges(spark, value).groupBy("polygon").agg(F.count("*").alias("n")).collect()} == {(0, 4), (1, 4), (2, 4)}
    pixels = spark.createDataFrame([(x, y) for x in range(6) for y in range(6)], "x bigint, y bigint")
    assert spatial.inside(pixels, ingest.polygon_edges(spark, value)).count() == 16  # a union: twice covered is covered


def test_states_and_clip_arguments(spark, tmp_path):
    (tmp_path / "contorno_sao_paulo.geojson").write_text(json.dumps({"type": "Polygon", "coordinates": [RING]}))
    (tmp_path / "contorno_32.geojson").write_text(json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": [0, 0]}}))
    folder = str(tmp_path)
    assert [ingest.state_code(s) for s in (" São Paulo", "es", 32, "032", "Espírito Santo")] == ["35", "32", "32", "32", "32"]
    assert ingest.state_files("ES", folder) == [f"{folder}/contorno_es.geojson", f"{folder}/contorno_32.geojson"]
    assert ingest.clip_area(state="São Paulo", folder=folder)[0]["type"] == "Polygon" and ingest.clip_area("ES", folder=folder)[0]["type"] == "Point"
    assert ingest.clip_area() is None and ingest.clip_area({"type": "Polygon", "coordinates": [RING]}) == [{"type": "Polygon", "coordinates": [RING]}]
    assert ingest.clip_area(f"{folder}/contorno_32.geojson")[0]["type"] == "Point"
    with pytest.raises(ValueError, match="not to both"):
        ingest.clip_area({}, "ES")
    with pytest.raises(ValueError, match="no such state"):
        ingest.clip_area("nowhere", folder=folder)
    with pytest.raises(FileNotFoundError):
        ingest.clip_area(state="AC", folder=folder)
    with pytest.raises(Exception, match="no such state"):
        ingest.normalise_state(spark.createDataFrame([("nowhere",)], "wanted string"), ingest.state_lookup(spark), strict=True).collect()


def test_texts(spark):
    df = spark.createDataFrame([(" ÁÉÎõüÇñ Ǎ ṩ é ", "x/CBERS_4A_WPM_20200101_195_138_L4_BAND3.tif")], "a string, b string")
    assert df.select(text.plain(F.col("a")), text.band_base(F.col("b"))).first()[:] == ("aeioucn a s e", "x/CBERS_4A_WPM_20200101_195_138_L4")
    assert ingest.batch_layout("/d", 0) == {"rgb": "/d/rgb", "pansharp": "/d/pansharp", "report": "/d/report.csv", "chunk": 1 << 20}


def test_mosaic_refuses(spark):
    own = views.px(spark, DATA)
    for kw, df in (({}, own.where("false")), ({"reference": 77}, own), ({"method": "median"}, own), ({"color_target": "x"}, own)):
        with pytest.raises(ValueError):
            mosaic_scenes(df, **kw)


def test_versions():
    import terrazzo

    assert set(terrazzo.versions()) == {"terrazzo", "pyspark", "pyarrow", "numpy", "pandas"} and all(terrazzo.versions().values())
