"""GeoTIFF codec, source and sink."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import DATA

from terrazzo.sources import raster, views


@pytest.mark.parametrize("how", [raster.NONE, raster.LZW, raster.DEFLATE])
@pytest.mark.parametrize("kind", ["uint8", "uint16", "int16", "float32"])
def test_codec(how, kind):
    r = np.random.default_rng(3)
    data = (r.integers(0, 40, (3, 70, 101)) * (r.random((3, 70, 101)) > 0.3)).astype(kind)
    own = raster.Raster(data, 300000.0, 7800000.0, 8.0, 8.0, 31983, 0.0)
    packed = raster.encode(own, how, block=64)
    back = raster.decode(packed)
    assert (back.data == data).all() and (back.left, back.top, back.res_x, back.epsg, back.nodata) == (300000.0, 7800000.0, 8.0, 31983, 0.0)
    part = raster.decode(packed, (60, 5, 30, 40))
    assert (part.data == data[:, 5:45, 60:90]).all() and part.left == 300000.0 + 480 and part.top == 7800000.0 - 40
    assert (raster.decode(packed, step=4).data == data[:, ::4, ::4]).all()


def test_lzw():
    r = random.Random(1)
    for n in (0, 1, 2, 255, 5000, 40_000):
        for of in (b"a", b"ab", bytes(range(256))):
            data = bytes(r.choice(of) for _ in range(n))
            assert raster.lzw_unpack(raster.lzw_pack(data)) == data


def test_broken_files():
    good = raster.encode(raster.Raster(np.ones((1, 20, 20), np.uint16)), block=16)
    for bad in (b"", b"II*\0", good[:30], good[: len(good) // 2], b"XX" + good[2:]):
        with pytest.raises(ValueError, match="TIFF"):
            raster.decode(bad)


def test_files(spark, tmp_path):
    data = np.arange(3 * 30 * 50, dtype=np.uint16).reshape(3, 30, 50)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.tif").write_bytes(raster.encode(raster.Raster(data, epsg=4674), raster.LZW, 16))
    (tmp_path / "b.tif").write_bytes(b"broken")
    (tmp_path / "c.txt").write_text("no raster")
    found = raster.files(spark, str(tmp_path))
    heads = {x.path.rsplit("/", 1)[1]: (x.width, x.height, x.bands, x.epsg, x.valid) for x in raster.headers(found).collect()}
    assert heads == {"a.tif": (50, 30, 3, 4674, True), "b.tif": (None, None, None, None, False)}
    got = raster.pixels(found.where("path like '%a.tif'"), 3, (10, 5, 20, 10)).collect()
    assert sorted((x.x, x.y, x.b1, x.b2, x.b3) for x in got) == sorted((x, y, *map(int, data[:, 5 + y, 10 + x])) for x in range(20) for y in range(10))


@pytest.mark.parametrize(("side", "block"), [(16, 16), (20, 32), (600, 512)])
def test_small_tiles_have_small_blocks(spark, side, block):
    """Small tiles were packed as whole blocks of 512 x 512 pixels."""
    own = spark.createDataFrame([(1, x, y, 7 * x + y) for x in (0, 3, 19, 45) for y in (0, 18, 40)], "scene_id bigint, x bigint, y bigint, b1 bigint")
    made = raster.tiles(own, ["scene_id"], ["b1"], side=side, compression=raster.NONE).collect()
    got = set()
    for t in made:
        _, tags = raster.directory(bytes(t.content))
        assert (tags[raster.WIDTH], tags[raster.TILE_W], tags[raster.TILE_H]) == ([side], [block], [block])
        data = raster.decode(bytes(t.content)).data[0]
        got |= {(int(x) + side * t.tile_x, int(y) + side * t.tile_y, int(data[y, x])) for y, x in zip(*data.nonzero(), strict=True)}
    assert got == {(r.x, r.y, r.b1) for r in own.collect() if r.b1}


def test_saved_tables_open_only_their_tiles(spark, tmp_path):
    own = views.px(spark, DATA)
    raster.save(own, str(tmp_path / "t"), ["scene_id"], side=16)
    got = raster.windowed(spark, str(tmp_path / "t"), (4, 20, 10, 8), side=16)
    want = own.where("x between 4 and 13 and y between 20 and 27")
    assert sorted(map(tuple, got.select(*own.columns).collect())) == sorted(map(tuple, want.collect()))
    assert "PartitionFilters: [isnotnull(tile_y" in got._jdf.queryExecution().executedPlan().toString()
