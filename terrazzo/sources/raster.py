"""GeoTIFF files: a codec on arrays, a source that reads files as pixels or headers, and a sink of tiles.

The codec knows classic and big TIFF, either byte order, strips and tiles, integer and float samples, band or pixel
interleaving, no compression, deflate and LZW, with or without the horizontal predictor. Files reach executors as binary
rows (any store that Spark reads), and tiles leave them as binary rows; nothing opens a path.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: TIFF tags, field types (code, bytes), compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR, TILE_W, TILE_H, TILES, TILE_BYTES, EXTRA, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 338, 339
SCALE, TIEPOINT, KEYS, NODATA = 33550, 33922, 34735, 42113
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
NONE, LZW, DEFLATE = 1, 5, 8
BLOCK = 512


@dataclass(frozen=True)
class Raster:
    """bands x height x width; the corner and size of a cell (map units), the projection's EPSG code, and no data."""

    data: np.ndarray
    left: float = 0.0
    top: float = 0.0
    res_x: float = 1.0
    res_y: float = 1.0
    epsg: int | None = None
    nodata: float | None = 0.0


def lzw_pack(data: bytes) -> bytes:
    """TIFF's variant: codes from 9 to 12 bits, highest bit first, the width growing one code early."""
    out, held, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width, at = 9, b""

    def put(code: int) -> None:
        nonlocal held, bits
        held = held << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    def code_of(s: bytes) -> int:
        return s[0] if len(s) == 1 else table[s]

    put(256)
    for byte in data:
        longer = at + bytes([byte])
        if len(longer) == 1 or longer in table:
            at = longer
            continue
        put(code_of(at))
        table[longer] = 258 + len(table)
        at = longer[-1:]
        size = 258 + len(table)
        if size == 4095:
            put(256)
            table.clear()
            width = 9
        elif size in (512, 1024, 2048):
            width += 1
    if at:
        put(code_of(at))
        if 258 + len(table) + 1 in (512, 1024, 2048):
            width += 1
    put(257)
    if bits:
        out.append(held << 8 - bits & 255)
    return bytes(out)


def lzw_unpack(data: bytes) -> bytes:
    out, table, width, last = [], [], 9, b""
    held = bits = 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not last:
            last = table[code]
        else:
            own = table[code] if code < len(table) else last + last[:1]
            table.append(last + own[:1])
            last = own
        out.append(last)
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


def encode(raster: Raster, compression: int = DEFLATE, block: int = BLOCK) -> bytes:
    """A tiled classic TIFF, pixel interleaved, with the horizontal predictor for integers."""
    bands, height, width = raster.data.shape
    kind = raster.data.dtype.newbyteorder("<")
    predictor = 2 if kind.kind in "iu" and compression != NONE else 1
    parts = []
    for y in range(0, max(1, height), block):
        for x in range(0, max(1, width), block):
            tile = np.zeros((block, block, bands), kind)
            own = raster.data[:, y : y + block, x : x + block]
            tile[: own.shape[1], : own.shape[2]] = own.transpose(1, 2, 0)
            if predictor == 2:
                tile[:, 1:] -= tile[:, :-1].copy()
            raw = tile.tobytes()
            parts.append({NONE: bytes, LZW: lzw_pack, DEFLATE: zlib.compress}[compression](raw))
    sample = {"u": 1, "i": 2, "f": 3}[kind.kind]
    offsets = np.cumsum([8, *map(len, parts)])[:-1].tolist()
    tags: list[tuple[int, int, list]] = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8 * kind.itemsize] * bands), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [2 if bands >= 3 else 1]),
        (SAMPLES, 3, [bands]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor]), (TILE_W, 3, [block]), (TILE_H, 3, [block]), (TILES, 4, offsets), (TILE_BYTES, 4, [len(p) for p in parts]),
        *([(EXTRA, 3, [0] * (bands - 3))] if bands > 3 else [(EXTRA, 3, [0])] if bands == 2 else []), (FORMAT, 3, [sample] * bands),
        (SCALE, 12, [raster.res_x, raster.res_y, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, raster.left, raster.top, 0.0]),
    ]
    if raster.epsg is not None:  # model type, pixel is area, and the code of a geographic or projected system
        geographic = 4000 <= raster.epsg < 5000
        tags.append((KEYS, 3, [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, raster.epsg]))
    if raster.nodata is not None:
        tags.append((NODATA, 2, [f"{raster.nodata:g}".encode() + b"\0"]))
    body = b"".join(parts)
    body += b"\0" * (len(body) % 2)
    directory, more = b"", b""
    first_free = 8 + len(body) + 2 + 12 * len(tags) + 4
    for tag, code, values in tags:
        raw = values[0] if code == 2 else struct.pack(f"<{len(values)}{TYPES[code][0]}", *values)
        count = len(raw) if code == 2 else len(values)
        if len(raw) <= 4:
            place = raw.ljust(4, b"\0")
        else:
            place = struct.pack("<I", first_free + len(more))
            more += raw + b"\0" * (len(raw) % 2)
        directory += struct.pack("<HHI", tag, code, count) + place
    if first_free + len(more) >= 1 << 32:
        raise ValueError("a raster of 4 GB and more has to be cut into tiles")
    return b"II*\0" + struct.pack("<I", 8 + len(body)) + body + struct.pack("<H", len(tags)) + directory + b"\0\0\0\0" + more


def directory(data: bytes) -> tuple[str, dict[int, list]]:
    """Byte order and tags of the first image; fails if the file is no TIFF or is cut short."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 16:
        raise ValueError("not a TIFF file")
    (magic,) = struct.unpack_from(order + "H", data, 2)
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    entry, number, room = (20, "Q", 8) if big else (12, "I", 4)
    try:
        (at,) = struct.unpack_from(order + number, data, 8 if big else 4)
        (count,) = struct.unpack_from(order + ("Q" if big else "H"), data, at)
        at += 8 if big else 2
        tags: dict[int, list] = {}
        for p in range(at, at + entry * count, entry):
            tag, code, n = struct.unpack_from(order + "HH" + number, data, p)
            if code not in TYPES:
                continue
            letter, size = TYPES[code]
            where = p + entry - room if size * n <= room else struct.unpack_from(order + number, data, p + entry - room)[0]
            if code == 2:
                tags[tag] = [data[where : where + n]]
            else:
                tags[tag] = list(struct.unpack_from(f"{order}{n * len(letter)}{letter[0]}", data, where))
    except struct.error as e:
        raise ValueError("a TIFF file that is cut short") from e
    return order, tags


def decode(data: bytes, window: tuple[int, int, int, int] | None = None, step: int = 1) -> Raster:
    """The whole raster, or a window (col_off, row_off, width, height) of it, every step-th pixel; blocks outside of the window
    are not unpacked."""
    order, tags = directory(data)
    one = lambda tag, other: tags.get(tag, [other])[0]
    width, height, bands, how = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(COMPRESSION, NONE)
    kind = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[one(FORMAT, 1)] }{one(BITS, 8) // 8}")
    tiled = TILES in tags
    bw, bh = (one(TILE_W, 0), one(TILE_H, 0)) if tiled else (width, min(height, one(ROWS, height)))
    offsets, counts = tags.get(TILES if tiled else STRIPS, []), tags.get(TILE_BYTES if tiled else STRIP_BYTES, [])
    apart = one(PLANAR, 1) == 2
    across, down = -(-width // bw), -(-height // bh)
    if not width or not height or len(offsets) != across * down * (bands if apart else 1) or len(counts) != len(offsets):
        raise ValueError("a TIFF file without its blocks")
    unpack = {NONE: bytes, LZW: lzw_unpack, DEFLATE: zlib.decompress, 32946: zlib.decompress}.get(how)
    if unpack is None:
        raise ValueError(f"compression {how} is not known")
    c0, r0, w, h = window or (0, 0, width, height)
    c1, r1 = min(width, c0 + w), min(height, r0 + h)
    c0, r0 = max(0, c0), max(0, r0)
    out = np.zeros((bands, max(0, r1 - r0), max(0, c1 - c0)), kind.newbyteorder("="))
    for plane in range(bands if apart else 1):
        for j in range(r0 // bh, -(-r1 // bh)):
            for i in range(c0 // bw, -(-c1 // bw)):
                k = (plane * down + j) * across + i
                if offsets[k] + counts[k] > len(data):
                    raise ValueError("a TIFF file that is cut short")
                per = 1 if apart else bands
                rows = bh if tiled else min(bh, height - j * bh)
                block = np.frombuffer(unpack(data[offsets[k] : offsets[k] + counts[k]]), kind, rows * bw * per).reshape(rows, bw, per)
                if one(PREDICTOR, 1) == 2:
                    block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
                y, x = j * bh, i * bw
                ya, yb, xa, xb = max(y, r0), min(y + rows, r1), max(x, c0), min(x + bw, c1)
                out[plane : plane + 1 if apart else None, ya - r0 : yb - r0, xa - c0 : xb - c0] = block[ya - y : yb - y, xa - x : xb - x].transpose(2, 0, 1)
    scale, tie = tags.get(SCALE, [1.0, 1.0]), tags.get(TIEPOINT, [0.0] * 6)
    keys = tags.get(KEYS, [])
    epsg = next((keys[p + 3] for p in range(4, len(keys) - 3, 4) if keys[p] in (2048, 3072)), None)
    nodata = float(tags[NODATA][0].rstrip(b"\0 ")) if NODATA in tags else None
    left, top = tie[3] + (c0 - tie[0]) * scale[0], tie[4] - (r0 - tie[1]) * scale[1]
    return Raster(out[:, ::step, ::step], left, top, scale[0] * step, scale[1] * step, epsg, nodata)


def files(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """path, length, content of all files below a folder whose names fit the pattern."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def headers(found: DataFrame) -> DataFrame:
    """path, width, height, bands, epsg and valid of files (path, content): valid ones can be opened and have all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column("content"):
                try:
                    data = content.as_py() or b""
                    _, tags = directory(data)
                    ends = [a + b for a, b in zip(tags.get(TILES) or tags[STRIPS], tags.get(TILE_BYTES) or tags[STRIP_BYTES], strict=True)]
                    raster = decode(data, (0, 0, 0, 0))
                    rows.append((tags[WIDTH][0], tags[HEIGHT][0], len(raster.data), raster.epsg, max(ends) <= len(data)))
                except (ValueError, KeyError):
                    rows.append((None, None, None, None, False))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds))], ["path", "width", "height", "bands", "epsg", "valid"])

    return found.select("path", "content").mapInArrow(run, "path string, width bigint, height bigint, bands bigint, epsg bigint, valid boolean")


def pixels(found: DataFrame, bands: int, window: tuple[int, int, int, int] | None = None, step: int = 1) -> DataFrame:
    """path, x, y, b1.. of files (path, content): whole, windowed or decimated, integer samples; a block row of pixels at a
    time leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                own = decode(content.as_py(), window, step).data
                if len(own) < bands:
                    raise ValueError(f"{path} has {len(own)} bands, not {bands}")
                _, height, width = own.shape
                for r in range(0, height, 64):
                    part = own[:bands, r : r + 64].astype(np.int64)
                    y, x = np.indices(part.shape[1:])
                    yield pa.RecordBatch.from_arrays([pa.array([path] * x.size), pa.array(x.ravel()), pa.array(y.ravel() + r), *(pa.array(b.ravel()) for b in part)], ["path", "x", "y", *(f"b{i + 1}" for i in range(bands))])

    names = ", ".join(f"b{i + 1} bigint" for i in range(bands))
    return found.select("path", "content").mapInArrow(run, f"path string, x bigint, y bigint, {names}")


def tiles(pixels_: DataFrame, keys: list[str], bands: list[str], side: int = 2048, left: float = 0.0, top: float = 0.0, res: float = 1.0, epsg: int | None = None, compression: int = DEFLATE, kind: str = "uint16") -> DataFrame:
    """keys, tile_x, tile_y, content: a GeoTIFF for each tile of side x side pixels (x, y, bands; absent ones are 0), its
    blocks no larger than the tile needs. A task holds one tile at a time."""
    block = min(BLOCK, -(-side // 16) * 16)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own = [k.as_py() for k in key]
        tx, ty = own[-2:]
        x, y = (table.column(c).to_numpy() - t * side for c, t in (("x", tx), ("y", ty)))
        data = np.zeros((len(bands), side, side), kind)
        for i, b in enumerate(bands):
            data[i, y, x] = table.column(b).to_numpy()
        content = encode(Raster(data, left + tx * side * res, top - ty * side * res, res, res, epsg), compression, block)
        return pa.table([*(pa.array([v], table.schema.field(c).type) for c, v in zip([*keys, "tile_x", "tile_y"], own, strict=True)), pa.array([content], pa.binary())], names=[*keys, "tile_x", "tile_y", "content"])

    dealt = pixels_.selectExpr(*keys, f"x div {side} as tile_x", f"y div {side} as tile_y", "x", "y", *bands)
    kinds = ", ".join(f"{c} {dealt.schema[c].dataType.simpleString()}" for c in (*keys, "tile_x", "tile_y"))
    return dealt.groupBy(*keys, "tile_x", "tile_y").applyInArrow(run, f"{kinds}, content binary")


def save(pixels_: DataFrame, path: str, keys: list[str], side: int = 2048) -> None:
    """A raster table on disk: Parquet, partitioned by keys and tile rows, so that a window reads only its own files."""
    dealt = pixels_.withColumns({"tile_y": F.expr(f"y div {side}"), "tile_x": F.expr(f"x div {side}")})
    dealt.repartition(*keys, "tile_y", "tile_x").sortWithinPartitions("y", "x").write.mode("overwrite").partitionBy(*keys, "tile_y").parquet(path)


def windowed(spark: SparkSession, path: str, window: tuple[int, int, int, int], side: int = 2048) -> DataFrame:
    """A saved raster table's pixels in a window (col_off, row_off, width, height); other tile rows' files are not opened."""
    c, r, w, h = window
    own = spark.read.parquet(path).where(F.col("tile_y").between(r // side, (r + h - 1) // side) & F.col("tile_x").between(c // side, (c + w - 1) // side))
    return own.where(F.col("x").between(c, c + w - 1) & F.col("y").between(r, r + h - 1)).drop("tile_x", "tile_y")
