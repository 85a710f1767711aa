"""Pixel algebra as pure Column functions. Bands are r, g, b (b1, b2, b3 of the pixel table); 0 is nodata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BANDS = ("b1", "b2", "b3")
TOP = 1023  # ten bits


def double(c: Column | float) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("double")


def clip(c: Column, low: Column | float, high: Column | float) -> Column:
    return F.greatest(F.least(c, double(high)), double(low))


def bands(names: tuple[str, ...] = BANDS) -> list[Column]:
    return [F.col(n) for n in names]


def valid(names: tuple[str, ...] = BANDS) -> Column:
    return F.least(*bands(names)) > 0


def brightness(names: tuple[str, ...] = BANDS) -> Column:
    """Weighted for three bands, the mean for fewer. Weights are whole thousandths, so DNs give few distinct values."""
    if len(names) < 3:
        return sum(bands(names)[1:], F.col(names[0])) / float(len(names))
    r, g, b = bands(names)
    return (299 * r + 587 * g + 114 * b) / double(1000.0)


def spread(names: tuple[str, ...] = BANDS) -> Column:
    return F.greatest(*bands(names)) - F.least(*bands(names))


def saturation(luma: Column | None = None) -> Column:
    return spread() / F.greatest(brightness() if luma is None else luma, double(1.0))


def saturation_of_maximum() -> Column:
    return spread() / F.greatest(double(F.greatest(*bands())), double(1e-6))


def blue_ratio() -> Column:
    r, g, b = bands()
    return b / F.greatest(double(r + g + b), double(1e-6))


def green_tint(r: Column, g: Column, b: Column, luma: Column) -> Column:
    return (g - 0.5 * (r + b)) / F.greatest(luma, double(1.0))


def color_ratio(band: Column, luma: Column) -> Column:
    return clip(band / F.greatest(luma, double(1.0)), 0.2, 3.0)


def linear(band: Column, gain: Column, offset: Column) -> Column:
    return band * gain + offset


def truncated(c: Column, top: int = TOP) -> Column:
    """Clipped to 0..top, then cut to a whole number; clipping first, as an ANSI cast may overflow."""
    return clip(c, 0.0, float(top)).cast("long")


def stretch(c: Column, low: Column, high: Column, gamma: float) -> Column:
    return F.power(clip((c - low) / (high - low), 0.0, 1.0), F.lit(1.0 / max(gamma, 1e-6)))


def harmonise(c: Column, low: Column, high: Column, to_low: Column, to_high: Column) -> Column:
    return clip((c - low) / F.greatest(high - low, double(1e-6)), 0.0, 1.0) * (to_high - to_low) + to_low


def block_size(n: Column) -> Column:
    """Tile side of a raster of n pixels: a multiple of 16 between 16 and 512."""
    return F.greatest(F.lit(16).cast("long"), F.least(F.lit(512).cast("long"), F.floor(n / 16) * 16))


def tile_side(ram_gb: Column) -> Column:
    return F.floor(F.greatest(double(1.0), F.least(double(16.0), ram_gb / 2, ram_gb / 4 + 4))) * 1024


def size_gb(width: Column, height: Column, count: Column) -> Column:
    return double(width * height * count * 2) / float(2**30)


def dtype_scale(dtype: Column, top: Column) -> Column:
    """Largest value of an integer type; of floats 65535 if a sample exceeds 1.5, else 1."""
    known = {"uint8": 255, "int16": 32767, "uint16": 65535, "int32": 2147483647, "uint32": 4294967295}
    out = F.when(top > 1.5, 65535.0).otherwise(1.0)
    for name, value in known.items():
        out = F.when(dtype == name, float(value)).otherwise(out)
    return out


def color_interpretation(count: Column, current: Column) -> Column:
    """Null below three bands; kept unless it is null, gray or undefined; else red, green, blue and undefined."""
    usual = F.concat(F.lit("red,green,blue"), F.repeat(F.lit(",undefined"), (count - 3).cast("int")))
    plain = current.isNull() | F.forall(F.split(current, ","), lambda c: c.isin("gray", "undefined"))
    return F.when(count < 3, None).when(plain, usual).otherwise(current)
