"""The mosaic as one lazy plan: reference, colours, merge, clip."""

from __future__ import annotations

from pyspark.sql import DataFrame

from terrazzo.operators import merge, radiometry, spatial


def mosaic_scenes(pixels: DataFrame, reference: int | None = None, match_colors: bool = True, overlap: bool = False, color_target: str = "median", strength: float = radiometry.STRENGTH, method: str = "mean", clip_to: DataFrame | None = None, least: int = 3000, overlap_least: int = 1000, order: list[int] | None = None) -> DataFrame:
    """x, y, b1, b2, b3 of the mosaic of all scenes of a pixel table.

    Colours go to the median profile of the scenes (or the reference's), or from scene to scene by overlap, which takes a
    round for each scene. strength is cut to 0..1.
    """
    if color_target not in ("median", "reference"):
        raise ValueError(f"unknown color target {color_target!r}")
    if method not in merge.METHODS:
        raise ValueError(f"unknown merge method {method!r}")
    strength = max(0.0, min(1.0, strength))
    if pixels.isEmpty():
        raise ValueError("a mosaic needs at least one scene")
    if reference is not None and pixels.where(pixels.scene_id == reference).isEmpty():
        raise ValueError("the reference is not among the scenes")
    if match_colors:
        gains = radiometry.global_transforms(pixels, least, strength, reference if color_target == "reference" else None)
        if overlap:
            ids = order or sorted(r.scene_id for r in pixels.select("scene_id").distinct().collect())
            pixels = radiometry.match_by_overlap(pixels, ids[0] if reference is None else reference, ids, overlap_least, strength, gains)
        else:
            pixels = radiometry.applied(pixels, gains)
    out = merge.merge(pixels, method, reference)
    return out if clip_to is None else spatial.clip(out, clip_to)
