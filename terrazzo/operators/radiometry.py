"""Gains and offsets that bring a scene's colours to a target: profiles, transforms, their quality, and their application."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions import pixel as px
from terrazzo.operators import masks
from terrazzo.operators.lineage import cut
from terrazzo.operators.stats import band_profile, colours

GLOBAL = {"gains": (0.55, 1.55), "offset": 120.0}
OVERLAP = {"gains": (0.65, 1.45), "offset": 90.0}
TINTS, GAIN_RATIO, STRENGTH = (0.94, 1.06), 1.08, 0.90


def scene_profile(pixels: DataFrame, keys: list[str], least: int = 3000, low: float = 10, high: float = 90) -> DataFrame:
    """Profile of each scene over its broad mask, over the mask without extremes where that is too small, and none (no
    row) where both are. The raster is scanned once, for its colours; masks and profiles are those of weighted colours."""
    both = masks.broad_and_extremes(cut(colours(pixels, keys)), keys, "weight")
    of = lambda c: F.sum(F.when(F.col(c), F.col("weight")).otherwise(0))
    counts = both.groupBy(*keys).agg(of("b").alias("nb"), of("e").alias("ne"))
    chosen = both.join(counts, keys).where(F.when(F.col("nb") >= least, F.col("b")).otherwise(F.col("e") & (F.col("ne") >= least)))
    return band_profile(chosen.select(*keys, *px.BANDS, "weight"), keys, low, high, weight="weight")


def target_profile(profiles: DataFrame, reference: int | None = None, key: str = "scene_id") -> DataFrame:
    """One row: the median over scenes of every field, or the reference scene's own fields where it has a profile."""
    fields = [c for c in profiles.columns if c not in (key, "pixels")]
    middle = profiles.agg(*(F.median(c).alias(c) for c in fields))
    if reference is None:
        return middle
    own = profiles.where(F.col(key) == reference).agg(*(F.first(c).alias(f"own_{c}") for c in fields))
    return middle.crossJoin(own).select(*(F.coalesce(f"own_{c}", c).alias(c) for c in fields))  # one row each


def median3(a: Column, b: Column, c: Column) -> Column:
    return F.sort_array(F.array(a, b, c))[1]


def transforms(source: Column | str, target: str, gains: tuple[float, float], offset: float, strength: float = STRENGTH) -> list[Column]:
    """gain_b1..gain_b3 and offset, from the columns of two struct columns (profiles). The bands share one offset."""
    s, t = (lambda f: F.col(f"{source}.{f}")), (lambda f: F.col(f"{target}.{f}"))
    sr, tr = s("luma_high") - s("luma_low"), t("luma_high") - t("luma_low")
    flat = (sr <= 1) | (tr <= 1)
    g = F.when(flat, px.double(1.0)).otherwise(px.clip(tr / F.greatest(sr, px.double(1e-9)), *gains))
    o = t("luma_mid") - g * s("luma_mid")
    gain, shift = 1 + (g - 1) * strength, px.clip(o * strength, -offset, offset)
    each = []
    for b in px.BANDS:
        ratio = px.clip(t(f"{b}_ratio") / F.greatest(s(f"{b}_ratio"), px.double(1e-9)), *TINTS)
        each.append(gain * F.coalesce(F.when(s(f"{b}_ratio") > 0, 1 + (ratio - 1) * min(1.0, strength)), px.double(1.0)))
    middle = median3(*each)
    return [*(px.clip(e, middle / GAIN_RATIO, middle * GAIN_RATIO).alias(f"gain_{b}") for e, b in zip(each, px.BANDS, strict=True)), shift.alias("offset")]


def global_transforms(pixels: DataFrame, least: int = 3000, strength: float = STRENGTH, reference: int | None = None) -> DataFrame:
    """scene_id and its transform to the target profile; scenes without a profile have no row."""
    profiles = cut(scene_profile(pixels, ["scene_id"], least))  # a row for each scene, used twice
    target = target_profile(profiles, reference)
    pairs = profiles.select("scene_id", F.struct("*").alias("s")).crossJoin(target.select(F.struct("*").alias("t")))  # one row
    return pairs.select("scene_id", *transforms("s", "t", **GLOBAL, strength=strength))


def applied(pixels: DataFrame, gains: DataFrame, keys: list[str] | None = None, top: int = px.TOP) -> DataFrame:
    """Pixels after their scene's transform (none: unchanged): clipped to 0..top, truncated; invalid pixels become 0."""
    keys = keys or ["scene_id"]
    joined = pixels.join(gains, keys, "left")
    out = {b: F.when(px.valid(), F.when(F.col("offset").isNull(), F.col(b)).otherwise(px.truncated(px.linear(F.col(b), F.col(f"gain_{b}"), F.col("offset")), top))).otherwise(0).cast("long") for b in px.BANDS}
    return joined.select(*(out[c].alias(c) if c in out else F.col(c) for c in pixels.columns))


def overlap_pairs(pixels: DataFrame, reference: int | None = None) -> DataFrame:
    """Co-registered valid pixels of two scenes: a (the reference, or the smaller id), b, x, y, a1..a3, b1..b3."""
    good = pixels.where(px.valid())
    a = good.select("x", "y", F.col("scene_id").alias("a"), *(F.col(b).alias(f"a{i + 1}") for i, b in enumerate(px.BANDS)))
    b = good.select("x", "y", F.col("scene_id").alias("b"), *px.bands())
    if reference is not None:
        return a.where(F.col("a") == reference).join(b.where(F.col("b") != reference), ["x", "y"])
    return a.join(b, ["x", "y"]).where("a < b")


def quality(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Of masked pairs with gain_b1..3 and offset: differences of the medians of luma and of green tint after the
    transform, and the shares of pixels it clips."""
    moved = pairs.select("*", *(px.linear(F.col(b), F.col(f"gain_{b}"), F.col("offset")).alias(f"t{i + 1}") for i, b in enumerate(px.BANDS)))
    a, t = [F.col(f"a{i}") for i in (1, 2, 3)], [F.col(f"t{i}") for i in (1, 2, 3)]
    luma = lambda c: (299 * c[0] + 587 * c[1] + 114 * c[2]) / px.double(1000.0)
    tint = lambda c: px.green_tint(*c, luma(c))
    return moved.groupBy(*keys).agg(
        F.abs(F.median(luma(t)) - F.median(luma(a))).alias("d_luma"),
        F.abs(F.median(tint(t)) - F.median(tint(a))).alias("d_tint"),
        F.avg((F.greatest(*t) >= px.TOP).cast("double")).alias("high_clip"),
        F.avg((F.least(*t) <= 0).cast("double")).alias("low_clip"),
    )


def safe(luma: float = 55.0, tint: float = 0.10, high: float = 0.015, low: float = 0.020) -> Column:
    return (F.col("d_luma") <= luma) & (F.col("d_tint") <= tint) & (F.col("high_clip") <= high) & (F.col("low_clip") <= low)


def overlap_transforms(pairs: DataFrame, keys: list[str], least: int = 1000, strict: int = 500, strength: float = STRENGTH) -> DataFrame:
    """For each pair of scenes whose overlap mask has `least` pixels: the transform of b onto a, its quality, and whether
    it is safe. pairs: keys, a1..a3, b1..b3."""
    own = masks.overlap(pairs, keys, strict).where("mask").drop("mask")
    own = cut(own)
    enough = own.groupBy(*keys).agg(F.count("*").alias("pixels")).where(F.col("pixels") >= least)
    own = own.join(enough.select(*keys), keys)
    source = band_profile(own.select(*keys, *px.BANDS), keys, 20, 80).select(*keys, F.struct("*").alias("s"))
    target = band_profile(own.select(*keys, *(F.col(f"a{i + 1}").alias(b) for i, b in enumerate(px.BANDS))), keys, 20, 80).select(*keys, F.struct("*").alias("t"))
    gains = source.join(target, keys).select(*keys, *transforms("s", "t", **OVERLAP, strength=strength))
    judged = quality(own.join(gains, keys), keys)
    return enough.join(gains, keys).join(judged, keys).withColumn("safe", safe())


def match_by_overlap(pixels: DataFrame, reference: int, order: list[int], least: int = 1000, strength: float = STRENGTH, fallback: DataFrame | None = None) -> DataFrame:
    """Scenes corrected one after the other, each onto the corrected scene it shares the most masked pixels with; a scene
    without a usable overlap gets its fallback transform, or none. One round for each scene: later estimates need the
    corrected pixels of earlier ones. A round estimates only the pairs of the scene corrected last, as the others' pixels
    have not changed. Only a row for each pair of scenes comes to the driver."""
    pixels = cut(pixels)
    done = {reference: pixels.where(F.col("scene_id") == reference)}
    pending, places, last, known = [s for s in order if s != reference], {s: k for k, s in enumerate(order)}, reference, []
    while pending:
        a = done[last].where(px.valid()).select("x", "y", F.col("scene_id").alias("a"), *(F.col(b).alias(f"a{i + 1}") for i, b in enumerate(px.BANDS)))
        b = pixels.where(px.valid() & F.col("scene_id").isin(pending)).select("x", "y", F.col("scene_id").alias("b"), *px.bands())
        known += overlap_transforms(a.join(b, ["x", "y"]), ["a", "b"], least, strength=strength).where("safe").collect()
        known = [r for r in known if r.b in pending]
        best = max(known, key=lambda r: (r.pixels, -places[r.b], -list(done).index(r.a)), default=None)
        source = best.b if best else pending[0]
        own = pixels.where(F.col("scene_id") == source)
        if best:
            gains = own.sparkSession.createDataFrame([(source, best.gain_b1, best.gain_b2, best.gain_b3, best.offset)], "scene_id bigint, gain_b1 double, gain_b2 double, gain_b3 double, offset double")
            own = applied(own, gains)
        elif fallback is not None:
            own = applied(own, fallback)
        done[source], last = cut(own), source
        pending.remove(source)
    return reduce(DataFrame.unionByName, (done[s] for s in order))
