"""Queries of percentiles, masks, profiles and colour transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.functions import pixel as P
from terrazzo.operators import masks, radiometry, stats
from terrazzo.plans.mosaic import mosaic_scenes as whole_mosaic
from terrazzo.registry import query
from terrazzo.sources.views import px, with_views

LEAST = 500  # of pixels for a profile; the default of 3000 is for whole scenes
S = ["scene_id"]


def good(spark: SparkSession, d: str) -> DataFrame:
    return px(spark, d).where(P.valid())


def rounded(df: DataFrame, keys: list[str], digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*(F.round(c, digits).alias(c) if kinds[c] == "double" and c not in keys else F.col(c) for c in df.columns))


@query(with_views("select scene_id, round(quantile_cont(luma, 0.05), 6) as p5, round(quantile_cont(luma, 0.5), 6) as p50, round(quantile_cont(luma, 0.95), 6) as p95 from lit group by 1", "lit"))
def percentiles(spark: SparkSession, d: str) -> DataFrame:
    p = stats.percentiles(good(spark, d), S, {"luma": P.brightness()}, [5, 50, 95])
    return p.select("scene_id", *(F.round(F.col("luma_p")[i], 6).alias(n) for i, n in enumerate(("p5", "p50", "p95"))))


def _levels(c: str, name: str, low: int, high: int) -> str:
    return ", ".join(f"quantile_cont({c}, {q / 100}) as {name}_{level}" for q, level in ((low, "low"), (50, "mid"), (high, "high")))


RATIO = "greatest(0.2::double, least(3.0::double, {b} / greatest(luma, 1.0::double)))"


def _profile(src: str, low: int = 10, high: int = 90, keys: str = "scene_id") -> str:
    cols = [*(_levels(c, c, low, high) for c in ("b1", "b2", "b3", "luma")), *(f"quantile_cont({RATIO.format(b=b)}, 0.5) as {b}_ratio" for b in P.BANDS)]
    return f"select {keys}, {', '.join(cols)}, count(*) as pixels from {src} group by {keys}"


FIELDS = [f"{c}_{level}" for c in (*P.BANDS, "luma") for level in ("low", "mid", "high")] + [f"{b}_ratio" for b in P.BANDS]
SIX = ", ".join(f"round({f}, 6) as {f}" for f in FIELDS)


@query(with_views(f"select scene_id, {', '.join(f'round({f}, 6) as {f}' for f in FIELDS if f[0] == 'b' and 'ratio' not in f)} from p", "lit", more={"p": _profile("lit")}))
def band_stats(spark: SparkSession, d: str) -> DataFrame:
    p = stats.band_profile(good(spark, d), S, 10, 90)
    return rounded(p.select("scene_id", *(f for f in FIELDS if f[0] == "b" and "ratio" not in f)), S)


@query(with_views("select scene_id, round(luma_low, 6) as luma_low, round(luma_mid, 6) as luma_mid, round(luma_high, 6) as luma_high from p", "lit", more={"p": _profile("lit")}))
def luma_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.band_profile(good(spark, d), S, 10, 90).select("scene_id", "luma_low", "luma_mid", "luma_high"), S)


@query(with_views("select scene_id, round(b1_ratio, 6) as b1_ratio, round(b2_ratio, 6) as b2_ratio, round(b3_ratio, 6) as b3_ratio from p", "lit", more={"p": _profile("lit")}))
def color_ratios(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.band_profile(good(spark, d), S, 10, 90).select("scene_id", *(f"{b}_ratio" for b in P.BANDS)), S)


@query(with_views(f"select scene_id, {SIX}, pixels from p", "lit", more={"p": _profile("lit")}))
def color_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.band_profile(good(spark, d), S, 10, 90), S)


LIMITS = {"lim": "select scene_id, " + ", ".join(f"quantile_cont({b}, 0.02) as {b}_lo, case when quantile_cont({b}, 0.98) <= quantile_cont({b}, 0.02) then quantile_cont({b}, 0.02) + 1 else quantile_cont({b}, 0.98) end as {b}_hi" for b in P.BANDS) + " from lit group by 1"}
SIDES = [f"{b}_{s}" for b in P.BANDS for s in ("lo", "hi")]


@query(with_views("select scene_id, " + ", ".join(f"round({c}, 6) as {c}" for c in SIDES) + " from lim", "lit", more=LIMITS))
def percentile_limits(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.limits(good(spark, d), S), S)


@query(with_views("select scene_id, x, y, " + ", ".join(f"case when least(b1, b2, b3) > 0 then round_even(power(greatest(0::double, least(1::double, ({b} - {b}_lo) / ({b}_hi - {b}_lo))), 1 / 1.15::double) * 255, 0)::bigint else 0 end as {b}" for b in P.BANDS) + " from px join lim using (scene_id)", "px", "lit", more=LIMITS))
def visual_stretch(spark: SparkSession, d: str) -> DataFrame:
    own = px(spark, d).join(stats.limits(good(spark, d), S), "scene_id")
    out = lambda b: F.when(P.valid(), F.rint(P.stretch(F.col(b), F.col(f"{b}_lo"), F.col(f"{b}_hi"), 1.15) * 255).cast("long")).otherwise(0).alias(b)
    return own.select("scene_id", "x", "y", *map(out, P.BANDS))


TARGET = {**LIMITS, "t": "select " + ", ".join(f"quantile_cont({c}, 0.5) as t_{c}" for c in SIDES) + " from lim"}


@query(with_views("select " + ", ".join(f"round(t_{c}, 6) as {c}" for c in SIDES) + " from t", "lit", more=TARGET))
def harmonize_target(spark: SparkSession, d: str) -> DataFrame:
    return stats.limits(good(spark, d), S).agg(*(F.round(F.median(c), 6).alias(c) for c in SIDES))


@query(with_views("select scene_id, x, y, " + ", ".join(f"case when least(b1, b2, b3) > 0 then round(greatest(0::double, least(1::double, ({b} - {b}_lo) / greatest({b}_hi - {b}_lo, 1e-6::double))) * (t_{b}_hi - t_{b}_lo) + t_{b}_lo, 4) else 0 end as {b}" for b in P.BANDS) + " from px join lim using (scene_id), t", "px", "lit", more=TARGET))
def harmonize_rgb(spark: SparkSession, d: str) -> DataFrame:
    limits = stats.limits(good(spark, d), S)
    target = limits.agg(*(F.median(c).alias(f"t_{c}") for c in SIDES))
    own = px(spark, d).join(limits, "scene_id").crossJoin(target)  # one row
    out = lambda b: F.when(P.valid(), F.round(P.harmonise(F.col(b), F.col(f"{b}_lo"), F.col(f"{b}_hi"), F.col(f"t_{b}_lo"), F.col(f"t_{b}_hi")), 4)).otherwise(0.0).alias(b)
    return own.select("scene_id", "x", "y", *map(out, P.BANDS))


def _q(at: list, src: str = "lit", key: str = "scene_id", channel: str = "luma", prefix: str = "p") -> str:
    return f"select {key}, " + ", ".join(f"quantile_cont({channel}, {a / 100}) as {prefix}{a}" for a in at) + f" from {src} group by {key}"


EXTREMES = "(p98 <= p2 or (luma >= p2 and luma <= p98))"
BROAD = f"{EXTREMES} and not ((luma > p92 and sat < 0.22::double) or luma > p97 or (luma > p20 and sat > 0.90::double))"


def _clear(p: str = "", r: str = "b1", g: str = "b2", b: str = "b3", luma: str = "luma", sat: str = "sat") -> str:
    blue = f"({b} > 1.10::double * {r} and {b} > 0.94::double * {g})"
    cyan = f"({g} > 1.08::double * {r} and {b} > 1.04::double * {r})"
    rules = [
        f"({luma} < {p}p55 and {b} > 1.04::double * {r} and {g} > 0.92::double * {r})", f"({cyan} and {luma} < {p}p90 and {sat} > 0.10::double)",
        f"({blue} and {luma} < {p}p82 and {sat} > 0.16::double and {r} < 0.92::double * {g})", f"{luma} < greatest(1.0::double, 0.60::double * {p}p20)",
        f"({luma} > {p}p90 and {sat} < 0.24::double)", f"({luma} > {p}p96 and {sat} < 0.42::double)", f"({luma} > {p}p90 and {blue} and {sat} < 0.38::double)",
        f"({luma} > {p}p10 and {sat} > 0.85::double)",
    ]
    return f"({p}p96 <= {p}p1 or ({luma} >= {p}p1 and {luma} <= {p}p96)) and not ({' or '.join(rules)})"


@query(with_views(f"select scene_id, x, y, {EXTREMES} as mask from lit join q using (scene_id)", "lit", more={"q": _q([2, 98])}))
def mask_extremes(spark: SparkSession, d: str) -> DataFrame:
    return masks.extremes(good(spark, d), S).select("scene_id", "x", "y", "mask")


@query(with_views(f"select scene_id, x, y, {BROAD} as mask from lit join q using (scene_id)", "lit", more={"q": _q(masks.BROAD)}))
def broad_mask(spark: SparkSession, d: str) -> DataFrame:
    return masks.broad(good(spark, d), S).select("scene_id", "x", "y", "mask")


@query(with_views(f"select scene_id, x, y, {_clear()} as mask from lit join q using (scene_id)", "lit", more={"q": _q(masks.CLEAR)}))
def clear_land_mask(spark: SparkSession, d: str) -> DataFrame:
    return masks.clear_land(good(spark, d), S).select("scene_id", "x", "y", "mask")


STABLE = {"q": _q([1, 92]), "f": "select lit.*, luma >= p1 and luma <= p92 and (greatest(b1, b2, b3) - least(b1, b2, b3)) / greatest(greatest(b1, b2, b3)::double, 1e-6::double) <= 0.88::double and b3 / greatest((b1 + b2 + b3)::double, 1e-6::double) <= 0.55::double as fit from lit join q using (scene_id)"}


@query(with_views("select scene_id, x, y, fit or count_if(fit) over (partition by scene_id) < 1000 as mask from f", "lit", more=STABLE))
def stable_mask(spark: SparkSession, d: str) -> DataFrame:
    return masks.stable(good(spark, d), S).select("scene_id", "x", "y", "mask")


def _chosen(least: int) -> dict[str, str]:
    return {
        "q": _q(masks.BROAD),
        "m": f"select lit.*, {BROAD} as b, {EXTREMES} as e from lit join q using (scene_id)",
        "n": "select scene_id, count_if(b) as nb, count_if(e) as ne from m group by 1",
        "c": f"select m.* from m join n using (scene_id) where case when nb >= {least} then b else e and ne >= {least} end",
    }


@query(with_views(f"select scene_id, {SIX}, pixels from p", "lit", more={**_chosen(LEAST), "p": _profile("c")}))
def scene_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(radiometry.scene_profile(px(spark, d), S, LEAST), S)


@query(with_views(f"select scene_id, {SIX}, pixels from p", "lit", more={**_chosen(2450), "p": _profile("c")}))
def scene_profile_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A minimum between the two masks' sizes at sf0.01: some scenes fall back, some have no profile."""
    return rounded(radiometry.scene_profile(px(spark, d), S, 2450), S)


MIDDLE = {**_chosen(LEAST), "p": _profile("c"), "t": "select " + ", ".join(f"quantile_cont({f}, 0.5) as {f}" for f in FIELDS) + " from p"}


@query(with_views(f"select {SIX} from t", "lit", more=MIDDLE))
def target_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(radiometry.target_profile(radiometry.scene_profile(px(spark, d), S, LEAST)), [])


@query(with_views(f"select {SIX} from p where scene_id = 1", "lit", more=MIDDLE))
def target_profile_reference(spark: SparkSession, d: str) -> DataFrame:
    return rounded(radiometry.target_profile(radiometry.scene_profile(px(spark, d), S, LEAST), reference=1), [])


def _transform(gains: tuple[float, float], lim: float, k: float = 0.9) -> dict[str, str]:
    """From `st`: keys, s_<field>, t_<field>."""
    each = [f"G * (case when s_{b}_ratio > 0 then 1 + (greatest(0.94::double, least(1.06::double, t_{b}_ratio / greatest(s_{b}_ratio, 1e-9::double))) - 1) * {k}::double else 1 end) as g{i}" for i, b in enumerate(P.BANDS)]
    return {
        "t1": f"select *, s_luma_high - s_luma_low as sr, t_luma_high - t_luma_low as tr from st",
        "t2": f"select *, case when sr <= 1 or tr <= 1 then 1.0::double else greatest({gains[0]}::double, least({gains[1]}::double, tr / greatest(sr, 1e-9::double))) end as g from t1",
        "t3": f"select *, 1 + (g - 1) * {k}::double as G_, greatest(-{lim}::double, least({lim}::double, (t_luma_mid - g * s_luma_mid) * {k}::double)) as off from t2",
        "t4": "select *, " + ", ".join(e.replace("G *", "G_ *") for e in each) + " from t3",
        "t5": "select *, list_sort([g0, g1, g2])[2] as med from t4",
        "tf": "select * exclude (g0, g1, g2, off), " + ", ".join(f"greatest(med / 1.08::double, least(med * 1.08::double, g{i})) as gain_{b}" for i, b in enumerate(P.BANDS)) + ", off as \"offset\" from t5",
    }


GLOBAL = {**MIDDLE, "st": "select scene_id, " + ", ".join(f"p.{f} as s_{f}, t.{f} as t_{f}" for f in FIELDS) + " from p, t", **_transform((0.55, 1.55), 120.0)}
GAINS = [*(f"gain_{b}" for b in P.BANDS), "offset"]
GAINS_SQL = ", ".join(f'round("{g}", 6) as "{g}"' for g in GAINS)


@query(with_views(f"select scene_id, {GAINS_SQL} from tf", "lit", more=GLOBAL))
def global_transforms(spark: SparkSession, d: str) -> DataFrame:
    return rounded(radiometry.global_transforms(px(spark, d), LEAST), S)


@query(with_views(f"select scene_id, {GAINS_SQL} from tf", "lit", more={**GLOBAL, "st": GLOBAL["st"].replace("from p, t", "from p, (select * from p where scene_id = 1) t").replace("select scene_id", "select p.scene_id")}))
def color_transforms(spark: SparkSession, d: str) -> DataFrame:
    """Onto the profile of scene 1 instead of the median."""
    return rounded(radiometry.global_transforms(px(spark, d), LEAST, reference=1), S)


@query(with_views("select scene_id, printf('gain=[%.4f, %.4f, %.4f] offset=%.2f', gain_b1, gain_b2, gain_b3, \"offset\") as line from tf", "lit", more=GLOBAL))
def format_transforms(spark: SparkSession, d: str) -> DataFrame:
    g = radiometry.global_transforms(px(spark, d), LEAST)
    return g.select("scene_id", F.format_string("gain=[%.4f, %.4f, %.4f] offset=%.2f", *GAINS).alias("line"))


MATCHED = {**GLOBAL, "px2": "select px.scene_id, x, y, " + ", ".join(f"case when least(b1, b2, b3) > 0 then coalesce(trunc(greatest(0::double, least(1023::double, {b} * gain_{b} + \"offset\")))::bigint, {b}) else 0 end as {b}" for b in P.BANDS) + " from px left join tf using (scene_id)"}


@query(with_views("select x, y, " + ", ".join(f"least(1023, trunc(sum({b}) / count(*)))::bigint as {b}" for b in P.BANDS) + " from px2 where least(b1, b2, b3) > 0 group by 1, 2", "px", "lit", more=MATCHED))
def mosaic_scenes(spark: SparkSession, d: str) -> DataFrame:
    return whole_mosaic(px(spark, d), least=LEAST)


@query()
def overlap_match_tree(spark: SparkSession, d: str) -> DataFrame:
    """Corrected from scene to scene, then merged: each round needs the corrected pixels of the last, which SQL cannot say."""
    return whole_mosaic(px(spark, d), reference=0, overlap=True, least=LEAST, overlap_least=300, order=[0, 1, 2, 3])


PAIRS = {
    "ov": "select a.scene_id as a, b.scene_id as b, x, y, a.b1 as a1, a.b2 as a2, a.b3 as a3, b.b1, b.b2, b.b3 from px a join px b using (x, y) where a.scene_id < b.scene_id and least(a.b1, a.b2, a.b3) > 0 and least(b.b1, b.b2, b.b3) > 0",
}


@query(with_views("select a, b, count(*) as pixels from ov group by 1, 2", "px", more=PAIRS))
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    return radiometry.overlap_pairs(px(spark, d)).groupBy("a", "b").agg(F.count("*").alias("pixels"))


@query(with_views("select b, arg_max(a, pixels * 1000 - a) as a, max(pixels) as pixels from (select a, b, count(*) as pixels from ov group by 1, 2) group by 1", "px", more=PAIRS))
def best_overlap(spark: SparkSession, d: str) -> DataFrame:
    n = radiometry.overlap_pairs(px(spark, d)).groupBy("a", "b").agg(F.count("*").alias("pixels"))
    best = n.groupBy("b").agg(F.max(F.struct("pixels", (-F.col("a")).alias("a"))).alias("m"))
    return best.select("b", (-F.col("m.a")).alias("a"), "m.pixels")


def _overlap(least: int, only: str = "") -> dict[str, str]:
    at = [*masks.CLEAR, 5, 95]
    luma = lambda s: f"(299 * {s}1 + 587 * {s}2 + 114 * {s}3) / 1000.0::double"
    sat = lambda s: f"(greatest({s}1, {s}2, {s}3) - least({s}1, {s}2, {s}3)) / greatest({s}_luma, 1.0::double)"
    q = ", ".join(f"quantile_cont({s}_luma, {p / 100}) as {s}_p{p}" for s in "ab" for p in at)
    return {
        **PAIRS,
        "o1": f"select *, {luma('a')} as a_luma, {luma('b')} as b_luma from ov {only}",
        "o2": f"select *, {sat('a')} as a_sat, {sat('b')} as b_sat from o1",
        "oq": f"select a, b, {q} from o2 group by 1, 2",
        "o3": f"select o2.*, {_clear('a_', 'a1', 'a2', 'a3', 'a_luma', 'a_sat')} as la, {_clear('b_', 'b1', 'b2', 'b3', 'b_luma', 'b_sat')} as lb, a_luma between a_p5 and a_p95 and b_luma between b_p5 and b_p95 as usual from o2 join oq using (a, b)",
        "om": f"select *, case when count_if(la and lb) over (partition by a, b) >= {least} then la and lb else usual and (la or lb) end as mask from o3",
    }


@query(with_views("select a, b, x, y, mask from om", "px", more=_overlap(500)))
def overlap_mask(spark: SparkSession, d: str) -> DataFrame:
    return masks.overlap(radiometry.overlap_pairs(px(spark, d)), ["a", "b"], 500).select("a", "b", "x", "y", "mask")


@query(with_views("select a, b, x, y, mask from om", "px", more=_overlap(1000)))
def overlap_mask_relaxed(spark: SparkSession, d: str) -> DataFrame:
    return masks.overlap(radiometry.overlap_pairs(px(spark, d)), ["a", "b"], 1000).select("a", "b", "x", "y", "mask")


_own = {
    **_overlap(500),
    "w": "select *, count(*) over (partition by a, b) as pixels from om where mask",
    "wb": "select a, b, b1, b2, b3, b_luma as luma from w where pixels >= 300",
    "wa": "select a, b, a1 as b1, a2 as b2, a3 as b3, a_luma as luma from w where pixels >= 300",
    "ps": _profile("wb", 20, 80, "a, b"),
    "pt": _profile("wa", 20, 80, "a, b"),
    "st": "select a, b, ps.pixels, " + ", ".join(f"ps.{f} as s_{f}, pt.{f} as t_{f}" for f in FIELDS) + " from ps join pt using (a, b)",
    **_transform((0.65, 1.45), 90.0),
    "mv": "select w.a, w.b, a1, a2, a3, a_luma, " + ", ".join(f"w.b{i} * gain_b{i} + \"offset\" as t{i}" for i in (1, 2, 3)) + " from w join tf using (a, b)",
    "mm": "select *, (299 * t1 + 587 * t2 + 114 * t3) / 1000.0::double as t_luma from mv",
    "ql": "select a, b, abs(quantile_cont(t_luma, 0.5) - quantile_cont(a_luma, 0.5)) as d_luma, abs(quantile_cont((t2 - 0.5::double * (t1 + t3)) / greatest(t_luma, 1.0::double), 0.5) - quantile_cont((a2 - 0.5::double * (a1 + a3)) / greatest(a_luma, 1.0::double), 0.5)) as d_tint, avg((greatest(t1, t2, t3) >= 1023)::int) as high_clip, avg((least(t1, t2, t3) <= 0)::int) as low_clip from mm group by 1, 2",
}


@query(with_views(f"select a, b, pixels, {GAINS_SQL} from tf", "px", more=_own))
def overlap_transforms(spark: SparkSession, d: str) -> DataFrame:
    t = radiometry.overlap_transforms(radiometry.overlap_pairs(px(spark, d)), ["a", "b"], least=300)
    return rounded(t.select("a", "b", "pixels", *GAINS), ["a", "b"])


@query(with_views("select a, b, round(d_luma, 6) as d_luma, round(d_tint, 6) as d_tint, round(high_clip, 6) as high_clip, round(low_clip, 6) as low_clip, d_luma <= 55 and d_tint <= 0.10::double and high_clip <= 0.015::double and low_clip <= 0.020::double as safe, d_luma <= 5 and d_tint <= 0.10::double and high_clip <= 0.015::double and low_clip <= 0.020::double as safe_strict from ql", "px", more=_own))
def transform_quality(spark: SparkSession, d: str) -> DataFrame:
    t = radiometry.overlap_transforms(radiometry.overlap_pairs(px(spark, d)), ["a", "b"], least=300)
    t = t.withColumn("safe_strict", radiometry.safe(luma=5.0))
    return rounded(t.select("a", "b", "d_luma", "d_tint", "high_clip", "low_clip", "safe", "safe_strict"), ["a", "b"])


@query(with_views("select scene_id, least(100, b1 * 100 // 1024 + 1) as bin, count(*) as n, round(count(*) / (sum(count(*)) over (partition by scene_id) * 10.24::double), 9) as density from px where b1 > 0 group by 1, 2", "px"))
def histogram(spark: SparkSession, d: str) -> DataFrame:
    h = stats.histogram(px(spark, d).where("b1 > 0"), S, F.col("b1"), 0.0, 1024.0, 100)
    return h.select("scene_id", "bin", "n", F.round("density", 9).alias("density"))


@query(with_views(" union all ".join(f"select '{b}' as band, min({b}) as lowest, max({b}) as highest, round(avg({b}), 6) as mean from px where {b} > 0" for b in P.BANDS), "px"))
def final_stats(spark: SparkSession, d: str) -> DataFrame:
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).alias("v")) for b in P.BANDS)))
    return px(spark, d).select(each.alias("c")).select("c.*").where("v > 0").groupBy("band").agg(F.min("v").alias("lowest"), F.max("v").alias("highest"), F.round(F.avg("v"), 6).alias("mean"))


@query(with_views("select scene_id, count(*) as pixels, count_if(least(b1, b2, b3) > 0)::bigint as valid, count(distinct (x // 8) * 1000 + y // 8) as tiles from px group by 1", "px"))
def counters(spark: SparkSession, d: str) -> DataFrame:
    return px(spark, d).groupBy("scene_id").agg(F.count("*").alias("pixels"), F.count_if(P.valid()).alias("valid"), F.countDistinct(F.expr("(x div 8) * 1000 + y div 8")).alias("tiles"))


@query(with_views("select x, y, " + ", ".join(f"least(1023, trunc(sum({b}) / count(*)))::bigint as {b}" for b in P.BANDS) + " from (select * from px where least(b1, b2, b3) > 0) group by 1, 2", "px"))
def mosaic_scenes_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return whole_mosaic(px(spark, d), match_colors=False)


