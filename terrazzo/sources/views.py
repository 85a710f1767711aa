"""Rasters, a catalogue and a polygon derived from the driver's tables (FIXTURES.md, 3), as DataFrames and as SQL.

px holds scene_id, x, y, b1, b2, b3; pan_px the panchromatic band of scene 0 at twice the resolution; scenes the
catalogue; aoi_edges a concave polygon with a hole. All whole numbers are bigint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rings of the polygon, in pixels.
RINGS = [[(4, 4), (60, 10), (36, 28), (58, 50), (6, 52)], [(16, 20), (26, 20), (26, 30), (16, 30)]]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    dn = F.greatest(F.lit(0).cast("long"), F.least(F.lit(1023).cast("long"), F.floor((F.col("v").cast("double") + 0.32) * 1600)))
    bands = values.select(F.expr("vec_id div 3").alias("tile"), (F.col("vec_id") % 3 + 1).alias("band"), F.col("pos").cast("long").alias("pos"), dn.alias("dn"))
    wide = bands.groupBy("tile", "pos").agg(*(F.max(F.when(F.col("band") == k, F.col("dn"))).alias(f"v{k}") for k in (1, 2, 3))).where("v1 is not null and v2 is not null and v3 is not null")
    placed = wide.selectExpr("tile % 4 as scene_id", "tile div 4 + 4 * (tile % 4) as place", "pos", "v1", "v2", "v3", "(v1 + v2 + v3) div 3 as m")
    band = lambda k: f"if(least(v1, v2, v3) = 0, 0L, least(1023L, ((7 * m + 3 * v{k}) div 10) * (20 + scene_id) div 20 + 8 * scene_id)) as b{k}"
    return placed.selectExpr("scene_id", "(place % 8) * 8 + pos % 8 as x", "(place div 8) * 8 + pos div 8 as y", *map(band, (1, 2, 3)))


def pan_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = px(spark, sf_dir).where("scene_id = 0")
    both = F.array(*(F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in (0, 1) for j in (0, 1)))
    fine = one.select("*", F.explode(both).alias("o")).select("*", "o.i", "o.j")
    return fine.selectExpr("2 * x + i as x", "2 * y + j as y", "if(b1 = 0, 0L, greatest(1L, least(1023L, (299 * b1 + 587 * b2 + 114 * b3) div 1000 + (7 * x + 13 * y + 5 * i + 11 * j) % 41 - 20))) as pan")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").selectExpr("event_id", "ts as datetime", "195 + user_id % 3 as path", "136 + (user_id div 3) % 5 as row_no", "cast(least(100, floor(value)) as bigint) as cloud_cover", "-420 + (event_id % 40) * 2 as minx10", "-213 + ((event_id div 40) % 40) * 2 as miny10")
    return e.withColumn("id", F.expr("concat('CBERS4A_WPM', path, row_no, date_format(datetime, 'yyyyMMdd'), if(event_id % 2 = 0, 'ETC2', ''))"))


def aoi_edges(spark: SparkSession) -> DataFrame:
    rows = [(r, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for r, ring in enumerate(RINGS) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True) if a[1] != b[1]]
    return spark.createDataFrame(rows, "ring bigint, x1 double, y1 double, x2 double, y2 double")


_EDGES = ", ".join(f"({r}, {a[0]}.0::double, {a[1]}.0::double, {b[0]}.0::double, {b[1]}.0::double)" for r, ring in enumerate(RINGS) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True) if a[1] != b[1])

SQL = {
    "px": """
        select scene_id, (place % 8) * 8 + pos % 8 as x, (place // 8) * 8 + pos // 8 as y,
               case when low = 0 then 0 else least(1023, ((7 * m + 3 * v1) // 10) * (20 + scene_id) // 20 + 8 * scene_id) end as b1,
               case when low = 0 then 0 else least(1023, ((7 * m + 3 * v2) // 10) * (20 + scene_id) // 20 + 8 * scene_id) end as b2,
               case when low = 0 then 0 else least(1023, ((7 * m + 3 * v3) // 10) * (20 + scene_id) // 20 + 8 * scene_id) end as b3
        from (select tile % 4 as scene_id, tile // 4 + 4 * (tile % 4) as place, pos, v1, v2, v3, (v1 + v2 + v3) // 3 as m, least(v1, v2, v3) as low
              from (select vec_id // 3 as tile, pos, max(case when vec_id % 3 = 0 then dn end) as v1, max(case when vec_id % 3 = 1 then dn end) as v2, max(case when vec_id % 3 = 2 then dn end) as v3
                    from (select vec_id, pos, greatest(0, least(1023, floor((v + 0.32) * 1600)::bigint)) as dn
                          from (select vec_id, unnest(embedding)::double as v, generate_subscripts(embedding, 1) - 1 as pos from embeddings))
                    group by 1, 2)
              where v1 is not null and v2 is not null and v3 is not null)""",
    "pan_px": """
        select 2 * x + i as x, 2 * y + j as y,
               case when b1 = 0 then 0 else greatest(1, least(1023, (299 * b1 + 587 * b2 + 114 * b3) // 1000 + (7 * x + 13 * y + 5 * i + 11 * j) % 41 - 20)) end as pan
        from px, (values (0), (1)) a(i), (values (0), (1)) b(j) where scene_id = 0""",
    "scenes": """
        select *, 'CBERS4A_WPM' || path || row_no || strftime(datetime, '%Y%m%d') || case when event_id % 2 = 0 then 'ETC2' else '' end as id
        from (select event_id, ts as datetime, 195 + user_id % 3 as path, 136 + (user_id // 3) % 5 as row_no, least(100, floor(value))::bigint as cloud_cover,
                     -420 + (event_id % 40) * 2 as minx10, -213 + ((event_id // 40) % 40) * 2 as miny10 from events)""",
    "aoi_edges": f"select ring::bigint as ring, x1, y1, x2, y2 from (values {_EDGES}) t(ring, x1, y1, x2, y2)",
    "pl": "select *, (299 * b1 + 587 * b2 + 114 * b3) / 1000.0::double as luma, least(b1, b2, b3) > 0 as valid from px",
    "lit": "select *, (greatest(b1, b2, b3) - least(b1, b2, b3)) / greatest(luma, 1.0::double) as sat from pl where valid",
}
NEEDS = {"pan_px": ["px"], "pl": ["px"], "lit": ["pl"]}


def with_views(sql: str, *names: str, more: dict[str, str] | None = None) -> str:
    """`sql` after the views it names (and those they need), then its own."""
    every: list[str] = []

    def need(n: str) -> None:
        for m in NEEDS.get(n, []):
            need(m)
        if n not in every:
            every.append(n)

    for n in names:
        need(n)
    parts = [f"{n} as ({SQL[n]})" for n in every] + [f"{n} as ({q})" for n, q in (more or {}).items()]
    return f"with {', '.join(parts)} {sql}"
