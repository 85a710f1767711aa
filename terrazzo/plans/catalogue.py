"""Queries of the scene catalogue, band files and batch states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.functions import text
from terrazzo.operators import catalog
from terrazzo.registry import query
from terrazzo.sources import ingest
from terrazzo.sources.views import read, scenes, with_views

BOX = (-41.0, -20.0, -39.0, -19.0)
MEET = "minx10 < -390 and minx10 + 5 > -410 and miny10 < -190 and miny10 + 5 > -200"


def _day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query(with_views(f"select event_id, id, cloud_cover from scenes where {MEET} and datetime::date between '2024-01-05' and '2024-12-20' and cloud_cover <= 40 order by cloud_cover, datetime, event_id limit 50", "scenes"))
def scene_search(spark: SparkSession, d: str) -> DataFrame:
    return catalog.search(scenes(spark, d), BOX, "2024-01-05", "2024-12-20", 40, 50).select("event_id", "id", "cloud_cover")


@query(with_views(f"select event_id, id, {_day('datetime')} as day from scenes where {MEET} and datetime::date between '2024-01-10' and '2024-01-20'", "scenes"))
def stac_search(spark: SparkSession, d: str) -> DataFrame:
    return catalog.stac_search(scenes(spark, d), BOX, "2024-01-10/2024-01-20").select("event_id", "id", day("datetime").alias("day"))


@query(with_views("select event_id, 'https://data.example/' || id || '/tci.tif' as href from scenes where event_id % 3 = 0", "scenes"))
def asset_select(spark: SparkSession, d: str) -> DataFrame:
    link = lambda n: F.concat(F.lit("https://data.example/"), F.col("id"), F.lit(f"/{n}.tif"))
    assets = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("thumb"), link("thumb"), F.lit("tci"), link("tci"))).otherwise(F.create_map(F.lit("thumb"), link("thumb")))
    s = scenes(spark, d).select("event_id", assets.alias("assets"))
    return s.where(F.map_contains_key("assets", "tci")).select("event_id", F.element_at("assets", "tci").alias("href"))


@query(with_views("select path, row_no, event_id, id, cloud_cover from (select *, row_number() over (partition by path, row_no order by cloud_cover nulls last, datetime, event_id) as r from scenes) where r = 1", "scenes"))
def best_scene(spark: SparkSession, d: str) -> DataFrame:
    return catalog.best_scene(scenes(spark, d)).select("path", "row_no", "event_id", "id", "cloud_cover")


@query(with_views("select path, row_no, event_id from (select *, rank() over (partition by path, row_no order by cloud_cover, datetime) as r from scenes) where r = 1", "scenes"))
def best_scene_ties(spark: SparkSession, d: str) -> DataFrame:
    return catalog.best_scene_ties(scenes(spark, d)).select("path", "row_no", "event_id")


@query(with_views("select event_id from scenes where exists (select 1 from (values (-415, -210, -405, -200), (-400, -195, -396, -185)) a(l, b, r, t) where minx10 < r and minx10 + 5 > l and miny10 < t and miny10 + 5 > b)", "scenes"))
def scenes_in_aoi(spark: SparkSession, d: str) -> DataFrame:
    areas = spark.createDataFrame([(-415, -210, -405, -200), (-400, -195, -396, -185)], "left long, bottom long, right long, top long")
    return catalog.within_area(scenes(spark, d), areas).select("event_id")


_AREA = [(0, -415, -212, -400, -205), (0, -400, -205, -404, -190), (0, -404, -190, -415, -212), (1, -380, -180, -372, -181), (1, -372, -181, -376, -170), (1, -376, -170, -380, -180)]
_BY_EDGES = f"""
with_scenes as (select event_id, minx10 as l, miny10 as b, minx10 + 5 as r, miny10 + 5 as t from scenes),
e as (select polygon, x1::double as x1, y1::double as y1, x2::double as x2, y2::double as y2 from (values {", ".join(map(str, _AREA))}) v(polygon, x1, y1, x2, y2)),
through as (select distinct event_id from with_scenes, e where greatest(0, case when x2 > x1 then (l - x1) / (x2 - x1) when x2 < x1 then (r - x1) / (x2 - x1) else 0 end, case when y2 > y1 then (b - y1) / (y2 - y1) when y2 < y1 then (t - y1) / (y2 - y1) else 0 end)
    < least(1, case when x2 > x1 then (r - x1) / (x2 - x1) when x2 < x1 then (l - x1) / (x2 - x1) else 1 end, case when y2 > y1 then (t - y1) / (y2 - y1) when y2 < y1 then (b - y1) / (y2 - y1) else 1 end)),
round as (select event_id from with_scenes, e where (y1 > (b + t) / 2) <> (y2 > (b + t) / 2) and (l + r) / 2 < (x2 - x1) * ((b + t) / 2 - y1) / (y2 - y1) + x1 group by event_id, polygon having count(*) % 2 = 1)
select event_id from through union select event_id from round"""


@query(with_views("", "scenes").rstrip() + ", " + _BY_EDGES.lstrip())
def scenes_in_polygons(spark: SparkSession, d: str) -> DataFrame:
    edges = spark.createDataFrame([(p, *map(float, c)) for p, *c in _AREA], "polygon bigint, x1 double, y1 double, x2 double, y2 double")
    return catalog.within_polygons(scenes(spark, d), edges).select("event_id")


@query(with_views("select event_id, substr(id, 12, 3) as path, substr(id, 15, 3) as row_no, substr(id, 18, 8) as day from scenes", "scenes"))
def scene_parts(spark: SparkSession, d: str) -> DataFrame:
    part = lambda k: text.strict_scene_part(F.col("id"), k)
    return scenes(spark, d).select("event_id", part(1).alias("path"), part(2).alias("row_no"), part(3).alias("day"))


_PREFIX = "'CBERS_4A_WPM_' || substr(id, 18, 8) || '_' || substr(id, 12, 3)::int || '_' || substr(id, 15, 3)::int"


@query(with_views(f"select event_id, {_PREFIX} as prefix from scenes", "scenes"))
def band_prefix(spark: SparkSession, d: str) -> DataFrame:
    return scenes(spark, d).select("event_id", text.band_prefix(F.col("id")).alias("prefix"))


@query(with_views(f"select distinct id, band, 'data/' || id || '/' || {_PREFIX} || '_L4_BAND' || n || '.tif' as path from scenes, (values ('pan', 0), ('blue', 1), ('green', 2), ('red', 3)) b(band, n)", "scenes"))
def band_paths(spark: SparkSession, d: str) -> DataFrame:
    each = catalog.required(scenes(spark, d))
    return each.select("id", "band", catalog.band_path(F.col("id"), F.col("band"), "data").alias("path"))


LISTING = """select id, ['pan', 'blue', 'green', 'red'][event_id % 4 + 1] as band, 'p' || event_id % 7 || '/' || id || '_' || event_id || '.tif' as path, event_id % 2 as priority, case when event_id % 5 = 0 then 0 else event_id end as length from scenes"""
FILES = {"ls": LISTING, "fl": "select id, band, path from (select *, row_number() over (partition by id, band order by priority, path) as r from ls where length > 0) where r = 1"}


def listing(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    band = F.element_at(F.array(*map(F.lit, ("pan", "blue", "green", "red"))), (e % 4 + 1).cast("int"))
    path = F.concat(F.lit("p"), (e % 7).cast("string"), F.lit("/"), F.col("id"), F.lit("_"), e.cast("string"), F.lit(".tif"))
    return scenes(spark, d).select("id", band.alias("band"), path.alias("path"), (e % 2).alias("priority"), F.when(e % 5 == 0, 0).otherwise(e).alias("length"))


@query(with_views("select id, band, path from fl", "scenes", more=FILES))
def band_lookup(spark: SparkSession, d: str) -> DataFrame:
    return catalog.band_files(listing(spark, d))


@query(with_views("select id, band, count(*) as files, count_if(length > 0)::bigint as usable from ls group by 1, 2", "scenes", more=FILES))
def raster_validity(spark: SparkSession, d: str) -> DataFrame:
    return listing(spark, d).groupBy("id", "band").agg(F.count("*").alias("files"), F.count_if(F.col("length") > 0).alias("usable"))


_REQUIRED = {**FILES, "rq": "select distinct id, band from scenes, (values ('red'), ('green'), ('blue'), ('pan')) b(band)"}


@query(with_views("select id, band from rq anti join fl using (id, band)", "scenes", more=_REQUIRED))
def missing_bands(spark: SparkSession, d: str) -> DataFrame:
    return catalog.missing_bands(scenes(spark, d), catalog.band_files(listing(spark, d)))


_STATUS = {
    **FILES,
    "wd": "select id, " + ", ".join(f"max(path) filter (band = '{b}') as {b}" for b in ("red", "green", "blue", "pan")) + " from fl group by 1",
    "pr": "select id, max(case when event_id % 11 = 0 then 'rgb/' || id || '.tif' end) as rgb0, max(case when event_id % 13 = 0 then 'sharp/' || id || '.tif' end) as sharp0 from scenes group by 1",
    "j": "select i.id, red, green, blue, pan, coalesce(rgb0, case when red is not null and green is not null and blue is not null then 'out/TRUE_COLOR_' || i.id || '.tif' end) as rgb, sharp0 from (select distinct id from scenes) i left join wd using (id) left join pr using (id)",
}


def _status_sql(dry: bool) -> str:
    made = "''" if dry else "case when rgb is not null and pan is not null then 'out/PANSHARP_' || id || '.tif' else '' end"
    last = "dry_run_criaria_pansharp" if dry else "pansharp_criado"
    return with_views("select id as scene_id, " + ", ".join(f"coalesce({b}, '') as {b}" for b in ("red", "green", "blue", "pan", "rgb")) + f", coalesce(sharp0, {made}) as pansharp, case when sharp0 is not null then 'pansharp_existente' when rgb is null or pan is null then 'sem_pansharp_por_falta_de_rgb_ou_pan' else '{last}' end as status from j", "scenes", more=_STATUS)


def _status(spark: SparkSession, d: str, dry: bool) -> DataFrame:
    s = scenes(spark, d)
    made = lambda n, kind, folder: s.where(F.col("event_id") % n == 0).select("id", F.lit(kind).alias("kind"), F.concat(F.lit(f"{folder}/"), F.col("id"), F.lit(".tif")).alias("path"))
    return catalog.batch_status(s, catalog.band_files(listing(spark, d)), made(11, "rgb", "rgb").unionByName(made(13, "pansharp", "sharp")), dry)


@query(_status_sql(False))
def scene_status(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d, False)


@query(_status_sql(True))
def scene_status_dry_run(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d, True)


@query("select c_custkey as attempt, least(60, 5 * c_custkey) as wait from customer")
def retry_schedule(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("attempt"), ingest.wait_seconds(F.col("c_custkey")).alias("wait"))


_STATES = ", ".join(f"('{uf}', '{code}', '{name}')" for uf, (code, name) in text.STATES.items())
_WANTED = "select * from (values (' são paulo '), ('ES'), ('espirito santo'), ('032'), ('99'), ('Goiás'), ('df'), ('nowhere')) w(wanted)"


@query(f"with s as (select * from (values {_STATES}) t(uf, code, name)), w as ({_WANTED}) select wanted, case when regexp_full_match(trim(wanted), '\\d+') then regexp_replace(trim(wanted), '^0+', '') else (select code from s where lower(uf) = k or strip_accents(lower(name)) = k) end as code from (select wanted, strip_accents(lower(trim(wanted))) as k from w)")
def state_lookup(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.createDataFrame([(w,) for w in (" são paulo ", "ES", "espirito santo", "032", "99", "Goiás", "df", "nowhere")], "wanted string")
    return ingest.normalise_state(wanted, ingest.state_lookup(spark))


@query(f"select name, strip_accents(lower(trim(name))) as plain from (values {_STATES}) t(uf, code, name)")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return ingest.state_lookup(spark).select("name", "plain")


@query("select page_id, split_part(string_split(url, '?')[1], '/', -1) as base, regexp_replace(split_part(string_split(url, '?')[1], '/', -1), '\\.[^.]*$', '') as stem, contains(url, 'http') as web from pages")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    base = text.basename(F.col("url"))
    return read(spark, d, "pages").select("page_id", base.alias("base"), text.stem(base).alias("stem"), F.contains("url", F.lit("http")).alias("web"))


@query(with_views("select event_id, 'TRUE_COLOR_' || id as rgb, 'PANSHARP_' || id as pansharp, 'base_' || id || '.tif' as file from scenes", "scenes"))
def name_templates(spark: SparkSession, d: str) -> DataFrame:
    named = lambda t: F.format_string(t, "id")
    return scenes(spark, d).select("event_id", named("TRUE_COLOR_%s").alias("rgb"), named("PANSHARP_%s").alias("pansharp"), named("base_%s.tif").alias("file"))


@query(with_views("select event_id, id, cloud_cover from scenes", "scenes"))
def feature_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows as GeoJSON features, and flattened again."""
    s = scenes(spark, d)
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("id"), F.struct("event_id", "cloud_cover", "path", "row_no").alias("properties")))
    back = s.select(F.from_json(feature, "id string, properties struct<event_id: bigint, cloud_cover: bigint>").alias("f"))
    return back.select("f.properties.event_id", "f.id", "f.properties.cloud_cover")


@query("select 'a' as name, 'Polygon' as kind, 5::bigint as points union all select 'b', 'Polygon', 4::bigint")
def geojson_explode(spark: SparkSession, d: str) -> DataFrame:
    raw = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"name":"a"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}},{"type":"Feature","properties":{"name":"b"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[2,0],[1,1],[0,0]]]}}]}'
    shape = "features array<struct<properties: struct<name: string>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    f = spark.range(1).select(F.explode(F.from_json(F.lit(raw), shape)["features"]).alias("f"))
    return f.select("f.properties.name", F.col("f.geometry.type").alias("kind"), F.size(F.col("f.geometry.coordinates")[0]).cast("long").alias("points"))


@query(with_views("select path, count(*) as scenes, count(distinct row_no) as rows_, min(cloud_cover) as least_cloud from scenes group by 1", "scenes"))
def folder_counts(spark: SparkSession, d: str) -> DataFrame:
    return scenes(spark, d).groupBy("path").agg(F.count("*").alias("scenes"), F.countDistinct("row_no").alias("rows_"), F.min("cloud_cover").alias("least_cloud"))
