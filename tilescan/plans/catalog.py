"""The registered queries over the test tables, each with the SQL that another engine runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilescan.functions import geometry as G
from tilescan.functions import pixels as P
from tilescan.operators import boxes, frames, jobs, land, pixels, polygons, previews, scoring, transforms, windows
from tilescan.sources import raster
from tilescan.sources.fixtures import sql_view, view

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

# fixed values: the sample scene's size and georeference
SCENE = {"width": 11326, "height": 7975}
TRANSFORM = [0.000269494585235856, 0.0, -118.79701057395, 0.0, -0.000269494585235856, 34.1688213687152]
SIDE, WIN, STRIDE = 32, 16, 4
WANTED = {"dem_name": "1-URGENT"}


def query(sql: str | None = None, *uses: str):
    """Registers a query under its function's name.  ``sql`` may name the views that it ``uses``."""

    def put(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            body = sql.strip()
            if uses:
                lead = "with recursive" if body.startswith("with recursive") else "with"
                body = f"{lead} {', '.join(f'{u} as ({sql_view(u)})' for u in uses)}" + (", " + body.removeprefix("with recursive").removeprefix("with").lstrip() if body.startswith("with") else " " + body)
            _sql[f.__name__] = body
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pixels with nulls for nodata."""
    return view(spark, sf_dir, "pixels").withColumn("dn", F.when(F.col("nodata") == 0, F.col("dn")))


MASKED = "m as (select scene_id, r, c, case when nodata = 0 then dn end as dn from pixels)"


def sql_iou(a: str, b: str) -> str:
    s = f"cos(radians((({a}.y0 + {a}.y1) / 2 + ({b}.y0 + {b}.y1) / 2) / 2))"
    lo = lambda k: f"(({k}.x0 + {k}.x1) / 2 - ({k}.x1 - {k}.x0) / 2 * {s})"
    hi = lambda k: f"(({k}.x0 + {k}.x1) / 2 + ({k}.x1 - {k}.x0) / 2 * {s})"
    i = f"(greatest(0.0::double, least({hi(a)}, {hi(b)}) - greatest({lo(a)}, {lo(b)})) * greatest(0.0::double, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))"
    u = f"({s} * (({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0) + ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0)) - {i})"
    return f"(case when {u} > 0 then {i} / {u} else 0.0 end)"


def sql_nms(threshold: float) -> str:
    return f"""with recursive ranked as (
      select filename, {{'confidence': confidence, 'ordinal': ordinal, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} as b,
             row_number() over (partition by filename order by confidence desc, ordinal desc) as k from detections),
    steps as (
      select filename, k, [b] as kept from ranked where k = 1
      union all
      select s.filename, d.k, case when len(list_filter(s.kept, lambda q: {sql_iou("q", "d.b")} > {threshold})) > 0 then s.kept else list_append(s.kept, d.b) end
      from steps s join ranked d on d.filename = s.filename and d.k = s.k + 1),
    done as (select filename, arg_max(kept, k) as kept from steps group by filename),
    flat as (select filename, unnest(kept) as b, unnest(range(len(kept))) as rank from done)
    select filename, rank::bigint as rank, b.confidence as confidence, b.ordinal as ordinal, b.x0 as x0, b.y0 as y0, b.x1 as x1, b.y1 as y1 from flat"""


@query(sql_nms(0.05), "detections")
def nms_per_scene(spark: SparkSession, d: str) -> DataFrame:
    return boxes.suppressed(view(spark, d, "detections"), 0.05)


@query(
    f"""select a.filename as filename, a.ordinal as a, b.ordinal as b, round({sql_iou("a", "b")}, 9) as iou
    from detections a join detections b on a.filename = b.filename and a.ordinal < b.ordinal where {sql_iou("a", "b")} > 0.0""",
    "detections",
)
def pairwise_iou(spark: SparkSession, d: str) -> DataFrame:
    return boxes.pairwise_iou(view(spark, d, "detections")).withColumn("iou", F.round("iou", 9))


@query("select filename, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, round(avg(confidence), 6) as confidence, count(*) as n from detections group by filename", "detections")
def scene_envelope(spark: SparkSession, d: str) -> DataFrame:
    return boxes.envelope(view(spark, d, "detections")).withColumn("confidence", r6("confidence"))


@query(
    """with t as (select event_id as id, case event_id % 6 when 0 then concat('[', event_id, ' 2.5 3 4 ]') when 1 then concat(event_id, ' 2.5   3 4') when 2 then '1 2 3'
       when 3 then 'a b c d' when 4 then '' else '[1 2 3 4 5]' end as bbox from events),
    p as (select id, list_transform(regexp_split_to_array(trim(trim(trim(bbox), '[]')), '\\s+'), lambda x: try_cast(x as double)) as n from t)
    select id, n[1] as x0, n[2] as y0, n[3] as x1, n[4] as y1 from p where len(n) = 4 and len(list_filter(n, lambda x: x is null)) = 0"""
)
def bbox_parse(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    text = F.when(i % 6 == 0, F.concat(F.lit("["), i.cast("string"), F.lit(" 2.5 3 4 ]"))).when(i % 6 == 1, F.concat(i.cast("string"), F.lit(" 2.5   3 4"))).when(i % 6 == 2, "1 2 3").when(i % 6 == 3, "a b c d").when(i % 6 == 4, "").otherwise("[1 2 3 4 5]")
    parsed = spark.read.parquet(f"{d}/events.parquet").select(i.alias("id"), G.parse_box(text).alias("b")).where("b is not null")
    return parsed.select("id", *(F.col("b")[k].alias(n) for k, n in enumerate(boxes.BOX)))


@query("select filename, arg_max(ordinal, {'c': confidence, 'o': ordinal}) as ordinal, max(confidence) as confidence from detections where confidence >= 0.5 group by filename", "detections")
def confidence_filter_topk(spark: SparkSession, d: str) -> DataFrame:
    return boxes.best_per_scene(boxes.confident(view(spark, d, "detections"), 0.5)).select("filename", "ordinal", "confidence")


@query(sql_nms(0.05).replace("rank::bigint as rank, ", "").replace("b.ordinal as ordinal, ", ""), "detections")
def merge_three_stage(spark: SparkSession, d: str) -> DataFrame:
    # with the default thresholds the later stages leave every box as it is
    return boxes.merged(view(spark, d, "detections")).drop("rank", "ordinal")


@query()
def merge_three_stage_wide(spark: SparkSession, d: str) -> DataFrame:
    """Thresholds at which all three stages act.  Growing unions have no SQL; the tests hold them against areas counted on a
    fine grid, and against the figures of the sample scene."""
    return boxes.merged(view(spark, d, "detections"), 0.5, 0.3, 0.1)


@query("select d.ordinal, d.filename, printf('%s_detection_%03d_conf_%s.png', replace(filename, '.tif', ''), (row_number() over (partition by filename order by ordinal) - 1)::int, round(confidence::decimal(18, 6), 3)::decimal(18, 3)::varchar) as crop from detections d", "detections")
def crop_names(spark: SparkSession, d: str) -> DataFrame:
    return boxes.crop_names(boxes.scene_windows(view(spark, d, "detections")), F.col("i")).select("ordinal", "filename", "crop")


GRID = "g as (select s.scene_id, r.v::int as row_off, c.v::int as col_off, (r.v // 175 * ((s.width - 700) // 175 + 1) + c.v // 175)::bigint as i from scenes s, unnest(range(0, s.height - 699, 175)) as r(v), unnest(range(0, s.width - 699, 175)) as c(v))"


@query(f"with {GRID} select * from g", "scenes")
def window_grid(spark: SparkSession, d: str) -> DataFrame:
    return windows.grid(view(spark, d, "scenes"), 700, 175)


@query(
    f"""with {GRID}, b as (select *, {TRANSFORM[2]}::double + {TRANSFORM[0]}::double * col_off as x, {TRANSFORM[5]}::double - {TRANSFORM[0]}::double * row_off as y from g)
    select scene_id, i, row_off, col_off, col_off as c0, row_off as r0, col_off + 700 as c1, row_off + 700 as r1, round(x::float::double, 4) as lon_min, round((y - {TRANSFORM[0]}::double * 700)::float::double, 4) as lat_min,
    round((x + {TRANSFORM[0]}::double * 700)::float::double, 4) as lon_max, round(y::float::double, 4) as lat_max, round(x, 6) as origin_x, round(y, 6) as origin_y, round({TRANSFORM[0]}::double, 12) as pixel from b""",
    "scenes",
)
def window_geo_bbox(spark: SparkSession, d: str) -> DataFrame:
    """Pixel box, all four sides in degrees, and the transform of every window."""
    g = windows.geo_boxes(windows.grid(view(spark, d, "scenes"), 700, 175), TRANSFORM, 700)
    sides = [F.round(F.col("bbox_geo")[k].cast("double"), 4).alias(n) for k, n in enumerate(("lon_min", "lat_min", "lon_max", "lat_max"))]
    return g.select("scene_id", "i", "row_off", "col_off", *(F.col("bbox")[k].alias(n) for k, n in enumerate(("c0", "r0", "c1", "r1"))), *sides, r6(F.col("transform")[2]).alias("origin_x"), r6(F.col("transform")[5]).alias("origin_y"), F.round(F.col("transform")[0], 12).alias("pixel"))


@query(f"with {GRID} select scene_id, row_off, col_off, row_number() over (order by scene_id, row_off, col_off) - 1 as n, concat(scene_id, '_win', row_number() over (order by scene_id, row_off, col_off) - 1) as name from g", "scenes")
def window_names(spark: SparkSession, d: str) -> DataFrame:
    return raster.numbered(windows.grid(view(spark, d, "scenes"), 700, 175)).select("scene_id", "row_off", "col_off", "n", "name")


@query(
    f"""with w as (select s.scene_id, a.v as row_off, b.v as col_off from (select distinct scene_id from pixels) s,
      (select unnest(range(0, {SIDE - WIN + 1}, {STRIDE})) as v) a, (select unnest(range(0, {SIDE - WIN + 1}, {STRIDE})) as v) b),
    n as (select w.scene_id, row_off, col_off, {WIN * WIN} - sum(case when p.nodata = 0 then 1 else 0 end) as n_nodata from w left join pixels p
      on p.scene_id = w.scene_id and p.r >= row_off and p.r < row_off + {WIN} and p.c >= col_off and p.c < col_off + {WIN} group by all)
    select scene_id, row_off::int as row_off, col_off::int as col_off, (row_off / {STRIDE} * {(SIDE - WIN) // STRIDE + 1} + col_off / {STRIDE})::bigint as i, n_nodata::bigint as n_nodata from n where n_nodata < 0.35 * {WIN * WIN}""",
    "pixels",
)
def window_nodata_filter(spark: SparkSession, d: str) -> DataFrame:
    px = view(spark, d, "pixels")
    scenes = px.select("scene_id").distinct().withColumn("height", F.lit(SIDE)).withColumn("width", F.lit(SIDE))
    return windows.mostly_valid(windows.nodata_counts(px, scenes, WIN, STRIDE), WIN, 0.35)


@query("select scene_id, case when coalesce(bool_or(r < 16 and c < 16 and dn - 200000 < -9000), false) then -9999.0 else 0.0 end::double as nodata from pixels group by scene_id", "pixels")
def nodata_detect(spark: SparkSession, d: str) -> DataFrame:
    return pixels.nodata_value(view(spark, d, "pixels").withColumn("dn", F.col("dn") - 200000), 16)


@query(
    """with a as (select *, max(nodata) over (partition by scene_id, r order by c range between 2 preceding and 2 following) as across from pixels)
    select scene_id, r, c, max(across) over (partition by scene_id, c order by r range between 2 preceding and 2 following) as masked from a""",
    "pixels",
)
def dilate_mask(spark: SparkSession, d: str) -> DataFrame:
    return pixels.dilated(view(spark, d, "pixels"), 2).select("scene_id", "r", "c", "masked")


def _pct(p: float) -> str:
    return f"quantile_cont(dn::double, {p / 100}) as p"


@query(f"with {MASKED}, q as (select scene_id, min(dn)::double as lo, {_pct(90)} from m group by scene_id) select scene_id, r, c, round(case when dn is not null then greatest(lo, least(dn::double, p)) end, 6) as dn from m join q using (scene_id)", "pixels")
def percentile_clip(spark: SparkSession, d: str) -> DataFrame:
    return pixels.percentile_clipped(masked(spark, d), 0, 90).select("scene_id", "r", "c", r6("dn").alias("dn"))


@query(f"with {MASKED} select scene_id, r, c, round(case when dn is not null then greatest(-35.0, 10 * log10(dn / 1e7 + 1e-10)) end, 6) as dn from m", "pixels")
def db_convert(spark: SparkSession, d: str) -> DataFrame:
    return pixels.in_decibels(masked(spark, d).withColumn("dn", F.col("dn") / F.lit(1e7))).select("scene_id", "r", "c", r6("dn").alias("dn"))


def _stretch_sql(top: int) -> str:
    return f"with {MASKED}, q as (select scene_id, min(dn)::double as lo, {_pct(99)} from m group by scene_id) select scene_id, r, c, (case when dn is null then 0 when lo = p then 1 else least({top}, greatest(0, round_even((dn - lo) / (p - lo) * {top - 1}, 0)::bigint + 1)) end)::int as dn from m join q using (scene_id)"


@query(_stretch_sql(255), "pixels")
def scale_uint8(spark: SparkSession, d: str) -> DataFrame:
    return pixels.stretched(masked(spark, d), 255).select("scene_id", "r", "c", "dn")


@query(_stretch_sql(65535), "pixels")
def scale_uint16_stretch(spark: SparkSession, d: str) -> DataFrame:
    return pixels.stretched(masked(spark, d), 65535).select("scene_id", "r", "c", "dn")


U16 = f"{MASKED}, q as (select scene_id, min(dn)::double as lo, max(dn)::double as hi from m group by scene_id), u as (select m.*, lo, hi, coalesce(round_even((dn - lo) / case when lo = hi then 1.0 else hi - lo end * 65535, 0)::int, 0) as dn16 from m join q using (scene_id)), e as (select *, case when dn16 > 0 then dn16 / 65535.0::double * case when lo = hi then 1.0 else hi - lo end + lo end as value from u)"


@query(f"with {U16} select scene_id, r, c, dn16 from u", "pixels")
def scale_uint16(spark: SparkSession, d: str) -> DataFrame:
    return pixels.in_uint16(masked(spark, d)).select("scene_id", "r", "c", "dn16")


@query(f"with {U16} select scene_id, r, c, round(value, 4) as value from e", "pixels")
def expand_uint16(spark: SparkSession, d: str) -> DataFrame:
    return pixels.expanded(pixels.in_uint16(masked(spark, d))).select("scene_id", "r", "c", F.round("value", 4).alias("value"))


@query(f"with {MASKED}, q as (select scene_id, {_pct(90)} from m group by scene_id) select scene_id, r, c, case when dn <= p then dn end as dn from m join q using (scene_id)", "pixels")
def outlier_exclude(spark: SparkSession, d: str) -> DataFrame:
    return pixels.outliers_removed(masked(spark, d), 90).select("scene_id", "r", "c", "dn")


@query(f"with {MASKED}, q as (select scene_id, {_pct(90)} from m group by scene_id) select scene_id, r, c, round(case when dn is not null then least(dn::double, p) end, 6) as dn from m join q using (scene_id)", "pixels")
def clamp_top(spark: SparkSession, d: str) -> DataFrame:
    return pixels.top_clamped(masked(spark, d), 90).select("scene_id", "r", "c", r6("dn").alias("dn"))


@query(f"with {U16} select scene_id, count(*) as n, round(corr(dn::double, value), 6) as correlation, round(sqrt(avg((dn - value) * (dn - value))), 4) as rmse from e where dn is not null and value is not null group by scene_id", "pixels")
def roundtrip_stats(spark: SparkSession, d: str) -> DataFrame:
    return pixels.agreement(pixels.expanded(pixels.in_uint16(masked(spark, d))), "dn", "value").select("scene_id", "n", r6("correlation").alias("correlation"), F.round("rmse", 4).alias("rmse"))


@query(
    f"""with {MASKED}, b as (select scene_id, dn::double as a, case when dn is not null then least(dn, 5000000) end::double as b from m), s as (select scene_id, min(a) as lo, max(a) as hi from b group by scene_id),
    h as (select scene_id, bin, sum(ca) as ca, sum(cb) as cb, any_value(w) as w from (
      select b.scene_id, least(49, floor((a - lo) / ((hi - lo) / 50))) as bin, 1 as ca, 0 as cb, (hi - lo) / 50 as w from b join s using (scene_id) where a is not null
      union all select b.scene_id, least(49, floor((b.b - lo) / ((hi - lo) / 50))), 0, 1, (hi - lo) / 50 from b join s using (scene_id) where b.b between lo and hi) group by all),
    k as (select scene_id, greatest(1e-12, ca / (sum(ca) over (partition by scene_id) * w)) as da, greatest(1e-12, cb / (sum(cb) over (partition by scene_id) * w)) as db from h)
    select scene_id, round(sum(da * ln(da / db)) * 1e6, 6) as kl from k group by scene_id""",
    "pixels",
)
def hist_kl(spark: SparkSession, d: str) -> DataFrame:
    both = masked(spark, d).withColumn("a", F.col("dn").cast("double")).withColumn("b", F.when(F.col("a").isNotNull(), F.least(F.col("a"), F.lit(5000000.0))))
    return pixels.divergence(both, "a", "b").select("scene_id", F.round(F.col("kl") * 1e6, 6).alias("kl"))


TILES = f"""{MASKED}, t as (select scene_id, r // 8 as tr, c // 8 as tc, r, c, dn::double as v, min(dn::double) over w as lo, max(dn::double) over w as hi, count(dn) over w as n, count(*) over w as here from m window w as (partition by scene_id, r // 8, c // 8))"""


@query(f"with {TILES} select scene_id, tr::bigint as tr, tc::bigint as tc, round(sum(case when hi > lo then (v - lo) / (hi - lo) else v end), 6) as total from t where n > 0 group by 1, 2, 3", "pixels")
def tile_minmax_norm(spark: SparkSession, d: str) -> DataFrame:
    t = pixels.tiles(masked(spark, d), 8).withColumn("t", P.tile_normalised(F.col("tile"), nan_policy="ignore"))
    return t.where(F.exists("tile", lambda x: x.isNotNull())).select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), r6(F.aggregate(P.filled(F.col("t")), F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query(f"with {TILES} select scene_id, tr::bigint as tr, tc::bigint as tc, round(sum(coalesce(v, 0) / 1e12) * case when sum(coalesce(v, 0) / 1e12) / 64 < 1e-5 then 10 else 1 end, 6) as total from t group by 1, 2, 3", "pixels")
def tile_boost(spark: SparkSession, d: str) -> DataFrame:
    t = pixels.tiles(masked(spark, d), 8).withColumn("t", P.boosted(F.transform(P.filled(F.col("tile")), lambda x: x / 1e12)))
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), r6(F.aggregate("t", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query(f"with {TILES}, k as (select scene_id, tr, tc, count(*) as here, bool_and(v is not null) as whole, sum(case when hi > lo then (v - lo) / (hi - lo) else v end) as s from t group by 1, 2, 3) select scene_id, tr::bigint as tr, tc::bigint as tc, round(case when whole and here = 64 then s else 0 end, 6) as total from k", "pixels")
def tile_minmax_propagated(spark: SparkSession, d: str) -> DataFrame:
    """The other policy: a tile with one missing pixel is all zeros."""
    t = pixels.tiles(masked(spark, d), 8).withColumn("t", P.filled(P.tile_normalised(F.col("tile"))))
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), r6(F.aggregate("t", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query(f"with {MASKED}, t as (select scene_id, r // 8 as tr, c // 8 as tc, case when (r // 8 + c // 8) % 3 = 0 then 0 else dn end as v, dn is null as gone from m) select scene_id, tr::bigint as tr, tc::bigint as tc, count(*) = 64 and bool_and(not gone and v = 0) as all_zero, bool_or(not gone and v = 0) as some_zero from t group by 1, 2, 3", "pixels")
def zero_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Tiles that are zero everywhere, and anywhere; nodata is not zero."""
    blank = masked(spark, d).withColumn("dn", F.when(F.col("dn").isNotNull(), F.when((F.expr("r div 8") + F.expr("c div 8")) % 3 == 0, 0).otherwise(F.col("dn"))))
    t = raster.zero_images(pixels.tiles(blank, 8).withColumnRenamed("tile", "image"))
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), "all_zero", F.exists("image", lambda x: F.coalesce(x == 0, F.lit(False))).alias("some_zero"))


@query(
    f"""with {TILES}, k as (select a.v as i, b.v as j from (select unnest(range(5)) as v) a, (select unnest(range(5)) as v) b),
    g as (select distinct scene_id, tr, tc from t), s as (select g.scene_id, g.tr, g.tc, (t.v / 1e4 - 2.341661e-09) / (1123.6694 - 2.341661e-09) as v from g cross join k left join t on t.scene_id = g.scene_id and t.r = g.tr * 8 + i * 8 // 5 and t.c = g.tc * 8 + j * 8 // 5),
    n as (select *, min(v) over w as lo, max(v) over w as hi from s window w as (partition by scene_id, tr, tc)), u as (select scene_id, tr, tc, case when v is null then 0 when hi > lo then (v - lo) / (hi - lo) else v end as u from n)
    select scene_id, tr::bigint as tr, tc::bigint as tc, round(sum(u) * case when sum(u) / 25 < 1e-5 then 10 else 1 end, 6) as total from u group by 1, 2, 3""",
    "pixels",
)
def contrastive_transform(spark: SparkSession, d: str) -> DataFrame:
    """Resize, global range, own range, boost, zeros for nodata."""
    t = transforms.contrastive_input(pixels.tiles(masked(spark, d), 8), 8, 5, nan_policy="ignore")
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), r6(F.aggregate("tile", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query(
    f"""with {MASKED}, q as (select scene_id, r // 8 as tr, c // 8 as tc, min(dn)::double as lo, quantile_cont(dn::double, 0.99) as hi, count(dn) as n from m group by 1, 2, 3),
    k as (select a.v as i, b.v as j from (select unnest(range(5)) as v) a, (select unnest(range(5)) as v) b),
    x as (select q.*, m.dn, case when n = 0 then 0 when lo = hi then 128 when dn is null then 0 else floor((least(dn::double, hi) - lo) / (hi - lo) * 254 + 1) end as b from q cross join k left join m on m.scene_id = q.scene_id and m.r = tr * 8 + i * 8 // 5 and m.c = tc * 8 + j * 8 // 5),
    y as (select scene_id, tr, tc, count(*) filter (dn is null) as n_masked, sum(case when dn is null then -5.0 else (b / 255.0::double - 0.5) / 0.25 end) + sum(case when dn is null then -5.0 else (b / 255.0::double - 0.25) / 0.5 end) as s from x group by 1, 2, 3)
    select scene_id, tr::bigint as tr, tc::bigint as tc, (2 * n_masked)::bigint as n_masked, round(s, 6) as total from y""",
    "pixels",
)
def feature_transform(spark: SparkSession, d: str) -> DataFrame:
    """Bytes, equal channels, resize, standardisation, and nodata put back by its own resized mask."""
    t = transforms.feature_input(pixels.tiles(masked(spark, d), 8), 8, 5, -5.0, [0.5, 0.25], [0.25, 0.5])
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), F.size(F.filter("tile", lambda x: x == -5.0)).cast("long").alias("n_masked"), r6(F.aggregate("tile", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query(f"with {MASKED} select scene_id, r, c, round((dn / 1e4 - 2.341661e-09) / (1123.6694 - 2.341661e-09), 6) as dn from m", "pixels")
def global_minmax(spark: SparkSession, d: str) -> DataFrame:
    return masked(spark, d).select("scene_id", "r", "c", r6(P.global_normalised(F.col("dn") / F.lit(1e4))).alias("dn"))


@query(
    f"with {MASKED}, t as (select scene_id, r // 8 as tr, c // 8 as tc, min(dn)::double as lo, quantile_cont(dn::double, 0.99) as hi, count(dn) as n from m group by 1, 2, 3), "
    "x as (select t.scene_id, tr, tc, sum(case when n = 0 then 0 when lo = hi then 0 when dn is null then 0 else floor((least(dn::double, hi) - lo) / (hi - lo) * 254 + 1) end) as s, any_value(n > 0 and lo = hi) as flat from m join t on t.scene_id = m.scene_id and tr = r // 8 and tc = c // 8 group by 1, 2, 3) "
    "select scene_id, tr::bigint as tr, tc::bigint as tc, (case when flat then 8192 else s end)::bigint as total from x",
    "pixels",
)
def clip_uint8(spark: SparkSession, d: str) -> DataFrame:
    t = pixels.tiles_to_uint8(pixels.tiles(masked(spark, d), 8))
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), F.aggregate("tile8", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query(f"with {MASKED}, g as (select scene_id, r // 8 as tr, c // 8 as tc from m group by 1, 2, 3), k as (select a.v as i, b.v as j from (select unnest(range(5)) as v) a, (select unnest(range(5)) as v) b) select g.scene_id, g.tr::bigint as tr, g.tc::bigint as tc, count(m.dn) as n, coalesce(sum(m.dn), 0)::double as total from g cross join k left join m on m.scene_id = g.scene_id and m.r = tr * 8 + i * 8 // 5 and m.c = tc * 8 + j * 8 // 5 group by 1, 2, 3", "pixels")
def resize_nearest(spark: SparkSession, d: str) -> DataFrame:
    t = pixels.resized(pixels.tiles(masked(spark, d), 8), 8, 5)
    return t.select("scene_id", F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), F.size(F.filter("tile", lambda x: x.isNotNull())).cast("long").alias("n"), F.aggregate(P.filled(F.col("tile")), F.lit(0.0), lambda s, x: s + x).alias("total"))


def job_table(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "jobs").withColumn("params", F.create_map(F.lit("dem_name"), "dem_name", F.lit("extra"), F.lit("1")))


def requests(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("granule"))


FIRST = "with q as (select concat('G', c_custkey::varchar) as granule from customer), f as (select q.granule, min(j.job_id) as job_id from q left join jobs j on j.granule = q.granule and not failed and not expired and dem_name = '1-URGENT' group by q.granule)"


@query(f"{FIRST} select granule, job_id, concat('RTC_', right(granule, 8)) as job_name from f", "jobs")
def job_first_match(spark: SparkSession, d: str) -> DataFrame:
    return jobs.first_match(requests(spark, d), job_table(spark, d), WANTED).withColumn("job_name", jobs.job_name(F.col("granule")))


@query(f"{FIRST} select count(*) as requested, count(job_id) as existing, count(*) - count(job_id) as new, (count(*) - count(job_id)) * 15.0::double as cost from f", "jobs")
def job_plan(spark: SparkSession, d: str) -> DataFrame:
    return jobs.plan(requests(spark, d), job_table(spark, d), WANTED, 15.0)


@query("select status, count(*) as n, round(sum(cost), 2) as cost from jobs group by status", "jobs")
def job_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return jobs.status_counts(view(spark, d, "jobs")).withColumn("cost", F.round("cost", 2))


@query("select c.res::int as resolution, case c.res when 10 then 60.0 when 20 then 15.0 end::double as cost, n from (select unnest([10, 20, 30]) as res) c join (select p_size % 3 * 10 + 10 as res, count(*) as n from part group by 1) p on p.res = c.res")
def job_cost(spark: SparkSession, d: str) -> DataFrame:
    """The cost of each resolution that is asked for; null where the table has none."""
    costs = spark.range(1).select(F.lit("RTC_GAMMA").alias("job_type"), F.create_map(F.lit("10"), F.lit(60.0), F.lit("20"), F.lit(15.0)).alias("cost_table"))
    asked = spark.read.parquet(f"{d}/part.parquet").groupBy((F.col("p_size") % 3 * 10 + 10).cast("int").alias("resolution")).agg(F.count(F.lit(1)).alias("n"))
    looked = [jobs.cost_of(costs, "RTC_GAMMA", r).select(F.lit(r).alias("resolution"), "cost") for r in (10, 20, 30)]
    return asked.join(looked[0].unionByName(looked[1]).unionByName(looked[2]), "resolution").select("resolution", "cost", "n")


@query(f"{FIRST} select granule, job_id, case when job_id is null then concat('RTC_', right(granule, 8)) end as job_name from f", "jobs")
def job_found_or_new(spark: SparkSession, d: str) -> DataFrame:
    """The two halves of a plan, one after the other."""
    found, new = jobs.found_and_new(requests(spark, d), job_table(spark, d), WANTED)
    return found.select("granule", "job_id", F.lit(None).cast("string").alias("job_name")).unionByName(new.select("granule", F.lit(None).cast("long").alias("job_id"), "job_name"))


@query("select count(*) as n_jobs, round(sum(cost), 2) as cost, 1000.0::double as credits from jobs", "jobs")
def job_account(spark: SparkSession, d: str) -> DataFrame:
    return jobs.account(view(spark, d, "jobs"), 1000.0).withColumn("cost", F.round("cost", 2))


@query(
    """with p as (select unnest(['dem_name', 'resolution', 'radiometry', 'scale', 'speckle_filter', 'dem_matching', 'include_dem', 'include_inc_map', 'include_rgb', 'include_scattering_area']) as name,
    unnest(['copernicus', '30', 'sigma0', 'power', 'true', 'false', 'false', 'false', 'false', 'false']) as value) select name, value, (select count(*) from customer) as n_requests from p"""
)
def job_default_parameters(spark: SparkSession, d: str) -> DataFrame:
    """The settings that requests without any get, with the number of requests."""
    asked = requests(spark, d).withColumn("params", jobs.default_parameters())
    return asked.select(F.explode("params").alias("name", "value")).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n_requests"))


@query("select granule, min(member) as path from files where lower(member) like '%.tif' group by granule", "files")
def first_raster_of_granule(spark: SparkSession, d: str) -> DataFrame:
    """The first raster of each granule's files in the order of their names."""
    return jobs.first_raster(view(spark, d, "files").select("granule", F.col("member").alias("path"), F.col("member").alias("ordinal")))


@query("select distinct granule, concat('/out/', replace(replace(member, '.tif', ''), '.png', ''), '_processed.tif') as processed, concat('/prev/', replace(replace(member, '.tif', ''), '.png', ''), '_preview.png') as preview from files where member not like '%.xml'", "files")
def output_paths(spark: SparkSession, d: str) -> DataFrame:
    f = view(spark, d, "files").where(~F.col("member").endswith(".xml"))
    return f.select("granule", previews.processed_path("/out", F.concat(F.lit("/in/"), "member"), "_processed").alias("processed"), previews.preview_path("/prev/", F.concat(F.lit("/in/"), "member")).alias("preview")).distinct()


SOURCES = "(select concat('scene_', c_custkey, '.tif') as filename from customer where c_custkey % 3 <> 0)"


def source_files(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").where(k % 3 != 0).select(F.concat(F.lit("/data/scene_"), k.cast("string"), F.lit(".tif")).alias("path"))


@query(f"select ordinal, filename, confidence from detections where confidence >= 0.5 and filename in (select filename from {SOURCES})", "detections")
def detections_with_sources(spark: SparkSession, d: str) -> DataFrame:
    """Confident detections whose raster is there, by base name."""
    return previews.with_sources(boxes.confident(view(spark, d, "detections"), 0.5), source_files(spark, d)).select("ordinal", "filename", "confidence")


@query(f"select filename, count(*) as n from detections where confidence >= 0.5 and filename not in (select filename from {SOURCES}) group by filename", "detections")
def detections_without_sources(spark: SparkSession, d: str) -> DataFrame:
    return previews.without_sources(boxes.confident(view(spark, d, "detections"), 0.5), source_files(spark, d))


@query("select filename, count(*) as n from detections group by filename", "detections")
def distinct_files(spark: SparkSession, d: str) -> DataFrame:
    return previews.distinct_files(view(spark, d, "detections"))


@query("select ordinal, filename, round(x0::float::double, 6) as x0, round(y0::float::double, 6) as y0, round(x1::float::double, 6) as x1, round(y1::float::double, 6) as y1, confidence from detections", "detections")
def detection_rows(spark: SparkSession, d: str) -> DataFrame:
    """Boxes through the text of the detections' file (floats separated by blanks) and back."""
    v = view(spark, d, "detections").withColumn("b", G.parse_box(G.box_text(F.array(*(F.col(c).cast("float") for c in boxes.BOX)))))
    return v.select("ordinal", "filename", *(r6(F.col("b")[k].cast("float").cast("double")).alias(c) for k, c in enumerate(boxes.BOX)), "confidence")


CHOSEN = "select granule, member, case when lower(member) like '%.tif' then concat(granule, regexp_extract(member, '(\\.[^.]*)$', 1)) else concat(granule, '_browse', regexp_extract(member, '(\\.[^.]*)$', 1)) end as new_name, case when member like '%.tif' then 'tif' else 'png' end as folder from files where lower(member) like '%\\_vv.tif' escape '\\' or (lower(member) like '%.png' and not contains(lower(member), 'rgb'))"


@query(CHOSEN, "files")
def file_select_rename(spark: SparkSession, d: str) -> DataFrame:
    return jobs.chosen_files(view(spark, d, "files"))


@query("select distinct granule from files where granule not in (select granule from files where member like '%_vv.tif')", "files")
def skip_existing(spark: SparkSession, d: str) -> DataFrame:
    f = view(spark, d, "files")
    return jobs.missing(f.select("granule").distinct(), f.where(F.col("member").endswith("_vv.tif")), "granule")


@query("select distinct granule as scene, concat('/a/', granule, '_Cal_ML.tif') as path from files", "files")
def scene_id(spark: SparkSession, d: str) -> DataFrame:
    paths = view(spark, d, "files").select(F.concat(F.lit("/a/"), "granule", F.lit("_Cal_ML.tif")).alias("path")).distinct()
    return paths.select(jobs.scene_id(F.col("path")).alias("scene"), "path")


@query(
    """select id, (case when marked then 10 else -1 + case when is_cog then -2 else 0 end + case when coalesce(compress, 'NONE') <> 'NONE' then 2 else 0 end
      + case when bx = 512 and b_y = 512 then 2 else case when b_y = 1 then -1 else 0 end end + case when geographic then 1 else -1 end
      + case when dtype = 'uint8' then 2 when vmax > 1000 then -1 else 0 end end)::int as score from raster_meta""",
    "raster_meta",
)
def preprocessed_score(spark: SparkSession, d: str) -> DataFrame:
    tags = F.when(F.col("marked"), F.create_map(F.lit("Processed"), F.lit("x"))).otherwise(F.create_map(F.lit("SOFTWARE"), F.lit("own")))
    meta = view(spark, d, "raster_meta").withColumn("tags", tags).withColumn("width", F.lit(4096)).withColumn("height", F.lit(4096)).withColumn("vmin", F.lit(0.0))
    return jobs.preprocessed_score(meta).select("id", "score")


LOGITS = "l as (select vec_id as id, list_transform([0, 1, 2], lambda j: round(list_sum(list_transform(embedding, lambda x, i: x::double * (((i - 1) * 7 + j * 13) % 11 - 5) / 2)), 9)) as z from embeddings), p as (select id, z, list_max(z) as top, list_sum(list_transform(z, lambda x: exp(x - list_max(z)))) as s from l), y as (select id, (list_position(z, top) - 1)::int as prediction, round(1 / s, 6) as confidence from p)"


def weight(k: int, j: int) -> float:
    """A linear layer's weight of component k for class j."""
    return ((k * 7 + j * 13) % 11 - 5) / 2


def logits(spark: SparkSession, d: str) -> DataFrame:
    layer = [F.array(*(F.lit(weight(k, j)) for k in range(64))) for j in range(3)]
    z = [F.round(F.aggregate(F.zip_with("embedding", w, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x), 9) for w in layer]
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.array(*z).alias("logits"))


@query(f"with {LOGITS} select * from y")
def softmax_argmax(spark: SparkSession, d: str) -> DataFrame:
    return scoring.predicted(logits(spark, d)).select("id", "prediction", r6("confidence").alias("confidence"))


@query(f"with {LOGITS} select id, concat('s', id % 7, '.tif') as filename, confidence from y where prediction = 1")
def positive_filter(spark: SparkSession, d: str) -> DataFrame:
    scored = scoring.predicted(logits(spark, d)).withColumn("path", F.concat(F.lit("/data/s"), (F.col("id") % 7).cast("string"), F.lit(".tif")))
    return scoring.positives(scored, 1).select("id", "filename", r6("confidence").alias("confidence"))


@query(f"with {LOGITS} select * from y")
def linear_detector(spark: SparkSession, d: str) -> DataFrame:
    """The same scores from the detector plug-in."""
    weights = [[weight(k, j) for k in range(64)] for j in range(3)]
    tiles = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("image"))
    return scoring.inferred(tiles, scoring.detector("linear", weights=weights)).select("id", "prediction", r6("confidence").alias("confidence"))


@query(
    """with s as (select concat('layer', p_partkey) as name, [p_size, 3] as shape from part where p_partkey % 5 <> 0),
    w as (select concat('layer', p_partkey) as name, [case when p_partkey % 7 = 0 then 0 else p_size end, 3] as shape from part where p_partkey % 3 <> 0)
    select case when s.name is null then 'absent' when w.name is null then 'unused' when s.shape = w.shape then 'loaded' else 'mismatched' end as status, count(*) as n from s full outer join w on s.name = w.name group by 1"""
)
def state_dict_match(spark: SparkSession, d: str) -> DataFrame:
    part, k = spark.read.parquet(f"{d}/part.parquet"), F.col("p_partkey")
    name = F.concat(F.lit("layer"), k.cast("string")).alias("name")
    stored = part.where(k % 5 != 0).select(name, F.array("p_size", F.lit(3)).alias("shape"))
    wanted = part.where(k % 3 != 0).select(name, F.array(F.when(k % 7 == 0, 0).otherwise(F.col("p_size")), F.lit(3)).alias("shape"))
    return scoring.matched_weights(stored, wanted)


@query(
    f"""with {MASKED}, land as (select n_nationkey % 7 + 1 as scene_id, n_nationkey % 5 * 9.5 as x0, n_nationkey % 6 * 7.0 as y0, n_nationkey % 5 * 9.5 + 12 as x1, n_nationkey % 6 * 7.0 + 8.5 as y1 from nation)
    select scene_id, r, c, case when not exists (select 1 from land l where l.scene_id = m.scene_id and c + 0.5 >= x0 and c + 0.5 < x1 and r + 0.5 >= y0 and r + 0.5 < y1) then dn end as dn from m""",
    "pixels",
)
def land_bbox_mask(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    land = spark.read.parquet(f"{d}/nation.parquet").select((k % 7 + 1).alias("scene_id"), (k % 5 * 9.5).alias("x0"), (k % 6 * 7.0).alias("y0"), (k % 5 * 9.5 + 12).alias("x1"), (k % 6 * 7.0 + 8.5).alias("y1"))
    return pixels.rectangles_masked(masked(spark, d), land).select("scene_id", "r", "c", "dn")


@query(
    f"""with p as (select ordinal, filename, {SCENE["width"]} as width, {SCENE["height"]} as height, floor((x0 - {TRANSFORM[2]}::double) / {TRANSFORM[0]}::double + 0.1) as c, floor((y1 - {TRANSFORM[5]}::double) / {TRANSFORM[4]}::double + 0.1) as r,
      floor((x1 - x0) / {TRANSFORM[0]}::double + 0.5) as w, floor((y0 - y1) / {TRANSFORM[4]}::double + 0.5) as h from detections),
    k as (select *, greatest(0, c - 32) as c0, greatest(0, r - 32) as r0, least(width, greatest(0, c - 32) + w + 64) as c1, least(height, greatest(0, r - 32) + h + 64) as r1 from p),
    e as (select *, case when c1 - c0 < 900 then least(width, greatest(0, c0 - floor((900 - (c1 - c0)) / 2)) + 900) else c1 end as ce, case when r1 - r0 < 900 then least(height, greatest(0, r0 - floor((900 - (r1 - r0)) / 2)) + 900) else r1 end as re from k where c1 > c0 and r1 > r0),
    s as (select *, case when c1 - c0 < 900 then greatest(0, ce - 900) else c0 end as cs, case when r1 - r0 < 900 then greatest(0, re - 900) else r0 end as rs from e)
    select ordinal, filename, cs::bigint as col_off, rs::bigint as row_off, (ce - cs)::bigint as win_w, (re - rs)::bigint as win_h from s""",
    "detections",
)
def preview_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 900 pixels at least, so that those at the right and lower edge move back."""
    boxes_in = view(spark, d, "detections").withColumn("width", F.lit(SCENE["width"])).withColumn("height", F.lit(SCENE["height"]))
    return windows.preview_windows(boxes_in, TRANSFORM, 32, 900).select("ordinal", "filename", "col_off", "row_off", "win_w", "win_h")


LAND = """land as (select n_nationkey % 7 + 1 as scene_id, n_nationkey, n_nationkey % 5 * 9.5::double as x, n_nationkey % 6 * 7.0::double as y from nation),
    sides as (select scene_id, n_nationkey, x as x0, y as y0, x + 14.25::double as x1, y + 5.25::double as y1 from land
      union all select scene_id, n_nationkey, x + 14.25::double, y + 5.25::double, x + 3.5::double, y + 16.75::double from land
      union all select scene_id, n_nationkey, x + 3.5::double, y + 16.75::double, x, y from land),
    hits as (select m.scene_id, r, c, n_nationkey from m join sides s on s.scene_id = m.scene_id and (y0 <= r + 0.5) <> (y1 <= r + 0.5)
      and c + 0.5 >= x0 + (r + 0.5::double - y0) * (x1 - x0) / (y1 - y0) group by all having count(*) % 2 = 1)"""


@query(
    f"""with {MASKED}, {LAND}
    select scene_id, r, c, case when not exists (select 1 from hits h where h.scene_id = m.scene_id and h.r = m.r and h.c = m.c) then dn end as dn from m""",
    "pixels",
)
def land_polygon_mask(spark: SparkSession, d: str) -> DataFrame:
    return polygons.polygons_masked(masked(spark, d), triangles(spark, d)).select("scene_id", "r", "c", "dn")


def triangles(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = k % 5 * F.lit(9.5), k % 6 * F.lit(7.0)
    corner = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    rings = spark.read.parquet(f"{d}/nation.parquet").select((k % 7 + 1).alias("scene_id"), k.alias("polygon"), F.array(corner(0.0, 0.0), corner(14.25, 5.25), corner(3.5, 16.75)).alias("points"))
    return polygons.sides(rings)


@query(
    f"""with {MASKED}, {LAND},
    lines as (select *, unnest(range(floor(least(y0, y1))::bigint, floor(greatest(y0, y1))::bigint + 1)) as r from sides),
    ends as (select *, x0 + (greatest(least(y0, y1), r::double) - y0) * (x1 - x0) / (y1 - y0) as xa, x0 + (least(greatest(y0, y1), r + 1.0::double) - y0) * (x1 - x0) / (y1 - y0) as xb from lines),
    runs as (select scene_id, r, floor(greatest(least(x0, x1), least(xa, xb))) as c0, floor(least(greatest(x0, x1), greatest(xa, xb))) as c1 from ends)
    select scene_id, r, c, case when not exists (select 1 from hits h where h.scene_id = m.scene_id and h.r = m.r and h.c = m.c)
      and not exists (select 1 from runs h where h.scene_id = m.scene_id and h.r = m.r and m.c between h.c0 and h.c1) then dn end as dn from m""",
    "pixels",
)
def land_touched_mask(spark: SparkSession, d: str) -> DataFrame:
    return polygons.polygons_masked(masked(spark, d), triangles(spark, d), all_touched=True).select("scene_id", "r", "c", "dn")


@query(
    f"""with {MASKED}, {LAND},
    a as (select scene_id, r, c, case when not exists (select 1 from hits h where h.scene_id = m.scene_id and h.r = m.r and h.c = m.c) then dn end as dn from m),
    w as (select *, max((dn is null)::int) over (partition by scene_id, r order by c range between 1 preceding and 1 following) as across from a),
    g as (select scene_id, r, c, case when max(across) over (partition by scene_id, c order by r range between 1 preceding and 1 following) = 0 then dn end as dn from w),
    q as (select scene_id, min(dn)::double as lo, {_pct(95)} from g group by scene_id)
    select scene_id, r, c, round(case when dn is not null then greatest(-35.0, 10 * log10(greatest(lo, least(dn::double, p)) + 1e-10)) end, 6) as dn from g join q using (scene_id)""",
    "pixels",
)
def frame_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Land mask, nodata grown by a pixel, percentile clip, decibels."""
    config = {"clip_percentile": 95, "dilate_px": 1, "convert_to_db": True, "save_masked": True, "masked_dtype": "float32", "compress": "DEFLATE"}
    return frames.preprocessed(masked(spark, d).select("scene_id", "r", "c", "dn"), config, triangles(spark, d)).select("scene_id", "r", "c", r6("dn").alias("dn"))


@query(f"with {MASKED}, {LAND}, e as (select scene_id, r, c, case when not exists (select 1 from hits h where h.scene_id = m.scene_id and h.r = m.r and h.c = m.c) then dn end as dn from m) select scene_id, r, c, coalesce(dn::float, 0)::double as zeros, coalesce(dn::float, -9999)::double as sentinel from e", "pixels")
def sink_values(spark: SparkSession, d: str) -> DataFrame:
    """What files of floats hold: nodata as 0, and as -9999."""
    sea = polygons.polygons_masked(masked(spark, d).select("scene_id", "r", "c", "dn"), triangles(spark, d))
    both = frames.as_type(sea.withColumn("raw", F.col("dn")), "float32")
    return both.select("scene_id", "r", "c", F.col("dn").cast("double").alias("zeros"), F.coalesce(F.col("raw").cast("float"), F.lit(-9999.0)).cast("double").alias("sentinel"))


@query(
    """with p as (select c_custkey as id, -120 + c_custkey % 6000 / 1000.0::double as lon, c_custkey % 17 * 4.5::double - 36 as lat from customer)
    select id, round(lon, 6) as lon, round(lat, 6) as lat, true as same from p"""
)
def projection_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Longitude and latitude to UTM zone 11 and back."""
    k = F.col("c_custkey")
    p = spark.read.parquet(f"{d}/customer.parquet").select(k.alias("id"), (F.lit(-120.0) + k % 6000 / 1000.0).alias("lon"), (k % 17 * 4.5 - 36).alias("lat"))
    epsg = F.when(F.col("lat") < 0, 32711).otherwise(32611)
    x, y = land.from_lonlat(epsg, F.col("lon"), F.col("lat"))
    lon, lat = land.to_lonlat(epsg, F.col("x"), F.col("y"))
    back = p.withColumn("x", x).withColumn("y", y).withColumn("lon1", lon).withColumn("lat1", lat)
    return back.select("id", r6("lon").alias("lon"), r6("lat").alias("lat"), ((F.abs(F.col("lon") - F.col("lon1")) < 1e-8) & (F.abs(F.col("lat") - F.col("lat1")) < 1e-8)).alias("same"))


@query(
    f"""with s as (select *, {TRANSFORM[2]}::double as lon0, {TRANSFORM[5]}::double - {TRANSFORM[0]}::double * height as lat0, {TRANSFORM[2]}::double + {TRANSFORM[0]}::double * width as lon1, {TRANSFORM[5]}::double as lat1 from scenes),
    l as (select n_nationkey as polygon, -119.0 + n_nationkey * 0.08::double as x0, 33.3 + n_nationkey % 7 * 0.12::double as y0, -118.85 + n_nationkey * 0.08::double as x1, 33.4 + n_nationkey % 7 * 0.12::double as y1 from nation)
    select s.scene_id, l.polygon::int as polygon, round(greatest(x0, lon0), 6) as x0, round(greatest(y0, lat0), 6) as y0, round(least(x1, lon1), 6) as x1, round(least(y1, lat1), 6) as y1
    from s join l on l.x0 < s.lon1 and s.lon0 < l.x1 and l.y0 < s.lat1 and s.lat0 < l.y1""",
    "scenes",
)
def land_clipped_to_scenes(spark: SparkSession, d: str) -> DataFrame:
    """The bounds of each polygon's part within each scene."""
    k = F.col("n_nationkey")
    x0, y0, x1, y1 = F.lit(-119.0) + k * 0.08, F.lit(33.3) + k % 7 * 0.12, F.lit(-118.85) + k * 0.08, F.lit(33.4) + k % 7 * 0.12
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    rings = spark.read.parquet(f"{d}/nation.parquet").select(k.alias("polygon"), F.lit(0).alias("ring"), F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1)).alias("points"))
    scenes = view(spark, d, "scenes").withColumn("transform", F.array(*map(F.lit, TRANSFORM))).withColumn("epsg", F.lit(4326))
    cut = land.clipped(rings, land.footprints(scenes))
    bound = lambda f, a: r6(f(F.transform("points", lambda p: p[a])))
    return cut.select("scene_id", "polygon", bound(F.array_min, "x").alias("x0"), bound(F.array_min, "y").alias("y0"), bound(F.array_max, "x").alias("x1"), bound(F.array_max, "y").alias("y1"))


@query(f"with {MASKED}, g as (select s.scene_id, a.v::int as r, b.v::int as c from (select distinct scene_id from m) s, (select unnest(range({SIDE})) as v) a, (select unnest(range({SIDE})) as v) b) select scene_id, r, c, dn::float::double as dn from g left join m using (scene_id, r, c)", "pixels")
def tiff_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pixels as blocks, as compressed files, and read back; what is absent or nodata is null."""
    px = masked(spark, d)
    scenes = px.select("scene_id").distinct().withColumn("width", F.lit(SIDE)).withColumn("height", F.lit(SIDE))
    back = raster.through_files(raster.from_pixels(px, scenes, SIDE), side=SIDE)
    return raster.pixels(back, SIDE).select("scene_id", "r", "c", F.col("dn").cast("double").alias("dn"))
