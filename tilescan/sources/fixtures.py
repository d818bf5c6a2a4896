"""Views of the test tables in the shapes of scenes, detections, jobs, files and raster metadata.

Scenes grow in number with the tables: pixels are scenes of 32 x 32, one for four suppliers; detections one for each user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "pixels": """select cast(floor(l_suppkey / 4) as int) as scene_id, cast(l_orderkey % 32 as int) as r, cast(l_partkey % 32 as int) as c,
        max(cast(round(l_extendedprice * 100) as bigint)) as dn, max(case when l_quantity <= 5 then 1 else 0 end) as nodata
        from lineitem group by 1, 2, 3""",
    "detections": """select event_id as ordinal, concat('scene_', cast(user_id as {text}), '.tif') as filename,
        -118.75{d} + (175 * ((event_id * 37) % 61)) / 4096.0{d} as x0, 34.25{d} - (175 * ((event_id * 53) % 42) + 700) / 4096.0{d} as y0,
        -118.75{d} + (175 * ((event_id * 37) % 61) + 700) / 4096.0{d} as x1, 34.25{d} - (175 * ((event_id * 53) % 42)) / 4096.0{d} as y1,
        round(value / 500.0{d}, 6) as confidence from events where event_type <> 'signup'""",
    "scenes": """select s_suppkey as scene_id, cast(600 + s_suppkey * 53 % 3000 as int) as height, cast(1400 + s_suppkey * 97 % 4000 as int) as width from supplier""",
    "jobs": """select o_orderkey as job_id, concat('G', cast(o_custkey as {text})) as granule, o_orderstatus = 'F' as failed,
        o_orderdate < timestamp '1995-01-01 00:00:00' as expired, o_orderstatus as status, o_totalprice as cost, o_orderpriority as dem_name from orders""",
    "raster_meta": """select p_partkey as id, case when p_partkey % 3 = 0 then 'DEFLATE' when p_partkey % 3 = 1 then 'NONE' else null end as compress,
        case when p_size % 2 = 0 then 512 else 256 end as bx, case when p_size % 5 = 0 then 1 when p_size % 2 = 0 then 512 else 256 end as b_y,
        p_partkey % 7 = 0 as is_cog, p_partkey % 4 <> 0 as geographic, case when p_size < 10 then 'uint8' else 'float32' end as dtype,
        p_retailprice as vmax, p_partkey % 11 = 0 as marked from part""",
    "files": """select concat('G', cast(l_orderkey as {text})) as granule, concat('G', cast(l_orderkey as {text}), case l_partkey % 6 when 0 then '_VV.tif'
        when 1 then '_vv.tif' when 2 then '_VH.tif' when 3 then '_rgb.png' when 4 then '.png' else '.xml' end) as member from lineitem""",
}
SOURCE = {"scenes": "supplier", "pixels": "lineitem", "detections": "events", "jobs": "orders", "raster_meta": "part", "files": "lineitem"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(VIEWS[name].format(text="string", d="D").replace(f"from {SOURCE[name]}", "from {t}"), t=spark.read.parquet(f"{sf_dir}/{SOURCE[name]}.parquet"))


def sql_view(name: str) -> str:
    """The view as text for another SQL engine."""
    return VIEWS[name].format(text="varchar", d="::double")
