"""Job planning, file choice and input checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(requests: DataFrame, jobs: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Each granule of ``requests`` with the first job (smallest ``job_id``) of just this granule that neither failed nor
    expired and has every wanted parameter; jobs may have more."""
    usable = jobs.where(~F.col("failed") & ~F.col("expired"))
    for key, value in wanted.items():
        usable = usable.where(F.element_at("params", key).eqNullSafe(F.lit(value)))
    return requests.join(usable.groupBy("granule").agg(F.min("job_id").alias("job_id")), "granule", "left")


def plan(requests: DataFrame, jobs: DataFrame, wanted: dict[str, str], cost: float | None) -> DataFrame:
    """One row: granules asked for, with a job, without, and what the latter cost."""
    m = first_match(requests, jobs, wanted).agg(F.count(F.lit(1)).alias("requested"), F.count("job_id").alias("existing"))
    new = F.col("requested") - F.col("existing")
    return m.select("requested", "existing", new.alias("new"), (new * F.lit(cost).cast("double")).alias("cost"))


def job_name(granule: Column) -> Column:
    return F.concat(F.lit("RTC_"), F.right(granule, F.lit(8)))


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))


def cost_of(costs: DataFrame, job_type: str, resolution: int) -> DataFrame:
    """The cost of a job type at a resolution in a table (job_type, cost_table: map); null if unknown."""
    return costs.where(F.col("job_type") == job_type).select(F.try_element_at("cost_table", F.lit(str(resolution))).alias("cost"))


def wanted_file(name: Column) -> Column:
    low = F.lower(name)
    return low.endswith("_vv.tif") | (low.endswith(".png") & ~low.contains("rgb"))


def chosen_files(files: DataFrame) -> DataFrame:
    """Members to extract (granule, member), with their new name and folder; only a lower-case .tif is filed as a raster."""
    low, base = F.lower("member"), F.element_at(F.split("member", "/"), -1)
    ending = F.regexp_extract("member", r"(\.[^.]*)$", 1)
    name = F.when(low.endswith(".tif"), F.concat("granule", ending)).when(low.endswith(".png"), F.concat(F.col("granule"), F.lit("_browse"), ending)).otherwise(base)
    return files.where(wanted_file(F.col("member"))).select("granule", "member", name.alias("new_name"), F.when(F.col("member").endswith(".tif"), "tif").otherwise("png").alias("folder"))


def missing(todo: DataFrame, there: DataFrame, key: str) -> DataFrame:
    return todo.join(there.select(key), key, "left_anti")


def scene_id(filename: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(filename, "/"), -1), r"\.[^.]*$", "")
    return F.split(stem, "_Cal|_ML|_Spk|_TC|_Orb|_processed")[0]


def preprocessed_score(meta: DataFrame) -> DataFrame:
    """Evidence that a raster was preprocessed: rows (tags: map, compress, bx, b_y, width, height, is_cog, geographic, dtype,
    vmin, vmax) with ``score``; above 0 counts as preprocessed."""
    keys, values = F.map_keys("tags"), F.lower(F.concat_ws(" ", F.map_values("tags")))
    marked = F.arrays_overlap(F.transform(keys, lambda k: F.lower(k)), F.array(*map(F.lit, ("preprocessed", "land_masked", "normalized", "processed"))))
    tags = F.when(F.exists(keys, lambda k: F.lower(k).contains("software")), -1).otherwise(0) + F.when(values.rlike("gamma|snap|esa|hyp3"), -2).otherwise(0)
    packed = F.when(F.col("compress").isNotNull() & ~F.upper("compress").isin("NONE", ""), 2).otherwise(0)
    strips = F.when(F.col("b_y") == 1, -1).otherwise(0) + F.when((F.col("bx") >= F.col("width")) & (F.col("b_y") >= F.col("height")), -1).otherwise(0)
    tiled = F.when((F.col("bx") == 512) & (F.col("b_y") == 512), 2).otherwise(strips)
    cog = F.when(F.col("is_cog"), -2).otherwise(0)
    crs = F.when(F.col("geographic"), 1).when(F.col("geographic").isNull(), 0).otherwise(-1)
    kind = F.when(F.col("dtype").contains("int"), 2).when((F.col("vmin") >= 0) & (F.col("vmax") <= 255.1), 1).when((F.col("vmax") > 1000) | (F.col("vmin") < -1000), -1).otherwise(0)
    return meta.withColumn("score", F.when(F.coalesce(marked, F.lit(False)), 10).otherwise(tags + packed + tiled + cog + crs + kind).cast("int"))


def preprocessed_files(headers: DataFrame, strict: bool = False) -> DataFrame:
    """``headers`` (``raster.profiles``) with ``score`` and ``preprocessed``; a file that cannot be read has no score and is not.
    With ``strict`` a file that is not preprocessed raises."""
    out = preprocessed_score(headers.withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,string>")))).withColumn("score", F.when(F.col("error").isNull(), F.col("score")))
    good = F.coalesce(F.col("score") > 0, F.lit(False))
    if strict:
        good = F.when(good, True).otherwise(F.raise_error(F.concat(F.col("path"), F.lit(": "), F.coalesce("error", F.lit("not preprocessed")))).cast("boolean"))
    return out.withColumn("preprocessed", good)


def found_and_new(requests: DataFrame, jobs: DataFrame, wanted: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The granules that have a usable job, with it, and those that have none."""
    matched = first_match(requests, jobs, wanted)
    return matched.where("job_id is not null"), matched.where("job_id is null").select("granule", job_name(F.col("granule")).alias("job_name"))


def account(jobs: DataFrame, credits: float | None) -> DataFrame:
    """One row: all jobs, what they cost, and the credits that remain (null if the service does not say)."""
    return jobs.agg(F.count(F.lit(1)).alias("n_jobs"), F.sum("cost").alias("cost")).withColumn("credits", F.lit(credits).cast("double"))


def first_raster(files: DataFrame) -> DataFrame:
    """The first raster of each granule among its files (granule, path, ordinal)."""
    return files.where(F.lower("path").endswith(".tif")).groupBy("granule").agg(F.min_by("path", "ordinal").alias("path"))


def default_parameters() -> Column:
    """The settings of a job that nobody gave any, as a map of texts."""
    from tilescan.config import JOB_PARAMETERS

    return F.create_map(*(F.lit(x if isinstance(x, str) else str(x).lower()) for pair in JOB_PARAMETERS.items() for x in pair))
