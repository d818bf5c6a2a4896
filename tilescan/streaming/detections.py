"""Detections that arrive as CSV files.  The operators that aggregate by scene work on the stream as they do on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tilescan.operators import boxes
from tilescan.sources.files import COLUMNS, with_boxes


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The detections of the files that appear in ``folder``, each file once; rows without a box are left out."""
    stream = spark.readStream.option("header", True).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.csv").schema(COLUMNS)
    return with_boxes(stream.csv(folder))


def envelopes(stream: DataFrame, threshold: float = 0.5) -> DataFrame:
    """By scene the envelope, mean confidence and number of its confident detections so far; the state is a row a scene."""
    return boxes.envelope(boxes.confident(stream, threshold))


def keep_as_table(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that keeps ``path`` (Parquet) as the whole result after each trigger, until no new files are left.

    Each trigger writes a folder of its own number, so one that runs again after a failure writes the same folder anew.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/trigger={number}")

    return result.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The result after the last trigger; to be read while no query writes."""
    written = spark.read.parquet(path)
    last = written.agg({"trigger": "max"}).first()[0]
    return written.where(written["trigger"] == last).drop("trigger")
