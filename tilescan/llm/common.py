"""What the operators of this package share: the shared folder, cut lineage, texts of batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tilescan.functions.workers import ship

__all__ = ["as_bytes", "cut", "discard", "made", "shared_dir", "ship", "table", "texts"]

_own_dir: list[str] = []
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a folder of our own where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="tilescan-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return "file://" + _own_dir[0]


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tilescan-{uuid.uuid4().hex}"
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many tables ``cut`` has written."""
    return len(_made)


def discard(spark: SparkSession, since: int) -> None:
    """Removes the tables that ``cut`` wrote after the first ``since``, but for the last one; to be called by what had them
    written, when nothing else of it is to be read."""
    old, _made[since:] = _made[since:-1], _made[since:][-1:]
    for path in old:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column; a null is an empty text."""
    return ["" if x is None else x for x in batch.column(name).to_pylist()]


def as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]
