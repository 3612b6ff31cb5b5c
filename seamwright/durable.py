"""Tables written to the folder that driver and executors share, which end a lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where one machine is both (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    held = getattr(spark, "_seamwright_dir", None)
    if held is None:
        held = spark._seamwright_dir = tempfile.mkdtemp(prefix="seamwright-")
    return held


def durable(df: DataFrame, name: str, **options) -> DataFrame:
    """Writes df as Parquet under shared_dir() and reads it back: the lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/seamwright/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").options(compression="zstd", **options).parquet(path)
    _made(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _made(spark: SparkSession) -> list[str]:
    """The tables this session has written and not deleted, in order."""
    if not hasattr(spark, "_seamwright_made"):
        spark._seamwright_made = []
    return spark._seamwright_made


@contextmanager
def scratch(spark: SparkSession):
    """Deletes the tables that ``durable`` writes inside, but for the last one: what the block was for.

    For callers that know when nothing reads them any more; a DataFrame that was made inside and not written reads them."""
    made = _made(spark)
    before = len(made)
    yield
    discard(spark, made[before:-1])


def discard(spark: SparkSession, paths: list[str]) -> None:
    for path in list(paths):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _made(spark).remove(path)


def latest(spark: SparkSession) -> str:
    """The path of the table that was written last."""
    return _made(spark)[-1]
