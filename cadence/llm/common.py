"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import scratch_dir, ship_package

#: Rows per Arrow batch: the memory bound of a Python task is this times the longest text.
ARROW_ROWS = 256
#: Words are maximal runs of anything but these ASCII blanks.
BLANKS = r"[ \t\n\x0B\f\r]+"


def prepared(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers and bound Arrow batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def staged(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: cuts
    the lineage, survives lost executors, and is computed one time only."""
    path = scratch_dir(df.sparkSession, purpose) + "/t"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def words_array(col):
    """Non-empty words of a string column, JVM side."""
    return F.filter(F.split(col, BLANKS), lambda w: w != "")


def shard_count(rows: int, per_shard: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / per_shard))
