"""Sinks: routed output (S5), result append (S6), tile store (S11), model
save / load (S13), console (S12).  All writes are idempotent per batch id
when used from ``foreachBatch``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUTE_PREFIX = "ml."


def route_by_model(df: DataFrame, model: str = "ML_model", prefix: str = ROUTE_PREFIX) -> DataFrame:
    """Routing key from each row's header: ``prefix + model``."""
    return df.withColumn("route", F.concat(F.lit(prefix), F.col(model)))


def write_routed(df: DataFrame, path: str | None, route: str = "route", fmt: str = "parquet", options: dict | None = None) -> str | None:
    """One folder per route (``route=<key>``).  With ``fmt="kafka"`` (the
    connector on the classpath) the route becomes each message's ``topic`` and
    ``value`` its payload; ``options`` carry the broker settings."""
    if fmt == "parquet":
        df.write.mode("append").partitionBy(route).parquet(path)
        return path
    out = df.select(F.col(route).alias("topic"), F.col("value").cast("binary").alias("value"))
    out.write.format(fmt).options(**(options or {})).save()
    return path


def append_results(data: DataFrame, path: str, batch_id: int | None = None) -> str:
    """Append (sess_id, time_in, time_ms, class) to the ``data`` table,
    partitioned by day of ``time_in`` (the hypertable's time partitioning).
    With ``batch_id`` the write replaces only that batch's folders below its
    days, so a replayed micro-batch does not duplicate rows and a reader of
    one day lists that day only."""
    out = data.withColumn("day", F.to_date("time_in"))
    if batch_id is None:
        out.write.mode("append").partitionBy("day").parquet(path)
    else:
        own = out.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(path)
    return path


def write_tiles(tiles: DataFrame, path: str, key: str = "recording_id", buckets: int | None = None) -> str:
    """Tile store keyed by recording.

    ``buckets=None``: one folder per recording (``key=<id>``), as the
    reference keeps one file per recording.  With many recordings pass
    ``buckets``: a fixed number of ``tile_bucket`` folders (hash of the key),
    the key kept as a column.  Either way no shuffle: each task writes its own
    rows, sorted by recording, so a recording holding most of the tiles is
    written by many tasks, not one."""
    if buckets:
        out = tiles.withColumn("tile_bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(int(buckets))))
        out.sortWithinPartitions("tile_bucket", key).write.mode("append").partitionBy("tile_bucket").parquet(path)
    else:
        tiles.sortWithinPartitions(key).write.mode("append").partitionBy(key).parquet(path)
    return path


def write_console(stream: DataFrame, truncate: bool = False):
    """Print each micro-batch (debugging only)."""
    return stream.writeStream.format("console").option("truncate", str(truncate).lower()).start()


def save_model(model, path: str) -> str:
    """Persist a Spark ML model (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_kmeans(path: str):
    from pyspark.ml.clustering import KMeansModel

    return KMeansModel.load(path)
