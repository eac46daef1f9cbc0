"""Run Structured Streaming queries to completion and stage stream inputs.

Streams write to parquet (or a ``foreachBatch`` sink) under the shared
checkpoint root with their own checkpoint location, so a restarted job
resumes where it stopped and re-running a batch is idempotent.  Nothing is
collected to the driver (no memory sink)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.session import default_parallelism, scratch_dir


def stage_files(df: DataFrame, purpose: str, files: int | None = 4, path: str | None = None) -> str:
    """Write ``df`` as ``files`` parquet files (one append; ``None`` keeps the
    DataFrame's own partitioning) and return the folder.  Call again with the
    same ``path`` to add later arrivals."""
    spark = df.sparkSession
    path = path or scratch_dir(spark, purpose)
    (df.repartition(files) if files else df).write.mode("append").parquet(path)
    return path


def stream_files(spark: SparkSession, minimum: int = 4) -> int:
    """File count for staging a table as stream input: at least ``minimum``
    (so a stream sees several micro-batches), else the cluster's default
    parallelism; file size therefore grows with the table."""
    return max(minimum, default_parallelism(spark))


def run_available_now(
    stream: DataFrame,
    purpose: str,
    output_mode: str = "append",
    partition_by: list[str] | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    path: str | None = None,
    rows_per_file: int | None = None,
) -> str:
    """Process everything available, then stop.  Returns the output folder
    (parquet sink) — read it with ``spark.read.parquet``.  With
    ``rows_per_file`` a task that gives more rows writes several files, which
    as many tasks can read."""
    spark: SparkSession = stream.sparkSession
    out = path or scratch_dir(spark, purpose)
    ckpt = checkpoint or scratch_dir(spark, purpose + "-checkpoint")
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", out)
        if rows_per_file:
            w = w.option("maxRecordsPerFile", rows_per_file)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {purpose} failed: {q.exception()}")
    return out


def start_stream(
    stream: DataFrame,
    purpose: str,
    checkpoint: str,
    every: str = "1 second",
    output_mode: str = "append",
    path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    partition_by: list[str] | None = None,
):
    """T5: start a long-running query (processing-time trigger) with a
    checkpoint, returning the StreamingQuery handle.  Restarting with the same
    ``checkpoint`` resumes after the last committed batch; with the
    idempotent sinks of this package a replayed batch does not duplicate."""
    w = (
        stream.writeStream.queryName(f"{purpose}")
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
    )
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", path or scratch_dir(stream.sparkSession, purpose))
        if partition_by:
            w = w.partitionBy(*partition_by)
    return w.start()


def last_progress(stream_query) -> dict | None:
    """Metrics of the last micro-batch (rows in, rows dropped by watermark …)."""
    return stream_query.lastProgress
