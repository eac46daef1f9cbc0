"""The whole pipeline as chained streams: windower → processor → scorer.

Each hop is a stream of its own with its own checkpoint.  It hands its rows
over through the streaming file sink, whose commit log the next hop's file
source reads: a batch that failed half-way leaves no rows that count, and a
replayed batch replaces itself, so every row is handed over once however often
a hop is stopped or fails.  Messages are frames in the wire format (S2, S3).

The ledger has a row for every micro-batch of every hop: rows taken in and
rows handed over, as Spark observed them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.header import time_channel_idx
from cadence.operators import dsp
from cadence.operators.results import scoring_sink
from cadence.schemas import HEADER_NAMES
from cadence.session import read_if_written, scratch_dir
from cadence.sources.frames import decode_frames, encode_frames
from cadence.sources.sinks import route_by_model
from cadence.streaming.blocks import block_windows

LEDGER = "hop string, batch_id long, rows_in long, rows_out long"


def as_frames(rows: DataFrame, samples: str = "samples") -> DataFrame:
    """(session_id, ML_model, value): rows of header fields and samples as messages."""
    own = rows.withColumn("header", F.struct(*HEADER_NAMES))
    return encode_frames(own, "header", samples).select("session_id", "ML_model", "value")


def windower(messages: DataFrame, length_s: float, overlap: float, arrival: str | None = None, disorder: str = "10 minutes") -> DataFrame:
    """S2 → W2 by keyed blocks → S3."""
    frames = decode_frames(messages, keep=(arrival,) if arrival else ())
    cut = block_windows(frames, length_s, overlap, arrival=arrival, disorder=disorder)
    return as_frames(cut.where("k is not null"))


def processor(messages: DataFrame) -> DataFrame:
    """S2 → D4 → S3 → S5: processed windows and the route of their model."""
    windows = decode_frames(messages)
    done = dsp.transform_windows(windows, "standard", time_idx=time_channel_idx(F.col("channel_names")))
    return route_by_model(as_frames(done.withColumn("processed", F.col("processed").cast("array<float>")), "processed"))


class Chain:
    """Folders and checkpoints of one pipeline under ``root``; a new object on
    the same root goes on where the last one stopped."""

    def __init__(self, spark: SparkSession, root: str | None = None, models: dict | None = None):
        self.spark, self.models = spark, models
        self.root = root or scratch_dir(spark, "chain")
        self.windows, self.processed = f"{self.root}/windows", f"{self.root}/processed"
        self.sessions, self.data = f"{self.root}/sessions", f"{self.root}/data"

    def _messages(self, path: str, files: int | None, columns: str = "value binary") -> DataFrame:
        reader = self.spark.readStream.schema(columns)
        if files:
            reader = reader.option("maxFilesPerTrigger", files)
        return reader.parquet(path)

    def _run(self, hop: str, out: DataFrame, path: str | None = None, partition_by: str | None = None, sink: Callable | None = None) -> None:
        """Everything available through one hop; its batches go to the ledger,
        those of a run that failed too."""
        writer = (
            out.observe("handed", F.count(F.lit(1)).alias("rows"))
            .writeStream.outputMode("append")
            .option("checkpointLocation", f"{self.root}/checkpoints/{hop}")
            .trigger(availableNow=True)
        )
        if sink is not None:
            query = writer.foreachBatch(sink).start()
        else:
            writer = writer.format("parquet").option("path", path)
            query = (writer.partitionBy(partition_by) if partition_by else writer).start()
        try:
            query.awaitTermination()
        finally:
            self._note(hop, query.recentProgress)

    def _note(self, hop: str, progress: list) -> None:
        rows = []
        for p in progress:  # a row a micro-batch
            p = json.loads(p.json)
            seen = (p.get("observedMetrics") or {}).get("handed")
            if seen is not None:
                rows.append((hop, int(p["batchId"]), sum(int(s["numInputRows"]) for s in p["sources"]), int(seen["rows"])))
        if rows:
            self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")

    def run_windower(self, source: str, length_s: float, overlap: float, files: int | None = None, disorder: str = "10 minutes") -> None:
        messages = self._messages(source, files, "value binary, received_at timestamp")
        self._run("windower", windower(messages, length_s, overlap, "received_at", disorder), self.windows)

    def run_processor(self, files: int | None = None) -> None:
        self._run("processor", processor(self._messages(self.windows, files)), self.processed, "route")

    def run_scorer(self, files: int | None = None) -> None:
        """S2 → U2 → S7, S6 for the messages of all routes."""
        frames = decode_frames(self._messages(self.processed, files, "value binary, route string"))
        self._run("scorer", frames, sink=scoring_sink(self.sessions, self.data, self.models))

    def results(self) -> DataFrame:
        return self.spark.read.parquet(self.data).select("sess_id", "time_in", "time_ms", "class")

    def ledger(self) -> DataFrame:
        """(hop, batch_id, rows_in, rows_out); a batch that was run again counts once."""
        noted = read_if_written(self.spark, f"{self.root}/ledger")
        if noted is None:
            return self.spark.createDataFrame([], LEDGER)
        return noted.groupBy("hop", "batch_id").agg(F.max("rows_in").alias("rows_in"), F.max("rows_out").alias("rows_out"))
