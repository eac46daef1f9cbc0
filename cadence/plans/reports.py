"""Scalar report projections of array-valued results.

Registered queries return these so results compare across engines cell by
cell: sizes plus an order-sensitive checksum instead of raw arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.arrays import weighted_checksum


def window_report(w: DataFrame) -> DataFrame:
    return w.select(
        "session_id",
        "k",
        "start_idx",
        "frame_number",
        "time_stamp",
        "num_samples",
        "num_channels",
        F.size("samples").alias("n_values"),
        weighted_checksum(F.col("samples")).alias("checksum"),
    )


def frame_report(f: DataFrame) -> DataFrame:
    return f.select(
        "session_id",
        "user_name",
        "frame_number",
        "time_stamp",
        "year",
        "month",
        "day",
        "ML_model",
        "preprocessing",
        "sampling_rate",
        "num_samples",
        "num_channels",
        F.array_join("channel_names", ",").alias("channel_names"),
        F.size("samples").alias("n_values"),
        weighted_checksum(F.col("samples")).alias("checksum"),
    )
