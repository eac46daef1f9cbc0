"""Bindings: the driver's tables viewed as this engine's data model.

Each function reads only the columns it needs (pruned at the parquet scan)
and derives the model table with DataFrame operations, so every query's work
grows with the input tables.  Constants here are the fixture parameters that
the oracle SQL repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.header import make_header
from cadence.operators.ordinal import position_within
from cadence.schemas import LABEL_CODES
from cadence.session import ensure_utc
from cadence.sources.frames import encode_frames

# ---- fixture parameters ------------------------------------------------------
SESSION_START = "2024-01-01 00:00:00"

FRAMES_FS = 16            # nominal rate of the embeddings-as-frames binding
FRAMES_SAMPLES = 16       # samples per frame
FRAMES_CHANNELS = 4       # channels per sample (64 floats per frame)
FRAMES_CHANNEL_NAMES = ["Time", "EEG a", "EEG b", "aux"]
FRAMES_LENGTH_S = 1.0     # → L = 16
FRAMES_OVERLAP = 0.75     # → S = 4

SIG_FS = 8                # nominal rate of the events-as-signal binding
SIG_LENGTH_S = 1.0        # → L = 8
SIG_OVERLAP = 0.8         # → S = 2

W64_FS = 250              # embeddings as single-channel 64-sample windows

RECORDING_FS = 16         # embeddings as 4-channel recordings of 64 samples
RECORDING_CHANNELS = 4

EVENT_TYPES = ("signup", "purchase", "error", "view", "click")

ANNOTATION_HOURS = 6      # interval length of annotations built from events
STORED_BEFORE = "2024-01-16 00:00:00"   # sessions started before this are already stored
# arrival order of producer groups in the late-data fixtures: batch 0, 1, 2
ARRIVAL_GROUPS = (("signup", "purchase"), ("error",), ("view", "click"))
TRAIN_ANNOTATION_S = 2.0  # interval length in signal seconds (training table)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _start():
    return F.lit(SESSION_START).cast("timestamp_ntz")


# ---- frames: embeddings as 16×4 sample-major frames, one session per label --
def frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded-frame table: flattened header + ``samples``."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    numbered = position_within(emb, ["label"], ["vec_id"], "frame_number")
    with_header = make_header(
        numbered,
        session_start=_start(),
        user_name=F.concat(F.lit("patient-"), F.col("label").cast("string")),
        frame_number=F.col("frame_number"),
        time_stamp=F.col("frame_number") * 1000,
        channel_names=F.array(*[F.lit(c) for c in FRAMES_CHANNEL_NAMES]),
        num_samples=F.lit(FRAMES_SAMPLES),
        num_channels=F.lit(FRAMES_CHANNELS),
        sampling_rate=F.lit(FRAMES_FS),
    )
    # Channel 0 ("Time") carries the sample time in ms; the rest are the
    # embedding values as recorded.
    ms_per_sample = 1000.0 / FRAMES_FS
    samples = F.transform(
        "embedding",
        lambda x, i: F.when(
            F.pmod(i, F.lit(FRAMES_CHANNELS)) == 0,
            ((F.col("frame_number") * FRAMES_SAMPLES + (i / FRAMES_CHANNELS).cast("int")) * F.lit(ms_per_sample)).cast("float"),
        ).otherwise(x),
    )
    return with_header.select("vec_id", "header.*", samples.alias("samples"))


def frame_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire-format messages (``value`` BINARY) built from :func:`frame_rows`."""
    rows = frame_rows(spark, sf_dir)
    hdr_cols = [c for c in rows.columns if c not in ("vec_id", "samples")]
    enc = encode_frames(rows.select("vec_id", F.struct(*hdr_cols).alias("header"), "samples"))
    received = _start() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("header.frame_number").cast("decimal(18,6)"))
    return enc.select("vec_id", F.col("header.frame_number").alias("frame_number"), "value", received.cast("timestamp").alias("received_at"))


# ---- sig: events as one-channel signals, one per user ------------------------
def sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, sample_idx, value): sample_idx = position by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type")
    return position_within(ev, ["user_id"], ["ts", "event_id"], "sample_idx")


# ---- headers: events as frame headers ----------------------------------------
def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header per event: session start = midnight of ts, time_stamp = ms
    into that day, model = event type; preprocessing and rate defaulted."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    ms = ((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(day.cast("timestamp"))) / 1000).cast("long").cast("int")
    return make_header(
        ev.withColumn("_day", day).withColumn("_ms", ms),
        session_start=F.col("_day"),
        user_name=F.concat(F.lit("user"), F.col("user_id").cast("string")),
        frame_number=(F.col("_ms") / 1000).cast("long"),  # one frame per second of the session
        time_stamp=F.col("_ms"),
        channel_names=F.array(F.lit("time"), F.lit("value")),
        num_samples=F.lit(1),
        num_channels=F.lit(2),
        ml_model=F.col("event_type"),
    ).drop("_day", "_ms")


# ---- timed: events on a TIMESTAMP axis ----------------------------------------
def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


# ---- windows64: embeddings as one-channel 64-sample windows at 250 Hz -------
def windows64(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return emb.select(
        F.col("vec_id").alias("window_id"),
        "label",
        F.lit(W64_FS).alias("sampling_rate"),
        F.lit(1).alias("num_channels"),
        F.array(F.lit("EEG")).alias("channel_names"),
        F.col("embedding").alias("samples"),
    )


def vector_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, sample_idx, value): each label's vectors end to end by vec_id."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    at = position_within(emb, ["label"], ["vec_id"], "_at")
    v = at.select("label", "_at", F.posexplode("embedding").alias("_i", "value"))
    return v.select("label", (F.col("_at") * 64 + F.col("_i")).alias("sample_idx"), F.col("value").cast("double").alias("value"))


# ---- recordings: embeddings as 4-channel recordings (channel-major) ---------
def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ch = (F.col("vec_id") % RECORDING_CHANNELS).cast("int")
    return emb.select(
        (F.col("vec_id") / RECORDING_CHANNELS).cast("long").alias("recording_id"),
        ch.alias("channel"),
        F.concat(F.lit("EEG C"), ch.cast("string"), F.lit("-REF")).alias("channel_label"),
        F.lit(float(RECORDING_FS)).alias("sampling_rate"),
        F.transform("embedding", lambda x: x.cast("double")).alias("samples"),
    )


# ---- annotations: error/purchase events as labelled intervals ---------------
def seconds_since_start(ts_col: str = "ts"):
    base = F.unix_micros(_start().cast("timestamp"))
    return (F.unix_micros(F.col(ts_col).cast("timestamp")) - base) / F.lit(1_000_000.0)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(recording_id, line_no, beg, end, label) in seconds since the start."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    lab = F.when(F.col("event_type") == "error", F.lit("fnsz")).otherwise(F.lit("bckg"))
    beg = seconds_since_start("ts")
    return ev.where(F.col("event_type").isin("error", "purchase")).select(
        F.col("user_id").alias("recording_id"),
        F.col("event_id").alias("line_no"),
        beg.alias("beg"),
        (beg + F.lit(ANNOTATION_HOURS * 3600.0)).alias("end"),
        lab.alias("label"),
    )


def label_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a time point to label: (recording_id, event_id, t)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ev.select(F.col("user_id").alias("recording_id"), "event_id", seconds_since_start("ts").alias("t"))


def train_annotations(spark: SparkSession, sf_dir: str, sig_df: DataFrame | None = None) -> DataFrame:
    """Annotations on the ``sig`` time axis: an error/purchase event at sample
    n opens [n/fs, n/fs + TRAIN_ANNOTATION_S]."""
    s = sig(spark, sf_dir) if sig_df is None else sig_df
    beg = F.col("sample_idx") / F.lit(float(SIG_FS))
    return s.where(F.col("event_type").isin("error", "purchase")).select(
        F.col("user_id").alias("recording_id"),
        F.col("event_id").alias("line_no"),
        beg.alias("beg"),
        (beg + F.lit(TRAIN_ANNOTATION_S)).alias("end"),
        F.when(F.col("event_type") == "error", F.lit("fnsz")).otherwise(F.lit("bckg")).alias("label"),
    )


LABEL_MAP_ITEMS = sorted(LABEL_CODES.items(), key=lambda kv: kv[1])


def arrival_batch():
    """Arrival batch of an event: its producer group's position in
    ARRIVAL_GROUPS (each group replays the whole month, so later groups
    arrive behind the watermark)."""
    expr = None
    for b, types in enumerate(ARRIVAL_GROUPS):
        cond = F.col("event_type").isin(*types)
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr.cast("int")
