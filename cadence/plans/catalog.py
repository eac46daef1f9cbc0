"""Registered queries: key → callable(spark, sf_dir) → DataFrame.

Each query binds the driver's tables (``bindings``), runs one operator or
pipeline from the library and returns a scalar report whose column names
match the oracle SQL of ``plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.arrays import pad_truncate, weighted_checksum
from cadence.functions.codec import split_frames
from cadence.functions.header import (
    event_time,
    header_to_json,
    parse_header,
    session_start,
    sliding_window_starts,
    split_time,
    time_channel_idx,
)
from cadence.operators import dsp
from cadence.operators.features import channel_catalog, channel_corr, corr_features, recording_spectra, recording_stft
from cadence.operators.labels import class_counts, interval_label, label_code
from cadence.operators import windows as W
from cadence.operators.models import (
    as_vector,
    assign_cluster,
    dispatch_model,
    dispatch_processing,
    first_k_centroids,
    fixture_processors,
    rule_class,
    train_kmeans,
    update_kmeans,
)
from cadence.operators.ordinal import skip_first
from cadence.operators.results import (
    data_rows,
    first_per_session,
    fk_orphans,
    new_sessions,
    register_sessions,
    score,
    scoring_sink,
)
from cadence.plans import bindings as B
from cadence.plans.reports import frame_report, window_report
from cadence.schemas import HEADER
from cadence.session import read_if_written, scratch_dir
from cadence.sources.files import (
    channels_like,
    list_inputs,
    pair_inputs,
    read_annotations,
    recordings_to_samples,
    render_annotations,
    write_annotation_files,
)
from cadence.sources.frames import classify_frames, decode_frames, encode_frames, read_frames
from cadence.sources.sinks import append_results, load_kmeans, route_by_model, save_model, write_routed, write_tiles
from cadence.streaming.blocks import block_windows, split_late_frames as split_late_blocks
from cadence.streaming.chain import Chain
from cadence.streaming.ops import dedup_frames, drop_expired, late_rows_sink, split_late, stateful_windows, with_event_time
from cadence.streaming.runner import run_available_now, stage_files, stream_files

Query = Callable[[SparkSession, str], DataFrame]


def r6(c):
    """Round to 6 decimals; ``+ 0.0`` folds −0.0 into 0.0."""
    return F.round(c, 6) + F.lit(0.0)
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# ---- slice 1: windows → stamp → rule → event time ---------------------------
def frame_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.sample_windows(B.frame_rows(spark, sf_dir), B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP)


def sig_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = W.samples_as_frames(B.sig(spark, sf_dir), "user_id", "sample_idx", "value", B.SIG_FS)
    return W.sample_windows(frames, B.SIG_LENGTH_S, B.SIG_OVERLAP, start_col="start")


@query
def q_sample_windows(spark, sf_dir):
    """W2 (flagship): overlapping windows of the frame sessions, as a scalar report."""
    return window_report(frame_windows(spark, sf_dir))


@query
def q_window_timestamp(spark, sf_dir):
    """P14 (no time channel): window stamps start_idx·1000 div fs of the event signals."""
    w = sig_windows(spark, sf_dir)
    return w.select(F.col("session_id").cast("long").alias("user_id"), "k", "start_idx", "time_stamp")


@query
def q_rule_class(spark, sf_dir):
    """M1: class of every header's time stamp."""
    h = B.headers(spark, sf_dir)
    return h.select("event_id", F.col("header.time_stamp").alias("time_stamp"), rule_class(F.col("header.time_stamp")).alias("class"))


@query
def q_event_time(spark, sf_dir):
    """Session start from the header fields plus time_stamp ms."""
    h = B.headers(spark, sf_dir).select("event_id", "header.*")
    start = session_start()
    return h.select(
        "event_id",
        start.alias("session_start"),
        "time_stamp",
        event_time(start, F.col("time_stamp")).alias("event_time"),
    )


def header_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers binding as wire messages: one sample of (time ms, value)."""
    h = B.headers(spark, sf_dir)
    samples = F.array(F.col("header.time_stamp").cast("float"), F.col("value").cast("float"))
    return encode_frames(h.withColumn("samples", samples)).select("event_id", "value")


# Model registry of the scoring fixture: every event type's queue is served
# by the default rule worker (U2 resolves the model named in each header).
def all_types_default():
    return {t: (lambda: rule_class(F.col("time_stamp"))) for t in ("default", *B.EVENT_TYPES)}


@query
def q_score_stream(spark, sf_dir):
    """M2: header messages staged as files and consumed as a stream; each
    micro-batch is decoded, scored, its new sessions registered and its
    result rows appended (foreachBatch, idempotent per batch id)."""
    files = stream_files(spark)
    staged = stage_files(header_frames(spark, sf_dir).select("value"), "score-input", files=files)
    # several micro-batches: sessions of one batch are known to the next
    stream = decode_frames(spark.readStream.schema("value binary").option("maxFilesPerTrigger", -(-files // 3)).parquet(staged))
    sessions, data = scratch_dir(spark, "sessions-table"), scratch_dir(spark, "data-table")
    run_available_now(stream, "score-stream", foreach_batch=scoring_sink(sessions, data, all_types_default()))
    return spark.read.parquet(data).select("sess_id", "time_in", "time_ms", "class")


@query
def q_window_scores(spark, sf_dir):
    """Flagship pipeline: frames → sample windows (W2, P14) → model
    → event time (P5) → result rows, one per window."""
    return data_rows(score(frame_windows(spark, sf_dir)))


# ---- frames: codec, quarantine, source ---------------------------------------
@query
def q_frame_decode(spark, sf_dir):
    """Decode the frame messages (envelope, JSON header, float payload)."""
    return frame_report(decode_frames(B.frame_bytes(spark, sf_dir)))


@query
def q_frame_encode(spark, sf_dir):
    """S3: encode frames and read the wire layout back (lengths, header JSON)."""
    enc = B.frame_bytes(spark, sf_dir)
    env = enc.select(split_frames(F.col("value")).alias("e"))
    h = F.from_json(F.col("e.header_text"), HEADER)
    return env.select(
        h["session_id"].alias("session_id"),
        h["frame_number"].alias("frame_number"),
        F.col("e.n_bytes").alias("n_bytes"),
        F.col("e.header_len").alias("header_len"),
        F.col("e.header_text").alias("header_json"),
    )


def corrupted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame messages where each session's frame 0 lost its last float and
    frame 1 carries a length field pointing past the message end."""
    fb = B.frame_bytes(spark, sf_dir)
    fn = F.col("frame_number")
    v = F.col("value")
    bad = (
        F.when(fn == 0, F.expr("substring(value, 1, octet_length(value) - 4)"))
        .when(fn == 1, F.concat(F.unhex(F.lit("FFFF0000")), F.expr("substring(value, 5)")))
        .otherwise(v)
    )
    return fb.select("vec_id", bad.alias("value"))


@query
def q_frame_quarantine(spark, sf_dir):
    """Verdict per message, two kinds of corruption injected."""
    verdicts = classify_frames(corrupted_frames(spark, sf_dir))
    return verdicts.select("vec_id", "n_bytes", "status")


@query
def q_frame_source(spark, sf_dir):
    """The frame messages staged as files and consumed as a stream
    (availableNow, two files per micro-batch), decoded, sunk, read back."""
    files = stream_files(spark)
    staged = stage_files(B.frame_bytes(spark, sf_dir).select("value", "received_at"), "frame-source-input", files=files)
    stream = read_frames(spark, staged, stream=True, max_files_per_trigger=files // 2)
    out = run_available_now(decode_frames(stream), "frame-source-output")
    return frame_report(spark.read.parquet(out))


# ---- frames: channels, time split, concat, fan-out ----------------------------
@query
def q_time_channel(spark, sf_dir):
    """Index of the time channel of each frame."""
    f = B.frame_rows(spark, sf_dir)
    return f.select("session_id", "frame_number", time_channel_idx(F.col("channel_names")).alias("time_idx"))


@query
def q_split_time(spark, sf_dir):
    """Time channel and signal channels of each frame."""
    f = B.frame_rows(spark, sf_dir).withColumn("time_idx", time_channel_idx(F.col("channel_names")))
    parts = split_time(f)
    return parts.select(
        "session_id",
        "frame_number",
        "time_idx",
        F.size("time").alias("n_time"),
        F.size("signal").alias("n_signal"),
        weighted_checksum(F.col("time")).alias("time_checksum"),
        weighted_checksum(F.col("signal")).alias("signal_checksum"),
    )


@query
def q_channel_subset(spark, sf_dir):
    """The channels whose label contains EEG."""
    f = B.frame_rows(spark, sf_dir)
    kept = channels_like(f, "EEG")
    return kept.select(
        "session_id",
        "frame_number",
        F.size("kept_channels").alias("n_channels_kept"),
        F.size("samples").alias("n_values"),
        weighted_checksum(F.col("samples")).alias("checksum"),
    )


@query
def q_block_concat(spark, sf_dir):
    """A1/A3 inside W1: each session's frames per 2 s / 1 s event-time window,
    appended in frame order."""
    f = B.frame_rows(spark, sf_dir).withColumn("event_time", event_time(session_start(), F.col("time_stamp")))
    keyed = f.withColumn("w", F.explode(sliding_window_starts(F.col("event_time"), 2, 1)))
    cat = W.concat_blocks(keyed, ["session_id", "w"], "frame_number", "samples")
    return cat.select(
        "session_id",
        F.col("w").alias("window_start"),
        F.col("n_blocks").alias("n_frames"),
        F.size("samples").alias("n_values"),
        weighted_checksum(F.col("samples")).alias("checksum"),
    )


@query
def q_fanout(spark, sf_dir):
    """Windows per input frame, per session."""
    frames = B.frame_rows(spark, sf_dir)  # one binding feeds both counts
    return W.fanout(frames, W.sample_windows(frames, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP))


@query
def q_relayout(spark, sf_dir):
    """Channel-major recordings to sample-major rows."""
    s = recordings_to_samples(B.recordings(spark, sf_dir))
    return s.select(
        "recording_id",
        "sample_idx",
        F.size("values").alias("n_channels"),
        weighted_checksum(F.col("values")).alias("checksum"),
    )


# ---- headers -----------------------------------------------------------------
@query
def q_header_build(spark, sf_dir):
    """Headers with defaults from the events."""
    h = B.headers(spark, sf_dir).select("event_id", "header.*")
    return h.withColumn("channel_names", F.array_join("channel_names", ","))


@query
def q_header_json(spark, sf_dir):
    """Header JSON round trip, plus the events' props JSON."""
    h = B.headers(spark, sf_dir)
    j = h.select("event_id", "props", header_to_json(F.col("header")).alias("header_json"), "header")
    back = j.withColumn("_back", parse_header(F.col("header_json")))
    out = back.select(
        "event_id",
        "header_json",
        F.length("header_json").alias("json_len"),
        (F.to_json(F.col("_back")) == F.col("header_json")).alias("roundtrip_ok"),
        F.from_json("props", "k INT")["k"].alias("props_k"),
    )
    return out


@query
def q_route_by_model(spark, sf_dir):
    """Messages routed to ml.<model>, written per route, counted."""
    h = B.headers(spark, sf_dir).select("event_id", "header.*")
    routed = route_by_model(h)
    out = write_routed(routed.select("route", "session_id", "frame_number", "time_stamp"), scratch_dir(spark, "routes"))
    return spark.read.parquet(out).groupBy("route").agg(F.count(F.lit(1)).alias("n_messages"))


def dispatch_fixture_models():
    """Two model workers registered by name; other model names stay unserved."""
    minute = lambda: rule_class(F.col("time_stamp"), 60_000, 30_000)
    default = lambda: rule_class(F.col("time_stamp"))
    return {"default": default, "view": default, "click": default, "purchase": minute}


@query
def q_dispatch_model(spark, sf_dir):
    """Each header scored by the model it names (unserved held back)."""
    h = B.headers(spark, sf_dir).select("event_id", "header.*")
    scored = dispatch_model(h, models=dispatch_fixture_models(), keep_unserved=False)
    return scored.select("event_id", F.col("ML_model").alias("ml_model"), "class")


def scored_events(spark, sf_dir):
    frames = decode_frames(header_frames(spark, sf_dir))
    return score(frames, models=all_types_default())


@query
def q_result_append(spark, sf_dir):
    """Result rows appended to a day-partitioned table and read back."""
    out = append_results(data_rows(scored_events(spark, sf_dir)), scratch_dir(spark, "data-table"))
    return spark.read.parquet(out).select("sess_id", "time_in", "time_ms", "class")


# ---- sessions ------------------------------------------------------------------
def existing_sessions(spark, sf_dir):
    """Sessions already stored: those that started before the resume point."""
    h = B.headers(spark, sf_dir).where(F.col("ts") < F.lit(B.STORED_BEFORE).cast("timestamp_ntz")).select("header.*")
    return first_per_session(score(h, models=all_types_default()))


@query
def q_new_sessions(spark, sf_dir):
    """Sessions not yet stored."""
    cands = first_per_session(scored_events(spark, sf_dir))
    return new_sessions(cands, existing_sessions(spark, sf_dir)).select("sess_id")


@query
def q_register_sessions(spark, sf_dir):
    """The sessions rows to insert (first row per new session)."""
    return register_sessions(scored_events(spark, sf_dir), existing_sessions(spark, sf_dir))


@query
def q_fk_check(spark, sf_dir):
    """Result rows whose session is not stored."""
    return fk_orphans(data_rows(scored_events(spark, sf_dir)), existing_sessions(spark, sf_dir))


# ---- windows64: filters, spectrum, standard chain, processor plug-ins ---------
def w64_long(df: DataFrame, col: str = "processed", extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select("window_id", *extra, F.posexplode(col).alias("n", "v")).select(
        "window_id", *extra, F.col("n").cast("int").alias("n"), r6(F.col("v")).alias("value")
    )


@query
def q_bandstop(spark, sf_dir):
    """Mains band-stop over single-channel windows."""
    return w64_long(dsp.transform_windows(B.windows64(spark, sf_dir), "bandstop"))


@query
def q_highpass(spark, sf_dir):
    """Drift high-pass over single-channel windows."""
    return w64_long(dsp.transform_windows(B.windows64(spark, sf_dir), "highpass"))


@query
def q_spectrum(spark, sf_dir):
    """D3: |FFT| of every window, all bins."""
    return w64_long(dsp.transform_windows(B.windows64(spark, sf_dir), "spectrum"))


@query
def q_process_standard(spark, sf_dir):
    """Band-stops → high-pass → |FFT| as one operator."""
    return w64_long(dsp.transform_windows(B.windows64(spark, sf_dir), "standard"))


@query
def q_dispatch_processing(spark, sf_dir):
    """Each window through the processor its header names."""
    w = B.windows64(spark, sf_dir).withColumn(
        "preprocessing", F.when(F.col("label") < 5, F.lit("standard")).otherwise(F.lit("spectrum"))
    )
    out = dispatch_processing(w, processors=fixture_processors())
    return w64_long(out, extra=("preprocessing",))


# ---- sig: sample time, frequency axis, per-window UDF, whole-signal ops -------
@query
def q_sample_time(spark, sf_dir):
    """Sample time n / fs."""
    s = B.sig(spark, sf_dir)
    return s.select("user_id", "sample_idx", (F.col("sample_idx") / F.lit(float(B.SIG_FS))).alias("t"))


@query
def q_freq_axis(spark, sf_dir):
    """FFT bin frequencies of the event-signal windows."""
    w = sig_windows(spark, sf_dir)
    b = w.select(
        F.col("session_id").cast("long").alias("user_id"), "k", "num_samples", "sampling_rate",
        F.explode(F.sequence(F.lit(0), F.col("num_samples") - 1)).alias("bin"),
    )
    return b.select("user_id", "k", "bin", dsp.freq_axis(F.col("bin"), F.col("num_samples"), F.col("sampling_rate")).alias("freq"))


def _window_stats(session, k, X):
    v = X[:, 0]
    return [(int(session), k, len(v), round(float(v.mean()), 6), float(v.max()))]


@query
def q_window_udf(spark, sf_dir):
    """A user function (mean / max) over every window."""
    frames = W.samples_as_frames(B.sig(spark, sf_dir), "user_id", "sample_idx", "value", B.SIG_FS)
    schema = "user_id long, k long, n long, mean double, max double"
    return W.apply_per_window(frames, _window_stats, schema, B.SIG_LENGTH_S, B.SIG_OVERLAP, start_col="start")


# Block length (samples) of the whole-signal filter: each block is one bounded
# group.  Multi-block results are checked against a
# direct recursion in tests/test_dsp.py.
SIG_FILTER_BLOCK = 1 << 16


@query
def q_filter_recording(spark, sf_dir):
    """Continuous-state filter over each whole signal."""
    s = B.sig(spark, sf_dir).select("user_id", "sample_idx", "value")
    y = dsp.filter_signals(s, ["user_id"], "sample_idx", "value", float(B.SIG_FS), "filters", SIG_FILTER_BLOCK)
    return y.select("user_id", "sample_idx", r6(F.col("filtered")).alias("filtered"))


@query
def q_filter_states(spark, sf_dir):
    """D6 at 250 Hz (all mains harmonics below Nyquist) over blocks of 1,024
    samples: states composed across the blocks of each label's signal."""
    s = B.vector_signals(spark, sf_dir)
    y = dsp.filter_signals(s, ["label"], "sample_idx", "value", float(B.W64_FS), "filters", 1 << 10)
    return y.select("label", "sample_idx", r6(F.col("filtered")).alias("filtered"))


@query
def q_stft_segments(spark, sf_dir):
    """Zero-extended STFT segments of each signal."""
    s = B.sig(spark, sf_dir).select("user_id", "sample_idx", "value")
    segs = W.stft_segments(s, ["user_id"], "sample_idx", "value", B.SIG_FS, int(B.SIG_FS * 4 / 5))
    return segs.select("user_id", "seg", F.size("segment").alias("n_values"), weighted_checksum(F.col("segment")).alias("checksum"))


@query
def q_stft(spark, sf_dir):
    """STFT of each signal (periodic Hann, one-sided, scaled by 1/Σw)."""
    s = B.sig(spark, sf_dir).select("user_id", "sample_idx", "value")
    z = dsp.stft(s, ["user_id"], "sample_idx", "value", float(B.SIG_FS))
    return z.select("user_id", "seg", "bin", "t", "freq", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


# ---- time windows and streams ---------------------------------------------------
def _sum_value():
    return F.sum(F.col("value").cast("decimal(18,2)")).cast("double")


@query
def q_sliding_time(spark, sf_dir):
    """2 h / 1 h event-time windows per user."""
    t = B.timed(spark, sf_dir)
    aggs = [F.count(F.lit(1)).alias("n_events"), _sum_value().alias("sum_value")]
    return W.time_windows(t, "ts", "2 hours", "1 hour", ["user_id"], aggs)


@query
def q_global_sliding(spark, sf_dir):
    """Unkeyed 2 h / 1 h windows with combinable aggregates."""
    t = B.timed(spark, sf_dir)
    order = F.struct("ts", "event_id")
    aggs = [
        F.count(F.lit(1)).alias("n_events"),
        _sum_value().alias("sum_value"),
        F.min_by("value", order).alias("first_value"),
        F.max_by("value", order).alias("last_value"),
    ]
    return W.time_windows(t, "ts", "2 hours", "1 hour", [], aggs)


STREAM_DELAY = "1 hour"


@query
def q_stream_sliding(spark, sf_dir):
    """Events as a stream on event time, 2 h / 1 h windows per user,
    1 h watermark, append mode — emitted windows are the closed ones."""
    schema = B.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(stage_events(spark, sf_dir, 1))
    ev = with_event_time(stream, "ts", STREAM_DELAY)
    aggs = [F.count(F.lit(1)).alias("n_events"), _sum_value().alias("sum_value")]
    win = W.time_windows(ev, "ts", "2 hours", "1 hour", ["user_id"], aggs)
    out = run_available_now(win, "stream-sliding")
    return spark.read.parquet(out)


def stage_events(spark, sf_dir, copies: int) -> str:
    """Events staged as stream input files (``copies`` appends of the table)."""
    ev = B.table(spark, sf_dir, "events")
    path = None
    for _ in range(copies):
        path = stage_files(ev, "events-stream", files=stream_files(spark, 2), path=path)
    return path


@query
def q_late_split(spark, sf_dir):
    """T2 (batch rule): rows behind the watermark of the earlier arrival batches."""
    t = B.timed(spark, sf_dir).withColumn("arrival_batch", B.arrival_batch())
    return split_late(t, "ts", "arrival_batch", 3600.0).select("event_id", "arrival_batch", "is_late")


@query
def q_stream_dedup(spark, sf_dir):
    """Events delivered twice, deduplicated on a stream within the watermark."""
    schema = B.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(stage_events(spark, sf_dir, 2))
    dedup = dedup_frames(stream, ["user_id", "event_id"], "ts", STREAM_DELAY)
    out = run_available_now(dedup, "stream-dedup")
    res = spark.read.parquet(out)
    return res.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


TTL_DAYS = 7


@query
def q_ttl_filter(spark, sf_dir):
    """T4: messages received within 7 days of the newest."""
    t = B.timed(spark, sf_dir)
    as_of = t.select(F.max("ts")).scalar()
    return drop_expired(t, "ts", TTL_DAYS * 86400.0, as_of).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


# A long session's windows come from one task; its report is made by many.
WINDOWS_PER_FILE = 1 << 16


@query
def q_stateful_windows(spark, sf_dir):
    """Frames streamed in four scrambled files, windows cut by the keyed
    cursor state; same closed windows as ``sample_windows``.  The replay holds
    every frame and scrambles whole sessions, so no frame is given up."""
    files = stream_files(spark)
    staged = stage_files(B.frame_rows(spark, sf_dir), "frames-stream", files=files)
    schema = spark.read.parquet(staged).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, files // 2)).parquet(staged)
    cut = stateful_windows(stream, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP, lateness_s=None)
    out = run_available_now(cut, "stateful-windows", rows_per_file=WINDOWS_PER_FILE)
    return window_report(spark.read.parquet(out))


@query
def q_block_windows(spark, sf_dir):
    """T6 by (session, block): the frames arrive scrambled in at least four
    micro-batches over two runs on one checkpoint; every window comes out, the
    tails of the sessions too."""
    frames = B.frame_rows(spark, sf_dir)
    files, path, ckpt = stream_files(spark), scratch_dir(spark, "block-input"), scratch_dir(spark, "block-checkpoint")
    out = scratch_dir(spark, "block-windows")
    early = F.pmod(F.xxhash64("vec_id"), F.lit(2)) == 0
    for part in (frames.where(early), frames.where(~early)):
        stage_files(part, "block-input", files=files, path=path)
        stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", max(1, files // 2)).parquet(path)
        cut = block_windows(stream, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP)
        run_available_now(cut, "block-windows", checkpoint=ckpt, path=out)
    return window_report(split_late_blocks(spark.read.parquet(out))[0])


def run_chain(spark: SparkSession, sf_dir: str) -> Chain:
    """Windower → processor → scorer over the frame messages, which arrive in
    two halves; each hop is a new stream on its old checkpoint for the second."""
    bytes_ = B.frame_bytes(spark, sf_dir).select("frame_number", "value", "received_at")
    files, path, root = stream_files(spark), scratch_dir(spark, "chain-input"), scratch_dir(spark, "chain")
    half = bytes_.agg(F.percentile_approx("frame_number", 0.5)).first()[0] or 0
    chain = Chain(spark, root)
    for part in (bytes_.where(F.col("frame_number") <= half), bytes_.where(F.col("frame_number") > half)):
        stage_files(part.select("value", "received_at"), "chain-input", files=files, path=path)
        chain = Chain(spark, root)
        chain.run_windower(path, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP, files=max(1, files // 2), disorder="1 day")
        chain.run_processor()
        chain.run_scorer()
    return chain


@query
def q_stream_chain(spark, sf_dir):
    """S1 → W2 → D4 → S3 → S5 → M2 → S6/S7 as chained streams: the result rows
    equal those of the batch pipeline."""
    return run_chain(spark, sf_dir).results()


@query
def q_stream_ledger(spark, sf_dir):
    """Rows taken in and handed over by every hop of the chained streams."""
    ledger = run_chain(spark, sf_dir).ledger()
    return ledger.groupBy("hop").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))


# ---- annotations and labels -------------------------------------------------------
@query
def q_label_code(spark, sf_dir):
    """Annotation label → class code."""
    a = B.annotations(spark, sf_dir)
    return a.select("line_no", "label", label_code(F.col("label")).alias("code"))


@query
def q_class_counts(spark, sf_dir):
    """A2: background vs seizure annotation lines per recording."""
    return class_counts(B.annotations(spark, sf_dir))


@query
def q_interval_label(spark, sf_dir):
    """Class code of every event time from the covering annotations."""
    return interval_label(B.label_times(spark, sf_dir), B.annotations(spark, sf_dir))


@query
def q_annotation_scan(spark, sf_dir):
    """Annotations rendered as one text file per recording (with the
    version line and a blank line), then scanned back line by line."""
    ann = B.annotations(spark, sf_dir).withColumn("file", F.col("recording_id").cast("string"))
    path = write_annotation_files(render_annotations(ann), scratch_dir(spark, "annotations"))
    back = read_annotations(spark, path)
    rec = F.regexp_extract(F.col("file"), r"file=([^/]+)/", 1).cast("long")
    return back.select(rec.alias("recording_id"), r6(F.col("beg")).alias("beg"), r6(F.col("end")).alias("end"), "label")


@query
def q_training_table(spark, sf_dir):
    """M7: whole-signal filter (D6) → STFT (D5) → interval labels."""
    sig = B.sig(spark, sf_dir)  # one binding feeds the signal and its annotations
    s = sig.select("user_id", "sample_idx", "value")
    filt = dsp.filter_signals(s, ["user_id"], "sample_idx", "value", float(B.SIG_FS), "filters", SIG_FILTER_BLOCK)
    # one row a segment takes the label; bins come last
    z = dsp.spectra(filt, ["user_id"], "sample_idx", "filtered", float(B.SIG_FS)).withColumnRenamed("user_id", "recording_id")
    hop = B.SIG_FS - int(B.SIG_FS * 4 / 5)
    lab = interval_label(z.withColumn("_at", F.col("seg") * (hop / B.SIG_FS)), B.train_annotations(spark, sf_dir, sig), ids=("seg",), t="_at")
    out = dsp.explode_bins(lab, ["recording_id"], float(B.SIG_FS), extra=("code",))
    return out.select(
        "recording_id", "seg", "bin", "t", "freq",
        r6(dsp.magnitude(F.col("re"), F.col("im"))).alias("magnitude"), "code",
    )


# ---- recordings: catalogue, correlation, features, tiles, padding -------------------
@query
def q_channel_catalog(spark, sf_dir):
    """A4: sorted channel labels per recording."""
    c = channel_catalog(B.recordings(spark, sf_dir))
    return c.select("recording_id", F.size("channels").alias("n_channels"), F.array_join("channels", ",").alias("channels"))


def rec_stft(spark, sf_dir):
    return recording_stft(B.recordings(spark, sf_dir), float(B.RECORDING_FS))


@query
def q_channel_corr(spark, sf_dir):
    """A5: |complex correlation| of channel pairs per STFT frame."""
    c = channel_corr(recording_spectra(B.recordings(spark, sf_dir), float(B.RECORDING_FS)))
    return c.select("recording_id", "seg", "ch_a", "ch_b", r6(F.col("corr")).alias("corr"))


@query
def q_corr_features(spark, sf_dir):
    """M3: eigenvalue features (width 32) per STFT frame."""
    return corr_features(recording_spectra(B.recordings(spark, sf_dir), float(B.RECORDING_FS)))


@query
def q_corr_norms(spark, sf_dir):
    """M3 by its invariants: the 2-, 4-, 6- and 8-norm of each frame's features,
    which fix four of them and equal traces of powers of the matrix."""
    f = corr_features(recording_spectra(B.recordings(spark, sf_dir), float(B.RECORDING_FS)))
    norm = lambda p: r6(F.aggregate("features", F.lit(0.0), lambda a, x: a + F.pow(x, F.lit(float(p)))) ** (1.0 / p)).alias(f"norm{p}")
    return f.select("recording_id", "seg", "n_eig", F.size("features").alias("width"), *[norm(p) for p in (2, 4, 6, 8)])


@query
def q_pad_truncate(spark, sf_dir):
    """Positive samples padded / cut to 32."""
    r = B.recordings(spark, sf_dir)
    v = pad_truncate(F.filter("samples", lambda x: x > 0), 32)
    return r.select("recording_id", "channel", F.posexplode(v).alias("pos", "value")).select(
        "recording_id", "channel", F.col("pos").cast("int").alias("pos"), "value"
    )


TILE_BUCKETS = 16  # tile folders (hash of recording id)


@query
def q_tile_store(spark, sf_dir):
    """Recording STFT tiles written to the tile store and read back."""
    z = rec_stft(spark, sf_dir)
    path = write_tiles(z, scratch_dir(spark, "tiles"), buckets=TILE_BUCKETS)
    back = spark.read.parquet(path)
    return back.select(
        F.col("recording_id").cast("long").alias("recording_id"), "channel", "seg", "bin", "t", "freq",
        r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"),
    )


# ---- vectors: k-means -------------------------------------------------------------------
KMEANS_K = 2


def vectors(spark, sf_dir):
    e = B.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", F.col("embedding").alias("v"))


@query
def q_kmeans_train(spark, sf_dir):
    """M4: k-means (k = 2, seed 0) over the vectors; cluster per vector."""
    v = vectors(spark, sf_dir).withColumn("features", as_vector("v"))
    model = train_kmeans(v, "features", KMEANS_K, 0)
    return model.transform(v).select("vec_id", F.col("cluster").cast("int").alias("cluster"))


@query
def q_assign_cluster(spark, sf_dir):
    """M6: nearest of the first k vectors."""
    v = vectors(spark, sf_dir)
    cents = first_k_centroids(v, "v", "vec_id", KMEANS_K)
    return assign_cluster(v, "v", cents).select("vec_id", "cluster", r6(F.col("dist")).alias("dist"))


@query
def q_minibatch_update(spark, sf_dir):
    """M5: one mini-batch step from those centroids."""
    v = vectors(spark, sf_dir)
    cents = first_k_centroids(v, "v", "vec_id", KMEANS_K)
    return update_kmeans(v, "v", cents).select("cluster", "n", "dim", r6(F.col("value")).alias("value"))


@query
def q_model_roundtrip(spark, sf_dir):
    """Model saved, loaded, and both score the vectors."""
    v = vectors(spark, sf_dir).withColumn("features", as_vector("v"))
    model = train_kmeans(v, "features", KMEANS_K, 0)
    path = save_model(model, scratch_dir(spark, "kmeans-model"))
    loaded = load_kmeans(path).setPredictionCol("cluster_after")
    both = loaded.transform(model.setPredictionCol("cluster_before").transform(v))  # one pass, no join
    return both.select("vec_id", "cluster_before", "cluster_after", (F.col("cluster_before") == F.col("cluster_after")).alias("same"))


@query
def q_kmeans_checks(spark, sf_dir):
    """M4, S13 by their invariants: every vector's cluster is its nearest
    centre's, also by the model that was saved and loaded."""
    v = vectors(spark, sf_dir).withColumn("features", as_vector("v"))
    model = train_kmeans(v, "features", KMEANS_K, 0)
    loaded = load_kmeans(save_model(model, scratch_dir(spark, "kmeans-model"))).setPredictionCol("loaded")
    both = loaded.transform(model.setPredictionCol("trained").transform(v))
    near = assign_cluster(both, "v", [list(c) for c in model.clusterCenters()])
    return near.select("vec_id", (F.col("cluster") == F.col("trained")).alias("nearest"), (F.col("trained") == F.col("loaded")).alias("same"))


# ---- paths: listing, pairing, resume ---------------------------------------------------------
def input_paths(spark, sf_dir):
    """File tree of the training corpus: a recording (.edf) per document; an
    annotation (.tse) and a binary-annotation file (.tse_bi) for the
    documents that have a labels row."""
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(B.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    base = lambda d: F.concat(F.lit("corpus/"), d["lang"], F.lit("/"), d["source"], F.lit("/rec_"), d["doc_id"].cast("string"))
    edf = docs.select(F.concat(base(docs), F.lit(".edf")).alias("path"))
    tse = labelled.select(F.explode(F.array(F.concat(base(labelled), F.lit(".tse")), F.concat(base(labelled), F.lit(".tse_bi")))).alias("path"))
    return edf.unionByName(tse)


@query
def q_list_inputs(spark, sf_dir):
    """Recordings and annotation files of the corpus listing."""
    return list_inputs(input_paths(spark, sf_dir))


@query
def q_pair_inputs(spark, sf_dir):
    """Recordings paired with annotation files by stem."""
    pairs, _unmatched = pair_inputs(list_inputs(input_paths(spark, sf_dir)))
    return pairs


SKIP_FIRST = 100


@query
def q_skip_inputs(spark, sf_dir):
    """O2: recordings after the first 100 by path."""
    edf = list_inputs(input_paths(spark, sf_dir)).where(F.col("kind") == "edf").select("path")
    return skip_first(edf, ["path"], SKIP_FIRST)


# ---- filter check: spectrogram before / after ---------------------------------------------
TONES_HZ = (0.5, 4.0, 11.0, 19.0, 35.0, 60.0, 120.0)  # fixed values: the tone mix
TONE_FS = 250
SAMPLES_PER_EVENT = 25


@query
def q_filter_attenuation(spark, sf_dir):
    """Per signal, the tone mix laid on the event grid of each user
    (25 samples at 250 Hz per event, plus the event value), STFT before and
    after the whole-signal filter chain; mean |Z| at each tone's bin."""
    s = B.sig(spark, sf_dir).select("user_id", "sample_idx", "value")
    n = (F.col("sample_idx") * SAMPLES_PER_EVENT + F.col("j")).cast("long")
    tone = sum(F.cos(F.lit(2 * np.pi * f / TONE_FS) * n) for f in TONES_HZ)
    x = s.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES_PER_EVENT - 1)))).select(
        "user_id", n.alias("n"), (tone + F.col("value") / 100.0).alias("x")
    )
    # STFT bins are 1 Hz apart (nperseg = fs): tone f sits in bin round(f)
    # (the 0.5 Hz tone between bins 0 and 1 is reported at bin 1)
    tone_bins = {f: max(1, int(round(f))) for f in TONES_HZ}
    before = dsp.stft(x, ["user_id"], "n", "x", float(TONE_FS), bins=list(tone_bins.values()))
    y = dsp.filter_signals(x, ["user_id"], "n", "x", float(TONE_FS), "filters")
    after = dsp.stft(y, ["user_id"], "n", "filtered", float(TONE_FS), bins=list(tone_bins.values()))
    pick = F.create_map(*[x for f, b in tone_bins.items() for x in (F.lit(b), F.lit(f))])

    def level(z, name):
        return z.groupBy("user_id", "bin").agg(F.avg(dsp.magnitude(F.col("re"), F.col("im"))).alias(name))

    out = level(before, "before").join(level(after, "after"), ["user_id", "bin"])
    return out.select(
        F.col("user_id").alias("recording_id"),
        F.try_element_at(pick, F.col("bin")).alias("tone_hz"),
        F.col("bin").cast("int").alias("bin"),
        "before",
        "after",
        (F.col("after") / F.col("before")).alias("ratio"),
    )


@query
def q_processed_windows(spark, sf_dir):
    """Windower → processor: frame windows (W2, 4 channels with a time
    channel) through the standard chain (D4); output per window, channel and
    bin — channel 0 keeps the time values, the others are |FFT| of the
    filtered signal channels."""
    w = frame_windows(spark, sf_dir).withColumn("time_idx", time_channel_idx(F.col("channel_names")))
    p = dsp.transform_windows(w, "standard", time_idx=F.col("time_idx"))
    C = F.col("num_channels")
    e = p.select("session_id", "k", "num_channels", F.posexplode("processed").alias("i", "v"))
    return e.select(
        "session_id",
        "k",
        F.pmod(F.col("i"), C).cast("int").alias("channel"),
        (F.col("i") / C).cast("int").alias("bin"),
        r6(F.col("v")).alias("value"),
    )


@query
def q_late_side_table(spark, sf_dir):
    """T2 stream side: events arrive in three batches, one per producer group.
    Each group is staged and consumed by its own availableNow run on the same
    checkpoint (so each run is one micro-batch, whatever the file counts, and
    every run restarts the sink, which re-reads its running maximum).  Rows
    behind the running watermark (1 h delay) go to a side table, read back."""
    ev = B.table(spark, sf_dir, "events")
    files = stream_files(spark)
    src, side = scratch_dir(spark, "late-input"), scratch_dir(spark, "late-side")
    ckpt = scratch_dir(spark, "late-side-checkpoint")
    for b in range(len(B.ARRIVAL_GROUPS)):
        stage_files(ev.where(B.arrival_batch() == b), "late-input", files=files, path=src)
        stream = spark.readStream.schema(ev.schema).parquet(src)
        run_available_now(stream, "late-side", foreach_batch=late_rows_sink(side, "ts", 3600.0), checkpoint=ckpt)
    late = read_if_written(spark, f"{side}/late")
    if late is None:  # no late rows at all
        return spark.createDataFrame([], "event_id bigint, batch_id int")
    return late.select("event_id", F.col("batch_id").cast("int").alias("batch_id"))


STREAM_WINDOW_DELAY = "5 seconds"


@query
def q_stream_windows(spark, sf_dir):
    """W2 on a stream: frames staged as files and consumed with availableNow;
    blocks of windows are keyed by their event-time end with a 5 s watermark
    and emitted (append) when the watermark passes them — the closed subset
    of ``sample_windows``."""
    staged = stage_files(B.frame_rows(spark, sf_dir), "frames-w2-stream", files=stream_files(spark))
    stream = spark.readStream.schema(spark.read.parquet(staged).schema).parquet(staged)
    wins = W.sample_windows(stream, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP, delay=STREAM_WINDOW_DELAY)
    out = run_available_now(window_report(wins), "stream-windows")
    return spark.read.parquet(out)


@query
def q_stream_window_scores(spark, sf_dir):
    """The flagship as a stream: frames → W2 (watermarked blocks) → model →
    event time → result rows appended to the ``data`` table."""
    staged = stage_files(B.frame_rows(spark, sf_dir), "frames-score-stream", files=stream_files(spark))
    stream = spark.readStream.schema(spark.read.parquet(staged).schema).parquet(staged)
    wins = W.sample_windows(stream, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP, delay=STREAM_WINDOW_DELAY)
    out = run_available_now(data_rows(score(wins)), "stream-window-scores")
    return spark.read.parquet(out)
