"""Chained streams and windows from keyed blocks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cadence.operators import dsp, windows as W
from cadence.functions.header import time_channel_idx
from cadence.plans import bindings as B, catalog
from cadence.session import scratch_dir
from cadence.sources.frames import decode_frames
from cadence.streaming import chain as chain_module
from cadence.streaming.blocks import BLOCK_WINDOWS, block_windows, split_late_frames
from cadence.streaming.runner import run_available_now, stage_files
from tests.conftest import SF_SMALL

FS, N, C = 10, 7, 2  # 7 samples a frame, two channels
LENGTH, OVERLAP = 1.0, 0.5  # L = 10, S = 5
HEADER = dict(
    user_name="u", time_stamp=0, year=2024, month=1, day=1, hour=0, minute=0, second=0, microsecond=0, ML_model="default",
    preprocessing="standard", sampling_rate=FS, num_samples=N, num_channels=C, channel_names=["a", "b"],
)
T0 = dt.datetime(2024, 5, 1)


def frame(session, number, minute, day=1):
    samples = [float(1000 * number + i) for i in range(N * C)]
    return dict(HEADER, session_id=session, frame_number=number, day=day, samples=samples, got=T0 + dt.timedelta(minutes=minute))


SCHEMA = (
    "session_id string, user_name string, frame_number int, time_stamp int, year int, month int, day int, hour int, minute int, "
    "second int, microsecond int, ML_model string, preprocessing string, sampling_rate int, num_samples int, num_channels int, "
    "channel_names array<string>, samples array<float>, got timestamp"
)


def table(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)


def streamed(spark, steps, **kw):
    """What block_windows writes for frames that arrive in the given steps, one run each."""
    path, ckpt, out = (scratch_dir(spark, f"test-blocks-{x}") for x in ("in", "ckpt", "out"))
    for rows in steps:
        stage_files(table(spark, rows), "x", files=1, path=path)
        stream = spark.readStream.schema(SCHEMA).parquet(path)
        run_available_now(block_windows(stream, LENGTH, OVERLAP, **kw), "x", checkpoint=ckpt, path=out)
    return spark.read.parquet(out)



def found(df):
    return sorted((r["session_id"], r["k"], r["start_idx"], r["frame_number"], tuple(r["samples"])) for r in df.collect())


def batch(spark, rows):
    return found(W.sample_windows(table(spark, rows), LENGTH, OVERLAP))


def test_blocks_in_any_order_with_gap_and_copies(spark):
    long = [frame("long", i, i) for i in range(60)]  # several blocks of one session
    assert 60 * N > 3 * BLOCK_WINDOWS * 5
    gap = [frame("gap", i, i) for i in range(30) if i != 11]  # lost for good
    days = [frame("later", i, i, day=3) for i in range(12)]  # a clock two days ahead
    rows = long + gap + days
    order = np.random.default_rng(3).permutation(len(rows))
    steps = [[rows[i] for i in part] for part in np.array_split(order, 4)]
    steps[2] += steps[0][:5]  # redelivered
    steps.append([frame("gap", 29, 99), frame("long", 3, 99)])
    out = streamed(spark, steps)
    windows, late = split_late_frames(out)
    assert found(windows) == batch(spark, rows)
    assert late.count() == 0
    # the tail: every window whose next sample is there
    assert windows.where("session_id = 'long'").count() == -(-(60 * N - 10) // 5)


def test_blocks_let_go_and_frames_that_come_after(spark):
    """Event-time timers on arrival: a block without a frame for an hour goes."""
    first = [frame("s", 0, 0), frame("s", 2, 1)]  # frame 1 is missing
    other = [frame("t", i, 200 + i) for i in range(4)]
    clock = [frame("u", i, 400 + i) for i in range(2)]  # moves the watermark on
    late = [frame("s", 1, 402)]
    kw = dict(arrival="got", disorder="1 minute", idle_ms=3_600_000)
    out = streamed(spark, [first, other, clock, clock, late], **kw)
    windows, side = split_late_frames(out)
    assert found(windows) == batch(spark, first + other + clock)
    assert [(r["session_id"], r["start"], r["frame_number"]) for r in side.collect()] == [("s", 7, 1)]
    # in time, it is not late
    out = streamed(spark, [first, [frame("s", 1, 30)], other, clock], **kw)
    assert found(split_late_frames(out)[0]) == batch(spark, first + other + clock + [frame("s", 1, 30)])


def test_chain_survives_a_failed_hop(spark, monkeypatch):
    bytes_ = B.frame_bytes(spark, SF_SMALL).select("value", "received_at")
    path = stage_files(bytes_, "test-chain", files=4)
    own = chain_module.Chain(spark)
    own.run_windower(path, B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP, files=2, disorder="1 day")
    sound = chain_module.processor

    def broken(messages):
        return sound(messages).withColumn("value", F.when(F.crc32("value") % 3 == 0, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("value")))

    monkeypatch.setattr(chain_module, "processor", broken)
    with pytest.raises(StreamingQueryException):
        own.run_processor(files=2)
    monkeypatch.setattr(chain_module, "processor", sound)
    again = chain_module.Chain(spark, own.root)  # a new driver
    again.run_processor(files=2)
    again.run_scorer()
    again.run_scorer()  # nothing new
    want = catalog.QUERIES["window_scores"](spark, SF_SMALL)
    assert sorted(map(tuple, again.results().collect())) == sorted(map(tuple, want.collect()))
    total = {r["hop"]: (r["a"], r["b"]) for r in again.ledger().groupBy("hop").agg(F.sum("rows_in").alias("a"), F.sum("rows_out").alias("b")).collect()}
    n = want.count()
    assert total == {"windower": (bytes_.count(), n), "processor": (n, n), "scorer": (n, n)}
    # the routed messages hold the processed windows of the batch pipeline
    w = W.sample_windows(B.frame_rows(spark, SF_SMALL), B.FRAMES_LENGTH_S, B.FRAMES_OVERLAP)
    done = dsp.transform_windows(w, "standard", time_idx=time_channel_idx(F.col("channel_names")))
    batch_rows = {(r[0], r[1]): r[2] for r in done.select("session_id", "time_stamp", "processed").collect()}
    got = decode_frames(spark.read.parquet(own.processed)).select("session_id", "time_stamp", "samples").collect()
    assert len(got) == len(batch_rows)
    for r in got:
        assert np.allclose(r[2], batch_rows[r[0], r[1]], rtol=1e-5, atol=1e-3)
    sessions = spark.read.parquet(own.sessions).select("sess_id")
    assert sessions.count() == sessions.distinct().count() == want.select("sess_id").distinct().count()
