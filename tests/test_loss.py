"""Redelivered, lost and gapped input: nothing vanishes, nothing is corrupted."""

import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadence.functions.header import check_header
from cadence.operators import dsp, ordinal, windows
from cadence.operators.labels import class_counts, split_unknown
from cadence.schemas import HEADER
from cadence.streaming.ops import _cursor_fn


def frames(spark, numbers, per_frame=8):
    base = windows.samples_as_frames(
        spark.createDataFrame([(1, 0, 0.0)], "s long, i long, v double"), "s", "i", "v", 8
    ).drop("frame_number", "num_samples", "samples", "start")
    rows = spark.createDataFrame(
        [(n, [float(x) for x in range(n * per_frame, (n + 1) * per_frame)]) for n in numbers], "frame_number int, samples array<float>"
    )
    return base.crossJoin(rows).withColumn("num_samples", F.lit(per_frame)).withColumn("start", F.col("frame_number").cast("long") * per_frame)


def test_windows_of_overlapping_frames_lose_nothing(spark):
    """All samples are there: a short copy beside a frame, or a frame that
    starts inside the one before and reaches beyond it, costs no window."""
    fs, length = 8, 8
    signal = [float(x) for x in range(48)]

    def run(spans):
        head = "session_id string, user_name string, year int, month int, day int, hour int, minute int, second int, microsecond int, frame_number int, time_stamp int, ML_model string, preprocessing string, sampling_rate int, num_samples int, num_channels int, channel_names array<string>, samples array<float>, start long"
        rows = [("s", "u", 2024, 1, 1, 0, 0, 0, 0, n, 0, "m", "p", fs, hi - lo, 1, ["EEG"], signal[lo:hi], lo) for n, (lo, hi) in enumerate(spans)]
        got = windows.sample_windows(spark.createDataFrame(rows, head), 1.0, 0.75, start_col="start").collect()
        for r in got:
            assert list(r.samples) == signal[r.start_idx : r.start_idx + length]
        return sorted(r.k for r in got)

    plain = [(n, n + 8) for n in range(0, 48, 8)]
    whole = run(plain)
    assert whole == list(range(20))
    assert run([*plain, (16, 19)]) == whole
    assert run([*plain[:2], (14, 24), *plain[3:]]) == whole
    assert run([*plain, (0, 48), (5, 30)]) == whole
    assert run([p for p in plain if p != (16, 24)]) != whole


@pytest.mark.parametrize("numbers", [[0, 1, 2, 3, 4, 5], [5, 1, 0, 1, 3, 2, 4, 1], [0, 1, 1, 3, 4, 5]])
def test_windows_of_redelivered_and_lost_frames(spark, numbers):
    got = windows.sample_windows(frames(spark, numbers), 1.0, 0.8, start_col="start").collect()
    have = {x for n in numbers for x in range(n * 8, n * 8 + 8)}
    want = {k: list(range(2 * k, 2 * k + 8)) for k in range(24) if all(x in have for x in range(2 * k, 2 * k + 9))}
    assert {r["k"]: [int(x) for x in r["samples"]] for r in got} == want
    assert len(got) == len(want)


def test_segments_do_not_depend_on_blocks_or_gaps(spark):
    x = [(None if i % 2 else 7, i, float(i % 13)) for i in range(2000) if not 500 <= i < 900]
    df = spark.createDataFrame(x, "s int, i long, v double")
    seen = []
    for hops in (4, 16, 64, 1000):
        rows = windows.stft_segments(df, ["s"], "i", "v", 50, 40, hops).collect()
        seen.append(sorted((str(r["s"]), r["seg"], tuple(r["segment"])) for r in rows))
    assert all(s == seen[0] for s in seen)
    assert {k: sum(r[0] == k for r in seen[0]) for k in ("7", "None")} == {"7": 200, "None": 201}


def test_positions_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, i) for i in range(1000)], "k int, v long")
    for target in (100, 10_000):
        rows = ordinal.position_within(df, ["k"], ["v"], min_rows_per_bucket=target).collect()
        assert len(rows) == 1000
        for k in (None, 0, 1, 2):
            own = sorted((r["v"], r["pos"]) for r in rows if r["k"] == k)
            assert [p for _, p in own] == list(range(len(own)))


HEAD = dict(
    session_id="a", user_name="u", frame_number=1, sampling_rate=250, num_samples=4, num_channels=2, channel_names=["x", "y"]
)


@pytest.mark.parametrize("field", ["session_id", "frame_number", "sampling_rate", "num_samples", "num_channels", "channel_names"])
def test_a_missing_header_field_is_a_defect(spark, field):
    texts = [HEAD, {k: v for k, v in HEAD.items() if k != field}, HEAD | {field: None}]
    df = spark.createDataFrame([(json.dumps(t),) for t in texts], "t string").select(F.from_json("t", HEADER).alias("h"))
    assert [r[0] for r in df.select(check_header(F.col("h"))).collect()] == [True, False, False]


def test_filter_takes_null_samples_as_zero_for_any_block(spark):
    rng = np.random.default_rng(0)
    x = [(1, i, None if i == 400 else float(v)) for i, v in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(x, "s int, i long, v double")
    out = []
    for block in (100, 65_536):
        rows = dsp.filter_signals(df, ["s"], "i", "v", 250.0, block=block).orderBy("i").collect()
        out.append([r["filtered"] for r in rows])
    assert len(out[0]) == 600 and not np.isnan(out[0]).any()
    assert np.max(np.abs(np.array(out[0]) - np.array(out[1]))) < 1e-9


class State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_cursor_goes_on_behind_a_lost_frame():
    fn, state, seen = _cursor_fn(1.0, 0.8, True, max_pending=3), State(), {}
    for n in [0, 1, 2, 4, 5, 6, 7, 8, 9, 10]:  # frame 3 never comes
        row = pd.DataFrame(
            [("u", n, 8, 8, 1, ["v"], [float(x) for x in range(n * 8, n * 8 + 8)], n * 8)],
            columns=["user_name", "frame_number", "sampling_rate", "num_samples", "num_channels", "channel_names", "samples", "start"],
        )
        for out in fn(("s",), iter([row]), state):
            for r in out.itertuples(index=False):
                seen[r[2]] = [int(x) for x in r[-1]]
    want = {k: list(range(2 * k, 2 * k + 8)) for k in range(40) if 2 * k + 8 < 24 or (2 * k >= 32 and 2 * k + 8 < 88)}
    assert seen == want
    assert len(state.get[6]) <= 3


def cursor_input(numbers, values):
    """Frames of 16 samples of 4 channels as one table of a micro-batch."""
    own = dict(user_name="u", sampling_rate=16, num_samples=16, num_channels=4)
    table = pd.DataFrame({"frame_number": numbers, "samples": list(values.reshape(-1, 64)[numbers]), **own})
    table["channel_names"] = [["a", "b", "c", "d"]] * len(table)
    return iter([table])


def test_cursor_cuts_a_long_session_in_linear_time():
    """12,000 scrambled frames in two halves, within 5 s of CPU (16 s when the
    list of frames was gone through for each window), in tables of bounded size."""
    n = 12_000
    rng = np.random.default_rng(3)
    values = rng.normal(size=n * 64).astype(np.float32)
    order = rng.permutation(n)
    fn, state, out = _cursor_fn(1.0, 0.75), State(), []
    began = time.process_time()
    for half in (order[: n // 2], order[n // 2 :]):
        out += fn(("s",), cursor_input(half, values), state)
    assert time.process_time() - began < 5
    assert max(len(t) for t in out) * 64 * 4 <= 4 << 20
    got = pd.concat(out)
    assert got["k"].tolist() == list(range((n - 1) * 4)) and (got["frame_number"] == got["k"] // 4).all()
    assert (np.stack(got["samples"]) == np.lib.stride_tricks.sliding_window_view(values, 64)[::16][: len(got)]).all()


def test_cursor_gives_up_many_frames_in_linear_time():
    """Every fourth of 20,000 frames is lost and comes at the end, scrambled:
    within 5 s of CPU (31 s when all waiting frames were gone through for each
    gap, all gaps for each late frame)."""
    n = 20_000
    rng = np.random.default_rng(4)
    values = rng.normal(size=n * 64).astype(np.float32)
    lost = np.arange(1, n - 4, 4)
    fn, state = _cursor_fn(1.0, 0.75, lateness_s=2.0), State()
    began = time.process_time()
    first = pd.concat(fn(("s",), cursor_input(rng.permutation(np.setdiff1d(np.arange(n), lost)), values), state))
    late = pd.concat(fn(("s",), cursor_input(rng.permutation(lost), values), state))
    assert time.process_time() - began < 5
    there = np.repeat(~np.isin(np.arange(n), lost), 16)
    upto = np.r_[0, np.cumsum(there)]
    s0 = np.arange((n - 1) * 4) * 4
    want = s0[upto[s0 + 17] - upto[s0] == 17]
    assert first["start_idx"].tolist() == want.tolist()
    assert late["k"].isna().all() and sorted(late["frame_number"]) == lost.tolist()
    assert all((d == values[f * 64 : f * 64 + 64]).all() for f, d in zip(late["frame_number"], late["samples"]))
    assert not len(state.get[-1])


def test_unknown_labels_are_counted_and_quarantined(spark):
    df = spark.createDataFrame([(1, "bckg"), (1, "xxxz"), (1, None), (2, "fnsz")], "recording_id int, label string")
    assert {tuple(r) for r in class_counts(df).collect()} == {(1, 1, 2), (2, 0, 1)}
    known, unknown = split_unknown(df)
    assert known.count() == 2 and {r["label"] for r in unknown.collect()} == {"xxxz", None}
