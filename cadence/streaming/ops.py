"""Streaming operators.

The reference runs on processing time with no watermark; here streams run on
event time (P5) with ``withWatermark`` so a replay gives the same result as
the batch job on the closed windows.  Each operator also has a batch form
that states the same rule over a whole table."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cadence.session import read_if_written


# ---- T1 ------------------------------------------------------------------------------
def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event-time column as TIMESTAMP (watermarks reject TIMESTAMP_NTZ)
    with a watermark ``delay`` behind the largest time seen."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


# ---- T2 ------------------------------------------------------------------------------
def split_late(df: DataFrame, ts: str, batch: str, delay_s: float) -> DataFrame:
    """T2 (batch rule): a row of arrival batch b is late when its time is
    below (largest time of batches < b) − delay, i.e. behind the watermark the
    stream had when b arrived.  Adds ``is_late``.  The per-batch maxima table
    has one row per arrival batch."""
    maxima = df.groupBy(batch).agg(F.max(F.col(ts).cast("timestamp")).alias("_mx"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    wm = maxima.withColumn("_wm", F.max("_mx").over(before) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(delay_s)))
    out = df.join(wm.select(batch, "_wm"), batch, "left")
    late = F.coalesce(F.col(ts).cast("timestamp") < F.col("_wm"), F.lit(False))
    return out.withColumn("is_late", late).drop("_wm")


def late_rows_sink(path: str, ts: str, delay_s: float):
    """T2 (stream side): a ``foreachBatch`` function writing the rows of each
    micro-batch that fall behind the running watermark (largest time of the
    earlier batches − delay) to ``path/late`` (side table), keyed by batch id
    so a replayed batch overwrites itself.  The running maximum is stored per
    batch under ``path/marks`` and re-read after a driver restart."""
    state = {"max": None, "batch": None}

    def previous_max(spark, batch_id: int):
        marks = read_if_written(spark, f"{path}/marks")  # None: no mark written yet
        return None if marks is None else marks.where(F.col("batch_id") < batch_id).agg(F.max("max_ts")).first()[0]

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        mx = state["max"] if state["batch"] == batch_id - 1 else previous_max(spark, batch_id)
        if mx is not None:
            cut = F.lit(mx) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(delay_s))
            late = batch_df.where(F.col(ts).cast("timestamp") < cut).withColumn("batch_id", F.lit(batch_id))
            late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        new_max = batch_df.agg(F.max(F.col(ts).cast("timestamp"))).first()[0]
        if mx is not None and (new_max is None or mx > new_max):
            new_max = mx
        spark.createDataFrame([(new_max,)], "max_ts timestamp").write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        state["max"], state["batch"] = new_max, batch_id

    return sink


# ---- T3 ------------------------------------------------------------------------------
def dedup_frames(df: DataFrame, keys: list[str], ts: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop redelivered rows.  Streams keep a key's state only while it is
    within the watermark; batch DataFrames use plain ``dropDuplicates``."""
    if df.isStreaming:
        if ts is None or delay is None:
            raise ValueError("streaming dedup needs an event-time column and a delay")
        return with_event_time(df, ts, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


# ---- T4 ------------------------------------------------------------------------------
def drop_expired(df: DataFrame, received_at: str, ttl_s: float, as_of: Column) -> DataFrame:
    """T4: keep messages received no more than ``ttl_s`` before ``as_of``."""
    cut = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_s))
    return df.where(F.col(received_at).cast("timestamp") >= cut.cast("timestamp"))


# ---- T6 ------------------------------------------------------------------------------
#: Sample time a session's missing frame is waited for.
LATENESS_S = 86_400.0
#: Windows leave the cursor in tables of about this many bytes of samples.
TABLE_BYTES = 4 << 20
WINDOW_OUT = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("k", T.LongType()),
        T.StructField("start_idx", T.LongType()),
        T.StructField("frame_number", T.IntegerType()),
        T.StructField("time_stamp", T.IntegerType()),
        T.StructField("sampling_rate", T.IntegerType()),
        T.StructField("num_samples", T.IntegerType()),
        T.StructField("num_channels", T.IntegerType()),
        T.StructField("channel_names", T.ArrayType(T.StringType())),
        T.StructField("samples", T.ArrayType(T.FloatType())),
    ]
)
#: Samples are kept as float32 bytes.
CURSOR_STATE = T.StructType(
    [
        T.StructField("next_k", T.LongType()),
        T.StructField("buf_start", T.LongType()),
        T.StructField("have_until", T.LongType()),
        T.StructField("buf", T.BinaryType()),
        T.StructField("fr_start", T.ArrayType(T.LongType())),
        T.StructField("fr_num", T.ArrayType(T.IntegerType())),
        T.StructField("pend_start", T.ArrayType(T.LongType())),
        T.StructField("pend_num", T.ArrayType(T.IntegerType())),
        T.StructField("pend_data", T.ArrayType(T.BinaryType())),
        T.StructField("user_name", T.StringType()),
        T.StructField("fs", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("gap_start", T.ArrayType(T.LongType())),
        T.StructField("gap_end", T.ArrayType(T.LongType())),
    ]
)


def _java_int(v):
    """The JVM's ``(int)`` cast of floats (same rule as ``header.java_int``)."""
    v = np.asarray(v, np.float64)
    return np.where(np.isnan(v), 0, np.clip(np.trunc(v), -(2**31), 2**31 - 1)).astype(np.int64)


def _int32(values: np.ndarray, there: np.ndarray):
    """Int32 column with nulls where not ``there``."""
    return pd.arrays.IntegerArray(np.where(there, values, 0).astype(np.int32), ~there)


def _stride(length_s: float, overlap: float, fs: int) -> tuple[int, int]:
    L = int(np.float32(length_s) * np.float32(fs))
    S = int(float((np.float32(1.0) - np.float32(overlap)) * np.float32(length_s) * np.float32(fs)) + 0.5)
    return L, S


def _take_from(starts: list[int], ends: list[int], a: int, b: int) -> bool:
    """Cuts [a, b) out of the lost ranges, which are in order and disjoint;
    tells whether any of it was lost."""
    i, j = bisect_right(ends, a), bisect_left(starts, b)
    if i >= j:
        return False
    rest = [(x, y) for x, y in ((starts[i], a), (b, ends[j - 1])) if x < y]
    starts[i:j], ends[i:j] = [x for x, _ in rest], [y for _, y in rest]
    return True


def _late_table(own: dict, late: list[tuple]) -> pd.DataFrame:
    """Frames that came after they were given up: rows without ``k``."""
    none = np.zeros(len(late), bool)
    return pd.DataFrame(
        own
        | {
            "k": pd.arrays.IntegerArray(np.zeros(len(late), np.int64), ~none),
            "start_idx": [a for a, _, _ in late],
            "frame_number": [f for _, f, _ in late],
            "time_stamp": _int32(none, none),
            "num_samples": [len(d) // own["num_channels"] for _, _, d in late],
            "samples": [d for _, _, d in late],
        }
    )


def _window_tables(own: dict, fs: int, L: int, S: int, t: int, runs: list[tuple], values, fr_start, fr_num) -> Iterator[pd.DataFrame]:
    """The windows of all runs, (first, end, place of sample 0) in ``values``,
    in tables of bounded size."""
    C = own["num_channels"]
    k = np.concatenate([np.arange(first, end) for first, end, _ in runs])
    place = k * S + np.repeat([at for _, _, at in runs], [end - first for first, end, _ in runs])
    fr_start, fr_num = np.array(fr_start, np.int64), np.array(fr_num, np.int64)
    every = np.lib.stride_tricks.sliding_window_view(values, L * C)
    step = max(1, TABLE_BYTES // (4 * L * C))
    for lo in range(0, len(k), step):
        s0 = k[lo : lo + step] * S
        win = every[place[lo : lo + step] * C]
        at = np.searchsorted(fr_start, s0, side="right") - 1  # the frame holding s0
        if t >= 0:
            stamp = _java_int(win[:, t])
        else:
            stamp = np.minimum(s0 // fs, 2**31) * 1000 + (s0 % fs) * 1000 // fs
        yield pd.DataFrame(
            own
            | {
                "k": pd.array(k[lo : lo + step], "Int64"),
                "start_idx": s0,
                "frame_number": fr_num[at],
                "time_stamp": _int32(stamp, stamp < 2**31),
                "num_samples": L,
                "samples": list(win),
            }
        )


def _cursor_fn(
    length_s: float, overlap: float, has_start: bool = False, max_pending: int | None = None, lateness_s: float | None = None
):
    """The cursor of a session over one micro-batch.  Its work and memory grow
    with the frames at hand and the windows they give, in any order of arrival
    and with any number of frames lost."""

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (session,) = key
        if state.exists:
            (next_k, buf_start, have_until, buf, fr_start, fr_num, p_start, p_num, p_data, user, fs, C, names, g_start, g_end) = state.get
            buf = np.frombuffer(buf, np.float32)
            fr_start, fr_num, g_start, g_end = list(fr_start), list(fr_num), list(g_start), list(g_end)
            pending = {a: (n, np.frombuffer(d, np.float32)) for a, n, d in zip(p_start, p_num, p_data)}
        else:
            next_k, buf_start, have_until, buf, fr_start, fr_num, pending = 0, 0, 0, np.zeros(0, np.float32), [], [], {}
            user = fs = C = names = None
            g_start, g_end = [], []  # lost ranges
        late = []
        for pdf in batches:
            if not len(pdf):
                continue
            if fs is None:
                row = pdf.iloc[0]
                user, fs, C, names = row["user_name"], int(row["sampling_rate"]), int(row["num_channels"]), list(row["channel_names"])
            number = pdf["frame_number"].astype("int64")
            start = (pdf["start"] if has_start else number * pdf["num_samples"]).astype("int64")
            for a, n, d in zip(start.tolist(), number.tolist(), pdf["samples"]):
                d = np.asarray(d, dtype=np.float32)
                if a >= have_until:
                    pending[a] = (n, d)
                # behind the cursor: a redelivered frame, or one that was given up
                elif g_start and _take_from(g_start, g_end, a, a + len(d) // C):
                    late.append((a, n, d))
        if fs is None:
            return
        L, S = _stride(length_s, overlap, fs)
        t = next((i for i, nm in enumerate(names) if nm.lower() == "time"), -1)
        # runs of samples lie end to end; ``base`` is the place of the last one's sample 0
        parts, runs, base = [buf], [], -buf_start
        waiting, at = sorted(pending), 0
        while True:
            # append frames that continue the contiguous run
            while have_until in pending:
                n, d = pending.pop(have_until)
                fr_start.append(have_until)
                fr_num.append(n)
                parts.append(d[: len(d) // C * C])
                have_until += len(d) // C
            if L > 0 and S > 0 and next_k * S + L < have_until:
                end = -((L - have_until) // S)
                runs.append((next_k, end, base))
                next_k = end
            while at < len(waiting) and (waiting[at] < have_until or waiting[at] not in pending):
                pending.pop(waiting[at], None)
                at += 1
            over = max_pending is not None and len(waiting) - at > max_pending
            old = at < len(waiting) and lateness_s is not None and waiting[-1] - have_until > lateness_s * fs
            if not over and not old:
                break
            # the frame before those that wait counts as lost; go on with the
            # first window that starts behind the gap
            g_start.append(have_until)
            g_end.append(waiting[at])
            base += have_until - waiting[at]
            have_until = waiting[at]
            next_k = max(next_k, -(-have_until // S)) if S > 0 else next_k
        values = np.concatenate(parts)
        parts.clear()
        # keep samples (and frame starts) from the next window start on
        keep_from = min(next_k * S, have_until) if L > 0 and S > 0 else have_until
        j = max(0, bisect_right(fr_start, keep_from) - 1)
        state.update(
            (
                next_k, keep_from, have_until, values[(keep_from + base) * C :].tobytes(), fr_start[j:], fr_num[j:],
                list(pending), [v[0] for v in pending.values()], [v[1].tobytes() for v in pending.values()],
                user, fs, C, names, g_start, g_end,
            )
        )
        own = {"session_id": session, "user_name": user, "sampling_rate": fs, "num_channels": C}

        tables = [_late_table(own, late)] if late else []
        if runs:
            tables = chain(tables, _window_tables(own, fs, L, S, t, runs, values, fr_start, fr_num))
        for table in tables:
            table["channel_names"] = [names] * len(table)
            yield table[WINDOW_OUT.names]

    return fn


def stateful_windows(
    frames: DataFrame,
    length_s: float = 1.0,
    overlap: float = 0.8,
    session: str = "session_id",
    start_col: str | None = None,
    max_pending: int | None = None,
    lateness_s: float | None = LATENESS_S,
) -> DataFrame:
    """Sample windows with an explicit per-session cursor in state —
    next window index, the sample tail it still needs and frames that arrived
    ahead of a gap.  Emits each window once, when the sample after its end has
    arrived (the rule of W2, which needs no state).  A missing frame counts as
    lost once a frame of its session starts more than ``lateness_s`` of sample
    time behind the gap (or, if ``max_pending`` is given, once more frames than
    that wait): the windows that need it are skipped, and the cursor goes on
    behind the gap.  ``lateness_s`` must exceed the disorder of arrival; None
    waits for ever.  A lost frame that comes after all is a row without ``k``
    (``split_late_frames``); frames redelivered are dropped.  A session that
    ends within ``lateness_s`` of a gap keeps the frames behind it in state.
    A frame's first sample index is ``start_col`` when given (frames of varying
    length), else frame_number · num_samples."""
    cols = ["user_name", "frame_number", "sampling_rate", "num_samples", "num_channels", "channel_names", "samples"]
    extra = [F.col(start_col).cast("long").alias("start")] if start_col else []
    return frames.select(session, *cols, *extra).groupBy(session).applyInPandasWithState(
        _cursor_fn(length_s, overlap, bool(start_col), max_pending, lateness_s),
        WINDOW_OUT, CURSOR_STATE, "append", GroupStateTimeout.NoTimeout,
    )


def split_late_frames(out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(windows, side table of the frames that came after they were given
    up) of what ``stateful_windows`` wrote."""
    late = out.where("k is null").select(
        "session_id", "user_name", F.col("start_idx").alias("start"), "frame_number",
        "sampling_rate", "num_samples", "num_channels", "channel_names", "samples",
    )
    return out.where("k is not null"), late
