"""T6 over (session, block): sample windows from keyed state that emit as soon
as their samples are there, whatever the order and delay of arrival.

A session is cut into blocks of its sample axis, as in W2; a frame is sent to
the blocks that need it, so one session spreads over as many state groups as it
has blocks.  A block's state holds its samples and which windows are out.  A
window is emitted once, in the micro-batch in which the last of its samples or
the sample past its end arrives: no watermark holds it back or drops it, the
tail of a session comes out with its last frame, and sessions whose clocks are
days apart do not know of each other.  A lost frame keeps back the windows that
need it and no others.

Timers run on the time of arrival, which is one clock for all sessions: a block
that received nothing for ``idle`` is let go, its samples are dropped and a
small mark stays.  A frame that comes after that is a row without ``k``
(``split_late_frames``), not lost.  After ``forget`` more the mark goes too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cadence.functions.header import window_time_stamp, time_channel_idx
from cadence.operators.windows import int_range, window_length, window_stride
from cadence.schemas import HEADER, HEADER_NAMES
from cadence.session import ensure_rocksdb

#: Windows a block hosts at most; its state is (BLOCK_WINDOWS · S + L) · C samples.
BLOCK_WINDOWS = 16
#: Milliseconds of arrival time.
IDLE = 3_600_000
FORGET = 86_400_000

_STATE = (
    "samples array<float>, there binary, frame_start array<long>, frame_header array<string>, emitted binary, gone boolean"
)
_OUT = "session_id string, header string, k long, start_idx long, n long, samples array<float>"


def _processor(idle_ms: int | None, forget_ms: int) -> StatefulProcessor:
    """The state machine of a block.  A class made in a function travels whole:
    the driver's own Python worker, which starts it first, does not see the
    files that were added to the session."""

    class Blocks(StatefulProcessor):
        def __init__(self, idle_ms: int | None, forget_ms: int):
            self.idle_ms, self.forget_ms = idle_ms, forget_ms  # idle None: no timers

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("block", _STATE)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            session, block, L, S, C = key
            H = BLOCK_WINDOWS * S
            base, size = block * H, H - S + L + 1  # the last window's samples and the one past its end
            came = pd.concat(rows).sort_values("start", kind="stable")
            old = self.state.get() if self.state.exists() else None
            if old is not None and old[5]:
                if not np.frombuffer(old[4], bool).all():  # else all is out, and these are redelivered
                    yield self._table(session, came["header"], None, came["start"], came["n"], came["samples"])
                return
            if old is None:
                buf, there = np.zeros((size, C), np.float32), np.zeros(size, bool)
                f_start, f_header, emitted = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(BLOCK_WINDOWS, bool)
            else:
                buf, there = np.array(old[0], np.float32).reshape(size, C), np.frombuffer(old[1], bool).copy()
                f_start, f_header = np.array(old[2], np.int64), np.array(old[3], object)
                emitted = np.frombuffer(old[4], bool).copy()
            # all samples of the batch with their places; the first to arrive at a place stays
            values = np.concatenate([np.asarray(x, np.float32) for x in came["samples"]]).reshape(-1, C)
            starts, counts = came["start"].to_numpy(np.int64), came["n"].to_numpy(np.int64)
            place = np.repeat(starts - base - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            place, first = np.unique(place, return_index=True)
            new = ~there[place]
            buf[place[new]] = values[first][new]
            there[place] = True
            f_start, at = np.unique(np.r_[f_start, starts], return_index=True)
            f_header = np.r_[f_header, came["header"].to_numpy(object)][at]
            # windows with all samples and the one past their end
            upto = np.r_[0, np.cumsum(there)]
            begin = np.arange(BLOCK_WINDOWS) * S
            ready = np.flatnonzero((upto[begin + L + 1] - upto[begin] == L + 1) & ~emitted)
            emitted[ready] = True
            done = bool(emitted.all())
            kept = ([], b"", [], []) if done else (buf.reshape(-1).tolist(), there.tobytes(), f_start.tolist(), f_header.tolist())
            self.state.update((*kept, emitted.tobytes(), done))
            if self.idle_ms is not None:
                self._wait(int(came["at"].max()) + (self.forget_ms if done else self.idle_ms))
            if len(ready):
                s0 = base + begin[ready]
                own = f_header[np.searchsorted(f_start, s0, "right") - 1]
                cut = [buf[i : i + L].reshape(-1) for i in begin[ready].tolist()]
                yield self._table(session, own, block * BLOCK_WINDOWS + ready, s0, L, cut)

        @staticmethod
        def _table(session, header, k, start, n, samples) -> pd.DataFrame:
            k = pd.array(k, "Int64") if k is not None else pd.array([None] * len(header), "Int64")
            return pd.DataFrame({"session_id": session, "header": header, "k": k, "start_idx": start, "n": n, "samples": list(samples)})

        def _wait(self, until_ms: int) -> None:
            """One timer a block, never moved back."""
            set_ = list(self.handle.listTimers())
            if not set_ or max(set_) < until_ms:
                for t in set_:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(until_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            old = self.state.get() if self.state.exists() else None
            if old is None or old[5]:
                self.state.clear()
            else:
                self.state.update(([], b"", [], [], old[4], True))
                self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.forget_ms)
            return iter(())

        def close(self) -> None:
            pass

    return Blocks(idle_ms, forget_ms)


def block_windows(
    frames: DataFrame,
    length_s: float = 1.0,
    overlap: float = 0.8,
    session: str = "session_id",
    start_col: str | None = None,
    arrival: str | None = None,
    disorder: str = "10 minutes",
    idle_ms: int = IDLE,
    forget_ms: int = FORGET,
) -> DataFrame:
    """The windows of a stream of frames (header fields and ``samples``),
    each once, as soon as its samples and the one past its end have come; the
    rows of W2 without ``n_frames``.

    Frames may come in any order, twice, or overlap (of samples that come twice
    the first counts).  ``arrival`` names the time a frame was received, in
    order but for ``disorder``; blocks without a frame for ``idle_ms`` of it are
    let go, and frames that come for one after that are rows whose ``k`` is
    null, one for each such block.  Without ``arrival`` state is kept.  Every frame crosses the shuffle about (H + L) / H times, H
    being BLOCK_WINDOWS strides.  The session's streams keep their state in
    RocksDB from here on (``ensure_rocksdb``)."""
    ensure_rocksdb(frames.sparkSession)
    fs, C = F.col("sampling_rate"), F.col("num_channels").cast("long")
    n = F.col("num_samples").cast("long")
    a = F.col(start_col).cast("long") if start_col else F.col("frame_number").cast("long") * n
    at = F.col(arrival).cast("timestamp") if arrival else F.lit(None).cast("timestamp")
    own = frames.select(
        F.col(session).cast("string").alias("session_id"), F.to_json(F.struct(*HEADER_NAMES)).alias("header"), "samples",
        at.alias("_at"), a.alias("_a"), n.alias("_n"), C.alias("_C"),
        window_length(length_s, fs).cast("long").alias("_L"), window_stride(length_s, overlap, fs).cast("long").alias("_S"),
    ).where("_L > 0 AND _S > 0 AND _n > 0")
    A, L, S, H = F.col("_a"), F.col("_L"), F.col("_S"), F.col("_S") * BLOCK_WINDOWS
    first = F.greatest(F.lit(0).cast("long"), F.floor((A - L + S - 1) / H).cast("long"))
    sent = own.withColumn("_b", F.explode(int_range(first, F.floor((A + F.col("_n") - 1) / H).cast("long"))))
    lo = F.greatest(A, F.col("_b") * H)
    hi = F.least(A + F.col("_n"), F.col("_b") * H + H - S + L + 1)
    pieces = sent.select(
        "session_id", "_b", "_L", "_S", "_C", "header", *(["_at"] if arrival else []), F.unix_millis("_at").alias("at"),
        lo.alias("start"), (hi - lo).alias("n"),
        F.slice("samples", ((lo - A) * F.col("_C") + 1).cast("int"), ((hi - lo) * F.col("_C")).cast("int")).alias("samples"),
    ).where("n > 0")
    if arrival:
        pieces = pieces.withWatermark("_at", disorder)
    out = pieces.groupBy("session_id", "_b", "_L", "_S", "_C").transformWithStateInPandas(
        _processor(idle_ms if arrival else None, forget_ms), _OUT, "Append", "EventTime" if arrival else "None"
    )
    h = F.from_json("header", HEADER)
    stamp = window_time_stamp(F.col("samples"), time_channel_idx(h["channel_names"]), F.col("start_idx"), h["sampling_rate"])
    own_fields = {
        "session_id": F.col("session_id"),
        "num_samples": F.col("n").cast("int"),
        "time_stamp": F.when(F.col("k").isNotNull(), stamp).otherwise(h["time_stamp"]),
    }
    return out.select(*[own_fields.get(name, h[name]).alias(name) for name in HEADER_NAMES], "k", "start_idx", "samples")


def split_late_frames(out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(windows, side table of the frames that came for a block let go, one row
    a frame and block) of what ``block_windows`` wrote."""
    late = out.where("k is null").select(*[c for c in out.columns if c not in ("k", "start_idx")], F.col("start_idx").alias("start"))
    return out.where("k is not null"), late
