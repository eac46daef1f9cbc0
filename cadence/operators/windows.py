"""Windowing: ordered block concat (A1), keyed / global sliding time windows
(W1, W4), overlapping sample windows (W2/W3, flagship), STFT segments (W5),
window time stamps (P14) and the fan-out metric (T7).

Sample windows use an *absolute* window index ``k``: window k covers samples
[k·S, k·S + L) of its session, so no cursor has to be carried between
firings and arrival order does not matter.  Windows are hosted by fixed
blocks of samples: each frame goes to the (≤ 3) blocks whose range it
overlaps, and each (session, block) group — bounded by the block size, never
by the session — cuts its windows locally, so a hot session spreads over as
many tasks as it has blocks.  A window is emitted only when all its samples
and sample k·S + L (one past its end) exist — the strict "start + length <
available" rule — so batch and stream agree.  STFT segments (W5) use the same
block scheme on long sample tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.dense import scatter_dense
from cadence.functions.header import session_start, time_channel_idx, window_time_stamp
from cadence.schemas import HEADER_NAMES


def int_range(lo: Column, hi: Column) -> Column:
    """[lo, hi] as an array of BIGINT; empty when hi < lo."""
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def window_length(length_s: float, sampling_rate: Column) -> Column:
    """L = int(length·fs) in float32 arithmetic, as the windower computes it."""
    return (F.lit(length_s).cast("float") * sampling_rate.cast("float")).cast("int")


def window_stride(length_s: float, overlap: float, sampling_rate: Column) -> Column:
    """S = int((1 − overlap)·length·fs + 0.5), (1 − overlap)·length·fs in float32."""
    step = (F.lit(1.0).cast("float") - F.lit(overlap).cast("float")) * F.lit(length_s).cast("float") * sampling_rate.cast("float")
    return (step.cast("double") + F.lit(0.5)).cast("int")


def concat_blocks(df: DataFrame, keys: Sequence[str | Column], order: str | Column, block: str | Column, name: str = "samples") -> DataFrame:
    """A1 (+A3): per group, the blocks appended in ``order`` and the number of
    blocks.  ``collect_list`` is unordered, hence the explicit sort."""
    o = F.col(order) if isinstance(order, str) else order
    b = F.col(block) if isinstance(block, str) else block
    return df.groupBy(*keys).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), b.alias("b")))), lambda z: z["b"])).alias(name),
        F.count(F.lit(1)).alias("n_blocks"),
    )


def time_windows(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    aggs: Sequence[Column] = (),
) -> DataFrame:
    """W1 (keyed) / W4 (``keys=()``): sliding event-time windows.

    ``aggs`` should be partial-aggregatable (count/sum/min_by/max_by …) so the
    map side combines before the shuffle; an unkeyed window is then one small
    row per window and task, never one task holding the window's rows.
    """
    # keep the bare column when it is already TIMESTAMP so a stream's
    # watermark (defined on that column) applies to the window
    t = F.col(ts) if dict(df.dtypes).get(ts) == "timestamp" else F.col(ts).cast("timestamp")
    grouped = df.groupBy(*keys, F.window(t, size, slide).alias("w"))
    out = grouped.agg(*aggs)
    return out.select(
        *keys,
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in out.columns if c not in (*keys, "w")],
    )


def sample_windows(
    frames: DataFrame,
    length_s: float = 1.0,
    overlap: float = 0.8,
    session: str = "session_id",
    start_col: str | None = None,
    block_windows: int | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Overlapping windows of ``int(length·fs)`` samples every
    ``int((1-overlap)·length·fs + .5)`` samples, cut across frame edges.

    ``frames`` has the flattened header fields and ``samples`` (sample-major).
    A frame's first absolute sample index is ``start_col`` when given (use it
    for sessions whose frames vary in length; :func:`prefix_sum_within` builds
    it), else ``frame_number · num_samples``.

    Plan: windows are hosted by fixed blocks of H = ``block_windows``·L
    samples (a window belongs to the block holding its first sample).  Each
    frame is sent to the blocks whose range [b·H, b·H + H + L) it overlaps —
    about (H + L)/H copies of the data cross the shuffle instead of one per
    window — and each (session, block) group, at most H + L + 2F samples,
    cuts all its windows locally.  A window is emitted only when all its
    samples and the one past its end are present (the strict rule), so an
    open window is never cut, and a missing frame suppresses exactly the
    windows that would need it.

    Output: one row per window with the header of the frame holding its first
    sample, ``k``, ``start_idx``, ``num_samples`` = L, ``time_stamp`` (P14),
    ``samples`` (L·C floats) and ``n_frames`` (frames the window touches).

    On a streaming DataFrame each block is keyed by its event-time end
    (session start + end of the block's needed range / fs) with a watermark
    ``delay`` behind the largest seen; in append mode a block's windows are
    emitted once, when the watermark passes its end.  ``block_windows``
    defaults to 4 in batch (≈1.25× shuffle) and 1 on streams (a window waits
    only for its own end, ≈2× shuffle).
    """
    if block_windows is None:
        block_windows = 1 if frames.isStreaming else 4
    fs = F.col("sampling_rate")
    C = F.col("num_channels").cast("long")
    Fn = F.col("num_samples").cast("long")
    a = F.col(start_col).cast("long") if start_col else F.col("frame_number").cast("long") * Fn
    hdr_names = [n for n in HEADER_NAMES if n != session]
    staged = frames.select(
        F.col(session),
        F.struct(*[F.col(n) for n in hdr_names]).alias("_h"),
        F.col("samples"),
        a.alias("_a"),
        Fn.alias("_F"),
        C.alias("_C"),
        window_length(length_s, fs).cast("long").alias("_L"),
        window_stride(length_s, overlap, fs).cast("long").alias("_S"),
    ).where((F.col("_L") > 0) & (F.col("_S") > 0))
    L, S, A, Fc = F.col("_L"), F.col("_S"), F.col("_a"), F.col("_F")
    H = L * block_windows
    b_lo = F.greatest(F.lit(0).cast("long"), F.floor((A - L - H + 1) / H).cast("long"))
    b_hi = F.floor((A + Fc - 1) / H).cast("long")
    span_hi = lambda b: b * H + H + L  # noqa: E731  (exclusive end of a block's needed range)
    streaming = frames.isStreaming
    if streaming and not delay:
        raise ValueError("a streaming sample_windows needs a watermark delay")
    pieces = (
        staged.withColumn("_b", F.explode(int_range(b_lo, b_hi)))
        .withColumn("_lo", F.greatest(A, F.col("_b") * H))
        .withColumn("_hi", F.least(A + Fc, span_hi(F.col("_b"))))
        .where(F.col("_hi") > F.col("_lo"))
        .select(
            session,
            "_b",
            "_L",
            "_S",
            "_C",
            F.col("_h.sampling_rate").alias("_fs"),
            session_start("_h.year", "_h.month", "_h.day", "_h.hour", "_h.minute", "_h.second", "_h.microsecond").alias("_t0"),
            F.struct(
                F.col("_lo").alias("lo"),
                (-F.col("_hi")).alias("to"),  # of pieces with one begin the longest comes first
                F.col("_hi").alias("hi"),
                F.col("_a").alias("a"),
                F.col("_h").alias("h"),
                F.slice("samples", ((F.col("_lo") - A) * F.col("_C") + 1).cast("int"), ((F.col("_hi") - F.col("_lo")) * F.col("_C")).cast("int")).alias("v"),
            ).alias("_p"),
        )
    )
    keys = [session, "_b"]
    if streaming:
        # event time of a block's end: session start + (b·H + H + L) / fs seconds
        secs = ((F.col("_b") * F.col("_L") * block_windows + F.col("_L") * block_windows + F.col("_L")) * 1_000_000 / F.col("_fs")).cast("long")
        pieces = pieces.withColumn(
            "_blk_end", (F.unix_micros(F.col("_t0").cast("timestamp")) + secs).cast("long")
        ).withColumn("_blk_end", F.timestamp_micros("_blk_end")).withWatermark("_blk_end", delay)
        keys.append("_blk_end")
    grouped = pieces.groupBy(*keys).agg(
        F.array_sort(F.collect_list("_p")).alias("_ps"),
        F.first("_L").alias("_L"),
        F.first("_S").alias("_S"),
        F.first("_C").alias("_C"),
    )
    Lg, Sg, Cg = F.col("_L"), F.col("_S"), F.col("_C")
    base = F.col("_b") * Lg * block_windows
    # pieces in order and disjoint: a piece gives the samples behind those of
    # the pieces before it, so a frame delivered twice gives none
    reached = F.aggregate(
        "_ps",
        F.array().cast("array<bigint>"),
        lambda acc, p: F.concat(acc, F.array(F.greatest(F.try_element_at(acc, F.lit(-1)), p["hi"]))),
    )

    def behind(p, i):
        lo = F.when(i > 0, F.greatest(p["lo"], F.get("_ends", i - 1))).otherwise(p["lo"])
        rest = F.slice(p["v"], ((lo - p["lo"]) * Cg + 1).cast("int"), (F.greatest(p["hi"] - lo, F.lit(0)) * Cg).cast("int"))
        return F.struct(lo.alias("lo"), p["hi"].alias("hi"), p["h"].alias("h"), F.when(lo == p["lo"], p["v"]).otherwise(rest).alias("v"))

    grouped = grouped.withColumn("_ends", reached)
    grouped = grouped.withColumn("_ps", F.filter(F.transform("_ps", behind), lambda p: p["lo"] < p["hi"])).drop("_ends")
    blocks = grouped.withColumn("_run", F.flatten(F.transform("_ps", lambda p: p["v"])))
    k_first = F.ceil(base / Sg).cast("long")
    k_last = F.ceil((base + Lg * block_windows) / Sg).cast("long") - 1  # starts inside this block
    wins = blocks.withColumn("k", F.explode(int_range(k_first, k_last)))
    s0 = F.col("k") * Sg
    # samples of [s0, s0 + L] present (the window plus its sentinel), and the
    # window's offset in the concatenated pieces (pieces never overlap)
    covered = F.aggregate("_ps", F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(F.lit(0).cast("long"), F.least(p["hi"], s0 + Lg + 1) - F.greatest(p["lo"], s0)))
    before = F.aggregate("_ps", F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(F.lit(0).cast("long"), F.least(p["hi"], s0) - p["lo"]))
    wins = wins.where(covered == Lg + 1)
    first_piece = F.try_element_at(F.filter("_ps", lambda p: (p["lo"] <= s0) & (s0 < p["hi"])), F.lit(1))
    touched = F.size(F.filter("_ps", lambda p: (p["lo"] <= s0 + Lg) & (s0 < p["hi"])))
    win = F.slice("_run", (before * Cg + 1).cast("int"), (Lg * Cg).cast("int"))
    out = wins.select(
        F.col(session), "k", s0.alias("start_idx"), first_piece["h"].alias("_h"), win.alias("samples"), touched.alias("n_frames"), Lg.alias("_L")
    )
    tidx = time_channel_idx(F.col("_h.channel_names"))
    cols = []
    for n in HEADER_NAMES:
        if n == session:
            cols.append(F.col(session))
        elif n == "num_samples":
            cols.append(F.col("_L").cast("int").alias("num_samples"))
        elif n == "time_stamp":
            cols.append(window_time_stamp(F.col("samples"), tidx, F.col("start_idx"), F.col("_h.sampling_rate")).alias("time_stamp"))
        else:
            cols.append(F.col(f"_h.{n}").alias(n))
    return out.select(*cols, "k", "start_idx", "samples", "n_frames")


def samples_as_frames(df: DataFrame, session: str, idx: str, value: str, sampling_rate: int, channel_name: str = "value") -> DataFrame:
    """View a long (session, sample_idx, value) table as one-sample frames so
    the frame operators (W2, P14, …) apply to it directly; ``start`` (BIGINT)
    is each frame's absolute sample index — pass ``start_col="start"``."""
    return df.select(
        F.col(session).cast("string").alias("session_id"),
        F.col(session).cast("string").alias("user_name"),
        F.col(idx).try_cast("int").alias("frame_number"),
        F.col(idx).cast("long").alias("start"),
        F.lit(0).alias("time_stamp"),
        *[F.lit(0).alias(n) for n in ("year", "month", "day", "hour", "minute", "second", "microsecond")],
        F.lit("default").alias("ML_model"),
        F.lit("standard").alias("preprocessing"),
        F.lit(sampling_rate).alias("sampling_rate"),
        F.lit(1).alias("num_samples"),
        F.lit(1).alias("num_channels"),
        F.array(F.lit(channel_name)).alias("channel_names"),
        F.array(F.col(value).cast("float")).alias("samples"),
    )


def fanout(frames: DataFrame, windows: DataFrame, session: str = "session_id") -> DataFrame:
    """Windows emitted per input frame, per session."""
    nf = frames.groupBy(session).agg(F.count(F.lit(1)).alias("n_frames"))
    nw = windows.groupBy(session).agg(F.count(F.lit(1)).alias("n_windows"))
    return nf.join(nw, session, "left").select(
        session,
        "n_frames",
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"),
        F.round(F.coalesce("n_windows", F.lit(0)) / F.col("n_frames"), 6).alias("windows_per_frame"),
    )


def stft_segments(
    samples: DataFrame,
    keys: Sequence[str],
    idx: str,
    value: str,
    nperseg: int,
    noverlap: int,
    block_hops: int = 64,
) -> DataFrame:
    """Segments of ``nperseg`` samples every hop = ``nperseg − noverlap``,
    the signal extended by ``nperseg // 2`` zeros at both ends, no end
    padding (segment count ⌊(N + 2·pad − noverlap)/hop⌋).

    ``samples``: long table (keys…, idx, value), idx = 0 … N−1.  Segments
    are hosted by blocks of ``block_hops`` hops; a sample is sent to the (≤ 2)
    blocks whose range — the block plus one segment of look-ahead — holds it;
    each block rebuilds its dense stretch with one Arrow scatter per batch
    (absent positions are 0) and slices its segments out in Catalyst.
    Blocks are laid out from each signal's last index (one grouped maximum),
    so a gap of any length changes no segment count: its samples are zeros.
    Output: keys…, ``seg``, ``segment`` ARRAY<DOUBLE>."""
    hop = nperseg - noverlap
    pad = nperseg // 2
    H = hop * block_hops
    reach = H - hop + nperseg  # extended positions a block needs: [bH, bH + reach)
    n_ext = F.col(idx).cast("long") + pad
    b_lo = F.greatest(F.lit(0).cast("long"), F.ceil((n_ext - reach + 1) / H).cast("long"))
    b_hi = F.floor(n_ext / H).cast("long")
    fan = samples.select(
        *keys,
        F.struct(n_ext.alias("p"), F.col(value).cast("double").alias("v")).alias("_x"),
        F.explode(int_range(b_lo, b_hi)).alias("_b"),
        F.lit(None).cast("long").alias("_k"),
    )
    # segment k fits when k·hop + nperseg ≤ N + 2·pad = last extended index + 1 + pad
    k_end = F.floor((F.max(n_ext) + 1 + pad - nperseg) / hop).cast("long")
    ends = samples.where(F.col(idx).isNotNull()).groupBy(*keys).agg(k_end.alias("_k")).where("_k >= 0")
    laid_out = ends.select(
        *keys,
        F.lit(None).cast("struct<p:bigint,v:double>").alias("_x"),
        F.explode(int_range(F.lit(0).cast("long"), F.floor(F.col("_k") / block_hops).cast("long"))).alias("_b"),
        "_k",
    )
    # a block's row in the layout meets its samples in one grouping: a join
    # could send the gathered samples to every task, their size being unknown
    g = fan.unionByName(laid_out).groupBy(*keys, "_b").agg(F.collect_list("_x").alias("_xs"), F.max("_k").alias("_k")).where("_k IS NOT NULL")
    base = F.col("_b") * H
    dense = scatter_dense(F.col("_xs"), base, F.lit(reach))
    k_first = F.col("_b") * block_hops
    k_last = F.least(k_first + block_hops - 1, F.col("_k"))
    # cut inside the block: a row a segment would carry a copy of the stretch each
    cut = lambda k: F.struct(k.alias("seg"), F.slice("_d", (k * hop - base + 1).cast("int"), nperseg).alias("segment"))
    segs = g.select(*keys, "_b", "_k", dense.alias("_d"))
    return segs.select(*keys, F.inline(F.transform(int_range(k_first, k_last), cut)))


def apply_per_window(
    frames: DataFrame,
    fn,
    schema,
    length_s: float = 1.0,
    overlap: float = 0.8,
    session: str = "session_id",
    start_col: str | None = None,
) -> DataFrame:
    """Call ``fn(session, k, samples)`` on every complete window, where
    ``samples`` is the window as an (L, C) numpy array in sample order; ``fn``
    returns a list of row tuples in the order of ``schema``, or a pandas
    DataFrame matching it (some 0.2 ms a frame, more than most functions take),
    or None.  Runs over the rows of :func:`sample_windows` in Arrow batches —
    no extra shuffle."""
    import numpy as np
    import pandas as pd

    wins = sample_windows(frames, length_s, overlap, session, start_col).select(session, "k", "num_samples", "num_channels", "samples")

    def run(batches):
        for pdf in batches:
            rows, tables = [], []
            for r in pdf.itertuples(index=False, name=None):
                out = fn(r[0], int(r[1]), np.asarray(r[4], dtype=np.float64).reshape(int(r[2]), int(r[3])))
                if isinstance(out, list):
                    rows += out
                elif out is not None and len(out):
                    tables.append(out)
            if rows:
                yield pd.DataFrame(rows)  # by position
            if tables:
                yield pd.concat(tables, ignore_index=True)

    return wins.mapInPandas(run, schema)
