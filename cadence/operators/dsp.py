"""Signal transforms over window / sample tables.

Filter design is textbook Butterworth (analogue prototype → frequency
transform → bilinear map → second-order sections), done once per
(sampling rate, chain) with numpy and cached on each executor: the design is
bounded by the filter order, never by the data.

Every transform here is linear and, per window, starts from zero state, so a
chain of filters is one convolution with its impulse response, done by FFT for
any window length.  Windows are processed as stacked Arrow batches: a few FFTs
per batch, no per-row Python.

Whole-recording filtering (D6) composes filter states.  A block of L samples
maps the state s before it to pᴸ·s + g, one complex number per pole p of the
chain (its modes are decoupled).  Every block gives its zero-state response
and its g; the state before block b is Σ pᴸ⁽ʲ⁻¹⁾·g(b − j) over the blocks
within the filter's memory; its free response is added to the block.  A sample
crosses the shuffle once, a state is some tens of numbers, and a recording of
any length spreads over as many tasks as it has blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from cadence.functions.header import time_channel_idx

# Fixed values of the standard chain: mains base frequency and half-width of
# each stop band (Hz), drift cut-off (Hz), Butterworth order.
MAINS_HZ = 60.0
STOP_HALF_WIDTH_HZ = 1.0
HIGHPASS_HZ = 1.0
ORDER = 5


# ---- design -------------------------------------------------------------------
def _prototype(order: int):
    p = -np.exp(1j * np.pi * np.arange(-order + 1, order, 2) / (2 * order))
    return np.zeros(0, complex), p, 1.0


def _to_highpass(z, p, k, wo):
    degree = len(p) - len(z)
    k = k * np.real(np.prod(-z) / np.prod(-p))
    return np.append(wo / z, np.zeros(degree)), wo / p, k


def _to_lowpass(z, p, k, wo):
    degree = len(p) - len(z)
    return wo * z, wo * p, k * wo**degree


def _to_bandstop(z, p, k, wo, bw):
    degree = len(p) - len(z)
    zh, ph = (bw / 2) / z, (bw / 2) / p
    zb = np.concatenate([zh + np.sqrt(zh**2 - wo**2), zh - np.sqrt(zh**2 - wo**2)])
    pb = np.concatenate([ph + np.sqrt(ph**2 - wo**2), ph - np.sqrt(ph**2 - wo**2)])
    zb = np.concatenate([zb, np.full(degree, 1j * wo), np.full(degree, -1j * wo)])
    return zb, pb, k * np.real(np.prod(-z) / np.prod(-p))


def _bilinear(z, p, k, fs2):
    degree = len(p) - len(z)
    zz = np.append((fs2 + z) / (fs2 - z), -np.ones(degree))
    pz = (fs2 + p) / (fs2 - p)
    return zz, pz, k * np.real(np.prod(fs2 - z) / np.prod(fs2 - p))


def butter_zpk(order: int, cutoff, btype: str, fs: float):
    """Digital Butterworth zeros, poles, gain (cut-offs in Hz)."""
    wn = np.atleast_1d(np.asarray(cutoff, dtype=float)) * 2.0 / fs
    if np.any(wn <= 0) or np.any(wn >= 1):
        raise ValueError(f"cut-off {cutoff} Hz outside (0, fs/2) for fs={fs}")
    z, p, k = _prototype(order)
    warped = 4.0 * np.tan(np.pi * wn / 2.0)  # pre-warp with internal fs = 2
    if btype == "lowpass":
        z, p, k = _to_lowpass(z, p, k, warped[0])
    elif btype == "highpass":
        z, p, k = _to_highpass(z, p, k, warped[0])
    elif btype == "bandstop":
        z, p, k = _to_bandstop(z, p, k, np.sqrt(warped[0] * warped[1]), warped[1] - warped[0])
    else:
        raise ValueError(btype)
    return _bilinear(z, p, k, 4.0)


def zpk_to_sections(z, p, k) -> np.ndarray:
    """Second-order sections (b0 b1 b2 1 a1 a2): conjugate pole pairs, each
    with the nearest remaining zero pair; gain on the first section."""
    z, p = list(np.asarray(z)), list(np.asarray(p))
    pairs = []
    cp = sorted([x for x in p if x.imag > 1e-12], key=lambda x: -abs(x))
    rp = sorted([x.real for x in p if abs(x.imag) <= 1e-12], key=lambda x: -abs(x))
    cz = [x for x in z if x.imag > 1e-12]
    rz = [x.real for x in z if abs(x.imag) <= 1e-12]
    for pole in cp:
        if cz:
            zi = int(np.argmin([abs(pole - x) for x in cz]))
            zero = cz.pop(zi)
            b = [1.0, -2 * zero.real, abs(zero) ** 2]
        else:
            zs = [rz.pop(0) if rz else 0.0, rz.pop(0) if rz else 0.0]
            b = [1.0, -(zs[0] + zs[1]), zs[0] * zs[1]]
        pairs.append(b + [1.0, -2 * pole.real, abs(pole) ** 2])
    while rp:
        ps = [rp.pop(0), rp.pop(0) if rp else 0.0]
        zs = [rz.pop(0) if rz else 0.0, rz.pop(0) if rz else 0.0]
        pairs.append([1.0, -(zs[0] + zs[1]), zs[0] * zs[1], 1.0, -(ps[0] + ps[1]), ps[0] * ps[1]])
    sos = np.array(pairs, dtype=float)
    sos[0, :3] *= k
    return sos


def butter_sos(order: int, cutoff, btype: str, fs: float) -> np.ndarray:
    return zpk_to_sections(*butter_zpk(order, cutoff, btype, fs))


def mains_harmonics(fs: float, base: float = MAINS_HZ, half: float = STOP_HALF_WIDTH_HZ) -> list[float]:
    """Harmonics f = base, 2·base, … whose stop band stays below Nyquist."""
    out, f = [], base
    while f < fs / 2 and f + half < fs / 2:
        out.append(f)
        f += base
    return out


@lru_cache(maxsize=64)
def chain_sections(fs: float, kind: str) -> np.ndarray:
    """Sections of a named chain: ``bandstop`` (all mains harmonics),
    ``highpass`` (drift), ``filters`` / ``standard`` (band-stops then high-pass)."""
    secs = []
    if kind in ("bandstop", "filters", "standard"):
        for f in mains_harmonics(fs):
            secs.append(butter_sos(ORDER, [f - STOP_HALF_WIDTH_HZ, f + STOP_HALF_WIDTH_HZ], "bandstop", fs))
    if kind in ("highpass", "filters", "standard"):
        secs.append(butter_sos(ORDER, HIGHPASS_HZ, "highpass", fs))
    if not secs:
        return np.zeros((0, 6))
    return np.vstack(secs)


def state_space(sos: np.ndarray):
    """(A, B, C, D) of a cascade of transposed-direct-form-II sections."""
    n = len(sos)
    d = 2 * n
    A, Bv = np.zeros((d, d)), np.zeros(d)
    # input of the current section as (coeffs over state, coeff of x)
    uc, ud = np.zeros(d), 1.0
    for i, (b0, b1, b2, _a0, a1, a2) in enumerate(sos):
        z1, z2 = 2 * i, 2 * i + 1
        A[z1] += (b1 - a1 * b0) * uc
        A[z1, z1] += -a1
        A[z1, z2] += 1.0
        Bv[z1] += (b1 - a1 * b0) * ud
        A[z2] += (b2 - a2 * b0) * uc
        A[z2, z1] += -a2
        Bv[z2] += (b2 - a2 * b0) * ud
        yc = b0 * uc
        yc[z1] += 1.0
        uc, ud = yc, b0 * ud
    return A, Bv, uc, ud


@lru_cache(maxsize=64)
def impulse_response(fs: float, kind: str, n: int) -> np.ndarray:
    """First ``n`` samples of the chain's impulse response."""
    sos = chain_sections(fs, kind)
    h = np.zeros(n)
    if len(sos) == 0:
        h[0] = 1.0
        return h
    A, Bv, Cv, Dv = state_space(sos)
    h[0] = Dv
    v = Bv.copy()
    block = 64
    # columns A^j B for j in [0, block); then advance a whole block at once
    P = np.empty((len(Bv), block))
    for j in range(block):
        P[:, j] = v
        v = A @ v
    Ab = np.linalg.matrix_power(A, block)
    m = 1
    while m < n:
        take = min(block, n - m)
        h[m : m + take] = Cv @ P[:, :take]
        P = Ab @ P
        m += take
    return h


@lru_cache(maxsize=64)
def modes(fs: float, kind: str):
    """(p, w, c): the chain as h[n] = c·δ[n] + Σ Re(w·pⁿ), one entry for each
    real pole and each conjugate pair."""
    z, p, k = [], [], 1.0
    if kind in ("bandstop", "filters", "standard"):
        for f in mains_harmonics(fs):
            zf, pf, kf = butter_zpk(ORDER, [f - STOP_HALF_WIDTH_HZ, f + STOP_HALF_WIDTH_HZ], "bandstop", fs)
            z, p, k = [*z, *zf], [*p, *pf], k * kf
    if kind in ("highpass", "filters", "standard"):
        zf, pf, kf = butter_zpk(ORDER, HIGHPASS_HZ, "highpass", fs)
        z, p, k = [*z, *zf], [*p, *pf], k * kf
    z, p = np.array(z, complex), np.array(p, complex)
    if not len(p):
        return p, p, 1.0
    ratio = 1.0 - p[None, :] / p[:, None]
    np.fill_diagonal(ratio, 1.0)
    # zeros and poles in pairs, so that no partial product over- or underflows
    r = k * np.prod((1.0 - z[None, :] / p[:, None]) / ratio, axis=1)
    keep = p.imag > -1e-12
    w = np.where(p.imag > 1e-12, 2.0, 1.0) * r
    return p[keep], w[keep], float(np.real(k * np.prod(z / p)))


@lru_cache(maxsize=64)
def memory_length(fs: float, kind: str, tol: float = 1e-16) -> int:
    """Samples after which every mode together stays below ``tol`` of the
    impulse response's first value (the chain's effective memory)."""
    p, w, c = modes(fs, kind)
    if not len(p):
        return 1
    peak = abs(c + np.sum(w.real))
    hi = 1
    while np.sum(np.abs(w) * np.abs(p) ** hi) > tol * peak:
        hi *= 2
    lo = hi // 2
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if np.sum(np.abs(w) * np.abs(p) ** mid) > tol * peak else (lo, mid)
    return hi


CHUNK = 1024  # samples per matrix product of states and free responses


@lru_cache(maxsize=64)
def _mode_powers(fs: float, kind: str):
    """pᵏ for k = 0 … CHUNK, modes × powers."""
    p = modes(fs, kind)[0]
    return p[:, None] ** np.arange(CHUNK + 1)[None, :]


def end_state(x: np.ndarray, fs: float, kind: str) -> np.ndarray:
    """Per mode Σ pⁿ⁻¹⁻ᵐ·x[m]: the state after ``x`` from zero state."""
    p, pw = modes(fs, kind)[0], _mode_powers(fs, kind)
    rows = np.concatenate([np.zeros(-len(x) % CHUNK), x]).reshape(-1, CHUNK)
    s = np.zeros(len(p), complex)
    for part in rows @ pw[:, CHUNK - 1 :: -1].T:
        s = s * pw[:, CHUNK] + part
    return s


def free_response(state: np.ndarray, n: int, fs: float, kind: str) -> np.ndarray:
    """Output over the next ``n`` samples of a chain in ``state`` without input."""
    w, pw = modes(fs, kind)[1], _mode_powers(fs, kind)
    out = np.empty((-(-n // CHUNK), CHUNK))
    s = w * state
    for row in out:
        row[:] = np.real(s @ pw[:, 1:])
        s = s * pw[:, CHUNK]
    return out.reshape(-1)[:n]


@lru_cache(maxsize=64)
def _mode_response_pow2(fs: float, kind: str, n: int) -> np.ndarray:
    p, _w, c = modes(fs, kind)
    h = np.zeros(n)
    h[0] = c
    if len(p):
        # an impulse one sample ago, read one power back
        h += free_response(1.0 / p, n, fs, kind)
    return h


def mode_response(fs: float, kind: str, n: int) -> np.ndarray:
    """First ``n`` samples of the impulse response from the modes."""
    return _mode_response_pow2(fs, kind, 1 << max(10, (n - 1).bit_length()))[:n]


# ---- window transforms (Arrow, stacked per batch) -----------------------------
# FFT convolution with the chain's impulse response for every window length:
# O(W log W) time and O(W) memory.


def _zero_state_filter(kind: str, X: np.ndarray, fs: float) -> np.ndarray:
    w = X.shape[1]
    nfft = 1 << int(np.ceil(np.log2(2 * w)))
    Hf = np.fft.rfft(impulse_response(float(fs), kind, w), nfft)[None, :, None]
    return np.fft.irfft(np.fft.rfft(X, nfft, axis=1) * Hf, nfft, axis=1)[:, :w, :]


def _apply(kind: str, X: np.ndarray, fs: float) -> np.ndarray:
    """X: (rows, W, channels) float64 → transformed, same shape."""
    if kind in ("bandstop", "highpass", "filters"):
        return _zero_state_filter(kind, X, fs)
    if kind == "spectrum":
        return np.abs(np.fft.fft(X, axis=1))
    if kind == "standard":
        return np.abs(np.fft.fft(_zero_state_filter("standard", X, fs), axis=1))
    raise ValueError(kind)


def _transform_batch(kind: str, samples: pa.Array, fs: pa.Array, nch: pa.Array, tidx: pa.Array) -> pa.Array:
    n = len(samples)
    lens = np.asarray(samples.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = np.asarray(samples.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lens)])
    fs_np = np.asarray(fs.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.float64)
    c_np = np.asarray(nch.fill_null(1).to_numpy(zero_copy_only=False), dtype=np.int64)
    t_np = np.asarray(tidx.fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    ok = (lens > 0) & (fs_np > 0) & (c_np > 0) & (lens % np.maximum(c_np, 1) == 0)
    if samples.null_count:
        ok &= np.asarray(samples.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    out_vals: list[np.ndarray] = [np.zeros(0)] * n
    keys = np.stack([lens, fs_np.astype(np.int64), c_np, t_np], axis=1)
    for key in np.unique(keys[ok], axis=0):
        L, fsk, C, t = (int(x) for x in key)
        rows = np.nonzero(ok & (lens == L) & (fs_np.astype(np.int64) == fsk) & (c_np == C) & (t_np == t))[0]
        W = L // C
        X = np.stack([flat[starts[r] : starts[r] + L] for r in rows]).reshape(len(rows), W, C)
        sig = [c for c in range(C) if c != t]
        Y = _apply(kind, X[:, :, sig], fsk) if sig else X[:, :, :0]
        if kind in ("spectrum", "standard"):
            # time column first, then the signal channels (sample-major)
            parts = ([X[:, :, [t]]] if t >= 0 else []) + [Y]
            Z = np.concatenate(parts, axis=2)
        else:
            Z = X.astype(np.float64).copy()
            Z[:, :, sig] = Y
        for j, r in enumerate(rows):
            out_vals[r] = Z[j].reshape(-1)
    counts = np.array([len(v) for v in out_vals], dtype=np.int64)
    offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    values = np.concatenate(out_vals) if n else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, type=pa.float64()), mask=pa.array(~ok))


def _make_udf(kind: str):
    @arrow_udf(T.ArrayType(T.DoubleType()))
    def transform(samples: pa.Array, fs: pa.Array, nch: pa.Array, tidx: pa.Array) -> pa.Array:
        return _transform_batch(kind, samples, fs, nch, tidx)

    # keeps an explode of the result from evaluating the function a second
    # time in a pushed-down size(...) > 0 filter
    return transform.asNondeterministic()


_UDFS = {k: _make_udf(k) for k in ("bandstop", "highpass", "filters", "spectrum", "standard")}


def transform_windows(
    df: DataFrame,
    kind: str,
    samples: str = "samples",
    sampling_rate: str = "sampling_rate",
    num_channels: str = "num_channels",
    time_idx: Column | None = None,
    out: str = "processed",
) -> DataFrame:
    """Apply a window transform to sample-major window arrays.

    kind: ``bandstop`` (D1), ``highpass`` (D2), ``filters`` (D1+D2),
    ``spectrum`` (D3, |FFT|, all bins), ``standard`` (D4 = D1 → D2 → D3).
    The time channel (``time_idx``, −1 for none; by default found in
    ``channel_names``) is never filtered; spectra put it first.  Zero initial state per window."""
    if time_idx is None:
        time_idx = time_channel_idx(F.col("channel_names")) if "channel_names" in df.columns else F.lit(-1)
    t = F.coalesce(time_idx, F.lit(-1)).cast("int")
    return df.withColumn(out, _UDFS[kind](F.col(samples), F.col(sampling_rate), F.col(num_channels), t))


# ---- whole-recording filtering (D6) ---------------------------------------------
BLOCK_OUT = T.ArrayType(T.StructType([T.StructField("i", T.LongType()), T.StructField("y", T.DoubleType())]))
STATES_OUT = T.ArrayType(T.StructType([T.StructField("blk", T.LongType()), T.StructField("s", T.ArrayType(T.DoubleType()))]))


def _list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _dense_blocks(xs: pa.Array, blk: pa.Array, block: int):
    """Per row (block): positions that hold a sample, the samples from the
    first to the last of them (NULL, NaN and absent ones 0) and the offset of
    the first from the block's begin."""
    offs = np.asarray(xs.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
    ii = np.asarray(xs.values.field("i").to_numpy(zero_copy_only=False), dtype=np.int64)
    vv = np.asarray(xs.values.field("v").to_numpy(zero_copy_only=False), dtype=np.float64)
    bb = np.asarray(blk.to_numpy(zero_copy_only=False), dtype=np.int64)
    for r in range(len(xs)):
        i, v = ii[offs[r] : offs[r + 1]], vv[offs[r] : offs[r + 1]]
        dense = np.zeros(int(i[-1] - i[0]) + 1)
        dense[i - i[0]] = np.where(np.isnan(v), 0.0, v)
        yield i, dense, int(i[0] - bb[r] * block)


def _block_states(kind: str, fs: float, block: int, reach: int, xs: pa.Array, blk: pa.Array) -> pa.Array:
    """What every block adds to the states before the next ``reach`` blocks."""
    p = modes(fs, kind)[0]
    steps = p[None, :] ** (block * np.arange(reach))[:, None]
    out = [np.zeros((0, len(p)), complex)]
    for _i, dense, off in _dense_blocks(xs, blk, block):
        out.append(steps * (end_state(dense, fs, kind) * p ** (block - off - len(dense)))[None, :])
    flat = np.concatenate(out).view(np.float64).reshape(-1)
    rows = len(xs) * reach
    to = np.asarray(blk.to_numpy(zero_copy_only=False), dtype=np.int64)[:, None] + 1 + np.arange(reach)[None, :]
    states = pa.StructArray.from_arrays([pa.array(to.reshape(-1)), _list_array(pa.array(flat), np.full(rows, 2 * len(p)))], names=["blk", "s"])
    return _list_array(states, np.full(len(xs), reach))


def _filter_blocks(kind: str, fs: float, block: int, xs: pa.Array, blk: pa.Array, states: pa.Array) -> pa.Array:
    """Zero-state response of every block plus the free response of the sum of
    its ``states``."""
    modes_n = len(modes(fs, kind)[0])
    out_i, out_y = [np.zeros(0, np.int64)], [np.zeros(0)]
    for r, (i, dense, off) in enumerate(_dense_blocks(xs, blk, block)):
        n = len(dense)
        nfft = 1 << (2 * n - 1).bit_length()
        y = np.fft.irfft(np.fft.rfft(dense, nfft) * np.fft.rfft(mode_response(fs, kind, n), nfft), nfft)[:n]
        carried = states[r].values
        if carried is not None and len(carried):
            s = carried.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * modes_n).sum(axis=0).view(np.complex128)
            y = y + free_response(s * modes(fs, kind)[0] ** off, n, fs, kind)
        out_i.append(i)
        out_y.append(y[i - i[0]])
    values = pa.StructArray.from_arrays([pa.array(np.concatenate(out_i)), pa.array(np.concatenate(out_y))], names=["i", "y"])
    return _list_array(values, np.array([len(a) for a in out_i[1:]], dtype=np.int64))


def filter_signals(
    samples: DataFrame,
    keys: list[str],
    idx: str = "sample_idx",
    value: str = "value",
    fs: float = 250.0,
    kind: str = "filters",
    block: int = 1 << 16,
) -> DataFrame:
    """Continuous-state filtering of long signals (keys…, idx, value) →
    (keys…, idx, filtered).

    Samples are gathered into blocks of ``block`` positions (one shuffle, each
    sample once, a sorted array of at most ``block`` a group).  Every block
    hands its end state, damped by the blocks between, to the blocks within
    the chain's memory (⌈memory / block⌉ of them, 1 at 250 Hz); the states meet
    the blocks on the blocks' own partitioning.  The result equals one pass
    over the whole signal to double precision.  NULL and NaN samples count as
    0, like absent ones, whatever the block size; their positions get an
    output.  NULL keys are a signal like any other."""
    fs, blk = float(fs), max(int(block), 1)
    i = F.col(idx).cast("long")
    # the keys as one struct, never NULL itself, compare null-safe in a plain equi-join
    rows = samples.select(
        F.struct(*keys).alias("_k"),
        F.floor(i / blk).cast("long").alias("_blk"),
        F.struct(i.alias("i"), F.col(value).cast("double").alias("v")).alias("_x"),
    ).where(F.col("_blk").isNotNull())
    blocks = rows.groupBy("_k", "_blk").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    reach = -(-memory_length(fs, kind) // blk) if len(modes(fs, kind)[0]) else 0

    @arrow_udf(STATES_OUT)
    def hand_over(xs: pa.Array, b: pa.Array) -> pa.Array:
        return _block_states(kind, fs, blk, reach, xs, b)

    @arrow_udf(BLOCK_OUT)
    def run(xs: pa.Array, b: pa.Array, states: pa.Array) -> pa.Array:
        return _filter_blocks(kind, fs, blk, xs, b, states)

    if reach:
        to = blocks.select("_k", F.explode(hand_over.asNondeterministic()("_xs", "_blk")).alias("_t")).select("_k", F.col("_t.blk").alias("_blk"), F.col("_t.s").alias("_s"))
        blocks = blocks.join(to.groupBy("_k", "_blk").agg(F.collect_list("_s").alias("_states")), ["_k", "_blk"], "left")
    else:
        blocks = blocks.withColumn("_states", F.lit(None).cast("array<array<double>>"))
    out = blocks.select("_k", F.explode(run.asNondeterministic()("_xs", "_blk", "_states")).alias("_o"))
    return out.select(*[F.col("_k")[k].alias(k) for k in keys], F.col("_o.i").alias(idx), F.col("_o.y").alias("filtered"))


# ---- short-time Fourier transform (D5) ------------------------------------------
def hann_periodic(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(n) / n)


def _rfft_batch(segments: pa.Array) -> pa.Array:
    n = len(segments)
    lens = np.asarray(segments.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = np.asarray(segments.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lens)])
    re_out: list[np.ndarray] = [np.zeros(0)] * n
    im_out: list[np.ndarray] = [np.zeros(0)] * n
    for L in np.unique(lens[lens > 0]):
        rows = np.nonzero(lens == L)[0]
        X = np.stack([flat[starts[r] : starts[r] + L] for r in rows])
        w = hann_periodic(int(L))
        Z = np.fft.rfft(X * w, axis=1) / w.sum()
        for j, r in enumerate(rows):
            re_out[r], im_out[r] = Z[j].real, Z[j].imag
    def lst(vals):
        offs = np.concatenate([[0], np.cumsum([len(v) for v in vals])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(vals) if n else np.zeros(0), type=pa.float64()))
    return pa.StructArray.from_arrays([lst(re_out), lst(im_out)], names=["re", "im"])


@arrow_udf(T.StructType([T.StructField("re", T.ArrayType(T.DoubleType())), T.StructField("im", T.ArrayType(T.DoubleType()))]))
def hann_rfft(segments: pa.Array) -> pa.Array:
    """Periodic-Hann-weighted one-sided FFT of each segment, divided by the
    window sum (spectrum scaling)."""
    return _rfft_batch(segments)


def spectra(
    samples: DataFrame,
    keys: list[str],
    idx: str,
    value: str,
    fs: float,
    nperseg: int | None = None,
    noverlap: int | None = None,
) -> DataFrame:
    """D5 as a row of arrays per segment: (keys…, seg, re, im), bins in order.
    Segments as in :func:`stft`."""
    from cadence.operators.windows import stft_segments

    nperseg = int(nperseg or fs)
    noverlap = int(noverlap if noverlap is not None else int(fs * 4 / 5))
    segs = stft_segments(samples, keys, idx, value, nperseg, noverlap)
    spec = segs.select(*keys, "seg", hann_rfft(F.col("segment")).alias("z"))
    return spec.select(*keys, "seg", F.col("z.re").alias("re"), F.col("z.im").alias("im"))


def stft(
    samples: DataFrame,
    keys: list[str],
    idx: str,
    value: str,
    fs: float,
    nperseg: int | None = None,
    noverlap: int | None = None,
    bins: list[int] | None = None,
) -> DataFrame:
    """STFT of long signals (keys…, idx, value) → (keys…, seg, bin, t,
    freq, re, im).  Segments of ``nperseg`` (default fs samples) every
    ``nperseg − noverlap`` (default noverlap = int(4·fs/5)), zero-extended by
    half a segment at both ends; t = seg·hop/fs, freq = bin·fs/nperseg.  With
    ``bins`` only the rows of those bins."""
    return explode_bins(spectra(samples, keys, idx, value, fs, nperseg, noverlap), keys, fs, nperseg, noverlap, bins=bins)


def explode_bins(
    spec: DataFrame,
    keys: list[str],
    fs: float,
    nperseg: int | None = None,
    noverlap: int | None = None,
    extra: tuple[str, ...] = (),
    bins: list[int] | None = None,
) -> DataFrame:
    """Spectra → a row a bin with its time and frequency; ``extra`` columns of
    the segment are repeated.  ``bins``: only these, the others make no row."""
    nperseg = int(nperseg or fs)
    hop = nperseg - int(noverlap if noverlap is not None else int(fs * 4 / 5))
    if bins is None:
        z = spec.select(*keys, "seg", *extra, F.posexplode(F.arrays_zip("re", "im")).alias("bin", "c"))
    else:
        cell = lambda b: F.struct(F.lit(b).alias("bin"), F.struct(F.get("re", F.lit(b)).alias("re"), F.get("im", F.lit(b)).alias("im")).alias("c"))
        own = F.array(*[cell(b) for b in sorted(set(bins)) if 0 <= b <= nperseg // 2])
        z = spec.select(*keys, "seg", *extra, F.inline(own))
    return z.select(
        *keys,
        "seg",
        F.col("bin").cast("int").alias("bin"),
        (F.col("seg") * F.lit(hop / fs)).alias("t"),
        (F.col("bin") * F.lit(fs / nperseg)).alias("freq"),
        F.col("c.re").alias("re"),
        F.col("c.im").alias("im"),
        *extra,
    )


def freq_axis(bin_: Column, n: Column, fs: Column) -> Column:
    """Frequency of FFT bin ``bin`` of an ``n``-point transform at rate
    ``fs`` — non-negative bins first, then the negative ones."""
    half = ((n + 1) / 2).cast("long")
    signed = F.when(bin_ < half, bin_).otherwise(bin_ - n)
    return signed.cast("double") * fs.cast("double") / n.cast("double")


def magnitude(re: Column, im: Column) -> Column:
    """|re + i·im|."""
    return F.sqrt(re * re + im * im)
