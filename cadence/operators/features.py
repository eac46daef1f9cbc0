"""Channel catalogue (A4), complex channel correlation (A5) and
correlation-spectrum features (M3).

A5/M3 work per (recording, STFT frame).  A channel's spectrum stays one row of
arrays until the frame's channels meet: C rows of a frame are shuffled, not one
a bin, and a group holds C spectra whatever the recording's length.  Whole
batches of frames are turned into correlation matrices and eigenvalues with
stacked numpy calls."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from cadence.functions.arrays import pad_truncate
from cadence.operators import dsp
from cadence.sources.files import recordings_long

FEATURE_WIDTH = 32


def channel_catalog(rec: DataFrame, key: str = "recording_id", label: str = "channel_label") -> DataFrame:
    """A4: sorted distinct channel labels per recording (the set combines
    map-side, so its size is the channel count, not the row count)."""
    return rec.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("channels"))


def recording_stft(rec: DataFrame, fs: float) -> DataFrame:
    """D5 over channel-major recordings: (recording_id, channel, seg, bin, t,
    freq, re, im)."""
    long = recordings_long(rec).select("recording_id", "channel", "sample_idx", "value")
    return dsp.stft(long, ["recording_id", "channel"], "sample_idx", "value", fs)


CORR = T.StructType(
    [
        T.StructField("channels", T.ArrayType(T.IntegerType())),
        T.StructField("corr", T.ArrayType(T.DoubleType())),
        T.StructField("eig", T.ArrayType(T.DoubleType())),
    ]
)


def _corr_batch(z: pa.Array) -> pa.Array:
    n = len(z)
    first = z.offsets.to_numpy(zero_copy_only=False).astype(np.int64)  # first channel of each frame
    ch = z.values.field("channel").to_numpy(zero_copy_only=False).astype(np.int64)
    re, im = z.values.field("re"), z.values.field("im")
    at = re.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    at_im = im.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    re = re.values.to_numpy(zero_copy_only=False).astype(np.float64)
    im = im.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bins = np.diff(at)
    shapes: dict[tuple[int, int], list[int]] = {}
    for r in range(n):
        own = bins[first[r] : first[r + 1]]
        if len(own) and own[0] > 0 and (own == own[0]).all():
            shapes.setdefault((int(own[0]), len(own)), []).append(r)
    chans: list = [None] * n
    corr: list = [None] * n
    eig: list = [None] * n
    for (B, C), rows in shapes.items():
        of = first[rows][:, None] + np.arange(C)[None, :]
        step = np.arange(B)[None, None, :]
        Z = re[at[of][:, :, None] + step] + 1j * im[at_im[of][:, :, None] + step]
        Zc = Z - Z.mean(axis=2, keepdims=True)
        cov = np.einsum("gib,gjb->gij", Zc, np.conj(Zc))
        var = np.real(np.einsum("gii->gi", cov))
        with np.errstate(divide="ignore", invalid="ignore"):
            R = np.abs(cov) / np.sqrt(var[:, :, None] * var[:, None, :])
        good = np.all(np.isfinite(R.reshape(len(rows), -1)), axis=1)
        E = np.full((len(rows), C), np.nan)
        if good.any():
            E[good] = np.sort(np.abs(np.linalg.eigvalsh(R[good])), axis=1)[:, ::-1]
        for j, r in enumerate(rows):
            chans[r] = ch[first[r] : first[r + 1]].tolist()
            corr[r] = [None if not np.isfinite(x) else float(x) for x in R[j].reshape(-1)]
            eig[r] = E[j].tolist() if good[j] else None
    return pa.StructArray.from_arrays(
        [pa.array(chans, type=pa.list_(pa.int32())), pa.array(corr, type=pa.list_(pa.float64())), pa.array(eig, type=pa.list_(pa.float64()))],
        names=["channels", "corr", "eig"],
    )


@arrow_udf(CORR)
def _corr_udf(z: pa.Array) -> pa.Array:
    return _corr_batch(z)


def recording_spectra(rec: DataFrame, fs: float) -> DataFrame:
    """D5 over channel-major recordings, a row of arrays per segment:
    (recording_id, channel, seg, re, im)."""
    long = recordings_long(rec).select("recording_id", "channel", "sample_idx", "value")
    return dsp.spectra(long, ["recording_id", "channel"], "sample_idx", "value", fs)


def _as_spectra(stft: DataFrame, key: str) -> DataFrame:
    """Spectra as they are; a long STFT (a row a bin) gathered to spectra."""
    if "bin" not in stft.columns:
        return stft.select(key, "seg", "channel", "re", "im")
    one = F.array_sort(F.collect_list(F.struct(F.col("bin").cast("int").alias("bin"), "re", "im")))
    z = stft.groupBy(key, "seg", "channel").agg(one.alias("_z"))
    return z.select(key, "seg", "channel", F.col("_z.re").alias("re"), F.col("_z.im").alias("im"))


def frame_correlations(stft: DataFrame, key: str = "recording_id") -> DataFrame:
    """A5 + eigenvalues over spectra (:func:`recording_spectra`) or a long
    STFT: one row per (recording, seg) with ``channels``, ``corr`` (C×C
    row-major |complex correlation|, NULL entries for constant channels) and
    ``eig`` (|eigenvalues| of that matrix, descending; NULL when the matrix is
    undefined)."""
    g = _as_spectra(stft, key).groupBy(key, "seg").agg(
        F.array_sort(F.collect_list(F.struct(F.col("channel").cast("int").alias("channel"), "re", "im"))).alias("z")
    )
    return g.select(key, "seg", _corr_udf.asNondeterministic()(F.col("z")).alias("c")).select(key, "seg", "c.channels", "c.corr", "c.eig")


def channel_corr(stft: DataFrame, key: str = "recording_id") -> DataFrame:
    """A5 as a long table (recording, seg, ch_a, ch_b, corr)."""
    m = frame_correlations(stft, key)
    C = F.size("channels")
    e = m.select(key, "seg", "channels", F.posexplode("corr").alias("i", "corr"))
    return e.select(
        key,
        "seg",
        F.element_at("channels", (F.floor(F.col("i") / C) + 1).cast("int")).alias("ch_a"),
        F.element_at("channels", (F.pmod(F.col("i"), C) + 1).cast("int")).alias("ch_b"),
        "corr",
    )


def corr_features(stft: DataFrame, key: str = "recording_id", width: int = FEATURE_WIDTH) -> DataFrame:
    """M3: per (recording, seg) the |eigenvalues| of the channel-correlation
    magnitude matrix, descending, zero-padded / cut to ``width`` (P15).
    Frames with an undefined matrix (a constant channel) are dropped."""
    m = frame_correlations(stft, key).where(F.col("eig").isNotNull())
    return m.select(
        key,
        "seg",
        F.size("eig").alias("n_eig"),
        pad_truncate(F.col("eig"), width).alias("features"),
        F.aggregate("eig", F.lit(0.0), lambda a, x: a + x).alias("trace"),
    )
