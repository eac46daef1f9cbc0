"""Rows-only queries against plain numpy re-computations on small data."""

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from cadence.operators import dsp
from tests.test_dsp import _direct

SF = "/root/testdata/sf0.001"


def _stft(x, fs):
    """One-sided STFT: nperseg = fs, hop = fs − int(4fs/5), half-segment zero
    extension at both ends, periodic Hann, scaled by 1/Σw."""
    nperseg = int(fs)
    noverlap = int(fs * 4 / 5)
    hop, pad = nperseg - noverlap, nperseg // 2
    xp = np.concatenate([np.zeros(pad), x, np.zeros(pad)])
    nseg = (len(xp) - noverlap) // hop
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    segs = np.stack([xp[k * hop : k * hop + nperseg] for k in range(nseg)])
    return np.fft.rfft(segs * w, axis=1) / w.sum()  # (seg, bin)


def test_corr_features_bruteforce(spark):
    got = E.queries()["corr_features"](spark, SF).toPandas().set_index(["recording_id", "seg"])
    emb = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id")
    checked = 0
    for rec, g in emb.groupby(emb.vec_id // 4):
        if len(g) != 4 or checked >= 12:
            continue
        Z = np.stack([_stft(np.asarray(e, dtype=float), 16) for e in g.embedding], axis=2)  # (seg, bin, ch)
        for seg in range(Z.shape[0]):
            n = np.corrcoef(Z[seg].T)  # channels × channels over bins
            ev = np.sort(np.abs(np.linalg.eigvals(np.abs(n))))[::-1]
            feat = np.concatenate([ev, np.zeros(32 - len(ev))])
            assert got.loc[(rec, seg), "features"] == pytest.approx(feat, abs=1e-9)
        checked += 1
    assert checked == 12


def test_filter_attenuation_bruteforce(spark):
    got = E.queries()["filter_attenuation"](spark, SF).toPandas()
    ev = pd.read_parquet(f"{SF}/events.parquet").sort_values(["user_id", "ts", "event_id"])
    tones = (0.5, 4.0, 11.0, 19.0, 35.0, 60.0, 120.0)
    sos = dsp.chain_sections(250.0, "filters")
    for uid, g in list(ev.groupby("user_id"))[:5]:
        vals = g["value"].to_numpy()
        n = np.arange(len(vals) * 25)
        x = sum(np.cos(2 * np.pi * f / 250 * n) for f in tones) + np.repeat(vals, 25) / 100.0
        before, after = np.abs(_stft(x, 250)), np.abs(_stft(_direct(sos, x), 250))
        mine = got[got.recording_id == uid].set_index("tone_hz")
        for f in tones:
            b = max(1, int(round(f)))
            assert mine.loc[f, "before"] == pytest.approx(before[:, b].mean(), rel=1e-9)
            assert mine.loc[f, "after"] == pytest.approx(after[:, b].mean(), rel=1e-7, abs=1e-12)


def test_spectrum_parseval(spark):
    """Σ_k |X_k|² = N · Σ_n x_n² for every window (D3 over windows64)."""
    spec = E.queries()["spectrum"](spark, SF).toPandas()
    energy = spec.assign(e=spec["value"] ** 2).groupby("window_id")["e"].sum()
    emb = pd.read_parquet(f"{SF}/embeddings.parquet").set_index("vec_id")
    want = emb["embedding"].apply(lambda v: 64 * float(np.sum(np.asarray(v, dtype=float) ** 2)))
    assert np.allclose(energy.sort_index().to_numpy(), want.loc[energy.sort_index().index].to_numpy(), rtol=1e-4)


def test_constant_channel_gives_null_correlation_and_no_feature_row(spark):
    from cadence.operators.features import channel_corr, corr_features

    rows = []
    for seg in (0, 1):
        for b in range(5):
            rows.append((1, seg, b, 0, float(b + seg), float(b * b)))  # varying channel
            rows.append((1, seg, b, 1, 2.0, 0.0 if seg == 0 else float(b)))  # constant in seg 0 only
    df = spark.createDataFrame(rows, "recording_id long, seg long, bin int, channel int, re double, im double")
    cc = {(r.seg, r.ch_a, r.ch_b): r.corr for r in channel_corr(df).collect()}
    assert cc[(0, 0, 1)] is None and cc[(0, 1, 1)] is None and cc[(0, 0, 0)] == pytest.approx(1.0)
    assert cc[(1, 0, 1)] is not None
    feats = corr_features(df).collect()
    assert [r.seg for r in feats] == [1]
    assert feats[0].n_eig == 2 and feats[0].trace == pytest.approx(2.0)
