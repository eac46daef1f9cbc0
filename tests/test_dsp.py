"""Filter design targets, operator identities, block-parallel whole-signal
filtering against a direct recursion (brute force)."""

import numpy as np
import pandas as pd
import pytest

from cadence.operators import dsp


def _response(sos, f, fs):
    z = np.exp(2j * np.pi * f / fs)
    r = 1.0
    for b0, b1, b2, _a0, a1, a2 in sos:
        r *= (b0 + b1 / z + b2 / z**2) / (1 + a1 / z + a2 / z**2)
    return abs(r)


def _direct(sos, x):
    y = np.asarray(x, float).copy()
    for b0, b1, b2, _a0, a1, a2 in sos:
        z1 = z2 = 0.0
        out = np.empty_like(y)
        for n, u in enumerate(y):
            o = b0 * u + z1
            z1 = b1 * u - a1 * o + z2
            z2 = b2 * u - a2 * o
            out[n] = o
        y = out
    return y


def test_bandstop_targets():
    sos = dsp.butter_sos(5, [59, 61], "bandstop", 250)
    assert sos[0, 0] == pytest.approx(0.9218784982, abs=1e-10)
    got = [_response(sos, f, 250) for f in (10, 59, 60, 61, 100)]
    assert got == pytest.approx([1, 0.707107, 0, 0.707107, 1], abs=1e-6)
    A = dsp.state_space(sos)[0]
    assert max(abs(np.linalg.eigvals(A))) == pytest.approx(0.992278, abs=1e-6)


def test_highpass_targets():
    sos = dsp.butter_sos(5, 1, "highpass", 250)
    assert sos[0, 0] == pytest.approx(0.9601488518, abs=1e-10)
    assert _response(sos, 0.5, 250) == pytest.approx(0.031229, abs=1e-6)
    assert _response(sos, 1, 250) == pytest.approx(0.707107, abs=1e-6)
    h = dsp.impulse_response(250.0, "highpass", 4)
    assert h == pytest.approx([0.96014885, -0.07808952, -0.07490456, -0.07180019], abs=1e-8)


def test_harmonics_stay_below_nyquist():
    assert dsp.mains_harmonics(250) == [60.0, 120.0]
    assert dsp.mains_harmonics(121) == []
    assert len(dsp.chain_sections(250.0, "standard")) == 13


@pytest.mark.parametrize("w", [5, 64, 400, 1500])
def test_window_transforms_equal_recursion(w):
    x = np.random.default_rng(1).normal(size=(3, w, 2))
    sos = dsp.chain_sections(250.0, "standard")
    y = np.stack([np.stack([_direct(sos, r[:, c]) for c in range(2)], axis=1) for r in x])
    assert np.max(np.abs(dsp._zero_state_filter("standard", x, 250.0) - y)) < 1e-9
    assert np.max(np.abs(dsp._apply("standard", x, 250.0) - np.abs(np.fft.fft(y, axis=1)))) < 1e-8


def test_block_parallel_filter_equals_whole_signal(spark):
    rng = np.random.default_rng(3)
    rows = []
    for sid, n in ((1, 3000), (2, 700), (3, 5)):
        x = rng.normal(size=n)
        rows += [(sid, i, float(v)) for i, v in enumerate(x)]
    pdf = pd.DataFrame(rows, columns=["sid", "i", "v"])
    df = spark.createDataFrame(pdf)
    got = dsp.filter_signals(df, ["sid"], "i", "v", 250.0, "filters", block=256).toPandas()
    sos = dsp.chain_sections(250.0, "filters")
    for sid, g in pdf.groupby("sid"):
        want = _direct(sos, g.sort_values("i")["v"].to_numpy())
        have = got[got.sid == sid].sort_values("i")["filtered"].to_numpy()
        assert len(have) == len(want)
        assert np.max(np.abs(have - want)) < 1e-9


@pytest.mark.parametrize("fs, n, block", [(250.0, 4000, 1024), (250.0, 4000, 100), (20000.0, 7000, 2048), (8.0, 50, 16)])
def test_composed_states_equal_one_recursion(spark, fs, n, block):
    """Three blocks and more, memory longer than the block, at 20 kHz too."""
    x = np.random.default_rng(7).normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"sid": "a", "i": np.arange(n), "v": x}))
    got = dsp.filter_signals(df, ["sid"], "i", "v", fs, "filters", block=block).toPandas().sort_values("i")
    want = _direct(dsp.chain_sections(fs, "filters"), x)
    assert got["i"].tolist() == list(range(n))
    assert np.max(np.abs(got["filtered"].to_numpy() - want)) < 1e-9


def test_states_pass_absent_blocks_and_null_keys(spark):
    """A gap of whole blocks is silence; a NULL key is one signal of its own."""
    n, block = 1500, 128
    x = np.random.default_rng(9).normal(size=n)
    there = [i for i in range(n) if not 200 <= i < 700]
    rows = [(k, i, None if i == 30 else float(x[i])) for k in (None, "b") for i in there]
    df = spark.createDataFrame(rows, "sid string, i long, v double")
    got = dsp.filter_signals(df, ["sid"], "i", "v", 250.0, "filters", block=block).toPandas()
    silent = np.where(np.isin(np.arange(n), there) & (np.arange(n) != 30), x, 0.0)
    want = _direct(dsp.chain_sections(250.0, "filters"), silent)[there]
    for part in (got[got.sid.isna()], got[got.sid == "b"]):
        part = part.sort_values("i")
        assert part["i"].tolist() == there
        assert np.max(np.abs(part["filtered"].to_numpy() - want)) < 1e-9


def test_design_equals_frequency_response():
    """The oracle's response is made from the analogue low-pass alone."""
    from cadence.plans.oracle import response

    for fs, kind in ((250.0, "filters"), (250.0, "bandstop"), (16.0, "standard"), (500.0, "highpass")):
        assert np.max(np.abs(response(fs, kind, 3000) - dsp.impulse_response(fs, kind, 3000))) < 1e-12


def test_modes_equal_sections():
    for fs, kind in ((250.0, "filters"), (8.0, "filters"), (500.0, "bandstop")):
        assert np.max(np.abs(dsp.mode_response(fs, kind, 3000) - dsp.impulse_response(fs, kind, 3000))) < 1e-12


def test_transform_windows_keeps_time_channel(spark):
    from pyspark.sql import functions as F

    w = 50
    t = np.arange(w, dtype=np.float32)
    sig = np.cos(2 * np.pi * 60 * np.arange(w) / 250).astype(np.float32)
    block = np.stack([t, sig], axis=1).reshape(-1).tolist()
    df = spark.createDataFrame([(block, 250, 2)], "samples array<float>, sampling_rate int, num_channels int")
    out = dsp.transform_windows(df, "filters", time_idx=F.lit(0)).first()["processed"]
    arr = np.asarray(out).reshape(w, 2)
    assert arr[:, 0] == pytest.approx(t)
    assert arr[:, 1] == pytest.approx(_direct(dsp.chain_sections(250.0, "filters"), sig.astype(float)), abs=1e-6)
    spec = np.asarray(dsp.transform_windows(df, "spectrum", time_idx=F.lit(0)).first()["processed"]).reshape(w, 2)
    assert spec[:, 0] == pytest.approx(t) and spec[:, 1] == pytest.approx(np.abs(np.fft.fft(sig.astype(float))), abs=1e-4)


def test_long_windows_use_fft_path_with_same_result():
    x = np.random.default_rng(5).normal(size=(3, 2000, 1))
    got = dsp._apply("filters", x, 250.0)
    want = np.stack([_direct(dsp.chain_sections(250.0, "filters"), x[r, :, 0]) for r in range(3)])[:, :, None]
    assert np.max(np.abs(got - want)) < 1e-9
    std = dsp._apply("standard", x, 250.0)
    assert np.max(np.abs(std[:, :, 0] - np.abs(np.fft.fft(want[:, :, 0], axis=1)))) < 1e-7


def test_stft_gathers_nothing_by_broadcast_and_picks_bins(spark):
    """Segments of a signal with gaps: no join may send the gathered samples
    to the driver; chosen bins are those of the full transform."""
    rows = [(u, i, float(i * 7 % 11)) for u in (1, None) for i in range(3000) if not 400 <= i < 2500]
    s = spark.createDataFrame(rows, "u long, i long, v double")
    full = dsp.stft(s, ["u"], "i", "v", 10.0)
    plan = full._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    order = ["u", "seg", "bin"]
    some = dsp.stft(s, ["u"], "i", "v", 10.0, bins=[4, 1, 5, 6])
    assert some.columns == full.columns and some.dtypes == full.dtypes
    want = full.where("bin IN (1, 4, 5)").orderBy(*order).collect()
    assert len(want) == 2 * 3 * ((3000 + 10 - 8) // 2)
    assert some.orderBy(*order).collect() == want
