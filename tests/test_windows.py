"""Sample windows (W2): closed-form counts, order independence, ragged
frames, the per-window hook; skew-safe positions (brute force)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cadence.operators import windows as W
from cadence.operators.ordinal import position_within, prefix_sum_within, skip_first


def _frames(spark, sessions, F_=10, C=2, fs=20, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for sid, nframes in sessions.items():
        for f in range(nframes):
            vals = rng.normal(size=F_ * C).astype(np.float32).tolist()
            rows.append((sid, "u", f, 0, 2024, 1, 1, 0, 0, 0, 0, "default", "standard", fs, F_, C, ["a", "b"][:C], vals))
    cols = "session_id string, user_name string, frame_number int, time_stamp int, year int, month int, day int, hour int, minute int, second int, microsecond int, ML_model string, preprocessing string, sampling_rate int, num_samples int, num_channels int, channel_names array<string>, samples array<float>"
    return spark.createDataFrame(rows, cols), rows


def _brute(rows, L, S, C):
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[2])):
        by.setdefault(r[0], []).extend(r[-1])
    out = {}
    for sid, flat in by.items():
        n = len(flat) // C
        k = 0
        while k * S + L < n:
            out[(sid, k)] = flat[k * S * C : (k * S + L) * C]
            k += 1
    return out


def test_windows_match_brute_force_and_closed_form(spark):
    df, rows = _frames(spark, {"s1": 7, "s2": 1, "s3": 3})
    L, S = 20, 4  # fs 20, 1 s, overlap 0.8
    got = {(r.session_id, r.k): list(r.samples) for r in W.sample_windows(df, 1.0, 0.8).collect()}
    want = _brute(rows, L, S, 2)
    assert got.keys() == want.keys()
    for k in want:
        assert np.allclose(got[k], want[k])
    for sid, nf in {"s1": 7, "s2": 1, "s3": 3}.items():
        n = nf * 10
        assert sum(1 for s, _ in got if s == sid) == max(0, math.ceil((n - L) / S))


def test_windows_do_not_depend_on_arrival_order(spark):
    df, _ = _frames(spark, {"s1": 9, "s2": 4}, seed=5)
    a = {(r.session_id, r.k, tuple(r.samples)) for r in W.sample_windows(df, 1.0, 0.8).collect()}
    shuffled = df.orderBy(F.rand(7)).repartition(5)
    b = {(r.session_id, r.k, tuple(r.samples)) for r in W.sample_windows(shuffled, 1.0, 0.8).collect()}
    assert a == b


def test_ragged_frames_with_running_start(spark):
    rng = np.random.default_rng(4)
    sizes = [5, 12, 3, 9, 20, 1, 7]
    rows, flat = [], []
    for f, n in enumerate(sizes):
        vals = rng.normal(size=n).astype(np.float32).tolist()
        flat += vals
        rows.append(("s", "u", f, 0, 2024, 1, 1, 0, 0, 0, 0, "default", "standard", 10, n, 1, ["x"], vals))
    cols = "session_id string, user_name string, frame_number int, time_stamp int, year int, month int, day int, hour int, minute int, second int, microsecond int, ML_model string, preprocessing string, sampling_rate int, num_samples int, num_channels int, channel_names array<string>, samples array<float>"
    df = spark.createDataFrame(rows, cols)
    df = prefix_sum_within(df, ["session_id"], ["frame_number"], "num_samples", "start", min_rows_per_bucket=2)
    got = {r.k: list(r.samples) for r in W.sample_windows(df, 1.0, 0.8, start_col="start").collect()}
    L, S = 10, 2
    want = {k: flat[k * S : k * S + L] for k in range(len(flat)) if k * S + L < len(flat)}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_position_within_hot_key(spark):
    rng = np.random.default_rng(9)
    n = 5000
    key = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n))  # one key holds ~60%
    pdf = pd.DataFrame({"key": key, "ts": rng.permutation(n), "id": np.arange(n)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = position_within(df, ["key"], ["ts", "id"], "pos", min_rows_per_bucket=100).toPandas().set_index("id")["pos"]
    tree = position_within(df, ["key"], ["ts", "id"], "pos", buckets=16, min_rows_per_bucket=100).toPandas().set_index("id")["pos"]
    assert (got.sort_index() == tree.sort_index()).all()
    pdf = pdf.sort_values(["key", "ts", "id"])
    pdf["want"] = pdf.groupby("key").cumcount()
    assert (got.loc[pdf["id"]].to_numpy() == pdf["want"].to_numpy()).all()


def test_skip_first(spark):
    df = spark.range(0, 1000).withColumn("p", F.format_string("f%04d", (F.col("id") * 7919) % 1000))
    got = sorted(r.p for r in skip_first(df.select("p"), ["p"], 100, min_rows_per_bucket=50).collect())
    assert got == sorted(f"f{i:04d}" for i in range(100, 1000))


def test_apply_per_window(spark):
    df, rows = _frames(spark, {"s1": 5}, F_=10, C=2, fs=10)
    schema = "session_id string, k long, first double"

    def fn(sid, k, X):
        return pd.DataFrame({"session_id": [sid], "k": [k], "first": [float(X[0, 0])]})

    got = {r.k: r.first for r in W.apply_per_window(df, fn, schema, 1.0, 0.8).collect()}
    want = _brute(rows, 10, 2, 2)
    assert got.keys() == {k for _, k in want}
    assert all(abs(got[k] - want[("s1", k)][0]) < 1e-6 for k in got)


def test_buckets_are_deterministic_and_split_hot_keys(spark):
    from cadence.operators.ordinal import bucket_bounds, bucket_of

    rng = np.random.default_rng(2)
    n = 20000
    pdf = pd.DataFrame({"key": np.where(rng.random(n) < 0.5, 7, rng.integers(0, 100, n)), "ts": rng.permutation(n)})
    df = spark.createDataFrame(pdf).repartition(6)
    b1 = bucket_bounds(df, ["key", "ts"], 16, min_rows=100)
    b2 = bucket_bounds(df.repartition(6), ["key", "ts"], 16, min_rows=100)
    assert b1 and b1 == b2
    hot = df.where("key = 7").select(bucket_of(df, ["key", "ts"], b1).alias("b")).distinct().count()
    assert hot >= 5


def test_stat_buckets_split_hot_key(spark):
    from cadence.operators.ordinal import _stat_buckets

    rng = np.random.default_rng(8)
    n = 20000
    pdf = pd.DataFrame({"key": np.where(rng.random(n) < 0.5, 7, rng.integers(0, 100, n)), "ts": rng.permutation(n)})
    df = spark.createDataFrame(pdf)
    b, split = _stat_buckets(df, ["key"], F.col("ts").cast("double"), 500)
    assert split
    sizes = b.groupBy("key", "_pid").count().toPandas()
    assert sizes[sizes.key == 7]["_pid"].nunique() >= 15
    assert sizes["count"].max() < 1500


def test_missing_frame_suppresses_only_windows_that_need_it(spark):
    df, rows = _frames(spark, {"s": 30}, F_=10, C=1, fs=20, seed=12)
    holed = df.where(F.col("frame_number") != 13)
    got = {r.k: list(r.samples) for r in W.sample_windows(holed, 1.0, 0.8).collect()}
    L, S = 20, 4
    flat = [v for r in sorted(rows, key=lambda r: r[2]) for v in r[-1]]
    present = set(range(300)) - set(range(130, 140))
    want = {
        k: flat[k * S : k * S + L]
        for k in range(300)
        if k * S + L < 300 and all(i in present for i in range(k * S, k * S + L + 1))
    }
    assert got.keys() == want.keys()
    assert any(k * S > 140 for k in got)  # windows after the gap are emitted
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_positions_with_null_order_values_in_hot_key(spark):
    rows = [(1, None if i % 10 == 0 else i, i) for i in range(200)] + [(2, i, 1000 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "key int, ts int, id int")
    got = {r.id: r.pos for r in position_within(df, ["key"], ["ts", "id"], "pos", min_rows_per_bucket=20).collect()}
    pdf = pd.DataFrame(rows, columns=["key", "ts", "id"])
    pdf["tsn"] = pdf["ts"].fillna(-1)  # NULLs first
    pdf = pdf.sort_values(["key", "tsn", "id"])
    pdf["want"] = pdf.groupby("key").cumcount()
    assert all(got[i] == w for i, w in zip(pdf["id"], pdf["want"]))


def test_sessions_with_different_rates(spark):
    a, rows_a = _frames(spark, {"fast": 12}, F_=25, C=2, fs=25, seed=31)
    b, rows_b = _frames(spark, {"slow": 9}, F_=10, C=2, fs=10, seed=32)
    got = {(r.session_id, r.k): (r.num_samples, list(r.samples)) for r in W.sample_windows(a.unionByName(b), 1.0, 0.8).collect()}
    want = {}
    for rows, fs in ((rows_a, 25), (rows_b, 10)):
        L = fs
        S = int(float((np.float32(1.0) - np.float32(0.8)) * np.float32(1.0) * np.float32(fs)) + 0.5)
        for (sid, k), v in _brute(rows, L, S, 2).items():
            want[(sid, k)] = (L, v)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and np.allclose(got[k][1], want[k][1]) for k in want)


def test_apply_per_window_takes_rows(spark):
    """A function may return row tuples, by position, beside tables."""
    df = spark.createDataFrame([("s", 0, 40, [float(i) for i in range(40)])], "session_id string, start long, n int, samples array<float>")
    frames = W.samples_as_frames(df.select("session_id", F.posexplode("samples").alias("i", "v")), "session_id", "i", "v", 10)

    def fn(session, k, X):
        if k % 3 == 0:
            return None
        if k % 3 == 1:
            return [(k, float(X[0, 0])), (k, float(X[-1, 0]))]
        return pd.DataFrame({"k": [k], "value": [float(X.sum())]})

    got = sorted(map(tuple, W.apply_per_window(frames, fn, "k long, value double", 1.0, 0.8, start_col="start").collect()))
    want = []
    for k in range(15):  # windows [2k, 2k + 10) with the sample past their end
        if k % 3 == 1:
            want += [(k, 2.0 * k), (k, 2.0 * k + 9)]
        elif k % 3 == 2:
            want.append((k, sum(2.0 * k + i for i in range(10))))
    assert got == sorted(want)
