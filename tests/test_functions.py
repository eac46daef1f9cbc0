"""Scalar helpers: label map, time channel, split, padding, frequency axis,
session start / event time, rule model."""

import datetime as dt

from pyspark.sql import functions as F

from cadence.functions.arrays import pad_truncate, weighted_checksum
from cadence.functions.header import event_time, session_start, split_time, time_channel_idx
from cadence.operators.dsp import freq_axis, magnitude
from cadence.operators.labels import label_code
from cadence.operators.models import rule_class


def test_label_code(spark):
    df = spark.createDataFrame([("bckg",), (" FnSz ",), ("mysz",), ("nope",), (None,)], "label string")
    assert [r.c for r in df.select(label_code(F.col("label")).alias("c")).collect()] == [6, 8, 17, None, None]


def test_time_channel_idx(spark):
    df = spark.createDataFrame([(["EEG", "TIME", "x"],), (["a", "b"],), (["time", "Time"],)], "names array<string>")
    assert [r.t for r in df.select(time_channel_idx(F.col("names")).alias("t")).collect()] == [1, -1, 0]


def test_split_time_without_time_channel(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 2, -1), ([1.0, 2.0, 3.0, 4.0], 2, 1)], "samples array<double>, num_channels int, time_idx int")
    rows = split_time(df).collect()
    assert rows[0].time == [] and rows[0].signal == [1.0, 2.0, 3.0, 4.0]
    assert rows[1].time == [2.0, 4.0] and rows[1].signal == [1.0, 3.0]


def test_pad_truncate(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([float(i) for i in range(40)],)], "v array<double>")
    out = [r.p for r in df.select(pad_truncate(F.col("v"), 32).alias("p")).collect()]
    assert out[0] == [1.0, 2.0] + [0.0] * 30 and out[1] == [float(i) for i in range(32)]


def test_freq_axis_odd_and_even(spark):
    df = spark.range(5).select(F.col("id").alias("b"))
    assert [r.f for r in df.select(freq_axis(F.col("b"), F.lit(5), F.lit(10)).alias("f")).collect()] == [0.0, 2.0, 4.0, -4.0, -2.0]
    df = spark.range(4).select(F.col("id").alias("b"))
    assert [r.f for r in df.select(freq_axis(F.col("b"), F.lit(4), F.lit(8)).alias("f")).collect()] == [0.0, 2.0, -4.0, -2.0]
    assert spark.range(1).select(magnitude(F.lit(3.0), F.lit(-4.0)).alias("m")).first().m == 5.0


def test_session_start_and_event_time_exact(spark):
    df = spark.createDataFrame([(2024, 2, 29, 23, 59, 59, 999999, 1)], "y int, mo int, d int, h int, mi int, s int, us int, ms int")
    st = session_start("y", "mo", "d", "h", "mi", "s", "us")
    r = df.select(st.alias("st"), event_time(st, F.col("ms")).alias("et")).first()
    assert r.st == dt.datetime(2024, 2, 29, 23, 59, 59, 999999)
    assert r.et == dt.datetime(2024, 3, 1, 0, 0, 0, 999)


def test_rule_class_and_checksum(spark):
    df = spark.createDataFrame([(0,), (5000,), (5001,), (19999,), (-1,)], "t int")
    assert [r.c for r in df.select(rule_class(F.col("t")).alias("c")).collect()] == [0, 0, 1, 1, 1]
    cs = spark.createDataFrame([([0.5, -1.25, 2.0],)], "v array<double>").select(weighted_checksum(F.col("v")).alias("c")).first().c
    assert cs == 0.5 - 2.5 + 6.0


def test_java_int_cast(spark):
    from cadence.functions.header import java_int
    from cadence.streaming.ops import _java_int

    vals = [1.9, -1.9, float("nan"), 3e9, -3e9, 0.0]
    got = [r.i for r in spark.createDataFrame([(v,) for v in vals], "x double").select(java_int(F.col("x")).alias("i")).collect()]
    want = [1, -1, 0, 2147483647, -2147483648, 0]
    assert got == want
    assert [_java_int(v) for v in vals] == want


def test_registries_hold_back_unserved_names(spark):
    from cadence.operators.models import dispatch_model, dispatch_processing, fixture_processors

    df = spark.createDataFrame([(1, "default", 6000), (2, "nobody", 6000)], "id int, ML_model string, time_stamp int")
    kept = {r.id: r["class"] for r in dispatch_model(df).collect()}
    assert kept == {1: 1, 2: None}
    assert [r.id for r in dispatch_model(df, keep_unserved=False).collect()] == [1]
    w = spark.createDataFrame(
        [([1.0] * 8, 250, 1, "standard"), ([1.0] * 8, 250, 1, "spectrum"), ([1.0] * 8, 250, 1, "unknown")],
        "samples array<float>, sampling_rate int, num_channels int, preprocessing string",
    )
    out = dispatch_processing(w, processors=fixture_processors()).collect()
    assert sorted(r.preprocessing for r in out) == ["spectrum", "standard"]
    spec = [r for r in out if r.preprocessing == "spectrum"][0].processed
    assert spec[0] == 8.0 and max(abs(x) for x in spec[1:]) < 1e-12
