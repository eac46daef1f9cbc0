"""Frame wire format: round trip, malformed frames, header defaults."""

import numpy as np
from pyspark.sql import functions as F

from cadence.functions.header import make_header
from cadence.sources.frames import classify_frames, decode_frames, encode_frames, split_malformed


def _frames(spark, n=20):
    rows = [(i, [float(x) for x in np.arange(6) + i], f"user{i % 3}") for i in range(n)]
    df = spark.createDataFrame(rows, "i int, samples array<float>, user string")
    h = make_header(
        df,
        session_start=F.lit("2024-03-01 10:00:00.250000"),
        user_name=F.col("user"),
        frame_number=F.col("i"),
        time_stamp=F.col("i") * 1000,
        channel_names=F.array(F.lit("time"), F.lit("c")),
        num_samples=F.lit(3),
        num_channels=F.lit(2),
    )
    return h


def test_round_trip(spark):
    h = _frames(spark)
    enc = encode_frames(h)
    dec = decode_frames(enc, keep=("i",)).orderBy("i").collect()
    src = h.orderBy("i").collect()
    assert len(dec) == len(src)
    for a, b in zip(src, dec):
        assert list(a["samples"]) == list(b["samples"])
        assert a["header"]["session_id"] == b["session_id"]
        assert b["microsecond"] == 250000 and b["ML_model"] == "default" and b["sampling_rate"] == 250


def test_wire_layout(spark):
    enc = encode_frames(_frames(spark, 1)).select("value").first()["value"]
    hl = int.from_bytes(enc[:4], "little")
    assert enc[4 : 4 + hl].decode().startswith('{"user_name":"user0"')
    assert np.frombuffer(enc[4 + hl :], "<f4").tolist() == [0, 1, 2, 3, 4, 5]


def test_malformed_are_quarantined(spark):
    enc = encode_frames(_frames(spark, 6)).select("i", "value")
    bad = enc.select(
        "i",
        F.when(F.col("i") == 0, F.expr("substring(value, 1, octet_length(value) - 2)"))
        .when(F.col("i") == 1, F.concat(F.unhex(F.lit("FFFF0000")), F.expr("substring(value, 5)")))
        .when(F.col("i") == 2, F.lit(None).cast("binary"))
        .when(F.col("i") == 3, F.unhex(F.lit("0102")))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    st = {r["i"]: r["status"] for r in classify_frames(bad).collect()}
    assert st[0] == "payload_size" and st[1] == "bad_length" and st[3] == "too_short"
    assert st[4] == "ok" and st[5] == "ok"
    good, q = split_malformed(bad)
    assert good.count() == 2 and q.count() == 4


def test_live_header_stamps_current_time(spark):
    import datetime as dt

    df = spark.createDataFrame([("u", 0)], "user string, i int")
    h = make_header(
        df, session_start=None, user_name=F.col("user"), frame_number=F.col("i"), time_stamp=F.col("i"),
        channel_names=F.array(F.lit("c")), num_samples=F.lit(1), num_channels=F.lit(1),
    ).select("header.*").first()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs(h.year - now.year) <= 1 and h.session_id.startswith("u")
