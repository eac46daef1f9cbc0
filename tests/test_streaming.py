"""Streams: restart from checkpoint without duplicates, stateful windows
equal batch windows under scrambled arrival, late-row side table."""

from pyspark.sql import functions as F

from cadence.operators import windows as W
from cadence.session import scratch_dir
from cadence.streaming.ops import late_rows_sink, stateful_windows, with_event_time
from cadence.streaming.runner import run_available_now, stage_files
from tests.test_windows import _frames


def test_stateful_matches_batch_under_scrambled_arrival(spark):
    df, _ = _frames(spark, {"a": 12, "b": 6}, seed=11)
    batch = {(r.session_id, r.k, tuple(r.samples)) for r in W.sample_windows(df, 1.0, 0.8).collect()}
    staged = stage_files(df.orderBy(F.rand(3)), "t6-input", files=5)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(staged)
    out = run_available_now(stateful_windows(stream, 1.0, 0.8), "t6-output")
    got = {(r.session_id, r.k, tuple(r.samples)) for r in spark.read.parquet(out).collect()}
    assert got == batch


def test_restart_from_checkpoint_has_no_duplicates(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    first, second = ev.where(F.col("event_id") < 500), ev.where(F.col("event_id") >= 500)
    src = stage_files(first, "restart-in", files=2)
    ckpt, out = scratch_dir(spark, "restart-ckpt"), scratch_dir(spark, "restart-out")

    def run():
        s = spark.readStream.schema(ev.schema).parquet(src)
        run_available_now(s.select("event_id", "user_id"), "restart", checkpoint=ckpt, path=out)

    run()
    stage_files(second, "restart-in", files=2, path=src)
    run()
    run()  # nothing new: must not rewrite anything
    res = spark.read.parquet(out)
    assert res.count() == ev.count() == res.select("event_id").distinct().count()


def test_watermarked_windows_emit_only_closed(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = stage_files(ev, "wm-in", files=1)
    s = with_event_time(spark.readStream.schema(ev.schema).parquet(src), "ts", "1 hour")
    win = W.time_windows(s, "ts", "2 hours", "1 hour", ["user_id"], [F.count(F.lit(1)).alias("n")])
    out = spark.read.parquet(run_available_now(win, "wm-out"))
    mx = ev.agg(F.max("ts")).first()[0]
    batch = W.time_windows(ev, "ts", "2 hours", "1 hour", ["user_id"], [F.count(F.lit(1)).alias("n")])
    import datetime as dt

    closed = batch.where(F.col("window_end") <= F.lit(mx - dt.timedelta(hours=1)))
    assert out.count() == closed.count()
    assert out.exceptAll(closed).count() == 0


def test_late_rows_side_table(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = None
    for b in range(3):
        src = stage_files(ev.where(F.col("event_id") % 3 == b), "late-in", files=1, path=src)
    side = scratch_dir(spark, "late-side")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_available_now(s, "late", foreach_batch=late_rows_sink(side, "ts", 3600.0))
    late = spark.read.parquet(f"{side}/late")
    assert late.count() > 0
    assert set(r.batch_id for r in late.select("batch_id").distinct().collect()) <= {1, 2}


def test_scoring_stream_registers_each_session_once(spark):
    from cadence.operators.results import scoring_sink
    from cadence.plans.catalog import all_types_default, header_frames
    from cadence.sources.frames import decode_frames

    msgs = header_frames(spark, "/root/testdata/sf0.001").select("value")
    staged = stage_files(msgs, "score-test-in", files=4)
    sessions, data = scratch_dir(spark, "score-test-sessions"), scratch_dir(spark, "score-test-data")
    ckpt = scratch_dir(spark, "score-test-ckpt")
    for _ in range(2):  # second run resumes from the checkpoint: nothing re-written
        stream = decode_frames(spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(staged))
        run_available_now(stream, "score-test", foreach_batch=scoring_sink(sessions, data, all_types_default()), checkpoint=ckpt)
    d = spark.read.parquet(data)
    s = spark.read.parquet(sessions)
    assert d.count() == msgs.count()
    assert s.count() == s.select("sess_id").distinct().count() == d.select("sess_id").distinct().count()


def test_registration_opens_only_the_days_of_its_batch(spark):
    """Stored days grow tenfold, the files opened for one day do not; a batch
    that is run again leaves the table as it was; ids without a start go too."""
    from cadence.operators.results import append_sessions, register_sessions, stored_sessions

    path = scratch_dir(spark, "session-index")

    def rows(ids):
        made = [(i, "u", "m", "p", 0, 0) for i in ids]
        return spark.createDataFrame(made, "sess_id string, user_name string, ml_model string, preprocessing string, frame_number int, time_ms int")

    def batch(n, ids, days):
        append_sessions(register_sessions(rows(ids), stored_sessions(spark, path, days, n)), path, n)

    def day(d):
        return f"2024-01-{d:02d}"

    opened = []
    for n in range(1, 11):
        batch(n, [f"u{j}{day(n)} 00:00:00" for j in range(3)] + [f"odd{n}"], [day(n), "none"])
        one = stored_sessions(spark, path, [day(1)])
        one.collect()
        scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        opened.append(scan.metrics().apply("numFiles").value())
    assert len(set(opened)) == 1 and opened[0] > 0
    before = sorted(map(tuple, stored_sessions(spark, path, [day(d) for d in range(1, 11)] + ["none"]).collect()))
    assert len(before) == 40
    for n in (10, 11):  # the last batch again, then the same sessions as a new batch
        batch(n, [f"u{j}{day(10)} 00:00:00" for j in range(3)] + ["odd10"], [day(10), "none"])
    assert sorted(map(tuple, stored_sessions(spark, path, [day(d) for d in range(1, 11)] + ["none"]).collect())) == before


def test_rows_of_unregistered_names_go_to_a_side_table(spark):
    from cadence.operators.models import split_unserved

    df = spark.createDataFrame([(1, "standard"), (2, "other"), (3, None)], "id int, preprocessing string")
    served, rest = split_unserved(df, "preprocessing", {"standard": None})
    assert [r.id for r in served.collect()] == [1] and sorted(r.id for r in rest.collect()) == [2, 3]


def test_minibatch_kmeans_stream_matches_sequential_updates(spark):
    import numpy as np

    from cadence.operators.models import minibatch_kmeans_sink

    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", F.slice("embedding", 1, 4).alias("v"))
    src = None
    for b in range(3):
        src = stage_files(emb.where(F.col("vec_id") % 3 == b), "km-in", files=1, path=src)
    init = [[0.0] * 4, [0.1] * 4]
    out = scratch_dir(spark, "km-out")
    s = spark.readStream.schema(emb.schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_available_now(s, "km", foreach_batch=minibatch_kmeans_sink(out, "v", init))
    table = spark.read.parquet(out)
    last = table.agg(F.max("version")).first()[0]
    got = np.zeros((2, 4))
    for r in table.where(F.col("version") == last).collect():
        got[r["cluster"], r["dim"]] = r["value"]
    # sequential reference over the same batches (file order = arrival order)
    c, seen = np.array(init), np.zeros(2)
    for b in range(3):
        X = np.array([r["v"] for r in emb.where(F.col("vec_id") % 3 == b).collect()], dtype=float)
        lab = np.argmin(((X[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        for j in range(2):
            m = X[lab == j]
            if len(m):
                c[j] = c[j] + (m.sum(0) - len(m) * c[j]) / (seen[j] + len(m))
                seen[j] += len(m)
    assert np.allclose(got, c, atol=1e-9)


def test_long_running_stream_and_progress(spark):
    from cadence.streaming.runner import last_progress, start_stream

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = stage_files(ev, "lr-in", files=2)
    out, ckpt = scratch_dir(spark, "lr-out"), scratch_dir(spark, "lr-ckpt")
    q = start_stream(spark.readStream.schema(ev.schema).parquet(src).select("event_id"), "lr_events", ckpt, "1 second", path=out)
    try:
        q.processAllAvailable()
        assert last_progress(q) is not None
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == ev.count()


def test_stateful_windows_with_ragged_frames(spark):
    import numpy as np

    from cadence.operators.ordinal import prefix_sum_within

    rng = np.random.default_rng(21)
    sizes = [5, 12, 3, 9, 20, 1, 7, 16, 4, 11]
    rows = []
    for f, n in enumerate(sizes):
        vals = rng.normal(size=n).astype(np.float32).tolist()
        rows.append(("s", "u", f, 0, 2024, 1, 1, 0, 0, 0, 0, "default", "standard", 10, n, 1, ["x"], vals))
    cols = "session_id string, user_name string, frame_number int, time_stamp int, year int, month int, day int, hour int, minute int, second int, microsecond int, ML_model string, preprocessing string, sampling_rate int, num_samples int, num_channels int, channel_names array<string>, samples array<float>"
    df = prefix_sum_within(spark.createDataFrame(rows, cols), ["session_id"], ["frame_number"], "num_samples", "start", min_rows_per_bucket=3)
    batch = {(r.k, r.frame_number, tuple(r.samples)) for r in W.sample_windows(df, 1.0, 0.8, start_col="start").collect()}
    staged = stage_files(df.orderBy(F.rand(5)), "t6-ragged-in", files=3)
    stream = spark.readStream.schema(spark.read.parquet(staged).schema).option("maxFilesPerTrigger", 1).parquet(staged)
    out = run_available_now(stateful_windows(stream, 1.0, 0.8, start_col="start"), "t6-ragged-out")
    got = {(r.k, r.frame_number, tuple(r.samples)) for r in spark.read.parquet(out).collect()}
    assert got == batch and len(got) > 0


def test_console_sink_runs(spark):
    from cadence.sources.sinks import write_console

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(5)
    src = stage_files(ev, "console-in", files=1)
    q = write_console(spark.readStream.schema(ev.schema).parquet(src).select("event_id", "event_type"))
    try:
        q.processAllAvailable()
        assert q.lastProgress["numInputRows"] == 5
    finally:
        q.stop()


def test_stateful_windows_wait_for_scrambled_halves_of_long_sessions(spark):
    df, _ = _frames(spark, {"a": 400, "b": 300}, seed=5)
    batch = {(r.session_id, r.k, tuple(r.samples)) for r in W.sample_windows(df, 1.0, 0.8).collect()}
    src = None
    for half in range(2):  # two micro-batches, each half of every session at random
        src = stage_files(df.where(F.crc32(F.concat("session_id", F.col("frame_number").cast("string"))) % 2 == half), "t6-halves", files=1, path=src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = spark.read.parquet(run_available_now(stateful_windows(stream, 1.0, 0.8), "t6-halves-out"))
    assert {(r.session_id, r.k, tuple(r.samples)) for r in out.collect()} == batch


def test_frames_given_up_by_event_time_go_to_the_side_table(spark):
    from cadence.streaming.ops import split_late_frames

    df, rows = _frames(spark, {"a": 60}, seed=6)  # frames of half a second
    src = None
    lost, twice = F.col("frame_number") == 20, F.col("frame_number") == 3
    for part in (df.where(~lost), df.where(lost | twice), df.where(lost)):
        src = stage_files(part, "t6-lost", files=1, path=src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = run_available_now(stateful_windows(stream, 1.0, 0.8, lateness_s=10.0), "t6-lost-out")
    windows, late = split_late_frames(spark.read.parquet(out))
    want = {r.k for r in W.sample_windows(df, 1.0, 0.8).collect() if r.start_idx + 20 < 200 or r.start_idx >= 210}
    assert sorted(r.k for r in windows.collect()) == sorted(want)
    assert [(r.start, r.frame_number, tuple(r.samples)) for r in late.collect()] == [(200, 20, tuple(rows[20][-1]))]


def test_windows_of_a_long_session_are_read_by_many_tasks(spark):
    df, _ = _frames(spark, {"a": 60}, seed=7)
    staged = stage_files(df, "t6-long", files=1)
    cut = stateful_windows(spark.readStream.schema(df.schema).parquet(staged), 1.0, 0.8)
    out = spark.read.parquet(run_available_now(cut, "t6-long-out", rows_per_file=50))
    assert out.count() == W.sample_windows(df, 1.0, 0.8).count() == 145
    assert sorted(r["count"] for r in out.groupBy(F.input_file_name()).count().collect()) == [45, 50, 50]
