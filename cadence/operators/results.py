"""Scoring results: score rows (M2), new-session anti-join (J3), session
registration (S7), foreign-key check (J4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.header import event_time, session_start
from cadence.operators.models import dispatch_model
from cadence.session import read_if_written


def score(frames: DataFrame, models: dict | None = None) -> DataFrame:
    """M2 core: classify decoded frames/windows by their ``ML_model`` and
    place them in time → (sess_id, time_in, time_ms, class) plus the session
    columns needed to register new sessions."""
    scored = dispatch_model(frames, models=models)
    start = session_start()
    return scored.select(
        F.col("session_id").alias("sess_id"),
        event_time(start, F.col("time_stamp")).alias("time_in"),
        F.col("time_stamp").alias("time_ms"),
        F.col("class"),
        F.col("user_name"),
        F.col("ML_model").alias("ml_model"),
        F.col("preprocessing"),
        F.col("frame_number"),
    )


def data_rows(scored: DataFrame) -> DataFrame:
    """S6 row shape of the ``data`` table."""
    return scored.select("sess_id", "time_in", "time_ms", "class")


def first_per_session(scored: DataFrame) -> DataFrame:
    """One ``sessions`` row per sess_id: values of its first row by
    (frame_number, time_ms).  ``min_by`` combines map-side, so a hot session
    costs one partial row per task."""
    first = F.min_by(
        F.struct("user_name", "ml_model", "preprocessing"),
        F.struct("frame_number", "time_ms"),
    )
    return scored.groupBy("sess_id").agg(first.alias("_f")).select("sess_id", "_f.user_name", "_f.ml_model", "_f.preprocessing")


def new_sessions(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidate sessions not yet stored (left anti-join on sess_id)."""
    return candidates.join(existing.select("sess_id"), "sess_id", "left_anti")


def register_sessions(scored: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows to insert into ``sessions`` — first row per new session."""
    return new_sessions(first_per_session(scored), existing)


def fk_orphans(data: DataFrame, sessions: DataFrame) -> DataFrame:
    """``data`` rows whose sess_id has no ``sessions`` row."""
    return data.join(sessions.select("sess_id"), "sess_id", "left_anti")


SESSIONS = "sess_id string, user_name string, ml_model string, preprocessing string, start_day string, batch_id long"


def start_day(sess_id: Column | str = "sess_id") -> Column:
    """Day on which a session began, read from its id (user name + start);
    ``none`` when the id does not end in a time stamp."""
    c = F.col(sess_id) if isinstance(sess_id, str) else sess_id
    return F.coalesce(F.nullif(F.regexp_extract(c, r"([0-9]{4}-[0-9]{2}-[0-9]{2}) [0-9:.]+$", 1), F.lit("")), F.lit("none"))


def stored_sessions(spark, path: str, days: list[str], before_batch: int | None = None) -> DataFrame:
    """Stored sessions that began on one of ``days``; the files of other days
    are not opened.  ``before_batch`` leaves out that batch and later ones, so
    a batch that is run again meets what it met the first time."""
    table = read_if_written(spark, path, SESSIONS)
    if table is None:
        table = spark.createDataFrame([], SESSIONS)
    table = table.where(F.col("start_day").isin(days))
    return table if before_batch is None else table.where(F.col("batch_id") < before_batch)


def append_sessions(new: DataFrame, path: str, batch_id: int) -> None:
    """Session rows by the day they began, then batch: a batch that is run
    again replaces its own rows."""
    own = new.withColumn("start_day", start_day()).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("start_day", "batch_id").parquet(path)


def scoring_sink(sessions_path: str, data_path: str, models: dict | None = None, existing=None):
    """M2 as a stream sink: a ``foreachBatch`` function that, per micro-batch
    of decoded frames, scores them (U2 → P5), registers sessions not stored
    yet (S7 against the sessions table, plus ``existing`` if given) and
    appends the result rows (S6).  The sessions table is kept by the day a
    session began, which its id tells, so a micro-batch opens the files of its
    own days however many sessions are stored.  Both writes are keyed by batch
    id, so a replayed batch overwrites its own output instead of duplicating
    it."""
    from cadence.sources.sinks import append_results

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        # one micro-batch feeds two writes: keep its scored rows for both
        scored = score(batch_df, models=models).persist()
        days = [r["d"] for r in scored.select(start_day().alias("d")).distinct().collect()]  # the days of one batch
        stored = stored_sessions(spark, sessions_path, days, batch_id).select("sess_id")
        if existing is not None:
            stored = stored.unionByName(existing.select("sess_id"))
        append_sessions(register_sessions(scored, stored), sessions_path, batch_id)
        append_results(data_rows(scored), data_path, batch_id=batch_id)
        scored.unpersist()

    return sink
