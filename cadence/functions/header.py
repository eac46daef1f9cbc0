"""Frame header expressions: build with defaults, JSON, time, time channel.

P1 make_header, P2 check_header, P3 header JSON, P4 session start, P5 event
time, P6 time-channel lookup, P7 split time from signal, P14 window stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.schemas import HEADER, HEADER_FIELDS, HEADER_NAMES

# Defaults of a header whose field is absent.
DEFAULT_MODEL = "default"
DEFAULT_PREPROCESSING = "standard"
DEFAULT_SAMPLING_RATE = 250


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def make_header(
    df: DataFrame,
    *,
    session_start: Column | str | None,
    user_name: Column | str = "user_name",
    frame_number: Column | str = "frame_number",
    time_stamp: Column | str = "time_stamp",
    channel_names: Column | str = "channel_names",
    num_samples: Column | str = "num_samples",
    num_channels: Column | str = "num_channels",
    session_id: Column | str | None = None,
    ml_model: Column | str | None = None,
    preprocessing: Column | str | None = None,
    sampling_rate: Column | str | None = None,
) -> DataFrame:
    """Add a typed ``header`` struct column, applying the defaults.

    A missing session id becomes user name + start time text.  The session
    start should be given; ``None`` stamps the current UTC time as a live
    producer does — nondeterministic, so batch jobs and fixtures never use it.
    """
    if session_start is None:
        start = F.current_timestamp().cast("timestamp_ntz")
    else:
        start = _c(session_start).cast("timestamp_ntz")
    micro = F.unix_micros(start.cast("timestamp")) % 1_000_000
    start_text = F.concat(
        F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
        F.when(micro != 0, F.concat(F.lit("."), F.lpad(micro.cast("string"), 6, "0"))).otherwise(F.lit("")),
    )
    user = _c(user_name).cast("string")
    sid = F.concat(user, start_text)
    if session_id is not None:
        sid = F.coalesce(_c(session_id).cast("string"), sid)
    model = F.lit(DEFAULT_MODEL) if ml_model is None else F.coalesce(_c(ml_model).cast("string"), F.lit(DEFAULT_MODEL))
    prep = (
        F.lit(DEFAULT_PREPROCESSING)
        if preprocessing is None
        else F.coalesce(_c(preprocessing).cast("string"), F.lit(DEFAULT_PREPROCESSING))
    )
    rate = (
        F.lit(DEFAULT_SAMPLING_RATE)
        if sampling_rate is None
        else F.coalesce(_c(sampling_rate).cast("int"), F.lit(DEFAULT_SAMPLING_RATE))
    )
    fields = {
        "user_name": user,
        "session_id": sid,
        "frame_number": _c(frame_number).try_cast("int"),
        "time_stamp": _c(time_stamp).try_cast("int"),
        "year": F.year(start),
        "month": F.month(start),
        "day": F.dayofmonth(start),
        "hour": F.hour(start),
        "minute": F.minute(start),
        "second": F.second(start),
        "microsecond": micro.cast("int"),
        "ML_model": model,
        "preprocessing": prep,
        "sampling_rate": rate.cast("int"),
        "num_samples": _c(num_samples).try_cast("int"),
        "num_channels": _c(num_channels).try_cast("int"),
        "channel_names": _c(channel_names).cast("array<string>"),
    }
    # INT fields of the wire format: values that do not fit become NULL
    # (and fail ``check_header``) instead of raising
    return df.withColumn("header", F.struct(*[fields[n].try_cast(t).alias(n) for n, t in HEADER_FIELDS]))


def check_header(header: Column) -> Column:
    """A header is usable when it parsed, every field that decoding and
    windowing need is there, the rate is positive, names are a list and their
    count equals ``num_channels``.  Never NULL: a missing field is a defect."""
    usable = (
        header.isNotNull()
        & header["session_id"].isNotNull()
        & header["frame_number"].isNotNull()
        & (header["sampling_rate"] > 0)
        & header["channel_names"].isNotNull()
        & (F.size(header["channel_names"]) == header["num_channels"])
        & (header["num_samples"] > 0)
        & (header["num_channels"] > 0)
    )
    return F.coalesce(usable, F.lit(False))


def header_to_json(header: Column) -> Column:
    """P3 (write side): compact JSON text of the header."""
    return F.to_json(header)


def parse_header(text: Column) -> Column:
    """P3 (read side): typed header from JSON; NULL when unparseable."""
    return F.from_json(text, HEADER, {"mode": "PERMISSIVE"})


def session_start(year="year", month="month", day="day", hour="hour", minute="minute", second="second", micro="microsecond") -> Column:
    """Session start (naive UTC) from the seven header fields, exact to the µs."""
    secs = _c(second).cast("decimal(16,6)") + _c(micro).cast("decimal(16,6)") / F.lit(1_000_000).cast("decimal(16,6)")
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), _c(minute), secs)


def event_time(start: Column, ms: Column | str) -> Column:
    """P5: start + ``ms`` milliseconds."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(ms).cast("decimal(18,6)") / F.lit(1000))


def time_channel_idx(channel_names: Column | str = "channel_names") -> Column:
    """0-based index of the first channel named ``time`` (any case), -1 if none."""
    return (F.array_position(F.transform(_c(channel_names), lambda s: F.lower(s)), "time") - 1).cast("int")


def java_int(x: Column) -> Column:
    """float → int as the JVM's ``(int)`` cast: truncate toward zero, NaN → 0,
    saturate outside the int range (no ANSI overflow error)."""
    d = x.cast("double")
    return (
        F.when(F.isnan(d), F.lit(0))
        .when(d >= F.lit(2147483647.0), F.lit(2147483647))
        .when(d <= F.lit(-2147483648.0), F.lit(-2147483648))
        .otherwise(d.cast("int"))
    )


def window_time_stamp(samples: Column, time_idx: Column, start_idx: Column, sampling_rate: Column) -> Column:
    """Time stamp of a window — the first sample of the time channel
    truncated to int, else the window start in ms from its sample index
    (NULL if that overflows the header's int field)."""
    from_time = java_int(F.try_element_at(samples, (time_idx + 1).cast("int")))
    from_index = F.floor((start_idx * 1000) / sampling_rate).cast("long").try_cast("int")
    return F.when(time_idx >= 0, from_time).otherwise(from_index)


def split_time(df: DataFrame, samples: str = "samples", num_channels: str = "num_channels", time_idx: str = "time_idx") -> DataFrame:
    """``time`` = the time channel's values, ``signal`` = the other
    channels (sample-major).  Without a time channel (idx −1) nothing is split
    off: ``time`` is empty and ``signal`` is the whole block."""
    C, t = F.col(num_channels), F.col(time_idx)
    return df.withColumn("time", F.filter(F.col(samples), lambda v, i: F.pmod(i, C) == t)).withColumn(
        "signal", F.filter(F.col(samples), lambda v, i: F.pmod(i, C) != t)
    )


def sliding_window_starts(ts: Column, size_s: int, slide_s: int) -> Column:
    """Starts of every ``size_s``/``slide_s`` event-time window containing
    ``ts`` (epoch-aligned, like ``window()``), as an array to explode when a
    per-window group must also carry ordered content."""
    us = F.unix_micros(ts.cast("timestamp"))
    slide, size = slide_s * 1_000_000, size_s * 1_000_000
    last = us - F.pmod(us, F.lit(slide))
    n = -(-size // slide)
    starts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: last - j * slide)
    keep = F.filter(starts, lambda s: (s <= us) & (us < s + size))
    return F.transform(keep, lambda s: F.timestamp_micros(s).cast("timestamp_ntz"))
