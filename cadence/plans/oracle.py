"""DuckDB oracle SQL per registered key (views: the driver's tables).

These restate each query's meaning independently of the Spark recipe —
e.g. sample windows are sliced from the whole concatenated session signal
rather than rebuilt from exploded frame pieces."""

from __future__ import annotations

import numpy as np

from cadence.plans import bindings as B

ORACLE: dict[str, str] = {}


def sql(key: str):
    def deco(fn):
        ORACLE[key] = fn()
        return fn

    return deco


START = f"TIMESTAMP '{B.SESSION_START}'"


def checksum(arr: str, digits: int = 4) -> str:
    """SQL twin of ``functions.arrays.weighted_checksum``."""
    return f"list_sum(list_transform({arr}, lambda x, i: round(x::DOUBLE, {digits})::DECIMAL(22,{digits}) * i))::DOUBLE"

# Frames binding in SQL: 16 samples × 4 channels per embedding, channel 0
# replaced by the sample time in ms, one session per label.
FRAMES_CTE = f"""
fr0 AS (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_number, embedding
  FROM embeddings),
fr AS (
  SELECT 'patient-' || label::VARCHAR || '{B.SESSION_START}' AS session_id, label, frame_number,
         list_transform(embedding, lambda x, i: CASE WHEN (i - 1) % 4 = 0
              THEN ((frame_number * 16 + (i - 1) // 4) * 62.5)::FLOAT ELSE x END) AS samples
  FROM fr0)"""

# Closed-form windows: whole session signal, windows k = 0 … ceil((N−L)/S)−1.
FRAME_WINDOWS_CTE = FRAMES_CTE + """,
sess AS (
  SELECT session_id, count(*) * 16 AS n, flatten(list(samples ORDER BY frame_number)) AS sigv
  FROM fr GROUP BY session_id),
fw AS (
  SELECT session_id, k, k * 4 AS start_idx, (k * 4) // 16 AS frame_number,
         sigv[k * 16 + 1 : k * 16 + 64] AS win
  FROM (SELECT *, unnest(range(0, greatest(0, ceil((n - 16) / 4.0))::BIGINT)) AS k FROM sess))"""

HEADERS_CTE = f"""
hd AS (
  SELECT event_id, user_id, event_type, value, ts, date_trunc('day', ts) AS day_start,
         (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS ms
  FROM events),
hdr AS (
  SELECT event_id, value, 'user' || user_id::VARCHAR AS user_name,
         'user' || user_id::VARCHAR || strftime(day_start, '%Y-%m-%d %H:%M:%S') AS session_id,
         (ms // 1000)::INTEGER AS frame_number, ms::INTEGER AS time_stamp, day_start AS session_start,
         event_type AS ML_model, 'standard' AS preprocessing
  FROM hd)"""

SIG_CTE = """
sg AS (
  SELECT user_id, event_id, ts, value, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_idx
  FROM events)"""


@sql("sample_windows")
def _():
    return f"""WITH {FRAME_WINDOWS_CTE}
SELECT session_id, k, start_idx, frame_number::INTEGER AS frame_number,
       trunc(win[1])::INTEGER AS time_stamp, 16 AS num_samples, 4 AS num_channels,
       len(win)::INTEGER AS n_values,
       {checksum('win')} AS checksum
FROM fw"""


@sql("window_timestamp")
def _():
    return f"""WITH {SIG_CTE},
n AS (SELECT user_id, count(*) AS n FROM sg GROUP BY user_id)
SELECT user_id, k, k * 2 AS start_idx, ((k * 2 * 1000) // 8)::INTEGER AS time_stamp
FROM (SELECT *, unnest(range(0, greatest(0, ceil((n - 8) / 2.0))::BIGINT)) AS k FROM n)"""


@sql("rule_class")
def _():
    return f"""WITH {HEADERS_CTE}
SELECT event_id, time_stamp, CASE WHEN time_stamp % 10000 > 5000 THEN 1 ELSE 0 END AS class FROM hdr"""


@sql("event_time")
def _():
    return f"""WITH {HEADERS_CTE}
SELECT event_id, session_start, time_stamp, session_start + to_milliseconds(time_stamp) AS event_time FROM hdr"""


@sql("score_stream")
def _():
    return f"""WITH {HEADERS_CTE}
SELECT session_id AS sess_id, session_start + to_milliseconds(time_stamp) AS time_in, time_stamp AS time_ms,
       (CASE WHEN time_stamp % 10000 > 5000 THEN 1 ELSE 0 END)::INTEGER AS class
FROM hdr"""


@sql("window_scores")
def _():
    return f"""WITH {FRAME_WINDOWS_CTE}
SELECT session_id AS sess_id, {START} + to_milliseconds(trunc(win[1])::INTEGER) AS time_in,
       trunc(win[1])::INTEGER AS time_ms,
       CASE WHEN trunc(win[1])::INTEGER % 10000 > 5000 THEN 1 ELSE 0 END AS class
FROM fw"""


# ---- frames: codec / quarantine / source ------------------------------------
FRAME_JSON = f"""to_json(struct_pack(
    user_name := 'patient-' || label::VARCHAR,
    session_id := 'patient-' || label::VARCHAR || '{B.SESSION_START}',
    frame_number := frame_number::INTEGER, time_stamp := (frame_number * 1000)::INTEGER,
    year := 2024, month := 1, day := 1, hour := 0, minute := 0, second := 0, microsecond := 0,
    ML_model := 'default', preprocessing := 'standard', sampling_rate := 16,
    num_samples := 16, num_channels := 4, channel_names := ['Time', 'EEG a', 'EEG b', 'aux']))::VARCHAR"""

FRAME_REPORT = f"""SELECT session_id, 'patient-' || label::VARCHAR AS user_name, frame_number::INTEGER AS frame_number,
       (frame_number * 1000)::INTEGER AS time_stamp, 2024 AS year, 1 AS month, 1 AS day,
       'default' AS ML_model, 'standard' AS preprocessing, 16 AS sampling_rate, 16 AS num_samples, 4 AS num_channels,
       'Time,EEG a,EEG b,aux' AS channel_names, len(samples)::INTEGER AS n_values, {checksum('samples')} AS checksum
FROM fr"""


@sql("frame_decode")
def _():
    return f"WITH {FRAMES_CTE}\n{FRAME_REPORT}"


@sql("frame_source")
def _():
    return f"WITH {FRAMES_CTE}\n{FRAME_REPORT}"


@sql("frame_encode")
def _():
    return f"""WITH {FRAMES_CTE},
j AS (SELECT session_id, frame_number, {FRAME_JSON} AS header_json FROM fr)
SELECT session_id, frame_number::INTEGER AS frame_number, (4 + octet_length(encode(header_json)) + 256)::INTEGER AS n_bytes,
       octet_length(encode(header_json))::INTEGER AS header_len, header_json
FROM j"""


@sql("frame_quarantine")
def _():
    return f"""WITH {FRAMES_CTE},
j AS (SELECT label, frame_number, octet_length(encode({FRAME_JSON})) AS hl FROM fr)
SELECT fr0.vec_id, (4 + hl + 256 - CASE WHEN j.frame_number = 0 THEN 4 ELSE 0 END)::INTEGER AS n_bytes,
       CASE WHEN j.frame_number = 0 THEN 'payload_size' WHEN j.frame_number = 1 THEN 'bad_length' ELSE 'ok' END AS status
FROM j JOIN fr0 ON j.label = fr0.label AND j.frame_number = fr0.frame_number"""


# ---- frames: channels / time split / concat / fan-out ------------------------
@sql("time_channel")
def _():
    return f"WITH {FRAMES_CTE}\nSELECT session_id, frame_number::INTEGER AS frame_number, 0 AS time_idx FROM fr"


@sql("split_time")
def _():
    return f"""WITH {FRAMES_CTE},
p AS (SELECT session_id, frame_number, list_filter(samples, lambda x, i: (i - 1) % 4 = 0) AS t,
             list_filter(samples, lambda x, i: (i - 1) % 4 <> 0) AS s FROM fr)
SELECT session_id, frame_number::INTEGER AS frame_number, 0 AS time_idx, len(t)::INTEGER AS n_time, len(s)::INTEGER AS n_signal,
       {checksum('t')} AS time_checksum, {checksum('s')} AS signal_checksum
FROM p"""


@sql("channel_subset")
def _():
    return f"""WITH {FRAMES_CTE},
p AS (SELECT session_id, frame_number, list_filter(samples, lambda x, i: (i - 1) % 4 IN (1, 2)) AS s FROM fr)
SELECT session_id, frame_number::INTEGER AS frame_number, 2 AS n_channels_kept, len(s)::INTEGER AS n_values, {checksum('s')} AS checksum
FROM p"""


@sql("block_concat")
def _():
    return f"""WITH {FRAMES_CTE},
x AS (SELECT *, unnest([frame_number - 1, frame_number]) AS w FROM fr),
g AS (SELECT session_id, w, count(*) AS n_frames, flatten(list(samples ORDER BY frame_number)) AS s FROM x GROUP BY session_id, w)
SELECT session_id, {START} + to_seconds(w) AS window_start, n_frames, len(s)::INTEGER AS n_values, {checksum('s')} AS checksum
FROM g"""


@sql("fanout")
def _():
    return f"""WITH {FRAMES_CTE},
n AS (SELECT session_id, count(*) AS n_frames FROM fr GROUP BY session_id)
SELECT session_id, n_frames, greatest(0, ceil((n_frames * 16 - 16) / 4.0))::BIGINT AS n_windows,
       round(greatest(0, ceil((n_frames * 16 - 16) / 4.0)) / n_frames, 6) AS windows_per_frame
FROM n"""


RECORDINGS_LONG = """
rl AS (
  SELECT vec_id // 4 AS recording_id, (vec_id % 4)::INTEGER AS channel,
         unnest(embedding)::DOUBLE AS value, unnest(range(len(embedding))) AS sample_idx
  FROM embeddings)"""


@sql("relayout")
def _():
    return f"""WITH {RECORDINGS_LONG},
g AS (SELECT recording_id, sample_idx, list(value ORDER BY channel) AS v FROM rl GROUP BY recording_id, sample_idx)
SELECT recording_id, sample_idx, len(v)::INTEGER AS n_channels, {checksum('v')} AS checksum FROM g"""


# ---- headers ---------------------------------------------------------------------
HEADER_JSON = """to_json(struct_pack(
    user_name := user_name, session_id := session_id, frame_number := frame_number, time_stamp := time_stamp,
    year := year(session_start)::INTEGER, month := month(session_start)::INTEGER, day := day(session_start)::INTEGER,
    hour := hour(session_start)::INTEGER, minute := minute(session_start)::INTEGER, second := second(session_start)::INTEGER,
    microsecond := 0, ML_model := ML_model, preprocessing := 'standard', sampling_rate := 250,
    num_samples := 1, num_channels := 2, channel_names := ['time', 'value']))::VARCHAR"""


@sql("header_build")
def _():
    return f"""WITH {HEADERS_CTE}
SELECT event_id, user_name, session_id, frame_number, time_stamp,
       year(session_start)::INTEGER AS year, month(session_start)::INTEGER AS month, day(session_start)::INTEGER AS day,
       hour(session_start)::INTEGER AS hour, minute(session_start)::INTEGER AS minute,
       second(session_start)::INTEGER AS second, 0 AS microsecond, ML_model, 'standard' AS preprocessing,
       250 AS sampling_rate, 1 AS num_samples, 2 AS num_channels, 'time,value' AS channel_names
FROM hdr"""


@sql("header_json")
def _():
    return f"""WITH {HEADERS_CTE},
j AS (SELECT event_id, {HEADER_JSON} AS header_json FROM hdr)
SELECT j.event_id, header_json, length(header_json)::INTEGER AS json_len, true AS roundtrip_ok,
       json_extract(e.props, '$.k')::INTEGER AS props_k
FROM j JOIN events e ON e.event_id = j.event_id"""


@sql("route_by_model")
def _():
    return "SELECT 'ml.' || event_type AS route, count(*) AS n_messages FROM events GROUP BY 1"


@sql("dispatch_model")
def _():
    return f"""WITH {HEADERS_CTE}
SELECT event_id, ML_model AS ml_model,
       (CASE WHEN ML_model IN ('default', 'view', 'click') THEN (CASE WHEN time_stamp % 10000 > 5000 THEN 1 ELSE 0 END)
             WHEN ML_model = 'purchase' THEN (CASE WHEN time_stamp % 60000 > 30000 THEN 1 ELSE 0 END) END)::INTEGER AS class
FROM hdr WHERE ML_model IN ('default', 'view', 'click', 'purchase')"""


SCORED = f"""{HEADERS_CTE},
sc AS (
  SELECT hdr.*, session_id AS sess_id, session_start + to_milliseconds(time_stamp) AS time_in, time_stamp AS time_ms,
         (CASE WHEN time_stamp % 10000 > 5000 THEN 1 ELSE 0 END)::INTEGER AS class, hd.user_id, hd.ts
  FROM hdr JOIN hd USING (event_id))"""


@sql("result_append")
def _():
    return f"WITH {SCORED}\nSELECT sess_id, time_in, time_ms, class FROM sc"


@sql("new_sessions")
def _():
    return f"""WITH {SCORED},
stored AS (SELECT DISTINCT sess_id FROM sc WHERE ts < TIMESTAMP '{B.STORED_BEFORE}')
SELECT DISTINCT sess_id FROM sc WHERE sess_id NOT IN (SELECT sess_id FROM stored)"""


@sql("register_sessions")
def _():
    return f"""WITH {SCORED}
SELECT sess_id, arg_min(user_name, (frame_number, time_ms)) AS user_name,
       arg_min(ML_model, (frame_number, time_ms)) AS ml_model,
       arg_min(preprocessing, (frame_number, time_ms)) AS preprocessing
FROM sc WHERE sess_id NOT IN (SELECT sess_id FROM sc WHERE ts < TIMESTAMP '{B.STORED_BEFORE}') GROUP BY sess_id"""


@sql("fk_check")
def _():
    return f"""WITH {SCORED}
SELECT sess_id, time_in, time_ms, class FROM sc
WHERE sess_id NOT IN (SELECT sess_id FROM sc WHERE ts < TIMESTAMP '{B.STORED_BEFORE}')"""


# ---- windows64 / sig signal transforms -------------------------------------------
def response(fs: float, kind: str, n: int) -> np.ndarray:
    """First ``n`` samples of a chain's impulse response, from its frequency
    response: the order-5 Butterworth low-pass 1 / Π(q − p) at the analogue
    variable q of each stage (bilinear, pre-warped), transformed back over more
    samples than the chain remembers.  Shares nothing with the library's design."""
    size = 1 << 16
    w = np.exp(-2j * np.pi * np.arange(size // 2 + 1) / size)
    minus, plus = 1 - w, 1 + w  # s = minus / plus
    poles = [np.exp(1j * np.pi * (2 * k + 6) / 10) for k in range(5)]
    warp = lambda f: np.tan(np.pi * f / fs)
    h = np.ones(len(w), complex)
    if kind != "highpass":
        f = 60.0
        while f + 1 < fs / 2:
            lo, hi = warp(f - 1), warp(f + 1)
            den = minus**2 + lo * hi * plus**2
            for p in poles:
                h *= den / ((hi - lo) * minus * plus - p * den)
            f += 60.0
    if kind != "bandstop":
        for p in poles:
            h *= minus / (warp(1.0) * plus - p * minus)
    return np.fft.irfft(h, size)[:n]


def h_values(fs: float, kind: str, n: int) -> str:
    """Impulse response as a VALUES table h(j, hv)."""
    h = response(float(fs), kind, n)
    return "h(j, hv) AS (VALUES " + ", ".join(f"({j}, {repr(float(v))}::DOUBLE)" for j, v in enumerate(h)) + ")"


W64_X = """
x AS (SELECT vec_id AS window_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS m FROM embeddings)"""


def _conv64(kind: str, src: str = "x") -> str:
    return f"""{h_values(B.W64_FS, kind, 64)},
y AS (SELECT {src}.window_id, {src}.m + h.j AS m, sum(h.hv * {src}.v) AS v FROM {src}, h WHERE {src}.m + h.j < 64 GROUP BY 1, 2)"""


def _dft(src: str, n: int = 64) -> str:
    return f"""kk AS (SELECT unnest(range({n})) AS k),
d AS (SELECT {src}.window_id, kk.k,
             sum({src}.v * cos(2 * pi() * (({src}.m * kk.k) % {n}) / {n})) AS re,
             sum({src}.v * sin(2 * pi() * (({src}.m * kk.k) % {n}) / {n})) AS im
      FROM {src}, kk GROUP BY 1, 2)"""


@sql("bandstop")
def _():
    return f"WITH {W64_X},\n{_conv64('bandstop')}\nSELECT window_id, m::INTEGER AS n, round(v, 6) + 0.0 AS value FROM y"


@sql("highpass")
def _():
    return f"WITH {W64_X},\n{_conv64('highpass')}\nSELECT window_id, m::INTEGER AS n, round(v, 6) + 0.0 AS value FROM y"


@sql("spectrum")
def _():
    return f"WITH {W64_X},\n{_dft('x')}\nSELECT window_id, k::INTEGER AS n, round(sqrt(re * re + im * im), 6) + 0.0 AS value FROM d"


@sql("process_standard")
def _():
    return f"WITH {W64_X},\n{_conv64('standard')},\n{_dft('y')}\nSELECT window_id, k::INTEGER AS n, round(sqrt(re * re + im * im), 6) + 0.0 AS value FROM d"


@sql("dispatch_processing")
def _():
    return f"""WITH {W64_X},
{_conv64('standard')},
{_dft('y')},
kk2 AS (SELECT unnest(range(64)) AS k),
ds AS (SELECT x.window_id, kk2.k, sum(x.v * cos(2 * pi() * ((x.m * kk2.k) % 64) / 64)) AS re,
              sum(x.v * sin(2 * pi() * ((x.m * kk2.k) % 64) / 64)) AS im FROM x, kk2 GROUP BY 1, 2),
lab AS (SELECT vec_id AS window_id, label FROM embeddings)
SELECT d.window_id, 'standard' AS preprocessing, k::INTEGER AS n, round(sqrt(re * re + im * im), 6) + 0.0 AS value
FROM d JOIN lab USING (window_id) WHERE label < 5
UNION ALL
SELECT ds.window_id, 'spectrum' AS preprocessing, k::INTEGER AS n, round(sqrt(re * re + im * im), 6) + 0.0 AS value
FROM ds JOIN lab USING (window_id) WHERE label >= 5"""


@sql("sample_time")
def _():
    return f"WITH {SIG_CTE}\nSELECT user_id, sample_idx, sample_idx / 8.0::DOUBLE AS t FROM sg"


SIG_WINDOWS = f"""{SIG_CTE},
nw AS (SELECT user_id, count(*) AS n FROM sg GROUP BY user_id),
sw AS (SELECT user_id, unnest(range(0, greatest(0, ceil((n - 8) / 2.0))::BIGINT)) AS k FROM nw)"""


@sql("freq_axis")
def _():
    return f"""WITH {SIG_WINDOWS},
b AS (SELECT user_id, k, unnest(range(8)) AS bin FROM sw)
SELECT user_id, k, bin::INTEGER AS bin, (CASE WHEN bin < 4 THEN bin ELSE bin - 8 END)::DOUBLE * 8.0 / 8.0 AS freq FROM b"""


@sql("window_udf")
def _():
    return f"""WITH {SIG_WINDOWS}
SELECT sw.user_id, sw.k, count(*) AS n, round(avg(sg.value::FLOAT::DOUBLE), 6) AS mean, max(sg.value::FLOAT::DOUBLE) AS max
FROM sw JOIN sg ON sg.user_id = sw.user_id AND sg.sample_idx >= sw.k * 2 AND sg.sample_idx < sw.k * 2 + 8
GROUP BY sw.user_id, sw.k"""


@sql("filter_recording")
def _():
    return f"""WITH {SIG_CTE},
{h_values(B.SIG_FS, 'filters', 512)}
SELECT a.user_id, a.sample_idx, round(sum(h.hv * b.value), 6) + 0.0 AS filtered
FROM sg a JOIN sg b ON a.user_id = b.user_id AND b.sample_idx <= a.sample_idx
JOIN h ON h.j = a.sample_idx - b.sample_idx
GROUP BY a.user_id, a.sample_idx"""


@sql("filter_states")
def _():
    return f"""WITH p AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i0, embedding FROM embeddings),
x AS (SELECT label, i0 * 64 + unnest(range(64)) AS n, unnest(embedding)::DOUBLE AS v FROM p),
{h_values(B.W64_FS, 'filters', 5300)}
SELECT a.label, a.n AS sample_idx, round(sum(h.hv * b.v), 6) + 0.0 AS filtered
FROM x a JOIN x b ON a.label = b.label AND b.n <= a.n
JOIN h ON h.j = a.n - b.n
GROUP BY a.label, a.n"""


SIG_SEGMENTS = f"""{SIG_CTE},
ps AS (SELECT user_id, count(*) AS n,
              [0.0::DOUBLE, 0.0, 0.0, 0.0] || list(value::DOUBLE ORDER BY sample_idx) || [0.0::DOUBLE, 0.0, 0.0, 0.0] AS padded
       FROM sg GROUP BY user_id),
seg AS (SELECT user_id, k AS seg, padded[2 * k + 1 : 2 * k + 8] AS s
        FROM (SELECT *, unnest(range(0, (n + 8 - 6) // 2)) AS k FROM ps))"""


@sql("stft_segments")
def _():
    return f"WITH {SIG_SEGMENTS}\nSELECT user_id, seg, len(s)::INTEGER AS n_values, {checksum('s')} AS checksum FROM seg"


@sql("stft")
def _():
    return f"""WITH {SIG_SEGMENTS},
sv AS (SELECT user_id, seg, unnest(s) AS v, unnest(range(8)) AS p FROM seg),
bins AS (SELECT unnest(range(5)) AS b)
SELECT user_id, seg, b::INTEGER AS bin, seg * 0.25::DOUBLE AS t, b * 1.0::DOUBLE AS freq,
       round(sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 8)) * cos(2 * pi() * ((b * p) % 8) / 8)) / 4.0, 6) + 0.0 AS re,
       round(-sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 8)) * sin(2 * pi() * ((b * p) % 8) / 8)) / 4.0, 6) + 0.0 AS im
FROM sv, bins GROUP BY user_id, seg, b"""


# ---- time windows and streams -----------------------------------------------------
SLIDING = """
sl AS (
  SELECT user_id, ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, count(*) AS n_events,
         sum(value::DECIMAL(18,2))::DOUBLE AS sum_value
  FROM (SELECT *, unnest([time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR, time_bucket(INTERVAL 1 HOUR, ts)]) AS ws FROM events)
  GROUP BY user_id, ws)"""


@sql("sliding_time")
def _():
    return f"WITH {SLIDING}\nSELECT * FROM sl"


@sql("global_sliding")
def _():
    return """SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, count(*) AS n_events,
       sum(value::DECIMAL(18,2))::DOUBLE AS sum_value,
       arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM (SELECT *, unnest([time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR, time_bucket(INTERVAL 1 HOUR, ts)]) AS ws FROM events)
GROUP BY ws"""


@sql("stream_sliding")
def _():
    return f"WITH {SLIDING}\nSELECT * FROM sl WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@sql("late_split")
def _():
    return """WITH e AS (SELECT event_id, ts, (CASE WHEN event_type IN ('signup', 'purchase') THEN 0 WHEN event_type = 'error' THEN 1 WHEN event_type IN ('view', 'click') THEN 2 END)::INTEGER AS arrival_batch FROM events),
m AS (SELECT arrival_batch, max(ts) AS mx FROM e GROUP BY 1),
w AS (SELECT arrival_batch, max(mx) OVER (ORDER BY arrival_batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS wm FROM m)
SELECT event_id, arrival_batch, coalesce(ts < wm, false) AS is_late FROM e JOIN w USING (arrival_batch)"""


@sql("stream_dedup")
def _():
    return "SELECT event_id, user_id, ts, value FROM events"


@sql("ttl_filter")
def _():
    return "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"


# Same closed windows, same SQL.
ORACLE["stateful_windows"] = ORACLE["sample_windows"]
ORACLE["block_windows"] = ORACLE["sample_windows"]
ORACLE["stream_chain"] = ORACLE["window_scores"]


@sql("stream_ledger")
def _():
    return f"""WITH {FRAME_WINDOWS_CTE},
n AS (SELECT count(*) AS windows, (SELECT count(*) FROM embeddings) AS frames FROM fw)
SELECT 'windower' AS hop, frames AS rows_in, windows AS rows_out FROM n
UNION ALL SELECT 'processor', windows, windows FROM n
UNION ALL SELECT 'scorer', windows, windows FROM n"""


# ---- annotations and labels -----------------------------------------------------------
SECS = f"(epoch_us(ts) - epoch_us({START}))::DOUBLE / 1000000.0::DOUBLE"
ANN = f"""
ann AS (
  SELECT user_id AS recording_id, event_id AS line_no, {SECS} AS beg, {SECS} + 21600.0::DOUBLE AS "end",
         CASE WHEN event_type = 'error' THEN 'fnsz' ELSE 'bckg' END AS label,
         CASE WHEN event_type = 'error' THEN 8 ELSE 6 END AS code
  FROM events WHERE event_type IN ('error', 'purchase'))"""


@sql("label_code")
def _():
    return f"WITH {ANN}\nSELECT line_no, label, code FROM ann"


@sql("class_counts")
def _():
    return f"""WITH {ANN}
SELECT recording_id, count(*) FILTER (WHERE code = 6) AS n_background, count(*) FILTER (WHERE code <> 6) AS n_seizure
FROM ann GROUP BY recording_id"""


@sql("interval_label")
def _():
    return f"""WITH {ANN},
tp AS (SELECT user_id AS recording_id, event_id, {SECS} AS t FROM events)
SELECT tp.recording_id, tp.event_id, tp.t, coalesce(arg_max(ann.code, ann.line_no), 0)::INTEGER AS code
FROM tp LEFT JOIN ann ON ann.recording_id = tp.recording_id AND ann.beg <= tp.t AND tp.t <= ann."end"
GROUP BY tp.recording_id, tp.event_id, tp.t"""


@sql("annotation_scan")
def _():
    return f"WITH {ANN}\nSELECT recording_id, round(beg, 6) + 0.0 AS beg, round(\"end\", 6) + 0.0 AS \"end\", label FROM ann"


SIG_FILTERED_SEGMENTS = f"""{SIG_CTE},
{h_values(B.SIG_FS, 'filters', 512)},
fl AS (SELECT a.user_id, a.sample_idx, sum(h.hv * b.value) AS value
       FROM sg a JOIN sg b ON a.user_id = b.user_id AND b.sample_idx <= a.sample_idx
       JOIN h ON h.j = a.sample_idx - b.sample_idx GROUP BY a.user_id, a.sample_idx),
ps AS (SELECT user_id, count(*) AS n,
              [0.0::DOUBLE, 0.0, 0.0, 0.0] || list(value::DOUBLE ORDER BY sample_idx) || [0.0::DOUBLE, 0.0, 0.0, 0.0] AS padded
       FROM fl GROUP BY user_id),
seg AS (SELECT user_id, k AS seg, padded[2 * k + 1 : 2 * k + 8] AS s
        FROM (SELECT *, unnest(range(0, (n + 8 - 6) // 2)) AS k FROM ps)),
sv AS (SELECT user_id, seg, unnest(s) AS v, unnest(range(8)) AS p FROM seg),
bins AS (SELECT unnest(range(5)) AS b),
z AS (SELECT user_id, seg, b AS bin,
             sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 8)) * cos(2 * pi() * ((b * p) % 8) / 8)) / 4.0 AS re,
             -sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 8)) * sin(2 * pi() * ((b * p) % 8) / 8)) / 4.0 AS im
      FROM sv, bins GROUP BY 1, 2, 3)"""


@sql("training_table")
def _():
    return f"""WITH {SIG_FILTERED_SEGMENTS},
tann AS (SELECT user_id AS recording_id, event_id AS line_no, sample_idx / 8.0::DOUBLE AS beg,
                sample_idx / 8.0::DOUBLE + 2.0::DOUBLE AS "end", CASE WHEN event_type = 'error' THEN 8 ELSE 6 END AS code
         FROM sg WHERE event_type IN ('error', 'purchase')),
fr AS (SELECT DISTINCT user_id, seg, seg * 0.25::DOUBLE AS t FROM z),
lab AS (SELECT fr.user_id, fr.seg, coalesce(arg_max(tann.code, tann.line_no), 0)::INTEGER AS code
        FROM fr LEFT JOIN tann ON tann.recording_id = fr.user_id AND tann.beg <= fr.t AND fr.t <= tann."end"
        GROUP BY fr.user_id, fr.seg)
SELECT z.user_id AS recording_id, z.seg, z.bin::INTEGER AS bin, z.seg * 0.25::DOUBLE AS t, z.bin * 1.0::DOUBLE AS freq,
       round(sqrt(re * re + im * im), 6) + 0.0 AS magnitude, lab.code
FROM z JOIN lab USING (user_id, seg)"""


# ---- recordings ---------------------------------------------------------------------------
@sql("channel_catalog")
def _():
    return """SELECT vec_id // 4 AS recording_id, count(DISTINCT vec_id % 4)::INTEGER AS n_channels,
       string_agg(DISTINCT 'EEG C' || (vec_id % 4)::VARCHAR || '-REF', ',' ORDER BY 'EEG C' || (vec_id % 4)::VARCHAR || '-REF') AS channels
FROM embeddings GROUP BY 1"""


REC_STFT = f"""{RECORDINGS_LONG},
rp AS (SELECT recording_id, channel, count(*) AS n,
              [0.0::DOUBLE, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0] || list(value ORDER BY sample_idx)
              || [0.0::DOUBLE, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0] AS padded
       FROM rl GROUP BY 1, 2),
rs AS (SELECT recording_id, channel, k AS seg, padded[4 * k + 1 : 4 * k + 16] AS s
       FROM (SELECT *, unnest(range(0, (n + 16 - 12) // 4)) AS k FROM rp)),
rv AS (SELECT recording_id, channel, seg, unnest(s) AS v, unnest(range(16)) AS p FROM rs),
rb AS (SELECT unnest(range(9)) AS b),
rz AS (SELECT recording_id, channel, seg, b AS bin,
              sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 16)) * cos(2 * pi() * ((b * p) % 16) / 16)) / 8.0 AS re,
              -sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 16)) * sin(2 * pi() * ((b * p) % 16) / 16)) / 8.0 AS im
       FROM rv, rb GROUP BY 1, 2, 3, 4)"""


CORR_PAIRS = f"""{REC_STFT},
mu AS (SELECT recording_id, seg, channel, avg(re) AS mr, avg(im) AS mi FROM rz GROUP BY 1, 2, 3),
zc AS (SELECT rz.recording_id, rz.seg, rz.channel, rz.bin, re - mr AS cr, im - mi AS ci
       FROM rz JOIN mu USING (recording_id, seg, channel)),
pr AS (SELECT a.recording_id, a.seg, a.channel AS ch_a, b.channel AS ch_b,
              sum(a.cr * b.cr + a.ci * b.ci) AS vr, sum(a.ci * b.cr - a.cr * b.ci) AS vi
       FROM zc a JOIN zc b ON a.recording_id = b.recording_id AND a.seg = b.seg AND a.bin = b.bin
       GROUP BY 1, 2, 3, 4),
dg AS (SELECT recording_id, seg, ch_a AS ch, vr AS var FROM pr WHERE ch_a = ch_b)"""


@sql("channel_corr")
def _():
    return f"""WITH {CORR_PAIRS}
SELECT pr.recording_id, pr.seg, pr.ch_a, pr.ch_b, round(sqrt(vr * vr + vi * vi) / sqrt(da.var * db.var), 6) + 0.0 AS corr
FROM pr JOIN dg da ON da.recording_id = pr.recording_id AND da.seg = pr.seg AND da.ch = pr.ch_a
        JOIN dg db ON db.recording_id = pr.recording_id AND db.seg = pr.seg AND db.ch = pr.ch_b"""


@sql("corr_norms")
def _():
    # traces of even powers of the |correlation| matrix R: products of R with
    # itself, then sums of elementwise products
    return f"""WITH {CORR_PAIRS},
r AS (SELECT pr.recording_id, pr.seg, pr.ch_a AS i, pr.ch_b AS j, sqrt(vr * vr + vi * vi) / sqrt(da.var * db.var) AS x
      FROM pr JOIN dg da ON da.recording_id = pr.recording_id AND da.seg = pr.seg AND da.ch = pr.ch_a
              JOIN dg db ON db.recording_id = pr.recording_id AND db.seg = pr.seg AND db.ch = pr.ch_b),
r2 AS (SELECT a.recording_id, a.seg, a.i, b.j, sum(a.x * b.x) AS x
       FROM r a JOIN r b ON a.recording_id = b.recording_id AND a.seg = b.seg AND a.j = b.i GROUP BY 1, 2, 3, 4),
r4 AS (SELECT a.recording_id, a.seg, a.i, b.j, sum(a.x * b.x) AS x
       FROM r2 a JOIN r2 b ON a.recording_id = b.recording_id AND a.seg = b.seg AND a.j = b.i GROUP BY 1, 2, 3, 4)
SELECT recording_id, seg, sqrt(count(*))::INTEGER AS n_eig, 32 AS width,
       round(sum(r.x * r.x) ** (1.0::DOUBLE / 2), 6) + 0.0 AS norm2, round(sum(r2.x * r2.x) ** (1.0::DOUBLE / 4), 6) + 0.0 AS norm4,
       round(sum(r2.x * r4.x) ** (1.0::DOUBLE / 6), 6) + 0.0 AS norm6, round(sum(r4.x * r4.x) ** (1.0::DOUBLE / 8), 6) + 0.0 AS norm8
FROM r JOIN r2 USING (recording_id, seg, i, j) JOIN r4 USING (recording_id, seg, i, j) GROUP BY recording_id, seg"""


@sql("tile_store")
def _():
    return f"""WITH {REC_STFT}
SELECT recording_id, channel, seg, bin::INTEGER AS bin, seg * 0.25::DOUBLE AS t, bin * 1.0::DOUBLE AS freq,
       round(re, 6) + 0.0 AS re, round(im, 6) + 0.0 AS im
FROM rz"""


@sql("pad_truncate")
def _():
    return """SELECT vec_id // 4 AS recording_id, (vec_id % 4)::INTEGER AS channel, unnest(range(32))::INTEGER AS pos,
       unnest((list_filter(embedding, lambda x: x > 0)::DOUBLE[] || list_transform(range(32), lambda i: 0.0::DOUBLE))[1:32]) AS value
FROM embeddings"""


# ---- vectors -------------------------------------------------------------------------------
KM = """
v AS (SELECT vec_id, embedding AS e FROM embeddings),
c AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::INTEGER AS cluster, embedding AS ce FROM embeddings ORDER BY vec_id LIMIT 2),
d AS (SELECT v.vec_id, v.e, c.cluster,
             list_sum(list_transform(range(len(v.e)), lambda i: (v.e[i + 1]::DOUBLE - c.ce[i + 1]::DOUBLE) ** 2)) AS dist FROM v, c),
a AS (SELECT vec_id, arg_min(cluster, (dist, cluster)) AS cluster, min(dist) AS dist, any_value(e) AS e FROM d GROUP BY vec_id)"""


@sql("assign_cluster")
def _():
    return f"WITH {KM}\nSELECT vec_id, cluster, round(dist, 6) + 0.0 AS dist FROM a"


@sql("minibatch_update")
def _():
    return f"""WITH {KM},
u AS (SELECT cluster, unnest(e)::DOUBLE AS x, unnest(range(len(e)))::INTEGER AS dim FROM a),
n AS (SELECT cluster, count(*) AS n FROM a GROUP BY cluster)
SELECT u.cluster, n.n, u.dim, round(avg(x), 6) + 0.0 AS value FROM u JOIN n USING (cluster) GROUP BY u.cluster, n.n, u.dim"""


@sql("kmeans_checks")
def _():
    return "SELECT vec_id, true AS nearest, true AS same FROM embeddings"


# ---- paths -----------------------------------------------------------------------------------
PATHS = """
pth AS (
  SELECT 'corpus/' || lang || '/' || source || '/rec_' || doc_id::VARCHAR AS base, doc_id,
         doc_id IN (SELECT doc_id FROM labels) AS labelled
  FROM documents),
files AS (
  SELECT base || '.edf' AS path, 'edf' AS kind, base FROM pth
  UNION ALL SELECT base || '.tse', 'tse', base FROM pth WHERE labelled
  UNION ALL SELECT base || '.tse_bi', 'tse_bi', base FROM pth WHERE labelled)"""


@sql("list_inputs")
def _():
    return f"WITH {PATHS}\nSELECT path, kind FROM files WHERE kind <> 'tse_bi'"


@sql("pair_inputs")
def _():
    return f"""WITH {PATHS}
SELECT e.base AS stem, e.path AS edf_path, t.path AS tse_path
FROM files e JOIN files t ON e.base = t.base AND e.kind = 'edf' AND t.kind = 'tse'"""


@sql("skip_inputs")
def _():
    return f"WITH {PATHS}\nSELECT path FROM (SELECT path FROM files WHERE kind = 'edf' ORDER BY path OFFSET 100)"


@sql("processed_windows")
def _():
    return f"""WITH {FRAME_WINDOWS_CTE},
wv AS (SELECT session_id, k, unnest(win)::DOUBLE AS v, unnest(range(64)) AS j FROM fw),
cv AS (SELECT session_id, k, j // 4 AS m, (j % 4)::INTEGER AS channel, v FROM wv),
{h_values(B.FRAMES_FS, 'standard', 16)},
y AS (SELECT cv.session_id, cv.k, cv.channel, cv.m + h.j AS m, sum(h.hv * cv.v) AS v
      FROM cv, h WHERE cv.channel <> 0 AND cv.m + h.j < 16 GROUP BY 1, 2, 3, 4),
kk AS (SELECT unnest(range(16)) AS b),
d AS (SELECT y.session_id, y.k, y.channel, kk.b,
             sum(y.v * cos(2 * pi() * ((y.m * kk.b) % 16) / 16)) AS re,
             sum(y.v * sin(2 * pi() * ((y.m * kk.b) % 16) / 16)) AS im
      FROM y, kk GROUP BY 1, 2, 3, 4)
SELECT session_id, k, channel, b::INTEGER AS bin, round(sqrt(re * re + im * im), 6) + 0.0 AS value FROM d
UNION ALL
SELECT session_id, k, 0 AS channel, m::INTEGER AS bin, round(v, 6) + 0.0 AS value FROM cv WHERE channel = 0"""


@sql("late_side_table")
def _():
    return """WITH e AS (SELECT event_id, ts, (CASE WHEN event_type IN ('signup', 'purchase') THEN 0 WHEN event_type = 'error' THEN 1 WHEN event_type IN ('view', 'click') THEN 2 END)::INTEGER AS arrival_batch FROM events),
m AS (SELECT arrival_batch, max(ts) AS mx FROM e GROUP BY 1),
w AS (SELECT arrival_batch, max(mx) OVER (ORDER BY arrival_batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS wm FROM m)
SELECT event_id, arrival_batch AS batch_id FROM e JOIN w USING (arrival_batch) WHERE ts < wm"""


@sql("stream_windows")
def _():
    # streams host windows in blocks of one window length (L = 16 samples):
    # block b = k·S div 16 = k div 4; its end (needed range b·16 + 32 samples
    # at 16 Hz) is b + 2 s after the session start; the watermark is the
    # largest block end seen (last frame's block, (n − 1) div 16) − 5 s
    return f"""WITH {FRAME_WINDOWS_CTE},
mx AS (SELECT max((n - 1) // 16 + 2) AS m FROM sess)
SELECT session_id, k, start_idx, frame_number::INTEGER AS frame_number,
       trunc(win[1])::INTEGER AS time_stamp, 16 AS num_samples, 4 AS num_channels,
       len(win)::INTEGER AS n_values, {checksum('win')} AS checksum
FROM fw WHERE k // 4 + 2 <= (SELECT m FROM mx) - 5"""


@sql("stream_window_scores")
def _():
    return f"""WITH {FRAME_WINDOWS_CTE},
mx AS (SELECT max((n - 1) // 16 + 2) AS m FROM sess)
SELECT session_id AS sess_id, {START} + to_milliseconds(trunc(win[1])::INTEGER) AS time_in,
       trunc(win[1])::INTEGER AS time_ms,
       CASE WHEN trunc(win[1])::INTEGER % 10000 > 5000 THEN 1 ELSE 0 END AS class
FROM fw WHERE k // 4 + 2 <= (SELECT m FROM mx) - 5"""
