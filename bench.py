"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query runs to completion through the ``noop`` sink (every row computed,
nothing collected); a warm-up pass on the smallest tables starts the JVM code
paths and Python workers first."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sample_windows",     # flagship windower (W2)
    "window_scores",      # frames → windows → model → result rows
    "process_standard",   # D1 → D2 → D3 as one operator
    "processed_windows",  # frames → W2 → D4 (time channel kept)
    "stream_windows",     # W2 on a stream, watermarked blocks
    "spectrum",
    "interval_label",     # range join (J2)
    "stream_sliding",     # event-time stream, watermark, append
    "score_stream",       # decode → classify → event time
    "training_table",     # D6 → D5 → J2
    "channel_corr",       # A5
    "sliding_time",       # W1
]


def run(spark, fn, sf_dir):
    """Wall time of building the query (streams run to completion and
    bucket bounds are sampled while building) plus executing it fully."""
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cadence.session import get_spark
    from cadence.plans.catalog import QUERIES

    spark = get_spark(cpus, "cadence-bench", max(8, 2 * int(cpus) if cpus.isdigit() else 16))
    warm = "/root/testdata/sf0.001"
    errors = {}
    for k in HEADLINE:
        try:
            run(spark, QUERIES[k], warm)
        except Exception as e:  # noqa: BLE001 — reported below, the line is still printed
            errors[k] = f"warm-up: {str(e)[:200]}"
    times = {}
    for k in HEADLINE:
        try:
            times[k] = round(run(spark, QUERIES[k], sf_dir), 3)
        except Exception as e:  # noqa: BLE001
            times[k] = None
            errors[k] = str(e)[:200]
    try:
        n_windows = QUERIES["sample_windows"](spark, sf_dir).count()
    except Exception:  # noqa: BLE001
        n_windows = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    done = [v for v in times.values() if v is not None]
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(done), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "windows_per_sec": round(n_windows / times["sample_windows"], 1) if n_windows and times.get("sample_windows") else None,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
