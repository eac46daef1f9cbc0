"""Shuffle volume of registered queries, from Spark's event log.

    python tools/shuffle_report.py [--sf /root/testdata/sf0.1] key [key ...]

Runs each query (through the ``noop`` sink) in a session whose event log is
written to a fresh scratch folder, then sums shuffle bytes / records written
per query.  Used to check the shuffle-volume claims in the README."""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder: str):
    import zstandard

    for f in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def measure(key: str, sf: str) -> dict:
    """Run one query in its own session (own event log) and sum the shuffle
    writes of the SQL execution of its final ``noop`` write only (work done
    while building the query — staging, bucket statistics — is excluded)."""
    from pyspark.sql import SparkSession

    log_dir = tempfile.mkdtemp(prefix="cadence-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from cadence.plans.catalog import QUERIES

    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    events = list(read_events(log_dir))
    last_exec = max(e["executionId"] for e in events if e.get("Event", "").endswith("SparkListenerSQLExecutionStart"))
    stages = set()
    for e in events:
        if e.get("Event") == "SparkListenerJobStart" and str(e.get("Properties", {}).get("spark.sql.execution.id")) == str(last_exec):
            stages.update(e["Stage IDs"])
    b = r = 0
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and e.get("Stage ID") in stages:
            w = e.get("Task Metrics", {}).get("Shuffle Write Metrics", {})
            b += w.get("Shuffle Bytes Written", 0)
            r += w.get("Shuffle Records Written", 0)
    return {"query": key, "shuffle_bytes": b, "shuffle_records": r}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="+")
    a = ap.parse_args()
    for k in a.keys:
        print(json.dumps(measure(k, a.sf)), flush=True)


if __name__ == "__main__":
    main()
