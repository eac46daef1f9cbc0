"""The driver may load __spark_entry__.py by path from another directory and
give it its own plain session: the UDF-backed queries must still run."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
E = importlib.util.module_from_spec(spec); sys.modules["__spark_entry__"] = E; spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("ROWS", E.queries()["frame_decode"](spark, "/root/testdata/sf0.001").count(), E.entry(spark).count())
"""


def test_entry_loads_from_another_directory():
    work = tempfile.mkdtemp(prefix="entry-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")],
        cwd=work, env=env, capture_output=True, text=True, timeout=600,
    )
    assert "ROWS 500 1960" in out.stdout, out.stderr[-2000:]


ALONE = r"""
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as E
print("KEYS", len(E.queries()), sorted(k for k in [*E.queries(), *E.oracle_sql()] if k == "pipeline" or k.startswith("op")))
"""


def test_entry_without_the_corpus_subpackage():
    import shutil

    from cadence.plans.catalog import QUERIES

    work = tempfile.mkdtemp(prefix="entry-alone-")
    shutil.copytree(os.path.join(ROOT, "cadence"), os.path.join(work, "cadence"), ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), work)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", ALONE, work], cwd=work, env=env, capture_output=True, text=True, timeout=300)
    assert f"KEYS {len(QUERIES)} []" in out.stdout, out.stdout + out.stderr[-2000:]


KEYED = r"""
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false").getOrCreate())
rows = lambda k: sorted(map(str, E.queries()[k](spark, "/root/testdata/sf0.001").collect()))
print("SAME", rows("block_windows") == rows("sample_windows"), rows("stream_chain") == rows("window_scores"))
print("LEDGER", len(rows("stream_ledger")))
"""


def test_keyed_state_in_a_plain_session():
    """The driver's session names no state store: the queries with state in
    blocks bring their own."""
    out = subprocess.run([sys.executable, "-c", KEYED, ROOT], cwd=tempfile.mkdtemp(prefix="entry-keyed-"), capture_output=True, text=True, timeout=900)
    assert "SAME True True" in out.stdout and "LEDGER 3" in out.stdout, out.stderr[-2000:]


AGAINST_SQL = r"""
import os, sys
sys.path.insert(0, sys.argv[1])
import duckdb
import __spark_entry__ as E
from pyspark.sql import SparkSession
from tools.oracle_check import fetched, rows_of, type_mismatches
sf = "/root/testdata/sf0.001"
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false").getOrCreate())
con = duckdb.connect()
for f in os.listdir(sf):
    con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{f}')")
for key in ("block_windows", "stream_chain", "stream_ledger"):
    got, sql = E.queries()[key](spark, sf), E.oracle_sql()[key]
    print(key, type_mismatches(got, con, sql) == {} and rows_of(fetched(got)) == rows_of(con.execute(sql).df()))
"""


def test_keyed_state_equals_its_sql_in_a_plain_session():
    """As the driver compares them: no state store is named, the rows are the SQL's."""
    out = subprocess.run([sys.executable, "-c", AGAINST_SQL, ROOT], cwd=tempfile.mkdtemp(prefix="entry-sql-"), capture_output=True, text=True, timeout=900)
    assert all(f"{key} True" in out.stdout for key in ("block_windows", "stream_chain", "stream_ledger")), out.stdout + out.stderr[-2000:]
