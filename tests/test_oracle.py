"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the rows-only keys' invariants."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK
from tools.oracle_check import fetched, rows_of, type_mismatches

ORACLE = E.oracle_sql()
KEYS = sorted(E.queries())


def test_every_key_is_registered_with_entry_and_most_with_sql():
    assert len(KEYS) >= 60
    rows_only = {k for k in set(KEYS) - set(ORACLE) if not re.match(r"op\d+_|pipeline$", k)}
    assert rows_only <= {"corr_features", "kmeans_train", "model_roundtrip", "filter_attenuation"}
    assert set(ORACLE) <= set(KEYS)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_CHECK)
    assert type_mismatches(sdf, duck, ORACLE[key]) == {}
    got = fetched(sdf)
    want = duck.execute(ORACLE[key]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["sess_id", "time_in", "time_ms", "class"]


def test_corr_features_trace_equals_channels(spark):
    f = E.queries()["corr_features"](spark, SF_CHECK).toPandas()
    assert len(f) > 0
    # |corr| has a unit diagonal: eigenvalues sum to the channel count when none is negative
    assert ((f["trace"] - f["n_eig"]).abs() < 1e-6).mean() > 0.5
    assert all(len(x) == 32 for x in f["features"])
    assert all(list(x[:4]) == sorted(x[:4], reverse=True) for x in f["features"])


def test_kmeans_and_roundtrip(spark):
    k = E.queries()["kmeans_train"](spark, SF_CHECK).toPandas()
    assert set(k["cluster"]) <= {0, 1} and len(k) == 500
    r = E.queries()["model_roundtrip"](spark, SF_CHECK).toPandas()
    assert len(r) == 500 and bool(r["same"].all())


def test_filter_attenuation(spark):
    a = E.queries()["filter_attenuation"](spark, SF_CHECK).toPandas()
    mains = a[a["tone_hz"].isin([60.0, 120.0])]["ratio"]
    keep = a[a["tone_hz"].isin([11.0, 19.0, 35.0])]["ratio"]
    assert mains.max() < 0.05
    assert (keep - 1).abs().max() < 0.05
