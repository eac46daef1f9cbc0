"""Scatter sparse (position, value) pairs into dense arrays, one numpy
assignment per Arrow batch.  (A Spark map lookup is a linear scan, so
densifying a block through ``element_at(map, p)`` would be quadratic.)"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf


def _dense(xs: pa.Array, base: pa.Array, width: pa.Array) -> pa.Array:
    n = len(xs)
    offs = np.asarray(xs.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
    o0 = offs[0]
    p = np.asarray(xs.values.field("p").to_numpy(zero_copy_only=False), dtype=np.int64)[o0 : offs[-1]]
    v = np.asarray(xs.values.field("v").to_numpy(zero_copy_only=False), dtype=np.float64)[o0 : offs[-1]]
    b = np.asarray(base.to_numpy(zero_copy_only=False), dtype=np.int64)
    w = np.asarray(width.to_numpy(zero_copy_only=False), dtype=np.int64)
    out_offs = np.concatenate([[0], np.cumsum(w)]).astype(np.int64)
    out = np.zeros(int(out_offs[-1]))
    row = np.repeat(np.arange(n), np.diff(offs))
    rel = p - b[row]
    ok = (rel >= 0) & (rel < w[row])
    out[out_offs[row[ok]] + rel[ok]] = v[ok]
    return pa.ListArray.from_arrays(pa.array(out_offs.astype(np.int32)), pa.array(out, type=pa.float64()))


@arrow_udf(T.ArrayType(T.DoubleType()))
def scatter_dense(xs: pa.Array, base: pa.Array, width: pa.Array) -> pa.Array:
    """list<struct<p: long, v: double>> → dense array<double> of ``width``
    holding v at position p − base (zeros elsewhere; out-of-range ignored)."""
    return _dense(xs, base, width)
