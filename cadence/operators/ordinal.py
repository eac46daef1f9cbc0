"""Skew-safe running positions and prefix sums within a key.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key
to one task; a session that holds a third of the data would then be sorted by
a single core.  Here rows are first cut into ordered buckets on (key, order)
— a hot key is split across many buckets — each bucket numbers its own rows
with a window, and a small table of per-(key, bucket) totals supplies the
offsets.

Buckets are deterministic, so every recomputation — the offsets branch, a
retried task after executor loss — assigns every row to the same bucket (a
sampled ``repartitionByRange`` would resample per exchange and could
disagree between branches):

* numeric / temporal first order column: exact per-key count, min and max
  find the hot keys (more than ``ROWS_PER_BUCKET`` rows; at most
  n / ROWS_PER_BUCKET of them, a proven bound checked before broadcasting)
  and split each into ⌈count / ROWS_PER_BUCKET⌉ equal-width ranges of that
  column — one lookup and one division per row;
* otherwise: bounds from a seeded sample of the sort keys (≤ 64 × buckets
  rows reach the driver, ≤ ``MAX_TREE_BUCKETS`` buckets) as literals in a
  balanced comparison tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_BUCKET = 64
MAX_SAMPLE = 200_000
MAX_TREE_BUCKETS = 256
# Target rows per (key, bucket) window partition, and the hot-key threshold.
ROWS_PER_BUCKET = 4_000_000
# Hot-key tables up to this many rows are broadcast (n / ROWS_PER_BUCKET
# bounds them; above it the join is a regular, AQE-managed join).
MAX_BROADCAST_HOT_KEYS = 500_000
# Inputs this small are numbered without splitting keys (no sample job): a
# single bucket of this many rows is an ordinary task-sized window partition.
MIN_ROWS_PER_BUCKET = 1_000_000


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_bounds(df: DataFrame, cols: Sequence[str], buckets: int, seed: int = 17, min_rows: int | None = None) -> list[tuple]:
    """≤ buckets−1 increasing bounds over the tuple (cols…), as text values
    in Spark's own ordering."""
    if buckets <= 1:
        return []
    n = df.count()
    buckets = min(buckets, -(-n // (MIN_ROWS_PER_BUCKET if min_rows is None else max(1, min_rows))))
    if n == 0 or buckets <= 1:
        return []
    want = min(MAX_SAMPLE, SAMPLE_PER_BUCKET * buckets)
    frac = min(1.0, want / n)
    sample = df.select(*cols)
    if frac < 1.0:
        sample = sample.sample(False, frac, seed)
    rows = sample.orderBy(*cols).select(*[F.col(c).cast("string").alias(c) for c in cols]).collect()
    if not rows:
        return []
    picks, last = [], None
    for j in range(1, buckets):
        t = tuple(rows[min(len(rows) - 1, (j * len(rows)) // buckets)])
        if t != last:
            picks.append(t)
            last = t
    return picks


def bucket_of(df: DataFrame, cols: Sequence[str], bounds: list[tuple]) -> Column:
    """Bucket index = number of bounds strictly below the row's key tuple,
    via a balanced comparison tree (log2(#bounds) comparisons per row)."""
    if not bounds:
        return F.lit(0)
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(*[F.col(c).alias(c) for c in cols])

    def lit(t):
        return F.struct(*[(F.lit(v).cast(types[c]) if v is not None else F.lit(None).cast(types[c])).alias(c) for c, v in zip(cols, t)])

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key > lit(bounds[mid]), build(mid + 1, hi)).otherwise(build(lo, mid))

    return build(0, len(bounds))


def _order_number(df: DataFrame, col: str) -> Column | None:
    """Monotone numeric view of an order column, or None when it has none."""
    t = dict(df.dtypes)[col]
    if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
        return F.col(col).cast("double")
    if t in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(F.col(col)).cast("double")
    return None


def _stat_buckets(df: DataFrame, keys: list[str], x: Column, rows_per_bucket: int, like: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Add ``_pid`` from exact per-key statistics (see module doc) of ``df``,
    or of ``like``, cheaper rows with the same keys and order values; the flag
    tells whether any key was split at all."""
    hot = (
        (df if like is None else like).select(*keys, x.alias("_x"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        .where(F.col("_n") > rows_per_bucket)
        .select(*keys, "_lo", ((F.col("_hi") - F.col("_lo")) / F.ceil(F.col("_n") / rows_per_bucket)).alias("_w"), F.ceil(F.col("_n") / rows_per_bucket).alias("_nb"))
    )
    n_hot = hot.count()
    if n_hot == 0:
        return df.withColumn("_pid", F.lit(0).cast("long")), False
    side = F.broadcast(hot) if n_hot <= MAX_BROADCAST_HOT_KEYS else hot
    j = df.withColumn("_x", x).join(side, keys, "left")
    # NULL order values sort first, so they belong to bucket 0
    pid = F.when(
        F.col("_w").isNotNull() & (F.col("_w") > 0) & F.col("_x").isNotNull(),
        F.least(F.col("_nb") - 1, F.floor((F.col("_x") - F.col("_lo")) / F.col("_w"))),
    ).otherwise(F.lit(0))
    return j.withColumn("_pid", pid.cast("long")).drop("_x", "_lo", "_w", "_nb"), True


def _with_offsets(local: DataFrame, offsets: DataFrame, parts: list[str]) -> DataFrame:
    """``local`` with the ``_off`` of its bucket.  Null-safe: rows whose key
    (or bucket) is NULL are a group like any other."""
    named = offsets.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(parts)], "_off")
    same = F.lit(True)
    for i, c in enumerate(parts):
        same = same & local[c].eqNullSafe(named[f"_o{i}"])
    return local.join(named, same, "inner").drop(*[f"_o{i}" for i in range(len(parts))])


def running_max_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    pid: Column | None = None,
    rows_per_bucket: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add ``name`` = largest non-NULL ``value`` among the rows of the same
    ``keys`` up to this one by ``order``.

    The rows of a key are cut into ordered buckets: ``pid`` (non-decreasing in
    ``order``) when given, else as for :func:`prefix_sum_within`; the maxima of
    the buckets before supply what is carried in.  ``like``: cheaper rows with
    the same keys and order values, to find the keys to be cut."""
    keys = list(keys)
    if pid is not None:
        staged, split = df.withColumn("_pid", pid), True
    else:
        staged, split = _stat_buckets(df, keys, _order_number(df, order[0]), rows_per_bucket or ROWS_PER_BUCKET, like)
    frame = Window.partitionBy(*keys, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumn("_loc", F.max(value).over(frame))
    if not split:
        return local.withColumn(name, F.col("_loc")).drop("_pid", "_loc")
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy(*keys, "_pid").agg(F.max(value).alias("_tot")).withColumn("_off", F.max("_tot").over(before)).drop("_tot")
    joined = _with_offsets(local, offsets, [*keys, "_pid"])
    return joined.withColumn(name, F.greatest("_off", "_loc")).drop("_pid", "_loc", "_off")


def prefix_sum_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    value: Column | str | None = None,
    name: str = "pos",
    inclusive: bool = False,
    buckets: int | None = None,
    min_rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows of the same ``keys`` that
    sort before this row by ``order`` (plus this row when ``inclusive``).

    With ``value=None`` each row counts 1, giving the 0-based position.
    ``order`` must break ties for a deterministic result; order entries must
    be column names (they also define the buckets)."""
    keys = list(keys)
    order_names = [c if isinstance(c, str) else None for c in order]
    if any(c is None for c in order_names):
        raise ValueError("order must be column names")
    spark = df.sparkSession
    rows_per_bucket = min_rows_per_bucket or ROWS_PER_BUCKET
    v = F.lit(1).cast("long") if value is None else _as_col(value)
    x = _order_number(df, order_names[0])
    if x is not None and buckets is None:
        staged, split = _stat_buckets(df, keys, x, rows_per_bucket)
        staged = staged.withColumn("_pv", v)
    else:
        nb = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200")), MAX_TREE_BUCKETS)
        cols = keys + order_names
        bounds = bucket_bounds(df, cols, nb, min_rows=rows_per_bucket)
        staged = df.withColumn("_pv", v).withColumn("_pid", bucket_of(df, cols, bounds))
        split = bool(bounds)
    frame = (
        Window.partitionBy(*keys, "_pid")
        .orderBy(*[F.col(c) for c in order_names])
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    local = staged.withColumn("_loc", F.coalesce(F.sum("_pv").over(frame), F.lit(0)))
    if not split:
        # no key was split: one bucket per key, so every offset is 0
        return local.withColumn(name, F.col("_loc").cast("long")).drop("_pv", "_pid", "_loc")

    # At most (#buckets + #keys) rows: totals per key and bucket, then the
    # offsets from the buckets before it.  AQE broadcasts it when small.
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(*keys, "_pid")
        .agg(F.sum("_pv").alias("_tot"))
        .withColumn("_off", F.coalesce(F.sum("_tot").over(before), F.lit(0)))
        .drop("_tot")
    )
    joined = _with_offsets(local, offsets, [*keys, "_pid"])
    return joined.withColumn(name, (F.col("_off") + F.col("_loc")).cast("long")).drop("_pv", "_pid", "_loc", "_off")


def position_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", buckets: int | None = None, min_rows_per_bucket: int | None = None
) -> DataFrame:
    """0-based row position within ``keys`` (distributed ``row_number() - 1``)."""
    return prefix_sum_within(df, keys, order, None, name, buckets=buckets, min_rows_per_bucket=min_rows_per_bucket)


def skip_first(df: DataFrame, order: Sequence[str], n: int, min_rows_per_bucket: int | None = None) -> DataFrame:
    """Rows after the first ``n`` in ``order`` (O2) without funnelling the
    table through one task, as a global ``OFFSET`` would."""
    ranked = position_within(df.withColumn("_all", F.lit(0)), ["_all"], order, "_rank", min_rows_per_bucket=min_rows_per_bucket)
    return ranked.where(F.col("_rank") >= F.lit(n)).drop("_all", "_rank")
