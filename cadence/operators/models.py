"""Classifiers and clustering: rule model (M1), model / processor plug-in
registries (U1, U2), k-means train (M4), mini-batch update (M5), nearest
centroid (M6), per-window UDF hook (U3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.session import read_if_written


def rule_class(time_stamp: Column, period_ms: int = 10_000, threshold_ms: int = 5_000) -> Column:
    """M1: class 1 when ``time_stamp mod period > threshold`` else 0."""
    return F.when(F.pmod(time_stamp, F.lit(period_ms)) > F.lit(threshold_ms), F.lit(1)).otherwise(F.lit(0)).cast("int")


# Model name (the header's ML_model) → Column expression over the row.
_MODELS: dict[str, Callable[[], Column]] = {}


def register_model(name: str, fn: Callable[[], Column]) -> None:
    _MODELS[name] = fn


def registered_models() -> dict[str, Callable[[], Column]]:
    return dict(_MODELS)


register_model("default", lambda: rule_class(F.col("time_stamp")))


def dispatch_model(
    df: DataFrame, model_col: str = "ML_model", out: str = "class", models: dict | None = None, keep_unserved: bool = True
) -> DataFrame:
    """Score each row with the model its header names, as one CASE
    expression (no per-model pass).  A row naming a model nobody serves gets
    NULL, or is held back (``keep_unserved=False``) as an unconsumed queue
    would hold it."""
    models = registered_models() if models is None else models
    expr = None
    for name, fn in models.items():
        cond = F.col(model_col) == F.lit(name)
        expr = F.when(cond, fn()) if expr is None else expr.when(cond, fn())
    if expr is None:
        expr = F.lit(None)
    scored = df.withColumn(out, expr.cast("int"))
    if not keep_unserved:
        scored = scored.where(F.col(model_col).isin(list(models)))
    return scored


# Processing name (the header's ``preprocessing``) → DataFrame → DataFrame.
_PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_processor(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _PROCESSORS[name] = fn


def registered_processors() -> dict[str, Callable[[DataFrame], DataFrame]]:
    return dict(_PROCESSORS)


def _standard(df: DataFrame) -> DataFrame:
    from cadence.operators.dsp import transform_windows

    return transform_windows(df, "standard", time_idx=F.col("time_idx") if "time_idx" in df.columns else None)


def _spectrum_only(df: DataFrame) -> DataFrame:
    from cadence.operators.dsp import transform_windows

    return transform_windows(df, "spectrum", time_idx=F.col("time_idx") if "time_idx" in df.columns else None)


register_processor("standard", _standard)


def fixture_processors() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Registry used by the dispatch fixture: the standard chain plus a
    spectrum-only processor."""
    return {"standard": _standard, "spectrum": _spectrum_only}


def dispatch_processing(df: DataFrame, col: str = "preprocessing", processors: dict | None = None) -> DataFrame:
    """Run each window through the processor its header names — one
    branch per registered name over the same input, results unioned.  Rows
    naming no registered processor are those of :func:`split_unserved`."""
    processors = registered_processors() if processors is None else processors
    out = None
    for name, fn in processors.items():
        part = fn(df.where(F.col(col) == F.lit(name)))
        out = part if out is None else out.unionByName(part)
    return out


def split_unserved(df: DataFrame, col: str, registry: dict) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``col`` names an entry of ``registry``, side table
    of the rows that name another or none)."""
    served = F.coalesce(F.col(col).isin(list(registry)), F.lit(False))
    return df.where(served), df.where(~served)


# ---- clustering (M4–M6) ------------------------------------------------------------
def as_vector(arr_col: str, dims: int | None = None):
    """ARRAY<FLOAT|DOUBLE> (optionally its first ``dims``) → ML vector."""
    from pyspark.ml.functions import array_to_vector

    a = F.col(arr_col)
    if dims is not None:
        a = F.slice(a, 1, dims)
    return array_to_vector(F.transform(a, lambda x: x.cast("double")))


def train_kmeans(df: DataFrame, features: str = "features", k: int = 2, seed: int = 0, max_iter: int = 20):
    """M4: k-means (k-means|| init, fixed seed) over a vector column."""
    from pyspark.ml.clustering import KMeans

    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df)


def first_k_centroids(df: DataFrame, vec: str, order: str, k: int) -> list[list[float]]:
    """Deterministic initial centroids: the first ``k`` vectors by ``order``.
    Only k rows reach the driver (a top-k per partition, then a merge)."""
    rows = df.orderBy(order).limit(k).select(F.transform(F.col(vec), lambda x: x.cast("double")).alias("v")).collect()
    return [list(r["v"]) for r in rows]


def _sq_dist(vec: str, centre: list[float]):
    c = F.array(*[F.lit(float(x)) for x in centre])
    diffs = F.zip_with(F.transform(F.col(vec), lambda x: x.cast("double")), c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, y: acc + y)


def assign_cluster(df: DataFrame, vec: str, centroids: list[list[float]]) -> DataFrame:
    """M6: nearest centroid (squared Euclidean; ties → lower index).  The k
    centroids are literals in the expression — k·d values, bounded by the
    model, never by the data — so there is no join at all."""
    cands = F.array(*[F.struct(_sq_dist(vec, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centroids)])
    best = F.array_min(cands)
    return df.withColumn("cluster", best["j"].cast("int")).withColumn("dist", best["d"])


def update_kmeans(batch: DataFrame, vec: str, centroids: list[list[float]], seen: list[int] | None = None) -> DataFrame:
    """M5: one mini-batch step.  Assign the batch, then per cluster
    centre ← centre + (Σx − n·centre)/(seen + n).  Returns (cluster, n, dim,
    value); clusters that got no points keep their centre.  The aggregation is
    a partial (map-side) sum per cluster and dimension."""
    d = len(centroids[0])
    seen = seen or [0] * len(centroids)
    a = assign_cluster(batch, vec, centroids)
    sums = a.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.try_element_at(F.col(vec), F.lit(i + 1)).cast("double")).alias(f"s{i}") for i in range(d)],
    )
    c_lit = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centroids])
    seen_lit = F.array(*[F.lit(int(s)) for s in seen])
    rows = sums.select(
        "cluster",
        "n",
        F.posexplode(F.array(*[F.col(f"s{i}") for i in range(d)])).alias("dim", "s"),
    )
    centre = F.element_at(F.element_at(c_lit, F.col("cluster") + 1), F.col("dim") + 1)
    seen_c = F.element_at(seen_lit, F.col("cluster") + 1)
    new = centre + (F.col("s") - F.col("n") * centre) / (seen_c + F.col("n"))
    return rows.select("cluster", "n", F.col("dim").cast("int").alias("dim"), new.alias("value"))


def minibatch_kmeans_sink(path: str, vec: str, centroids: list[list[float]]):
    """M5 on a stream: a ``foreachBatch`` function that updates the centres
    with each micro-batch and writes version ``batch_id`` of the centroid
    table (cluster, dim, value, seen) — a replayed batch rewrites the same
    version.  The k·d centres and k counts it carries are re-read from the
    latest version before ``batch_id`` when the driver restarts."""
    state: dict = {"c": None, "seen": None, "version": None}

    def load_before(spark, batch_id: int) -> None:
        state["c"], state["seen"] = [list(c) for c in centroids], [0] * len(centroids)
        state["version"] = -1
        table = read_if_written(spark, path)
        if table is None:  # no version written yet
            return
        table = table.where(F.col("version") < batch_id)
        last = table.agg(F.max("version")).first()[0]
        if last is None:
            return
        for r in table.where(F.col("version") == last).collect():  # k·d rows
            state["c"][r["cluster"]][r["dim"]] = r["value"]
            state["seen"][r["cluster"]] = int(r["seen"])
        state["version"] = last

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if state["c"] is None or state["version"] is None or state["version"] != batch_id - 1:
            load_before(batch_df.sparkSession, batch_id)
        upd = update_kmeans(batch_df, vec, state["c"], state["seen"]).collect()  # k·d rows
        new_c, new_seen = [list(c) for c in state["c"]], list(state["seen"])
        counted = set()
        for r in upd:
            new_c[r["cluster"]][r["dim"]] = r["value"]
            if r["cluster"] not in counted:
                new_seen[r["cluster"]] += int(r["n"])
                counted.add(r["cluster"])
        rows = [(j, d, float(new_c[j][d]), int(new_seen[j])) for j in range(len(new_c)) for d in range(len(new_c[j]))]
        out = batch_df.sparkSession.createDataFrame(rows, "cluster int, dim int, value double, seen long")
        out.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        state["c"], state["seen"], state["version"] = new_c, new_seen, batch_id

    return sink
