"""Approximate nearest neighbours by multi-index hashing.

Binary codes are learned: several rotations, each fit (from its own start) to
bring the principal directions of a bounded sample close to the corners of the
cube, give one bit a dimension each.  A code is split into byte substrings,
each with its own inverted index.  If two codes differ in at most r bits, then
on some of the m substrings they differ in at most r // m bits (and on the
first r % m + 1 substrings or the rest by one less): probing all substring
values within those radii therefore retrieves every code within r.  Retrieved
codes are checked against r and reranked by the cosine of the original
vectors in double precision.

The radius is learned too: on the sample it covers the true neighbours of
nearly all sampled vectors.  Sample neighbours are farther than those among
all rows, so the recall over all rows is higher.

All rows are indexed: index shards (by a hash of the id, so equal vectors
spread) meet blocks of queries on a grid, and every cell returns its best k per
query.  A query with fewer than k retrieved neighbours is searched again with
the whole code length as its radius, so it gets all there are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import prepared, shard_count, staged

ROTATIONS = 4
SAMPLE_ROWS = 4096
COVER = 0.985
K = 5
SHARD_ROWS = 8192
QUERY_ROWS = 2048
_ONES = np.bitwise_count(np.arange(256, dtype=np.uint8))


def usable(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part: not null, not zero, every
    component finite.  Of rows that repeat an id the smallest vector stays."""
    v = F.col(col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    kept = vectors.where(F.col(id_col).isNotNull() & F.col(col).isNotNull()).where(~bad & some)
    return kept.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v).alias("v"))


class Coder:
    """Rotations and radius learned from a sample (rows of unit length)."""

    def __init__(self, sample: np.ndarray, rotations: int = ROTATIONS, cover: float = COVER, k: int = K, seed: int = 5):
        dim = sample.shape[1]
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        _, axes = np.linalg.eigh(x.T @ x)
        rng = np.random.default_rng(seed)
        turns = []
        for _ in range(max(rotations, math.ceil(64 / dim))):
            r = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            for _ in range(20):  # iterative quantisation: corners, then the rotation nearest to them
                u, _, vt = np.linalg.svd(np.where(x @ axes @ r > 0, 1.0, -1.0).T @ (x @ axes))
                r = (u @ vt).T
            turns.append(axes @ r)
        self.turn = np.concatenate(turns, axis=1)
        self.bits = self.turn.shape[1]
        self.radius = self.bits
        n = len(sample)
        if n > k:
            codes = self.codes(sample)
            cos = sample @ sample.T
            np.fill_diagonal(cos, -np.inf)
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            apart = _ONES[codes[:, None, :] ^ codes[near]].sum(axis=2)
            self.radius = int(np.quantile(apart, cover))

    def codes(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits((unit - self.mean) @ self.turn > 0, axis=1)


def _unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow of squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def probe_radii(radius: int, parts: int) -> list[int]:
    """Radii by substring: codes within ``radius`` meet at least one of them."""
    least, more = divmod(radius, parts)
    return [least if i <= more else least - 1 for i in range(parts)]


class Index:
    """Inverted lists of the byte substrings of a shard's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.bound = np.stack([np.searchsorted(np.sort(codes[:, j]), np.arange(257)) for j in range(codes.shape[1])])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        if radius >= 8 * len(code):
            return np.arange(len(self.codes))
        got = np.zeros(len(self.codes), bool)
        for j, r in enumerate(probe_radii(radius, len(code))):
            if r < 0:
                continue
            for value in np.flatnonzero(_ONES[np.arange(256) ^ code[j]] <= r):
                got[self.order[self.bound[j, value] : self.bound[j, value + 1], j]] = True
        rows = np.flatnonzero(got)
        return rows[_ONES[self.codes[rows] ^ code].sum(axis=1) <= radius]


def _search(coder, k: int, radius: int):
    def run(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(shard) or not len(queries):
            return empty
        ids, v = shard["id"].to_numpy(), np.stack(shard["v"].tolist())
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        own = _unit(v)
        index = Index(coder.value.codes(own))
        size = np.linalg.norm(v, axis=1)
        q = np.stack(queries["v"].tolist())
        codes = coder.value.codes(_unit(q))
        out = []
        for qid, vec, code in zip(queries["id"].tolist(), q, codes):
            rows = index.within(code, radius)
            rows = rows[ids[rows] != qid]
            if not len(rows):
                continue
            score = v[rows] @ vec / (size[rows] * np.linalg.norm(vec))
            best = np.lexsort((ids[rows], -score))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows][best], "score": score[best]}))
        return pd.concat(out) if out else empty

    return run


def _grid(rows: DataFrame, queries: DataFrame, coder, k: int, radius: int, shards: int) -> DataFrame:
    """Best k of every (index shard, query block) cell."""
    blocks = shard_count(queries.count(), QUERY_ROWS)
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    left = rows.select("id", "v", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = queries.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"))
    return (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(_search(coder, k, radius), "query_id long, vec_id long, score double")
    )


def nearest(vectors: DataFrame, is_query, k: int = K, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector
    whose id meets ``is_query`` (a function of the id column), by cosine, ties
    to the smaller id, the query itself excluded.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do those whose length is not the most frequent one (ties: the
    larger).  Rows that repeat an id count once.  No usable rows: no result."""
    spark = prepared(vectors.sparkSession)
    every = staged(usable(vectors).withColumn("dim", F.size("v")), "ann-rows")
    dims = every.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = every.where(F.col("dim") == dims["dim"]).select("id", "v")
    # the sample_rows rows of smallest hash, sorted among some twice as many
    n, h = rows.count(), F.xxhash64("id", F.lit(3))
    near = rows.where(h / F.lit(float(1 << 64)) + 0.5 <= F.lit((2 * sample_rows + 50) / n))
    sample = near.orderBy(h, "id").limit(sample_rows).collect()  # bounded by sample_rows
    coder = spark.sparkContext.broadcast(Coder(_unit(np.array([r["v"] for r in sample])), k=k))
    shards = shard_count(n, SHARD_ROWS)
    queries = rows.where(is_query(F.col("id")))
    found = staged(_grid(rows, queries, coder, k, coder.value.radius, shards), "ann-found")
    # a query short of k neighbours looks at every row
    short = queries.join(
        found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id")),
        "id",
        "left_anti",
    )
    again = staged(_grid(rows, staged(short, "ann-short"), coder, k, coder.value.bits, shards), "ann-again")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    whole = found.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    return (
        whole.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
