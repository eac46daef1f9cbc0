"""Temperature mixing of sources, realised as budgeted block permutations.
DataFrame functions only.

Weights.  Source i with n_i tokens gets weight n_i^a / sum n_j^a.  The
exponent a in [0, 1] (1: as the corpus is, 0: all sources alike) is bisected on
a grid of 2^-20: the largest one whose weights reach the target entropy (a
share of ln(sources)), raised if needed to the smallest one at which no source
is repeated more than ``max_repeat`` times.  Each pass over the source table
takes five bisections at once.

Quotas.  Source i gets round(w_i * budget) tokens.  Without a budget it is the
smallest that uses every source whole at least once, so no document goes.

Blocks.  The documents of a source fall into hash blocks of about BLOCK_DOCS.
An epoch is a permutation of the source's blocks (by a hash of seed, epoch and
block).  Whole epochs take every block; the last takes blocks in order while
they fit, and of the block at the edge documents in hash order while they fit.
Only block sums are ordered, in two levels, so no task orders a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import prepared, staged, text_or_empty

BLOCK_DOCS = 1000
ENTROPY = 0.9
MAX_REPEAT = 2.0
SEED = 17
GRID = 1 << 20
FAN = 32
#: Rows (about 100 bytes each) up to which a table of sources or blocks is sent to every task.
BROADCAST_ROWS = 200_000


def token_count(col="text"):
    """Words of a text (null: 0)."""
    return F.regexp_count(text_or_empty(col), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _bisect(sizes: DataFrame, measure, holds, rising: bool) -> int:
    """The edge of a monotone condition on the grid 0..GRID: if rising the
    smallest k where it holds (GRID if nowhere), else the largest (0 if nowhere)."""
    lo, hi = 0, GRID
    while lo < hi:
        step = max(1, (hi - lo) // FAN)
        at = list(range(lo, hi, step)) + [hi]
        row = sizes.agg(*[measure(k / GRID).alias(f"m{i}") for i, k in enumerate(at)]).first()
        ok = [row[f"m{i}"] is not None and holds(row[f"m{i}"]) for i in range(len(at))]
        if rising:
            i = ok.index(True) if True in ok else None
            if i is None:
                return GRID
            if i == 0:
                return at[0]
            lo, hi = at[i - 1] + 1, at[i]
        else:
            held = [i for i, x in enumerate(ok) if x]
            if not held:
                return 0
            i = held[-1]
            if i == len(at) - 1:
                return at[i]
            lo, hi = at[i], at[i + 1] - 1
            if lo + 1 > hi:
                return lo
            if hi == lo + 1:
                last = sizes.agg(measure(hi / GRID).alias("m")).first()["m"]
                return hi if last is not None and holds(last) else lo
    return lo


def weights(
    docs: DataFrame, entropy: float = ENTROPY, max_repeat: float = MAX_REPEAT, budget: int | None = None
) -> DataFrame:
    """(source, docs, tokens, exponent, weight, quota).  Null sources count as
    the source ''.  A source without tokens has weight and quota 0."""
    prepared(docs.sparkSession)
    sizes = staged(
        docs.select(F.coalesce("source", F.lit("")).alias("source"), token_count().alias("n"))
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")),
        "mixing-sources",
    )
    full = sizes.where("tokens > 0")
    tot = full.agg(
        F.count(F.lit(1)).alias("s"), F.sum("tokens").alias("n"), F.max("tokens").alias("hi"), F.min("tokens").alias("lo")
    ).first()
    if not tot["s"]:
        return sizes.select(
            "source", "docs", "tokens", F.lit(1.0).alias("exponent"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota")
        )
    import math

    share = F.log(F.col("tokens") / F.lit(float(tot["n"])))

    def spread(a: float):
        z = F.sum(F.exp(share * a))
        return F.log(z) - F.sum(F.exp(share * a) * share * a) / z

    need = entropy * math.log(tot["s"])
    k = _bisect(full, spread, lambda h: h >= need - 1e-12, rising=False)

    def repeats(a: float):
        if budget is None:
            return F.exp((1 - a) * (F.log(F.max("tokens").cast("double")) - F.log(F.min("tokens").cast("double"))))
        # the least source is repeated most while a <= 1
        return F.lit(float(budget)) * F.max(F.exp(share * a) / F.col("tokens")) / F.sum(F.exp(share * a))

    k = max(k, _bisect(full, repeats, lambda r: r <= max_repeat + 1e-12, rising=True))
    a = k / GRID
    z = full.agg(F.sum(F.exp(share * a)).alias("z")).first()["z"]
    if budget is None:
        quota = F.round(F.col("tokens") * F.exp((1 - a) * (F.lit(math.log(tot["hi"])) - F.log(F.col("tokens").cast("double")))))
    else:
        quota = F.round(F.exp(share * a) / z * float(budget))
    some = F.col("tokens") > 0
    return sizes.select(
        "source",
        "docs",
        "tokens",
        F.lit(a).alias("exponent"),
        F.when(some, F.exp(share * a) / z).otherwise(0.0).alias("weight"),
        F.when(some, quota).otherwise(0.0).cast("long").alias("quota"),
    )


def _hash(*parts):
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))


def _placed(docs: DataFrame, sources: DataFrame, block_docs: int) -> DataFrame:
    """(row, source, block): docs as a struct, so that no column name clashes."""
    src = sources.select("source", F.ceil(F.col("docs") / block_docs).cast("long").alias("blocks"))
    h = F.conv(F.substring(_hash(F.col("row.doc_id")), 1, 8), 16, 10).cast("long")
    return (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        .withColumn("source", F.coalesce("row.source", F.lit("")))
        .join(_small(src), "source")
        .select("row", "source", (h % F.col("blocks")).alias("block"))
    )


def schedule(docs: DataFrame, sources: DataFrame, seed: int = SEED, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(row, epoch, block_rank, n_tokens): the rows of docs (columns doc_id,
    source, text, further ones) as structs, repeated by the quotas of
    ``sources``; block_rank is the place of the block in its epoch.  Rows that
    repeat an id are documents of their own; texts without words cost nothing
    and come with their block."""
    sources = staged(sources, "mixing-weights")
    placed = _placed(docs, sources, block_docs)
    blocks = (
        placed.select("source", "block", token_count("row.text").alias("n"))
        .groupBy("source", "block")
        .agg(F.sum("n").alias("tokens"))
    )
    quota = sources.select(
        "source",
        F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("int").alias("full"),
        F.when(F.col("tokens") > 0, F.col("quota") % F.col("tokens")).otherwise(0).alias("rest"),
    )
    last = F.when(F.col("rest") > 0, F.col("full")).otherwise(F.col("full") - 1)
    turns = (
        blocks.join(_small(quota), "source")
        .withColumn("last", last)
        .where("last >= 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("h", _hash(F.lit(seed), F.col("epoch"), F.col("block"), F.col("source")))
        .withColumn("part", F.substring("h", 1, 2))
    )
    turns = staged(turns.select("source", "block", "epoch", "tokens", "full", "rest", "h", "part"), "mixing-turns")
    # ordered sums in two levels: 256 parts an epoch, then inside a part
    before = Window.partitionBy("source", "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        turns.groupBy("source", "epoch", "part")
        .agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k"))
        .select(
            "source",
            "epoch",
            "part",
            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
            F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k0"),
        )
    )
    inside = Window.partitionBy("source", "epoch", "part").orderBy("h", "block")
    ranked = turns.join(parts, ["source", "epoch", "part"]).select(
        "source",
        "block",
        "epoch",
        "tokens",
        "full",
        "rest",
        (F.col("k0") + F.row_number().over(inside) - 1).alias("block_rank"),
        (F.col("t0") + F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")).alias("at"),
    )
    ranked = staged(ranked, "mixing-ranked")
    fits = (F.col("epoch") < F.col("full")) | (F.col("at") + F.col("tokens") <= F.col("rest"))
    key = ["source", "block"]
    whole = ranked.where(fits).select(*key, "epoch", "block_rank")
    edge = ranked.where(~fits & (F.col("at") < F.col("rest"))).select(
        *key, "epoch", "block_rank", (F.col("rest") - F.col("at")).alias("left")
    )
    n = token_count("row.text").alias("n_tokens")
    taken = placed.join(_small(whole), key).select("row", "epoch", "block_rank", n)
    order = Window.partitionBy(*key).orderBy(
        _hash(F.lit(seed), F.col("epoch"), F.col("row.doc_id")), "row.doc_id", F.md5(text_or_empty("row.text").cast("binary"))
    )
    partly = (
        placed.join(_small(edge), key)
        .select("row", *key, "epoch", "block_rank", "left", n)
        .withColumn("upto", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("upto") <= F.col("left"))
    )
    return taken.unionByName(partly.select("row", "epoch", "block_rank", "n_tokens"))


def mixed(
    docs: DataFrame,
    entropy: float = ENTROPY,
    max_repeat: float = MAX_REPEAT,
    budget: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, all its columns, repeated to the target mix; see
    ``weights`` and ``schedule``.  No rows give no rows."""
    plan = schedule(docs, weights(docs, entropy, max_repeat, budget), seed)
    return plan.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: DuckDB SQL of the same schedule over a table {docs} (doc_id, source, text).
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(text, '')) AS th,
                  len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n FROM {docs}),
 src AS (SELECT source, count(*) AS docs, sum(n)::BIGINT AS tokens FROM d GROUP BY source),
 tot AS (SELECT count(*) AS s, sum(tokens)::BIGINT AS n, max(tokens) AS hi, min(tokens) AS lo FROM src WHERE tokens > 0),
 grid AS (SELECT k, k / {grid}.0::DOUBLE AS a FROM (SELECT unnest(generate_series(0, {grid})) AS k)),
 ent AS (SELECT k, ln(sum(exp(l * a))) - sum(exp(l * a) * l * a) / sum(exp(l * a)) AS h
         FROM grid, (SELECT ln(tokens / n::DOUBLE) AS l FROM (SELECT src.tokens, tot.n FROM src, tot) WHERE tokens > 0) GROUP BY k),
 ke AS (SELECT coalesce(max(k), 0) AS k FROM ent, tot WHERE h >= {entropy} * ln(s) - 1e-12),
 kr AS (SELECT coalesce(min(k), {grid}) AS k FROM grid, tot WHERE exp((1 - a) * (ln(hi) - ln(lo))) <= {max_repeat} + 1e-12),
 al AS (SELECT greatest(ke.k, kr.k) / {grid}.0::DOUBLE AS a FROM ke, kr),
 q AS (SELECT source, docs, tokens, ceil(docs / {block_docs}.0)::BIGINT AS blocks,
              CASE WHEN tokens > 0 THEN round(tokens * exp((1 - a) * (ln(hi) - ln(tokens))))::BIGINT ELSE 0 END AS quota FROM src, tot, al),
 fr AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS fulls, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest FROM q),
 p AS (SELECT d.*, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % blocks AS block, fulls, rest FROM d JOIN fr USING (source)),
 b AS (SELECT source, block, fulls, rest, sum(n)::BIGINT AS tokens FROM p GROUP BY ALL),
 t AS (SELECT *, unnest(range(0, CASE WHEN rest > 0 THEN fulls + 1 ELSE fulls END))::INT AS epoch FROM b),
 r AS (SELECT *, row_number() OVER w - 1 AS block_rank, sum(tokens) OVER w - tokens AS at FROM
         (SELECT *, md5('{seed}:' || epoch || ':' || block || ':' || source) AS h FROM t)
       WINDOW w AS (PARTITION BY source, epoch ORDER BY h, block ROWS UNBOUNDED PRECEDING)),
 e AS (SELECT p.doc_id, p.source, r.epoch, r.block_rank, p.n,
              r.epoch < r.fulls OR r.at + r.tokens <= r.rest AS whole, r.rest - r.at AS left_,
              sum(p.n) OVER (PARTITION BY p.source, p.block, r.epoch ORDER BY md5('{seed}:' || r.epoch || ':' || coalesce(p.doc_id::VARCHAR, 'null')), p.doc_id, p.th
                             ROWS UNBOUNDED PRECEDING) AS upto
       FROM p JOIN r ON p.source = r.source AND p.block = r.block)
SELECT doc_id, source, epoch, block_rank::BIGINT AS block_rank, n::BIGINT AS n_tokens
FROM e WHERE whole OR (left_ > 0 AND upto <= left_)
"""


def sql(docs: str = "documents", entropy: float = ENTROPY, max_repeat: float = MAX_REPEAT, seed: int = SEED) -> str:
    return SQL.format(docs=docs, entropy=entropy, max_repeat=max_repeat, seed=seed, grid=GRID, block_docs=BLOCK_DOCS)
