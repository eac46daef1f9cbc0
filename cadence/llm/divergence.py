"""Divergence of sources from one another and from their language.

First pass: exact document frequencies of every language's terms keep those in
enough documents.  The kept terms are dealt by hash to shards, and a task makes
a minimal perfect hash of each, with its keys.  Second pass: the shards are sent
to all tasks, as many at a time as stay under a fixed number of bytes (a larger
vocabulary takes further passes), and each group of documents has a dense array
of counts that terms increment at their slot; stored keys tell kept terms from
others, so counts are exact.

Shares are whole billionths and all arithmetic is on whole numbers.  Pairs of
sources are compared over blocks of slots and tiles of sources, as arrays; the
partial sums are added up.  A language of any share of the documents is spread
over as many tasks as it has blocks.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import prepared, shard_count, staged
from cadence.llm.perfecthash import PerfectHash, hashes
from cadence.llm.wordscan import LETTERS, slices, text_bytes, words

MIN_DOCS = 10
TOP = 10
#: Terms of a shard, about.
SHARD_TERMS = 50_000
#: Bytes of perfect hashes sent to the tasks at once.
BROADCAST_BYTES = 64_000_000
#: Counts (8 bytes each) that a task holds before it hands them on.
DENSE_SLOTS = 4_000_000
#: Slots and sources that one task compares at once.
BLOCK_SLOTS = 8192
TILE = 64
_BILLION = 1_000_000_000


def _grouped(docs: DataFrame) -> DataFrame:
    """(lang, source, text as bytes), nulls empty."""
    return text_bytes(docs, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the
    language; a row a task and term is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = words(part.column("text"), LETTERS)
            many = max(1, len(found.terms))
            once = np.unique(found.text_of() * many + found.number)
            langs = part.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False)[once // many]
            pair, n = np.unique(lang * many + once % many, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(pair // many)).cast(pa.string()),
                    found.terms.take(pa.array(pair % many)).cast(pa.large_string()).cast(pa.string()),
                    pa.array(n),
                ],
                names=["lang", "term", "n"],
            )

    rows = _grouped(docs).mapInArrow(count, "lang string, term string, n long")
    return rows.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def sharded_hashes(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, shard, n, bytes, hash): a perfect hash of every language's shard."""
    n = shard_count(terms.count(), shard_terms)
    n = 1 << (n - 1).bit_length()

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash(pa.array([t.encode() for t in rows["term"]], pa.large_binary()))
        own = [(rows["lang"].iloc[0], int(rows["shard"].iloc[0]), len(made), made.nbytes(), pickle.dumps(made))]
        return pd.DataFrame(own, columns=["lang", "shard", "n", "bytes", "hash"])

    shard = F.xxhash64("term").bitwiseAND(F.lit(n - 1)).cast("int").alias("shard")
    return (
        terms.select("lang", shard, "term")
        .groupBy("lang", "shard")
        .applyInPandas(make, "lang string, shard int, n long, bytes long, hash binary")
    )


def _based(shards: DataFrame) -> DataFrame:
    """Adds base, the language's first slot of the shard, and at, the bytes of
    all shards before it; a row a shard."""
    every = Window.orderBy("lang", "shard").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select(
        F.col("lang").alias("of"),
        F.col("shard").alias("number"),
        F.coalesce(F.sum("n").over(own), F.lit(0)).alias("base"),
        F.coalesce(F.sum("bytes").over(every), F.lit(0)).alias("at"),
    )
    return shards.join(sizes, (shards["lang"] == sizes["of"]) & (shards["shard"] == sizes["number"])).drop("of", "number")


def _recount(docs: DataFrame, shards: list, bits: int) -> DataFrame:
    """(lang, source, slot, n) of the terms in the given shards (rows), dealt
    by the low ``bits`` of their hash."""
    spark = docs.sparkSession
    lists: dict[str, list] = {}
    for r in shards:
        lists.setdefault(r["lang"], []).append((r["shard"], r["base"], bytes(r["hash"])))
    shared = spark.sparkContext.broadcast(lists)  # under BROADCAST_BYTES, or one shard
    mask = np.uint64((1 << bits) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {lang: [(s, base, pickle.loads(h)) for s, base, h in own] for lang, own in shared.value.items()}
        first = {lang: min(base for _, base, _ in own) for lang, own in opened.items()}
        size = {lang: max(base + len(h) for _, base, h in own) - first[lang] for lang, own in opened.items()}
        dense: dict[tuple[str, str], np.ndarray] = {}
        room = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                at = np.flatnonzero(counts)
                for i in range(0, len(at), 100_000):
                    part = at[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part + first[lang]), pa.array(counts[part])],
                        names=["lang", "source", "slot", "n"],
                    )
            dense.clear()

        for part in slices(batches):
            found = words(part.column("text"), LETTERS)
            h = hashes(found.terms)
            langs = part.column("lang").dictionary_encode()
            sources = part.column("source").dictionary_encode()
            text = found.text_of()
            lang_of = langs.indices.to_numpy(zero_copy_only=False)[text]
            source_of = sources.indices.to_numpy(zero_copy_only=False)[text].astype(np.int64)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                if lang not in opened:
                    continue
                own = lang_of == code
                slot = np.full(len(found.terms), -1, np.int64)
                for shard, base, table in opened[lang]:
                    mine = np.flatnonzero(h & mask == np.uint64(shard))
                    got = table.slots(found.terms.take(pa.array(mine)), h[mine])
                    slot[mine] = np.where(got < 0, -1, got + base - first[lang])
                at = slot[found.number[own]]
                key = (source_of[own] * size[lang] + at)[at >= 0]
                key, n = np.unique(key, return_counts=True)
                which = key // size[lang]
                edge = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(key) else np.zeros(0, int)
                for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(key)]):
                    group = (lang, sources.dictionary[int(which[i])].as_py())
                    if group not in dense:
                        if room + size[lang] > DENSE_SLOTS and dense:
                            yield from out()
                            room = 0
                        dense[group] = np.zeros(size[lang], np.int64)
                        room += size[lang]
                    dense[group][key[i:j] % size[lang]] += n[i:j]
        yield from out()

    rows = _grouped(docs).mapInArrow(count, "lang string, source string, slot long, n long")
    return rows.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))


def recounted(docs: DataFrame, shards: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, source, slot, n), n > 0: how often every group holds every kept
    term; shards: lang, shard, n, base, at, bytes, hash."""
    spark = docs.sparkSession
    size = shards.agg(F.max(F.col("at") + F.col("bytes")).alias("total"), F.max("shard").alias("last")).first()
    total, bits = size["total"] or 0, (size["last"] or 0).bit_length()
    out = None
    for i in range(-(-total // broadcast_bytes)):
        # shards that begin in this stretch of bytes
        own = shards.where(F.col("at").between(i * broadcast_bytes, (i + 1) * broadcast_bytes - 1)).collect()
        if own:
            part = staged(_recount(docs, own, bits), "divergence-counts")
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "lang string, source string, slot long, n long")
    return out


def share(n: np.ndarray, total: int) -> np.ndarray:
    """floor(10**9 * n / total) for 0 <= n <= total < 9 * 10**15, digits by threes."""
    out, rest = n // total, n % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out


def _share(n, total):
    """The same of columns."""
    return F.expr(f"(CAST({_BILLION} AS DECIMAL(12,0)) * CAST({n} AS DECIMAL(20,0))) div CAST({total} AS DECIMAL(20,0))")


def _compare(rows_of_unit: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The partial sums of one block and two tiles (lang, source, item, value),
    item after source in the order of the language's sources."""
    columns = ["lang", "source", "item", "value"]
    if not len(rows_of_unit):
        return pd.DataFrame([], columns=columns)
    u = rows_of_unit.iloc[0]
    width, terms = int(u["width"]), int(u["terms"])
    sources: dict[str, int] = {}
    for r in (*u["left"], *u["right"]):
        sources.setdefault(r["source"], int(r["total"]))
    if not width:
        p = np.zeros((len(sources), 0), np.int64)
    else:
        line = {s: i for i, s in enumerate(sources)}
        dense = np.zeros((len(sources), width), np.int64)
        if len(counts):
            own = counts["source"].map(line).to_numpy(np.int64)
            dense[own, counts["slot"].to_numpy(np.int64) - int(u["block"]) * BLOCK_SLOTS] = counts["n"].to_numpy(np.int64)
        p = np.stack([1 + share(dense[i] + 2, total + 2 * terms) for i, total in enumerate(sources.values())])
    names, out = list(sources), []
    place = {s: i for i, s in enumerate(names)}
    right = [r["source"] for r in u["right"]]
    for r in u["left"]:
        a = place[r["source"]]
        items = [s for s in right if s > r["source"]] if u["ti"] == u["tj"] else right
        if items:
            q = p[[place[s] for s in items]]
            value = ((p[a] - q) ** 2 // (p[a] + q)).sum(axis=1)
            out += [(u["lang"], r["source"], item, v) for item, v in zip(items, value.tolist())]
    return pd.DataFrame(out, columns=columns)


def pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, once.
    groups: lang, source, total, terms."""
    by = Window.partitionBy("lang").orderBy("source")
    tiled = groups.withColumn("tile", F.floor((F.row_number().over(by) - 1) / TILE).cast("int"))
    tiled = staged(tiled, "divergence-tiles")
    tile = tiled.groupBy("lang", "tile").agg(  # at most TILE sources
        F.sort_array(F.collect_list(F.struct("source", "total"))).alias("list"), F.max("terms").alias("terms")
    )
    left = tile.select("lang", F.col("tile").alias("ti"), F.col("list").alias("left"), "terms")
    right = tile.select("lang", F.col("tile").alias("tj"), F.col("list").alias("right"))
    blocks = F.greatest(F.ceil(F.col("terms") / BLOCK_SLOTS), F.lit(1)).cast("int")
    units = (
        left.join(right, "lang")
        .where("ti <= tj")
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("width", F.least(F.lit(BLOCK_SLOTS), F.col("terms") - F.col("block") * BLOCK_SLOTS).cast("int"))
    )
    tiles = tile.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    dealt = (
        counts.join(tiled.select("lang", "source", "tile"), ["lang", "source"])
        .join(tiles, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang",
            F.least("tile", "other").alias("ti"),
            F.greatest("tile", "other").alias("tj"),
            F.floor(F.col("slot") / BLOCK_SLOTS).cast("int").alias("block"),
            "source",
            "slot",
            "n",
        )
    )
    key = ["lang", "ti", "tj", "block"]
    parts = units.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(
        _compare, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _slot_terms(shards: DataFrame) -> DataFrame:
    """(lang, slot, term) of every kept term."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, base, h in zip(b["lang"], b["base"], b["hash"]):
                keys = pickle.loads(h).keys.to_pylist()
                slot = np.arange(base, base + len(keys))
                yield pd.DataFrame({"lang": lang, "slot": slot, "term": [k.decode() for k in keys]})

    return shards.select("lang", "base", "hash").mapInPandas(rows, "lang string, slot long, term string")


def raised_terms(groups: DataFrame, counts: DataFrame, terms: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): every group's terms of a higher share
    than in the whole language, the ``top`` of them."""
    every = terms.join(counts.groupBy("lang", "slot").agg(F.sum("n").alias("m")), ["lang", "slot"])
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    own = (
        counts.join(every, ["lang", "slot"])
        .join(groups, ["lang", "source"])
        .join(langs, "lang")
        .withColumn("p", 1 + _share("(n + 2)", "(total + 2 * terms)"))
        .withColumn("q", 1 + _share("(m + 2)", "(all + 2 * terms)"))
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def audited(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard_terms: int = SHARD_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(lang, source, part, item, value, rank).  Part pair: the divergence of
    every two sources of a language; part term: a group's terms of a higher
    share than in its language, at most ``top``.

    Null text, lang and source are empty.  A language without kept terms has
    pairs of value 0; a language of one source has none.  Rows that repeat an
    id are documents of their own; ids are not read.  Ties go to the smaller
    item in UTF-8.  No rows give no rows.  Further columns are ignored."""
    prepared(docs.sparkSession)
    kept = staged(kept_terms(docs, min_docs), "divergence-terms")
    shards = staged(_based(staged(sharded_hashes(kept, shard_terms), "divergence-hashes")), "divergence-shards")
    counts = recounted(docs, shards, broadcast_bytes)
    there = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = (
        there.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(shards.groupBy("lang").agg(F.sum("n").alias("terms")), "lang", "left")
        .na.fill(0, ["total", "terms"])
    )
    groups = staged(groups, "divergence-groups")
    once = staged(pairs(groups, counts), "divergence-pairs")
    both = once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = ["lang", "source", "part", "item", "value", "rank"]
    paired = both.select("*", F.lit("pair").alias("part"), F.row_number().over(order).alias("rank")).select(*out)
    raised = raised_terms(groups, counts, _slot_terms(shards), top).withColumn("part", F.lit("term"))
    return paired.unionByName(raised.select(*out))


#: DuckDB SQL of the query's rows over the table documents.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
 t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
 k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}),
 v AS (SELECT lang, count(*) AS terms FROM k GROUP BY lang),
 g AS (SELECT DISTINCT lang, source FROM d),
 c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
 f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
 p AS (SELECT lang, source, term, n, 1 + ({_BILLION}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * terms) AS p
       FROM f JOIN v USING (lang)),
 q AS (SELECT lang, term, 1 + ({_BILLION}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * terms) AS q
       FROM (SELECT lang, term, sum(n) AS n FROM f GROUP BY ALL) JOIN v USING (lang)),
 pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
 pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
 tv AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
 u AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tv))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM u WHERE part = 'pair' OR rank <= {TOP}
"""
