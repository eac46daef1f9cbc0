"""Target-distribution importance resampling of documents.

Hashed n-gram counts of the corpus and of a target sample give every bucket a
gain, a log ratio in whole thousandths.  A document's weight is the sum of its
gains, taken from one array by its features' buckets; the crc32 of an n-gram is
composed from those of its words (crc32 is linear over GF(2)), so no n-gram is
ever built as text.

With Gumbel noise on the weights, a draw without replacement is the highest
scores.  Their cutoff is found without sorting the corpus: a mergeable quantile
sketch gives a bracket of scores, exact counts outside it prove that the cutoff
lies inside or widen it, and so on inside the bracket until few rows are left;
only those are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared, shard_count, staged
from cadence.llm.wordscan import ALPHANUMERIC, Words, slices, text_bytes, words

BUCKETS = 10_000
RUN = 3
SEED = 42
LEAST_WORDS = 20
#: Rows drawn of every hundred.
PERCENT = 5
#: Relative error of the quantile sketch.
SKETCH_ERROR = 1e-3
#: A bracket of at most this many rows (two longs each) is sorted.
BRACKET_ROWS = 200_000
#: Drawn rows that one task ranks.
RANKED_ROWS = 1_000_000

#: Words longer than this many bytes are rare; their n-grams are hashed as they are.
LONGEST = 64


def _crc_step() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _shift_tables(longest: int) -> np.ndarray:
    """[n, k, b]: what byte b at place k of a crc32 becomes behind n zero bytes."""
    step = _crc_step()
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(longest):
        out[n + 1] = step[out[n] & 0xFF] ^ out[n] >> np.uint32(8)
    return out


_SHIFT = _shift_tables(LONGEST + 1)


def _behind(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of a text's bytes, moved before ``size`` further bytes."""
    out = _SHIFT[size, 0, crc & 0xFF]
    for k in range(1, 4):
        out ^= _SHIFT[size, k, crc >> np.uint32(8 * k) & 0xFF]
    return out


def buckets(found: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 and 3 words the (first words, buckets) of a batch."""
    terms = found.terms.to_pylist()
    size = np.fromiter(map(len, terms), np.int64, len(terms))
    alone = np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms))
    spaced = np.fromiter((zlib.crc32(b" " + t) for t in terms), np.uint32, len(terms))
    number, text = found.number, found.text_of()
    long = size > LONGEST
    add = np.minimum(size, LONGEST) + 1
    crc, first = alone[number], np.arange(len(number))
    out = [(first, (crc % BUCKETS).astype(np.int64))]
    for k in range(1, RUN):
        whole = text[first[: len(first) - 1]] == text[first[: len(first) - 1] + k] if len(first) > 1 else np.zeros(0, bool)
        # a run of k words that starts at the batch's last k words has no k-th follower
        first = first[: len(whole)][whole]
        crc = crc[: len(whole)][whole]
        last = number[first + k]
        crc = _behind(crc, add[last]) ^ spaced[last]
        for i in np.flatnonzero(long[last]).tolist():
            at = int(first[i])
            crc[i] = zlib.crc32(b" ".join(terms[j] for j in number[at : at + k + 1].tolist()))
        out.append((first, (crc % BUCKETS).astype(np.int64)))
    return out


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How often every bucket occurs in all texts; null texts are empty.  One
    row a task and bucket is shuffled."""
    prepared(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for part in slices(batches):
            for _, b in buckets(words(part.column("text"), ALPHANUMERIC)):
                total += np.bincount(b, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = text_bytes(docs).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of a bucket's shares), per bucket."""
    of_corpus, of_target = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * of_corpus) / float((s + 1) * of_target)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(gain)  # one number a bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = words(part.column("text"), ALPHANUMERIC)
            n = np.diff(found.bound)
            text = found.text_of()
            weight = np.zeros(len(n), np.int64)
            for first, b in buckets(found):
                upto = np.r_[0, np.cumsum(shared.value[b])]
                edge = np.searchsorted(text[first], np.arange(len(n) + 1))
                weight += upto[edge[1:]] - upto[edge[:-1]]
            features = sum(np.maximum(n - k, 0) for k in range(RUN))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    own = text_bytes(docs, F.col(id_col).cast("long").alias("doc_id"))
    return own.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds score: weight plus Gumbel noise in whole thousandths, from a hash
    of seed and doc_id (a null id counts as empty)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def _bracket(rows: DataFrame, column: str, n: int, place: int, error: float) -> tuple[int, int, int, int]:
    """(low, high, rows above high, rows from low to high) of ``column``, whose
    ``place``-th highest of ``n`` values is proven to lie from low to high."""
    while True:
        share = 1 - (place - 0.5) / n
        ends = [max(0.0, share - error), min(1.0, share + error)]
        sketch = F.percentile_approx(column, ends, F.lit(max(100, math.ceil(4 / error)))).alias("q")
        extremes = [F.min(column).alias("least"), F.max(column).alias("most")]
        r = rows.agg(sketch, *extremes).first()
        low = r["least"] if ends[0] == 0 else r["q"][0]
        high = r["most"] if ends[1] == 1 else r["q"][1]
        above, inside = rows.agg(
            F.count_if(F.col(column) > high), F.count_if(F.col(column).between(low, high))
        ).first()
        if above < place <= above + inside:
            return low, high, above, inside
        error *= 4


def cutoff(rows: DataFrame, place: int, bracket_rows: int = BRACKET_ROWS, error: float = SKETCH_ERROR):
    """(score, doc_id) of the ``place``-th row of ``rows`` (score, doc_id) by
    falling score, then rising doc_id; place is 1 or more and at most their
    number.  Brackets are narrowed over scores, and over ids where one score
    ties, until at most ``bracket_rows`` rows are left; rows that repeat score
    and id share one place's key."""
    n = rows.count()
    left = rows.select("score", F.negative("doc_id").alias("back"))
    for column in ("score", "back"):
        at = F.col(column)
        while n > bracket_rows:
            low, high, above, inside = _bracket(left, column, n, place, error)
            if inside == n and low < high:  # the sketch gained nothing: halve the values
                middle = (low + high) // 2
                above = left.where(at > middle).count()
                low, high, above, inside = (middle + 1, high, 0, above) if above >= place else (low, middle, above, n - above)
            left, place, n = left.where(at.between(low, high)), place - above, inside
            if low == high:
                break
    if n > bracket_rows:  # one score and id, repeated
        r = left.first()
        return r["score"], -r["back"]
    r = left.orderBy(F.desc("score"), F.desc("back")).limit(place).agg(F.min(F.struct("score", "back")).alias("m")).first()["m"]
    return r["score"], -r["back"]


def ranked(rows: DataFrame, ranked_rows: int = RANKED_ROWS, count: int | None = None) -> DataFrame:
    """Adds rank, 1 for the highest score, ties to the smaller doc_id.  Rows are
    dealt to sorted ranges; the ranges' sizes (one row each) give the offsets."""
    n = rows.count() if count is None else count
    parts = shard_count(n, ranked_rows, 8)
    order = [F.desc("score"), F.asc("doc_id")]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # partition number above bit 33, place within the partition below
    placed = staged(placed.withColumn("place", F.monotonically_increasing_id()), "resample-drawn")
    part = F.shiftright("place", 33).alias("part")
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a range
    base, offsets = 1, []
    for p in sorted(sizes):
        offsets += [F.lit(p), F.lit(base).cast("long")]
        base += sizes[p]
    offset = F.create_map(*offsets)[F.shiftright("place", 33)] if offsets else F.lit(0).cast("long")
    return placed.withColumn("rank", offset + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("place")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null
    for those not drawn.

    Null texts are empty: no features, weight 0.  Rows that repeat an id are
    documents of their own and share their noise; equal rows take their ranks
    in any order.  Rows without an id get a score and are never drawn.  An
    empty target gives weights by rarity alone.  No rows give no rows.  Further
    columns are ignored."""
    scores = gains(bucket_counts(docs), bucket_counts(target))
    every = staged(with_score(weighted(docs, scores), seed), "resample-scores")
    able = every.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()).select("score", "doc_id")
    draw = able.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not draw:
        return every.select(*out, none)
    score, last = cutoff(able, draw, bracket_rows)
    high = F.col("score") > score
    taken = F.coalesce(
        (F.col("n_words") >= least_words) & (high | ((F.col("score") == score) & (F.col("doc_id") <= last))), F.lit(False)
    ) & F.col("doc_id").isNotNull()
    drawn = ranked(every.where(taken).select(*out), count=draw)
    rank = F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")  # repeats of the last row may go beyond
    return drawn.select(*out, rank).unionByName(every.where(~taken).select(*out, none))


#: DuckDB SQL of the query's rows over the tables documents and benchmark.
SQL = f"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (
   SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
   FROM (SELECT unnest(range(256)) AS i))),
 w AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
       UNION ALL
       SELECT 'b', row_number() OVER (), NULL, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
 p AS (SELECT side, r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)),
 f AS (SELECT side, r, array_to_string(ws[i : i + k - 1], ' ') AS g, count(*) AS n FROM p GROUP BY ALL),
 g AS (SELECT g, xor(list_reduce(
         list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(g))), lambda j: ('0x' || substr(hex(encode(g)), 2 * j + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS b
       FROM (SELECT DISTINCT g FROM f), tab),
 c AS (SELECT b, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM f JOIN g USING (g) GROUP BY b),
 tot AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM c),
 gain AS (SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + {BUCKETS}))::DOUBLE
                  / ((coalesce(s, 0) + 1) * (t_all + {BUCKETS}))::DOUBLE))::BIGINT AS v FROM c, tot),
 wt AS (SELECT r, sum(n * v) AS weight FROM f JOIN g USING (g) JOIN gain USING (b) WHERE side = 'd' GROUP BY r),
 s AS (SELECT doc_id, r, len(ws) AS m, greatest(len(ws), 0) + greatest(len(ws) - 1, 0) + greatest(len(ws) - 2, 0) AS n_features,
              coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
       FROM w LEFT JOIN wt USING (r) WHERE side = 'd'),
 o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM s WHERE m >= {LEAST_WORDS} AND doc_id IS NOT NULL)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= {PERCENT} * able // 100 THEN rank END AS rank
FROM s LEFT JOIN o USING (r)
"""
