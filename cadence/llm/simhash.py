"""SimHash near-duplicates by segment popcounts.

Fingerprints are 64-bit majority votes over the XXH64 (seed 42) of word
shingles.  A fingerprint is embedded as 32 counts, the set bits of each
two-bit segment; the Manhattan distance of two embeddings never exceeds the
Hamming distance of the fingerprints.  The counts are kept as a thermometer
code (0 → 00, 1 → 01, 2 → 11), so one ``bit_count`` of an XOR is the Manhattan
distance.

Range join on the grid of embeddings: the 32 axes form ``GROUPS`` equal
groups; within Manhattan distance d at most d groups differ, so two linked
fingerprints share a cell (equal counts) on at least one choice of
GROUPS - d groups.  Pairs of a cell pass the Manhattan bound, then the exact
Hamming test.

A cell may hold thousands of fingerprints (a large group of near copies), and
its pairs are never enumerated: (1) every member of a cell is tested against a
few pivots of the cell (linear), the verified links are contracted to classes;
(2) only cells that still hold two or more classes remain, and there only
members outside the cell's largest class are compared with the other classes.
Any link between two classes has such a member, so no link is lost.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cadence.llm.common import prepared, shard_count, staged, text_or_empty
from cadence.llm.components import components

SHINGLE = 4
MAX_BITS = 4
GROUPS = 8
SEED = 42
PIVOTS = 3
#: Names of crowded cells (8 bytes each) that are sent to every task; more are joined by shuffle.
BROADCAST_CELLS = 1_000_000
#: Fingerprints a task expands to cells: each makes 70 rows that hardly combine
#: in the task, so its table grows with them (some 100 bytes a row).
SPREAD = 16_384
_LOW = 0x5555555555555555


def _vote(data: bytes, shingle: int) -> int:
    """Fingerprint of UTF-8 bytes; whole text, in blocks of shingles."""
    words = data.lower().split()  # bytes: lowers A-Z only, splits on the ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(shingle, len(words))
    start, end = start[: len(words) - k + 1], end[k - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(start), 8192):
        h = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(start[at : at + 8192].tolist(), end[at : at + 8192].tolist())],
            dtype="<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    f = sum(1 << i for i, on in enumerate((2 * ones > len(start)).tolist()) if on)
    return f - (1 << 64) if f >= 1 << 63 else f


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf(LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([_vote(bytes(t), shingle) for t in texts], dtype="int64")

    return fingerprint


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """Adds the signed 64-bit fingerprint of ``text`` (null counts as empty; no words: 0)."""
    prepared(docs.sparkSession)
    return docs.withColumn(out, fingerprint_udf(shingle)(text_or_empty().cast("binary")))


def thermometer(col):
    """32 two-bit segment counts as a thermometer code in one long."""
    low = F.lit(_LOW)
    hi = F.shiftrightunsigned(col, 1).bitwiseAND(low)
    lo = col.bitwiseAND(low)
    return hi.bitwiseOR(lo).bitwiseOR(F.shiftleft(hi.bitwiseAND(lo), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def cells(fps: DataFrame, max_bits: int, groups: int = GROUPS) -> DataFrame:
    """One row (cell, fp) per fingerprint and choice of groups.  A cell's
    name hashes the choice and the counts on it; two cells that share a name
    by accident only add tests, never links."""
    if not 0 <= max_bits < groups or 64 % groups:
        raise ValueError("need max_bits < groups, groups dividing 64")
    width = 64 // groups
    one = (1 << width) - 1
    masks = [
        _signed(sum(one << (g * width) for g in chosen))
        for chosen in itertools.combinations(range(groups), groups - max_bits)
    ]
    code = fps.select("fp", thermometer(F.col("fp")).alias("code"))
    picked = code.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    return picked.select(F.xxhash64("mask", F.col("code").bitwiseAND(F.col("mask"))).alias("cell"), "fp")


def _close(a, b, max_bits: int):
    """The Manhattan distance of the embeddings bounds, the Hamming distance decides."""
    return (F.bit_count(thermometer(a).bitwiseXOR(thermometer(b))) <= max_bits) & (
        F.bit_count(a.bitwiseXOR(b)) <= max_bits
    )


def spread(fps: DataFrame) -> DataFrame:
    """Some ``SPREAD`` rows a task; fingerprints are so small that a file of
    them, one task, holds hundreds of thousands."""
    return fps.repartition(shard_count(fps.count(), SPREAD), "fp")


def link_classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fps: (fp, rep), fp distinct.  Returns (node, component) over the reps
    of every class that has a link."""
    every = cells(spread(fps), max_bits)
    # one grouped pass: cells of one member link nothing, cells of two are
    # their smallest and largest, only larger ones are listed
    size = staged(
        every.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .where((F.col("n") > 2) | ((F.col("n") == 2) & _close(F.col("lo"), F.col("hi"), max_bits))),
        "simhash-cells",
    )
    pairs = size.where("n = 2")
    crowd = size.where("n > 2").select("cell")
    few_cells = crowd.count() <= BROADCAST_CELLS
    held = staged(every.join(F.broadcast(crowd) if few_cells else crowd, "cell", "left_semi"), "simhash-members")
    # pivots of a cell: its smallest members under a few fixed scrambles, by
    # grouped minima (pre-aggregated, whatever the cell's size)
    pivots = (
        held.groupBy("cell")
        .agg(*[F.min_by("fp", F.xxhash64("fp", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)])
        .select("cell", F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("ps"))
    )
    near = held.join(pivots, "cell").select(
        "fp", F.explode(F.filter("ps", lambda p: (p != F.col("fp")) & _close(p, F.col("fp"), max_bits))).alias("p")
    )
    of = lambda links, a, b: (  # noqa: E731  from fingerprints to their reps
        links.select(F.col(a).alias("fp"), F.col(b).alias("other"))
        .distinct()
        .join(fps, "fp")
        .select(F.col("rep").alias("a"), F.col("other").alias("fp"))
        .join(fps, "fp")
        .select("a", F.col("rep").alias("b"))
    )
    first = staged(of(pairs, "lo", "hi").unionByName(of(near, "fp", "p")), "simhash-links")
    known = staged(components(first), "simhash-classes")
    classes = fps.join(known, fps.rep == known.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("cls")
    )
    classed = held.join(classes, "fp").select("cell", "fp", "cls")
    # what still lies in a cell with another class: few beside the largest class
    tally = classed.groupBy("cell", "cls").agg(F.count(F.lit(1)).alias("k"))
    mixed = (
        tally.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("classes"), F.max_by("cls", F.struct("k", "cls")).alias("largest"))
        .where("classes > 1")
        .select("cell", "largest")
    )
    apart = staged(classed.join(mixed, "cell").select("cell", "fp", "cls", "largest"), "simhash-open")
    few, rest = apart.where("cls <> largest").alias("x"), apart.alias("y")
    late = few.join(
        rest,
        (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.cls") != F.col("y.cls"))
        & _close(F.col("x.fp"), F.col("y.fp"), max_bits),
    )
    late = late.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    return components(first.unionByName(late))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id"
) -> DataFrame:
    """(id_col, fp, component_id); component_id is the smallest id linked to it.

    Null text counts as empty; empty texts share fingerprint 0 and link like
    any other.  Rows that repeat an id stay, each with its own fingerprint, in
    one class (the id is the node).  Rows without an id get a fingerprint and
    a null component_id.  Further columns are ignored; no rows give no rows."""
    fp = docs.select(F.col(id_col).cast("long").alias("id"), "text")
    fp = staged(with_fingerprint(fp, shingle).select("id", "fp"), "simhash-fp")
    named = fp.where("id is not null")
    fps = staged(named.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-distinct")
    found = link_classes(fps, max_bits)
    # an id that occurs with several fingerprints ties their classes
    held = named.join(fps, "fp").select("id", "rep").distinct()
    ties = held.groupBy("id").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = ties.join(held, "id").select("a", F.col("rep").alias("b"))
    found = staged(found, "simhash-found")
    if ties.limit(1).count():
        links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties)
        found = staged(components(links), "simhash-found")
    label = fps.join(found, fps.rep == found.node, "left").select(
        F.col("fp"), F.coalesce("component", "rep").alias("component_id")
    )
    out = fp.join(label, "fp", "left")
    return out.select(
        F.col("id").alias(id_col),
        "fp",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row (all columns of ``docs``) of every group of linked texts: the one
    of the smallest id, rows without an id last, ties to the smaller row.
    Groups go by texts, not ids: of rows that share an id with unrelated texts
    each stays if it is the first of its own group."""
    fp = staged(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), shingle).select("id", "fp"), "simhash-fp")
    fps = staged(fp.select("fp").distinct().withColumn("rep", F.col("fp")), "simhash-distinct")
    linked = staged(link_classes(fps, max_bits), "simhash-found")
    classes = fps.join(linked, fps.rep == linked.node, "left").select("fp", F.coalesce("component", "rep").alias("cls"))
    classes = staged(classes, "simhash-classes")
    of_row = fp.join(classes, "fp").select("id", "cls")
    first = of_row.groupBy("cls").agg(F.min("id").alias("first"))  # null: no row of the class has an id
    first = staged(first, "simhash-first")
    marked = of_row.join(first, "cls")
    gone = marked.where("id is not null and id <> first").select(F.col("id").alias("gone"))
    # rows whose id does not tell them apart are decided by their own fingerprint
    twice = fp.where("id is not null").groupBy("id").count().where("count > 1").select(F.col("id").alias("gone"))
    out = staged(gone.unionByName(twice).distinct(), "simhash-gone")
    own = docs.withColumn("row", F.struct(*docs.columns)).select("row", F.col("doc_id").cast("long").alias("id"), "text")
    kept = own.where("id is not null").join(out, own["id"] == out["gone"], "left_anti").select("row.*")
    unclear = staged(twice, "simhash-twice").withColumnRenamed("gone", "twice")
    rest = own.join(unclear, own["id"] == unclear["twice"], "left_semi").unionByName(own.where("id is null"))
    if not rest.limit(1).count():
        return kept
    own_class = with_fingerprint(rest, shingle).join(classes, "fp").join(first, "cls")
    chosen = own_class.where(F.col("id").eqNullSafe(F.col("first"))).groupBy("cls").agg(F.min("row").alias("row"))
    return kept.unionByName(chosen.select("row.*"))
