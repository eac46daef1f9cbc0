"""Annotation labels: label → code (P9), interval label join (J2), class
counts (A2).

The interval join is a sweep.  A time point t takes the code of every
annotation with beg ≤ t ≤ end, the latest line winning.  Annotations are first
flattened into disjoint pieces that carry the winning line; a point then takes
the last piece that begins at or before it, a running maximum over points and
pieces in time order.  No point meets more than its one piece, nothing is
aggregated per point, and the rows of a long recording are swept in many
ordered ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators.ordinal import position_within, running_max_within
from cadence.schemas import BACKGROUND_CODE, LABEL_CODES, UNLABELLED


def label_code(label: Column) -> Column:
    """Upper-cased label → class code; unknown labels → NULL (to be
    quarantined; the reference raised KeyError)."""
    pairs = []
    for name, code in LABEL_CODES.items():
        pairs += [F.lit(name), F.lit(code)]
    return F.try_element_at(F.create_map(*pairs), F.upper(F.trim(label))).cast("int")


BAND = 6  # tree levels per join: a node meets at most 2^BAND rows


def _ends(annotations: DataFrame, key: str, code: str) -> DataFrame:
    """Begins (``_side`` 0) and ends (2) of the lines that cover anything."""
    ann = annotations if code in annotations.columns else annotations.withColumn(code, label_code(F.col("label")))
    ann = ann.select(key, "line_no", F.col(code).alias("_code"), F.col("beg").cast("double").alias("beg"), F.col("end").cast("double").alias("end"))
    ends = F.explode(F.array(F.struct(F.col("beg").alias("_t"), F.lit(0).alias("_side")), F.struct(F.col("end").alias("_t"), F.lit(2).alias("_side"))))
    return ann.dropna().where("beg <= end").select("*", ends.alias("_e")).select("*", "_e.*").drop("_e")


def flatten_intervals(annotations: DataFrame, key: str = "recording_id", code: str = "code") -> DataFrame:
    """Disjoint pieces of overlapping intervals: (key, ``_t``, ``_side``,
    ``_r``, ``win``).  Piece ``_r`` of a recording begins at ``_t`` itself
    (``_side`` 0) or right behind it (2) and lasts until piece ``_r`` + 1;
    ``win`` is (line_no, code) of the largest line that covers it, NULL when
    none does.  Lines without key, code, line number or times, or with end
    before beg, cover nothing; of equal line numbers the larger code wins.

    The begins and ends of a recording are numbered in time order, so a line
    covers a range of numbers.  The range is cut into nodes of a binary tree
    (at most two a level, as many levels as the line spans binary digits), the
    winner is taken per node, and a piece takes the winner of its ancestors,
    ``BAND`` levels a join.  n lines cost n·log(overlap) rows whatever their
    lengths, and no key of a join holds more than 2^BAND rows."""
    ranked = position_within(_ends(annotations, key, code), [key], ["_t", "_side", "line_no", "_code", "beg", "end"], "_r")
    spans = ranked.groupBy(key, "line_no", "_code", "beg", "end").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"))
    spans = spans.withColumn("_top", F.length(F.bin(F.col("_hi") - F.col("_lo"))) - 1)
    top = spans.agg(F.max("_top").alias("m")).first()["m"] or 0

    level = spans.select(key, "line_no", "_code", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("_l"))
    level = level.withColumn("_lo", F.expr("shiftright(_lo + shiftleft(1L, _l) - 1, _l)")).withColumn("_hi", F.expr("shiftright(_hi, _l)"))
    odd = lambda c: F.pmod(c, F.lit(2)) == 1
    at = F.array(F.when(odd(F.col("_lo")), F.col("_lo")), F.when(odd(F.col("_hi")), F.col("_hi") - 1))
    nodes = level.where("_lo < _hi").select(key, "_l", F.explode(at).alias("_u"), F.struct("line_no", F.col("_code").alias("code")).alias("_win"))
    nodes = nodes.where(F.col("_u").isNotNull()).groupBy(key, "_l", "_u").agg(F.max("_win").alias("_win"))

    above = None
    for first in range(top // BAND * BAND, -1, -BAND):
        rows = ranked.select(key, F.shiftright("_r", first).alias("_p")).distinct() if first else ranked.select(key, "_t", "_side", F.col("_r").alias("_p"))
        own = [c for c in rows.columns]
        steps = rows.select("*", F.explode(F.sequence(F.lit(first), F.lit(min(first + BAND - 1, top)))).alias("_l"))
        steps = steps.withColumn("_u", F.expr(f"shiftright(_p, _l - {first})"))
        won = steps.join(nodes, [key, "_l", "_u"], "left").groupBy(*own).agg(F.max("_win").alias("win"))
        if above is not None:
            won = won.withColumn("_up", F.shiftright("_p", BAND)).join(above, [key, "_up"], "left")
            won = won.select(*own, F.greatest("win", "_above").alias("win"))
        above = won.select(key, F.col("_p").alias("_up"), F.col("win").alias("_above"))
    return won.withColumnRenamed("_p", "_r")


def interval_label(
    times: DataFrame,
    annotations: DataFrame,
    key: str = "recording_id",
    ids: tuple[str, ...] = ("event_id",),
    t: str = "t",
    bucket_s: float | None = None,
    code: str = "code",
) -> DataFrame:
    """Every row of ``times`` with ``code`` = code of the annotation
    covering ``t`` (beg ≤ t ≤ end, inclusive) with the largest ``line_no``;
    0 when none covers it, and for rows without key or time.  Repeated rows
    stay repeated.

    The result does not depend on ``bucket_s``, the width of the time ranges
    in which a recording is swept.  When not given, only recordings of more
    than ``ordinal.ROWS_PER_BUCKET`` rows are swept in ranges."""
    pieces = flatten_intervals(annotations, key, code)
    x = F.col(t).cast("double")
    known = x.isNotNull() & ~F.isnan(x)
    marks = pieces.select(key, "_t", "_side", "_r", F.struct("_r", F.col("win.code").alias("code")).alias("_piece"))
    marks = marks.withColumn("_row", F.lit(None).cast(times.select(F.struct("*")).schema[0].dataType))
    points = times.select(
        F.col(key),
        F.when(known, x).alias("_t"),
        F.lit(1).alias("_side"),
        F.lit(None).cast("long").alias("_r"),
        F.lit(None).cast(marks.schema["_piece"].dataType).alias("_piece"),
        F.struct(*times.columns).alias("_row"),
    )
    pid = None if bucket_s is None else F.coalesce(F.floor(F.col("_t") / bucket_s).cast("long"), F.lit(-(1 << 63)))
    like = _ends(annotations, key, code).select(key, "_t").unionByName(points.select(key, "_t"))
    swept = running_max_within(marks.unionByName(points), [key], ["_t", "_side", "_r"], "_piece", "_last", pid, like=like)
    return swept.where("_side = 1").select("_row.*", F.coalesce(F.col("_last.code"), F.lit(UNLABELLED)).cast("int").alias(code))


def class_counts(annotations: DataFrame, key: str = "recording_id", code: str = "code") -> DataFrame:
    """A2: background vs seizure annotation lines per recording; a line whose
    label is unknown is no background line."""
    c = F.col(code) if code in annotations.columns else label_code(F.col("label"))
    background = F.coalesce(c == BACKGROUND_CODE, F.lit(False))
    return annotations.groupBy(key).agg(
        F.count_if(background).alias("n_background"),
        F.count_if(~background).alias("n_seizure"),
    )


def split_unknown(annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines with a known label and its ``code``, quarantined lines whose
    label is missing or unknown)."""
    coded = annotations.withColumn("code", label_code(F.col("label")))
    return coded.where(F.col("code").isNotNull()), coded.where(F.col("code").isNull()).drop("code")
