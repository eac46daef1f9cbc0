"""File-based inputs of the training path.

Listing uses the ``binaryFile`` source with ``content`` pruned, so only paths
and sizes are read; annotation text is read line by line with the file name
from ``_metadata`` (no per-file Python, no whole-file rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import default_parallelism

LIST_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` (recursive): (path, length)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )


def list_inputs(paths: DataFrame, path: str = "path") -> DataFrame:
    """Keep names containing ``tse`` or ``.edf`` but not ``tse_bi``;
    ``kind`` is ``edf`` for names with ``.edf`` (recordings), ``tse`` for
    names with ``.tse`` (annotation files), NULL for the rest of the listing."""
    p = F.col(path)
    keep = (p.contains("tse") | p.contains(".edf")) & ~p.contains("tse_bi")
    kind = F.when(p.contains(".edf"), F.lit("edf")).when(p.contains(".tse"), F.lit("tse"))
    return paths.where(keep).withColumn("kind", kind)


def path_stem(path: Column) -> Column:
    """File name without folder and extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def pair_inputs(inputs: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(pairs, unmatched) — recordings joined to annotation files on the
    folder + stem (not on list position); unmatched rows of either side."""
    key = F.concat_ws("/", F.regexp_replace(F.col(path), r"/[^/]*$", ""), path_stem(F.col(path)))
    edf = inputs.where(F.col("kind") == "edf").select(key.alias("stem"), F.col(path).alias("edf_path"))
    tse = inputs.where(F.col("kind") == "tse").select(key.alias("stem"), F.col(path).alias("tse_path"))
    pairs = edf.join(tse, "stem", "inner")
    unmatched = edf.join(tse, "stem", "left_anti").select("stem", F.col("edf_path").alias("path")).unionByName(
        tse.join(edf, "stem", "left_anti").select("stem", F.col("tse_path").alias("path"))
    )
    return pairs, unmatched


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """S9 + P10: annotation text files → (file, line_key, beg, end, label).

    Lines holding ``version`` and blank lines are skipped; fields are split on
    whitespace, the first three used.  ``line_key`` orders lines within a file
    (block start, then position inside the split) for "later line wins"."""
    raw = _listed_text(spark, path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    lines = annotation_lines_only(raw)
    f = F.split(F.trim(F.col("value")), r"\s+")
    return lines.select(
        "file",
        F.struct("_blk", "_pos").alias("line_key"),
        F.expr("try_cast(try_element_at(split(trim(value), '\\\\s+'), 1) AS DOUBLE)").alias("beg"),
        F.expr("try_cast(try_element_at(split(trim(value), '\\\\s+'), 2) AS DOUBLE)").alias("end"),
        F.try_element_at(f, F.lit(3)).alias("label"),
    )


def _listed_text(spark: SparkSession, path: str) -> DataFrame:
    """The text files below ``path``, their folders listed by a few tasks a
    core; Spark's own choice is a task a folder, up to 10,000."""
    before = spark.conf.get(LIST_TASKS, None)
    spark.conf.set(LIST_TASKS, str(4 * default_parallelism(spark)))
    try:
        return spark.read.text(path)
    finally:
        if before is None:
            spark.conf.unset(LIST_TASKS)
        else:
            spark.conf.set(LIST_TASKS, before)


def annotation_lines_only(df: DataFrame, value: str = "value") -> DataFrame:
    """P10: drop ``version`` lines and blank lines."""
    v = F.col(value)
    return df.where(~v.contains("version") & (F.trim(v) != ""))


def render_annotations(ann: DataFrame) -> DataFrame:
    """Annotation rows → text lines in the annotation-file layout
    ``beg end label probability`` (6 decimals), plus the ``version`` header
    line and a blank line per file; ordered by ``order`` within ``file``."""
    body = ann.select(
        "file",
        F.col("line_no").cast("double").alias("o"),
        F.format_string("%.6f %.6f %s 1.0000", F.col("beg"), F.col("end"), F.col("label")).alias("value"),
    )
    files = ann.select("file").distinct()
    head = files.select("file", F.lit(-2.0).alias("o"), F.lit("version = tse_v1.0.0").alias("value"))
    blank = files.select("file", F.lit(-1.0).alias("o"), F.lit("").alias("value"))
    return head.unionByName(blank).unionByName(body)


def write_annotation_files(lines: DataFrame, path: str) -> str:
    """One text file per ``file`` key (folder ``file=<key>``), lines sorted.
    A file's lines meet in one task because the format is one text file per
    recording; annotation files are small (a line per labelled interval)."""
    (
        lines.repartition("file")
        .sortWithinPartitions("file", "o")
        .select("file", "value")
        .write.mode("append")
        .partitionBy("file")
        .text(path)
    )
    return path


def channels_like(frames: DataFrame, token: str = "EEG") -> DataFrame:
    """P8 on sample-major frames: keep the channels whose name contains
    ``token``; adds ``kept_channels`` and narrows ``samples`` to them."""
    C = F.col("num_channels")
    names = F.col("channel_names")
    keep = lambda v, i: F.coalesce(F.try_element_at(names, (F.pmod(i, C) + 1).cast("int")).contains(token), F.lit(False))
    return frames.withColumn("kept_channels", F.filter(names, lambda n: n.contains(token))).withColumn(
        "samples", F.filter(F.col("samples"), keep)
    )


def _record_offset(rec: DataFrame, start_col: str | None) -> Column:
    return F.col(start_col).cast("long") if start_col and start_col in rec.columns else F.lit(0).cast("long")


def recordings_to_samples(rec: DataFrame, start_col: str | None = "block_start") -> DataFrame:
    """Channel-major rows (recording_id, channel, samples[, block_start])
    → sample-major rows (recording_id, sample_idx, values in channel order).

    A recording may arrive as data records — one row per (channel, record)
    with ``block_start`` = index of its first sample — so no row ever holds a
    whole long channel.  The shuffle regroups whole records: one group per
    (recording, record) holding its C channel arrays, transposed in place and
    exploded to samples after the exchange."""
    off = _record_offset(rec, start_col)
    g = rec.select("recording_id", "channel", off.alias("_o"), "samples").groupBy("recording_id", "_o").agg(
        F.array_sort(F.collect_list(F.struct("channel", "samples"))).alias("_chs")
    )
    n = F.aggregate(F.transform("_chs", lambda c: F.size(c["samples"])), F.lit(0), lambda a, x: F.greatest(a, x))
    by_sample = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.transform(F.col("_chs"), lambda c: F.try_element_at(c["samples"], i + 1)),
    )
    rows = g.select("recording_id", "_o", F.posexplode(F.when(n > 0, by_sample)).alias("_j", "values"))
    return rows.select("recording_id", (F.col("_o") + F.col("_j")).cast("long").alias("sample_idx"), "values")


def recordings_long(rec: DataFrame, start_col: str | None = "block_start") -> DataFrame:
    """Channel-major recordings (whole channels or data records with
    ``block_start``) → long (recording_id, channel, sample_idx, value)."""
    off = _record_offset(rec, start_col)
    return rec.select(
        "recording_id", "channel", "channel_label", "sampling_rate", off.alias("_o"), F.posexplode("samples").alias("_j", "value")
    ).select("recording_id", "channel", "channel_label", "sampling_rate", (F.col("_o") + F.col("_j")).cast("long").alias("sample_idx"), "value")
