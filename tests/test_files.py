"""File listing (binaryFile, content pruned) and annotation text scanning."""

import os

from pyspark.sql import functions as F

from cadence.operators.labels import interval_label, label_code
from cadence.session import scratch_dir
from cadence.sources.files import list_files, list_inputs, pair_inputs, read_annotations


def test_listing_and_pairing(spark):
    root = scratch_dir(spark, "tree")
    for rel in ["a/s1/r1.edf", "a/s1/r1.tse", "a/s1/r1.tse_bi", "a/s2/r2.edf", "b/r3.tse", "b/notes.txt", "b/tse_readme.txt"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write("x")
    files = list_files(spark, root)
    assert "content" not in files.columns
    inputs = list_inputs(files)
    kinds = sorted((os.path.basename(r.path), r.kind or "") for r in inputs.collect())
    assert kinds == [("r1.edf", "edf"), ("r1.tse", "tse"), ("r2.edf", "edf"), ("r3.tse", "tse"), ("tse_readme.txt", "")]
    pairs, unmatched = pair_inputs(inputs)
    assert pairs.count() == 1 and unmatched.count() == 2


def test_annotation_scan_and_label_join(spark):
    root = scratch_dir(spark, "ann")
    with open(os.path.join(root, "rec.tse"), "w") as fh:
        fh.write("version = tse_v1.0.0\n\n0.0000 10.0000 bckg 1.0000\n5.0000 8.0000 fnsz 1.0000\n\n7.5 20 gnsz 1.0\n")
    ann = read_annotations(spark, root)
    rows = ann.orderBy("line_key").collect()
    assert [(r.beg, r.end, r.label) for r in rows] == [(0.0, 10.0, "bckg"), (5.0, 8.0, "fnsz"), (7.5, 20.0, "gnsz")]
    a = ann.withColumn("recording_id", F.lit(1)).withColumn("line_no", F.col("line_key")).withColumn("code", label_code(F.col("label")))
    times = spark.createDataFrame([(1, i, float(t)) for i, t in enumerate([0, 5, 7.5, 8, 9, 20, 21])], "recording_id int, event_id int, t double")
    got = {r.event_id: r.code for r in interval_label(times, a, bucket_s=4.0).collect()}
    assert got == {0: 6, 1: 8, 2: 9, 3: 9, 4: 9, 5: 9, 6: 0}


def test_tile_store_layouts(spark):
    from cadence.sources.sinks import write_tiles

    df = spark.range(0, 1000).select((F.col("id") % 7).alias("recording_id"), F.col("id").alias("v"))
    per_rec = spark.read.parquet(write_tiles(df, scratch_dir(spark, "tiles-a")))
    bucketed = spark.read.parquet(write_tiles(df, scratch_dir(spark, "tiles-b"), buckets=3))
    assert per_rec.count() == bucketed.count() == 1000
    assert bucketed.select("tile_bucket").distinct().count() <= 3
    assert sorted(r.v for r in bucketed.where("recording_id = 5").collect()) == list(range(5, 1000, 7))


def test_interval_label_does_not_depend_on_bucket_width(spark):
    import __spark_entry__  # noqa: F401  (repo root on the path)
    from cadence.plans import bindings as B

    sf = "/root/testdata/sf0.001"
    times, ann = B.label_times(spark, sf), B.annotations(spark, sf)
    base = {(r.event_id, r.code) for r in interval_label(times, ann, bucket_s=21600.0).collect()}
    for width in (None, 500.0, 86400.0 * 40):
        assert {(r.event_id, r.code) for r in interval_label(times, ann, bucket_s=width).collect()} == base


def test_annotation_folders_are_listed_by_few_tasks(spark):
    """A task a folder made listing dearer than reading; the setting is put back."""
    from cadence.session import default_parallelism
    from cadence.sources import files as f

    ann = spark.range(400).selectExpr("CAST(id AS STRING) file", "id line_no", "id * 1.0D beg", "id + 1.5D `end`", "'fnsz' label")
    path = f.write_annotation_files(f.render_annotations(ann), scratch_dir(spark, "test-annotations"))
    before = spark.conf.get(f.LIST_TASKS, None)
    spark.sparkContext.setJobGroup("list-annotations", "listing")
    try:
        back = f.read_annotations(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker()
    tasks = [jobs.getStageInfo(s).numTasks for j in jobs.getJobIdsForGroup("list-annotations") for s in jobs.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 4 * default_parallelism(spark)
    assert spark.conf.get(f.LIST_TASKS, None) == before
    assert back.count() == 400
