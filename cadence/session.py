"""Session construction and the shared scratch folder.

Jobs that must cut lineage or stage intermediate tables write under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is absent (local tests) do we pick a fresh folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(cpus: int | str = "*", app: str = "cadence", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests, bench and tools.  On a cluster the
    submitter's session is used instead and these settings come from it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config(STATE_STORE, ROCKSDB)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext when the session has one (not under Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect sessions expose no context
        return None


def _checkpoint_root(spark: SparkSession) -> str:
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root and sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        # Unset only in local tests: take a private folder and publish it so
        # DataFrame.checkpoint() and our staged tables agree on one place.
        root = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    sc = _context(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.default.parallelism", str(fallback)))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared checkpoint root.

    Each call returns a path that has never been used, so reruns and
    concurrent queries never collide and nothing needs deleting first.
    """
    root = _checkpoint_root(spark).rstrip("/")
    path = f"{root}/cadence/{purpose}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


def read_if_written(spark: SparkSession, path: str, schema: str | None = None):
    """The Parquet table at ``path``, or None if nothing was written there;
    any other failure is raised.  With ``schema`` no file is opened for it."""
    from pyspark.errors import AnalysisException

    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ensure_utc(spark: SparkSession) -> None:
    """Session starts are naive UTC (the wire format carries no zone), so
    timestamp arithmetic runs with the session time zone set to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_rocksdb(spark: SparkSession) -> None:
    """State of ``transformWithState`` needs a store with column families,
    which Spark's default store lacks; streams started from here on use
    RocksDB, those on older checkpoints stay with the store they began with."""
    if spark.conf.get(STATE_STORE, "HDFSBackedStateStoreProvider").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cadence`` importable in the session's Python workers (its Arrow
    UDFs are resolved by module name there): zip the package once per
    application into the shared scratch folder and ``addPyFile`` it — the
    runtime form of ``spark-submit --py-files``.  No-op when already shipped
    or when the session exposes no SparkContext (Spark Connect ships code
    through its own artifact mechanism)."""
    import zipfile

    sc = _context(spark)
    if sc is None:
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = _checkpoint_root(spark)
    if "://" in root and not root.startswith("file:"):
        # remote shared folder: build the archive beside the driver process;
        # addPyFile uploads it to every executor (as --py-files does)
        target = os.path.join(tempfile.mkdtemp(prefix="cadence-pyfiles-"), "cadence.zip")
    else:
        target = os.path.join(scratch_dir(spark, "pyfiles").replace("file:", ""), "cadence.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.join("cadence", os.path.relpath(full, pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
