"""Session handling (C9): one session, master only when unset, UTC, AQE on, UI off."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "tidepool", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating one if needed.

    ``master`` is only applied when neither the caller's environment
    (``spark-submit``) nor an existing session has chosen one.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is None and "PYSPARK_SUBMIT_ARGS" not in os.environ and \
            "SPARK_MASTER" not in os.environ:
        master = "local[*]"
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the whole cluster; Spark's 1g default starves 8 tasks
            builder = builder.config("spark.driver.memory", os.environ.get("TIDEPOOL_DRIVER_MEMORY", "4g"))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever submits the job (a shared,
    durable filesystem).  Only a local-mode session (tests, the bench) gets a
    scratch folder of its own when the setting is missing.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for a written intermediate table."""
    import uuid
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def files_for(spark: SparkSession, rows: int, rows_a_file: int) -> int:
    """Files to write ``rows`` rows in: of at most about ``rows_a_file`` rows, in as many whole rounds of all cores as that takes."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return cores * max(1, -(-rows // (rows_a_file * cores)))


def materialize(df, name: str, files: int | None = None):
    """Cut lineage by writing ``df`` once as a Parquet table under the checkpoint
    folder and reading it back.

    One computation (an eager ``checkpoint()`` runs the plan twice: once to
    count, once to write), durable on executor loss, and the read-back is
    split into as many tasks as its files.

    ``files``: at most so many, whatever the number of shuffle partitions; see
    ``files_for``.  For each file and its checksum Hadoop's local file system
    starts a process (chmod), which until it runs shares, and counts, the whole
    memory of the executor.
    """
    path = scratch_path(df.sparkSession, name)
    if files:
        df = df.coalesce(files)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Batches of at most 16 MB between the JVM and Python where the session sets no bound of its own: rows here are
    whole texts, and a task holds several batches and their copies outside the heap.  Spark reads the setting when a
    plan runs, so it stays with the session; one that has chosen any value, in any spelling, keeps it."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "16777216b")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidepool`` importable in Python workers (``mapInPandas`` steps).

    Zips the package once per application and registers it with
    ``SparkContext.addPyFile``, which distributes it to every executor (the
    same as ``--py-files`` at submit time).  A no-op when the application
    already ships it.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tidepool-pyfiles-"), "tidepool.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
