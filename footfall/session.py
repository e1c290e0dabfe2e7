"""Spark session helpers.

The library never creates a session by itself inside operators; callers pass
one in.  ``get_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "footfall", extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the library's settings.  The master and the number of
    shuffle partitions stay as spark-submit or Spark's defaults have them,
    unless an argument or the environment names them."""
    builder = (
        SparkSession.builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # wide snapshot plans (hundreds of aggregate columns)
        .config("spark.sql.codegen.maxFields", "1000")
        # exact medians keep a value map a group: stay with hashing beyond 128 groups a task
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000")
        # remove checkpoint files once their DataFrame is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    master = master or os.environ.get("FOOTFALL_MASTER")
    parts = shuffle_partitions or os.environ.get("FOOTFALL_SHUFFLE_PARTITIONS")
    memory = os.environ.get("FOOTFALL_DRIVER_MEMORY")
    if master:
        builder = builder.master(master)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    event_dir = os.environ.get("FOOTFALL_EVENT_LOG_DIR")
    if event_dir:   # stage/task timings for profiling, written to a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset and the master is local (tests) a scratch
    folder is created; a cluster without the setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    path = tempfile.mkdtemp(prefix="footfall-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds many branches of a plan: the branches
    read the written copy instead of recomputing it, and a lost executor
    costs a re-read, not a replay of the whole upstream plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_written(*written: DataFrame) -> None:
    """Delete the files of tables from ``materialize`` that nothing reads any
    more; tables that it did not write stay as they are."""
    for df in written:
        plan, jvm = df._jdf.queryExecution().analyzed(), df.sparkSession._jvm
        while plan.getClass().getSimpleName() == "Project":
            plan = plan.child()
        if plan.getClass().getSimpleName() != "LogicalRDD" or plan.rdd().getCheckpointFile().isEmpty():
            continue
        path = jvm.org.apache.hadoop.fs.Path(plan.rdd().getCheckpointFile().get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
