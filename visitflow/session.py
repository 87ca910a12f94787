"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings every job relies on: UTC wall clock (the test tables hold
# timestamp_ntz values), ANSI errors instead of silent nulls, and adaptive
# execution so that shuffle sizes, broadcast choices and skewed partitions
# are re-planned from runtime statistics.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even when a later operator then needs one more
    # shuffle: one session may hold a third of all rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply SQL_CONF to an existing session (runtime-settable keys only)."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "visitflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session for local runs, tests and the bench.

    On a cluster the submitter owns master, memory and partition counts; this
    helper only fills what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # checkpoint files of DataFrames that are no longer referenced are deleted
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    and the master is local (tests) a fresh scratch folder is created and
    registered; on a cluster a machine-local folder would be wrong, so an
    unset value is an error there.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)          # conf given at runtime: DataFrame.checkpoint() needs it
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS or object store)")
    path = tempfile.mkdtemp(prefix="visitflow-ckpt-")
    sc.setCheckpointDir(path)          # spark.checkpoint.dir is a core conf: it cannot be set at runtime
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the checkpoint folder for one intermediate table."""
    return f"{scratch_root(spark)}/{name}-{os.getpid()}-{next(_counter)}"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, deleted with all it holds when the driver ends."""
    root = f"{checkpoint_dir(spark)}/visitflow/{spark.sparkContext.applicationId}"
    if root not in _marked:
        _marked.add(root)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return root


_marked: set[str] = set()


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()


def empty_frame(spark: SparkSession, schema: str):
    """An empty DataFrame of ``schema`` as a JVM-side local relation.

    Unlike ``createDataFrame([])`` (a Python RDD scan of unknown size), the
    optimizer sees it is empty and prunes unions and joins against it.
    """
    fields = [f.strip().split() for f in schema.split(",")]
    cols = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in fields)
    return spark.sql(f"SELECT {cols} WHERE 1 = 0")


def small_frame(spark: SparkSession, rows, schema: str):
    """A few parameter rows (e.g. the steps of a page flow) as a local relation."""
    from pyspark.sql import functions as F
    fields = [f.strip().split() for f in schema.split(",")]
    if not rows:
        return empty_frame(spark, schema)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
