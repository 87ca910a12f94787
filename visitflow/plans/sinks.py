"""Result-table writers (K1-K7) and intermediate tables.

Result tables carry ``taskid`` first and have one folder per task; a job
overwrites its own, so rerunning a task replaces its rows and leaves other
tasks untouched (the reference appends, duplicating on rerun).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..session import scratch_path, scratch_root


def write_result(df: DataFrame, out_dir: str, table: str, task_id: int, fmt: str = "parquet",
                 options: dict[str, str] | None = None) -> str:
    """Write one result table of a task; ``taskid`` comes first, as in the reference's tables.

    File formats (parquet, orc, json, csv) get one folder per table, partitioned
    by taskid; the task's own partition is overwritten. ``fmt="jdbc"`` appends to the database
    table ``table`` through Spark's JDBC writer (``options``: url, user,
    password, driver), the reference's own sink.
    """
    if fmt == "jdbc":
        rows = df.select(F.lit(task_id).cast("bigint").alias("taskid"), *df.columns)
        rows.write.format("jdbc").options(**(options or {})).option("dbtable", table).mode("append").save()
        return table
    path = f"{out_dir.rstrip('/')}/{table}"
    # one folder per task: an empty result still leaves its columns there
    df.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{path}/taskid={int(task_id)}")
    return path


def write_results(outputs: dict[str, DataFrame], out_dir: str, task_id: int, fmt: str = "parquet",
                  options: dict[str, str] | None = None) -> dict[str, str]:
    """Writes a task's result tables together: all of them are replaced, or none.

    The tables are independent Spark jobs, run from one driver thread each,
    into a pending folder beside the results. Only when every one of them is
    written do they take their places, by renames of the file system. A failed
    table leaves the earlier results as they were. ``fmt="jdbc"`` appends, as
    the database's own transactions end with each table.
    """
    if fmt == "jdbc":
        return {name: write_result(df, out_dir, name, task_id, fmt, options) for name, df in outputs.items()}
    out_dir = out_dir.rstrip("/")
    pending = f"{out_dir}/_pending/{int(task_id)}-{uuid.uuid4().hex}"
    spark = next(iter(outputs.values())).sparkSession
    try:
        with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
            jobs = [pool.submit(df.write.format(fmt).options(**(options or {})).mode("overwrite").save, f"{pending}/{name}")
                    for name, df in outputs.items()]
            for job in jobs:
                job.result()
        for name in outputs:
            files.publish(spark, f"{pending}/{name}", f"{out_dir}/{name}", f"taskid={int(task_id)}")
        return {name: f"{out_dir}/{name}" for name in outputs}
    finally:
        files.delete(spark, pending)


def write_task_results(outputs: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                       options: dict[str, str] | None = None) -> dict[str, str]:
    """Result tables of many tasks at once: each ``task_id`` replaces its own folder (dynamic partition overwrite)."""
    if fmt == "jdbc":
        raise ValueError("results of many tasks go to files")
    out = {}
    for name, df in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        (df.withColumnRenamed("task_id", "taskid").write.format(fmt).options(**(options or {})).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("taskid").save(path))
        out[name] = path
    return out


def read_result(spark: SparkSession, out_dir: str, table: str, task_id: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Rows of a result table, ``taskid`` first (on disk it is the folder's column, which Spark puts last)."""
    df = spark.read.format(fmt).load(f"{out_dir.rstrip('/')}/{table}")
    df = df.select(F.col("taskid").cast("bigint").alias("taskid"), *[c for c in df.columns if c != "taskid"])
    return df if task_id is None else df.where(F.col("taskid") == F.lit(task_id))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written table, not
    from the raw scan) and lets several outputs share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a materialized intermediate, through Spark's own Hadoop file system.

    Its readers must be done. Only folders that ``materialize`` wrote are deleted.
    """
    spark = df.sparkSession
    base = scratch_root(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base.split(":", 1)[-1].lstrip("/") in folder:
            files.delete(spark, folder)
