"""Helpers shared by the operators: tables in the shared folder, row keys, scratch names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
# the six characters of SPACE, for translate()
SPACE_CHARS = " \t\n\x0b\f\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one operator run, in the shared folder of ``spark.checkpoint.dir``.

    ``write`` cuts the lineage: later stages read the stored table, so a lost
    executor never makes Spark repeat the work above it. ``drop`` deletes a
    table whose readers are done, through Spark's own Hadoop file system.
    With ``tidy`` a write's shuffle files go as soon as it is stored.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.root = scratch_path(spark, name)
        self.n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.parquet(self.save(df, name))

    def save(self, df: DataFrame, name: str) -> str:
        self.n += 1
        path = f"{self.root}/{self.n}-{name}"
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true" if self.tidy else before)
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return path

    def drop(self, df: DataFrame) -> None:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.startswith(self.root) or self.root.split(":", 1)[-1] in path:
                hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have (any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python a thousand at a time, not ten thousand: a session setting the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_hash(text: str) -> Column:
    """64-bit content hash that tells rows with one id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def with_row_key(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, list[str]]:
    """Adds three non-null columns that name a row's (id, text): is the id set, the id, the text's hash."""
    names = fresh(df, "id_set", "id", "text_key")
    ident = F.col(f"`{doc_id}`")
    kind = df.schema[doc_id].dataType
    blank = F.lit("" if kind.simpleString() == "string" else 0).cast(kind)
    values = (ident.isNotNull(), F.coalesce(ident, blank), text_hash(text))
    return df.withColumns(dict(zip(names, values))), names


def row_key(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``with_row_key`` from a table's doc_id and text_key, in place of these."""
    kind = df.schema["doc_id"].dataType
    blank = F.lit("" if kind.simpleString() == "string" else 0).cast(kind)
    return df.select(F.col("doc_id").isNotNull().alias(names[0]), F.coalesce("doc_id", blank).alias(names[1]),
                     F.col("text_key").alias(names[2]), *[c for c in df.columns if c not in ("doc_id", "text_key")])


def first_copy(names: list[str]) -> Column:
    """Number of a row among those that repeat its id and text, from 1."""
    return F.row_number().over(Window.partitionBy(*names).orderBy(names[2]))
