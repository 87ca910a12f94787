"""Ad-click stream (T1-T5): log lines -> blacklist, per-user counts, ad stat, top 3, trend.

Two streaming queries share the parsed click stream (T1):

* the **state stream** works in ``foreachBatch``: the blacklist is re-read for
  every micro-batch (T5); counts (T4) and ad stat (T3) get the batch's
  increments, each touched province its new top 3, the blacklist its new users;
* the **trend stream** is a native windowed aggregation in Spark's RocksDB state
  store: watermark, 1-minute tumbling windows, update mode. The windows that
  changed are appended with their counts so far (T2).

Nothing stored is ever rewritten by a batch. A table is a Parquet folder
``<table>/batch=<n>/date=<d>``; a batch writes its own ``batch=<n>`` and the tables
are read as aggregates over it: sums of increments, the largest count so far,
the latest top 3. The only record beside the data is the number of the last
whole batch. A batch that failed half-way has the next number again, so
its leftovers are overwritten (exactly once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import files
from ..operators.ads import (PROVINCE_KEYS, STAT_KEYS, STATE_SCHEMAS, TREND_KEYS, USER_KEYS, AdState, ad_stat, click_cells,
                             new_blacklisted, parse_log, top3_updates, user_click_counts, without_blacklisted)
from ..plans.sinks import discard, materialize
from ..session import checkpoint_dir, empty_frame

TREND_SCHEMA = "date string, hour string, minute string, ad_id bigint, click_count bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class BatchTables:
    """Append-only tables below ``root`` and the number of their last whole batch.

    ``_commits`` holds one empty file, ``<number>-<generation>-<batch id>``: the last
    commit. ``_owner`` names the stream checkpoint whose batches these are.
    """

    schemas: dict[str, str] = {}

    def __init__(self, spark: SparkSession, root: str, owner: str | None = None):
        self.spark, self.root, self.owner = spark, root.rstrip("/"), owner

    # -- commits -------------------------------------------------------------
    def _last(self) -> tuple[int, int, int | None]:
        """(number, generation, batch id) of the last whole batch; number 0 before the first."""
        found = [tuple(int(x) for x in n.split("-")) for n in files.names(self.spark, f"{self.root}/_commits")]
        return max(found) if found else (0, 0, None)

    def last_commit(self) -> int | None:
        """The newest committed batch id."""
        return self._last()[2]

    def admit(self, batch_id: int) -> bool:
        """True for a new batch of this state's own source, False for a replay of a committed one.

        Batch ids only mean something together with the checkpoint that
        numbered them. A batch of another checkpoint, and a plain batch whose
        id was used before, would be taken for a replay and vanish: both raise.
        """
        last = self.last_commit()
        if last is None:
            return True
        owner = files.read_text(self.spark, f"{self.root}/_owner") or None
        if owner != self.owner:
            raise RuntimeError(f"state {self.root} belongs to the batches of {owner or 'plain calls'}, "
                               f"not of {self.owner or 'plain calls'}")
        if batch_id > last:
            return True
        if self.owner is None:
            raise ValueError(f"batch {batch_id} is not after the last committed batch {last} of {self.root}")
        return False

    def _commit(self, number: int, generation: int, batch_id: int) -> None:
        """Makes a batch the last whole one: one file appears, then the older ones go."""
        if number == 1:
            files.write_text(self.spark, f"{self.root}/_owner", self.owner or "")
        folder, name = f"{self.root}/_commits", f"{number}-{generation}-{batch_id}"
        files.write_text(self.spark, f"{folder}/{name}", "")
        for old in files.names(self.spark, folder):
            if old != name:
                files.delete(self.spark, f"{folder}/{old}")

    # -- rows ----------------------------------------------------------------
    def _columns(self, table: str) -> list[str]:
        """In their declared order: a folder's column would come last."""
        return [f.split()[0] for f in self.schemas[table].split(", ")]

    def _folder(self, table: str, generation: int) -> str:
        return f"{self.root}/{table}-{generation}"

    def rows(self, table: str, dates: tuple[str, str] | None = None) -> DataFrame:
        """Rows of all whole batches with their ``batch``; ``dates`` (first, last) prune the folders."""
        number, generation, _ = self._last()
        schema = f"{self.schemas[table]}, batch bigint"
        if not number:
            return empty_frame(self.spark, schema)
        found = self.spark.read.schema(schema).parquet(self._folder(table, generation)).where(F.col("batch") <= number)
        found = found.select(*self._columns(table), "batch")
        if dates is not None and "date" in found.columns:
            found = found.where(F.col("date").between(*dates))
        return found

    def _write(self, table: str, number: int, generation: int, df: DataFrame) -> DataFrame:
        """Writes a batch's own rows and returns them as stored."""
        folder = f"{self._folder(table, generation)}/batch={number}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy("date") if "date" in df.columns else writer).parquet(folder)
        return self.spark.read.schema(self.schemas[table]).parquet(folder).select(*self._columns(table))

    def whole(self, table: str, dates: tuple[str, str] | None = None) -> DataFrame:
        """The table as of the last whole batch."""
        raise NotImplementedError

    def compact(self) -> None:
        """Rewrites every table as one batch, so that reading it opens few files again.

        The new folders take the place of the old ones with the commit file;
        until then, and if the rewrite fails, the old ones count. Run it
        between batches.
        """
        number, generation, batch_id = self._last()
        if not number:
            return
        for table in self.schemas:
            files.delete(self.spark, self._folder(table, generation + 1))
            self._write(table, number, generation + 1, self.whole(table))
        self._commit(number, generation + 1, batch_id)
        for table in self.schemas:
            files.delete(self.spark, self._folder(table, generation))


def _dates(df: DataFrame) -> tuple[str, str] | None:
    """First and last date of one micro-batch (one row)."""
    low, high = df.agg(F.min("date"), F.max("date")).first()
    return None if low is None else (low, high)


class AdStateStore(BatchTables):
    """The ad tables of the state stream: counts and stat as increments, top 3 by group, the blacklist as a log."""

    schemas = STATE_SCHEMAS
    sums = {"counts": USER_KEYS, "stat": STAT_KEYS}

    def whole(self, table: str, dates: tuple[str, str] | None = None) -> DataFrame:
        rows = self.rows(table, dates)
        if table in self.sums:
            return rows.groupBy(*self.sums[table]).agg(F.sum("click_count").alias("click_count"))
        if table == "blacklist":
            return rows.select("user_id")
        latest = F.rank().over(Window.partitionBy(*PROVINCE_KEYS).orderBy(F.desc("batch")))     # K12: the last rows of a group
        return rows.withColumn("age", latest).where("age = 1").drop("age", "batch")

    def state(self, dates: tuple[str, str] | None = None) -> AdState:
        return AdState(**{table: self.whole(table, dates) for table in self.schemas})

    def apply(self, clicks: DataFrame, batch_id: int, threshold: int) -> bool:
        """Apply one micro-batch exactly once; False for a replay of a committed one (see ``admit``).

        Every step writes its rows and the next reads them: nothing is computed
        twice, and a lost executor costs its step only.
        """
        if not self.admit(batch_id):
            return False
        number, generation, _ = self._last()
        number += 1
        clean = materialize(without_blacklisted(click_cells(clicks), self.whole("blacklist")), "batch-clicks")
        try:
            dates = _dates(clean)
            users = self._write("counts", number, generation, user_click_counts(clean))
            self._write("blacklist", number, generation, new_blacklisted(self.rows("counts", dates), users, threshold))
            places = self._write("stat", number, generation, ad_stat(clean))
            self._write("top3", number, generation, top3_updates(self.rows("stat", dates), self.whole("top3", dates), places))
            self._commit(number, generation, batch_id)
        finally:
            discard(clean)
        return True


class TrendStore(BatchTables):
    """The per-minute trend table: each batch appends the counts so far of the windows it changed."""

    schemas = {"trend": TREND_SCHEMA}

    def whole(self, table: str, dates: tuple[str, str] | None = None) -> DataFrame:
        """Of a window's counts the last, which is the largest."""
        return self.rows(table, dates).groupBy(*TREND_KEYS).agg(F.max("click_count").alias("click_count"))

    def trend(self) -> DataFrame:
        return self.whole("trend")

    def apply(self, updates: DataFrame, batch_id: int) -> bool:
        if not self.admit(batch_id):
            return False
        number, generation, _ = self._last()
        self._write("trend", number + 1, generation, updates)
        self._commit(number + 1, generation, batch_id)
        return True


def read_log_stream(spark: SparkSession, source: str, fmt: str = "text",
                    options: dict[str, str] | None = None) -> DataFrame:
    """T1 source: a folder of text files (tests) or Kafka (``fmt='kafka'``, value cast to text)."""
    reader = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.load(source)


def trend_counts(clicks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Clicks per 1-minute window and ad, late events beyond ``delay`` dropped."""
    w = F.window("ts", "1 minute")
    return (clicks.withWatermark("ts", delay).groupBy(w.alias("w"), "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("date"),
                    F.date_format("w.start", "HH").alias("hour"),
                    F.date_format("w.start", "mm").alias("minute"), "ad_id", "click_count"))


def _checkpoint(root: str, given: str | None) -> str:
    """The stream's offsets live next to its state: together they make batches exactly-once."""
    return given or f"{root.rstrip('/')}/_stream_checkpoint"


def start_ad_stream(spark: SparkSession, source: str, state_root: str | None = None, threshold: int = 100,
                    checkpoint: str | None = None, fmt: str = "text", options: dict[str, str] | None = None,
                    trigger: dict | None = None, name: str | None = None):
    """Start the state stream; returns the StreamingQuery."""
    root = state_root or f"{checkpoint_dir(spark)}/visitflow-state/ad"
    store = AdStateStore(spark, root, owner=_checkpoint(root, checkpoint))
    clicks = parse_log(read_log_stream(spark, source, fmt, options))
    writer = (clicks.writeStream
              .foreachBatch(lambda df, bid: store.apply(df, bid, threshold))
              .option("checkpointLocation", _checkpoint(root, checkpoint)))
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_trend_stream(spark: SparkSession, source: str, trend_root: str | None = None, delay: str = "10 minutes",
                       checkpoint: str | None = None, fmt: str = "text",
                       options: dict[str, str] | None = None, trigger: dict | None = None,
                       name: str | None = None):
    """Start the trend stream (update mode: only windows changed in a trigger are appended).

    Its windows are kept in RocksDB on the executors, with change logs in the
    stream's checkpoint, unless the session names another state store.
    """
    if spark.conf.get(PROVIDER, None) is None or "HDFSBacked" in spark.conf.get(PROVIDER):
        spark.conf.set(PROVIDER, ROCKSDB)
    root = trend_root or f"{checkpoint_dir(spark)}/visitflow-state/trend"
    store = TrendStore(spark, root, owner=_checkpoint(root, checkpoint))
    counts = trend_counts(parse_log(read_log_stream(spark, source, fmt, options)), delay)
    writer = (counts.writeStream.outputMode("update")
              .foreachBatch(lambda df, bid: store.apply(df, bid))
              .option("checkpointLocation", _checkpoint(root, checkpoint)))
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_to_completion(query, timeout_s: int | None = None) -> None:
    """Wait for an availableNow query, however long; with ``timeout_s`` stop it and raise if it takes longer."""
    query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
