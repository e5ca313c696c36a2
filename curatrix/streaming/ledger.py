"""Incremental jobs as Structured Streaming: a ledger of checks in keyed state, first and last sightings, and new keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery


def rolled_up(events: DataFrame, keys: list[str], stamp: str, last: list[str], sequence: str) -> DataFrame:
    """One row a key: how many checks, and the columns of the last one by time and sequence."""
    place = F.struct(stamp, sequence)
    return events.groupBy(*keys).agg(F.count("*").alias("query_count"), F.max(place).alias("_place"), *[F.max_by(c, place).alias(f"last_{c}") for c in last]).select(*keys, "query_count", F.col(f"_place.{stamp}").alias("last_checked"), F.col(f"_place.{sequence}").alias("last_sequence"), *[f"last_{c}" for c in last])


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams started from now on keep their keyed state in RocksDB on the executors' disks, with changes saved to the checkpoint, instead of in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def ledger_stream(spark: SparkSession, events: DataFrame, path: str, checkpoint: str, keys: list[str], stamp: str, last: list[str], sequence: str) -> StreamingQuery:
    """Keeps a ledger under path. Counts and last checks are keyed state; a batch combines its own rows before the shuffle, reads and updates the
    state of its keys, and writes these keys' new rows as batch=<number>: work follows the batch, not the ledger. A batch that runs again replaces its own rows.
    The state has as many partitions as spark.sql.shuffle.partitions at the first start."""
    keep_state_on_disk(spark)
    changes = rolled_up(events, keys, stamp, last, sequence)
    return _changes_written(changes, path, checkpoint)


def _changes_written(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_ledger(spark: SparkSession, path: str, keys: list[str], until: int | None = None) -> DataFrame:
    """The ledger (as of batch until): each key's row of the last batch that changed it, from the last compacted base and the batches after it."""
    upto = _last_base(spark, path)
    changes = spark.read.parquet(f"{path}/changes").where(F.col("batch") > upto)
    changes = changes if until is None else changes.where(F.col("batch") <= until)
    columns = [c for c in changes.columns if c != "batch"]
    if upto >= 0:
        changes = changes.unionByName(spark.read.parquet(f"{path}/base/upto={upto}").withColumn("batch", F.lit(upto)))
    rows = changes.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in columns if c not in keys]), "batch").alias("r"))
    return rows.select(*keys, "r.*").select(*columns)


def compact_ledger(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Writes the ledger up to its last batch as a base, which readers take once it is complete; the number of that batch. A batch that runs again afterwards writes the same rows, which the base has."""
    last = spark.read.parquet(f"{path}/changes").agg(F.max("batch")).first()[0]
    if last > _last_base(spark, path):
        latest_ledger(spark, path, keys, last).write.mode("overwrite").parquet(f"{path}/base/upto={last}")
    return last


def _last_base(spark: SparkSession, path: str) -> int:
    """The batch up to which the last complete base goes, -1 without one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = hadoop(f"{path}/base/upto=*/_SUCCESS")
    found = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done) or []
    return max((int(f.getPath().getParent().getName().partition("=")[2]) for f in found), default=-1)


class _Idle(StatefulProcessor):
    """A ledger row a key; a timer, moved on by each check, closes the row and forgets the key."""

    def __init__(self, keys: list[str], stamp: str, last: list[str], sequence: str, state: str, idle_ms: int) -> None:
        self.keys, self.stamp, self.last, self.sequence, self.state_schema, self.idle_ms = keys, stamp, last, sequence, state, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, handle.getValueState("ledger", self.state_schema)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  these names are Spark's
        import pandas as pd

        count, *now = self.row.get() if self.row.exists() else (0, None, None, *[None] * len(self.last))
        for chunk in rows:  # a key's rows come in pieces
            count += len(chunk)
            top = chunk.sort_values([self.stamp, self.sequence]).iloc[-1]
            found = [top[self.stamp].to_pydatetime(), top[self.sequence], *[top[c] for c in self.last]]
            found = [x.item() if hasattr(x, "item") else x for x in found]
            if now[0] is None or (found[0], found[1]) > (now[0], now[1]):
                now = found
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.row.update((count, *now))
        self.handle.registerTimer(int(pd.Timestamp(now[0]).tz_localize("UTC").timestamp() * 1000) + self.idle_ms)
        yield self._out(key, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        yield self._out(key, True)
        self.row.clear()

    def _out(self, key, closed: bool):
        import pandas as pd

        count, stamp, sequence, *values = self.row.get()
        columns = [*self.keys, "query_count", "last_checked", "last_sequence", *[f"last_{c}" for c in self.last], "closed"]
        return pd.DataFrame([[*key, count, stamp, sequence, *values, closed]], columns=columns)

    def close(self) -> None:
        pass


def idle_ledger_stream(spark: SparkSession, events: DataFrame, path: str, checkpoint: str, keys: list[str], stamp: str, last: list[str], sequence: str, delay: str, idle_ms: int) -> StreamingQuery:
    """ledger_stream with a bound on its state: a key that has no check for idle_ms of event time is closed and forgotten when the watermark
    (delay) passes that time, and a later check starts it anew. Rows have closed. Checks without a stamp or later than the watermark are left out.
    One task takes the rows of a key in a batch, in pieces; ledger_stream combines them before the shuffle."""
    keep_state_on_disk(spark)
    of = {f.name: f.dataType.simpleString() for f in events.schema}
    state = ", ".join(["query_count bigint", "last_checked timestamp", f"last_sequence {of[sequence]}", *[f"`last_{c}` {of[c]}" for c in last]])
    out = ", ".join([*[f"`{k}` {of[k]}" for k in keys], state, "closed boolean"])
    rows = events.where(F.col(stamp).isNotNull()).withWatermark(stamp, delay).select(*keys, stamp, sequence, *last)
    changes = rows.groupBy(*keys).transformWithStateInPandas(_Idle(keys, stamp, last, sequence, state, idle_ms), out, "update", "eventtime")
    return _changes_written(changes, path, checkpoint)


def seen_stream(events: DataFrame, key: str, stamp: str) -> DataFrame:
    """First and last sighting and count of each key; write it in update or complete mode."""
    return events.groupBy(key).agg(F.count("*").alias("n"), F.min(stamp).alias("first_seen"), F.max(stamp).alias("last_seen"))


def new_keys_stream(events: DataFrame, keys: list[str], stamp: str | None = None, within: str | None = None) -> DataFrame:
    """The first row of each key; with a watermark (stamp, within) keys are forgotten after that time."""
    if stamp and within:
        return events.withWatermark(stamp, within).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def resume_stream(events: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Appends to path the rows whose keys it lacks."""
    from ..sources.tables import append_new

    return events.writeStream.foreachBatch(lambda batch, _: append_new(batch, path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_checks(events: DataFrame, key: str, source: str, sources: list[str], stamp: str, sequence: str) -> DataFrame:
    """Each key's latest time by source, a column each."""
    return events.groupBy(key).pivot(source, sources).agg(F.max_by(stamp, F.struct(stamp, sequence)))
