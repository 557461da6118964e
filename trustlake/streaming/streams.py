"""Deduplication, windows and keyed state over a stream of events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

from trustlake.operators.filters import EventFilter
from trustlake.operators.store import need_have
from trustlake.sources.commits import Commits
from trustlake.sources.stores import EventStore
from trustlake.sources.tables import shared_home


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; event time is cast to a timestamp with time zone, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def replica_stream(spark: SparkSession, path: str, schema, keep: EventFilter, columns: dict[str, str] | None = None, files: int = 1) -> DataFrame:
    """A replica's files as pages of a stream, ``files`` at a time, under a filter; its limit, if it has one, ends the download."""
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path).where(keep.predicate(columns))
    return pages.limit(keep.limit) if keep.limit > 0 else pages


def deduplicated(stream: DataFrame, slack: str = "1 hour") -> DataFrame:
    """Each id once, late events up to the slack that cursors also leave."""
    return stream.withWatermark("ts", slack).dropDuplicatesWithinWatermark(["event_id"])


def tumbling_counts(stream: DataFrame, size: str = "1 day", slack: str = "1 hour") -> DataFrame:
    by = stream.withWatermark("ts", slack).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))
    return by.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


CHANGES = "user_id long, errors long, dead_until timestamp, at timestamp"


#: Into how many groups keyed state deals its users; a call to Python and to the state store is one for a group.
GROUPS = 1024


class ErrorMarks(StatefulProcessor):
    """Errors in a row of each user, in event time, and the mark that enough of them set.

    Anything else ends a row of errors, and so does a pause of ``ttl_ms``. From ``dead_after`` errors on a user is dead
    until ``ttl_ms`` after the last one; a timer then lets the mark lapse and the state go, whether events come or not.
    Each batch gives one row for a user that changed, a lapse one with no errors and no mark. A key is a group of users
    (its number, and whether it is the one of those without an id): its state lists the users who have errors, and its
    timer is the earliest of theirs.
    """

    def __init__(self, dead_after: int, ttl_ms: int):
        self.dead_after, self.ttl_ms = dead_after, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "users array<long>, errors array<long>, last_ms array<long>")

    def _held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Users in order, their errors and the times of the last ones."""
        return tuple(np.array(c, np.int64) for c in (self.run.get() if self.run.exists() else ((), (), ())))

    def _keep(self, users: np.ndarray, errors: np.ndarray, last: np.ndarray) -> None:
        if len(users):
            order = np.argsort(users)
            self.run.update(tuple(c[order].tolist() for c in (users, errors, last)))
            self.handle.registerTimer(int(last.min()) + self.ttl_ms)
        else:
            self.run.clear()

    def _rows(self, key: tuple, users: np.ndarray, errors: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        named = pd.array(users, dtype="Int64") if not key[1] else pd.array([None] * len(users), dtype="Int64")
        dead = pd.Series(pd.to_datetime(at + self.ttl_ms, unit="ms")).where(errors >= self.dead_after)
        return pd.DataFrame({"user_id": named, "errors": errors, "dead_until": dead, "at": pd.to_datetime(at, unit="ms")})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat([b[["user_id", "ms", "event_id", "event_type"]] for b in rows]).sort_values(["user_id", "ms", "event_id"])
        at, bad = events["ms"].to_numpy(np.int64), (events["event_type"] == "error").to_numpy(bool)
        users, first = np.unique(events["user_id"].to_numpy(np.int64), return_index=True)
        ends = np.append(first[1:], len(events)) - 1
        held, held_errors, held_last = self._held()
        known = np.isin(users, held)
        before, before_at = np.zeros(len(users), np.int64), np.zeros(len(users), np.int64)
        place = np.searchsorted(held, users[known])
        before[known], before_at[known] = held_errors[place], held_last[place]
        # an error goes on with a row of errors, or begins one
        on = np.zeros(len(events), bool)
        on[1:] = bad[1:] & bad[:-1] & (at[1:] - at[:-1] < self.ttl_ms)
        on[first] = bad[first] & (before > 0) & (at[first] - before_at < self.ttl_ms)
        begins = ~on
        begins[first] = True
        begin = np.maximum.accumulate(np.where(begins, np.arange(len(events)), 0))[ends]
        errors = np.where(bad[ends], ends - begin + 1 + np.where(on[begin], before, 0), 0)
        if len(held):
            self.handle.deleteTimer(int(held_last.min()) + self.ttl_ms)
        others, left = ~np.isin(held, users), errors > 0
        self._keep(np.append(held[others], users[left]), np.append(held_errors[others], errors[left]), np.append(held_last[others], at[ends][left]))
        yield self._rows(key, users, errors, at[ends])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        users, errors, last = self._held()
        due = last + self.ttl_ms
        gone = (due <= expiredTimerInfo.getExpiryTimeInMs()) | (due < timerValues.getCurrentWatermarkInMs())
        if gone.any():
            self._keep(users[~gone], errors[~gone], last[~gone])
            yield self._rows(key, users[gone], np.zeros(gone.sum(), np.int64), due[gone])

    def close(self) -> None:
        pass


#: The state store that keyed state with timers needs: on disk, with the memory of its cache only.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def error_marks(stream: DataFrame, dead_after: int = 3, ttl: float = 6 * 3600.0, slack: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """Changes (``CHANGES``) of each user's errors in a row and dead mark, from a stream with user_id, event_id, event_type and ts.

    State ends with a row of errors or when its mark lapses, at the latest ``ttl`` seconds after the watermark has
    passed its last event. Users are dealt into ``groups``, which a stream keeps for good. The query has to run with ``STATE_STORE``, as ``drained`` sees to; ``latest`` gives one row a key.
    """
    user, group = F.coalesce(F.col("user_id").cast("long"), F.lit(0).cast("long")), F.pmod(F.xxhash64("user_id"), F.lit(groups))
    rows = stream.withWatermark("ts", slack).select(group.alias("group"), F.isnull("user_id").alias("unnamed"), user.alias("user_id"), "event_id", "event_type", "ts", F.unix_millis("ts").alias("ms"))
    return rows.groupBy("group", "unnamed").transformWithStateInPandas(ErrorMarks(dead_after, int(ttl * 1000)), CHANGES, "Append", "EventTime")


def latest(changes: DataFrame, key: str = "user_id", at: str = "at") -> DataFrame:
    """The last change of each key; of one time the one with fewer errors, as it is a lapse."""
    others = [c for c in changes.columns if c != key]
    by = changes.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(at, -F.col("errors"))).alias("last"))
    return by.select(key, *[f"last.{c}" for c in others])


#: About how many rows a file of a slice has.
FILE_ROWS = 100_000


def in_slices(spark: SparkSession, rows: DataFrame, at: str, slices: int, late: Column | None = None, most: int = FILE_ROWS) -> tuple[str, int]:
    """A folder of Parquet files, as many for each slice of time, in order, and how many that are: a stream that reads so many at a time reads slice by slice.

    Rows for which ``late`` holds come two slices after theirs. A slice of few rows is filled up with empty files.
    """
    home, count = shared_home(spark, "slices"), slices + (late is not None)
    low, high, n = rows.agg(F.min(F.unix_micros(at)), F.max(F.unix_micros(at)), F.count("*")).first()
    files = max(1, -(-n // (count * most)))
    low, high = (F.lit(x or 0).cast("long") for x in (low, high))
    place = F.least(F.lit(slices - 1), F.floor((F.unix_micros(at) - low) * slices / F.greatest(F.lit(1), high - low)).cast("int"))
    place = place if late is None else F.when(late, F.least(F.lit(slices), place + 2)).otherwise(place)
    # no task sorts more than about ``most`` rows by slice
    rows.withColumn("slice", place).repartition(max(count * files, spark.sparkContext.defaultParallelism)).write.partitionBy("slice").parquet(f"{home}/parts")
    schema, folder = T.StructType([*rows.schema.fields, T.StructField("slice", T.IntegerType())]), Commits(spark, home)
    for i in range(count):
        # a file source takes files in the order of their times
        spark.read.schema(schema).parquet(f"{home}/parts").where(F.col("slice") == i).drop("slice").repartition(files).write.mode("append").parquet(f"{home}/in")
        for _ in range((i + 1) * files - sum(name.startswith("part-") for name in folder.names("in"))):
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(f"{home}/in")
    return f"{home}/in", files


class LateWindows:
    """Counts by tumbling window that late rows do not fall out of.

    Each batch splits its rows by the watermark, which is the greatest time of earlier batches less the slack: rows of
    windows that are still open are counted, others go to a table of late rows as they are. A backfill counts these and
    adds them to their windows, which are the only ones it touches. Folders are named by batch, and a batch or backfill
    that comes again replaces its own; the watermark of each batch is committed, and a retried batch finds its own again.
    """

    def __init__(self, spark: SparkSession, home: str, at: str, size_ms: int, slack_ms: int, keys: list[str]):
        self.spark, self.home, self.at, self.size, self.slack, self.keys = spark, home.rstrip("/"), at, size_ms, slack_ms, keys
        self.commits = Commits(spark, home)

    def _window(self) -> Column:
        ms = F.unix_millis(self.at)
        return (ms - F.pmod(ms, F.lit(self.size))).alias("start_ms")

    def put(self, batch: DataFrame, number: int) -> None:
        """What ``foreachBatch`` calls."""
        while self.commits.latest()[0] < number:
            last, document = self.commits.latest()
            self.commits.commit(last + 1, {"watermark": document.get("next"), "next": document.get("next")})
        document = self.commits.at(number)
        mark = document["watermark"]
        batch = batch.withColumn("start_ms", self._window()).persist()
        closed = F.lit(False) if mark is None else F.col("start_ms") + self.size <= mark
        try:
            batch.where(closed).drop("start_ms").write.mode("overwrite").parquet(f"{self.home}/data/late/batch={number}")
            counts = batch.where(~closed).groupBy("start_ms", *self.keys).agg(F.count("*").alias("n"))
            counts.write.mode("overwrite").parquet(f"{self.home}/data/counts/part=b{number}")
            newest = batch.agg(F.max(F.unix_millis(self.at))).first()[0]
        finally:
            batch.unpersist()
        following = mark if newest is None else max(newest - self.slack, mark if mark is not None else newest - self.slack)
        if self.commits.latest()[0] == number:
            self.commits.commit(number + 1, {"watermark": following, "next": following})

    def windows(self) -> DataFrame:
        """start_ms, the keys and n of every window so far."""
        kinds = ", ".join(f"`{k}` string" for k in self.keys)
        parts = self.spark.read.schema(f"start_ms long, {kinds}, n long, part string").parquet(f"{self.home}/data/counts")
        return parts.groupBy("start_ms", *self.keys).agg(F.sum("n").alias("n"))

    def late(self, schema: T.StructType) -> DataFrame:
        """The late rows that no backfill has taken yet, with the batch they came in."""
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{self.home}/data/late")
        done = [int(n.removeprefix("part=f")) for n in self.commits.names("data/counts") if n.startswith("part=f")]
        return rows.where(~F.col("batch").isin(*done)) if done else rows

    def backfill(self, schema: T.StructType) -> int:
        """Counts the late rows into their windows and returns how many windows those are."""
        batches = [r["batch"] for r in self.late(schema).select("batch").distinct().collect()]
        touched = 0
        for b in batches:
            rows = self.spark.read.schema(schema).parquet(f"{self.home}/data/late/batch={b}")
            counts = rows.withColumn("start_ms", self._window()).groupBy("start_ms", *self.keys).agg(F.count("*").alias("n"))
            counts.write.mode("overwrite").parquet(f"{self.home}/data/counts/part=f{b}")
            touched += self.spark.read.parquet(f"{self.home}/data/counts/part=f{b}").select("start_ms").distinct().count()
        return touched


class Gauges(StreamingQueryListener):
    """Totals of all queries of a session as they go on: batches, rows received, milliseconds of work. Added with ``spark.streams.addListener``."""

    def __init__(self):
        self.totals = {"batches": 0, "received": 0, "busy_ms": 0}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.totals["batches"] += 1
        self.totals["received"] += event.progress.numInputRows
        self.totals["busy_ms"] += event.progress.batchDuration

    def settle(self, spark: SparkSession, seconds: float = 10.0) -> None:
        """Waits until what has happened so far is counted; Spark tells listeners a little later."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(int(seconds * 1000))


def drained(stream: DataFrame, mode: str = "append", each: Callable[[DataFrame], DataFrame] = lambda batch: batch, kept: Callable[[int], None] = lambda number: None) -> DataFrame:
    """All that a stream gives now, as a table below ``spark.checkpoint.dir``, where its checkpoint and state stand too.

    ``each`` is applied to every batch and keeps its columns; ``kept`` hears of each batch that is written.
    """
    spark = stream.sparkSession
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    home, paths = shared_home(spark, "stream"), {}

    def save(batch: DataFrame, number: int) -> None:
        # a batch that is tried again replaces its own folder
        paths[number] = f"{home}/out/{number}"
        each(batch).select(*batch.columns).write.mode("overwrite").parquet(paths[number])
        kept(number)

    query = stream.writeStream.foreachBatch(save).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{home}/checkpoint").start()
    query.awaitTermination()
    if not paths:
        return spark.createDataFrame([], stream.schema)
    # in complete mode each batch has the whole result
    return spark.read.schema(stream.schema).parquet(*([paths[max(paths)]] if mode == "complete" else paths.values()))


def into_store(stream: DataFrame, store: EventStore, home: str, now: int, verified=None, hooks: tuple[Callable[[DataFrame], None], ...] = (), each: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> dict[str, int]:
    """Drains a stream of events into a store, batch by batch, and returns rows received and stored.

    The checkpoint below ``home`` moves only when a batch is stored, so a pass that dies goes on where it was; a batch
    that comes again changes nothing, as its ids are stored. ``each`` is applied to every batch, and
    ``hooks`` see what it gives before that is stored.
    """
    totals, scratch = {"received": 0, "stored": 0}, Commits(store.spark, home)

    def put(batch: DataFrame, number: int) -> None:
        # hooks and store get the same rows, whatever changes meanwhile and whoever is lost
        path = f"batches/{number}"
        each(batch).select(*batch.columns).write.mode("overwrite").parquet(f"{home}/{path}")
        rows = store.spark.read.schema(batch.schema).parquet(f"{home}/{path}")
        for hook in hooks:
            hook(rows)
        totals["received"] += rows.count()
        totals["stored"] += store.insert(rows, now, verified)
        scratch.delete(path)

    query = stream.writeStream.foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", f"{home}/checkpoint").start()
    query.awaitTermination()
    return totals


def reconciled(store: EventStore, replica: DataFrame, now: int, verified=None) -> int:
    """The periodic half beside a live stream: stores what a replica has and the store lacks, and returns how many rows those are."""
    lacking = need_have(store.events().select("id"), replica.select("id")).where("side = 'need'").select("id")
    return store.insert(replica.join(lacking, "id", "left_semi"), now, verified)


def enrolled(enrolment: str) -> Callable[[DataFrame], DataFrame]:
    """Keeps a batch's events of enrolled authors.

    The enrolment table (pubkey) at this path is listed and read for each batch, so who enrols meanwhile takes part from
    the next one on; a join of the stream itself with the table would go on with the files that stood there at its start.
    """
    return lambda batch: batch.join(batch.sparkSession.read.schema("pubkey string").parquet(enrolment).distinct(), "pubkey", "left_semi")


def passes(run: Callable[[int], dict], count: int, wait: Callable[[], None], log: Callable[[str], None] = lambda line: None) -> list[dict]:
    """``count`` passes one after another, each begun after the wait that follows the end of the last; one that fails is logged and does not end the loop."""
    out = []
    for number in range(count):
        try:
            out.append(run(number))
        except Exception as e:  # a pass may fail in any way, and the next one may not
            log(f"! pass {number} failed: {e}")
        if number + 1 < count:
            wait()
    return out
