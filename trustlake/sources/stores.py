"""Stores on shared storage: the event log in segments, snapshots behind numbered commits, a history of passes, state, settings."""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter
from collections.abc import Callable
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustlake.functions.columns import first_tag
from trustlake.operators.filters import visible
from trustlake.operators.store import EPHEMERAL, ledger_merge, refresh_slice, stored_events
from trustlake.schema import EVENTS, LEDGER
from trustlake.sources.commits import CommitConflict, Commits, get_text, put_text
from trustlake.sources.tables import dotenv


class Snapshots:
    """A table of which each version is a folder of Parquet files, named by a numbered commit.

    A reader that has begun keeps the version it read, a job that dies leaves the last commit as it was, and of two
    writers who began from one version the second is refused.
    """

    def __init__(self, spark: SparkSession, home: str, schema: T.StructType):
        self.spark, self.home, self.schema = spark, home.rstrip("/"), schema
        self.commits = Commits(spark, home)

    def version(self) -> int:
        return self.commits.latest()[0]

    def read(self, version: int | None = None) -> DataFrame:
        number, document = self.commits.latest() if version is None else (version, self.commits.at(version) if version >= 0 else {})
        path = document.get("path")
        return self.spark.read.schema(self.schema).parquet(f"{self.home}/{path}") if path else self.spark.createDataFrame([], self.schema)

    def swap(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """Commits ``rows`` as the version after ``version``, which is the one they were worked out from (the latest, if not given)."""
        version = self.version() if version is None else version
        if version < 0:
            self.commits.commit(0, {})
            version = 0
        path = f"data/{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.home}/{path}")
        if not self.commits.commit(version + 1, {"path": path}):
            self.commits.delete(path)
            raise CommitConflict(f"version {version + 1} of {self.home} was written meanwhile")
        return self.read(version + 1)

    def change(self, change: Callable[[DataFrame], DataFrame], tries: int = 5) -> DataFrame:
        """Swaps in what ``change`` makes of the latest version, again from the newer one if another writer was faster."""
        for _ in range(tries):
            version = self.version()
            try:
                return self.swap(change(self.read(version)), version)
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.home}: other writers were faster {tries} times")

    def vacuum(self, keep: int = 2) -> None:
        """Deletes the folders of all but the last ``keep`` versions."""
        number, _ = self.commits.latest()
        kept = {self.commits.at(n).get("path") for n in range(max(0, number - keep + 1), number + 1)}
        for name in self.commits.names("data"):
            if f"data/{name}" not in kept:
                self.commits.delete(f"data/{name}")


def observed(told: Observation) -> dict[str, int]:
    """What was observed; nothing where the plan was cut short, as there was no row to observe."""
    try:
        return told.get
    except Py4JJavaError:
        return {}


ROWS = T.StructType([*EVENTS.fields, T.StructField("expires_at", T.LongType()), T.StructField("part", T.StringType())])
#: Fates of offered events, as an insert reports them.
FATES = ("unverified", "ephemeral", "expired", "duplicate", "known", "refused", "stored")


class EventStore:
    """The event log as segments: an insert appends the rows it accepts and marks for the rows it removes.

    Rows and marks are dealt into buckets by author. The commit lists each segment with its bucket and its range of
    authors, so a batch reads only segments that can hold its authors, and writes none of the others; all rules bind
    events of one author. A mark names an id and the part that holds it, so an id may come again later. Writers work
    from the commit they read: if others have committed meanwhile, a change is put on top where theirs touched other
    buckets, and worked out again where they did not.
    """

    def __init__(self, spark: SparkSession, home: str, buckets: int = 64):
        self.spark, self.home = spark, home.rstrip("/")
        self.commits, self.buckets = Commits(spark, home), buckets
        self.touched: dict[str, list[str]] = {"read": [], "written": []}

    def _latest(self) -> tuple[int, dict]:
        number, document = self.commits.latest()
        if number < 0:
            self.commits.commit(0, {"buckets": self.buckets, "segments": [], "touched": []})
            number, document = self.commits.latest()
        self.buckets = document["buckets"]
        return number, document

    def _live(self, segments: list[dict]) -> DataFrame:
        """The rows of segments that no mark among them removes."""
        paths = lambda dead: [f"{self.home}/{s['path']}" for s in segments if s["dead"] == dead]
        read = lambda schema, dead: self.spark.read.schema(schema).parquet(*paths(dead)) if paths(dead) else self.spark.createDataFrame([], schema)
        rows = read(ROWS, False)
        return rows.join(read("id string, part string", True), ["id", "part"], "left_anti").select(*ROWS.names) if paths(True) else rows

    def events(self) -> DataFrame:
        return self.rows().select(*EVENTS.names)

    def rows(self) -> DataFrame:
        """The events with what is stored beside them: expires_at and the part they are in."""
        return self._live(self._latest()[1]["segments"])

    def of_authors(self, authors: list[str]) -> DataFrame:
        """The events of some authors, read from the segments that can hold them."""
        number, document = self._latest()
        named = self.spark.createDataFrame([(a,) for a in authors], "pubkey string")
        met = self._met(document, self._ranges(named))
        return self._live(met).where(F.col("pubkey").isin(*authors)).select(*EVENTS.names) if authors else self.events().limit(0)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("pubkey"), F.lit(self.buckets)).cast("int")

    def _ranges(self, rows: DataFrame) -> dict[int, tuple[str, str]]:
        by = rows.groupBy(self._bucket().alias("bucket")).agg(F.min("pubkey").alias("low"), F.max("pubkey").alias("high"))
        return {r["bucket"]: (r["low"], r["high"]) for r in by.collect()}

    def _met(self, document: dict, ranges: dict[int, tuple[str, str]]) -> list[dict]:
        return [s for s in document["segments"] if s["bucket"] in ranges and s["low"] <= ranges[s["bucket"]][1] and s["high"] >= ranges[s["bucket"]][0]]

    def _written(self, rows: DataFrame, part: str) -> list[dict]:
        """Rows with ``what`` (rows or dead) as segments below a folder of their own, and how the commit lists them."""
        out = rows.withColumn("bucket", self._bucket()).hint("rebalance", "what", "bucket").sortWithinPartitions("what", "bucket", "pubkey", "id")
        out.write.partitionBy("what", "bucket").parquet(f"{self.home}/data/{part}")
        back = self.spark.read.schema("pubkey string, what string, bucket int").parquet(f"{self.home}/data/{part}")
        by = back.groupBy("what", "bucket").agg(F.count("*").alias("rows"), F.min("pubkey").alias("low"), F.max("pubkey").alias("high")).collect()
        return [{"path": f"data/{part}/what={r['what']}/bucket={r['bucket']}", "dead": r["what"] == "dead", "bucket": r["bucket"], "rows": r["rows"], "low": r["low"], "high": r["high"]} for r in by]

    def _change(self, work: Callable[[dict, str], tuple[DataFrame, Callable[[dict], bool]]], tries: int = 5) -> tuple[list[dict], list[dict]]:
        """Commits what ``work`` makes of the latest commit: rows to write, and which listed segments these replace.

        Returns the segments written and those replaced.
        """
        for _ in range(tries):
            number, document = self._latest()
            part = uuid.uuid4().hex
            rows, replaces = work(document, part)
            written = self._written(rows, part)
            old = [s for s in document["segments"] if replaces(s)]
            mine = {s["bucket"] for s in written + old}
            if not mine:
                self.commits.delete(f"data/{part}")
                return [], []
            while True:
                listed = [s for s in document["segments"] if s not in old] + written
                if self.commits.commit(number + 1, {"buckets": self.buckets, "segments": listed, "touched": sorted(mine)}):
                    self.touched["written"] = [s["path"] for s in written]
                    return written, old
                last, document = self._latest()
                theirs = {b for n in range(number + 1, last + 1) for b in self.commits.at(n)["touched"]}
                number = last
                if theirs & mine:
                    break
            self.commits.delete(f"data/{part}")
        raise CommitConflict(f"{self.home}: other writers were faster {tries} times")

    def insert(self, batch: DataFrame, now: int, verified: Column | None = None) -> int:
        """Stores what the rules accept of a batch and returns how many rows those are."""
        return self.insert_reported(batch, now, verified)["stored"]

    def insert_reported(self, batch: DataFrame, now: int, verified: Column | None = None) -> dict[str, int]:
        """Stores a batch and reports how many events were offered, what became of them (``FATES``) and how many stored ones were removed.

        Events that fail ``verified``, ephemeral ones and those that have expired are rejected before anything is worked
        out, so they neither supersede nor delete. Of the rest are refused ids that are stored, and what stored or new
        deletions, erasures and newer versions rule out. Deletions outlive the events that they name. The batch is read
        once, and the counts are observed while it is.
        """
        staged, told = f"staging/{uuid.uuid4().hex}", Observation()
        holds = F.lit(True) if verified is None else F.coalesce(verified, F.lit(False))
        expires = first_tag(F.col("tags"), "expiration").try_cast("long")
        fate = F.when(~holds | F.col("id").isNull() | F.col("pubkey").isNull(), "unverified").when(F.col("kind").between(*EPHEMERAL), "ephemeral").when(~visible(expires, now), "expired")
        offered = batch.select(*EVENTS.names, expires.alias("expires_at"), fate.alias("fate"))
        offered = offered.observe(told, F.count(F.lit(1)).alias("offered"), *[F.count_if(F.col("fate") == f).alias(f) for f in FATES[:3]])
        offered.where("fate is null").drop("fate").write.parquet(f"{self.home}/{staged}/offered")
        staying = self.spark.read.schema(T.StructType(ROWS.fields[:-1])).parquet(f"{self.home}/{staged}/offered")
        new = staying.dropDuplicates(["id"]).withColumn("part", F.lit(""))
        # authors are the same before copies are put together, which is a sort of all ids
        ranges, judged = self._ranges(staying), []

        def work(document: dict, part: str) -> tuple[DataFrame, Callable[[dict], bool]]:
            met = self._met(document, ranges)
            self.touched["read"] = [s["path"] for s in met]
            old = self._live(met).join(staying.select("pubkey").distinct(), "pubkey", "left_semi").select(*ROWS.names)
            held = old.select("id", F.lit(True).alias("held")).distinct()
            both = new.join(held, "id", "left").select(*ROWS.names, "held").unionByName(old.withColumn("held", F.lit(None).cast("boolean")))
            # what the rules look at is put together once, as they go over it several times
            folder = f"{self.home}/{staged}/judged-{part}"
            both.write.parquet(folder)
            every = self.spark.read.schema(both.schema).parquet(folder)
            kept = stored_events(every.where("held is null").drop("expires_at", "held")).select("id", "pubkey", "part", F.lit(True).alias("kept"))
            every = every.join(kept, ["id", "pubkey", "part"], "left")
            is_new = F.col("part") == ""
            fate = F.when(is_new & F.col("held").isNotNull(), "known").when(is_new, F.when(F.col("kept"), "stored").otherwise("refused")).when(F.col("kept").isNull(), "removed")
            seen = Observation()
            judged.append((seen, both))
            every = every.withColumn("fate", fate).observe(seen, *[F.count_if(F.col("fate") == f).alias(f) for f in ("known", "refused", "stored", "removed")])
            rows = every.where(F.col("fate").isin("stored", "removed"))
            return rows.select(*EVENTS.names, "expires_at", F.when(is_new, part).otherwise(F.col("part")).alias("part"), F.when(is_new, "rows").otherwise("dead").alias("what")), lambda s: False

        try:
            written, _ = self._change(work)
            seen, both = judged[-1]
            # a plan that turns out empty is cut short, and what was observed in it is lost: then all there is was refused or known
            left = seen.get if written else {"stored": 0, "removed": 0, **{k: v or 0 for k, v in both.where("part = ''").agg(F.count_if(F.col("held").isNull()).alias("refused"), F.count_if("held").alias("known")).first().asDict().items()}}
            out = dict.fromkeys(("offered", *FATES), 0) | observed(told) | left
        finally:
            self.commits.delete(staged)
        out["duplicate"] = out["offered"] - sum(out[f] for f in FATES if f != "duplicate")
        return out

    def load(self, rows: DataFrame) -> None:
        """Appends rows as they are, without any rule."""
        expires = first_tag(F.col("tags"), "expiration").try_cast("long")
        self._change(lambda document, part: (rows.select(*EVENTS.names, expires.alias("expires_at"), F.lit(part).alias("part"), F.lit("rows").alias("what")), lambda s: False))

    def delete(self, predicate: Column, authors: list[str] | None = None) -> int:
        """Marks the rows for which ``predicate`` holds (a null keeps its row) and returns how many those are; with ``authors`` only their segments are read."""
        ranges = None if authors is None else self._ranges(self.spark.createDataFrame([(a,) for a in authors], "pubkey string"))

        def work(document: dict, part: str) -> tuple[DataFrame, Callable[[dict], bool]]:
            met = document["segments"] if ranges is None else self._met(document, ranges)
            self.touched["read"] = [s["path"] for s in met]
            gone = self._live(met).where(F.coalesce(predicate, F.lit(False)))
            gone = gone if authors is None else gone.where(F.col("pubkey").isin(*authors))
            return gone.select("id", "pubkey", "part", F.lit("dead").alias("what")), lambda s: False

        return sum(s["rows"] for s in self._change(work)[0])

    def sweep(self, now: int) -> int:
        """Removes what has expired."""
        return self.delete(~visible(F.col("expires_at"), now))

    def compact(self, most: int = 8) -> None:
        """Writes the live rows of each bucket with more than ``most`` segments, or with marks, as one segment."""

        def work(document: dict, part: str) -> tuple[DataFrame, Callable[[dict], bool]]:
            count = Counter(s["bucket"] for s in document["segments"])
            chosen = {b for b, n in count.items() if n > most} | {s["bucket"] for s in document["segments"] if s["dead"]}
            rows = self._live([s for s in document["segments"] if s["bucket"] in chosen])
            return rows.withColumn("part", F.lit(part)).withColumn("what", F.lit("rows")), lambda s: s["bucket"] in chosen

        self._change(work)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes parts that the last ``keep`` commits do not list; only while no other writer is at work, whose parts are not listed yet."""
        number, _ = self._latest()
        listed = {s["path"].split("/")[1] for n in range(max(0, number - keep + 1), number + 1) for s in self.commits.at(n)["segments"]}
        for name in self.commits.names("data"):
            if name not in listed:
                self.commits.delete(f"data/{name}")


PASSES = "pass long, ended_at long, offered long, " + ", ".join(f"{f} long" for f in FATES) + ", removed long"


class PassHistory:
    """A row for each pass, appended when it ends."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PASSES).parquet(self.home) if self._exists() else self.spark.createDataFrame([], PASSES)

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.home)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def append(self, number: int, ended_at: int, reports: list[dict[str, int]]) -> None:
        """The sums of a pass's insert reports as its row."""
        names = [c.split()[0] for c in PASSES.split(", ")]
        row = {n: sum(r.get(n, 0) for r in reports) for n in names} | {"pass": number, "ended_at": ended_at}
        self.spark.createDataFrame([tuple(row[n] for n in names)], PASSES).coalesce(1).write.mode("append").parquet(self.home)

    def newest(self, most: int = 12) -> DataFrame:
        return self.read().orderBy(F.desc("ended_at"), F.desc("pass")).limit(most)


class Ledger(Protocol):
    """What a crawl asks of its ledger of authors."""

    def read(self) -> DataFrame: ...

    def get(self, pubkey: str) -> DataFrame: ...

    def mark_synced(self, authors: DataFrame, at: int) -> None: ...

    def mark_outbox_checked(self, authors: DataFrame, at: int) -> None: ...

    def synced_since(self, cutoff: int) -> DataFrame: ...

    def synced_count(self) -> int: ...

    def due_for_refresh(self, cutoff: int, limit: int) -> DataFrame: ...

    def outbox_checked(self) -> DataFrame: ...


class StoredLedger:
    """The ledger as snapshots; a change that meets another writer's is worked out again on top of it."""

    def __init__(self, spark: SparkSession, home: str):
        self.table = Snapshots(spark, home, LEDGER)

    def read(self) -> DataFrame:
        return self.table.read()

    def get(self, pubkey: str) -> DataFrame:
        return self.read().where(F.col("pubkey") == pubkey)

    def upsert(self, rows: DataFrame) -> None:
        self.table.change(lambda old: ledger_merge(old, rows))

    def _stamp(self, authors: DataFrame, field: str, at: int) -> None:
        values = [F.lit(at if f == field else None).cast("long").alias(f) for f in ("content_synced_at", "outbox_checked_at")]
        self.upsert(authors.select("pubkey").distinct().select("pubkey", *values))

    def mark_synced(self, authors: DataFrame, at: int) -> None:
        """Stamps authors (pubkey) whose content was fetched; their other stamp stays."""
        self._stamp(authors, "content_synced_at", at)

    def mark_outbox_checked(self, authors: DataFrame, at: int) -> None:
        self._stamp(authors, "outbox_checked_at", at)

    def synced_since(self, cutoff: int) -> DataFrame:
        return self.read().where(F.col("content_synced_at") >= cutoff).select("pubkey")

    def synced_count(self) -> int:
        return self.read().where(F.col("content_synced_at") > 0).count()

    def due_for_refresh(self, cutoff: int, limit: int) -> DataFrame:
        return refresh_slice(self.read(), cutoff, limit)

    def outbox_checked(self) -> DataFrame:
        return self.read().where(F.col("outbox_checked_at") > 0).select("pubkey")


class StateFile:
    """A crawl's small state as JSON; what cannot be read counts as empty, and dead marks that have lapsed are dropped on loading."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, now_ms: int) -> dict:
        try:
            state = json.loads(get_text(self.spark, self.path) or "{}")
        except json.JSONDecodeError:
            state = {}
        state = state if isinstance(state, dict) else {}
        state["dead_until"] = {r: t for r, t in state.get("dead_until", {}).items() if t > now_ms}
        return state

    def save(self, state: dict) -> None:
        put_text(self.spark, self.path, json.dumps(state, indent=2, sort_keys=True))


def rendered_settings(keys: list[tuple[str, str, str]], answers: dict[str, str] | None = None) -> str:
    """A settings file's text: for each (name, default, note) the note as a comment and the answer or default."""
    lines = ["# Settings. A variable of the same name in the environment overrides a value here.", ""]
    for name, default, note in keys:
        lines += [f"# {note}", f"{name}={(answers or {}).get(name, default)}", ""]
    return "\n".join(lines)


def setting(spark: SparkSession, name: str, path: str | None = None, default: str | None = None) -> str | None:
    """A setting from the environment, else from a settings file, else the default."""
    if name in os.environ:
        return os.environ[name]
    found = dotenv(spark, path).where(F.col("key") == name).select("value").take(1) if path and get_text(spark, path) is not None else []
    return found[0]["value"] if found else default


def generated_events(rows: DataFrame, number: str, author: str, kind: int = 1, since: int = 1_700_000_000) -> DataFrame:
    """An event for each row of a table, for load tests: numbered by one column, of the author that another one names, one a second."""
    key = F.sha2(F.concat(F.lit("author "), F.col(author).cast("string")), 256)
    body = F.concat(F.lit("note "), F.col(number).cast("string"))
    no_tags = F.array().cast("array<array<string>>")
    return rows.select(F.sha2(F.col(number).cast("string"), 256).alias("id"), key.alias("pubkey"), (F.lit(since) + F.col(number)).cast("long").alias("created_at"), F.lit(kind).alias("kind"), no_tags.alias("tags"), body.alias("content"), F.lit("").alias("sig"))


def loaded(store: EventStore, batch: DataFrame, now: int) -> dict[str, float]:
    """Inserts a batch and reports rows offered and stored, seconds and rows a second; the store's count must agree."""
    import time

    before, began = store.events().count(), time.perf_counter()
    stored = store.insert(batch, now)
    seconds = time.perf_counter() - began
    if store.events().count() - before > stored:
        raise ValueError("more rows are stored than were accepted")
    return {"offered": batch.count(), "stored": stored, "seconds": seconds, "rate": stored / max(seconds, 1e-9)}
