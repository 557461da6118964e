"""What a crawl remembers between passes: cursors, capabilities, dead relays, readings, completed authors. All are keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlake.functions.columns import since_with_slack


def advanced_cursors(cursors: DataFrame, runs: DataFrame) -> DataFrame:
    """relay, scope, last_synced_at after ``runs`` (relay, scope, ended_at, completed).

    Only a run that completed moves a cursor, the latest one counts, and what comes later overwrites.
    """
    new = runs.where("completed").groupBy("relay", "scope").agg(F.max("ended_at").alias("new"))
    both = cursors.join(new, ["relay", "scope"], "full_outer")
    return both.select("relay", "scope", F.coalesce("new", "last_synced_at").alias("last_synced_at"))


def scoped(filters: DataFrame, cursors: DataFrame, slack: int = 3600) -> DataFrame:
    """``filters`` (relay, scope, since and others) with ``since`` moved to their cursor less the slack, and ``first``: no cursor yet."""
    both = filters.join(cursors.select("relay", "scope", "last_synced_at"), ["relay", "scope"], "left")
    return both.withColumn("since", since_with_slack(F.col("last_synced_at"), F.col("since"), slack)).withColumn("first", F.col("last_synced_at").isNull()).drop("last_synced_at")


def learnt_capabilities(known: DataFrame, runs: DataFrame) -> DataFrame:
    """relay, capable (null: unknown) after ``runs`` (relay, ended_at, outcome).

    An ``unreliable`` run settles that a relay cannot reconcile. Else what is known stays, and the earliest telling run
    decides: ``productive`` that it can, ``unavailable`` that it cannot; ``over limit`` and others say nothing of it.
    """
    tells = F.when(F.col("outcome") == "productive", True).when(F.col("outcome") == "unavailable", False)
    by = runs.groupBy("relay").agg(F.min_by(tells, F.when(tells.isNotNull(), F.struct("ended_at", tells))).alias("told"), F.bool_or(F.col("outcome") == "unreliable").alias("bad"))
    both = known.join(by, "relay", "full_outer")
    return both.select("relay", F.when(F.col("bad"), False).otherwise(F.coalesce("capable", "told")).alias("capable"))


def dead_marks(marks: DataFrame, failures: DataFrame, now_ms: int, ttl_ms: int = 21_600_000) -> DataFrame:
    """relay, dead_until of relays that are dead at ``now_ms``: the latest mark holds for ``ttl_ms`` and lapses then."""
    new = failures.groupBy("relay").agg((F.max("failed_at") + ttl_ms).alias("new"))
    both = marks.join(new, "relay", "full_outer").select("relay", F.coalesce("new", "dead_until").alias("dead_until"))
    return both.where(F.col("dead_until") > now_ms)


def alive(relays: DataFrame, marks: DataFrame, now_ms: int) -> DataFrame:
    """The relays without a mark that still holds."""
    return relays.join(marks.where(F.col("dead_until") > now_ms).select("relay"), "relay", "left_anti")


def newest_readings(readings: DataFrame, most: int = 12) -> DataFrame:
    """The newest readings (at, n)."""
    return readings.orderBy(F.desc("at"), F.desc("n")).limit(most)


def rate_of(readings: DataFrame) -> DataFrame:
    """rate: growth a second from the first to the last reading; null for fewer than two, or without growth."""
    ends = readings.agg(F.count("*").alias("k"), F.min_by("n", "at").alias("a"), F.max_by("n", "at").alias("b"), (F.max("at") - F.min("at")).alias("t"))
    more = F.col("b") - F.col("a")
    return ends.select(F.when((F.col("k") > 1) & (F.col("t") > 0) & (more > 0), more / F.col("t")).alias("rate"))


def completed_authors(done: DataFrame, finished: DataFrame) -> DataFrame:
    """author, new: the set of authors whose content was fetched to the end, which only grows; ``new`` marks this pass's."""
    old = done.select("author").distinct()
    new = finished.select("author").distinct().join(old, "author", "left_anti")
    return old.withColumn("new", F.lit(False)).union(new.withColumn("new", F.lit(True)))


def low_yield_relays(batches: DataFrame, curated: DataFrame, least: int = 3, streak: int = 2) -> DataFrame:
    """relay, streak: relays to discard, whose ``streak`` or more consecutive batches gave under ``least`` events an author.

    ``batches`` has relay, batch, downloaded, authors; the yield is a whole number, a good batch ends a streak, and so
    does one that asked for no author, as nothing could come of it; curated relays are never discarded.
    """
    low = (F.col("authors") > 0) & (F.expr("downloaded div greatest(authors, 1)") < least)
    order = Window.partitionBy("relay").orderBy("batch")
    rows = batches.withColumn("low", low).withColumn("island", F.sum((~F.col("low")).cast("int")).over(order))
    runs = rows.where("low").groupBy("relay", "island").agg(F.count("*").alias("streak")).where(F.col("streak") >= streak)
    return runs.groupBy("relay").agg(F.max("streak").alias("streak")).join(curated.select("relay"), "relay", "left_anti")


def settled(outcomes: DataFrame) -> DataFrame:
    """relay, scope, transport, completed of downloads, from what they met.

    ``outcomes`` has relay, scope, pages_only, capable (null: unknown), capped, need, got, first, pages_completed,
    reconcile_completed. A relay that cannot reconcile, or is asked not to, is paged; a reconciliation that looks
    incomplete is repaired by pages, and then the pages decide.
    """
    from trustlake.functions.columns import looks_incomplete

    paged = F.col("pages_only") | F.coalesce(~F.col("capable"), F.lit(False))
    repaired = looks_incomplete(~paged, F.col("capped"), F.col("need"), F.col("got"), F.col("first"))
    transport = F.when(paged, "pages").when(repaired, "repaired by pages").otherwise("reconciled")
    return outcomes.select("relay", "scope", transport.alias("transport"), F.when(paged | repaired, F.col("pages_completed")).otherwise(F.col("reconcile_completed")).alias("completed"))


def full_listing(listings: DataFrame, complete: DataFrame) -> DataFrame:
    """relay, id: the different ids of each listing that is complete and had no limit, which may be compared with what is held.

    A relay whose listing cannot be relied on has one row with a null id; one with a reliable empty listing has none.
    """
    reliable = F.col("complete") & ~F.col("capped")
    ids = listings.where("id is not null").select("relay", "id").distinct().join(complete.where(reliable).select("relay"), "relay")
    return ids.unionByName(complete.where(~F.coalesce(reliable, F.lit(False))).select("relay", F.lit(None).cast(ids.schema["id"].dataType).alias("id")))
