"""The trust graph: observers name services, services score subjects, subjects may be observers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlake.functions.columns import first_tag
from trustlake.operators.store import newest
from trustlake.schema import RELAY_LIST, SCORE, TRUST_LIST


def provider_edges(events: DataFrame, service: str = "30382:rank") -> DataFrame:
    """observer, service, relay of each provider that a trust list names."""
    lists = newest(events.where(F.col("kind") == TRUST_LIST), ["pubkey"])
    named = F.explode(F.filter("tags", lambda t: (F.size(t) > 1) & (t[0] == service)))
    return lists.select(F.col("pubkey").alias("observer"), named.alias("t")).select("observer", F.col("t")[1].alias("service"), F.try_element_at("t", F.lit(3)).alias("relay"))


def scores(events: DataFrame) -> DataFrame:
    """service, subject, rank (null where missing), created_at, id of current scores."""
    rows = events.where(F.col("kind") == SCORE).withColumn("subject", first_tag(F.col("tags"), "d")).where("subject is not null")
    rank = first_tag(F.col("tags"), "rank").try_cast("int")
    return newest(rows, ["pubkey", "subject"]).select(F.col("pubkey").alias("service"), "subject", rank.alias("rank"), "created_at", "id")


def relay_lists(events: DataFrame) -> DataFrame:
    """author, relay, pos of each relay that an author writes to."""
    lists = newest(events.where(F.col("kind") == RELAY_LIST), ["pubkey"])
    write = F.filter("tags", lambda t: (F.size(t) > 1) & (t[0] == "r") & ((F.size(t) < 3) | (F.element_at(t, -1) != "read")))
    return lists.select(F.col("pubkey").alias("author"), F.posexplode(F.transform(write, lambda t: t[1])).alias("pos", "relay"))


def rosters(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """observer, subject: whom an observer's services score."""
    return edges.select("observer", "service").distinct().join(scored, "service").select("observer", "subject").distinct()


def coverage(edges: DataFrame, scored: DataFrame, own_outbox: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per observer: providers, roster and how much of it has an outbox, is synced (also as a fraction), is unreached, is pending."""
    listed = ledger.select(F.col("pubkey").alias("subject"), (F.col("content_synced_at") >= 1).alias("synced"), (F.col("outbox_checked_at") > 0).alias("checked"))
    own = own_outbox.select(F.col("author").alias("subject")).distinct().withColumn("own", F.lit(True))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    rows = rosters(edges, scored).join(listed, "subject", "left").join(own, "subject", "left")
    count = lambda c: F.count_if(c).cast("long")
    by = rows.groupBy("observer").agg(F.count("*").alias("roster"), count(flag("own")).alias("with_own_outbox"), count(flag("synced")).alias("synced"), count(~flag("synced") & ~flag("checked")).alias("unreached"))
    providers = edges.groupBy("observer").agg(F.count_distinct("service").alias("providers"))
    zero = F.lit(0).cast("long")
    out = providers.join(by, "observer", "left").na.fill(0)
    out = out.withColumn("pending", F.greatest(F.col("roster") - F.col("synced"), zero))
    out = out.withColumn("attempted", F.greatest(F.col("pending") - F.col("unreached"), zero))
    return out.withColumn("fraction", F.when(F.col("roster") > 0, F.round(F.col("synced") / F.col("roster"), 6)).otherwise(0.0))


def reputation(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """observer, subject, rank: the best current rank that an observer's services give a subject; a score without a rank is no cell."""
    ranked = edges.select("observer", "service").distinct().join(scored.where("rank is not null"), "service")
    return ranked.groupBy("observer", "subject").agg(F.max("rank").alias("rank"))


def orphans(scored: DataFrame, edges: DataFrame) -> DataFrame:
    """Scores of services that no trust list names. Without a single list nothing is known of any service, and nothing is an orphan."""
    listed = edges.select("service").distinct()
    any_list = edges.agg((F.count("*") > 0).alias("any")).where("any")
    return scored.join(listed, "service", "left_anti").join(F.broadcast(any_list), how="left_semi")


def swept_orphans(scored: DataFrame, edges: DataFrame, save, most: float = 0.5) -> DataFrame:
    """The orphans that a sweep may delete: none, and ``MassDeletion``, where they are more than ``most`` of all scores."""
    from trustlake.operators.store import guarded

    known = edges.select("service").where("service is not null").distinct().withColumn("known", F.lit(True))
    marked = scored.join(known, "service", "left").withColumn("gone", F.col("known").isNull()).drop("known")
    # one row tells whether there is a list at all
    any_list = edges.agg((F.count("*") > 0).alias("any"))
    marked = marked.join(F.broadcast(any_list)).withColumn("gone", F.col("gone") & F.col("any")).drop("any")
    return guarded(marked, save, most=most)


def single_relay_services(edges: DataFrame) -> DataFrame:
    """service, relay of services that are hinted on one relay only, the sole ones whose absences count as deletions."""
    known = edges.where("relay is not null").groupBy("service").agg(F.count_distinct("relay").alias("n"), F.min("relay").alias("relay"))
    return known.where("n = 1").select("service", "relay")


def frontier(edges: DataFrame, scored: DataFrame, roots: DataFrame, home: str) -> DataFrame:
    """observer, depth: observers that ``roots`` reach, through scored subjects that are observers themselves.

    Each round's new observers are written below ``home``, a shared folder, so a round depends on no earlier one's
    tasks, joins only what the round before has found, and writes nothing twice. Rounds go on until nothing is new.
    """
    spark = edges.sparkSession
    named = edges.select(F.col("observer").alias("subject")).distinct()
    rosters(edges, scored).join(named, "subject", "left_semi").write.parquet(f"{home}/links")
    links = spark.read.parquet(f"{home}/links")
    kind = edges.schema["observer"].dataType.simpleString()
    seen = lambda: spark.read.schema(f"observer {kind}, depth int").parquet(f"{home}/seen")
    roots.select(F.col("observer").cast(kind).alias("observer")).distinct().write.parquet(f"{home}/seen/depth=0")
    depth = 0
    while True:
        last = seen().where(F.col("depth") == depth)
        if last.isEmpty():
            return seen()
        found = last.join(links, "observer").select(F.col("subject").cast(kind).alias("observer")).distinct()
        depth += 1
        found.join(seen().select("observer"), "observer", "left_anti").write.parquet(f"{home}/seen/depth={depth}")


def routed(authors: DataFrame, lists: DataFrame, fallback: list[str], most: int = 4, spread: int = 2, discarded: DataFrame | None = None, reachable=None) -> DataFrame:
    """author, relay: the first ``most`` of an author's own relays that can be reached, else ``spread`` neighbours among the fallback ones by hash.

    ``reachable`` is a condition on ``relay`` (publicly routable, if not given); relays that fail it neither count
    towards ``most`` nor keep an author from the fallback. An author gets each fallback relay once, so at most as many as
    there are, and none where there are none. Relays in ``discarded`` are left out in the end; they do not make room for
    others.
    """
    from trustlake.functions.columns import routable, spread_hash

    usable = lists.where(routable(F.col("relay")) if reachable is None else reachable)
    ranked = authors.join(usable, "author").withColumn("nth", F.row_number().over(Window.partitionBy("author").orderBy("pos", "relay")))
    own = ranked.where(F.col("nth") <= most).select("author", "relay")
    out = own
    if fallback:
        slots = F.array(*map(F.lit, fallback))
        first = (spread_hash("author") % len(fallback)).cast("int")
        picks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(min(spread, len(fallback)) - 1)), lambda i: F.element_at(slots, (first + i) % len(fallback) + 1)))
        out = own.union(authors.join(usable, "author", "left_anti").select("author", F.explode(picks).alias("relay")))
    return out if discarded is None else out.join(discarded.select("relay").distinct(), "relay", "left_anti").select("author", "relay")
