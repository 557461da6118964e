"""Whom a crawl follows and where it asks: observers, their relays, providers and identities, as joins over sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.functions.columns import routable, tag_values
from trustlake.operators import trust
from trustlake.operators.store import newest, stored_events
from trustlake.schema import INDEXER, RELAY_LIST, TRUST_LIST


def observers(house: str, enrolled: DataFrame, events: DataFrame, swept: DataFrame | None = None) -> DataFrame:
    """observer, house (whether it is the house's own key): the house, who enrolled, and authors of stored and of swept trust lists."""
    authors = [enrolled.select("observer"), *(e.where(F.col("kind") == TRUST_LIST).select(F.col("pubkey").alias("observer")) for e in (events, swept) if e is not None)]
    out = enrolled.sparkSession.range(1).select(F.lit(house).alias("observer"))
    for a in authors:
        out = out.union(a)
    return out.where("observer is not null").distinct().withColumn("house", F.col("observer") == house)


def index_relays_of(authors: DataFrame, events: DataFrame, seeds: list[str]) -> DataFrame:
    """author, pos, relay of each author's newest index relay list, or the seeds where it is missing or empty."""
    lists = newest(events.where(F.col("kind") == INDEXER), ["pubkey"]).select(F.col("pubkey").alias("author"), F.array_distinct(tag_values(F.col("tags"), "relay")).alias("own"))
    both = authors.select("author").distinct().join(lists, "author", "left")
    return both.select("author", F.posexplode(F.when(F.size("own") > 0, F.col("own")).otherwise(F.array(*map(F.lit, seeds)))).alias("pos", "relay"))


def index_relays(events: DataFrame, author: str, seeds: list[str]) -> DataFrame:
    """pos, relay of one author's index relays, as ``index_relays_of`` has them."""
    one = events.sparkSession.range(1).select(F.lit(author).alias("author"))
    return index_relays_of(one, events.where(F.col("pubkey") == author), seeds).select("pos", "relay")


def united(*relays: DataFrame) -> DataFrame:
    """relay once each, in the order of the first list that has it: rank."""
    out = None
    for i, r in enumerate(relays):
        own = r.select("relay", F.struct(F.lit(i).alias("list"), F.col("pos").cast("long").alias("pos")).alias("rank"))
        out = own if out is None else out.union(own)
    return out.groupBy("relay").agg(F.min("rank").alias("rank"))


def outboxes(seekers: DataFrame, events: DataFrame, index: DataFrame) -> DataFrame:
    """observer, relay, own: an observer's routable write relays, else the index relays (``own`` is false then)."""
    lists = trust.relay_lists(events.where(F.col("kind") == RELAY_LIST)).where(routable(F.col("relay")))
    own = seekers.select("observer").join(lists.select(F.col("author").alias("observer"), "relay").distinct(), "observer")
    # The index relays are a short list that every observer without a relay gets in full.
    rest = seekers.select("observer").join(own, "observer", "left_anti")
    listed = F.array_sort(F.collect_set("relay"))
    given = rest.crossJoin(index.agg(listed.alias("relays"))).select("observer", F.explode("relays").alias("relay"))
    return own.withColumn("own", F.lit(True)).union(given.withColumn("own", F.lit(False)))


def provider_relays(events: DataFrame, service: str = "30382:rank") -> DataFrame:
    """service, relay (where its scores are fetched), hints: the hint of the newest trust list that has one, ties to the least relay; how many relays are hinted."""
    lists = newest(events.where(F.col("kind") == TRUST_LIST), ["pubkey"])
    named = F.explode(F.filter("tags", lambda t: (F.size(t) > 2) & (t[0] == service)))
    hints = lists.select("created_at", named.alias("t")).select("created_at", F.col("t")[1].alias("service"), F.col("t")[2].alias("relay")).where("relay <> ''")
    return hints.groupBy("service").agg(F.min_by("relay", F.struct(-F.col("created_at"), "relay")).alias("relay"), F.count_distinct("relay").alias("hints"))


def identities(missing: DataFrame, aggregators: DataFrame, popular: DataFrame) -> DataFrame:
    """author, what, source: missing profiles and relay lists found at the aggregators, and what they lack at the popular relays.

    Each frame has author and what; ``source`` is null where neither has it.
    """
    keys = ["author", "what"]
    first = missing.select(*keys).distinct().join(aggregators.select(*keys).distinct().withColumn("first", F.lit(True)), keys, "left")
    rest = first.where("first is null").select(*keys).join(popular.select(*keys).distinct().withColumn("second", F.lit(True)), keys, "left")
    return first.where("first").select(*keys, F.lit("aggregator").alias("source")).union(rest.select(*keys, F.when(F.col("second"), F.lit("popular")).alias("source")))


def least_loaded(lists: DataFrame) -> DataFrame:
    """author, relay: of each author's relays the one that the fewest authors list, ties to the least relay."""
    load = lists.groupBy("relay").agg(F.count_distinct("author").alias("load"))
    return lists.join(load, "relay").groupBy("author").agg(F.min_by("relay", F.struct("load", "relay")).alias("relay"))


def work_map(index: DataFrame, outbox: DataFrame, homes: DataFrame, routes: DataFrame) -> DataFrame:
    """relay, sweep, outboxes, services, authors: what each relay is asked for, in counts and a flag."""
    parts = [(index, "sweep", "relay"), (outbox, "outboxes", "observer"), (homes, "services", "service"), (routes, "authors", "author")]
    out = None
    for df, name, column in parts:
        own = df.select("relay", F.lit(name).alias("task"), F.col(column).cast("string").alias("who")).distinct()
        out = own if out is None else out.union(own)
    count = lambda name: F.count_if(F.col("task") == name).alias(name)
    return out.groupBy("relay").agg((F.count_if(F.col("task") == "sweep") > 0).alias("sweep"), count("outboxes"), count("services"), count("authors"))


def crawl(replicas: DataFrame, house: str, seeds: list[str], home: str, connected_only: bool = True) -> dict[str, DataFrame]:
    """A pass over ``replicas`` (relay and an event's columns): observers, edges, scores and the trust lists' authors reached.

    Lists come from the index relays first; each observer's own outbox then has the say, and providers' scores come from
    the relay chosen for the service. With ``connected_only`` observers count whom the house reaches through scored
    subjects, else all whose lists the sweep finds.
    """
    spark = replicas.sparkSession
    seeded = spark.range(1).select(F.posexplode(F.array(*map(F.lit, seeds))).alias("pos", "relay"))
    swept = replicas.join(seeded.select("relay"), "relay", "left_semi").drop("relay").dropDuplicates(["id"])
    known = observers(house, spark.createDataFrame([], "observer string"), swept)
    where = outboxes(known, swept, seeded)
    own = replicas.join(where.select("relay", F.col("observer").alias("pubkey")), ["relay", "pubkey"], "left_semi").drop("relay")
    lists = stored_events(own.unionByName(swept).dropDuplicates(["id"])).where(F.col("kind") == TRUST_LIST)
    # the pass goes over its lists and scores again and again, so it keeps them with its other files
    kept = lambda df, name: df.write.parquet(f"{home}/{name}") or spark.read.schema(df.schema).parquet(f"{home}/{name}")
    lists = kept(lists, "lists")
    edges = trust.provider_edges(lists)
    homes = provider_relays(lists)
    scored = kept(trust.scores(replicas.join(homes.select("relay", F.col("service").alias("pubkey")), ["relay", "pubkey"], "left_semi").drop("relay").dropDuplicates(["id"])), "scores")
    reached = trust.frontier(edges, scored, spark.range(1).select(F.lit(house).alias("observer")), home)
    active = reached.select("observer") if connected_only else known.select("observer")
    return {"observers": active, "edges": edges.join(active, "observer", "left_semi"), "scores": scored, "reached": reached}
