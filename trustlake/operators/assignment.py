"""Each author to one of its own relays, with loads as even as the lists allow, by rounds of bids and rising prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def auction(lists: DataFrame, capacity: int, save, rounds: int) -> DataFrame | None:
    """author, relay with at most ``capacity`` authors a relay; None where that cannot be, or not in so many rounds.

    An author without a place bids at the cheapest of its relays one more than the next cheapest costs. A relay keeps its
    highest bids, and once it is full its price is the least of them. Prices tell how many moves away a free place is,
    so an author all of whose relays cost more than there are relays has none in reach.
    """
    relays = lists.select("relay").distinct().count()
    top = relays + 1
    kept = save(lists.sparkSession.createDataFrame([], lists.select("author", "relay").schema).withColumn("bid", F.lit(0)))
    for _ in range(rounds):
        full = kept.groupBy("relay").agg(F.count("*").alias("k"), F.min("bid").alias("least")).where(F.col("k") >= capacity)
        free = lists.join(kept.select("author"), "author", "left_anti").join(full, "relay", "left").withColumn("price", F.coalesce("least", F.lit(0)))
        offer = F.struct("price", F.xxhash64("author", "relay").alias("h"), "relay")
        by = free.groupBy("author").agg(F.min(offer).alias("first"), F.count("*").alias("choices"), F.min_by("price", F.struct("price", F.xxhash64("author", "relay"))).alias("cheapest"), F.slice(F.sort_array(F.collect_list("price")), 2, 1).alias("next"))
        bids = save(by.select("author", F.col("first.relay").alias("relay"), "cheapest", F.least(F.coalesce(F.get("next", F.lit(0)), F.lit(top)) + 1, F.lit(top)).alias("bid")))
        state = bids.agg(F.count("*").alias("n"), F.max("cheapest").alias("worst")).first()
        if not state["n"]:
            return kept.select("author", "relay")
        if state["worst"] >= top:
            return None
        order = Window.partitionBy("relay").orderBy(F.desc("bid"), F.xxhash64("author"), "author")
        every = kept.unionByName(bids.select("author", "relay", "bid"))
        kept = save(every.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= capacity).drop("nth"))
    return None


def balanced(lists: DataFrame, save, rounds: int = 40) -> DataFrame:
    """author, relay: each listed author at one of its own relays; the greatest load is below twice the least possible one.

    Capacities start at the mean load and double while an auction shows that they are too small, so the last one that
    failed is below the least possible load. An auction that has not ended after ``rounds`` counts as failed, which may
    cost another doubling. Repeated and null rows of ``lists`` (author, relay) change nothing.
    """
    lists = save(lists.where("author is not null and relay is not null").select("author", "relay").distinct())
    sizes = lists.agg(F.count_distinct("author").alias("a"), F.count_distinct("relay").alias("r")).first()
    if not sizes["a"]:
        return lists
    capacity = -(-sizes["a"] // sizes["r"])
    while (found := auction(lists, capacity, save, rounds)) is None:
        capacity *= 2
    return found
