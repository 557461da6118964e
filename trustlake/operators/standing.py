"""Reputation kept up to date: of a batch of lists and scores only the cells concerned are worked out again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.sources.buckets import BucketedTable


class Standing:
    """observer, subject, rank, as ``trust.reputation`` has them, beside the lists and scores they come from.

    Lists stand by observer and by service, scores by subject and by service, cells by observer, each in buckets. New
    lists concern all cells of their observers; a score concerns the cells of its subject with those whose lists name
    its service. These are the only buckets read and written.
    """

    def __init__(self, spark: SparkSession, home: str, save, buckets: int = 64):
        table = lambda name, schema, key: BucketedTable(spark, f"{home.rstrip('/')}/{name}", schema, key, buckets)
        self.save = save
        self.lists = table("lists", "observer string, service string", "observer")
        self.followers = table("followers", "service string, observer string", "service")
        self.by_subject = table("by-subject", "subject string, service string, rank int", "subject")
        self.by_service = table("by-service", "service string, subject string, rank int", "service")
        self.cells = table("cells", "observer string, subject string, rank int", "observer")

    def apply(self, listed: DataFrame, lists: DataFrame, scores: DataFrame) -> None:
        """Takes in a batch.

        ``listed`` has the observers whose list is new, and ``lists`` (observer, service) all that these lists name, so
        an observer without a row there names nobody now. ``scores`` has service, subject and rank of new scores, one
        for each pair; a null rank takes the score away.
        """
        listed, scores = self.save(listed.select("observer").distinct()), self.save(scores.select("service", "subject", "rank"))
        lists = self.save(lists.join(listed, "observer", "left_semi").select("observer", "service").distinct())
        before = self.save(self.lists.of(listed))
        self.lists.put(listed, lists)
        services = self.save(before.select("service").union(lists.select("service")).distinct())
        self.followers.change(self.followers.buckets_of(services), lambda old: old.join(listed, "observer", "left_anti").select("service", "observer").unionByName(lists.select("service", "observer")))
        pairs = ["service", "subject"]
        for t in (self.by_subject, self.by_service):
            t.change(t.buckets_of(scores), lambda old, names=t.schema.names: old.join(scores, pairs, "left_anti").select(*names).unionByName(scores.where("rank is not null").select(*names)))
        # cells of a score whose observer's list is not new
        touched = scores.join(self.followers.of(scores), "service").select("observer", "subject").distinct().join(listed, "observer", "left_anti")
        touched = self.save(touched.select("observer", "subject"))
        ranked = self.lists.of(listed).join(self.by_service.of(lists), "service").select("observer", "subject", "rank")
        named = touched.join(self.lists.of(touched), "observer")
        ranked = ranked.unionByName(named.join(self.by_subject.of(touched), pairs).select("observer", "subject", "rank"))
        fresh = self.save(ranked.groupBy("observer", "subject").agg(F.max("rank").alias("rank")))
        concerned = self.cells.buckets_of(listed.union(touched.select("observer")))
        self.cells.change(concerned, lambda old: old.join(listed, "observer", "left_anti").join(touched, ["observer", "subject"], "left_anti").select("observer", "subject", "rank").unionByName(fresh))

    def reputation(self, observers: DataFrame | None = None) -> DataFrame:
        return self.cells.read() if observers is None else self.cells.of(observers)
