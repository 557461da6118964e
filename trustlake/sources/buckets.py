"""A table in buckets of its key, of which a change reads and writes the buckets of the keys concerned only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustlake.sources.commits import CommitConflict, Commits


class BucketedTable:
    """Rows by the hash of ``key``; a commit names the folder of each bucket, so readers see whole states.

    ``order`` are columns that a bucket's files are sorted by, for filters to skip parts of them. ``touched`` tells
    which buckets the last read and change went to.
    """

    def __init__(self, spark: SparkSession, home: str, schema: T.StructType | str, key: str, buckets: int = 64, order: tuple[str, ...] = ()):
        self.spark, self.home, self.key, self.buckets, self.order = spark, home.rstrip("/"), key, buckets, order
        self.schema = spark.createDataFrame([], schema).schema
        self.commits = Commits(spark, home)
        self.touched: dict[str, set[int]] = {"read": set(), "written": set()}

    def _latest(self) -> tuple[int, dict]:
        number, document = self.commits.latest()
        if number < 0:
            self.commits.commit(0, {"buckets": self.buckets, "paths": {}})
            number, document = self.commits.latest()
        self.buckets = document["buckets"]
        return number, document

    def bucket(self, column: Column | str | None = None) -> Column:
        return F.pmod(F.xxhash64(self.key if column is None else column), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> set[int]:
        """The buckets of a frame's keys, no more than there are buckets."""
        self._latest()
        return {r["b"] for r in keys.select(self.bucket(F.col(self.key)).alias("b")).distinct().collect()}

    def read(self, only: set[int] | None = None) -> DataFrame:
        paths = self._latest()[1]["paths"]
        chosen = [f"{self.home}/{p}" for b, p in paths.items() if only is None or int(b) in only]
        self.touched["read"] = {int(b) for b in paths if only is None or int(b) in only}
        return self.spark.read.schema(self.schema).parquet(*chosen) if chosen else self.spark.createDataFrame([], self.schema)

    def of(self, keys: DataFrame) -> DataFrame:
        """The rows of a frame's keys, from their buckets."""
        return self.read(self.buckets_of(keys)).join(keys.select(self.key).distinct(), self.key, "left_semi").select(*self.schema.names)

    def change(self, buckets: set[int], work: Callable[[DataFrame], DataFrame]) -> None:
        """Replaces the rows of some buckets by what ``work`` makes of them; refused if another writer was faster."""
        number, document = self._latest()
        paths = document["paths"]
        rows = work(self.read(buckets)).select(*self.schema.names).withColumn("bucket", self.bucket())
        folder = f"data/{uuid.uuid4().hex}"
        out = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.order)
        out.write.partitionBy("bucket").parquet(f"{self.home}/{folder}")
        new = {n.removeprefix("bucket="): f"{folder}/{n}" for n in self.commits.names(folder) if n.startswith("bucket=")}
        kept = {b: p for b, p in paths.items() if int(b) not in buckets}
        if not self.commits.commit(number + 1, {"buckets": self.buckets, "paths": kept | new}):
            self.commits.delete(folder)
            raise CommitConflict(f"version {number + 1} of {self.home} was written meanwhile")
        self.touched["written"] = buckets

    def put(self, keys: DataFrame, rows: DataFrame) -> None:
        """``rows`` in place of all rows of the keys (those of ``rows`` among them)."""
        keys = keys.select(self.key).distinct()
        self.change(self.buckets_of(keys), lambda old: old.join(keys, self.key, "left_anti").select(*self.schema.names).unionByName(rows.select(*self.schema.names)))
