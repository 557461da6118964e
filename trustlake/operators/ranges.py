"""Differences of two sets of ids by fingerprints of ranges: only ranges that differ are gone into and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.sources.buckets import BucketedTable

#: Bits of an id's hash at each level of the tree; the last one's ranges hold the ids.
LEVELS = (4, 8, 12, 16)


def place(bits: int, column: str = "id") -> Column:
    """The range of an id: the first bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - bits)


def code(bits: int, at: Column) -> Column:
    """A number for a range that no range of another level has."""
    return at + F.lit(1 << bits).cast("long")


class RangeTree:
    """Ids in buckets of ranges, and for each range of each level how many there are and two sums of their hashes without carry.

    Sums of equal sets are equal, and those of different ones differ but for a chance of 2**-128; adding and taking away
    ids changes only the ranges they are in.
    """

    def __init__(self, spark: SparkSession, home: str, save, buckets: int = 256):
        home = home.rstrip("/")
        self.save = save
        self.ids = BucketedTable(spark, f"{home}/ids", "top long, leaf long, id string", "top", buckets, ("leaf", "id"))
        self.sums = BucketedTable(spark, f"{home}/sums", "code long, n long, x long, y long", "code", max(1, buckets // 16), ("code",))

    def _placed(self, ids: DataFrame) -> DataFrame:
        text = ids.where("id is not null").select(F.col("id").cast("string").alias("id")).distinct()
        return text.select(place(LEVELS[1]).alias("top"), place(LEVELS[-1]).alias("leaf"), "id")

    def _summed(self, placed: DataFrame, sign: int = 1) -> DataFrame:
        codes = F.explode(F.array(*[code(b, place(b)) for b in LEVELS]))
        parts = placed.select(codes.alias("code"), F.xxhash64(F.lit(1), "id").alias("x"), F.xxhash64(F.lit(2), "id").alias("y"))
        return parts.groupBy("code").agg((F.count("*") * sign).alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))

    def _change(self, placed: DataFrame, sign: int) -> None:
        """Adds or takes away ids that are, or are not, there; ``placed`` is written."""
        if sign > 0:
            self.ids.change(self.ids.buckets_of(placed), lambda old: old.unionByName(placed))
        else:
            self.ids.change(self.ids.buckets_of(placed), lambda old: old.join(placed.select("leaf", "id"), ["leaf", "id"], "left_anti"))
        change = self.save(self._summed(placed, sign))
        merged = lambda old: old.unionByName(change).groupBy("code").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where("n > 0")
        self.sums.change(self.sums.buckets_of(change), merged)

    def add(self, ids: DataFrame) -> None:
        """Adds ids; those that are there, nulls and repeats change nothing."""
        placed = self._placed(ids)
        self._change(self.save(placed.join(self.ids.of(placed), ["leaf", "id"], "left_anti").select("top", "leaf", "id")), 1)

    def remove(self, ids: DataFrame) -> None:
        placed = self._placed(ids)
        self._change(self.save(placed.join(self.ids.of(placed).select("leaf", "id"), ["leaf", "id"], "left_semi").select("top", "leaf", "id")), -1)

    def need_have(self, remote: RangeTree) -> DataFrame:
        """id and side: ``need`` stands only in the other tree, ``have`` only in this one.

        From level to level the ranges within those that differed are compared; the ids of the last ones are compared
        as they are. ``compared`` counts the ranges of each level.
        """
        self.compared: list[int] = []
        ranges = None
        for i, bits in enumerate(LEVELS):
            if ranges is None:
                asked = self.ids.spark.range(1 << bits).select(code(bits, F.col("id")).alias("code"))
            else:
                step = 1 << (bits - LEVELS[i - 1])
                within = F.sequence(F.lit(0), F.lit(step - 1))
                asked = ranges.select(F.explode(F.transform(within, lambda k: code(bits, F.col("at") * step + k))).alias("code"))
            asked = self.save(asked)
            self.compared.append(asked.count())
            both = asked.join(self.sums.of(asked).withColumnsRenamed({"n": "n1", "x": "x1", "y": "y1"}), "code", "left").join(remote.sums.of(asked), "code", "left")
            same = F.col("n").eqNullSafe(F.col("n1")) & F.col("x").eqNullSafe(F.col("x1")) & F.col("y").eqNullSafe(F.col("y1"))
            ranges = self.save(both.where(~same).select((F.col("code") - (1 << bits)).alias("at")))
        tops = ranges.select(F.shiftright("at", LEVELS[-1] - LEVELS[1]).alias("top")).distinct()
        leaves = ranges.select(F.col("at").alias("leaf"))
        mine, theirs = (t.ids.of(tops).join(leaves, "leaf", "left_semi").select("id") for t in (self, remote))
        need = theirs.join(mine, "id", "left_anti").withColumn("side", F.lit("need"))
        return need.union(mine.join(theirs, "id", "left_anti").withColumn("side", F.lit("have")))
