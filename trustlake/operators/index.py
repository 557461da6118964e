"""An inverted index of texts in tiers: postings by term, from which a search reads those of its own terms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.functions import columns as C
from trustlake.operators.search import words
from trustlake.sources.buckets import BucketedTable

#: Blocks that documents are dealt into; each term keeps a bound of its weight in each.
BLOCKS = 64
#: What ``sort:`` may name: the order of the results.
SORTS = {"score": [F.desc, "score"], "rank": [F.desc, "trust"], "new": [F.desc, "created_at"], "old": [F.asc, "created_at"]}


def variants(word: Column) -> Column:
    """A word and what is left of it without one of its letters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.array_append(cut, word))


class TextIndex:
    """Postings (term, tier, block, id, author, created_at, tf, n of the tier's words), bounds (term, tier, block: the greatest tf and least n), variants of terms, and sums of each tier.

    All but the sums stand in buckets. ``build`` writes them in one pass over the texts; a search reads the buckets of
    its terms, and with a limit first the blocks whose bounds are the greatest, then those only whose bound is above the
    least score found.
    """

    def __init__(self, spark: SparkSession, home: str, save, buckets: int = 64):
        table = lambda name, schema, key, *order: BucketedTable(spark, f"{home.rstrip('/')}/{name}", schema, key, buckets, order)
        self.spark, self.save = spark, save
        self.postings = table("postings", "term string, tier string, block int, id string, author string, created_at long, tf long, n long", "term", "term", "block")
        self.bounds = table("bounds", "term string, tier string, block int, tf long, n long, df long", "term")
        self.variants = table("variants", "variant string, term string", "variant")
        self.sums = table("sums", "tier string, docs long, words long", "tier")

    def build(self, texts: DataFrame, tiers: list[str]) -> None:
        """Indexes texts (id, author, created_at and a column for each tier), in place of what was indexed before."""
        split = texts.select("id", "author", "created_at", F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), words(F.coalesce(F.col(t), F.lit(""))).alias("w")) for t in tiers])).alias("t"))
        split = self.save(split.select("id", "author", "created_at", "t.tier", F.size("t.w").cast("long").alias("n"), "t.w"))
        every = set(range(self.postings.buckets))
        one = split.select("id", "author", "created_at", "tier", "n", F.explode("w").alias("term"))
        counted = one.groupBy("id", "author", "created_at", "tier", "n", "term").agg(F.count("*").alias("tf")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(BLOCKS)).cast("int"))
        self.postings.change(every, lambda old: counted)
        held = self.postings.read()
        self.bounds.change(every, lambda old: held.groupBy("term", "tier", "block").agg(F.max("tf").alias("tf"), F.min("n").alias("n"), F.count("*").alias("df")))
        terms = self.bounds.read().select("term").distinct()
        self.variants.change(every, lambda old: terms.select(F.explode(variants(F.col("term"))).alias("variant"), "term"))
        self.sums.change(every, lambda old: split.groupBy("tier").agg(F.count("*").alias("docs"), F.sum("n").alias("words")))

    def expanded(self, terms: list[str], fuzzy: bool) -> DataFrame:
        """asked, term: the terms, and with ``fuzzy`` the indexed words within one edit of those of five letters or more."""
        asked = self.spark.createDataFrame([(t,) for t in dict.fromkeys(terms)], "asked string").withColumn("term", F.col("asked"))
        if not fuzzy:
            return asked
        long = asked.where(F.length("asked") >= 5)
        cut = long.select("asked", F.explode(variants(F.col("asked"))).alias("variant"))
        near = self.variants.of(cut).join(cut, "variant").where(F.levenshtein("term", "asked") <= 1)
        return asked.union(near.select("asked", "term")).distinct()

    def search(self, terms: list[str], tiers: dict[str, float], trust: DataFrame | None, floor: float = 0.0, spam: bool = False, fuzzy: bool = False, limit: int | None = None, sort: str = "score", k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """id, author, created_at, trust, score: what ``search.searched`` finds, by postings; see there for trust, floor and spam.

        ``sort`` is one of ``SORTS``, ties to the smaller id; ``limit`` keeps the first ones.
        """
        names = "id string, author string, created_at long, trust double, score double"
        if trust is None or not terms:
            return self.spark.createDataFrame([], names)
        sums = {r["tier"]: r for r in self.sums.read().where(F.col("tier").isin(*tiers)).collect()}
        wanted = self.save(self.expanded(terms, fuzzy))
        bounds = self.bounds.of(wanted).where(F.col("tier").isin(*tiers)).join(wanted, "term")
        mean = {t: r["words"] / r["docs"] for t, r in sums.items() if r["docs"]}
        found = self.save(self.postings.of(wanted).where(F.col("tier").isin(*tiers)).join(wanted, "term").groupBy("asked", "tier", "id").agg(F.lit(1).alias("one")).groupBy("asked", "tier").agg(F.count("*").alias("df"))) if fuzzy else bounds.groupBy("asked", "tier").agg(F.sum("df").alias("df"))
        idf = {(r["asked"], r["tier"]): math.log(1 + (sums[r["tier"]]["docs"] - r["df"] + 0.5) / (r["df"] + 0.5)) for r in found.collect()}
        if not idf:
            return self.spark.createDataFrame([], names)
        weight = F.lit(0.0)
        for (t, tier), x in idf.items():
            weight = F.when((F.col("asked") == t) & (F.col("tier") == tier), tiers[tier] * x).otherwise(weight)
        average = F.lit(1.0)
        for tier, x in mean.items():
            average = F.when(F.col("tier") == tier, x).otherwise(average)
        value = weight * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / average))

        def scored(blocks: list[int] | None) -> DataFrame:
            rows = self.postings.of(wanted).where(F.col("tier").isin(*tiers))
            rows = rows if blocks is None else rows.where(F.col("block").isin(*blocks))
            by = rows.join(wanted, "term").groupBy("asked", "tier", "id", "author", "created_at", "n").agg(F.sum("tf").alias("tf"))
            hits = by.groupBy("id", "author", "created_at").agg(F.sum(value).alias("bm25"))
            gated = hits.join(trust, "author", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0)))
            gated = gated if spam else gated.where(F.col("trust") >= floor)
            return gated.select("id", "author", "created_at", "trust", F.round(F.col("bm25") * (1 + F.col("trust")), 6).alias("score"))

        way, column = SORTS[sort]
        order = [way(column), "id"]
        if limit is None:
            return scored(None).orderBy(*order)
        if sort != "score":
            return scored(None).orderBy(*order).limit(limit)
        most = trust.agg(F.max("trust")).first()[0] or 0.0
        # the greatest a document of the block can have: the sum of its terms' greatest counts in the shortest text
        best = bounds.groupBy("asked", "tier", "block").agg(F.sum("tf").alias("tf"), F.min("n").alias("n")).groupBy("block").agg(F.sum(value).alias("bound"))
        ranked = [(r["block"], r["bound"] * (1 + max(most, 0.0)) + 1e-6) for r in best.orderBy(F.desc("bound"), "block").collect()]
        head, rest = ranked[: max(1, len(ranked) // 4)], ranked[max(1, len(ranked) // 4) :]
        top = self.save(scored([x for x, _ in head]).orderBy(*order).limit(limit))
        least = top.agg(F.count("*").alias("k"), F.min("score").alias("s")).first()
        more = [x for x, bound in rest if least["k"] < limit or bound >= least["s"]]
        self.skipped = len(rest) - len(more)
        return (top.unionByName(scored(more)) if more else top).orderBy(*order).limit(limit)

    def asked(self, query: str, tiers: dict[str, float], trust: DataFrame | None, floor: float = 0.0, fuzzy: bool = False, limit: int | None = None) -> DataFrame:
        """A search from one string: its words, and the extensions ``filter:rank:N`` (least trust, out of 100), ``include:spam`` and ``sort:`` (see ``SORTS``; others sort by score)."""
        q = F.lit(query)
        r = self.spark.range(1).select(C.search_terms(F.lower(q)).alias("terms"), C.least_rank(q).alias("least"), C.includes_spam(q).alias("spam"), C.search_extension(q, "sort").alias("sort")).first()
        least = floor if r["least"] is None else max(floor, r["least"] / 100)
        return self.search(r["terms"], tiers, trust, least, r["spam"], fuzzy, limit, r["sort"] if r["sort"] in SORTS else "score")
