"""Mixing sources to target weights: hash-random order, prefix sums of sizes, and a cut at each source's budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustlake.llm.common import text_or_empty, written

#: A source's documents are dealt by their random key to this many ranges, whose sums are added up first.
RANGES = 4096


def word_count(name: str = "text") -> Column:
    """Number of words of a text column, null counting none."""
    spaces = F.regexp_replace(F.col(name).cast("string"), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.trim(spaces)
    n = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + F.when(trimmed == "", 0).otherwise(1)
    return F.coalesce(n, F.lit(0)).cast("long")


def document_key(seed: int = 0) -> Column:
    """A random key of 128 bits hashed from source, doc_id and text; rows that are equal in all three share one."""
    source = F.col("source").cast("string")
    parts = [F.coalesce(F.length(source).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(source, F.lit("")), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}:"), text_or_empty()]
    return F.unhex(F.md5(F.concat(*parts)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """source, source_size, target for a frame of source and size.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all sizes; none is
    asked for more than ``epochs`` times its own size, the excess going to the others by weight. That is a common
    level times the weight, cut at the cap, so the sources are ordered by the level at which they reach their cap and
    the level follows from prefix sums. Windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    per = per.withColumn("full_at", F.col("cap") / F.col("weight"))
    every = Window.partitionBy()
    lower = Window.orderBy("full_rank").rangeBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("full_rank", F.dense_rank().over(Window.orderBy("full_at")))
    total = F.sum("source_size").over(every) * F.lit(share)
    capped = F.coalesce(F.sum("cap").over(lower), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0))
    per = per.withColumn("level", (total - capped) / open_weight)
    # A source that is full has a level no lower than its own cap's; the others' levels are at most the common one.
    common = F.max(F.when(F.col("level") < F.col("full_at"), F.col("level"))).over(every)
    target = F.when(common.isNull() | (F.col("full_at") <= common), F.col("cap")).otherwise(F.col("weight") * common)
    return per.select("source", "source_size", target.alias("target"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: int = 0) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken of each document.

    ``size`` is the number of words (a null text has none). Within a source, documents stand in the order of a random
    key hashed from source, doc_id and text; each is taken whole as often as the target holds the source's whole size, and
    once more up to where the running sum reaches what is left, the last one in part. A source's taken words so add
    up to its target, rounded down, and no document exceeds ``epochs`` times its size. Reruns agree, as do orders of
    the input; rows equal in all three share one key and are told apart by nothing else, so it does not matter which is cut.
    Null sources form a source of their own, empty tables give no rows, columns other than doc_id, text and source
    are not read. A source of any size spreads over ``RANGES`` key ranges: their sums are aggregated before the
    shuffle, added up per source, and only then are running sums taken inside each range.
    """
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"), document_key(seed).alias("key")), "sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("size")), weights, share, epochs)
    ranged = sized.withColumn("range", F.floor(F.conv(F.substring(F.hex("key"), 1, 4), 16, 10).cast("long") * RANGES / (1 << 16)))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("in_range").over(before), F.lit(0)))
    plan = sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.source", "range", "base", "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = running.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.range") == F.col("p.range")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor("target").cast("long") - whole * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - F.col("base") - F.col("ahead")))
    return both.select("doc_id", "d.source", "key", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame, size_column: str = "n_chars", **options) -> DataFrame:
    """The mix itself: each document's row, with its columns, as often as the mix takes it.

    What is taken of a document beyond whole copies is a row with its first words, joined by single spaces; ``size_column``,
    where there is one, is counted anew there. Documents without words take no part.
    """
    # Rows that share a key have equal texts; what the mix takes of them together is given by one of them.
    plan = mix_documents(docs, **options).groupBy("key").agg(F.max("size").alias("mix size"), F.sum("taken").alias("mix taken")).where("`mix taken` > 0")
    keyed = docs.withColumn("mix key", document_key(options.get("seed", 0))).dropDuplicates(["mix key"])
    both = keyed.join(plan, keyed["mix key"] == plan["key"])
    whole = F.floor(F.col("mix taken") / F.col("mix size"))
    copies = both.withColumn("mix rest", F.col("mix taken") % F.col("mix size")).withColumn("mix copy", F.explode(F.sequence(F.lit(1), (whole + (F.col("mix rest") > 0).cast("int")).cast("int"))))
    cut = F.col("mix copy") > whole
    first = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col("mix rest").cast("int")), " ")
    text = F.when(cut, first).otherwise(F.col("text"))
    shown = [text.alias("text") if c == "text" else F.when(cut, F.length(text)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == size_column else keyed[c] for c in docs.columns]
    return copies.select(*shown)
