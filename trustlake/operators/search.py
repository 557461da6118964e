"""Search over tiers of text, ranked by BM25 and by the searcher's trust in the author."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.functions.columns import first_tag, location_text, profile_field, tag_values

#: Kinds whose events have a title (or the tag named) first, and which tags come second. Kinds beside these are searched by content.
PRIMARY = {1: ["subject"], 31337: ["subject"], 1621: ["subject"], 1618: ["subject"], 9802: ["comment", "context"], 30617: ["name"], 1337: ["name"], 30009: ["name"], 34550: ["name"], 39000: ["name"], 40: ["name"], 41: ["name"], 32267: ["name"], 31990: ["name", "display_name"], 30312: ["room", "title"], 30313: ["room", "title"]}
TITLED = [11, 20, 21, 22, 2003, 30023, 30818, 30402, 30311, 1313, 31922, 31923, 31924, 36787, 34139, 54, 10154, 30030, 15128, 35128, 30000, 39089, 10003, 30001, 30003, 30004, 30005, 30006, 30063, 30267, 30002, 39092, 39701, 30015]
SECONDARY = {
    "summary": [30023, 30818, 30402, 30311, 1313, 31922, 31923, 31924, 1063, 9041, 30312, 30313, 32267],
    "description": [34139, 54, 10154, 30030, 30617, 1337, 30009, 34550, 15128, 35128, 30000, 39089, 10003, 30001, 30003, 30004, 30005, 30006, 30063, 30267, 30002, 39092, 39701, 30015],
    "about": [39000, 40, 41, 31990],
    "t": [1, 30023, 30015],
    "rules": [34550],
    "artist": [36787],
    "album": [36787],
}
#: Kinds that are searched by their content alone.
OTHERS = [1301, 30817, 31890, 33401, 34235, 34236]
BODILESS = [31337, 39000, 40, 41, 31990, 15128, 35128, 30000, 39089, 10003, 30001, 30003, 30004, 30005, 30006, 30063, 30267, 30002, 39092, 39701, 30015]
PROFILE_FIELDS = (("name", "display_name"), ("about", "nip05", "lud16", "website"))


def content_kinds() -> list[int]:
    """Kinds that are fetched for a scored author: those that are searched, deletions and erasures; ascending."""
    return sorted({0, *PRIMARY, *TITLED, *(k for kinds in SECONDARY.values() for k in kinds), *OTHERS, 5, 62})


def text_tiers(events: DataFrame) -> DataFrame:
    """id, author, primary, secondary, body, location of events, by kind; texts without a word are empty."""
    kind, tags = F.col("kind"), F.col("tags")
    joined = lambda *parts: F.trim(F.concat_ws(" ", *parts))
    named = {**PRIMARY, **{k: ["title"] for k in TITLED}}
    by_tags: dict[tuple, list[int]] = {}
    for k, names in named.items():
        by_tags.setdefault(tuple(names), []).append(k)
    primary = F.when(kind == 0, joined(*[profile_field(F.col("content"), f) for f in PROFILE_FIELDS[0]]))
    for names, kinds in sorted(by_tags.items()):
        primary = primary.when(kind.isin(*kinds), joined(*[first_tag(tags, t) for t in names]))
    tiers = [F.when(kind.isin(*kinds), F.array_join(tag_values(tags, t), " ")) for t, kinds in SECONDARY.items()]
    secondary = F.when(kind == 0, joined(*[profile_field(F.col("content"), f) for f in PROFILE_FIELDS[1]])).otherwise(joined(*tiers))
    body = F.when(kind.isin(0, *BODILESS), F.lit("")).otherwise(F.coalesce("content", F.lit("")))
    return events.select("id", F.col("pubkey").alias("author"), F.coalesce(primary, F.lit("")).alias("primary"), secondary.alias("secondary"), body.alias("body"), location_text(tags).alias("location"))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def searched(texts: DataFrame, terms: list[str], trust: DataFrame | None, floor: float, save, tiers: dict[str, float] | None = None, k1: float = 1.2, b: float = 0.75, spam: bool = False, fuzzy: bool = False, letters: str | None = None) -> DataFrame:
    """id, author, score: the tiers' weighted BM25 of the terms, times one and the searcher's trust in the author.

    ``texts`` has id, author and a column for each tier; ``trust`` author and trust (an author without any has none).
    Authors below the floor are shown only with ``spam``; without a known searcher (``trust`` is None) there is nothing
    to rank by, so nothing is found. With ``fuzzy`` a word within one edit of a term of five letters or more counts as
    it. The texts are split once; lengths and counts of the terms are written, and the corpus statistics, one row,
    come from there.
    """
    tiers = tiers or {"text": 1.0}
    if trust is None:
        return texts.select("id", "author", F.lit(0.0).alias("score")).limit(0)
    same = lambda t: (lambda w: (w == t) | (F.levenshtein(w, F.lit(t), 1) >= 0)) if fuzzy and len(t) >= 5 else (lambda w: w == t)
    split = (lambda c: F.filter(F.split(F.lower(c), letters), lambda w: w != "")) if letters else words
    parts = [split(F.col(c)).alias(c) for c in tiers]
    rows = texts.select("id", "author", *parts)
    found = [F.size(F.filter(c, same(t))).alias(f"{c} {i}") for c in tiers for i, t in enumerate(terms)]
    counted = save(rows.select("id", "author", *[F.size(c).alias(f"{c} n") for c in tiers], *found))
    names = [(c, i) for c in tiers for i in range(len(terms))]
    stats = counted.agg(F.count("*").alias("docs"), *[F.avg(f"`{c} n`").alias(f"{c} n") for c in tiers], *[F.count_if(F.col(f"`{c} {i}`") > 0).alias(f"{c} {i}") for c, i in names]).first()
    score = F.lit(0.0)
    for c, i in names:
        df, mean, tf = stats[f"{c} {i}"], stats[f"{c} n"], F.col(f"`{c} {i}`")
        if df:
            idf = math.log(1 + (stats["docs"] - df + 0.5) / (df + 0.5))
            score = score + F.lit(tiers[c] * idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col(f"`{c} n`") / mean))
    hits = counted.where(F.greatest(F.lit(0), *[F.col(f"`{c} {i}`") for c, i in names]) > 0).select("id", "author", score.alias("bm25"))
    gated = hits.join(trust, "author", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0)))
    return (gated if spam else gated.where(F.col("trust") >= floor)).select("id", "author", F.round(F.col("bm25") * (1 + F.col("trust")), 6).alias("score"))


def trust_of(query: DataFrame, reputation: DataFrame) -> DataFrame:
    """author, trust: the dot product of a searcher's weights (observer, weight) with the observers' ranks (observer, subject, rank), out of 100."""
    both = reputation.join(query, "observer").groupBy(F.col("subject").alias("author"))
    return both.agg((F.sum(F.col("weight") * F.col("rank")) / 100.0).alias("trust"))
