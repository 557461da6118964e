"""Near-duplicate lines within one edit, by a deletion-neighbourhood join in DataFrame operations only.

A line is cut into four segments. Two lines within one edit agree outside one segment, so lines that share the hash of
what is outside it with no other line need no look; longer segments are cut again in the same way until they are short,
so a line costs time in proportion to its length. What is left emits its deletion variants of those short segments as
hashed keys; lines with an equal variant are joined, their edit distance is verified, and the earliest is kept. The bound
is one edit, as in the SQL of op1: with each further edit the variants grow by a factor of a segment's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import row_hash, written

#: Segments of a line, parts of a segment that is cut again, and the length up to which a segment emits variants.
SEGMENTS, PARTS, FINE = 4, 8, 32
LINE = ["id", "id2"]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, salt, pos, line, id, id2 (two hashes of 64 bits that tell a line), n of the lines that are not blank; a null text has none."""
    # The hash of a text is taken below the explode, or it would be taken again for each line.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("salt"), F.split(F.col("text").cast("string"), "\n").alias("parts"))
    told = rows.select("doc_id", "salt", F.posexplode("parts").alias("pos", "line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return told.select("*", F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2"), F.length("line").alias("n"))


def place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("pos"))


def outside(base: str, low: str, high: str, skip: str) -> str:
    """SQL for the hash of a line without the segment [low, high) of its base; ``skip`` is 1 for the longer line of a pair, whose base is one less than its length."""
    return f"xxhash64({base}, {low}, {high}, substring(line, 1, {low}), substring(line, {high} + 1 + {skip}))"


def first_keys() -> list[tuple[str, str, str, bool]]:
    """(key, low, high, longer) as SQL, for each segment of a line as the base and as the longer line of a pair."""
    out = []
    for longer in (False, True):
        base = f"(n - {int(longer)})"
        ends = [f"cast(floor({base} * {i} / {SEGMENTS}) as int)" for i in range(SEGMENTS + 1)]
        out += [(outside(base, a, b, str(int(longer))), a, b, longer) for a, b in zip(ends, ends[1:])]
    return out


def with_partner(keyed: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key another line has too, at least one of them as the base of a pair.

    Hot keys collapse before the shuffle; the join is a merge at every size, whose hot keys Spark splits.
    """
    by = keyed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min("longer").alias("longer"))
    return keyed.join(by.where("least <> most and not longer").select("key").hint("merge"), "key").drop("key")


def duplicate_lines(docs: DataFrame, min_chars: int = 16) -> tuple[DataFrame, DataFrame]:
    """(first, near): ``first`` has for each different line its number and where it stands first, ``near`` the lines whose first place goes too."""
    lines, keys = lines_of(docs), first_keys()
    keyed = lines.select(*LINE, "n", place().alias("place"), *[F.when(F.col("n") >= min_chars, F.expr(k[0])).alias(f"k{j}") for j, k in enumerate(keys)])
    # Copies of a line have equal keys; they collapse before the shuffle.
    first = written(keyed.groupBy(*LINE).agg(F.min("place").alias("place"), F.min("n").alias("n"), F.count("*").alias("copies"), *[F.min(f"k{j}").alias(f"k{j}") for j in range(len(keys))]), "lines")
    each = F.explode(F.array(*[F.struct(F.col(f"k{j}").alias("key"), F.expr(low).alias("low"), F.expr(high).alias("high"), F.lit(longer).alias("longer")) for j, (_, low, high, longer) in enumerate(keys)]))
    asked = with_partner(first.where(F.col("n") >= min_chars).select(*LINE, each.alias("k")).select(*LINE, "k.*"))
    asked = written(asked, "segments")
    wanted = asked.select(*LINE).distinct().join(first.select(*LINE, "n", "place"), LINE)
    wanted = written(wanted, "wanted-lines")
    own = lines.where(F.col("n") >= min_chars).select(*LINE, "line", place().alias("at"))
    texts = written(own.join(wanted.hint("merge"), LINE).where("at <=> place").dropDuplicates(LINE).select(*LINE, "n", "place", "line"), "line-texts")
    longest = texts.agg(F.max("n")).first()[0] or 0
    width = longest // SEGMENTS + 1
    while width > FINE:
        cut = asked.where(f"high - low > {FINE}").join(texts, LINE).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        ends = [f"cast(low + floor((high - low) * (j + {k}) / {PARTS}) as int)" for k in (0, 1)]
        cut = cut.select(*LINE, "longer", F.expr("if(longer, n - 1, n)").alias("base"), F.expr(ends[0]).alias("low"), F.expr(ends[1]).alias("high"), "line")
        cut = written(cut.select(*LINE, F.expr(outside("base", "low", "high", "if(longer, 1, 0)")).alias("key"), "low", "high", "longer"), "finer-keys")
        asked = written(asked.where(f"high - low <= {FINE}").unionByName(with_partner(cut)), "segments")
        width = width // PARTS + 1
    spots = F.explode(F.expr("sequence(low, high - if(longer, 0, 1))"))
    at = asked.where("longer or high > low").join(texts, LINE).select(*LINE, "place", "line", "n", "longer", spots.alias("p"))
    less = "concat(substring({0}, 1, p), substring({0}, p + 2))"
    # One letter changed: both lines lose the letter at one place. One letter more: the longer line loses it and equals the other.
    changed = at.where("not longer").select(*LINE, "place", "p", F.expr(f"xxhash64('changed', p, {less.format('line')})").alias("key"), F.lit(0).alias("role"))
    longer = at.where("longer").select(*LINE, "place", "p", F.expr(f"xxhash64('whole', {less.format('line')})").alias("key"), F.lit(1).alias("role"))
    whole = texts.select(*LINE, "place", F.lit(0).alias("p"), F.expr("xxhash64('whole', line)").alias("key"), F.lit(2).alias("role"))
    variants = written(changed.union(longer).union(whole), "variants")
    best = [F.min(F.when(F.col("role") == r, F.struct("place", *LINE, "p"))).alias(f"best{r}") for r in range(3)]
    shared = written(variants.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), *best).where("least <> most").drop("least", "most"), "shared-variants")
    found = variants.join(shared, "key").withColumn("partner", F.expr("case role when 0 then best0 when 1 then best2 else best1 end"))
    spot = F.when(F.col("role") == 2, F.col("partner.p")).otherwise(F.col("p"))
    pairs = found.where("partner.place < place").select(*LINE, F.col("partner.id").alias("other"), F.col("partner.id2").alias("other2"), "role", spot.alias("p")).distinct()
    left, right = texts.select(*LINE, F.col("line").alias("a")), texts.select(F.col("id").alias("other"), F.col("id2").alias("other2"), F.col("line").alias("b"))
    # The distance is one if the lines are equal without the letter at p, which is verified in time in proportion to their length.
    equal = F.expr(f"case role when 0 then {less.format('a')} = {less.format('b')} when 1 then {less.format('a')} = b else a = {less.format('b')} end")
    near = pairs.join(left, LINE).join(right, ["other", "other2"]).where(equal).select(*LINE).distinct()
    return first.select(*LINE, "place", "copies"), written(near, "near-lines")


def lost_lines(docs: DataFrame, min_chars: int = 16) -> DataFrame:
    """doc_id, salt (hash of the text) and removed (positions) of the different rows that lose lines."""
    first, near = duplicate_lines(docs, min_chars)
    goes = first.join(near.withColumn("near", F.lit(True)), LINE, "left").where("near or copies > 1")
    goes = written(goes.select(*LINE, "place", F.coalesce("near", F.lit(False)).alias("near")), "going-lines")
    gone = lines_of(docs).select("doc_id", "salt", "pos", *LINE).join(goes.hint("merge"), LINE).where(F.col("near") | (F.col("place") < place()))
    return gone.groupBy("doc_id", "salt").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def without(items: str | Column, places: str) -> Column:
    """An array without the items at ``places``, in time that follows the lengths."""
    rest = F.array_except(F.sequence(F.lit(0), F.size(items) - 1), places)
    return F.transform(rest, lambda p: F.get(items, p))


def removed_lines(docs: DataFrame, min_chars: int = 16) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (positions), chars_removed, kept (hash of the kept lines' hashes in order) of every row.

    A line that is not blank goes if the same line stands earlier, by doc_id (null last) and then position; a line of at
    least ``min_chars`` characters also if another such line within one edit (a letter more, less or other) does: in
    shorter ones a letter makes another word. This is judged on the input, not on what is left. Lines at one place in
    rows of equal doc_id are not earlier than each other. Rows are told apart by doc_id and a hash of the text, so rows
    of equal or null doc_id lose their own lines only, and equal rows lose the same. A null text has no lines and an
    empty one one. Empty tables give no rows; only doc_id and text are read.
    """
    parts = F.split(F.col("text").cast("string"), "\n")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("salt"), F.transform(parts, lambda x: F.length(x)).alias("sizes"), F.transform(parts, lambda x: F.xxhash64(x)).alias("hashes"))
    d = lost_lines(docs, min_chars).alias("d")
    out = rows.alias("i").join(d, F.col("i.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("i.salt") == F.col("d.salt")), "left")
    out = out.select("i.doc_id", F.coalesce("sizes", F.array().cast("array<int>")).alias("sizes"), "hashes", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda s, p: s + F.get("sizes", p).cast("long"))
    kept = F.xxhash64(without("hashes", "removed"))
    return out.select("doc_id", F.size("sizes").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed", lost.alias("chars_removed"), kept.alias("kept"))


def without_duplicate_lines(docs: DataFrame, min_chars: int = 16, size_column: str = "n_chars") -> DataFrame:
    """``docs`` without the lines that ``removed_lines`` names; documents that lose every line go.

    The columns stay as they are; ``size_column``, where there is one, is counted anew for changed texts. Equal rows
    lose the same lines, so a row never loses what it has itself kept in another.
    """
    gone = lost_lines(docs, min_chars).select(F.col("doc_id").alias("gone_id"), F.col("salt").alias("gone_salt"), F.col("removed").alias("removed lines"))
    kept = without(F.split("text", "\n"), "removed lines")
    both = docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (row_hash(docs["text"]) == gone["gone_salt"]), "left")
    same = F.col("removed lines").isNull() | F.col("text").isNull()
    text = F.when(same, F.col("text")).otherwise(F.array_join(kept, "\n"))
    changed = [text.alias("text") if c == "text" else F.when(same, F.col(c)).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c) if c == size_column else docs[c] for c in docs.columns]
    return both.where(same | (F.size("removed lines") < F.size(F.split("text", "\n")))).select(*changed)
