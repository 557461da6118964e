"""SimHash fingerprints of texts, and the groups of those that differ in few bits, by a range join on popcounts of segments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import map_arrow, text_or_empty, written
from trustlake.llm.components import components

SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: The seed of the shingles' XXH64.
SEED = 42
#: Bytes of text whose words are listed at a time.
BLOCK = 1 << 20
#: Cells with more fingerprints are cut into cells of single bits, which hold 65 at most.
MOST = 256


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``BLOCK`` bytes at a time."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes) -> np.ndarray:
    """Eight bytes, lowest bits first: a bit is set if over half the hashes of the shingles of three words have it.

    A text of one or two words is one shingle, and one without words has the fingerprint zero.
    """
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.lower()):
        words = tail + words
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:])), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
        tail = words[-2:]
    if not n and tail:
        only = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], "<u8")
        ones, n = np.unpackbits(only.view(np.uint8), bitorder="little").astype(np.int64), 1
    return np.packbits(2 * ones > n, bitorder="little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and fp (the 64 bits as a signed number) of each row; a null text counts as empty."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints = np.stack([fingerprint(t.as_py()) for t in part.column(1)]).view("<i8").ravel()
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], names=[key, "fp"])

    rows = docs.select(key, F.encode(text_or_empty(text), "utf-8").alias("t"))
    return map_arrow(rows, run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp long", "t")


def signed(value: int) -> Column:
    """An unsigned number of 64 bits as the long with these bits."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def popcounts(fp: Column) -> Column:
    """How many bits each of the 32 segments of two bits has, packed into the places of the segments."""
    odd = signed(0x5555555555555555)
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(odd), fp.bitwiseAND(odd)
    return high.bitwiseXOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def cells_around(at: Column) -> Column:
    """The grid cells within Manhattan distance one of packed popcounts, which are 0, 1 or 2 in each place."""
    out = [at]
    for i in range(32):
        # between 0 and 1 the lower bit of the place changes, between 1 and 2 both do
        out.append(F.when(at.bitwiseAND(signed(2 << 2 * i)) == 0, at.bitwiseXOR(signed(1 << 2 * i))))
        out.append(F.when(at.bitwiseAND(signed(3 << 2 * i)) != 0, at.bitwiseXOR(signed(3 << 2 * i))))
    return F.array_compact(F.array(*out))


def near_fingerprints(prints: DataFrame) -> DataFrame:
    """u, v: links between different fingerprints (fp) of at most two differing bits; others are left out if they follow from links.

    The Manhattan distance of two fingerprints' popcounts is at most the number of bits in which they differ. Two
    points of a grid within distance two have a cell within distance one of both, so each fingerprint is entered into
    the cells around its own, and those that meet in a cell are verified on their bits. A cell in which more than
    ``MOST`` meet is cut into cells of single bits: what meets in one of those differs in two bits at most, so all are
    linked to the least, without pairs.

    Spark sizes an explode like the table it is made of, 65 times too low here, so the joins are told to sort and
    never broadcast; few files of fingerprints do not make few tasks of cells.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = prints.select("fp").repartition(parts, "fp").distinct().select("fp", F.explode(cells_around(popcounts(F.col("fp")))).alias("cell"))
    met = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(cells.join(met.hint("merge"), "cell").select("cell", "fp", "n"), "cells")
    few = shared.where(F.col("n") <= MOST).select("cell", "fp")
    a, b = few.select("cell", F.col("fp").alias("u")), few.select("cell", F.col("fp").alias("v"))
    u, v = F.col("u"), F.col("v")
    # fingerprints of one cell of their own meet in all cells around it and are taken from their own
    once = (popcounts(u) != popcounts(v)) | (F.col("cell") == popcounts(u))
    pairs = a.join(b.hint("merge"), "cell").where((u < v) & (F.bit_count(u.bitwiseXOR(v)) <= 2) & once).select("u", "v")
    many = shared.where(F.col("n") > MOST).select("fp").distinct()
    balls = many.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(signed(x)) for x in [0, *(1 << i for i in range(64))]])).alias("cell"))
    least = balls.groupBy("cell").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("cell", "v")
    stars = balls.join(least.hint("merge"), "cell").select(F.col("fp").alias("u"), "v").where("u <> v")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``key``, fp, component_id, the least key of those reachable over links of at most two bits.

    Texts that are null or have no words have the fingerprint zero and are linked like others; repeated rows stay; null
    keys stay and are never the least key unless a group has no other; an empty table gives no rows; other columns are
    not read.
    """
    prints = written(fingerprints(docs, key, text), "fingerprints")
    firsts = written(prints.groupBy("fp").agg(F.min(key).alias("first")), "firsts")
    groups = written(components(near_fingerprints(firsts)).select(F.col("node").alias("fp"), "root"), "groups")
    least = groups.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("least"))
    named = groups.join(least, "root").select("fp", "least")
    of = firsts.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(of, "fp").select(key, "fp", "component_id")
