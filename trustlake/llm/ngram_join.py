"""Similar texts by the Jaccard similarity of their word shingles, through a MinHash LSH forest.

Each of ``TREES`` trees orders the texts by a path of ``DEPTH`` MinHash values; a trie node is told by the hash of its
prefix. Texts meet at the deepest nodes first. Every pair that meets is verified on the whole shingle sets, in blocks of
bounded size, and the similarities found tell what share of such pairs the depth so far misses. While the recall so
estimated is below the target, the prefixes are shortened by one value, and pairs that meet there for the first time are
verified. The shortest prefix is the one at which pairs at the threshold meet with the target's probability, so the trie
below it is all that is ever looked at: a node of it with one text is left out before anything else.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import joined_bytes, mix, row_hash, running, slices, span_hash, text_or_empty, word_hashes, word_spans, written
from trustlake.llm.components import components

TREES, DEPTH = 40, 8
#: Texts of a class of candidates that one block compares with each other, and their bytes.
BLOCK, BLOCK_BYTES = 1000, 16 << 20
PIECE = 1 << 20


def shortest_prefix(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``target`` at least."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offsets by text); a text of fewer than ``n`` words has one shingle of all, without words none."""
    s, e, counts = word_spans(flat, offsets)
    words = word_hashes(flat, s, e)
    base = np.cumsum(counts) - counts
    many = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(many)
    at = np.repeat(base - (ends - many), many) + np.arange(int(many.sum()))
    return span_hash(running(words), at, at + np.repeat(np.minimum(counts, n), many)), np.concatenate([[0], ends])


def paths(shingles: np.ndarray, offsets: np.ndarray, root: int) -> np.ndarray:
    """For each text with shingles (rows) and each tree, the hashes of its prefixes of ``root`` to ``DEPTH`` values."""
    filled = np.flatnonzero(np.diff(offsets))
    starts = offsets[:-1][filled]
    out = np.zeros((len(filled), TREES, DEPTH - root + 1), np.uint64)
    if not len(filled):
        return out
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    high = shingles.astype(np.uint32)
    for t in range(TREES):
        key = np.zeros(len(filled), np.uint64)
        for d in range(DEPTH):
            # multiply-shift of both halves, with odd random numbers
            a, b = (int(x) | 1 for x in mix(np.array([2 * (t * DEPTH + d) + 1, 2 * (t * DEPTH + d) + 2], np.uint64)) >> np.uint64(32))
            least = np.minimum.reduceat(scrambled(low, high, a, b), starts)
            key = mix(key + least + np.uint64(t * DEPTH + d + 1))
            if d + 1 >= root:
                out[:, t, d + 1 - root] = key
    return out


def scrambled(low: np.ndarray, high: np.ndarray, a: int, b: int) -> np.ndarray:
    x = low * np.uint32(a) + high * np.uint32(b)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    return x


def signatures(docs: DataFrame, n: int, root: int) -> DataFrame:
    """doc_id, tid (hash of the text), size (bytes), keys (``paths`` one after another; empty for a text without words)."""
    each = TREES * (DEPTH - root + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                flat, ends = joined_bytes(part.column("text"))
                shingles, off = shingle_sets(flat, ends, n)
                keys = paths(shingles, off, root)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((np.diff(off) > 0) * each)]).astype(np.int32)), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tid"), pa.array(np.diff(ends), pa.int64()), lists], ["doc_id", "tid", "size", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("tid"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, tid binary, size long, keys array<long>")


def similarities(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """The similarity of each two sets that reach the threshold, from exact counts of common members; 0 elsewhere."""
    g = len(sets)
    sizes = np.array([len(s) for s in sets])
    every, ids = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(g), sizes)
    shared = np.bincount(ids, minlength=len(every)) > 1
    new = np.cumsum(shared) - 1
    row, col = row[shared[ids]], new[ids[shared[ids]]]
    common = np.zeros((g, g), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for low in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(col, (low, low + 4096))
        m = np.zeros((g, min(4096, int(shared.sum()) - low)), np.float32)
        m[row[a:b], col[a:b] - low] = 1
        common += m @ m.T
    common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    out = np.where(common * threshold.denominator >= union * threshold.numerator, common / np.maximum(union, 1), 0.0)
    np.fill_diagonal(out, 0.0)
    return out


def missed(similarity: np.ndarray, depth: int) -> np.ndarray:
    """For each pair that was found, how many of its kind a forest of this depth misses."""
    never = (1 - similarity**depth) ** TREES
    return never / (1 - never)


def roots_of(links: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(len(links))
    while True:
        new = np.minimum(root, np.where(links, root[None, :], len(links)).min(1, initial=len(links)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verified(rows: DataFrame, n: int, threshold: Fraction, root: int) -> DataFrame:
    """tid, links, missed (by depth from ``root`` on), root from rows of label, i, j, side, tid, labels, packed; rows of one (label, i, j) form a block.

    A pair that meets under several labels is counted under the least of them only.
    """

    def block(table: pa.Table) -> pa.RecordBatch | None:
        label, i, j = (table.column(c)[0].as_py() for c in ("label", "i", "j"))
        tids, side = table.column("tid").to_pylist(), table.column("side").to_numpy()
        z = zstandard.ZstdDecompressor()
        sets = []
        # one text after another, so a block holds its shingles and not its texts
        for packed in table.column("packed"):
            flat = np.frombuffer(z.decompress(packed.as_buffer()), np.uint8)
            sets.append(np.unique(shingle_sets(flat, np.array([0, len(flat)]), n)[0]))
        found = similarities(sets, threshold)
        if i != j:
            found[side[:, None] == side[None, :]] = 0.0
        links = found > 0
        if not links.any():
            return None
        counted = links.copy()
        lower: dict[bytes, list[int]] = {}
        for k, own in enumerate(table.column("labels").to_pylist()):
            for x in own:
                if x < label:
                    lower.setdefault(x, []).append(k)
        for members in lower.values():
            if len(members) > 1:
                counted[np.ix_(members, members)] = False
        # Components are rooted at the least text.
        order = sorted(range(len(tids)), key=tids.__getitem__)
        roots = roots_of(links[np.ix_(order, order)])
        own = np.empty(len(tids), np.int64)
        own[order] = np.array(order)[roots]
        has = np.flatnonzero(links.any(1))
        lost = np.stack([np.where(counted, missed(found, d), 0.0)[has].sum(1) for d in range(root, DEPTH + 1)], 1)
        odds = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1, dtype=np.int32) * lost.shape[1]), pa.array(lost.ravel()))
        return pa.RecordBatch.from_arrays([pa.array([tids[x] for x in has], pa.binary()), pa.array(counted[has].sum(1), pa.int64()), odds, pa.array([tids[own[x]] for x in has], pa.binary())], ["tid", "links", "missed", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j"))))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in pairwise(edges):
                if held and keys[a] != last:
                    if (out := block(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                last = keys[a]
                held.append(batch.slice(a, b - a))
        if held and (out := block(pa.Table.from_batches(held))) is not None:
            yield out

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "label", "i", "j").sortWithinPartitions("label", "i", "j").mapInArrow(run, "tid binary, links long, missed array<double>, root binary")


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """tid, packed (the text compressed) of one document for each tid and first doc_id in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, "text"):
                small = [z.compress(t.as_buffer()) for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("tid"), pa.array(small, pa.binary())], ["tid", "packed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("tid"), text_or_empty().alias("text"))
    first = rows.join(wanted.select("tid", "first").hint("merge"), "tid").where("doc_id <=> first").select("tid", "text")
    return first.mapInArrow(run, "tid binary, packed binary").dropDuplicates(["tid"])


def trie(signed: DataFrame, levels: int) -> DataFrame:
    """tid, path (node at the shortest prefix, ..., node of the whole path) below nodes of the shortest prefix that hold several texts."""
    roots = signed.select("tid", F.explode(F.filter("keys", lambda x, i: i % levels == 0)).alias("node"))
    several = roots.groupBy("node").agg(F.min("tid").alias("least"), F.max("tid").alias("most")).where("least <> most").select("node")
    cut = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("keys", t * levels + 1, levels))
    each = signed.where(F.size("keys") > 0).select("tid", F.explode(cut).alias("path")).withColumn("node", F.element_at("path", 1))
    return written(each.join(several.hint("merge"), "node").select("tid", "path").distinct(), "trie")


def met(tries: DataFrame, at: int, levels: int) -> DataFrame:
    """tid, label of texts that meet at nodes of level ``at`` and not below them. A label is the node's least text, behind a byte by which deeper levels come first."""
    node = F.element_at("path", at + 1)
    below = F.element_at("path", at + 2) if at + 1 < levels else F.xxhash64("tid")
    placed = tries.select("tid", node.alias("node"), below.alias("below"))
    nodes = placed.groupBy("node").agg(F.min("tid").alias("least"), F.min("below").alias("a"), F.max("below").alias("b")).where("a <> b")
    label = F.concat(F.unhex(F.lit(f"{levels - 1 - at:02x}")), "least")
    return written(placed.join(nodes.select("node", label.alias("label")).hint("merge"), "node").select("tid", "label").distinct(), "labels")


def classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, target: float = 0.99999) -> tuple[DataFrame, DataFrame]:
    """(by text: tid, first (its least doc_id), root (the class's least text), class_id, n_links; by row: doc_id, tid) of ``similar_classes``."""
    root = shortest_prefix(threshold, target)
    levels = DEPTH - root + 1
    signed = written(signatures(docs, n, root), "signatures")
    texts = signed.groupBy("tid").agg(F.min("doc_id").alias("first"), F.max("size").alias("size"))
    tries = trie(signed, levels)
    told = found = None
    for at in reversed(range(levels)):
        own = met(tries, at, levels)
        told = own if told is None else told.union(own)
        sized = own.join(texts.select("tid", "size"), "tid").groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        sizes = sized.select("label", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
        wanted = written(own.select("tid").distinct().join(texts.select("tid", "first"), "tid"), "wanted-texts")
        labels = told.join(wanted.select("tid"), "tid", "left_semi").groupBy("tid").agg(F.sort_array(F.collect_list("label")).alias("labels"))
        each = packed_texts(docs, wanted).join(labels.hint("merge"), "tid").join(own.hint("merge"), "tid").join(sizes.hint("merge"), "label")
        each = each.withColumn("side", F.pmod(F.xxhash64("tid"), "blocks").cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = each.select("label", F.least("side", "with").alias("i"), F.greatest("side", "with").alias("j"), "side", "tid", "labels", "packed")
        new = written(verified(rows, n, Fraction(threshold).limit_denominator(1000), root), "links")
        found = new if found is None else found.union(new)
        seen = found.agg(F.sum("links").alias("links"), F.sum(F.element_at("missed", at + 1)).alias("missed")).first()
        # Without any pair there is nothing to estimate from, so the prefixes are shortened to the end.
        if seen["links"] and seen["links"] >= target * (seen["links"] + seen["missed"]):
            break
    counts = found.groupBy("tid").agg(F.sum("links").alias("links"))
    roots = components(found.select("tid", "root"), "tid", "root")
    rooted = texts.select("tid", "first").join(roots.withColumnRenamed("node", "tid"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    least = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    by_text = rooted.join(least, "root").join(counts, "tid", "left").select("tid", "first", "root", "class_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"))
    return by_text, signed.select("doc_id", "tid")


def similar_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, target: float = 0.99999) -> DataFrame:
    """doc_id, tid, class_id, n_links of every document.

    Texts are linked if the Jaccard similarity of their sets of ``n``-word shingles reaches ``threshold``; words are runs of
    anything but ASCII white space. A text of fewer words has one shingle, all its words; texts without words (null
    counts as empty) are linked to none. The forest stops where, by the similarities found, it has the share ``target``
    of all links. ``n_links`` is the number of different texts linked to the document's own
    (copies share one text), ``class_id`` the least doc_id of all documents that are copies or linked through any number
    of links; it is null where none has one. Repeated rows stay; an empty table gives no rows; other columns are not
    read.

    Joins are merges at every size, so a plan that fits a small corpus is the one that runs on a large one. Candidate
    pairs are never listed: a node of a tree is told by its least text, texts that share such a label are
    compared in blocks of about twice ``BLOCK`` texts or ``BLOCK_BYTES`` bytes at most (a longer text stands with others
    of its block), and a block returns one row per text.
    """
    by_text, rows = classes(docs, n, threshold, target)
    return rows.join(by_text.hint("merge"), "tid").select("doc_id", "tid", "class_id", "n_links")


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs``, with its columns, of each class: the first by doc_id (null last), then by the text's hash."""
    by_text, _ = classes(docs, **options)
    place = F.struct(F.col("first").isNull(), F.col("first"), F.col("tid"))
    first = by_text.groupBy("root").agg(F.min(place).alias("place")).select(F.col("place.first").alias("first id"), F.col("place.tid").alias("first tid"))
    kept = docs.withColumn("own tid", row_hash())
    kept = kept.join(first, kept["doc_id"].eqNullSafe(first["first id"]) & (kept["own tid"] == first["first tid"]), "left_semi")
    return kept.dropDuplicates(["own tid"]).drop("own tid")
