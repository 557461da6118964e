"""Spelling variants: words one edit apart, found by a self-join of tries with active-node sets, and the forms they belong to."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import map_arrow, text_or_empty, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words have so many code points and occurrences at least; one in ``ERASED`` keeps of a document loses a code point.
LEAST_LENGTH, LEAST_COUNT, ERASED = 5, 3, 97
#: A trie takes groups of at most so many words and letters; larger groups are split by longer prefixes.
MOST_WORDS, MOST_LETTERS = 10_000, 1 << 18
#: Characters of text whose words are listed at a time, and different words that are counted before they are handed on.
BLOCK, KEPT = 1 << 20, 200_000
#: Pairs handed on at a time.
PAIRS = 20_000


def text_blocks(text: str) -> Iterator[str]:
    """Pieces of about ``BLOCK`` characters that end between words."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            run = RUN.match(text, end)
            end = run.end() if run else end
        yield text[at:end]
        at = end


def erased(begun: int, word: str) -> str:
    """The word, or the word without one code point where its hash, gone on from that of what stands before it, says so."""
    h = zlib.crc32(word.encode(), begun)
    if h % ERASED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: how often each word stands in all documents, for words of the least length and count."""

    def flushed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for k, t in zip(part.column(0).to_pylist(), part.column(1)):
            begun = zlib.crc32(f"{k}:".encode())
            # bytes have lower case for A to Z only
            for block in text_blocks(t.as_py().lower().decode()):
                for word, n in Counter(RUN.findall(block)).items():
                    word = erased(begun, word)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) > KEPT:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.encode(text_or_empty(text), "utf-8").alias("t"))
    found = map_arrow(rows, run, "word string, n long", "t")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Node:
    __slots__ = ("children", "word")

    def __init__(self):
        self.children, self.word = {}, None


def spread(active: dict[Node, int], node: Node, distance: int) -> None:
    """Enters a node with its distance and the nodes below it with one more."""
    if active.get(node, 2) > distance:
        active[node] = distance
        if not distance:
            for child in node.children.values():
                active.setdefault(child, 1)


def near_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of numbers of different words that are exactly one edit apart, each pair once, from one trie joined with itself.

    The active set of a node holds the nodes whose strings are within one edit of its own, with that distance; a child's
    set follows from its parent's by a deletion, a match (and the insertions below it) or a replacement.
    """
    root = Node()
    for i, w in enumerate(words):
        node = root
        for c in w:
            node = node.children.get(c) or node.children.setdefault(c, Node())
        node.word = i
    top: dict[Node, int] = {}
    spread(top, root, 0)
    todo = [(root, top)]
    while todo:
        node, active = todo.pop()
        if node.word is not None:
            for other, distance in active.items():
                if distance and other.word is not None and node.word < other.word:
                    yield node.word, other.word
        for c, child in node.children.items():
            below: dict[Node, int] = {}
            for v, distance in active.items():
                if not distance:
                    if below.get(v, 2) > 1:
                        below[v] = 1
                    for x, u in v.children.items():
                        if x == c:
                            spread(below, u, 0)
                        elif u not in below:
                            below[u] = 1
                else:
                    u = v.children.get(c)
                    if u is not None and u not in below:
                        below[u] = 1
            todo.append((child, below))


def keyed(words: DataFrame) -> DataFrame:
    """The words' rests grouped by what two near ones share.

    ``words`` has group, rest, base: in a group, near words' rests are ``base`` or one more code points long. One edit
    leaves either the first half of the base alone or what follows it, so a rest is entered under its first half, what
    follows going into the trie, and, turned round, under its last part.
    """
    n, half = F.col("base"), F.floor(F.col("base") / 2).cast("int")
    rest = F.col("rest")
    ahead = F.struct(F.concat(F.lit("f"), F.substring(rest, F.lit(1), half)).alias("key"), F.substring(rest, half + 1, F.length(rest)).alias("rest"), (n - half).alias("base"))
    behind = F.reverse(rest)
    back = F.struct(F.concat(F.lit("b"), F.substring(behind, F.lit(1), n - half)).alias("key"), F.substring(behind, n - half + 1, F.length(rest)).alias("rest"), half.alias("base"))
    sides = words.select("word", "group", F.explode(F.array(ahead, back)).alias("s"))
    # the group's name stays short however often it is split
    return sides.select("word", F.md5(F.concat_ws(":", "group", F.col("s.base").cast("string"), "s.key")).alias("group"), "s.rest", "s.base")


def joined(groups: DataFrame) -> DataFrame:
    """word, near of near words, in both orders, in groups (word, group, rest) of bounded size, each handled by one trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rests, now = [], [], None

        def pairs() -> Iterator[pa.RecordBatch]:
            found = list(near_pairs(rests)) if len(rests) > 1 else []
            for at in range(0, len(found), PAIRS):
                one, two = ([words[p[k]] for p in found[at : at + PAIRS]] for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(one + two, pa.string()), pa.array(two + one, pa.string())], names=["word", "near"])

        for batch in batches:
            for group, word, rest in zip(*(batch.column(c).to_pylist() for c in ("group", "word", "rest"))):
                if group != now:
                    yield from pairs()
                    words, rests, now = [], [], group
                words.append(word)
                rests.append(rest)
        yield from pairs()

    together = groups.select("group", "word", "rest").repartition("group").sortWithinPartitions("group")
    return together.mapInArrow(run, "word string, near string")


def near_words(vocabulary: DataFrame, most_words: int = MOST_WORDS, most_letters: int = MOST_LETTERS) -> DataFrame:
    """word, near: every word with every word that differs by exactly one inserted, deleted or replaced code point.

    Words are entered by half: near words share the first half or the rest behind it. The tries are partitioned by
    these shared prefixes; groups too large for one trie are split by longer ones until they are small, or until at most
    one code point is left, where there are no more words than code points.
    """
    word, length = F.col("word"), F.length("word")
    tasks = vocabulary.select("word", F.explode(F.array(length - 1, length)).alias("base")).select("word", F.concat(F.lit("g"), F.col("base").cast("string")).alias("group"), word.alias("rest"), "base")
    found = []
    while True:
        tasks = keyed(tasks)
        sizes = tasks.groupBy("group").agg(F.count("*").alias("words"), F.sum(F.length("rest")).cast("long").alias("letters")).where("words > 1")
        tasks = written(tasks.join(sizes, "group"), "spelling-groups")
        large = ((F.col("words") > most_words) | (F.col("letters") > most_letters)) & (F.col("base") > 1)
        found.append(joined(tasks.where(~large)))
        tasks = tasks.where(large).drop("words", "letters")
        if tasks.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def struct_of_largest(n: Column, word: Column) -> Column:
    """Its least is the word of the largest n, ties to the smaller word."""
    return F.struct((-n).alias("m"), word.alias("w"))


def grouped(counts: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of a vocabulary (word, n).

    A word's form is its near word of the largest n, if that is at least twice its own; its root is the last form. As n
    doubles with each step, a chain of forms has at most 62 of them, and six rounds of joins that double their reach end it.
    """
    counts = written(counts.select("word", "n"), "vocabulary")
    others = counts.select(F.col("word").alias("near"), F.col("n").alias("m"))
    by = near_words(counts).join(others, "near").groupBy("word").agg(F.count("*").alias("n_near"), F.min(struct_of_largest(F.col("m"), F.col("near"))).alias("best"))
    all_words = counts.join(by, "word", "left")
    is_form = -F.col("best.m") >= 2 * F.col("n")
    out = written(all_words.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.w")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    links = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        links = step.select("word", "root")
        if step.where("went").isEmpty():
            break
    return out.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all texts.

    Null and empty texts have no words, a null key counts as an empty one, repeated rows count each time, an empty table
    gives no rows, and other columns are not read. Ties between forms go to the smaller word.
    """
    return grouped(word_counts(docs, key, text)).select("word", "form", "root", "n", "n_near", "form_n")
