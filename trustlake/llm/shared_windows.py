"""Windows of symbols (bytes or words) that stand in more than one place, over whole corpora.

Every window is owned by one of its k-grams, the one with the least hash, so equal windows are owned by equal k-grams
at equal offsets. Rows are therefore exchanged per owning k-gram, about two for each window length, and not per window.
A k-gram that stands alone needs no look. Where the whole stretch that a k-gram owns is the same elsewhere, all its
windows are shared. Only stretches that differ while their k-grams agree are fetched, gathered by k-gram, and handed
to the operator's own comparison. What is compared of a k-gram with very many stretches is split by offset and by the
hash of the core that all windows of a range of offsets have in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlake.llm.common import BYTE_VALUE, joined_bytes, mix, running, slices, span_hash, text_or_empty, word_hashes, word_spans, written

#: Low bits of a packed minimum that hold the position.
POSITION = np.uint64((1 << 34) - 1)
#: Tells the symbols' second values from their first.
OTHER = np.uint64(0x2545F4914F6CDD1D)
#: Bytes of text that are hashed at a time.
PIECE = 1 << 20
#: Symbols of a text of its own that are taken at a time.
LONG = 2 << 20
#: Stretches of one k-gram from which it is split, and the offsets in a range of the split at most.
HOT, RANGE = 5_000, 16
#: Rows that are compared at a time; a k-gram's rows stay together.
TOGETHER = 3_000


class Windows(NamedTuple):
    """``unit``: "bytes" or "words"; ``n`` symbols to a window, ``k`` to the gram that owns it."""

    unit: str
    n: int
    k: int


class Stretch(NamedTuple):
    """Columns of the rows that a comparison gets: k-gram key, document, whether its result is wanted, first window, windows, symbols."""

    key: np.ndarray
    doc: np.ndarray
    wanted: np.ndarray
    windows: np.ndarray
    symbols: list[bytes]


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours."""
    m = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:m], ahead[w - 1 : w - 1 + m])


def symbols_of(flat: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(values, offsets by text, word spans)."""
    if unit == "bytes":
        return BYTE_VALUE[flat], offsets, ()
    s, e, counts = word_spans(flat, offsets)
    return word_hashes(flat, s, e), np.concatenate([[0], np.cumsum(counts)]), (s, e)


def owners(values: np.ndarray, offsets: np.ndarray, w: Windows) -> dict[str, np.ndarray]:
    """The stretches of consecutive windows with one owner: text, first window, windows, owner's offset, hashes."""
    m = len(values) - w.n + 1
    none = {c: np.zeros(0, np.int64) for c in ("text", "start", "windows", "owner", "gram", "stretch", "other")}
    if m <= 0:
        return none
    sums = running(values)
    at = np.arange(len(values) - w.k + 1)
    grams = span_hash(sums, at, at + w.k)
    owner = (sliding_minimum(grams & ~POSITION | at.astype(np.uint64), w.n - w.k + 1) & POSITION).astype(np.int64)
    p = np.arange(m)
    inside = np.zeros(m, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        inside[a : max(a, b - w.n + 1)] = True
    first = inside.copy()
    first[1:] &= (owner[1:] != owner[:-1]) | ~inside[:-1]
    starts = p[first]
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    stops = p[last] + w.n
    own = owner[starts]
    place = (own - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    stretch = mix(span_hash(sums, starts, stops) + place)
    # other values of the symbols, so the two hashes together have 128 bits
    other = mix(span_hash(running(mix(values ^ OTHER)), starts, stops) + place)
    text = np.searchsorted(offsets, starts, "right") - 1
    return {"text": text, "start": starts - offsets[text], "windows": stops - starts - w.n + 1, "owner": own - starts, "gram": grams[own].view(np.int64), "stretch": stretch.view(np.int64), "other": other.view(np.int64)}


def stretches_of(flat: np.ndarray, offsets: np.ndarray, w: Windows) -> Iterator[dict[str, np.ndarray]]:
    """``owners`` of texts; of one long text piece by piece, each with the symbols of its last windows.

    A stretch that two pieces cut in two has the same owner in both, so its windows still meet their equals.
    """
    if len(offsets) > 2 or len(flat) <= LONG:
        values, ends, _ = symbols_of(flat, offsets, w.unit)
        yield owners(values, ends, w)
        return
    words = word_hashes(flat, *word_spans(flat, offsets)[:2]) if w.unit == "words" else None
    count = len(flat) if words is None else len(words)
    for a in range(0, max(count - w.n + 1, 0), LONG):
        b = min(count, a + LONG + w.n - 1)
        values = BYTE_VALUE[flat[a:b]] if words is None else words[a:b]
        o = owners(values, np.array([0, b - a]), w)
        o["start"] += a
        yield o


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, doc (null last), salt (tells rows of one doc_id apart by their text) and text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), F.xxhash64(text_or_empty()).alias("salt"), text_or_empty().alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """``identified`` rows with their texts compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, "text"):
                small = [z.compress(t.as_buffer()) if t.is_valid else b"" for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("doc"), part.column("salt"), pa.array(small, pa.binary())], ["doc_id", "doc", "salt", "packed"])

    return identified(docs).mapInArrow(run, "doc_id long, doc long, salt long, packed binary")


def unpacked(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    z = zstandard.ZstdDecompressor()
    texts = [z.decompress(t) for t in part.column("packed").to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def stretches(docs: DataFrame, w: Windows) -> DataFrame:
    """gram, stretch and other (two hashes of it), doc, salt, start, windows, owner of every stretch of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                for o in stretches_of(*joined_bytes(part.column("text")), w):
                    rows = pa.array(o["text"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(o["gram"]), pa.array(o["stretch"]), pa.array(o["other"]), part.column("doc").take(rows), part.column("salt").take(rows), *(pa.array(o[c].astype(np.int32)) for c in ("start", "windows", "owner"))],
                        ["gram", "stretch", "other", "doc", "salt", "start", "windows", "owner"],
                    )

    return identified(docs).select("doc", "salt", "text").mapInArrow(run, "gram long, stretch long, other long, doc long, salt long, start int, windows int, owner int")


def cut_out(rows: DataFrame, docs: DataFrame, w: Windows) -> DataFrame:
    """The symbols of stretches, by the key under which they are compared.

    ``rows`` has gram, doc, salt, start, windows, owner, wanted, hot. A hot k-gram's stretch is cut into ranges of
    offsets; all windows of a range contain one core, and the core's hash joins the key.
    """
    item = F.struct("gram", "start", "windows", "owner", "wanted", "hot")
    listed = rows.groupBy("doc", "salt").agg(F.collect_list(item).alias("items")).join(packed(docs).drop("doc_id"), ["doc", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "packed", PIECE // 2):
                flat, offsets = unpacked(part)
                values = None
                if w.unit == "words":
                    values, offsets, _ = symbols_of(flat, offsets, w.unit)
                lists = part.column("items")
                text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                flat_items = lists.flatten()
                gram, start, windows, owner, wanted, hot = (flat_items.field(i).to_numpy(zero_copy_only=False) for i in range(6))
                a = offsets[text] + start
                stop = a + windows
                key = gram.copy()
                if hot.any():
                    sums = running(BYTE_VALUE[flat] if values is None else values)
                    rest = ~hot
                    parts = [(text[rest], a[rest], stop[rest], key[rest], wanted[rest])]
                    h = np.flatnonzero(hot)
                    own = a[h] + owner[h]
                    step = max(1, min(RANGE, (w.n - w.k) // 2))
                    for low in range(0, w.n - w.k + 1, step):
                        # offsets low to high of the owner in a window are the windows own - high to own - low
                        high = min(low + step - 1, w.n - w.k)
                        x, y = np.maximum(a[h], own - high), np.minimum(stop[h], own - low + 1)
                        on = x < y
                        core = span_hash(sums, own[on] - low, own[on] - high + w.n)
                        split = mix(core ^ gram[h][on].view(np.uint64) + np.uint64(low)).view(np.int64)
                        parts.append((text[h][on], x[on], y[on], split, wanted[h][on]))
                    text, a, stop, key, wanted = (np.concatenate(c) for c in zip(*parts))
                if w.unit == "bytes":
                    raw = flat.tobytes()
                    cut = [raw[x : y + w.n - 1] for x, y in zip(a.tolist(), stop.tolist())]
                else:
                    cut = [v.tobytes() for v in (values[x : y + w.n - 1] for x, y in zip(a.tolist(), stop.tolist()))]
                took = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), part.column("doc").take(took), part.column("salt").take(took), pa.array((a - offsets[text]).astype(np.int32)), pa.array((stop - a).astype(np.int32)), pa.array(wanted.astype(bool)), pa.array(cut, pa.binary())],
                    ["key", "doc", "salt", "start", "windows", "wanted", "symbols"],
                )

    return listed.select("doc", "salt", "items", "packed").mapInArrow(run, "key long, doc long, salt long, start int, windows int, wanted boolean, symbols binary")


def compared(rows: DataFrame, w: Windows, compare: Callable[[Stretch], list[tuple[int, int, int]]]) -> DataFrame:
    """doc, salt, start, stop: what ``compare`` finds, as (row, first window, windows), in rows of equal keys."""

    def some(table: pa.Table) -> pa.RecordBatch:
        column = lambda c: table.column(c).to_numpy()
        found = compare(Stretch(column("key"), column("doc"), column("wanted"), column("windows"), table.column("symbols").to_pylist()))
        row, first, count = (np.array(x, np.int64) for x in (zip(*found) if found else ((), (), ())))
        start = column("start")[row] + first
        return pa.RecordBatch.from_arrays(
            [pa.array(column("doc")[row], pa.int64()), pa.array(column("salt")[row], pa.int64()), pa.array(start.astype(np.int32)), pa.array((start + count + w.n - 1).astype(np.int32))],
            ["doc", "salt", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            at = 0
            for edge in [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]:
                if rows + edge - at >= TOGETHER:
                    yield some(pa.Table.from_batches([*held, batch.slice(at, edge - at)]))
                    held, rows, at = [], 0, edge
            # the batch's last key may go on in the next batch
            held.append(batch.slice(at))
            rows += batch.num_rows - at
        if held:
            yield some(pa.Table.from_batches(held))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "key").sortWithinPartitions("key", "doc").mapInArrow(run, "doc long, salt long, start int, stop int")


def marked(placed: DataFrame, earlier: bool) -> DataFrame:
    """``placed`` with whole (the stretch as a whole is shared), told (it is compared), wanted (the comparison's result for it is used), hot."""
    gram, both = Window.partitionBy("gram"), Window.partitionBy("gram", "stretch", "other")
    ends = {f"{end}_{c}": f(c).over(gram) for c in ("stretch", "other") for end, f in (("low", F.min), ("high", F.max))}
    rows = placed.withColumns({**ends, "rows": F.count("*").over(gram)})
    # a k-gram that stands alone is neither shared nor compared
    rows = rows.where("rows > 1").withColumn("mixed", (F.col("low_stretch") != F.col("high_stretch")) | (F.col("low_other") != F.col("high_other"))).withColumn("hot", F.col("rows") > HOT)
    if earlier:
        return rows.withColumn("whole", F.min("doc").over(both) < F.col("doc")).withColumn("told", F.col("mixed") & ~F.col("whole")).withColumn("wanted", F.lit(True))
    rows = rows.withColumn("alike", F.count("*").over(both)).withColumn("nth", F.row_number().over(both.orderBy("doc", "salt", "start")))
    return rows.withColumn("whole", F.col("alike") > 1).withColumn("told", F.col("mixed") & (F.col("nth") == 1)).withColumn("wanted", ~F.col("whole"))


def shared_spans(docs: DataFrame, w: Windows, compare: Callable[[Stretch], list[tuple[int, int, int]]], earlier: bool) -> DataFrame:
    """doc, salt, spans: the symbols that shared windows cover, by document.

    With ``earlier`` a window counts if it starts in a document with a smaller doc_id also, else if it starts anywhere
    else also.
    """
    columns = ["gram", "doc", "salt", "start", "windows", "owner", "whole", "told", "wanted", "hot"]
    kept = written(marked(stretches(docs, w), earlier).where("whole or told").select(*columns), "stretches")
    whole = kept.where("whole").select("doc", "salt", "start", (F.col("start") + F.col("windows") + (w.n - 1)).alias("stop"))
    told = kept.where("told").select("gram", "doc", "salt", "start", "windows", "owner", "wanted", "hot")
    spans = whole.union(compared(cut_out(told, docs, w), w, compare))
    return spans.groupBy("doc", "salt").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def without_spans(docs: DataFrame, spans: DataFrame, w: Windows) -> DataFrame:
    """doc_id, n, n_removed, n_spans (maximal runs), kept (bytes; kept words are joined by one space) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "packed", PIECE):
                flat, off = unpacked(part)
                raw = flat.tobytes()
                edges: np.ndarray = off
                if w.unit == "words":
                    s, e, counts = word_spans(flat, off)
                    edges = np.concatenate([[0], np.cumsum(counts)])
                change = np.zeros(int(edges[-1]) + 1, np.int32)
                lists = part.column("spans").fill_null([])
                base = np.repeat(edges[:-1], np.diff(lists.offsets.to_numpy()))
                items = lists.flatten()
                np.add.at(change, base + items.field(0).to_numpy(zero_copy_only=False), 1)
                np.add.at(change, base + items.field(1).to_numpy(zero_copy_only=False), -1)
                gone = np.cumsum(change)[:-1] > 0
                removed, runs, kept = [], [], []
                for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    g = gone[a:b]
                    removed.append(int(g.sum()))
                    runs.append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
                    if w.unit == "bytes":
                        kept.append(flat[a:b][~g].tobytes() if removed[-1] else raw[a:b])
                    else:
                        stay = np.flatnonzero(~g) + a
                        kept.append(b" ".join([raw[x:y] for x, y in zip(s[stay].tolist(), e[stay].tolist())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(edges), pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                    ["doc_id", "n", "n_removed", "n_spans", "kept"],
                )

    joined = packed(docs).join(spans, ["doc", "salt"], "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(run, "doc_id long, n long, n_removed long, n_spans long, kept binary")


def window_runs(flags: np.ndarray, windows: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first window, windows) of the maximal runs of flagged windows; ``flags`` has the rows' windows one after another."""
    base = np.cumsum(windows) - windows
    edge = np.zeros(len(flags) + 1, bool)
    edge[base] = True
    starts = flags & (edge[:-1] | ~np.concatenate([[False], flags[:-1]]))
    stops = flags & (np.concatenate([edge[1:-1], [True]]) | ~np.concatenate([flags[1:], [False]])) if len(flags) else flags
    a, b = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    own = np.searchsorted(base, a, "right") - 1
    return list(zip(row[own].tolist(), (a - base[own]).tolist(), (b - a).tolist()))
