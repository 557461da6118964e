"""Vectors compressed to codes of sixteen parts: whole-number Lloyd rounds that scan only what moved entries can change.

Each block of vectors keeps, for every entry of a codebook, a heap of its parts keyed by how much nearer their entry is
than any other. When entries move, an entry's drift grows by its own step and by the longest step of the others; the parts
whose key is above their entry's drift cannot have a nearer entry, so a round pops the others only and scans them in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import written

#: Parts of a vector, entries of a codebook, rounds, and the whole numbers that one component unit is cut into.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Whole components are kept within this bound, so that distances and their sums stay exact.
LARGEST = 1 << 24
#: Numbers of a block of vectors.
BLOCK = 1 << 19


@dataclass
class Codes:
    """codes: the key, code, error and whatever else was asked for; codebooks[part, entry, position]; rescanned: the share of parts that each later assignment scanned."""

    codes: DataFrame
    codebooks: np.ndarray
    rescanned: list[float] = field(default_factory=list)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def finite(vector: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(vector: list | np.ndarray, width: int) -> np.ndarray:
    """Components as whole numbers, rounded down; zeros fill up to ``width``."""
    out = np.zeros(width, np.int64)
    out[: len(vector)] = np.clip(np.floor(np.asarray(vector, np.float64) * SCALE), -LARGEST, LARGEST)
    return out


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances [row, entry] in whole numbers."""
    out = np.zeros((len(parts), len(book)), np.int64)
    for j in range(parts.shape[1]):
        step = parts[:, j, None] - book[None, :, j]
        out += step * step
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower index, and by how much the next one is farther away."""
    d = distances(parts, book)
    at = d.argmin(1)
    rows = np.arange(len(parts))
    own = np.sqrt(d[rows, at].astype(np.float64))
    if len(book) == 1:
        return at, np.full(len(parts), np.inf)
    d[rows, at] = np.iinfo(np.int64).max
    return at, np.sqrt(d.min(1).astype(np.float64)) - own


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each [part, entry]: its own step and the longest step of the others, a little more than they are."""
    step = np.sqrt(((new - old).astype(np.float64) ** 2).sum(2))
    others = np.empty_like(step)
    for e in range(step.shape[1]):
        others[:, e] = np.delete(step, e, 1).max(1, initial=0.0)
    return (step + others) * (1 + 1e-9)


class Heaps:
    """A block's parts at one position: for each entry a heap of (key, row), kept sorted, so what is to be popped stands in front."""

    def __init__(self, entry: np.ndarray, key: np.ndarray, row: np.ndarray):
        self.entry, self.key, self.row = entry, key, row

    @classmethod
    def built(cls, entry: np.ndarray, key: np.ndarray) -> Heaps:
        order = np.lexsort((key, entry))
        return cls(entry[order].astype(np.uint8), key[order], order.astype(np.int32))

    def popped(self, drift: np.ndarray) -> np.ndarray:
        """Places whose key is not above their entry's drift, found from the front of each heap."""
        ends = np.searchsorted(self.entry, np.arange(len(drift) + 1))
        fronts = [np.arange(a, a + np.searchsorted(self.key[a:b], drift[e] + 1e-6, "right")) for e, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
        return np.concatenate(fronts) if fronts else np.zeros(0, np.int64)

    def pushed(self, out: np.ndarray, entry: np.ndarray, key: np.ndarray) -> Heaps:
        """Without the places ``out``, their rows entered again under new entries and keys by a merge."""
        rows, stay = self.row[out], np.ones(len(self.row), bool)
        stay[out] = False
        return Heaps.merged(Heaps(self.entry[stay], self.key[stay], self.row[stay]), Heaps.built(entry, key), rows)

    @staticmethod
    def merged(kept: Heaps, new: Heaps, rows: np.ndarray) -> Heaps:
        at = np.empty(len(new.row), np.int64)
        ends, news = np.searchsorted(kept.entry, np.arange(257)), np.searchsorted(new.entry, np.arange(257))
        for e in np.flatnonzero(np.diff(news)):
            at[news[e] : news[e + 1]] = ends[e] + np.searchsorted(kept.key[ends[e] : ends[e + 1]], new.key[news[e] : news[e + 1]])
        return Heaps(np.insert(kept.entry, at, new.entry), np.insert(kept.key, at, new.key), np.insert(kept.row, at, rows[new.row]))


STATE = "vectors binary, entry binary, key binary, row binary, moved binary, scanned long"


def blocks(rows: DataFrame, width: int, carried: list[str]) -> DataFrame:
    """Blocks of at most ``BLOCK`` numbers: the carried columns as a list of structs, the vectors as whole numbers."""
    most = max(1, BLOCK // max(width, 1))
    kinds = ", ".join(f"`{c}`: {rows.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                flat = np.stack([whole(v.as_py(), width) for v in part.column("v")]).astype("<i4")
                structs = pa.StructArray.from_arrays([part.column(c) for c in carried], names=carried)
                rows = pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs)
                yield pa.RecordBatch.from_arrays([rows, pa.array([flat.tobytes()])], names=["rows", "vectors"])

    return rows.mapInArrow(run, f"rows array<struct<{kinds}>>, vectors binary")


def unpacked(vectors: bytes, width: int) -> np.ndarray:
    """[part, row, position] of a block."""
    flat = np.frombuffer(vectors, "<i4").astype(np.int64)
    return flat.reshape(-1, PARTS, width // PARTS).transpose(1, 0, 2)


def deltas(part: np.ndarray, old: np.ndarray | None, new: np.ndarray, entries: int) -> np.ndarray:
    """What entries' sums and counts [entry, position + 1] gain by rows that went from old entries to new ones."""
    out = np.zeros((entries, part.shape[1] + 1), np.int64)
    ones = np.concatenate([part, np.ones((len(part), 1), np.int64)], 1)
    np.add.at(out, new, ones)
    if old is not None:
        np.subtract.at(out, old, ones)
    return out


def assigned(table: DataFrame, book: np.ndarray, width: int, drift: np.ndarray | None) -> DataFrame:
    """The blocks after an assignment: heaps, what moved between entries, how many parts were scanned.

    Without ``drift`` every part is scanned and the heaps are built; else those are whose key, less what its entry has
    drifted since the part was scanned, leaves room for another entry. Keys are entered with the drift of their entry
    added, so that a heap never has to be gone through for it.
    """
    entries = book.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = unpacked(batch.column("vectors")[i].as_py(), width)
                n, heaps, moved, scanned = parts.shape[1], [], [], 0
                stored = None if drift is None else [np.frombuffer(batch.column(c)[i].as_py(), kind).reshape(PARTS, n) for c, kind in (("entry", np.uint8), ("key", "<f8"), ("row", "<i4"))]
                for p in range(PARTS):
                    if drift is None:
                        entry, slack = nearest(parts[p], book[p])
                        heaps.append(Heaps.built(entry, slack))
                        moved.append(deltas(parts[p], None, entry, entries))
                        scanned += n
                        continue
                    heap = Heaps(*(x[p] for x in stored))
                    out = heap.popped(drift[p])
                    rows = heap.row[out]
                    entry, slack = nearest(parts[p][rows], book[p])
                    moved.append(deltas(parts[p][rows], heap.entry[out], entry, entries))
                    heaps.append(heap.pushed(out, entry, slack + drift[p][entry]))
                    scanned += len(out)
                packed = [np.stack([getattr(h, c) for h in heaps]).tobytes() for c in ("entry", "key", "row")]
                columns = [batch.column("rows").slice(i, 1), batch.column("vectors").slice(i, 1), *(pa.array([x]) for x in packed), pa.array([np.stack(moved).astype("<i8").tobytes()]), pa.array([scanned])]
                yield pa.RecordBatch.from_arrays(columns, names=["rows", "vectors", "entry", "key", "row", "moved", "scanned"])

    kind = table.schema["rows"].dataType.simpleString()
    return table.mapInArrow(run, f"rows {kind}, {STATE}")


def totals(table: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, int]:
    """What the entries' sums and counts gained in all blocks, and the parts scanned: added up by Spark, a row for each number of a codebook."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, scanned = np.zeros(np.prod(shape), np.int64), 0
        for batch in batches:
            for m in batch.column("moved"):
                out += np.frombuffer(m.as_py(), "<i8")
            scanned += sum(batch.column("scanned").to_pylist())
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(out[at], scanned))], names=["at", "gain"])

    rows = table.select("moved", "scanned").mapInArrow(run, "at long, gain long").groupBy("at").agg(F.sum("gain").alias("gain")).collect()
    out = np.zeros(np.prod(shape), np.int64)
    for r in rows:
        if r["at"] >= 0:
            out[r["at"]] = r["gain"]
    return out.reshape(shape), sum(r["gain"] for r in rows if r["at"] < 0)


def coded(table: DataFrame, book: np.ndarray, width: int, carried: list[str]) -> DataFrame:
    """The carried columns, code and error of each row of the blocks."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema["rows"].dataType.elementType.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = unpacked(batch.column("vectors")[i].as_py(), width)
                n = parts.shape[1]
                entry, row = (np.frombuffer(batch.column(c)[i].as_py(), kind).reshape(PARTS, n) for c, kind in (("entry", np.uint8), ("row", "<i4")))
                code, error = np.empty((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p in range(PARTS):
                    code[row[p], p] = entry[p]
                    step = parts[p] - book[p][code[:, p]]
                    error += (step * step).sum(1)
                structs = batch.column("rows")[i].values
                yield pa.RecordBatch.from_arrays([*(structs.field(c) for c in carried), pa.array([c.tobytes().hex() for c in code]), pa.array(error)], names=[*carried, "code", "error"])

    return table.mapInArrow(run, f"{kinds}, code string, error long")


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", carried: tuple[str, ...] = ("label",)) -> Codes:
    """``key``, the ``carried`` columns, code (two hexadecimal digits for each part) and error of every vector, and the codebooks.

    Vectors that are null or hold null or non-finite components are left out. Components become floor(256 * x), within
    ``LARGEST``; vectors shorter than the longest, or than a multiple of sixteen, are filled with zeros. The codebooks
    start from the vectors of the 64 smallest keys (fewer, if there are fewer; equal keys by their components, null keys
    last), repeated keys and equal vectors count each time. No vectors: no rows and empty codebooks.
    What stands on the driver are the codebooks, 64 times the length of a vector.
    """
    rows = vectors.where(finite(vector)).select(key, *carried, F.col(vector).cast("array<double>").alias("v"))
    first = rows.select(key, "v").orderBy(F.asc_nulls_last(key), "v").limit(ENTRIES).collect()
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(-(-longest // PARTS), 1) * PARTS
    names = [key, *carried]
    book = np.array([whole(r["v"], width) for r in first], np.int64).reshape(-1, PARTS, width // PARTS).transpose(1, 0, 2)
    if not first:
        kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
        return Codes(vectors.sparkSession.createDataFrame([], f"{kinds}, code string, error long"), book)
    shape = (PARTS, book.shape[1], width // PARTS + 1)
    table = written(blocks(rows, width, names), "vector-blocks")
    sums, drift, shares = np.zeros(shape, np.int64), None, []
    for turn in range(ROUNDS + 1):
        table = written(assigned(table, book, width, drift), "vector-heaps")
        if turn == ROUNDS:
            break
        gain, scanned = totals(table, shape)
        sums += gain
        if turn == 0:
            every = scanned
        else:
            shares.append(scanned / every)
        count = sums[:, :, -1:]
        moved = np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), book)
        drift, book = (0 if drift is None else drift) + drifts(book, moved), moved
    shares.append(table.agg(F.sum("scanned")).first()[0] / every)
    return Codes(coded(table, book, width, names), book, shares)


def with_group_errors(codes: DataFrame, group: str = "label") -> DataFrame:
    """``codes`` with label_error: the errors summed over the rows of equal ``group``, nulls together."""
    sums = codes.groupBy(F.col(group).alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col(group).eqNullSafe(F.col("of"))).drop("of")
