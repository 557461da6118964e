"""Helpers that the operators of this subpackage share: shared folders, written tables, text batches, word hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handled in pieces of about so many bytes, so a worker's memory does not follow the batch size.
PIECE_BYTES = 4 << 20
#: Less where texts become lists of Python strings, which take many times their bytes.
STRING_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``; where that is unset, below a temporary folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='trustlake-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there and lost executors cost nothing."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_hash(text: str | Column = "text") -> Column:
    """MD5 of a text, null counting as empty: tells rows of one doc_id apart."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def slices(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut where ``column`` has gathered ``most`` bytes; a longer value stands alone."""
    if not batch.num_rows:
        return
    col = batch.column(column)
    col = col.cast(pa.large_binary()) if pa.types.is_string(col.type) or pa.types.is_binary(col.type) else col
    ends = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    start = 0
    while start < len(col):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string or binary column without nulls."""
    col = column.cast(pa.large_binary())
    ends = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Random 64-bit values of the bytes, and the odd base of the running polynomial with its inverse.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(4)
def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    step = base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step % (1 << 64)
    return out


def size_class(n: int) -> int:
    return 1 << max(10, int(n).bit_length())


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums modulo 2**64, one more than there are values; ``span_hash`` reads spans from them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, size_class(len(values)))[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, stop) that do not depend on where a span stands."""
    inverse = powers(BASE_INVERSE, size_class(len(sums)))
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words of each text."""
    space = np.ones(len(flat) + 2, bool)
    space[1:-1] = (flat == 32) | ((flat >= 9) & (flat <= 13))
    # a text's first byte starts a word even where the text before it ends in one
    first = ~space[1:-1]
    starts = first & space[:-2]
    inner = offsets[(offsets > 0) & (offsets < len(flat))]
    starts[inner] |= first[inner]
    ends = first & space[2:]
    ends[inner - 1] |= first[inner - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.diff(np.searchsorted(s, offsets))


def word_hashes(flat: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the words at [s, e), taken over about ``PIECE_BYTES`` at a time."""
    out = np.empty(len(s), np.uint64)
    a = 0
    while a < len(s):
        b = max(a + 1, int(np.searchsorted(e, s[a] + PIECE_BYTES, "right")))
        part = flat[s[a] : e[b - 1]]
        out[a:b] = span_hash(running(BYTE_VALUE[part]), s[a:b] - s[a], e[a:b] - s[a])
        a = b
    return out


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, by: str, most: int = STRING_BYTES) -> DataFrame:
    """``mapInArrow`` with ``f`` on slices of each batch that hold about ``most`` bytes of ``by``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, by, most):
                yield from f(part)

    return df.mapInArrow(run, schema)
