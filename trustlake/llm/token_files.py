"""Token ids as flat binary files.

A data set is a folder of shards. Shard ``NNNNN`` has three files: ``.bin`` holds the ids of its documents one after
another as little-endian unsigned integers (16 bits where every id fits, else 32), ``.off`` the documents' 64-bit
offsets in it (one more than documents), ``.doc`` their 64-bit doc ids (the least value stands for null). Shards follow
each other in ascending doc_id order, so a shard's base in the whole stream is the sum of the ids of those before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlake.llm.chunk_cache import ChunkCache
from trustlake.llm.common import joined_bytes, shared_dir, slices, text_or_empty
from trustlake.llm.word_chunks import chunk_cache

NULL_ID = np.iinfo(np.int64).min


_CACHES: dict[str, tuple[ChunkCache, Callable]] = {}


def _cache(tokenizer_path: str) -> tuple[ChunkCache, Callable]:
    if tokenizer_path not in _CACHES:
        _CACHES[tokenizer_path] = chunk_cache(tokenizer_path)
    return _CACHES[tokenizer_path]


def _put(fs: pafs.FileSystem, path: str, parts: list[np.ndarray]) -> None:
    with fs.open_output_stream(path) as out:
        for p in parts:
            out.write(p.tobytes())


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, n_vocab: int, shards: int | None = None) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) and writes the shards to ``path``, a URI that all executors reach.

    Texts are encoded chunk by chunk where the tokenizer file says that its pre-tokens follow from the bytes' classes
    (``word_chunks``), and whole for tokenizers of other kinds.
    A null text counts as empty and still gets the end id; null doc_ids come first; repeated rows stay, ordered by
    text. An empty table gives no shard. Only doc_id and text are read, so other columns may have any name. A shard
    is written under a name of the attempt and then renamed, so a repeated task leaves one whole shard. Returns the
    manifest: shard, n_docs, n_tokens, bits.
    """
    spark = docs.sparkSession
    bits = 16 if max(n_vocab - 1, end_id) < 1 << 16 else 32
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        shard, attempt = ctx.partitionId(), ctx.taskAttemptId()
        fs, root = pafs.FileSystem.from_uri(path)
        (cache, cut), ids_of, lengths = _cache(tokenizer_path), [], [np.zeros(1, np.int64)]
        temp, total = f"{root}/.{shard:05d}-{attempt}", 0
        out = None
        for batch in batches:
            for part in slices(batch, "text"):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(temp + ".bin")
                ids, at, _ = cache.ids(*cut(*joined_bytes(part.column("text"))))
                ids = np.insert(ids, at[1:], end_id).astype(f"<u{bits // 8}")
                out.write(ids.tobytes())
                total += len(ids)
                lengths.append(np.diff(at) + 1)
                ids_of.append(part.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        sizes = np.concatenate(lengths)
        _put(fs, temp + ".off", [np.cumsum(sizes).astype("<i8")])
        _put(fs, temp + ".doc", [x.astype("<i8") for x in ids_of])
        for ext in (".off", ".doc", ".bin"):
            fs.move(temp + ext, f"{root}/{shard:05d}{ext}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_docs": pa.array([len(sizes) - 1], pa.int64()), "n_tokens": pa.array([total], pa.int64()), "bits": pa.array([bits], pa.int32())})

    fs, root = pafs.FileSystem.from_uri(path)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).repartitionByRange(shards, "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(encode, "shard int, n_docs long, n_tokens long, bits int").write.parquet(f"{path}/manifest")
    return spark.read.schema("shard int, n_docs long, n_tokens long, bits int").parquet(f"{path}/manifest")


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """What the shards hold, by document, read through memory maps: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids before the document in the whole stream: the shard's base, a prefix sum over the
    manifest's few rows, and the offset in the shard. Shards are read by as many tasks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                name, n = f"{root}/{row['shard']:05d}", row["n_docs"]
                kind = np.dtype(f"<u{row['bits'] // 8}")
                if isinstance(fs, pafs.LocalFileSystem):
                    load = lambda ext, kind: np.memmap(name + ext, kind, "r")
                    flat = load(".bin", kind)
                    span = lambda a, b: flat[a:b]
                else:
                    load = lambda ext, kind: np.frombuffer(fs.open_input_file(name + ext).readall(), kind)
                    stored = fs.open_input_file(name + ".bin")
                    span = lambda a, b: np.frombuffer(stored.read_at((b - a) * kind.itemsize, a * kind.itemsize), kind)
                off, ids = load(".off", "<i8"), load(".doc", "<i8")
                for k in range(0, n, 4096):
                    ends = off[k : min(k + 4096, n) + 1]
                    crc = [zlib.crc32(span(a, b).astype("<u4").tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    doc = np.asarray(ids[k : k + len(crc)])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc, pa.int64(), mask=doc == NULL_ID),
                        "start": pa.array(row["base"] + ends[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(n, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, n_vocab: int) -> DataFrame:
    """Writes the token files of ``docs`` to a new shared folder and returns what they hold, by document."""
    path = shared_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer_path, end_id, path, n_vocab), path)
