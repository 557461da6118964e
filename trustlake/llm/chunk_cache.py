"""Token ids of texts by way of their chunks: a batch's different chunks are looked up, and only new ones are encoded."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Chunks of more bytes than this are not kept; the cache starts anew beyond CACHED chunks.
LONGEST, CACHED = 64, 500_000


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes


def ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the ranges one after another, where each ends in them)."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0), ends


class ChunkCache(dict):
    """Maps a chunk's bytes to its row in a flat table of ids and flags.

    ``encode`` gives for a list of new chunks the ids, how many each has, and a flag for each that is kept beside it.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]):
        super().__init__()
        self.encode, self.fresh = encode, []
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.rows, self.flat, self.starts, self.flags = 0, np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)

    def __missing__(self, chunk: bytes) -> int:
        self.fresh.append(chunk)
        self[chunk] = row = self.rows
        self.rows += 1
        return row

    def ids(self, chunks: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, the texts' offsets in them, whether all chunks of a text have the flag); ``counts`` has the chunks of each text."""
        if self.rows > CACHED:
            self.reset()
        different = chunks.dictionary_encode()
        rows = np.fromiter(map(self.__getitem__, different.dictionary.to_pylist()), np.int64, len(different.dictionary))[different.indices.to_numpy()]
        if self.fresh:
            new, sizes, flags = self.encode(self.fresh)
            self.flat = np.concatenate([self.flat, new])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.flags = np.concatenate([self.flags, flags])
            for c in self.fresh:
                if len(c) > LONGEST:
                    del self[c]
            self.fresh = []
        at, ends = ranges(self.starts[rows], self.starts[rows + 1] - self.starts[rows])
        text_ends = np.concatenate([[0], np.cumsum(counts)])
        lacking = np.concatenate([[0], np.cumsum(~self.flags[rows])])[text_ends]
        return self.flat[at], np.concatenate([[0], ends])[text_ends], np.diff(lacking) == 0


def chunk_array(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The chunks of ``flat`` that begin at ``starts``; each ends where the next begins."""
    ends = np.append(starts, len(flat)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])
