"""Removal of passages that stand in earlier documents, by relative Lempel-Ziv parsing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trustlake.llm.common import running, span_hash
from trustlake.llm.shared_windows import Stretch, Windows, shared_spans, without_spans


def factors(length: int):
    """A comparison that parses each document's stretches against those of earlier documents in its reference block."""

    def compare(rows: Stretch) -> list[tuple[int, int, int]]:
        # The rows of one key are one reference block, ordered by document.
        words = np.frombuffer(b"".join(rows.symbols), np.uint64)
        sizes = np.fromiter(map(len, rows.symbols), np.int64, len(rows.symbols)) // 8
        base = np.cumsum(sizes) - sizes
        windows = rows.windows.astype(np.int64)
        at = np.repeat(base - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        seeds = span_hash(running(words), at, at + length).tolist()
        flat, begin = words.tolist(), base.tolist()
        out: list[tuple[int, int, int]] = []
        index: dict[int | tuple[int, ...], tuple[int, int, int]] = {}
        block, seed = None, 0
        for row, (key, doc, count) in enumerate(zip(rows.key.tolist(), rows.doc.tolist(), windows.tolist())):
            if key != block:
                block, index = key, {}
            own, i = begin[row], 0
            end = own + count + length - 1
            while i < count:
                found = index.get(seeds[seed + i])
                if found is not None and flat[found[1] : found[1] + length] != flat[own + i : own + i + length]:
                    found = index.get(tuple(flat[own + i : own + i + length]))
                if found is None or found[0] >= doc:
                    i += 1
                    continue
                # The factor goes on as long as its source does; the windows across its end are looked up next.
                a, b = own + i, found[1]
                source_end = found[2]
                n = length
                while a + n < end and b + n < source_end and flat[a + n] == flat[b + n]:
                    n += 1
                out.append((row, i, n - length + 1))
                i += n - length + 1
            for j in range(count):
                held = index.setdefault(seeds[seed + j], (doc, own + j, end))
                if held[1] != own + j and flat[held[1] : held[1] + length] != flat[own + j : own + j + length]:
                    # words of another window with its hash stand under themselves
                    index.setdefault(tuple(flat[own + j : own + j + length]), (doc, own + j, end))
            seed += count
        return out

    return compare


def without_copied_passages(docs: DataFrame, length: int = 13) -> DataFrame:
    """doc_id, n (words), n_removed, n_spans, kept (UTF-8, kept words joined by one space) of every document.

    Words are runs of anything but ASCII white space. A word goes if a window of ``length`` words that covers it starts
    in a document with a smaller doc_id also; windows do not cross documents and are judged on the input. A null text
    has no words. Null doc_ids count as larger than all others and are not smaller than each other, as rows of equal
    doc_id are not. Shorter texts lose nothing; an empty table gives no rows; other columns are not read.

    The reference is cut into blocks by the gram that owns a window, so a block has every place of its windows, and
    the longest match at a position starts at an indexed seed of ``length`` words. Parsing is greedy; a factor has at
    least ``length`` words, and windows across a factor's end are checked against the index before parsing goes on.
    """
    w = Windows("words", length, max(1, length * 2 // 5))
    return without_spans(docs, shared_spans(docs, w, factors(length), earlier=True), w)
