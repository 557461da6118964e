"""Removal of byte strings that stand twice, by sorting suffixes deep and shallow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trustlake.llm.shared_windows import Stretch, Windows, shared_spans, window_runs, without_spans

#: Words of eight bytes that the multikey quicksort looks at before blind tries take over.
SHALLOW = 3


def words_at(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one big-endian number."""
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    return np.ndarray((len(buffer) + 8,), ">u8", padded, 0, (1,)).astype(np.uint64)


def first_of(group: np.ndarray) -> np.ndarray:
    """Where each one's group begins; the members of a group stand together."""
    starts = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    return np.flatnonzero(starts)[np.cumsum(starts) - 1]


class Sorting:
    """Suffixes that are still to be told apart, in groups that lie together; a group's place in the order is known."""

    def __init__(self, count: int):
        self.order = np.zeros(count, np.int64)
        self.same = np.zeros(count, bool)
        self.member, self.place = np.arange(count), np.zeros(count, np.int64)
        self.settle(np.zeros(count, bool))

    def split(self, *keys: np.ndarray) -> np.ndarray:
        """Sorts the members of each group by keys and makes groups of equal ones. Returns the permutation."""
        at = np.lexsort((*keys[::-1], self.place))
        new = np.ones(len(at), bool)
        old = self.place[at]
        new[1:] = old[1:] != old[:-1]
        for k in keys:
            k = k[at]
            new[1:] |= k[1:] != k[:-1]
        self.member = self.member[at]
        # the groups' members keep their places, so a new group starts where its first member stands
        slot = old + np.arange(len(at)) - first_of(old)
        self.place = slot[np.flatnonzero(new)][np.cumsum(new) - 1] if len(at) else slot
        return at

    def settle(self, equal: np.ndarray) -> None:
        """Takes out members that are alone or known to be equal to their whole group."""
        if not len(self.member):
            return
        first = first_of(self.place)
        alone = np.bincount(first, minlength=len(first))[first] == 1
        done = alone | equal
        slot = self.place[done] + (np.arange(len(first)) - first)[done]
        self.order[slot] = self.member[done]
        self.same[slot] = (np.arange(len(first)) > first)[done]
        self.member, self.place = self.member[~done], self.place[~done]


def sorted_suffixes(buffer: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes at ``at`` by their first ``length`` bytes, whether each is equal to the one before it in that order).

    Shallow: multikey quicksort on words of eight bytes, to ``SHALLOW`` words. A round parts each group by its next word
    into as many groups as there are different ones, in order; those of one member have their place. Deep: the groups
    that are left share these words and are ordered by blind tries. From one member of a group, how many words the
    others share with it and the word in which they part give the branches of its path in order; a branch's members are
    alike up to there and make the next trie. Members that never part are equal. All groups of a round are handled by
    the same array operations.
    """
    word, whole = words_at(buffer), length // 8
    # A last word that overlaps the one before covers a length that is no multiple of eight; a shorter length cuts the word.
    steps = np.arange(whole) * 8
    if length % 8:
        steps = np.append(steps, max(length - 8, 0))
    if length < 8:
        word = word >> np.uint64(64 - 8 * length)
    todo = Sorting(len(at))
    for step in steps[:SHALLOW]:
        todo.split(word[at[todo.member] + step])
        todo.settle(np.zeros(len(todo.member), bool))
    if len(steps) <= SHALLOW:
        todo.settle(np.ones(len(todo.member), bool))
    while len(todo.member):
        first = first_of(todo.place)
        pivot = at[todo.member[first]]
        shared = np.full(len(first), len(steps))
        parting, greater = np.zeros(len(first), np.uint64), np.ones(len(first), np.int64)
        open_ = np.arange(len(first))
        for j in range(SHALLOW, len(steps)):
            mine, own = word[at[todo.member[open_]] + steps[j]], word[pivot[open_] + steps[j]]
            off = mine != own
            shared[open_[off]], parting[open_[off]] = j, mine[off]
            greater[open_[off]] = np.where(mine[off] > own[off], 2, 0)
            open_ = open_[~off]
        # less than the pivot: who parts early comes first; greater: who parts late does
        turn = np.where(greater == 0, shared, np.where(greater == 2, len(steps) - shared, 0))
        order = todo.split(greater * (len(steps) + 1) + turn, parting)
        todo.settle(shared[order] == len(steps))
    return todo.order, todo.same


def repeated(buffer: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``at`` share their first ``length`` bytes with another one."""
    order, same = sorted_suffixes(buffer, at, length)
    out = np.zeros(len(at), bool)
    out[order] = same | np.append(same[1:], False)
    return out


def shared_suffixes(length: int):
    def compare(rows: Stretch) -> list[tuple[int, int, int]]:
        buffer = np.frombuffer(b"".join(rows.symbols), np.uint8)
        windows = rows.windows.astype(np.int64)
        base = np.cumsum([0, *map(len, rows.symbols)])[:-1]
        at = np.repeat(base - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        flags = repeated(buffer, at, length) & np.repeat(rows.wanted, windows)
        return window_runs(flags, windows, np.arange(len(windows)))

    return compare


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n (bytes), n_removed, n_spans, kept (bytes) of every document without the strings that repeat.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else also, in the same document or
    another; strings do not cross documents, and all are judged on the input. A null text counts as empty. Rows that
    are equal are two places, so both lose what they share; rows of one doc_id with different texts are two documents.
    Null doc_ids stay; texts shorter than ``length`` lose nothing; an empty table gives no rows; other columns are not
    read.
    """
    w = Windows("bytes", length, max(1, length * 9 // 25))
    return without_spans(docs, shared_spans(docs, w, shared_suffixes(length), earlier=False), w)
