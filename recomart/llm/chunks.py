"""Token ids of distinct text chunks, remembered by each Python worker up to a bound."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a worker remembers unless told otherwise; beyond that it starts anew with the chunks at hand.
MAX_CHUNKS = 150_000

SLICE_BYTES = 1 << 20  # text handled at a time


def row_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about SLICE_BYTES of text (at least one row)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // SLICE_BYTES
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        for i, j in zip(starts, [*starts[1:], len(part)]):
            yield batch.slice(i, j - i)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] - 1 of all i, one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]))


class Remembered:
    """Maps chunks to entries. Entry e has ids in each of ``tables`` tables (``ids``, ``counts``) and a mark.

    ``solve(chunks)`` gives, for new chunks, for every table (all ids, ids per chunk), and the marks. A chunk that
    was forgotten is solved again, so the bound changes no result.
    """

    def __init__(self, solve: Callable, tables: int = 1, limit: int | None = None):
        self.solve, self.tables, self.limit = solve, tables, limit or MAX_CHUNKS
        self.forget()

    def forget(self) -> None:
        self.at: dict = {}
        self.flat = [np.zeros(0, np.int32)] * self.tables
        self.start = [np.zeros(0, np.int64)] * self.tables
        self.count = [np.zeros(0, np.int64)] * self.tables
        self.mark = np.zeros(0, bool)

    def entries(self, chunks: list) -> np.ndarray:
        """Entry number of every chunk."""
        distinct = dict.fromkeys(chunks)
        new = [c for c in distinct if c not in self.at]
        if new and (len(self.at) + len(new) > self.limit or max(map(len, self.flat)) > 10 * self.limit):
            self.forget()
            new = list(distinct)
        if new:
            solved, marks = self.solve(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            for k, (ids, counts) in enumerate(solved):
                self.start[k] = np.concatenate((self.start[k], len(self.flat[k]) + np.cumsum(counts) - counts))
                self.count[k] = np.concatenate((self.count[k], counts))
                self.flat[k] = np.concatenate((self.flat[k], np.asarray(ids, np.int32)))
            self.mark = np.concatenate((self.mark, marks))
        return np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))

    def counts(self, entries: np.ndarray, table: int = 0) -> np.ndarray:
        return self.count[table][entries]

    def ids(self, entries: np.ndarray, table: int = 0) -> np.ndarray:
        """The ids of the entries, one after the other."""
        return self.flat[table][ragged(self.start[table][entries], self.count[table][entries])]


def together(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the lists, one after the other, and the length of each list."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.int32, int(counts.sum())), counts
