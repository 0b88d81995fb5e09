"""Sparse incidence entries (key, owner) dealt into blocks of keys, as compact chunks.

A task packs the entries of many owners, cuts them by key into blocks and ships one binary chunk
per block: the keys, small indexes into the chunk's owners, and the owners once. A block is a
range of a hash, so a block's task sees every entry of its keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from corpusloom.llm.common import map_rows, mixed

#: Entries that a task gathers before it ships chunks, and the mean entries of a block.
FLUSH = 1_500_000
BLOCK = 1_000_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def signed(x: int | np.uint64) -> int:
    """A 64-bit pattern as Spark's long."""
    x = int(x)
    return x - (1 << 64) if x >= 1 << 63 else x


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each key."""
    return ((mixed(keys) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


class Chunks:
    """Gathers entries in one task."""

    def __init__(self, blocks: int) -> None:
        self.blocks = blocks
        self.clear()

    def clear(self) -> None:
        self.keys: list[np.ndarray] = []
        self.owners: list[int] = []
        self.marks: list[int] = []
        self.size = 0

    def add(self, keys: np.ndarray, owner: int, mark: int) -> Iterator[tuple[int, bytes]]:
        """Add an owner's keys; yields chunks when enough have come together."""
        self.keys.append(keys)
        self.owners.append(owner)
        self.marks.append(mark)
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if self.size:
            keys = np.concatenate(self.keys)
            at = np.repeat(np.arange(len(self.keys), dtype=np.uint32), [len(k) for k in self.keys])
            block = block_of(keys, self.blocks)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(self.blocks + 1))
            owners, marks = np.array(self.owners, np.int64), np.array(self.marks, np.uint32)
            for b in range(self.blocks):
                part = order[edges[b] : edges[b + 1]]
                if len(part):
                    used, index = np.unique(at[part], return_inverse=True)
                    yield b, pack_chunk(keys[part], index.astype(np.uint32), owners[used], marks[used])
        self.clear()


def pack_chunk(keys, index, owners, marks) -> bytes:
    """One chunk; indexes take two bytes where they fit."""
    kind = np.uint16 if len(owners) < 1 << 16 else np.uint32
    head = np.array([len(keys), len(owners), kind().itemsize], np.int64)
    return b"".join(x.tobytes() for x in (head, keys, owners, marks, index.astype(kind)))


def unpack_chunk(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, owner, mark) of each entry."""
    n, m, width = np.frombuffer(data, np.int64, 3)
    at = 24
    keys = np.frombuffer(data, np.uint64, n, at)
    owners = np.frombuffer(data, np.int64, m, at := at + 8 * int(n))
    marks = np.frombuffer(data, np.uint32, m, at := at + 8 * int(m))
    index = np.frombuffer(data, np.uint16 if width == 2 else np.uint32, n, at + 4 * int(m))
    return keys, owners[index], marks[index]


def each_block(chunks: DataFrame, blocks: int, fn, schema: str, batch: int = 20_000) -> DataFrame:
    """``fn(keys, owners, marks)`` over the entries of each block, sorted by key, mark and owner, each once."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, parts = None, []
        for b, data in rows:
            if b != now and parts:
                yield from fn(*gathered(parts))
                parts = []
            now = b
            parts.append(unpack_chunk(data))
        if parts:
            yield from fn(*gathered(parts))

    dealt = chunks.repartition(blocks, "block").sortWithinPartitions("block")
    return map_rows(dealt.select("block", "data"), run, schema, batch)


def gathered(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, owners, marks = (np.concatenate(x) for x in zip(*parts))
    parts.clear()  # each entry is held once while they are sorted
    order = np.lexsort((owners, marks, keys))
    return keys[order], owners[order], marks[order]


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal keys in a sorted array."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(keys)])
