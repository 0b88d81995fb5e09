"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Best fit depends on lengths only, and there are at most ``capacity`` different ones. The
documents are tokenised and counted by length in Spark; best-fit decreasing then runs over that
histogram (at most 2,048 counts, whatever the corpus), with a segment tree over the remaining
capacities that finds the tightest open bin in logarithmic time. It yields, for each length,
intervals of ranks with their bins; Spark numbers the pieces of each length and looks them up.
The result is the same as placing the pieces one by one.

Texts that are null count as empty (one separator). Repeated rows are packed like any others;
equal lengths are placed in the order of a hash of the document id, then the id. Empty tables
give empty results. Further columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows
from corpusloom.plans.lineage import bounded_rows, materialize

CAPACITY = 2048
#: Rows numbered by one window task, on average.
RANK_ROWS = 50_000
#: Characters for which both tokenizer libraries are known to agree: printable ASCII, line feed, Latin-1 letters.
PLAIN = bytes([10, *range(32, 127), 0xA1, 0xBF, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])


@lru_cache(2)
def tokenizers_of(name: str):
    """The tokenizer of a file, and a faster encoder with the same vocabulary and ranks."""
    import public_tokenizers as files
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(files.path(f"{name}.json"))
    with open(files.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return slow, fast


def encode(text: str, name: str = "byte_bpe_50k") -> np.ndarray:
    """Token ids of a text, as the tokenizer file defines them, without added special tokens.

    Texts of plain characters go to the faster library; all others, and those that spell a
    special token, to the tokenizer itself.
    """
    slow, fast = tokenizers_of(name)
    try:
        plain = "<|" not in text and not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        plain = False
    if plain:
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def token_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document with its closing separator.

    Only documents longer than ``capacity`` are cut; their first piece takes the remainder, so
    that all others are full.
    """

    def pieces(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            ids = np.append(encode(text or "", tokenizer), np.uint32(separator)).astype("<u4")
            start, end = 0, (len(ids) - 1) % capacity + 1
            piece = 0
            while start < len(ids):
                part = ids[start:end]
                out = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))
                yield (*out, part.tolist()) if with_ids else out
                piece, start, end = piece + 1, end, end + capacity

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return map_rows(docs.select("doc_id", "text"), pieces, schema)


class CapacityTree:
    """A segment tree over capacities 0..n: which have open bins, and the smallest such from a given one."""

    def __init__(self, n: int) -> None:
        self.size = 1 << n.bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, capacity: int, filled: bool) -> None:
        i = self.size + capacity
        self.any[i] = filled
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= ``least`` that has an open bin."""
        i = self.size + least
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


@dataclass
class Run:
    """Pieces ``first..first+count-1`` of a length: ``each`` per bin from ``bin`` on, the first at ``offset``."""

    length: int
    first: int
    count: int
    each: int
    bin: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing over a histogram of lengths, bins with equal room taken together."""
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs: list[Run] = []
    new = 0

    def put(room: int, start: int, n: int) -> None:
        if room and n:
            open_bins.setdefault(room, []).append((start, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                start, n = new, -(-left // each)
                new += n
            else:
                each = room // length
                start, n = open_bins[room].pop()
                need = -(-left // each)
                if n > need:
                    open_bins[room].append((start + need, n - need))
                    n = need
                tree.set(room, bool(open_bins[room]))
            placed = min(left, n * each)
            runs.append(Run(length, rank, placed, each, start, capacity - room))
            full, rest = divmod(placed, each)
            put(room - each * length, start, full)
            if rest:
                put(room - rest * length, start + full, 1)
            left, rank = left - placed, rank + placed
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1..capacity."""
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    counts = {r[0]: r[1] for r in bounded_rows(pieces.groupBy("length").count(), capacity, "lengths")}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    salts = max(1, sum(counts.values()) // RANK_ROWS)
    runs = [(r.length, r.first, r.first + r.count, r.each, r.bin, r.offset) for r in best_fit(counts, capacity)]
    table = spark.createDataFrame(runs, "length long, first long, last long, each long, bin long, place long")
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("last", "first", "each", "bin", "place"))).alias("runs"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(own)).join(starts, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth") - 1).join(F.broadcast(table), "length")
    run = F.get(F.filter("runs", lambda r: F.col("rank") < r["last"]), F.lit(0))
    nth = F.col("rank") - F.col("run.first")
    return ranked.withColumn("run", run).select(
        *pieces.columns,
        (F.col("run.bin") + F.floor(nth / F.col("run.each"))).alias("sequence_id"),
        (F.col("run.place") + F.pmod(nth, F.col("run.each")) * F.col("length")).alias("offset"),
    )


def best_fit_packing(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece with its sequence and place."""
    return pack(token_pieces(docs, tokenizer, capacity), capacity)
