"""Phrase collocations by Rabin-Karp fingerprints.

A task takes texts in blocks. Prefix polynomials over the block's bytes give each word a value, and
prefix polynomials over these values a 64-bit fingerprint of every run of one to four words; both are
a few array operations for the whole block. Tasks add up equal fingerprints and hand them on in
ranges of the fingerprint; a shuffle adds the counts of all tasks. A phrase can only be frequent if
its fingerprint is, and if the phrases within it are: so words and pairs are counted first, and runs of
three and four only where all their pairs passed. What passed is known to the tasks as a bit map over
the fingerprints' first bits, of at most ``MAX_BITS``; a bit that is set by another fingerprint costs
time only.

The fingerprints decide nothing. In a last pass each block takes the places of runs whose fingerprints
passed, compares the text at all places of a fingerprint with that at the first, and hands on the
text with its count, once for each different text. Added up by text, the counts are exact whatever
fingerprints collide. Only these frequent phrases are ever made into strings. (Places stay in the task
that holds the text; what is shuffled is the fingerprint with its count, then the phrase.)

Null texts are empty; a null language counts as ``und``. Repeated rows count again. Texts of any
length are cut into blocks between pieces, or within a piece with the last three words repeated but not
counted again. Equal scores and counts are ordered by the phrase's bytes. Empty tables give no rows.
Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import ASCII_LOWER, map_rows, mixed
from corpusloom.plans.lineage import materialize

LONGEST = 4
#: Bytes of text that are hashed together.
BLOCK_BYTES = 1 << 20
#: Fingerprints that a task gathers before it adds up equal ones and hands them on.
GATHER = 3_000_000
#: Fingerprints in a range that is counted at once, on average.
RANGE_ENTRIES = 500_000
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
#: Bytes of a fingerprint that are shuffled, behind the bits that name its range.
KEY_BYTES = 5
#: Distinct phrases that a task counts before it hands its partial counts on.
FLUSH = 400_000
#: Bytes of text behind a part of the phrases that is added up at once.
PART_BYTES = 16 << 20
#: Bytes to what they mean: ends of pieces to line feed, tab to blank, A-Z to a-z, others to themselves.
MEANING = bytes(10 if chr(b) in ".,;:!?\n\v\f\r" else 32 if b == 9 else ASCII_LOWER[b] for b in range(256))
BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xC2B2AE3D27D4EB4F | 1


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to 0..n-1 and its inverse to 0..n-1, modulo 2**64."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        out = np.ones(n, np.uint64)
        out[1:] = b
        both.append(np.multiply.accumulate(out))
    return both[0], both[1]


class Hasher:
    """Prefix polynomials; keeps its powers and a random value for each byte."""

    def __init__(self) -> None:
        self.byte = mixed(np.arange(1, 257, dtype=np.uint64))
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of_runs(self, values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
        """The polynomials of ``values[start:end]`` for many starts and ends."""
        n = len(values) + 1
        if base not in self._powers or len(self._powers[base][0]) < n:
            self._powers[base] = powers(base, n)
        up, down = self._powers[base]
        prefix = np.zeros(n, np.uint64)
        np.cumsum(values * down[: n - 1], out=prefix[1:])
        return (prefix[end] - prefix[start]) * up[start]


class Block:
    """Words of a block of folded text: places, pieces and fingerprints. ``skip`` words are known already."""

    def __init__(self, text: bytes, lang: str, skip: int, hasher: Hasher) -> None:
        self.text, self.lang, self.skip = text, lang, skip
        a = np.frombuffer(text, np.uint8)
        apart = (a == 32) | (a == 10)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8)))
        self.start, self.end = edges[::2], edges[1::2]
        breaks = np.flatnonzero(a == 10)
        self.piece = np.searchsorted(breaks, self.start)
        values = hasher.of_runs(hasher.byte[a], self.start, self.end, BASE)
        self.words = mixed(values + (self.end - self.start).astype(np.uint64))
        self._hasher = hasher
        self._lang = np.uint64(int.from_bytes(lang.encode(), "little") % 0xFFFFFFFFFFFFFFC5)

    def __len__(self) -> int:
        return len(self.start)

    def runs(self, n: int, where: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints of all runs of ``n`` words within a piece, or of those ``where`` says."""
        many = len(self) - n + 1
        if many <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        whole = self.piece[:many] == self.piece[n - 1 :]
        whole[: max(0, min(many, self.skip - n + 1))] = False
        if where is not None:
            whole &= where
        i = np.flatnonzero(whole)
        hashes = self._hasher.of_runs(self.words, i, i + n, WORD_BASE)
        return i, mixed(mixed(hashes + self._lang) + np.uint64(n))

    def phrase(self, i: int, n: int) -> bytes:
        """The run of ``n`` words from word ``i`` on, joined by blanks."""
        return b" ".join(self.text[s:e] for s, e in zip(self.start[i : i + n].tolist(), self.end[i : i + n].tolist()))

    def word_numbers(self) -> np.ndarray:
        """A number for each word, equal if and only if the words' bytes are."""
        values, first, number = np.unique(self.words, return_index=True, return_inverse=True)
        length = self.end - self.start
        like = first[number]
        same = length == length[like]
        if same.all():
            a = np.frombuffer(self.text, np.uint8)
            shift = np.repeat(self.start - (np.cumsum(length) - length), length)
            at = np.arange(int(length.sum())) + shift
            there = at + np.repeat(self.start[like] - self.start, length)
            if (a[at] == a[there]).all():
                return number
        numbers: dict[bytes, int] = {}
        return np.array([numbers.setdefault(self.phrase(i, 1), len(numbers)) for i in range(len(self))])


def cut(text: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """A folded text in parts of about ``limit`` bytes, each with its number of repeated words."""
    at, known = 0, []  # the last words before a cut within a piece come again, so that runs across it are seen
    while len(text) - at > limit:
        end = text.rfind(b"\n", at + 1, at + limit)
        within = end < 0
        if within:
            end = text.rfind(b" ", at + limit // 2, at + limit)
        if end < 0:
            found = [x for x in (text.find(b" ", at + limit), text.find(b"\n", at + limit)) if x >= 0]
            if not found:
                break
            end = min(found)
        part = b" ".join([*known, text[at:end]])
        yield part, len(known)
        last = part.rpartition(b"\n")[2].split(b" ") if within else []
        at, known = end, [w for w in last if w][1 - LONGEST :]
    yield b" ".join([*known, text[at:]]), len(known)


def blocks(rows: Iterable[tuple[str | None, str | None]], hasher: Hasher) -> Iterator[Block]:
    """Rows of (lang, text) as blocks of one language."""
    waiting: dict[str, list[bytes]] = {}
    size: Counter[str] = Counter()

    def done(lang: str) -> Block:
        size.pop(lang)
        return Block(b"\n".join(waiting.pop(lang)), lang, 0, hasher)

    for lang, text in rows:
        if not text:
            continue
        lang = "und" if lang is None else lang
        folded = text.encode().translate(MEANING)
        if len(folded) > BLOCK_BYTES:
            for part, skip in cut(folded, BLOCK_BYTES):
                yield Block(part, lang, skip, hasher)
            continue
        waiting.setdefault(lang, []).append(folded)
        size[lang] += len(folded) + 1
        if size[lang] >= BLOCK_BYTES:
            yield done(lang)
        elif len(size) > 8 and size.total() >= 4 * BLOCK_BYTES:
            yield done(max(size, key=size.get))
    for lang in list(waiting):
        yield done(lang)


class Bits:
    """Which first bits of fingerprints passed."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.shift = data, np.uint64(64 - (8 * len(data)).bit_length() + 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> self.shift
        return (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def run_places(block: Block, sizes: tuple[int, ...], bits: Bits | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first words, fingerprints) of the block's runs; of three words and more only if their pairs passed."""
    pairs = None
    for n in sizes:
        where = None
        if n > 2:
            if pairs is None:
                i, keys = block.runs(2)
                pairs = np.zeros(max(0, len(block) - 1), bool)
                pairs[i[bits.has(keys)]] = True
                if block.skip:
                    pairs[: block.skip] = True  # not asked for; the run itself is
            many = len(block) - n + 1
            where = np.ones(max(0, many), bool)
            for k in range(n - 1):
                where &= pairs[k : k + max(0, many)]
        yield n, *block.runs(n, where)


def fingerprint_counts(docs: DataFrame, sizes: tuple[int, ...], ranges: int, bits=None) -> DataFrame:
    """(range, keys, counts): fingerprints of the runs of ``docs(lang, text)``, added up within tasks.

    A key is the ``KEY_BYTES`` bytes of the fingerprint that follow the bits of its range.
    """
    below = 64 - (ranges - 1).bit_length()
    shift, cut_off = np.uint64(below - 8 * KEY_BYTES), np.uint64(8 * KEY_BYTES)

    def count(rows: Iterable[tuple]) -> Iterator[tuple]:
        hasher, known = Hasher(), Bits(bits.value) if bits else None
        held: list[np.ndarray] = []

        def handed_on() -> Iterator[tuple]:
            keys, counts = np.unique(np.concatenate(held) >> shift, return_counts=True)
            held.clear()
            counts = counts.astype("<u4")
            part = (keys >> cut_off).astype(np.int64)
            low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(keys))
            start = 0
            for end in ends.tolist():
                yield int(part[start]), low[start:end].tobytes(), counts[start:end].tobytes()
                start = end

        for block in blocks(rows, hasher):
            held += [keys for _, _, keys in run_places(block, sizes, known) if len(keys)]
            if sum(map(len, held)) >= GATHER:
                yield from handed_on()
        if held:
            yield from handed_on()

    return map_rows(docs, count, "range int, keys binary, counts binary", batch=500)


def passed(counted: DataFrame, ranges: int, n_bits: int, least: int) -> np.ndarray:
    """The bit map of all fingerprints with a total of at least ``least``."""
    spark = counted.sparkSession
    tasks = min(ranges, max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 8))
    dealt = counted.repartition(tasks, "range").sortWithinPartitions("range")
    own_bits = n_bits // ranges
    shift = np.uint64(8 * KEY_BYTES - (own_bits - 1).bit_length())

    def total(rows: Iterable[tuple]) -> Iterator[tuple]:
        here, keys, counts = None, [], []

        def frequent() -> Iterator[tuple]:
            k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
            order = np.argsort(k)
            k = k[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            found = k[first][np.add.reduceat(c[order], first) >= least]
            if len(found):
                bits = np.zeros(own_bits, np.uint8)
                bits[(found >> shift).astype(np.int64)] = 1
                yield here, np.packbits(bits, bitorder="little").tobytes()

        for r, k, c in rows:
            if r != here:
                if keys:
                    yield from frequent()
                here, keys, counts = r, [], []
            whole = np.zeros((len(k) // KEY_BYTES, 8), np.uint8)
            whole[:, :KEY_BYTES] = np.frombuffer(k, np.uint8).reshape(-1, KEY_BYTES)
            keys.append(whole.view("<u8").ravel())
            counts.append(np.frombuffer(c, "<u4"))
        if keys:
            yield from frequent()

    out = np.zeros(n_bits // 8, np.uint8)
    for r, data in map_rows(dealt, total, "range int, data binary", batch=50).collect():  # at most n_bits in all
        out[r * own_bits // 8 : (r + 1) * own_bits // 8] = np.frombuffer(data, np.uint8)
    return out


def block_phrases(block: Block, bits: Bits) -> Iterator[tuple[bytes, int, int]]:
    """(phrase, words, count) of the block's runs whose fingerprints passed; one text may come more than once."""
    number = block.word_numbers()
    for n, places, keys in run_places(block, tuple(range(1, LONGEST + 1)), bits):
        kept = bits.has(keys)
        places, keys = places[kept], keys[kept]
        _, first, group, many = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        like = places[first[group]]
        same = np.ones(len(places), bool)
        for k in range(n):
            same &= number[places + k] == number[like + k]
        if not same.all():  # other texts with the fingerprint of an earlier one
            many = many - np.bincount(group[~same], minlength=len(many))
            yield from ((block.phrase(i, n), n, 1) for i in places[~same].tolist())
        at = places[first]
        plain = np.ones(len(at), bool)  # words that are one blank apart can be taken as they stand
        for k in range(n - 1):
            plain &= block.start[at + k + 1] == block.end[at + k] + 1
        text = block.text
        for i, begin, end, as_is, m in zip(at.tolist(), block.start[at].tolist(), block.end[at + n - 1].tolist(), plain.tolist(), many.tolist()):
            yield text[begin:end] if as_is else block.phrase(i, n), n, m


def phrase_counts(docs: DataFrame, bits, least: int, parts: int) -> DataFrame:
    """(lang, phrase, k, f) of the runs that passed and occur at least ``least`` times, by their text.

    ``k`` is the number of words; a row with 0 words holds the language's number of all words. Tasks hand
    on sorted phrases in parts of the hash of their text.
    """

    def texts(rows: Iterable[tuple]) -> Iterator[tuple]:
        hasher, known = Hasher(), Bits(bits.value)
        held: dict[str, dict[bytes, int]] = {}

        def handed_on() -> Iterator[tuple]:
            for lang, found in held.items():
                dealt: dict[int, list[bytes]] = {}
                for phrase in sorted(found):
                    dealt.setdefault(zlib.crc32(phrase) % parts, []).append(phrase)
                for part, own in dealt.items():
                    yield part, lang, b"\n".join(own), np.array([found[p] for p in own], "<i8").tobytes()
            held.clear()

        for block in blocks(rows, hasher):
            found = held.setdefault(block.lang, {b"": 0})
            found[b""] += len(block) - block.skip  # no phrase is empty: this counts all words
            for phrase, _, m in block_phrases(block, known):
                found[phrase] = found.get(phrase, 0) + m
            if sum(map(len, held.values())) >= FLUSH:
                yield from handed_on()
        yield from handed_on()

    def add(rows: Iterable[tuple]) -> Iterator[tuple]:
        here, total = None, {}

        def frequent() -> Iterator[tuple]:
            for phrase, f in total.items():
                if not phrase:
                    yield here[1], None, 0, f
                elif f >= least:
                    yield here[1], phrase.decode(), phrase.count(b" ") + 1, f
            total.clear()

        for part, lang, phrases, counts in rows:
            if (part, lang) != here:
                yield from frequent()
                here = part, lang
            for phrase, f in zip(phrases.split(b"\n"), np.frombuffer(counts, "<i8").tolist()):
                total[phrase] = total.get(phrase, 0) + f
        yield from frequent()

    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 4)
    sent = map_rows(docs, texts, "part int, lang string, phrases binary, counts binary", batch=200)
    dealt = sent.repartition(tasks, "part").sortWithinPartitions("part", "lang")
    return map_rows(dealt, add, "lang string, phrase string, k int, f long", batch=20_000)


def frequent_phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, phrase, k, f) of all runs of one to four words that occur at least ``least`` times, stored.

    Rows with ``k`` 0 hold the number of all words of a language.
    """
    docs = docs.select("lang", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = max(1, size // 6)
    n_bits = min(MAX_BITS, max(MIN_BITS, 1 << (words - 1).bit_length()))
    ranges = max(2, min(n_bits // 64, 1 << (2 * words // RANGE_ENTRIES).bit_length()))
    spark = docs.sparkSession
    short = spark.sparkContext.broadcast(passed(fingerprint_counts(docs, (1, 2), ranges), ranges, n_bits, least))
    both = passed(fingerprint_counts(docs, (3, 4), ranges, short), ranges, n_bits, least) | short.value
    every = spark.sparkContext.broadcast(both)
    found = materialize(phrase_counts(docs, every, least, max(1, size // PART_BYTES)), "phrases")
    short.destroy()
    every.destroy()
    return found


def collocations(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of ``docs(lang, text)``.

    A phrase of two to four words is scored by its weakest cut, with ``l`` and ``r`` the counts of the
    two parts; phrases within a longer one of at least four fifths of their count are left out.
    """
    counted = frequent_phrases(docs, least)
    parts = counted.where("k > 0")
    words = F.split("phrase", " ")
    long = counted.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("words"))
    cuts = long.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    within = long.where("k > 2").select(
        "lang", "a", "words", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")
    )
    within = within.select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at")
    )
    covers = within.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    covered = F.expr("cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * 80")
    kept = weakest.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
    best = Window.partitionBy("lang").orderBy(F.col("w.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = counted.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"),
        "n", F.col("w.score").cast("long").alias("score"),
    )
