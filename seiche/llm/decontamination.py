"""Benchmark passages in documents: SimHash of item-sized windows, found by multi-index Hamming blocks, then verified.

Words are compared without case and without what isn't a letter or digit. The benchmark is the stated query set; it is
read in blocks of bounded size, and each block's index is broadcast against all documents. A window that holds too few
of the block's shingles can't reach the similarity and gets no fingerprint; the others of the size of some item get one,
every item within the Hamming radius is found through the blocks, and the shingles themselves decide.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import chunks, mixed, rolled, tidy, words

SHINGLE, SIMILARITY = 5, 0.8
#: Four blocks of 16 bits; fingerprints within 19 bits have a block within 4.
BLOCKS, RADIUS = 4, 19
#: A block of the benchmark: items and bytes of text at most.
MOST_ITEMS, MOST_BYTES = 20_000, 16 << 20

#: Words of the shortest item that counts: one of fewer has no shingle, and clean documents hold its words by chance.
LEAST_WORDS = SHINGLE

NOISE = re.compile(r"[\W_]+")
#: All 16-bit values with 4 bits or fewer.
NEAR = np.array([sum(1 << b for b in c) for n in range(RADIUS // BLOCKS + 1) for c in combinations(range(16), n)], np.uint16)
TABLE = 22


class Words(dict):
    """The hash of a word's letters and digits, lower case; 0 if it has none. What it holds is bounded."""

    def __init__(self, most: int = 100_000):
        import xxhash

        self.most, self.of = most, xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        bare = word.decode().lower()
        bare = bare if bare.isalnum() else NOISE.sub("", bare)
        h = self[word] = self.of(bare, 7) or 1 if bare else 0
        return h

    def hashes(self, text: bytes) -> np.ndarray:
        w = words(text)
        h = np.fromiter(map(self.__getitem__, w), np.uint64, len(w))
        return h[h != 0]


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    return mixed(rolled(h, size))


def simhash(s: np.ndarray) -> int:
    bits = np.unpackbits(s.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(s), bitorder="little").view(np.uint64)[0])


def similarity(a: Counter, b: Counter) -> float:
    """Of two weighted sets of shingles: the sum of the smaller weights over the sum of the larger ones."""
    both = sum(min(n, b[s]) for s, n in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both)


class Index:
    """Items of a bounded block of the benchmark. An item of fewer than SHINGLE words has shingles of all its words."""

    def __init__(self, items: list[tuple[int, bytes]], least_words: int = 1):
        of = Words()
        self.by_size: dict[int, dict[int, list[int]]] = {}  # words in a shingle, words in the item: numbers of items
        self.ids, self.lengths, self.weights, prints, seen, own = [], [], [], [], {}, {}
        for i, text in items:
            h = of.hashes(text)
            if len(h) < max(1, least_words):
                continue
            size = min(SHINGLE, len(h))
            s = shingles(h, size)
            k = len(self.ids)
            self.ids.append(i)
            self.lengths.append(len(h))
            self.weights.append(Counter(s.tolist()))
            prints.append(simhash(s))
            self.by_size.setdefault(size, {}).setdefault(len(h), []).append(k)
            seen.setdefault(size, set()).update(s.tolist())
            own.setdefault((size, len(h)), set()).update(s.tolist())
        self.prints = np.array(prints, np.uint64)
        self.known = {k: np.array(sorted(v), np.uint64) for k, v in seen.items()}
        self.own = {k: np.array(sorted(v), np.uint64) for k, v in own.items()}  # of items of one length
        self.maybe = {}
        for k, v in self.known.items():
            self.maybe[k] = np.zeros(1 << TABLE, bool)
            self.maybe[k][(v >> np.uint64(64 - TABLE)).astype(np.int64)] = True
        self.tables = {}
        for size, by_length in self.by_size.items():
            for length, numbers in by_length.items():
                values = self.prints[numbers].view(np.uint16).reshape(-1, BLOCKS)
                tables = []
                for j in range(BLOCKS):
                    order = np.argsort(values[:, j], kind="stable")
                    tables.append((values[order, j], np.array(numbers)[order]))
                self.tables[size, length] = tables

    def near(self, size: int, length: int, fp: int) -> list[int]:
        """Items of that length within RADIUS bits of the fingerprint."""
        f = np.uint64(fp)
        parts = np.array([f]).view(np.uint16)
        found: set[int] = set()
        for part, (values, numbers) in zip(parts, self.tables[size, length]):
            if len(values) <= len(NEAR):  # fewer items than probes: compare them all
                found.update(numbers[np.bitwise_count(values ^ part) <= RADIUS // BLOCKS].tolist())
                continue
            probes = NEAR ^ part
            a, b = np.searchsorted(values, probes, "left"), np.searchsorted(values, probes, "right")
            for x in np.flatnonzero(b > a):
                found.update(numbers[a[x] : b[x]].tolist())
        numbers = np.fromiter(found, np.int64, len(found))
        return numbers[np.bitwise_count(self.prints[numbers] ^ f) <= RADIUS].tolist()

    def matches(self, h: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(number of the item, best similarity, first word of that window, words) of the items that a window of their
        size matches; h: a document's word hashes."""
        best: dict[int, tuple[float, int]] = {}
        for size, by_length in self.by_size.items():
            s = shingles(h, size)
            if not len(s):
                continue
            hit = self.maybe[size][(s >> np.uint64(64 - TABLE)).astype(np.int64)]
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            known = self.known[size]
            place = np.minimum(np.searchsorted(known, s[at]), len(known) - 1)
            at = at[known[place] == s[at]]
            if not len(at):
                continue
            values = s[at]
            done: dict[tuple[int, int], list[int]] = {}
            for length in by_length:
                least = SIMILARITY * (length - size + 1)
                n = min(length - size + 1, len(s))  # shingles in the window: a shorter document is one window
                own = self.own[size, length]
                mine = at[own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values]
                # a match needs so many of the window's shingles in an item of its length
                if len(mine) < least:
                    continue
                total = np.zeros(len(s) + 1, np.int64)
                total[mine + 1] = 1
                total = np.cumsum(total)
                for start in np.flatnonzero(total[n:] - total[:-n] >= least).tolist():
                    window = s[start : start + n]
                    fp = simhash(window)
                    if (near := done.get((length, fp))) is None:
                        near = done[length, fp] = self.near(size, length, fp)
                    weights = Counter(window.tolist()) if near else None
                    for k in near:
                        if best.get(k, (0.0, 0))[0] < 1.0 and (x := similarity(self.weights[k], weights)) >= SIMILARITY and x > best.get(k, (0.0, 0))[0]:
                            best[k] = (x, start)
        return [(k, x, start, min(self.lengths[k], len(h))) for k, (x, start) in sorted(best.items())]


def indexes(benchmark: DataFrame, least_words: int = LEAST_WORDS) -> Iterator[Index]:
    """The benchmark's items, block by block; a block holds about MOST_ITEMS items and MOST_BYTES bytes at most. Null texts
    and texts of fewer than least_words words match nothing."""
    b = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text IS NOT NULL")
    n, size = b.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // MOST_ITEMS), -(-size // MOST_BYTES))
    for k in range(parts):
        own = b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").toArrow()
        yield Index([(i, t.encode()) for i, t in zip(own.column(0).to_pylist(), own.column(1).to_pylist())], least_words)


def leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the items that a window of a document of the item's own number
    of words, or a shorter document as a whole, matches with a weighted similarity of five-word shingles of 0.8 or more;
    the best window, the first of ties. Items of fewer than least_words words are left out; those of fewer than five are
    otherwise matched as a whole.

    Very long documents are one row each; their windows are counted by arrays. Null and empty texts match nothing; repeated rows each match; null ids stay null. Empty tables: no rows. Other columns
    are ignored. No shuffle: documents are read once for each block of the benchmark."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("bigint"), "text")
    schema = "doc_id bigint, item_id bigint, similarity double, first_word int, n_words int"
    out = spark.createDataFrame([], schema)
    for index in indexes(benchmark, least_words):
        kept = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], kept=kept) -> Iterator[pa.RecordBatch]:
            of, x = Words(), kept.value
            for part, texts in chunks(batches, "text"):
                rows = [(i, x.ids[k], sim, start, n) for i, t in zip(part.column(0).to_pylist(), texts) for k, sim, start, n in x.matches(of.hashes(t))]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
                yield pa.record_batch([pa.array([r[c] for r in rows], kinds[c]) for c in range(5)], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        out = out.union(src.mapInArrow(tidy(run), schema))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs without the rows that hold a passage of the benchmark (see leaks); all columns stay. Null and empty texts stay,
    repeated rows stay or go alike; an empty benchmark drops nothing, an empty table gives no rows."""
    out = docs
    for index in indexes(benchmark, least_words):
        kept = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], kept=kept) -> Iterator[pa.RecordBatch]:
            of, x = Words(), kept.value
            for part, texts in chunks(batches, "text"):
                yield part.filter(pa.array([not x.matches(of.hashes(t)) for t in texts]))

        out = out.mapInArrow(tidy(run), docs.schema)
    return out
