"""Substring dedup by level-wise doubling: windows of words that repeat across documents are extended to twice their
length as long as any repeat.

Rows are packed into bundles (see bundles.py), written once to shared storage, bucketed. A level sends, for each bundle and
each part of the hash space, one sorted array of its distinct window hashes; a task of the level sees all bundles' arrays
of one part, and answers each with a bit a hash: does another document have it (at the first level a second one: does a
document with a smaller id). So what moves is bytes, not a row for each window; a window in a third of all documents is
one entry for each bundle; and no group of rows with one key is ever gathered.

Before the first level, a sieve of half its length: identical 13-word windows have the same least 7-word hash inside, so
only windows whose least 7-word hash repeats go on. The sieve sends a quarter of the positions.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.llm.bundles import NULL, Bundle, cuts, distinct, nulls_of, rows_of, words_of, written_bundles
from seiche.llm.common import drop_scratch, free_shuffles, mixed, rolled, scratch, tidy

#: Words in the first level's window, and in the sieve's.
WINDOW, SIEVE = 13, 7
#: Hashes that a task of a level holds, on average.
PART = 1_000_000

ASKS = "place int, part int, bundle bigint, hashes binary, docs binary"
ANSWERS = "bundle bigint, part int, bits binary"


class Rows:
    """The words of some rows of a bundle as hashes, one after another. row: of each word; room: words from it to its row's end."""

    def __init__(self, b: Bundle, rows: np.ndarray | None = None):
        self.b = b
        every = rows is None
        rows = np.arange(len(b.ids)) if every else rows
        self.n = b.sizes[rows]
        self.h = b.hashes[b.codes if every else b.codes[b.places(rows)]]
        self.row = np.repeat(rows, self.n)
        self.room = np.repeat(np.cumsum(self.n), self.n) - np.arange(len(self.h))

    def windows(self, length: int, at: np.ndarray) -> np.ndarray:
        return mixed(rolled(self.h, length)[at])

    def sieve(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows; for each, its run of windows with one least SIEVE-word hash; each run's hash and row."""
        at = np.flatnonzero(self.room >= WINDOW)
        if not len(at):
            return at, at, np.empty(0, np.uint64), at
        least = sliding_least(mixed(rolled(self.h, SIEVE)))[at]
        row = self.row[at]
        new = np.ones(len(at), bool)
        new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        return at, np.cumsum(new) - 1, least[new], row[new]


def sliding_least(h: np.ndarray) -> np.ndarray:
    """For each start, the least of the SIEVE-word hashes inside the WINDOW-word window: of WINDOW - SIEVE + 1 values."""
    width, size = WINDOW - SIEVE + 1, 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :])


def _few(ids: np.ndarray) -> bytes:
    """Ids as the distinct ones and, for each, its number among them."""
    u, which = np.unique(ids, return_inverse=True)
    return struct.pack("<q", len(u)) + u.tobytes() + which.astype(np.uint16 if len(u) <= 1 << 16 else np.uint32).tobytes()


def _many(b: bytes) -> np.ndarray:
    n = struct.unpack_from("<q", b)[0]
    u = np.frombuffer(b, np.int64, n, 8)
    return u[np.frombuffer(b, np.uint16 if n <= 1 << 16 else np.uint32, -1, 8 + 8 * n)]


def _asks(name: str, u: np.ndarray, parts: int, ids: np.ndarray | None = None) -> Iterator[tuple]:
    at = cuts(u, parts)
    for k in range(parts):
        a, b = at[k], at[k + 1]
        if b > a:
            yield k, name, u[a:b].tobytes(), b"" if ids is None else _few(ids[a:b])


def _note(name: str, parts: int, levels: np.ndarray, rows: np.ndarray, bits: np.ndarray) -> tuple:
    """What a bundle tells its next step: for each row how many levels repeat in it, the rows that have candidates, and a bit for each of their words."""
    body = struct.pack("<q", len(rows)) + levels.astype(np.uint8).tobytes() + rows.astype(np.int32).tobytes() + np.packbits(bits).tobytes()
    return -1 - xxhash.xxh32_intdigest(struct.pack("<q", name)) % parts, name, zstandard.compress(body, 1), b""


def _read_note(body: bytes, n: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    body = zstandard.decompress(body)
    k = struct.unpack_from("<q", body)[0]
    return np.frombuffer(body, np.uint8, n, 8).copy(), np.frombuffer(body, np.int32, k, 8 + n).astype(np.int64), body[8 + n + 4 * k :]


def _answer(table: pa.Table) -> pa.Table:
    """All asks of one part: for each hash, whether another bundle has it, and, where ids came, whether one with a smaller
    id does. Notes pass."""
    part = table.column("part")[0].as_py()
    names = table.column("bundle").to_pylist()
    asked = table.column("hashes").to_pylist()
    if part < 0:
        return _table([(n, part, b) for n, b in zip(names, asked)])
    each = [np.frombuffer(b, np.uint64) for b in asked]
    ends = np.cumsum([len(x) for x in each])
    docs = table.column("docs").to_pylist()
    with_ids = any(docs)
    ids = np.concatenate([_many(b) for b in docs]) if with_ids else None
    u, starts, back, least, _ = distinct(np.concatenate(each), ids)
    bits = [(np.diff(np.append(starts, len(back))) > 1)[back]]
    if with_ids:
        bits.append(least[back] < ids)
    out, a = [], 0
    for n, b in zip(names, ends.tolist()):
        out.append((n, part, struct.pack("<q", b - a) + b"".join(np.packbits(x[a:b]).tobytes() for x in bits)))
        a = b
    return _table(out)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["bundle", "part", "bits"])


def _decode(row: dict, which: int = 0) -> np.ndarray:
    """One of the bits of all asked hashes, in their order. 0: another document has it; 1: one with a smaller id."""
    out = [np.zeros(0, bool)]
    for x in row["notes"] or ():
        if x["part"] >= 0:
            n = struct.unpack_from("<q", x["bits"])[0]
            size = -(-n // 8)
            out.append(np.unpackbits(np.frombuffer(x["bits"], np.uint8, size, 8 + which * size), count=n).astype(bool))
    return np.concatenate(out)


class Step:
    """One pass over the bundles. length 0: ask for the sieve. length WINDOW: from the sieve's answers, ask for the first
    level. Twice that and so on: from the answers about windows of half the length, ask for the double ones."""

    def __init__(self, length: int, parts: int):
        self.length, self.parts = length, parts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                out = list(self.asks(row))
                # each part has a task of its own; notes are dealt over the same ones
                place = [r[0] if r[0] >= 0 else -1 - r[0] for r in out]
                yield pa.record_batch([pa.array(place, pa.int32()), pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())], ["place", "part", "bundle", "hashes", "docs"])

    def asks(self, row: dict) -> Iterator[tuple]:
        b = Bundle(row)
        if self.length <= WINDOW:
            r = Rows(b)
            at, run, h, of = r.sieve()
            if not len(at):
                return
            u, _, back, first, last = distinct(h, of)
            if not self.length:
                yield from _asks(b.name, u, self.parts)
                return
            at = at[(_decode(row) | (last > first))[back][run]]
            levels = np.zeros(len(b.ids), np.uint8)
        else:
            half = self.length // 2
            r, at, levels, again = _repeated(b, row, half)
            levels = np.maximum(levels, _level(r, at[again], half))
            kept = np.zeros(len(r.h) + 1, bool)
            kept[at[again]] = True
            at = at[again]
            at = at[r.room[at] >= self.length]
            at = at[kept[at + half]]
        rows = np.unique(r.row[at])
        bits = np.zeros(len(r.h), bool)
        bits[at] = True
        yield _note(b.name, self.parts, levels, rows, bits[np.isin(r.row, rows)])
        if len(at):
            u, _, _, first, _ = distinct(r.windows(self.length, at), r.row[at])
            yield from _asks(b.name, u, self.parts, b.ids[first] if self.length == WINDOW else None)


def _candidates(b: Bundle, row: dict) -> tuple[Rows, np.ndarray, np.ndarray]:
    """The rows that have candidates, where those start, and the levels known before."""
    levels, rows, bits = _read_note(next(x["bits"] for x in row["notes"] if x["part"] < 0), len(b.ids))
    r = Rows(b, rows)
    return r, np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(r.h))), levels


def _repeated(b: Bundle, row: dict, length: int) -> tuple[Rows, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with candidates of this length, their starts, the levels known before, which candidates repeat."""
    r, at, levels = _candidates(b, row)
    if not len(at):
        return r, at, levels, np.zeros(0, bool)
    _, _, back, first, last = distinct(r.windows(length, at), r.row[at])
    return r, at, levels, (_decode(row) | (last > first))[back]


def _level(r: Rows, at: np.ndarray, length: int) -> np.ndarray:
    """For each row with a repeated window of this length: how many levels that is."""
    out = np.zeros(len(r.b.ids), np.uint8)
    out[np.unique(r.row[at])] = (length // WINDOW).bit_length()
    return out


def _covered(b: Bundle, row: dict) -> np.ndarray:
    """Which words of the bundle a window covers that also starts in a row with a smaller id."""
    gone = np.zeros(len(b.codes), bool)
    if any(x["part"] < 0 for x in row["notes"] or ()):
        r, at, _ = _candidates(b, row)
        if len(at):
            _, _, back, first, _ = distinct(r.windows(WINDOW, at), r.row[at])
            at = at[_decode(row, 1)[back] | (b.ids[first][back] < b.ids[r.row[at]])]
            edge = np.zeros(len(r.h) + 1, np.int64)
            edge[at] += 1
            edge[at + WINDOW] -= 1
            gone[b.places(np.unique(r.row))] = np.cumsum(edge[:-1]) > 0
    return gone


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, longest bigint, spans array<struct<start:int,words:int>>, kept string"
SPAN = pa.struct([("start", pa.int32()), ("words", pa.int32())])


def _spans(gone: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Of each row, the runs of removed words: start in the row, number of words."""
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(gone & np.concatenate(([True], ~gone[:-1] | (row[1:] != row[:-1])))) if len(gone) else np.empty(0, np.int64)
    ends = np.flatnonzero(gone & np.concatenate((~gone[1:] | (row[1:] != row[:-1]), [True]))) if len(gone) else starts
    values = pa.StructArray.from_arrays([pa.array((starts - first[row[starts]]).astype(np.int32)), pa.array((ends - starts + 1).astype(np.int32))], fields=list(SPAN))
    offsets = np.searchsorted(row[starts], np.arange(len(sizes) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            b = Bundle(row)
            gone = _covered(b, row)
            levels = np.frombuffer(row["levels"], np.uint8).astype(np.int64) if row["levels"] else np.zeros(len(b.ids), np.int64)
            longest = np.where(levels > 0, WINDOW << np.maximum(levels - 1, 0), 0)
            per_row = np.bincount(np.repeat(np.arange(len(b.ids)), b.sizes), gone, len(b.ids)).astype(np.int64)
            offsets = np.concatenate(([0], np.cumsum(b.sizes - per_row))).astype(np.int32)
            words = pa.array(words_of(row), pa.binary()).cast(pa.string())
            kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(b.codes[~gone]))), " ")
            ids = pa.array(b.ids, mask=nulls_of(row))
            yield pa.record_batch([ids, pa.array(b.sizes), pa.array(per_row), pa.array(longest), _spans(gone, b.sizes), kept], ["doc_id", "n_words", "n_removed", "longest", "spans", "kept"])


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        yield pa.record_batch([pa.array([r["bundle"] for r in rows], pa.int64()), pa.array([np.max([_read_note(x, r["n"])[0] for x in r["own"]], axis=0).tobytes() for r in rows], pa.binary())], ["bundle", "levels"])


def substring_dedup(docs: DataFrame, part: int = PART) -> DataFrame:
    """Of each row: doc_id, n_words, n_removed, longest (the greatest of 13, 26, 52... words at which a window of the row
    is also elsewhere; 0: none), spans (start and number of the removed words) and kept (the words left, joined by one
    space). A word is removed if one of the 13-word windows that cover it also starts in a row with a smaller doc_id;
    windows are judged on the input.

    Null text: no words. Fewer than 13 words: nothing removed. A null doc_id comes after all others. Rows with equal ids
    don't remove each other's words. Empty table: no rows. Other columns are ignored. Windows are compared by 64-bit
    hashes of their words' 64-bit hashes."""
    spark: SparkSession = docs.sparkSession
    bundles, buckets = written_bundles(docs)
    total = bundles.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    columns = ["bundle", "ids", "sizes", "codes", "words"]

    def level(rows: DataFrame, length: int, share: float) -> DataFrame:
        """share: of all words, so many hashes are asked at most."""
        parts = max(1, -(-int(total * share) // part))
        asks = rows.mapInArrow(tidy(Step(length, parts)), ASKS)
        out = scratch(spark, "notes")
        asks.repartitionById(parts, F.col("place")).groupBy("place", "part").applyInArrow(_answer, ANSWERS).write.parquet(out)
        del asks, rows  # the last references to what was shuffled
        free_shuffles(spark)
        return spark.read.schema(ANSWERS).parquet(out)

    def with_notes(notes: DataFrame, how: str = "inner") -> DataFrame:
        by = notes.repartition(buckets, "bundle").groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("notes"))
        return bundles.join(by, "bundle", how)

    def asked(notes: DataFrame) -> int:
        return notes.filter("part >= 0").agg(F.coalesce(F.sum(F.octet_length("bits") - 8), F.lit(0))).first()[0] * 8

    notes = level(bundles.select(*columns), 0, 0.3)
    first = notes = level(with_notes(notes).select(*columns, "notes"), WINDOW, 1.0)
    seen, length, open_ = [], WINDOW, asked(notes) / 2
    while open_:
        goes_on = notes.filter("part >= 0").select("bundle").distinct()
        length *= 2
        notes = level(with_notes(notes.join(goes_on, "bundle", "left_semi")).select(*columns, "notes"), length, open_ / max(1, total))
        seen.append(notes.filter("part < 0"))
        open_ = asked(notes)
    levels = spark.createDataFrame([], "bundle bigint, levels binary")
    if seen:
        own = seen[0]
        for x in seen[1:]:
            own = own.union(x)
        sizes = bundles.select("bundle", (F.octet_length("ids") / 8).cast("int").alias("n"))
        levels = own.repartition(buckets, "bundle").groupBy("bundle").agg(F.collect_list("bits").alias("own")).join(sizes, "bundle").select("bundle", "n", "own").mapInArrow(tidy(_levels), "bundle bigint, levels binary")
    rows = with_notes(first, "left").join(levels, "bundle", "left")
    return rows.select(*columns, "nulls", "notes", "levels").mapInArrow(tidy(_finish), RESULT)
