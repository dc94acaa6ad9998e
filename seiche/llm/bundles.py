"""Bundles: rows packed a megabyte or two at a time, their words as numbers into a dictionary of the bundle's own.

What is asked about the words of all documents (which windows repeat, how often a pair of words occurs) moves as one
sorted array of distinct 64-bit hashes for each bundle and part of the hash space, and is answered in the same order. So a
key in every document is one entry for each bundle, and a pass over a bundle is array arithmetic, without a step of Python
for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.llm.common import scratch, tidy

#: Bytes of text in a bundle, and in a bucket of the table of bundles.
BUNDLE, BUCKET = 2 << 20, 32 << 20
NULL = np.iinfo(np.int64).max  # a null doc_id comes after the others

SCHEMA = "bundle bigint, ids binary, nulls binary, sizes binary, codes binary, words binary, n_words bigint"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def gathered(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about most_bytes of text, one row at least."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        at = 0
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)).tolist()
        for i, s in enumerate(sizes):
            if total and total + s > most_bytes:
                held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total, at = [], 0, i
            total += s
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encoded(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Texts (null: empty) as the number of words of each, the distinct words, and each word's number among them."""
    texts = texts.cast(pa.string()).fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = lists.flatten().dictionary_encode()
    codes = np.asarray(words.indices, np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    empty = pc.index(words.dictionary, "").as_py()  # beside white space at an end of a text
    if empty >= 0:
        rows, codes = rows[codes != empty], codes[codes != empty]
    return np.bincount(rows, minlength=len(texts)), words.dictionary, codes


def _rotated(x: np.ndarray, k: int) -> np.ndarray:
    return x << np.uint32(k) | x >> np.uint32(32 - k)


def spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's hash of bigints, which deals rows into buckets: Murmur3 of the low and the high half, seed 42."""
    u = np.ascontiguousarray(values, np.int64).view(np.uint64)
    h = np.full(len(u), 42, np.uint32)
    for half in (u.astype(np.uint32), (u >> np.uint64(32)).astype(np.uint32)):
        h ^= _rotated(half * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = _rotated(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32)


def name_in(bucket: int, buckets: int, place: int, k: int) -> int:
    """A number for bundle k of task `place`, no other bundle's, that Spark deals into this bucket."""
    first, step = place << 40 | k << 20, min(1 << 20, 4 * buckets + 64)
    for salt in range(0, 1 << 20, step):
        names = np.arange(first + salt, first + salt + step)
        if len(fit := np.flatnonzero(spark_hash(names) % buckets == bucket)):
            return int(names[fit[0]])
    return first


def _planes(codes: np.ndarray) -> bytes:
    """Numbers byte by byte: where small ones are frequent, the high bytes are mostly zero."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def packed(buckets: int, lower: bool = False, most_bytes: int = BUNDLE):
    """For mapInArrow over (doc_id, text): bundles of rows, ordered by id inside; words are numbered by how frequent they
    are. All bundles of a task go to one bucket, so it writes one file, and nothing moves. A bundle's number comes from its
    task and its place there, so a task that runs again makes the same ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=1).compress
        for k, part in enumerate(gathered(batches, "text", most_bytes)):
            own = part.column(0)
            ids = np.asarray(own.fill_null(NULL), np.int64)
            order = np.argsort(ids, kind="stable")
            nulls = np.asarray(own.is_null())
            n, words, codes = encoded(part.column(1).take(pa.array(order)), lower)
            often = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[often] = np.arange(len(words))
            raw = words.take(pa.array(often)).cast(pa.binary()).to_pylist()
            row = [name_in(place % buckets, buckets, place, k), ids[order].tobytes(), np.packbits(nulls[order]).tobytes(), n.astype(np.int32).tobytes(), pack(_planes(rank[codes])), pack(b" ".join(x for x in raw if x)), len(codes)]
            yield pa.record_batch([pa.array([x], pa.int64() if i in (0, 6) else pa.binary()) for i, x in enumerate(row)], NAMES)

    return tidy(run)


class Bundle:
    """ids: of the rows. sizes: their numbers of words. codes: of all words. hashes: of the dictionary."""

    def __init__(self, row: dict):
        self.name = row["bundle"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        raw = words_of(row)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in raw), np.uint64, len(raw))
        planes = np.frombuffer(zstandard.decompress(row["codes"]), np.uint8).reshape(4, -1)
        self.codes = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
        self.ends = np.cumsum(self.sizes)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the words of these rows are among all words."""
        n = self.sizes[rows]
        first = np.cumsum(n) - n
        return np.arange(int(n.sum())) + np.repeat(self.ends[rows] - n - first, n)


def nulls_of(row: dict) -> np.ndarray:
    n = len(row["ids"]) // 8
    return np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=n).astype(bool)


def words_of(row: dict) -> list[bytes]:
    body = zstandard.decompress(row["words"])
    return body.split(b" ") if body else []


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One at a time: a bundle is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def distinct(h: np.ndarray, row: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order; where each begins among the sorted ones; for each hash its place among the distinct ones;
    the least and the greatest row of each (of no rows: empty)."""
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    back = np.empty(len(s), np.int64)
    back[order] = np.cumsum(new) - 1
    none = np.empty(0, np.int64)
    if row is None or not len(s):
        return s[starts], starts, back, none, none
    r = row[order]
    return s[starts], starts, back, np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)


def cuts(sorted_hashes: np.ndarray, parts: int) -> list[int]:
    """Where each part of the hash space begins, and the end."""
    bounds = np.array([(k << 64) // parts for k in range(parts)], np.uint64)
    return [*np.searchsorted(sorted_hashes, bounds).tolist(), len(sorted_hashes)]


def written_bundles(docs: DataFrame, lower: bool = False) -> tuple[DataFrame, int]:
    """docs (doc_id, text) as a table of bundles in the shared folder, and its number of buckets, which follows the bytes
    of text. Answers that are dealt by bundle over as many partitions join it without moving it."""
    spark: SparkSession = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count("*") * 8).first()[0]
    buckets = max(1, -(-size // BUCKET))
    path = scratch(spark, "bundles")
    name = "seiche_" + path.rpartition("-")[2]
    src.mapInArrow(packed(buckets, lower), SCHEMA).write.bucketBy(buckets, "bundle").option("path", path).option("compression", "none").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalogue's entry; the files stay until the application ends
    return out, buckets
