"""Near-duplicate documents by SimHash and pigeonring filtering, decided by the sets of word shingles: the pipeline's near-dedup.

Similarity is the Jaccard index of the distinct shingles. At a similarity of 0.8 each bit of two SimHashes differs with
probability acos(8/9) / pi = 0.15 or less, ten bits of 64, which no key over 64 bits finds without finding much else. So
the fingerprint has 864 bits, a ring of 72 segments of 12. Two documents are candidates if a chain of segments starts with
an equal one and keeps every prefix within its budget; that is certain below 72 differing bits, and beyond that likely
(README: measured). Candidates are linked to families, and within a family the sets themselves decide about each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import Hashes, chunks, free_shuffles, mixed, rolled, tidy, words, written
from seiche.llm.components import components, forest

#: Words in a shingle; the least similarity.
SHINGLE, SIMILARITY = 5, 0.8
#: The ring: segments and bits of each; its radius; segments of a chain, the first equal and the others in two words.
SEGMENTS, BITS, RADIUS, CHAIN = 72, 12, 207, 11
HALF = (CHAIN - 1) // 2
#: Sets of up to SHORT shingles have RINGS fingerprints: few shingles leave more bits to chance (4 of 5: 0.19 of them).
SHORT, RINGS = 40, 2
#: Budget of the first l segments of a chain.
BUDGET = [RADIUS * n // SEGMENTS for n in range(1, CHAIN + 1)]
#: The most members of a family, and about the most shingles, in a block; larger families are compared pair by pair of
#: blocks, and so are buckets of more fingerprints than WIDE blocks have members.
BLOCK, MOST, WIDE = 1024, 1 << 18, 16
#: Buckets of more members have some compared with all first; about the most comparisons, and rows of buckets, at a time.
LARGE, CELLS, READ = 256, 1 << 18, 1 << 16
_draw = np.random.default_rng(5)
XORS = _draw.integers(0, 1 << 63, (RINGS, -(-SEGMENTS * BITS // 64)), np.uint64)
FACTORS = _draw.integers(0, 1 << 63, (RINGS, -(-SEGMENTS * BITS // 64)), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, of: Hashes, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, sorted hashes. Words are runs of non-space, A-Z lower-cased; a text of fewer words
    has one shingle of them all."""
    w = words(text.lower())
    if not w:
        return np.empty(0, np.uint64)
    return np.unique(mixed(rolled(np.fromiter(map(of.__getitem__, w), np.uint64, len(w)), min(size, len(w))) + np.uint64(min(size, len(w)))))


def rings(sets: list[np.ndarray], turn: int = 0) -> np.ndarray:
    """The SimHash of each set, not empty, of SEGMENTS * BITS bits (sets x bytes): a bit is 1 if it is 1 in over half of
    the shingles' hashes, which each turn draws anew. Eight bits of a hash at a time are counted in the bytes of a word, of
    255 shingles at most."""
    h = np.concatenate(sets)
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    pieces = -(-n // 255)
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(np.cumsum(n) - n, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    out = np.empty((len(sets), XORS.shape[1], 8, 8), bool)
    for k in range(XORS.shape[1]):
        x = mixed((h ^ XORS[turn, k]) * FACTORS[turn, k])
        for bit in range(8):
            counts = np.add.reduceat((x >> np.uint64(bit)) & np.uint64(0x0101010101010101), cuts)
            out[:, k, bit] = 2 * np.add.reduceat(counts.view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64) > n[:, None]
    return np.packbits(out.reshape(len(sets), -1)[:, : SEGMENTS * BITS], axis=1)


def chains(ring: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each ring (rings x bytes) and each segment (rings x SEGMENTS): the segment's bucket, and the chain that follows it
    as two words."""
    bits = np.unpackbits(ring, axis=1).reshape(len(ring), SEGMENTS, BITS)
    value = bits.astype(np.int64) @ (1 << np.arange(BITS, dtype=np.int64))
    words_ = [sum(np.roll(value, -(1 + half * HALF + k), axis=1) << (BITS * k) for k in range(HALF)) for half in (0, 1)]
    return (np.arange(SEGMENTS) << BITS) + value, words_[0], words_[1]


def chain_holds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For XORs of two chains whose first segments are equal: does every prefix stay within its budget?"""
    ok, total = np.ones(a.shape, bool), np.zeros(a.shape, np.int64)
    for k in range(CHAIN - 1):
        total += np.bitwise_count(((a, b)[k // HALF] >> (BITS * (k % HALF))) & ((1 << BITS) - 1))
        ok &= total <= BUDGET[k + 1]
    return ok


def _grouped(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each member of a bucket, the first member of its component by chains that hold. In a large bucket some members
    are compared with all first; what they link is a component, and pairs within the largest need no comparison."""
    of = np.arange(len(a))

    def link(rows: np.ndarray, others: np.ndarray) -> None:
        x, y = np.nonzero(np.bitwise_count(a[rows, None] ^ a[others][None, :]) <= BUDGET[HALF])
        i, j = rows[x], others[y]
        new = of[i] != of[j]
        i, j = i[new], j[new]
        ok = chain_holds(a[i] ^ a[j], b[i] ^ b[j])
        if ok.any():
            to = np.arange(len(a))
            for x, root in forest(np.unique(np.stack([of[i[ok]], of[j[ok]]], 1), axis=0).tolist()):
                to[x] = root
            of[:] = to[of]

    n, order = len(a), np.arange(len(a))
    if n > LARGE:
        for k in range(8):
            alone = np.flatnonzero(of == np.arange(len(a)))
            link(alone[[k * len(alone) // 8]], order)
        labels, count = np.unique(of, return_counts=True)
        largest = of == labels[np.argmax(count)]
        n, order = len(a) - int(largest.sum()), np.argsort(largest, kind="stable")
    step = max(1, CELLS // len(a))
    for k in range(0, n, step):
        link(order[k : min(k + step, n)], order[k:])
    return of


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both / (len(a) + len(b) - both)


def linked(label: np.ndarray, sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """The pairs (places) of sets of different labels that have the similarity. One of each such pair is outside the most
    frequent label, and only those sets are compared with all others."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(n) - n
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    labels, of, count = np.unique(label, return_inverse=True, return_counts=True)
    mark = np.zeros(len(values), np.int64)
    for k in np.flatnonzero(of != np.argmax(count)).tolist():
        own = ids[starts[k] : starts[k] + n[k]]
        mark[own] = 1
        both = np.add.reduceat(mark[ids], starts)
        mark[own] = 0
        for j in np.flatnonzero((both >= least * (n + n[k] - both)) & (of != of[k])).tolist():
            yield k, j


def _key(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), 9) - (1 << 63)


def _sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, key: of the set, n: shingles, rings: the fingerprints) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Hashes()
        for part, texts in chunks(batches, "text"):
            sets = [shingles(t, of, size) for t in texts]
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            each: list[list[bytes]] = [[] for _ in sets]
            for turn in range(RINGS):
                some = np.flatnonzero((n > 0) & ((n <= SHORT) | (turn == 0))).tolist()
                for k, ring in zip(some, rings([sets[k] for k in some], turn) if some else ()):
                    each[k].append(ring.tobytes())
            yield pa.record_batch([part.column(0), part.column(1), pa.array(list(map(_key, sets)), pa.int64()), pa.array(n), pa.array(each, pa.list_(pa.binary()))], ["doc_id", "text_hash", "key", "n", "rings"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(tidy(run), "doc_id bigint, text_hash bigint, key bigint, n bigint, rings array<binary>")


def _buckets(turn: pa.Array, ring: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bucket, a, b = chains(np.frombuffer(b"".join(ring.to_pylist()), np.uint8).reshape(len(ring), -1))
    return bucket + (np.asarray(turn, np.int64)[:, None] * SEGMENTS << BITS), a, b


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, members) of a task's rings (turn, ring)."""
    total = np.zeros(RINGS * SEGMENTS << BITS, np.int64)
    for x in batches:
        total += np.bincount(_buckets(x.column(0), x.column(1))[0].ravel(), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "members"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, bucket, a, b) of each chain of each ring (key, turn, ring)."""
    for x in batches:
        each = _buckets(x.column(1), x.column(2))
        yield pa.record_batch([pa.array(np.repeat(np.asarray(x.column(0)), SEGMENTS)), *(pa.array(c.ravel()) for c in each)], ["key", "bucket", "a", "b"])


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (part, key, a, b) sorted by part, the links between members of a part, as a forest."""

    def links(x: pa.Table, whole: int) -> pa.RecordBatch:
        part, key, a, b = (np.asarray(x.column(k))[:whole] for k in range(4))
        ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) + 1
        pairs: list[tuple[int, int]] = []
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
            if end - start > 1:
                of = _grouped(a[start:end], b[start:end])
                far = np.flatnonzero(of != np.arange(len(of)))
                if len(far):
                    pairs += zip(key[start + far].tolist(), key[start + of[far]].tolist())
        found = forest(pairs)
        return pa.record_batch([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["u", "v"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= READ and np.asarray(held[0].column(0))[0] != np.asarray(batch.column(0))[-1]:
            x = pa.Table.from_batches(held)
            part = np.asarray(x.column(0))
            whole = int(np.searchsorted(part, part[-1]))
            yield links(x, whole)
            held = x.slice(whole).combine_chunks().to_batches()
            rows -= whole
    if rows:
        yield links(pa.Table.from_batches(held), rows)


def _candidates(distinct: DataFrame, most: int) -> DataFrame:
    """Edges (u, v) between the keys of `distinct` (key, rings) whose components are those of all pairs that share a bucket
    and whose chains from there hold. A bucket of more than `most` is cut, and each pair of its blocks compared on its own."""
    rings_ = distinct.select("key", F.posexplode("rings").alias("turn", "ring"))
    spread = rings_.mapInArrow(tidy(_spread), "key bigint, bucket bigint, a bigint, b bigint")
    part = F.shiftleft("bucket", 40)
    if distinct.count() > most:
        counts = rings_.select("turn", "ring").mapInArrow(tidy(_counted), "bucket bigint, members bigint").groupBy("bucket").agg(F.sum("members").alias("members"))
        large = written(counts.filter(F.col("members") > most).select("bucket", F.ceil(F.col("members") / most).cast("int").alias("g")), "large")
        spread = spread.join(F.broadcast(large), "bucket", "left").withColumn("g", F.coalesce("g", F.lit(1)))
        spread = spread.withColumn("p", F.pmod(F.xxhash64("key"), "g").cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        part = part + F.shiftleft(F.least("p", "x").cast("bigint"), 20) + F.greatest("p", "x")
    rows = spread.select(part.alias("part"), "key", "a", "b").repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(tidy(_bucketed), "u bigint, v bigint").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, shingles) of the rows of docs that `wanted` (key, rep, text_hash) names. Only these texts are read again as sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Hashes()
        for part, texts in chunks(batches, "text"):
            yield pa.record_batch([part.column(0), pa.array([shingles(t, of, size).tobytes() for t in texts], pa.binary())], ["key", "shingles"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("text_hash")))
    return rows.select("key", "text").mapInArrow(tidy(run), "key bigint, shingles binary").dropDuplicates(["key"])


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (u, v) of keys whose sets have the similarity."""
    both = pairs.join(sets.select(F.col("key").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("key").alias("v"), F.col("shingles").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            a, b = ([np.frombuffer(s.as_buffer(), np.uint64) for s in x.column(k)] for k in (2, 3))
            yield x.select(["u", "v"]).filter(pa.array([similarity(s, t) >= least for s, t in zip(a, b)], pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(tidy(run), "u bigint, v bigint")


def _across(least: float):
    """Of each part of a family, the links between members of different components, as a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            us: list[int] = []
            vs: list[int] = []
            for members in x.column(0):
                m = members.values
                key, label = m.field("key").to_pylist(), np.asarray(m.field("label"))
                if (label == label[0]).all():
                    continue
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in m.field("shingles")]
                for u, v in forest((key[i], key[j]) for i, j in linked(label, sets, least)):
                    us.append(u)
                    vs.append(v)
            yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def near_duplicates(docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash: xxhash64 of the text, component: a number of it, component_id): documents whose sets of shingles have a similarity of `least` or more are linked;
    component_id is the smallest doc_id reachable, the document's own included.

    Equal sets are one node. Nodes with fingerprints whose chains hold are linked to families; all pairs of the similarity
    that share a chain are within one. First each node is compared with one of its neighbours (the smallest key); what that
    links is a component, and then only members of different components are compared, in the family's tasks, which gives
    the same components as all pairs do, without a row for each pair of a large group of copies. Null text: like no words.
    Documents without words are linked with each other. A null doc_id keeps its row; it counts as no id in the minimum.
    Empty table: no rows."""
    rows = written(_sketched(docs, size), "sketched")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash"))
    distinct = rows.groupBy("key").agg(rep.alias("rep"), F.first("n").alias("n"), F.first("rings").alias("rings"))
    distinct = written(distinct.select("key", "rep.doc_id", "rep.text_hash", "n", "rings").withColumnRenamed("doc_id", "rep"), "distinct")
    near = written(_candidates(distinct, WIDE * block), "candidates")
    free_shuffles(docs.sparkSession)
    family = components(near).select(F.col("node").alias("key"), F.col("label").alias("family"))
    found = written(family.join(distinct.select("key", "rep", "text_hash", "n"), "key"), "families")
    sets = written(_sets(docs, found.select("key", "rep", "text_hash"), size), "sets")
    free_shuffles(docs.sparkSession)
    tried = written(near.groupBy("u").agg(F.min("v").alias("v")), "tried")
    first = written(_verified(tried, sets, least), "links")
    label = components(first).select(F.col("node").alias("key"), "label")
    labelled = written(found.select("key", "family", "n").join(label, "key", "left").withColumn("label", F.coalesce("label", "key")), "labelled")
    open_ = labelled.groupBy("family").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.sum("n").alias("size"), F.count("*").alias("members")).filter("a != b").select("family", "size", "members")
    cut = labelled.join(open_, "family").withColumn("g", F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("size") / MOST)).cast("int"))
    cut = cut.withColumn("p", F.pmod(F.xxhash64("key"), "g").cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cut = cut.select("key", "label", "family", F.least("p", "x").alias("i"), F.greatest("p", "x").alias("j")).join(sets, "key")
    parts = cut.groupBy("family", "i", "j").agg(F.collect_list(F.struct("key", "label", "shingles")).alias("members"))
    links = written(first.union(parts.select("members").mapInArrow(tidy(_across(least)), "u bigint, v bigint").distinct()), "links")
    of = components(links).join(distinct.select("key", "rep"), F.col("node") == F.col("key")).select("key", "label", "rep")
    near = written(of.join(of.groupBy("label").agg(F.min("rep").alias("component_id")), "label").select("key", F.col("label").alias("component"), "component_id"), "linked")
    alone = distinct.join(near.select("key"), "key", "left_anti").select("key", F.col("key").alias("component"), F.col("rep").alias("component_id"))
    return rows.select("doc_id", "text_hash", "key").join(near.union(alone), "key").select("doc_id", "text_hash", "component", "component_id")
