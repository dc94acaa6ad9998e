"""Near-duplicate documents by SimHash, linked through pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import chunks, tidy, words, written
from seiche.llm.components import components, forest

#: The ring: eight segments of eight bits. Budget of the first l segments of a chain, of 3 bits in all: floor(3 l / 8).
SEGMENTS, BITS, RADIUS = 8, 8, 3
BUDGET = [RADIUS * n // SEGMENTS for n in range(1, SEGMENTS + 1)]
#: Words in a shingle where no contract says otherwise.
PRODUCTION_SHINGLE = 5
#: Of the segments 3 to 5 of a chain, which may differ by one bit in all, one is left out of the key.
LEFT_OUT = (2, 3, 4)
#: The most fingerprints compared with each other at a time; larger buckets are cut into blocks of this size, pair by pair.
BLOCK = 1024


def shingle_hashes(text: bytes, size: int) -> list[int]:
    w = words(text.lower())
    if not w:
        return []
    if len(w) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(w), 42)]
    buf = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h = xxhash.xxh64_intdigest
    return [h(buf[a:b], 42) for a, b in zip(starts[: len(w) - size + 1].tolist(), ends[size - 1 :].tolist())]


def fingerprints_of(texts: list[bytes], size: int = 3) -> np.ndarray:
    """SimHash of each text (uint64). Words are runs of non-space, A-Z lower-cased; shingles count as often as they occur;
    a bit is 1 if it is 1 in over half the shingle hashes; no words: 0."""
    each = [shingle_hashes(t, size) for t in texts]
    n = np.array([len(x) for x in each])
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        h = np.fromiter(chain.from_iterable(each), np.uint64, int(n.sum()))
        starts = np.concatenate(([0], np.cumsum(n[full])[:-1]))
        ones = np.zeros((len(full), 64), np.int64)
        step = 1 << 16  # one very long text must not be unpacked at once
        for a in range(0, len(h), step):
            bits = np.unpackbits(h[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = int(np.searchsorted(starts, a, "right")) - 1
            last = int(np.searchsorted(starts, a + len(bits), "left"))
            cuts = np.maximum(starts[first:last] - a, 0)
            ones[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp bigint) of each row of docs; fp has the fingerprint's 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            yield pa.record_batch([part.column(0), pa.array(fingerprints_of(texts, size).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), "doc_id bigint, fp bigint")


def _segment(k: int) -> Column:
    return F.shiftrightunsigned("fp", BITS * (k % SEGMENTS)).bitwiseAND(255)


def keys() -> Column:
    """The keys of column fp. Two fingerprints within the radius share one: by the pigeonring principle some chain of
    consecutive segments, starting at segment r of the ring, keeps every prefix within its budget; the first two
    segments of that chain are equal (budget 0) and of the next three at least two are (budget 1)."""
    out = []
    for r in range(SEGMENTS):
        for i, skipped in enumerate(LEFT_OUT):
            bits = F.lit(r * len(LEFT_OUT) + i).cast("bigint")
            for k in (0, 1, *(x for x in LEFT_OUT if x != skipped)):
                bits = F.shiftleft(bits, BITS).bitwiseOR(_segment(r + k))
            out.append(bits)
    return F.array(*out)


def chain_holds(diff: np.ndarray, r: int) -> np.ndarray:
    """For XORs of two fingerprints: does every prefix of the chain that starts at segment r stay within its budget? The
    last prefix is the whole ring, the full Hamming check; shorter ones prune."""
    ok, total = np.ones(diff.shape, bool), np.zeros(diff.shape, np.uint8)
    for k, most in enumerate(BUDGET):
        total += np.bitwise_count((diff >> np.uint64(BITS * ((r + k) % SEGMENTS))) & np.uint64(255))
        ok &= total <= most
        if not ok.any():
            break
    return ok


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket (key, fps), the links as a forest: no link is lost, and a bucket gives no more rows than it has."""
    for batch in batches:
        us: list[int] = []
        vs: list[int] = []
        for key, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f = np.array(members, np.int64).view(np.uint64)
            i, j = np.nonzero(np.triu(chain_holds(f[:, None] ^ f[None, :], (key >> 32) // len(LEFT_OUT)), 1))
            if len(i):
                for u, v in forest(zip(f.view(np.int64)[i].tolist(), f.view(np.int64)[j].tolist())):
                    us.append(u)
                    vs.append(v)
        yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints (column fp) whose components are those of all pairs within the radius.

    Buckets of one are dropped by their count. A bucket of n > block fingerprints is cut into g = n / block blocks, and
    each pair of blocks is compared on its own, so a task holds 2 * block fingerprints at most, however hot the key."""
    sig = distinct.select("fp", F.explode(keys()).alias("key"))
    counts = sig.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = sig.join(counts, "key").withColumn("g", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("fp"), "g").cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    buckets = rows.groupBy("key", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j")).agg(F.collect_set("fp").alias("fps"))
    return buckets.select("key", "fps").mapInArrow(tidy(_links), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp bigint, component_id): documents whose fingerprints differ in three bits at most are linked;
    component_id is the smallest doc_id reachable, the document's own included.

    Null text: like no words, fingerprint zero. Documents without words are linked like any others. Equal texts, ties:
    one fingerprint, one component. A null doc_id keeps its row; it counts as no id in the minimum. Empty table: no rows.
    Other columns of docs are ignored."""
    fps = written(fingerprints(docs, size), "fp")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = components(links(distinct.select("fp")))
    of = found.join(distinct, F.col("node") == F.col("fp")).select("fp", "label", "rep")
    least = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = written(of.join(least, "label").select("fp", "component_id"), "linked")
    alone = distinct.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("rep").alias("component_id"))
    return fps.join(linked.union(alone), "fp").select("doc_id", "fp", "component_id")
