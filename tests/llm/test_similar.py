"""Near-dedup by shingle similarity, against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from seiche.llm import similar
from seiche.llm.common import mixed
from seiche.llm.components import components

from .test_operators import SCHEMA, words_of


def brute(rows, least):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sets:
            if label[i] != label[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label.update({k: a for k, v in label.items() if v == b})
    return label


def edited(r, w, n):
    w = list(w)
    for p in r.sample(range(len(w)), n):
        w[p] = words_of(r, 1) + "x"
    return " ".join(w)


def rows_of(r):
    rows = []
    for size, changed in ((100, 1), (300, 1), (500, 3), (200, 3), (100, 2), (200, 6), (4, 0), (60, 0)):
        for _ in range(12):
            w = words_of(r, size).split()
            rows += [" ".join(w), edited(r, w, changed), edited(r, w, changed)]
    base = words_of(r, 120).split()
    rows += [edited(r, base, r.randint(1, 4)) for _ in range(60)]
    return [(i, t) for i, t in enumerate([*rows, None, "", " "])]


def test_all_pairs_of_the_similarity_are_found(spark):
    rows = rows_of(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, similar.SIMILARITY)
    for block in (similar.BLOCK, 8):
        got = {x["doc_id"]: x["component_id"] for x in similar.near_duplicates(docs, block=block).collect()}
        assert got == want
    assert similar.near_duplicates(docs.limit(0)).count() == 0


def test_edited_copies_leave_the_pipeline(spark):
    r = random.Random(4)
    rows = []
    for k in range(40):
        w = words_of(r, 100).split()
        rows += [(2 * k, " ".join(w), "en", "s", 1), (2 * k + 1, edited(r, w, 1), "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = {x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert left == set(range(0, 80, 2))


def simhash_bits(s):
    x = [mixed((s ^ similar.XORS[0, k]) * similar.FACTORS[0, k]) for k in range(similar.XORS.shape[1])]
    ones = [int(((v >> np.uint64(8 * byte + bit)) & np.uint64(1)).sum()) for v in x for bit in range(8) for byte in range(8)]
    return [2 * n > len(s) for n in ones][: similar.SEGMENTS * similar.BITS]


def test_fingerprints_are_simhashes():
    r = np.random.default_rng(1)
    sets = [r.integers(0, 1 << 63, n, np.uint64) for n in (1, 2, 5, 254, 255, 256, 1000)]
    got = np.unpackbits(similar.rings(sets), axis=1).astype(bool)
    assert got.tolist() == [simhash_bits(s) for s in sets]


def chain(x, y):
    """Of two rings of bits: does a chain from an equal segment keep all its prefixes within the budget?"""
    diff = (x != y).reshape(similar.SEGMENTS, similar.BITS).sum(1).tolist() * 2
    prefixes = lambda r: [sum(diff[r : r + n + 1]) for n in range(similar.CHAIN)]
    return any(diff[r] == 0 and all(t <= similar.RADIUS * (n + 1) // similar.SEGMENTS for n, t in enumerate(prefixes(r))) for r in range(similar.SEGMENTS))


@pytest.mark.parametrize("most", [1 << 20, 4])
def test_candidates_are_the_pigeonring_ones(spark, most):
    """Whether buckets are cut or not."""
    r = np.random.default_rng(2)
    rings = []
    for k in range(60):
        bits = r.integers(0, 2, similar.SEGMENTS * similar.BITS).astype(bool) if k % 12 == 0 else rings[-1].copy()
        if k % 12:
            bits[r.permutation(len(bits))[: r.integers(0, 300)]] ^= True
        rings.append(bits)
    rows = [(k, [np.packbits(x).tobytes()]) for k, x in enumerate(rings)]
    near = similar._candidates(spark.createDataFrame([*rows, (99, [])], "key bigint, rings array<binary>"), most)
    want = list(range(60))
    for i in range(60):
        for j in range(i):
            if want[i] != want[j] and chain(rings[i], rings[j]):
                a, b = sorted((want[i], want[j]))
                want = [a if x == b else x for x in want]
    got = {x["node"]: x["label"] for x in components(near).collect()}
    assert [got.get(k, k) for k in range(60)] == want and 5 < len(set(want)) < 60


@pytest.mark.parametrize("size", [5, 700])
def test_groups_of_a_bucket(size):
    """Large buckets, whose largest component isn't compared within, have the components of all pairs."""
    r = np.random.default_rng(size)
    for _ in range(5):
        bases = r.integers(0, 1 << 60, (4, 2))
        rows = bases[r.integers(0, 4, size)]
        for row in rows:
            for _ in range(r.integers(0, 40)):
                row[r.integers(2)] ^= 1 << int(r.integers(60))
        a, b = rows[:, 0].copy(), rows[:, 1].copy()
        near = similar.chain_holds(a[:, None] ^ a, b[:, None] ^ b)
        label, last = np.arange(size), None
        while last is None or (label != last).any():
            last, label = label, np.where(near, label, size).min(1)
        assert similar._grouped(a, b).tolist() == label.tolist()


@pytest.mark.parametrize("common, left, right", [(4, 1, 0), (12, 2, 1), (40, 5, 5), (160, 20, 20)])
def test_pairs_of_the_least_similarity_are_candidates(common, left, right):
    """At most 2 of 2,000 pairs are missed."""
    r = np.random.default_rng(common)
    h = [r.integers(0, 1 << 63, common + left + right, np.uint64) for _ in range(2000)]
    sides = [x[: common + left] for x in h], [np.concatenate((x[:common], x[common + left :])) for x in h]
    found = np.zeros(2000, bool)
    for turn in range(similar.RINGS if common + left <= similar.SHORT else 1):
        (k, a, b), (m, c, d) = (similar.chains(similar.rings(s, turn)) for s in sides)
        found |= ((k == m) & similar.chain_holds(a ^ c, b ^ d)).any(1)
    assert found.sum() >= 1998
