"""Kneser-Ney models against their definition, letter by letter, and a score recomputed from the texts."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from seiche.llm import toxicity
from seiche.llm.toxicity import DISCOUNT, ORDER

PAD = "^" * (ORDER - 1)


class Brute:
    """P(letter | context, class) from counts of grams, by recursion over contexts."""

    def __init__(self, grams, letters):
        self.own = [Counter({g: n[y] for g, n in grams.items() if n[y]}) for y in (0, 1)]
        self.letters = [*letters, "$", "\0"]
        self.types = {ORDER: {g for g, n in grams.items() if sum(n)}}
        for k in range(ORDER - 1, 0, -1):
            self.types[k] = {g[1:] for g in self.types[k + 1]}

    def shared(self, context, c):
        """By the continuation counts of contexts shorter than a model's own."""
        size = len(context) + 1
        n = Counter(g[1:] for g in self.types[size + 1])
        after = {g: m for g, m in n.items() if g[:-1] == context}
        lower = 1 / len(self.letters) if size == 1 else self.shared(context[1:], c)
        if not after:
            return lower
        total = sum(after.values())
        return (max(after.get(context + c, 0) - DISCOUNT, 0) + sum(min(m, DISCOUNT) for m in after.values()) * lower) / total

    def p(self, y, context, c):
        after = {g: m for g, m in self.own[y].items() if g[:-1] == context}
        lower = self.shared(context[1:], c)
        if not after:
            return lower
        total = sum(after.values())
        return (max(after.get(context + c, 0) - DISCOUNT, 0) + sum(min(m, DISCOUNT) for m in after.values()) * lower) / total


@pytest.fixture(scope="module")
def counted():
    r = random.Random(3)
    grams = {}
    for y in (0, 1):
        for _ in range(60):
            w = "".join(r.choice("abcd"[: 3 + y]) for _ in range(r.randint(1, 6)))
            s = PAD + w + "$"
            for k in range(len(w) + 1):
                n = grams.setdefault(s[k : k + ORDER], [0, 0])
                n[y] += r.choice((1, 1, 2, 5))
    return grams


def ratios(grams):
    g = sorted(grams)
    return toxicity.models(pa.table([pa.array(g), pa.array([grams[x][0] for x in g]), pa.array([grams[x][1] for x in g]), pa.array([0] * len(g)), pa.array([0] * len(g))], list("gabcd")))[0]


def test_probabilities_sum_to_one(counted):
    b = Brute(counted, "abcd")
    for y in (0, 1):
        for context in ["^^^", "^^a", "abc", "dab", "ddd", "zzz"]:
            assert sum(b.p(y, context[-(ORDER - 1) :], c) for c in b.letters) == pytest.approx(1)


def test_ratios_are_differences_of_two_log_likelihoods(counted):
    b, r = Brute(counted, "abcd"), ratios(counted)
    words = ["a", "abc", "dddd", "cabbage", "zz", "bd", "abcdabcdabcd" * 50]
    shown = lambda c: c if c in "abcd$^" else "\0"
    for w, got in zip(words, r.of(words)):
        s = "".join(map(shown, PAD + w + "$"))
        want = sum(math.log(b.p(1, s[k : k + ORDER - 1], s[k + ORDER - 1]) / b.p(0, s[k : k + ORDER - 1], s[k + ORDER - 1])) for k in range(len(w) + 1))
        assert got == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert r.of([]).tolist() == [] and ratios({}).of(["ab"]).tolist() == [0.0]


def test_letters_beyond_the_alphabet_fall_together():
    a = toxicity.Alphabet("".join(map(chr, range(0x4E00, 0x4E00 + 5000))))
    assert a.numbers("\u4e00")[0] == 4 and a.numbers(chr(0x4E00 + 4999))[0] == toxicity.OTHER and a.outcomes == (1 << toxicity.BITS) - 2
    assert a.numbers("^$").tolist() == [toxicity.START, toxicity.END]


def test_evidence_is_normalised_by_length(counted):
    scores = toxicity.WordScores(ratios(counted))
    words = ["ab", "dcd", "a", "12", "!?", "dd,"]
    v = [scores.ratios.of([w])[0] for w in ("ab", "dcd", "a", "dd")]
    (mean, top), none, repeated, long_ = toxicity.evidence([" ".join(words).encode(), b" 1 !\n", " ".join(words * 40).encode(), b"ab " * 500_000], scores)
    assert mean == pytest.approx(np.mean(v), rel=1e-5) and top == pytest.approx(max(v), rel=1e-5) and none == (0.0, 0.0)
    assert repeated[0] == pytest.approx(mean) and repeated[1] == pytest.approx(np.mean(sorted([*v] * 40)[-3:]), rel=1e-5)
    assert long_[0] == pytest.approx(v[0], rel=1e-5) == pytest.approx(long_[1], rel=1e-5)


def test_sample_is_bounded_by_rows(spark):
    """A repeated id is one row of the sample, whichever order its rows come in."""
    r = random.Random(6)
    text = lambda toxic: " ".join(r.choice(["fine day", "good road", "warm soup"] if not toxic or k else ["vile scum"]) for k in range(6))
    rows = [(i, text(i % 2)) for i in range(120)]
    many = rows + [(1, f"vile other {k}") for k in range(50)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(120)] + [(4, 0, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    a, b = (toxicity.fit(frame(x), labels) for x in (many, many[::-1]))
    assert a.coefficients.tolist() == pytest.approx(b.coefficients.tolist()) and a.ratios.grams.tolist() == b.ratios.grams.tolist()
    few = toxicity.fit(frame(rows), labels, most_toxic=10, most_ordinary=10)
    assert 0 < len(few.ratios) <= len(a.ratios)
    got = toxicity.score(frame(rows + rows[:3] + [(500, None), (501, ""), (502, "fine vile scum " * 100_000)]), a).collect()
    assert len(got) == 126 and len({x["toxicity"] for x in got if x["doc_id"] in (500, 501)}) == 1
    assert all(x["toxic"] == x["doc_id"] % 2 for x in got if x["doc_id"] < 120) and [x["toxic"] for x in got if x["doc_id"] == 502] == [1]
