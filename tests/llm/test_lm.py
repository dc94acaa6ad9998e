"""LM scores against counts of all other documents, taken one by one."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seiche.llm import lm

LABELS = "doc_id bigint, quality int, toxic int"
VOCAB = [a + b for a in "ab ce di fo gu ha".split() for b in "ra se ti vo".split()]


def brute(rows, good):
    """(target loss, background loss) of each row, by models that never saw the row."""
    split = [(t or "").lower().split() for _, t in rows]
    is_good = [i in good for i, _ in rows]
    every = Counter(w for x in split for w in x)
    known = {w for w, n in every.items() if n >= lm.RARE}
    split = [[w if w in known else "?" for w in x] for x in split]
    n, n_good = sum(map(len, split)), sum(len(x) for x, g in zip(split, is_good) if g)
    out = []
    for k, x in enumerate(split):
        both = []
        for of_target, scale in ((True, 1.0), (False, n_good / n if n_good else 1.0)):
            one, two = Counter(), Counter()
            for j, y in enumerate(split):
                if j != k and y and (is_good[j] or not of_target):
                    one.update(["^", *y])
                    two.update(zip(["^", *y], y))
            tokens, v = sum(c for w, c in one.items() if w != "^"), len(known) + 1
            p = lambda a, b: (scale * two[a, b] + lm.BACKOFF * (one[b] + 1) / (tokens + v)) / (scale * one[a] + lm.BACKOFF)  # noqa: B023, E731
            both.append(-sum(math.log(p(a, b)) for a, b in zip(["^", *x], x)) / len(x) if x else 0.0)
        out.append(tuple(both))
    return out


@pytest.mark.parametrize("part", [40, 10**6])
def test_both_losses_of_every_row(spark, part):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(VOCAB[: 24 if i % 2 else 6]) for _ in range(r.randint(1, 30)))) for i in range(60)]
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "Ab once " * 3), (7, rows[7][1]), (7, "abra rare"), (None, "cese cese dira")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit("x") for c in ("lm_score", "bundle", "good", "part")})
    good = [*range(0, 40, 3), 7]
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(3, 0, 0), (None, 1, 0), (5000, 1, 1)], LABELS)
    got = sorted((x["doc_id"] if x["doc_id"] is not None else 1 << 60, x["n_tokens"], round(x["target_loss"], 9), round(x["background_loss"], 9), round(x["lm_score"], 9)) for x in lm.cross_entropy_difference(d, labels, part).collect())
    want = sorted((i if i is not None else 1 << 60, len((t or "").split()), round(a, 9), round(b, 9), round(b - a, 9)) for (i, t), (a, b) in zip(rows, brute(rows, set(good))))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [v for x in got for v in x[2:]] == pytest.approx([v for x in want for v in x[2:]], abs=1e-8)


def test_documents_like_the_target_score_higher(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(VOCAB[12 * (i % 2) :][:12]) for _ in range(30))) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(60)], LABELS)
    got = {x["doc_id"]: x["lm_score"] for x in lm.cross_entropy_difference(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).collect()}
    assert min(got[i] for i in range(60, 120, 2)) > max(got[i] for i in range(61, 120, 2))


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    got = {x["doc_id"]: x for x in lm.cross_entropy_difference(docs, none).collect()}
    assert got[1]["n_tokens"] == 3 and math.isfinite(got[1]["lm_score"]) and got[2]["lm_score"] == 0.0
    assert lm.cross_entropy_difference(docs.limit(0), none).count() == 0


def test_target_of_all_good_rows(spark):
    n = 50_300
    docs = spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the"), F.col("id") % 7, F.col("id") % 11).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    # all rows are good, so the two models are one
    assert lm.cross_entropy_difference(docs, labels).agg(F.max(F.abs("lm_score"))).first()[0] == 0
