"""Bundles: what goes in comes out; numbers of bundles fall into the bucket that Spark deals them to."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seiche.llm import bundles


def test_spark_deals_by_the_same_hash(spark):
    r = np.random.default_rng(2)
    values = [0, 1, -1, 1 << 40, *r.integers(-(1 << 62), 1 << 62, 200).tolist()]
    got = [x[0] for x in spark.createDataFrame([(v,) for v in values], "v bigint").select(F.hash("v")).collect()]
    assert bundles.spark_hash(np.array(values)).tolist() == got
    names = {bundles.name_in(p % 7, 7, p, k) for p in range(20) for k in range(20)}
    assert len(names) == 400 and bundles.name_in(99_999, 100_000, 3, 5) >> 20 == (3 << 40 | 5 << 20) >> 20


@pytest.mark.parametrize("lower", [False, True])
def test_words_come_back(spark, lower, monkeypatch):
    monkeypatch.setattr(bundles, "BUCKET", 3_000)
    r = random.Random(1)
    rows = [(r.randint(0, 50), " ".join(r.choice(["Ab", "ab", "cé", "　x", " "]) for _ in range(r.randint(0, 40)))) for _ in range(200)]
    rows += [(None, " lead\ttabs\x0b\x0c\r\n trail "), (3, None), (4, ""), (5, " \n "), (6, "w" * 5000)]
    out, buckets = bundles.written_bundles(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6), lower)
    got = []
    for x in out.collect():
        row = x.asDict()
        b, words = bundles.Bundle(row), bundles.words_of(row)
        assert (np.diff(b.ids) >= 0).all() and row["n_words"] == len(b.codes) == b.ends[-1]
        for k, (i, null) in enumerate(zip(b.ids.tolist(), bundles.nulls_of(row).tolist())):
            got.append((None if null else i, [words[c].decode() for c in b.codes[b.places(np.array([k]))]]))
    want = [(i, [w.decode() for w in ((t or "").encode().lower() if lower else (t or "").encode()).split()]) for i, t in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=order) == sorted(want, key=order) and buckets > 1
    # a task's bundles are in one file, and answers join without moving them
    assert out.select(F.input_file_name()).distinct().count() <= 6
    plan = out.hint("merge").join(spark.range(9).select(F.col("id").alias("bundle")).repartition(buckets, "bundle").groupBy("bundle").count(), "bundle")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert spark.catalog.listTables() == []
