"""Decontamination of documents shorter than the item they hold."""

import random

from seiche.llm import decontamination

from .test_operators import words_of


def test_item_less_its_last_words(spark):
    w = words_of(random.Random(2), 60).split()
    docs = spark.createDataFrame([(k, " ".join(w[: 60 - k])) for k in range(20)], "doc_id bigint, text string")
    item = spark.createDataFrame([(1, " ".join(w))], "item_id bigint, text string")
    got = {x["doc_id"]: x["n_words"] for x in decontamination.leaks(docs, item).collect()}
    # 56 shingles, of which 45 are 0.8
    assert got == {k: 60 - k for k in range(12)}
