"""The pipeline's stages over small tables, and the queries' columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seiche.llm import queries
from seiche.llm.common import written

from .test_operators import LABELS, SCHEMA, words_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, top = random.Random(11), str(tmp_path_factory.mktemp("sf"))
    rows, labels = [], []
    for i in range(300):
        y = int(i % 6 == 0)
        w = words_of(r, r.randint(30, 80)).split()
        for _ in range(1 + len(w) // 25 if y else 0):
            w[r.randrange(len(w))] = r.choice(["scumbag", "moronic", "idiotic"])
        rows.append((i, " ".join(w), "en", f"s{i % 4}", 1))
        labels.append((i, 1 - y, y))
    item = words_of(r, 25)
    rows += [(400 + k, rows[1][1], "en", "s1", 1) for k in range(3)] + [(410, rows[2][1] + "\n" + item, "en", "s2", 1), (420, None, "en", None, None), (421, "", "en", "s1", 0)]
    rows += [(500 + k, f"{words_of(r, 40)}\nNora luxu {k} koxu dira fose pixu guti", "en", "s3", 1) for k in range(15)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, item), (2, words_of(r, 30))], "item_id bigint, text string").write.parquet(f"{top}/benchmark.parquet")
    spark.createDataFrame([(1, "u", "<p>a, b</p>")], "page_id bigint, url string, html string").write.parquet(f"{top}/pages.parquet")
    return top, rows, labels


def test_stages(spark, folder):
    top, rows, labels = folder
    docs = spark.read.parquet(f"{top}/documents.parquet").withColumn("toxic", F.lit("keep me"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, top), "stage")
        seen.append((name, {x["doc_id"]: x for x in out.collect()}))
        if name != "mixing":
            assert out.columns == docs.columns
            docs = out
    by = dict(seen)
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & set(by["toxicity"])) <= 3 and len({i for i, *_ in rows} - toxic - set(by["toxicity"])) <= 3
    assert all(x["toxic"] == "keep me" for x in by["toxicity"].values())
    assert sum("Nora luxu" in (x["text"] or "") for x in by["line_dedup"].values()) == 1 and set(by["line_dedup"]) == set(by["toxicity"])
    assert not {400, 401, 402} & set(by["near_dedup"]) and 1 in by["near_dedup"] and 421 not in by["near_dedup"]
    assert set(by["near_dedup"]) - set(by["decontamination"]) == {410}
    assert all(len(x["copies"]) > 0 for x in by["mixing"].values())


def test_run_and_empty_tables(spark, folder, tmp_path):
    top, rows, _ = folder
    assert 0 < corpus_pipeline.run(spark, top).count() <= len(rows)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{top}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"], "op2_simhash": ["doc_id", "fingerprint", "component_id"], "op4_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_html": ["page_id", "url", "text", "n_chars"], "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"], "op9_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op10_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_cover_every_row(spark, folder, name):
    top, rows, _ = folder
    out = queries.QUERIES[name](spark, top)
    assert set(COLUMNS.get(name, [])) <= set(out.columns)
    n = out.count()
    assert n == {"op5_html": 1, "op7_decontamination": 1, "mixing_targets": 5}.get(name, len(rows))


def test_repeated_rows_and_rows_without_an_id(spark, folder):
    """Each stage takes them as its docstring says."""
    top, _, _ = folder
    r = random.Random(21)
    a, b, c = (words_of(r, 60) for _ in range(3))
    item = spark.read.parquet(f"{top}/benchmark.parquet").filter("item_id = 1").first()["text"]
    rows = [(1, a), (1, a), (None, a), (None, b), (None, b + " more"), (None, b), (2, c), (3, c), (4, None), (None, None), (None, ""), (5, item + " " + a), (None, c + " " + item), (6, " ".join([words_of(r, 30_000), item, words_of(r, 30_000)])), (6, words_of(r, 60_000))]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], SCHEMA).withColumns({x: F.lit("x") for x in ("key", "component", "text_hash", "__seiche_gone")})
    near = corpus_pipeline.drop_near_duplicates(spark, docs, top)
    got = [(x["doc_id"], x["text"]) for x in near.collect()]
    assert near.columns == docs.columns and got.count((1, a)) == 2 and (None, a) not in got and (2, c) in got and (3, c) not in got
    assert sum(i is None and (t or "").startswith(b) for i, t in got) == 1 and sum(not t for _, t in got) == 1
    left = [(x["doc_id"], (x["text"] or "")[:20]) for x in corpus_pipeline.drop_benchmark_leaks(spark, docs, top).collect()]
    assert len(left) == len(rows) - 3 and left.count((6, rows[-1][1][:20])) == 1
    assert corpus_pipeline.drop_repeated_lines(spark, docs, top).count() == corpus_pipeline.drop_toxic(spark, docs, top).count() == len(rows)
    mixed = corpus_pipeline.mix_sources(spark, docs, top).collect()
    assert sum(x["taken"] for x in mixed) == pytest.approx(sum(len((t or "").split()) for _, t in rows), rel=0.6)
