"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.llm import decontamination, lines, mixing, similar, toxicity
from seiche.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold, by models of the labelled ones among docs. Null and empty texts have
    no evidence and stay; repeated rows stay or go alike."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, names=("__seiche_toxicity", "__seiche_toxic"))
    return scored.filter(F.col("__seiche_toxic") == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; the first line of each template stays. No row goes: null texts
    stay null, equal texts lose the same lines, a text that loses all its lines stays as an empty one."""
    return lines.deduplicated(docs, count="__seiche_dropped").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (SimHash and pigeonring find them, similarity 0.8 of 5-word shingles decides) the
    document with the smallest id. Of equal ids, all rows stay or go. Documents without words are a group. Rows without an id go if any of their group has one; of a
    group without ids, the text with the least hash stays, once."""
    found = written(similar.near_duplicates(docs), "near")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__seiche_gone")).distinct()
    named = docs.filter("doc_id IS NOT NULL").join(gone, docs["doc_id"] == gone["__seiche_gone"], "left_anti")
    first = found.filter("component_id IS NULL").groupBy("component").agg(F.min("text_hash").alias("__seiche_first")).select("__seiche_first")
    unnamed = docs.filter("doc_id IS NULL").join(first, F.xxhash64(docs["text"]) == first["__seiche_first"], "left_semi").dropDuplicates(["text"])
    return named.select(*docs.columns).union(unnamed.select(*docs.columns))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Null and empty texts hold none."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often and for which shards. Null texts have no words, a null source is a
    source; equal rows are taken alike."""
    return mixing.mix(docs).filter(F.size("copies") > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: No stage but the mixing's targets can be said in SQL; tests compare each with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each stage's rows written to shared storage and read by the next. An empty
    table passes all stages. Jobs run while the frame is built."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
