"""Connected components of a graph given by its edges, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import drop_scratch, free_shuffles, scratch, shuffle_parts, tidy


def _root(parent: dict[int, int], x: int) -> int:
    top = x
    while (up := parent.get(top, top)) != top:
        top = up
    while parent.get(x, x) != top:
        parent[x], x = top, parent[x]
    return top


def forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) for every node of the pairs but the smallest ones."""
    parent: dict[int, int] = {}
    for a, b in pairs:
        a, b = _root(parent, a), _root(parent, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, _root(parent, x)) for x in list(parent)]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as a forest with the same components; a batch is bounded, so is the forest."""
    for b in batches:
        if out := forest(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["u", "v"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (u, v: bigint, any order, repeated or not). Returns (node, label): label is the smallest node of the component;
    nodes are those of the edges. Empty edges give no rows.

    Every round is written to shared storage, so lineage stays short; a round is two aggregations and two joins on node
    ids, and what a hub adds is one row per neighbour (its minimum is combined before the shuffle, and Spark splits a
    skewed side of the join). No more than the round's own edges ever moves; nothing is collected but two sums.
    """
    spark = edges.sparkSession

    def keep(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = scratch(spark, "edges")
        df.write.parquet(path)
        out = spark.read.schema("u bigint, v bigint").parquet(path)
        return out, path, tuple(out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))).first())

    start = edges.filter("u != v").mapInArrow(tidy(_local), "u bigint, v bigint").distinct()
    now, path, sums = keep(start)
    for _ in range(rounds):
        if not sums[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        new, new_path, new_sums = keep(small)
        drop_scratch(spark, path)
        done = new_sums == sums
        now, path, sums = new, new_path, new_sums
        free_shuffles(spark)
        if done:
            break
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
