"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Each source's rows fall into blocks by a hash. What a source gives is an exact number of blocks: all of them for every
whole time its target goes into its size, then blocks in permuted order up to the rest, the last one cut by rows. These
quotas are split among the output shards down a binary tree: at each node the left half takes half of the blocks, as many
of each source as a draw without replacement would give. A shard then takes its quota of each source's permuted blocks,
disjoint from the other shards', and orders their rows by a hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seiche.llm.common import WORD, written

WEIGHTS, MOST_TIMES, BLOCKS, DEPTH, SEED = (1, 2, 3), 3, 256, 4, 20240501
#: Bits of a row's hash by which a cut block's rows fall into ranges.
BIN_BITS = 12
#: Rows of the plan (sources times blocks) up to which it is broadcast; beyond, Spark joins it by shuffling.
BROADCAST_ROWS = 100_000


def size_of(text: Column) -> Column:
    """Words of a text: each becomes one letter, and what is left without white space is counted. (regexp_count makes an
    array of all words first, several times the text's own memory.)"""
    letters = F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.char_length(letters), F.lit(0)).cast("bigint")


def _row_hash() -> Column:
    return F.xxhash64(F.lit(SEED), "doc_id", "text")


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED + 1), h), F.lit(blocks)).cast("int")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """sources (source, source_size) with sid (0.., by code point, null last), weight and target. Targets share the sum of
    all sizes by weight; where one would exceed `most` times its source's size it stops there, and the excess is shared
    by weight among the others until none is above. Sources are as many rows as a mixture has weights; one task orders them."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("sid", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights))).cast("int") + 1).cast("double"))
    s = s.withColumn("limit", F.col("source_size") * float(most))
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before, every = filled.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # from the source that fills first on: full as long as the level reaches its limit; the first that isn't full sets the level
    s = s.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("limit"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "sid", "level"))).over(every)["level"]
    return s.withColumn("target", F.least(F.col("limit"), F.coalesce(final * F.col("weight"), F.col("limit")))).select("sid", "source", "source_size", "weight", "target")


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 4, taken back."""
    z = n.cast("double") + 4.0
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) - F.ln((z - 3.0) * (z - 2.0) * (z - 1.0))


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def _drawn(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Of `marked` among `total`, how many are in `draws` draws without replacement: the hypergeometric quantile of u."""
    low, high = F.greatest(F.lit(0), draws - (total - marked)), F.least(marked, draws)
    p = F.transform(F.sequence(low, high), lambda k: F.exp(_log_choose(marked, k) + _log_choose(total - marked, draws - k) - _log_choose(total, draws)))
    below = F.aggregate(p, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("k")), lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["k"] + F.when(a["sum"] + w < u, 1).otherwise(0)).alias("k")), lambda a: a["k"])
    return F.least(high, low + below)


def split(quotas: DataFrame, depth: int = DEPTH) -> DataFrame:
    """quotas (sid, q) split among 2^depth shards: (shard, sid, q). Sums over shards are exact; shards differ by a block or two in all."""
    tree = quotas.agg(F.sort_array(F.collect_list(F.struct("sid", F.col("q").cast("int").alias("q")))).alias("quotas")).select(F.lit(0).alias("node"), "quotas")
    for level in range(depth):
        total = F.aggregate("quotas", F.lit(0), lambda a, x: a + x["q"])
        seed = F.lit(SEED + 2 + level)

        def step(a: Column, x: Column) -> Column:
            u = F.pmod(F.xxhash64(seed, a["node"], x["sid"]), F.lit(1 << 53)).cast("double") / float(1 << 53)
            got = _drawn(a["total"], x["q"], a["draws"], u).cast("int")
            return F.struct(a["node"].alias("node"), (a["total"] - x["q"]).alias("total"), (a["draws"] - got).alias("draws"), F.concat(a["left"], F.array(F.struct(x["sid"].alias("sid"), got.alias("q")))).alias("left"))

        start = F.struct(F.col("node"), total.alias("total"), (total / 2).cast("int").alias("draws"), F.expr("CAST(array() AS array<struct<sid:int,q:int>>)").alias("left"))
        tree = tree.withColumn("left", F.aggregate("quotas", start, step, lambda a: a["left"]))
        right = F.zip_with("quotas", "left", lambda a, b: F.struct(a["sid"].alias("sid"), (a["q"] - b["q"]).alias("q")))
        tree = tree.select("node", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("quotas")), F.struct(F.lit(1).alias("side"), right.alias("quotas")))).alias("x")).select((F.col("node") * 2 + F.col("x.side")).alias("node"), F.col("x.quotas").alias("quotas"))
    return tree.select(F.col("node").alias("shard"), F.explode("quotas").alias("x")).select("shard", "x.sid", "x.q")


def _cuts(rows: DataFrame) -> DataFrame:
    """Where each source's cut block runs out: (sid, cut), of its rows (sid, h, size, residual). A row is inside if its middle
    is within the residual, in the order of h. Ranges of h are added up first, and only the one that holds the cut is
    ordered, one row in 2^BIN_BITS of the block, which is one in `blocks` of the source."""
    binned = rows.withColumn("bin", F.shiftright("h", 64 - BIN_BITS))
    bins = binned.groupBy("sid", "residual", "bin").agg(F.sum("size").alias("words"))
    bins = bins.withColumn("before", F.sum("words").over(Window.partitionBy("sid").orderBy("bin")) - F.col("words"))
    cut = bins.filter("before <= residual").groupBy("sid").agg(F.max(F.struct("bin", "before")).alias("b")).select("sid", "b.bin", "b.before")
    inside = binned.join(cut, ["sid", "bin"])
    middle = F.col("before") + F.sum("size").over(Window.partitionBy("sid").orderBy("h")) - F.col("size") / 2
    last = inside.withColumn("middle", middle).filter("middle <= residual").groupBy("sid").agg(F.max("h").alias("last"))
    # none of that range: the cut is where the range begins
    return cut.join(last, "sid", "left").select("sid", F.coalesce("last", F.shiftleft("bin", 64 - BIN_BITS) - 1).alias("cut"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES, blocks: int = BLOCKS, depth: int = DEPTH) -> DataFrame:
    """What each block of each source gives: (source, block, source_size, target, units: array of (epoch, shard, cut)). A
    unit with a cut gives the rows whose hash is at most the cut."""
    h = _row_hash()
    narrow = written(docs.select("source", h.alias("h"), _block(h, blocks).alias("block"), size_of(F.col("text")).alias("size")), "sizes")
    per_block = written(narrow.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    goal = targets(per_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    goal = written(goal.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))), "targets")
    permuted = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 100), "sid", "block"), "block")
    b = per_block.join(goal, per_block["source"].eqNullSafe(goal["source"])).select("sid", "block", "words", "whole", "rest", goal["source"], "source_size", "target")
    b = b.withColumn("end", F.sum("words").over(permuted))
    # the block in which the rest runs out is cut; those before it are whole
    b = b.withColumn("inside", F.col("end") <= F.col("rest")).withColumn("edge", ~F.col("inside") & (F.col("end") - F.col("words") < F.col("rest"))).withColumn("residual", F.col("rest") - (F.col("end") - F.col("words")))
    b = written(b, "permuted")
    edge = b.filter("edge").select("sid", "source", "block", "residual")
    rows = narrow.join(edge, narrow["source"].eqNullSafe(edge["source"]) & (narrow["block"] == edge["block"])).groupBy("sid", "h", "residual").agg(F.sum("size").alias("size"))
    cuts = _cuts(written(rows, "edges"))
    b = b.join(cuts, "sid", "left")
    epochs = F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole") - 1)).otherwise(F.expr("CAST(array() AS array<int>)"))
    full = b.select("sid", "block", F.explode(epochs).alias("epoch"), F.lit(None).cast("bigint").alias("cut"))
    part = b.filter("inside OR (edge AND cut IS NOT NULL)").select("sid", "block", F.col("whole").alias("epoch"), F.when(F.col("edge"), F.col("cut")).alias("cut"))
    units = written(full.union(part).withColumn("rank", F.row_number().over(Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 200), "sid", "epoch", "block"), "epoch", "block")) - 1), "units")
    leaves = split(units.groupBy("sid").agg(F.count("*").alias("q")), depth)
    leaves = leaves.withColumn("to", F.sum("q").over(Window.partitionBy("sid").orderBy("shard"))).filter("q > 0").withColumn("from", F.col("to") - F.col("q"))
    dealt = units.join(leaves.select("sid", "shard", "from", "to"), "sid").filter("rank >= from AND rank < to")
    per = dealt.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "cut"))).alias("units"))
    return b.select("sid", "source", "block", "source_size", "target").join(per, ["sid", "block"], "left").select("source", "block", "source_size", "target", "units")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES, blocks: int = BLOCKS, depth: int = DEPTH) -> DataFrame:
    """docs' columns with size (words), source_size, target (words, of its source), copies (array of epoch, shard and the
    order inside the shard; empty if the mix doesn't take the row) and taken (words, repeats counted).

    Null text: no words. A null source is a source, the last one. Equal rows fall on the same side of a cut. Empty table:
    no rows. Input columns named like an added one are replaced. The same rows give the same mix, in any order or layout.
    Rows don't move where the plan is small enough to broadcast; only rows' hashes and sizes are aggregated."""
    added = ("size", "source_size", "target", "copies", "taken")
    src = docs.select(*(c for c in docs.columns if c not in added))
    p = written(plan(src, weights, most, blocks, depth), "plan").withColumnsRenamed({"source": "__seiche_source", "block": "__seiche_of", "source_size": "__seiche_size", "target": "__seiche_target", "units": "__seiche_units"})
    if p.count() <= BROADCAST_ROWS:
        p = F.broadcast(p)
    rows = src.withColumn("__seiche_h", _row_hash()).withColumn("__seiche_block", _block(F.col("__seiche_h"), blocks)).withColumn("size", size_of(F.col("text")))
    rows = rows.join(p, rows["source"].eqNullSafe(p["__seiche_source"]) & (F.col("__seiche_block") == F.col("__seiche_of")))
    took = F.filter(F.coalesce("__seiche_units", F.expr("CAST(array() AS array<struct<epoch:int,shard:int,cut:bigint>>)")), lambda x: x["cut"].isNull() | (F.col("__seiche_h") <= x["cut"]))
    copies = F.transform(took, lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"), F.xxhash64(F.lit(SEED + 300), x["epoch"], F.col("__seiche_h")).alias("order")))
    return rows.withColumn("copies", copies).withColumn("taken", F.col("size") * F.size("copies")).withColumns({"source_size": F.col("__seiche_size"), "target": F.col("__seiche_target")}).select(*src.columns, *added)


def drawn(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, one for each copy, with its shard and in the shard's shuffled order: write them with
    partitionBy('shard')."""
    copy = mixed.withColumn("copy", F.explode("copies"))
    return copy.select(*(c for c in mixed.columns if c not in ("copies", "taken")), "copy.epoch", "copy.shard", "copy.order").repartition("shard", F.pmod("order", F.lit(64))).sortWithinPartitions("shard", "order")
