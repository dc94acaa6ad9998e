"""Line dedup by a log-template tree: lines whose template recurs across documents are dropped.

The tree has a fixed depth: the number of a line's tokens, then its leading tokens (a token with a digit counts as
variable there). In a leaf, a token is constant at its position if enough documents have it there; what isn't constant is
a variable field. A line's template is its leaf and its constants in place. So the tree doesn't depend on the order of
lines, and every step is a count by key. A template that is variable for the most part is no template (prose whose lines
only begin alike).

A long line needs no variable fields to be told from chance: if two documents have it word for word, it is a template
without any. But a document most of whose words are in such lines is a copy as a whole, not a document with a passage in
it. It keeps its long lines; near-dedup decides about copies.

Documents are counted, never lines: two lines of one document count once, and equal texts are one document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seiche.llm.common import chunks, tidy, written

#: Leading tokens in the tree; documents in which a template recurs; the least share of constant tokens.
LEADING, RECURS, CONSTANT = 3, 10, 0.7
#: Tokens of a long line; documents in which it recurs word for word; the share of a document's tokens in recurring long lines from which the document is a copy.
LONG, LONG_RECURS, COPY = 20, 2, 0.5
DIGIT = re.compile(rb"[0-9]")
VARIABLE = "<*>"


def leaf_of(w: list[bytes]) -> bytes:
    return b"%d " % len(w) + b" ".join(b"<*>" if DIGIT.search(x) else x for x in w[:LEADING])


def _signed(b: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(b, seed) - (1 << 63)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, row, least) of (row, text): the leaves and the long lines of each text, once each, and in how many texts they recur."""
    for part, texts in chunks(batches, "text"):
        keys: list[int] = []
        rows: list[int] = []
        least: list[bool] = []
        for row, t in zip(part.column(0).to_pylist(), texts):
            own = {}
            for line in t.split(b"\n"):
                w = line.split()
                if w:
                    own[_signed(leaf_of(w), 3)] = False
                    if len(w) >= LONG:
                        own[_signed(b" ".join(w), 4)] = True
            keys += own
            rows += [row] * len(own)
            least += own.values()
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(rows, pa.int64()), pa.array(least, pa.bool_())], ["key", "row", "verbatim"])


LINES = "key bigint, doc_id bigint, row bigint, at int, verbatim boolean, line bigint, n int, total int, tokens string"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line by its leaf, with its tokens; another for a long line by itself."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32()]
    for part, texts in chunks(batches, "text"):
        out: list[list] = [[] for _ in range(9)]
        for i, row, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
            split = [x.split() for x in t.split(b"\n")]
            total = sum(map(len, split))
            for at, w in enumerate(split):
                if w:
                    text = b" ".join(w)
                    line = _signed(text, 4)
                    for key, verbatim in ((_signed(leaf_of(w), 3), False), (line, True))[: 1 + (len(w) >= LONG)]:
                        for c, v in zip(out, (key, i, row, at, verbatim, line, len(w), total, None if verbatim else text)):
                            c.append(v)
        yield pa.record_batch([*(pa.array(c, k) for c, k in zip(out, kinds)), pa.array(out[8], pa.binary()).cast(pa.string())], [x.split()[0] for x in LINES.split(", ")])


def recurring(docs: DataFrame, recurs: int = RECURS, constant: float = CONSTANT) -> DataFrame:
    """The lines of templates that recur: (doc_id, row: a hash of the text, at: number of the line from 0, n and total:
    tokens of the line and of the text, template: string with <*> for variable fields, null where the line recurs word for
    word, of: a number for the template, n_docs: different texts that have it).

    Leaves and long lines that too few texts have are dropped by their count before any line moves. A count of texts is
    taken over (key, text) pairs, combined before they move, so a line in a third of all rows is no task's burden; where a
    text has several lines in a leaf, its tokens are counted apart, once each."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text").filter("text IS NOT NULL")
    keys = src.select("row", "text").mapInArrow(tidy(_keys), "key bigint, row bigint, verbatim boolean").distinct().groupBy("key", "verbatim").agg(F.count("*").alias("n_docs"))
    keys = written(keys.filter(F.col("n_docs") >= F.when(F.col("verbatim"), LONG_RECURS).otherwise(recurs)).select("key", "n_docs"), "keys")
    # keys grow with the input, so the lines are joined by a shuffle whatever the size
    lines = written(src.mapInArrow(tidy(_lines), LINES).join(keys.hint("merge"), "key"), "lines")
    verbatim = lines.filter("verbatim").select("doc_id", "row", "at", "n", "total", F.lit(None).cast("string").alias("template"), F.col("line").alias("of"), "n_docs")

    treed = lines.filter("NOT verbatim").withColumnRenamed("key", "leaf")
    own = written(treed.select("row", "leaf", "line").distinct().groupBy("row", "leaf").agg(F.min("line").alias("line"), F.count("*").alias("lines")), "leaves")
    singles = own.filter("lines = 1").groupBy("leaf", "line").agg(F.count("*").alias("texts"))
    several = written(treed.join(own.filter("lines > 1").select("row", "leaf"), ["row", "leaf"], "left_semi").select("row", "leaf", "line").distinct(), "several")
    placed = treed.groupBy("leaf", "line").agg(F.min("tokens").alias("tokens")).select("leaf", "line", F.posexplode(F.split("tokens", " ", -1)).alias("pos", "token"))
    placed = written(placed, "placed")
    of_singles = placed.join(singles, ["leaf", "line"]).groupBy("leaf", "pos", "token").agg(F.sum("texts").alias("texts"))
    of_several = placed.join(several, ["leaf", "line"]).select("leaf", "pos", "token", "row").distinct().groupBy("leaf", "pos", "token").agg(F.count("*").alias("texts"))
    fixed = written(of_singles.union(of_several).groupBy("leaf", "pos", "token").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= recurs).select("leaf", "pos", "token", F.lit(True).alias("is_fixed")), "fixed")
    marked = placed.join(fixed, ["leaf", "pos", "token"], "left").withColumn("is_fixed", F.coalesce("is_fixed", F.lit(False)))
    shown = F.when(F.col("is_fixed"), F.col("token")).otherwise(VARIABLE)
    patterns = marked.groupBy("leaf", "line").agg(F.sort_array(F.collect_list(F.struct("pos", shown.alias("t")))).alias("p"), F.avg(F.col("is_fixed").cast("double")).alias("share"))
    patterns = patterns.filter(F.col("share") >= constant).select("leaf", "line", F.concat_ws(" ", F.col("p.t")).alias("template"))
    patterns = written(patterns.withColumn("of", F.xxhash64("leaf", "template")), "patterns")
    counts = singles.join(patterns, ["leaf", "line"]).groupBy("of").agg(F.sum("texts").alias("texts")).union(several.join(patterns, ["leaf", "line"]).select("of", "row").distinct().groupBy("of").agg(F.count("*").alias("texts")))
    counts = counts.groupBy("of").agg(F.sum("texts").alias("n_docs")).filter(F.col("n_docs") >= recurs)
    of_line = written(patterns.join(counts, "of"), "templates")
    found = treed.drop("n_docs").join(of_line, ["leaf", "line"]).select("doc_id", "row", "at", "n", "total", "template", "of", "n_docs")
    return found.unionByName(verbatim)


def dropped(docs: DataFrame, recurs: int = RECURS, constant: float = CONSTANT, keep_first: bool = True) -> DataFrame:
    """(doc_id, row, at) of the lines that go. See deduplicated."""
    found = written(recurring(docs, recurs, constant), "recurring")
    long_ = found.filter(F.col("n") >= LONG)
    copies = long_.select("row", "at", "n", "total").distinct().groupBy("row", "total").agg(F.sum("n").alias("inside")).filter(F.col("inside") >= COPY * F.col("total")).select("row")
    gone = found.filter(F.col("n") < LONG).unionByName(long_.join(copies, "row", "left_anti"))
    if keep_first:
        first = written(found.groupBy("of").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row", "at")).alias("k")).select("of", "k.row", "k.at"), "first")
        # equal texts lose the same lines
        gone = gone.join(first.select("of", F.col("row").alias("first_row"), F.col("at").alias("first_at")), "of").filter(~((F.col("row") == F.col("first_row")) & (F.col("at") == F.col("first_at"))))
    return gone.select("doc_id", "row", "at").distinct()


def deduplicated(docs: DataFrame, recurs: int = RECURS, constant: float = CONSTANT, keep_first: bool = True, count: str = "n_dropped") -> DataFrame:
    """docs' columns with the lines of recurring templates taken out of text (n_chars, where there is one, follows) and
    n_dropped (or as `count` names it), the lines that went. A template recurs if `recurs` different texts have it; a line
    of LONG tokens or more also if LONG_RECURS texts have it word for word. A text with half its tokens or more in
    recurring lines of LONG tokens keeps those. keep_first: the first line of each template, in the row with the smallest
    doc_id (the first by hash of its text among rows with that id), stays, so that text that was copied survives once.

    Null text: stays null, no lines. Empty text and lines without a token: no lines; they stay. Equal texts lose the same
    lines, whatever their ids, and count as one. A null doc_id comes after the others. An empty table gives no rows. A very
    long text is one row; its lines move each on their own. An input column n_dropped is replaced, others keep their
    names. Rows that lose lines are found by their id and a hash of their text; that join is the only move of whole texts.
    Jobs run while the frame is built."""
    gone = dropped(docs, recurs, constant, keep_first)
    drop = gone.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("__seiche_at")).select(F.col("doc_id").alias("__seiche_id"), F.col("row").alias("__seiche_of"), "__seiche_at")
    names = [c for c in docs.columns if c not in (count, "__seiche_id", "__seiche_of", "__seiche_at")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            here = dict(zip(part.schema.names, part.columns))
            new, lost = [], []
            for t, at in zip(texts, here.pop("__seiche_at").to_pylist()):
                if at:
                    out = set(at)
                    t = b"\n".join(x for i, x in enumerate(t.split(b"\n")) if i not in out)
                new.append(t)
                lost.append(len(at or ()))
            here["text"] = pa.array([n if ok else None for n, ok in zip(new, here["text"].is_valid().to_pylist())], pa.binary()).cast(pa.string())
            if "n_chars" in here:
                kind = here["n_chars"].type
                here["n_chars"] = pa.array([len(n.decode()) if k else old for n, k, old in zip(new, lost, here["n_chars"].to_pylist())], kind)
            yield pa.record_batch([*(here[c] for c in names), pa.array(lost, pa.int32())], [*names, count])

    src = docs.select(*names)
    joined = src.join(drop.hint("merge"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("__seiche_id")) & (F.xxhash64("text") == F.col("__seiche_of")), "left").select(*names, "__seiche_at")
    return joined.mapInArrow(tidy(cut), T.StructType([*src.schema.fields, T.StructField(count, T.IntegerType())]))
