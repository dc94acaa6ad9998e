"""Language-model scores by cross-entropy difference (Moore and Lewis 2010).

Two bigram models, of a target (documents labelled good) and of the background (all documents), share one vocabulary and one
way of smoothing. A document's score is the mean over its tokens of the background's loss less the target's.

The models are matched. The vocabulary is the words that occur RARE times or more in all documents, every other word is one
word; the background's bigram counts are scaled to the target's number of tokens, so that both weigh their counts against
the backoff alike, however much larger the corpus is; and a document is never scored by what it added itself: its own
counts are taken out of each model that counted it.

Counts are exact and cover every document. They are gathered and handed back by bundle (see bundles.py): a bundle sends its
distinct words, then its distinct bigrams, each with its counts, as sorted arrays cut by parts of the hash space; the task
of a part adds up and answers each bundle in its own order. Nothing is broadcast or collected but five sums, and a word or
bigram that is in every document is one entry for each bundle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.llm.bundles import Bundle, cuts, distinct, nulls_of, rows_of, written_bundles
from seiche.llm.common import BASE, free_shuffles, mixed, scratch, tidy

#: Occurrences in all documents that a word of the vocabulary has; weight of the backoff distribution.
RARE, BACKOFF = 3, 20.0
#: Hashes that a task holds, on average.
PART = 1_000_000
#: What stands for all rare words, and for the start of a document.
OTHER, START = np.uint64(0x6F74686572), np.uint64(0x7374617274)

ASKS = "part int, bundle bigint, hashes binary, counts binary"
ANSWERS = "bundle bigint, part int, counts binary, sums array<bigint>"
SCORES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, lm_score double"


def _packed(*counts: np.ndarray) -> bytes:
    """Counts byte by byte, the low ones first: most of the others are zero."""
    a = np.concatenate(counts).astype("<i8")
    return zstandard.compress(a.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(b: bytes, columns: int = 2) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel().reshape(columns, -1)


def _packed_hashes(u: np.ndarray) -> bytes:
    """Sorted hashes as the steps between them, whose high bytes are zero: a bundle's hashes lie about 2^47 apart."""
    return _packed(np.diff(u, prepend=np.uint64(0)).view(np.int64))


def _unpacked_hashes(b: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(b, 1)[0].view(np.uint64), dtype=np.uint64)


class Words:
    """A bundle's words: their numbers in its dictionary, and which rows are good."""

    def __init__(self, row: dict):
        self.b = b = Bundle(row)
        self.row = np.repeat(np.arange(len(b.sizes)), b.sizes)
        self.good = np.zeros(len(b.sizes), bool)
        self.good[[int(x) for x in row["good"] or ()]] = True
        self.start, self.other = len(b.hashes) + 1, len(b.hashes)
        self.first = np.zeros(len(self.row), bool)
        self.first[(b.ends - b.sizes)[b.sizes > 0]] = True

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of the dictionary and of START in order, with their occurrences in all rows and in good ones."""
        some = self.b.sizes > 0
        both = [np.bincount(self.b.codes[x], minlength=len(self.b.hashes)) for x in (slice(None), self.good[self.row])]
        h = np.append(self.b.hashes, START)
        order = np.argsort(h)
        return h[order], np.append(both[0], some.sum())[order], np.append(both[1], (some & self.good).sum())[order]

    def known(self, row: dict, sums: dict) -> None:
        """From the answers about words: n, the counts of each word of the dictionary, of OTHER and of START, and the
        words and contexts of the text with rare ones as OTHER."""
        order = np.argsort(np.append(self.b.hashes, START))
        got = np.empty((2, len(order)), np.int64)
        got[:, order] = _answered(row["asked_words"])
        rare = got[0, :-1] < RARE
        self.n = np.column_stack((got[:, :-1], [sums["other"], sums["other_good"]], got[:, -1:]))
        self.now = self.b.codes.copy()
        self.now[rare[self.now]] = self.other
        self.before = np.empty_like(self.now)
        self.before[1:] = self.now[:-1]
        self.before[self.first] = self.start

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams in order, their occurrences in all rows and in good ones, and the place of each token's bigram among them."""
        h = np.concatenate((self.b.hashes, [OTHER, START]))
        key = mixed(h[self.before] * np.uint64(BASE) + h[self.now])
        u, _, back, _, _ = distinct(key)
        return u, np.bincount(back, minlength=len(u)), np.bincount(back[self.good[self.row]], minlength=len(u)), back

    def losses(self, row: dict, sums: dict) -> list[np.ndarray]:
        """The mean loss of each row by the target and by the background, both without the row's own counts."""
        u, _, _, back = self.bigrams()
        two = _answered(row["bigrams"]) if len(u) else np.zeros((2, 0), np.int64)
        own_two, own_one = _own(self.row * len(u) + back), _own(self.row * (self.start + 1) + self.now)
        own_before = np.ones(len(own_one), np.int64)
        own_before[1:][~self.first[1:]] = own_one[:-1][~self.first[1:]]
        size = np.maximum(self.b.sizes, 1)
        mine = self.good[self.row].astype(np.int64)
        # the background is weighed as if it were as large as the target
        scale = sums["n_good"] / sums["n"] if sums["n_good"] else 1.0
        out = []
        for which, own, s in ((1, mine, 1.0), (0, np.ones_like(mine), scale)):
            tokens = sums["n_good"] if which else sums["n"]
            p = (self.n[which][self.now] - own * own_one + 1.0) / (tokens - own * self.b.sizes[self.row] + sums["vocabulary"])
            pair = s * (two[which][back] - own * own_two)
            context = s * (self.n[which][self.before] - own * own_before)
            loss = -np.log((pair + BACKOFF * p) / (context + BACKOFF))
            out.append(np.bincount(self.row, loss, len(size)) / size)
        return out


def _own(key: np.ndarray) -> np.ndarray:
    """How often each key occurs."""
    _, starts, back, _, _ = distinct(key)
    return np.diff(np.append(starts, len(key)))[back]


def _answered(answers: list[dict]) -> np.ndarray:
    """Counts (all, good) of everything asked, in its order."""
    return np.concatenate([_unpacked(x["counts"]) for x in answers], axis=1)


def _asks(name: int, u: np.ndarray, n: np.ndarray, good: np.ndarray, parts: int) -> pa.RecordBatch:
    at = cuts(u, parts)
    out = [(k, _packed_hashes(u[a:b]), _packed(n[a:b], good[a:b])) for k, (a, b) in enumerate(zip(at, at[1:])) if b > a]
    return pa.record_batch([pa.array([x[0] for x in out], pa.int32()), pa.array([name] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], ["part", "bundle", "hashes", "counts"])


def _sum(table: pa.Table) -> pa.Table:
    """All asks of one part: each hash's counts over all bundles, for each bundle. sums, in the first answer: occurrences,
    good ones, words that aren't rare, occurrences of rare words, good ones (all without START)."""
    names = table.column("bundle").to_pylist()
    each = [_unpacked_hashes(b) for b in table.column("hashes").to_pylist()]
    ends = np.cumsum([len(x) for x in each]).tolist()
    n = np.concatenate([_unpacked(b) for b in table.column("counts").to_pylist()], axis=1)
    h = np.concatenate(each)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    total = np.add.reduceat(n[:, order], np.flatnonzero(new), axis=1)
    back = np.empty(len(h), np.int64)
    back[order] = np.cumsum(new) - 1
    own = h[order][new] != START
    rare = own & (total[0] < RARE)
    sums = [int(x) for x in (*total[:, own].sum(axis=1), (own & ~rare).sum(), *total[:, rare].sum(axis=1))]
    rows = [(name, _packed(*total[:, back[a:b]])) for name, a, b in zip(names, [0, *ends], ends)]
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([table.column("part")[0].as_py()] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([sums] + [None] * (len(rows) - 1), pa.list_(pa.int64()))], ["bundle", "part", "counts", "sums"])


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            ids = np.frombuffer(row["ids"], np.int64)
            own = np.flatnonzero(~nulls_of(row))
            yield pa.record_batch([pa.array([row["bundle"]] * len(own), pa.int64()), pa.array(own.astype(np.int32)), pa.array(ids[own])], ["bundle", "at", "doc_id"])


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, part: int = PART) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss: nats a token, lm_score: background_loss - target_loss) of each row
    of docs. A higher score is more like the documents that labels call good (quality = 1).

    Words are runs of non-space, A-Z lower-cased. Null and empty texts: no tokens, 0 in all. No good rows: the target's
    model knows nothing, the losses still compare. Ids with several labels are good if any is; repeated rows of a good id
    are all good; a null id is not. Empty table: no rows. Other columns are ignored. A text of any length is one row of a
    bundle. Jobs run while the frame is built."""
    spark: SparkSession = docs.sparkSession
    bundles, buckets = written_bundles(docs, lower=True)
    total = bundles.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    places = bundles.select("bundle", "ids", "nulls").mapInArrow(tidy(_positions), "bundle bigint, at int, doc_id bigint").join(good, "doc_id").repartition(buckets, "bundle").groupBy("bundle").agg(F.collect_list("at").alias("good"))
    rows = bundles.join(places, "bundle", "left").select("bundle", "ids", "nulls", "sizes", "codes", "words", "good")

    def summed(asks: DataFrame, parts: int) -> DataFrame:
        out = scratch(spark, "counts")
        asks.repartitionById(parts, F.col("part")).groupBy("part").applyInArrow(_sum, ANSWERS).write.parquet(out)
        del asks  # the last reference to what was shuffled
        free_shuffles(spark)
        return spark.read.schema(ANSWERS).parquet(out)

    def answers(df: DataFrame, name: str) -> DataFrame:
        return df.repartition(buckets, "bundle").groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("part", "counts"))).alias(name))

    parts = max(1, -(-total // (4 * part)))

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                yield _asks(row["bundle"], *Words(row).words(), parts)

    words = summed(rows.mapInArrow(tidy(ask_words), ASKS), parts)
    got = words.filter("sums IS NOT NULL").agg(*(F.coalesce(F.sum(F.col("sums")[k]), F.lit(0)) for k in range(5))).first()
    sums = dict(zip(("n", "n_good", "vocabulary", "other", "other_good"), got))
    sums["vocabulary"] += 1  # OTHER
    rows = rows.join(answers(words, "asked_words"), "bundle", "left")
    pairs = max(1, -(-total // (2 * part)))

    def ask_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                w = Words(row)
                w.known(row, sums)
                u, n, of_good, _ = w.bigrams()
                yield _asks(row["bundle"], u, n, of_good, pairs)

    bigrams = summed(rows.mapInArrow(tidy(ask_bigrams), ASKS), pairs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                w = Words(row)
                w.known(row, sums)
                target, background = w.losses(row, sums)
                ids = pa.array(w.b.ids, mask=nulls_of(row))
                yield pa.record_batch([ids, pa.array(w.b.sizes), pa.array(target), pa.array(background), pa.array(background - target)], [x.split()[0] for x in SCORES.split(", ")])

    return rows.join(answers(bigrams, "bigrams"), "bundle", "left").mapInArrow(tidy(score), SCORES)
