"""Toxicity: class-conditional Kneser-Ney models of the letters of words, with shared backoff counts.

Two interpolated Kneser-Ney models, of toxic and of ordinary text, give each letter of a word (and its end) a probability
after the three before it. The highest order counts are the class's own; what discounting frees goes to a lower order that
both classes share: Kneser-Ney's continuation counts (before how many different letters a gram stands, in either class),
interpolated down to single letters and then to a uniform distribution. So a rare expression is smoothed, not dropped, and
one that a class hasn't shown is no evidence by itself: after a context that neither class has shown, both models say the
same. Counts are of texts, not occurrences.

A document's evidence is the difference of its two log-likelihoods, normalised by length: per word over all its words, and
over its most toxic fiftieth of words (one at least), since insults are few among the words even of a toxic text. A logistic
fit turns the two into a probability; it is made on evidence from models that haven't seen the text (each half of the
sample is scored by the other's).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seiche.llm.common import chunks, drop_scratch, scratch, tidy

#: What is taken out of a lower-case run of non-space characters to get the letters of a word.
OTHERS = re.compile(r"[\W\d_]+")
#: Letters in a gram, the last one included; the discount (of a count below it, all); bits of a letter's number in a gram's.
ORDER, DISCOUNT, BITS = 4, 1.5, 12
#: The number of a word's start, of its end, of any letter that the sample hasn't shown or that isn't among its most frequent.
START, END, OTHER = 1, 2, 3
#: The labelled rows a model is fitted on: so many of each class at most, those with the smallest hash of doc_id.
MOST_TOXIC, MOST_ORDINARY = 2_500, 5_000
#: One in so many words counts as the most toxic ones.
TOP = 50
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in chunks(batches, "text", 4 << 20):
        n: Counter = Counter()
        for half, y, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), texts):
            n.update((half, y, w) for w in {OTHERS.sub("", w) for w in set(t.decode().lower().split())} if w)
        yield pa.record_batch([pa.array([k[0] for k in n], pa.int32()), pa.array([k[1] for k in n], pa.int32()), pa.array([k[2] for k in n], pa.string()), pa.array(list(n.values()), pa.int64())], ["half", "y", "word", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of ORDER letters, each word with ORDER - 1 starts before it."""
    for b in batches:
        n: dict[tuple[int, int], Counter] = defaultdict(Counter)
        for half, y, w, c in zip(*(b.column(i).to_pylist() for i in range(4))):
            s = "^" * (ORDER - 1) + w + "$"
            own = n[half, y]
            for k in range(len(w) + 1):
                own[s[k : k + ORDER]] += c
        for (half, y), got in n.items():
            yield pa.record_batch([pa.array([half] * len(got), pa.int32()), pa.array([y] * len(got), pa.int32()), pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], ["half", "y", "gram", "n"])


class Alphabet:
    """Numbers of letters; a gram is its letters' numbers side by side, so a shorter gram is what is left of its high bits.
    Letters that the sample shows are numbered as far as a gram's bits go, the most frequent first."""

    def __init__(self, letters: str):
        self.of = np.full(0x110000, OTHER, np.uint16)
        letters = letters[: (1 << BITS) - 4]
        if letters:
            self.of[np.frombuffer(letters.encode("utf-32-le"), np.uint32)] = np.arange(len(letters)) + 4
        self.of[ord("^")], self.of[ord("$")] = START, END
        self.outcomes = len(letters) + 2  # all letters, OTHER, END

    def numbers(self, text: str) -> np.ndarray:
        return self.of[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)


def grams_of(numbers: np.ndarray) -> np.ndarray:
    """The grams that end at each letter from the ORDERth on."""
    out = np.zeros(max(0, len(numbers) - ORDER + 1), np.int64)
    for k in range(ORDER):
        out = out << BITS | numbers[k : k + len(out)]
    return out


def _places(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where each key is among the sorted ones; -1: nowhere."""
    if not len(keys):
        return np.full(len(of), -1)
    at = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
    return np.where(keys[at] == of, at, -1)


def shared_backoff(types: np.ndarray, outcomes: int) -> np.ndarray:
    """Of distinct grams of ORDER letters, the probability of the last letter by the order below: continuation counts,
    interpolated order by order."""

    def order(longer: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
        # of: grams of `size` letters; longer: the distinct grams of one letter more
        if not size:
            return np.full(len(of), 1.0 / outcomes)
        mask = (1 << BITS * size) - 1
        own, n = np.unique(longer & mask, return_counts=True)
        before, at = np.unique(own >> BITS, return_inverse=True)
        total, freed = np.bincount(at, n), np.bincount(at, np.minimum(n, DISCOUNT))
        lower = order(own, own & ((1 << BITS * (size - 1)) - 1), size - 1)
        p = (np.maximum(n - DISCOUNT, 0) + freed[at] * lower) / total[at]
        place = _places(own, of)
        return p[place]  # every gram asked for ends a longer one

    return order(types, types & ((1 << BITS * (ORDER - 1)) - 1), ORDER - 1)


class Ratios:
    """log P(letter | context, toxic) - log P(letter | context, ordinary). After a context that either class has shown, a
    gram that neither has shown differs by the freed mass alone, since the backoff is shared; after another context, by nothing."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: Alphabet):
        """grams: distinct, sorted; counts: of each class (ordinary, toxic), by gram."""
        self.alphabet, self.grams = alphabet, grams
        self.contexts, at = np.unique(grams >> BITS, return_inverse=True)
        backoff = shared_backoff(grams, alphabet.outcomes)
        self.gram_logs, self.context_logs = [], []
        for n in counts:
            total = np.bincount(at, n, len(self.contexts))
            freed = np.where(total > 0, np.bincount(at, np.minimum(n, DISCOUNT), len(self.contexts)) / np.maximum(total, 1), 1.0)
            self.context_logs.append(np.log(freed))
            self.gram_logs.append(np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1)[at] + freed[at] * backoff))
        self.gram_ratio = (self.gram_logs[1] - self.gram_logs[0]).astype(np.float32)
        self.context_ratio = (self.context_logs[1] - self.context_logs[0]).astype(np.float32)
        del self.gram_logs, self.context_logs

    def __len__(self) -> int:
        return len(self.grams)

    def of(self, found: list[str]) -> np.ndarray:
        """Of each word (letters only), the sum over its letters and its end."""
        if not found:
            return np.empty(0)
        pad = "^" * (ORDER - 1)
        g = grams_of(self.alphabet.numbers(pad + ("$" + pad).join(found) + "$"))
        # grams that end in a start belong to no word
        g = g[(g & ((1 << BITS) - 1)) != START]
        place = _places(self.grams, g)
        context = _places(self.contexts, g >> BITS)
        value = np.where(place >= 0, self.gram_ratio[place], np.where(context >= 0, self.context_ratio[context], 0.0)) if len(self.grams) else np.zeros(len(g))
        n = np.fromiter(map(len, found), np.int64, len(found)) + 1
        return np.add.reduceat(value.astype(np.float64), np.cumsum(n) - n)


class WordScores(dict):
    """log P(word | toxic) - log P(word | ordinary) by the word as written, in lower case; NaN if it has no letters. What
    it holds is bounded."""

    def __init__(self, ratios: Ratios, most: int = 100_000):
        self.ratios, self.most = ratios, most

    def learn(self, written: set[str]) -> None:
        if len(self) + len(written) > self.most:
            self.clear()
        new = [w for w in written if w not in self]
        bare = [w if w.isalpha() else OTHERS.sub("", w) for w in new]
        lettered = [w for w in bare if w]
        score = iter(self.ratios.of(lettered).tolist())
        self.update((w, next(score) if b else float("nan")) for w, b in zip(new, bare))


def evidence(texts: list[bytes], scores: WordScores) -> list[tuple[float, float]]:
    """Of each text: the mean over all words, the mean over the most toxic fiftieth. No words: zeros."""
    split = [t.decode().lower().split() for t in texts]
    scores.learn(set().union(*split))
    out = []
    for found in split:
        v = np.fromiter(map(scores.__getitem__, found), np.float64, len(found))
        v = v[v == v]
        n = len(v)
        k = max(1, n // TOP)
        out.append((float(v.mean()), float(np.partition(v, n - k)[n - k :].mean())) if n else (0.0, 0.0))
    return out


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """ratios: of grams. coefficients: of the evidence, and the constant."""

    def __init__(self, ratios: Ratios, coefficients: np.ndarray):
        self.ratios, self.coefficients = ratios, coefficients

    def probabilities(self, rows: list[tuple[float, float]]) -> np.ndarray:
        z = np.array(rows, np.float64).reshape(-1, 2) @ self.coefficients[:2] + self.coefficients[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_ordinary: int = MOST_ORDINARY) -> Model:
    """Models of the two classes from labelled rows that aren't held out. The sample is bounded by most_toxic and
    most_ordinary rows (whole texts): ids are chosen by hash, and an id is one row (of rows with equal ids the text with
    the least hash), so its labels are broadcast and its gram counts come to the driver.

    An id with several labels is toxic if any says so. Null ids, null labels and labels other than 0 and 1 are ignored;
    null and empty texts have no grams. Ties of the hash go by id. No rows of one class, or empty tables: no grams, and
    every text gets the share of toxic rows. Runs jobs at once."""
    spark = docs.sparkSession
    rows = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).filter(~held_out(F.col("doc_id")))
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = lambda y, most: rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = pick(1, most_toxic).union(pick(0, most_ordinary))
    path = scratch(spark, "labelled")
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"), "y", "text").write.parquet(path)
    sample = spark.read.schema("half int, y int, text string").parquet(path).select("text", "half", "y")
    n = [0, 0]
    for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect():
        n[r["y"]] = r["n"]
    if not all(n):
        drop_scratch(spark, path)
        share = min(max(count.get(1, 0) / max(1, sum(count.values())), 1e-3), 1 - 1e-3)
        return Model(Ratios(np.empty(0, np.int64), np.zeros((2, 0)), Alphabet("")), np.array([0, 0, np.log(share / (1 - share))]))
    words = sample.mapInArrow(tidy(_count_words), "half int, y int, word string, n bigint").groupBy("half", "y", "word").agg(F.sum("n").alias("n"))
    grams = words.mapInArrow(tidy(_count_grams), "half int, y int, gram string, n bigint").groupBy("gram").agg(*(F.sum(F.when((F.col("half") == h) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1))).toArrow()
    whole, *half = models(grams)
    kept = spark.sparkContext.broadcast(half)  # a half is scored by the other half's counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [WordScores(r) for r in kept.value]
        for part, texts in chunks(batches, "text"):
            of = part.column(1).to_pylist()
            both = [evidence([t for t, x in zip(texts, of) if x == h], scores[h]) for h in (0, 1)]
            got = both[0] + both[1]
            y = [v for h in (0, 1) for v, x in zip(part.column(2).to_pylist(), of) if x == h]
            yield pa.record_batch([pa.array(y, pa.int32()), *(pa.array([e[i] for e in got], pa.float64()) for i in range(2))], ["y", "a", "b"])

    seen = sample.mapInArrow(tidy(run), "y int, a double, b double").orderBy("y", "a", "b").toPandas()
    drop_scratch(spark, path)
    kept.destroy()
    y = seen["y"].to_numpy(float)
    weight = np.where(y == 1, count[1] / n[1], count[0] / n[0])
    return Model(whole, _fit(seen[["a", "b"]].to_numpy(float), y, weight * len(y) / weight.sum()))


def models(table: pa.Table) -> list[Ratios]:
    """From grams (a string of ORDER letters; counts of the ordinary and of the toxic class in either half): the model of
    both halves, and those that score half 0 and half 1, each by the other half's counts. One alphabet serves them all."""
    table = table.combine_chunks()
    text = "".join(table.column(0).to_pylist())
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
    n = np.array([table.column(i) for i in range(1, 5)], np.int64).reshape(4, -1)  # half 0 ordinary, toxic, half 1 ...
    last, at = np.unique(letters[:, -1], return_inverse=True)
    often = np.bincount(at, n.sum(axis=0), len(last))
    order = sorted(zip(-often, last.tolist()))
    alphabet = Alphabet("".join(chr(c) for _, c in order if c != ord("$")))
    # rare letters may fall together beyond the alphabet's bits
    grams, back = np.unique(grams_of_rows(alphabet.of[letters].astype(np.int64)), return_inverse=True)
    n = np.array([np.bincount(back, x, len(grams)) for x in n])
    out = []
    for own in ([0, 2], [2], [0]):
        both = np.array([sum(n[k + y] for k in own) for y in (0, 1)])
        some = both.sum(axis=0) > 0
        out.append(Ratios(grams[some], both[:, some], alphabet))
    return out


def grams_of_rows(letters: np.ndarray) -> np.ndarray:
    out = np.zeros(len(letters), np.int64)
    for k in range(ORDER):
        out = out << BITS | letters[:, k]
    return out


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, names: tuple[str, str] = ("toxicity", "toxic")) -> DataFrame:
    """docs' columns with toxicity (double, 0 to 1) and toxic (int, 1 if toxicity >= threshold), or as `names` names them. The model has a bounded
    number of grams (those of a bounded sample) and is broadcast. Null and empty texts, and those without letters, get the score
    of no evidence; a text of any length is read whole. Repeated rows stay, an empty table gives none, input columns named like an added one are replaced."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*(c for c in docs.columns if c not in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, scores = kept.value, WordScores(kept.value.ratios)
        for part, texts in chunks(batches, "text"):
            p = m.probabilities(evidence(texts, scores))
            yield pa.record_batch([*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*part.schema.names, *names])

    schema = T.StructType([*src.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    return src.mapInArrow(tidy(run), schema)
