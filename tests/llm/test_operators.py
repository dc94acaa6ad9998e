"""Each operator against a brute-force version on small rows, and on the rows that are easy to get wrong."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seiche.llm import decontamination, html, mixing, quality, simhash, substrings, tokens, toxicity
from seiche.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCAB = [a + b for a in "ab ce di fo gu ha ji ko lu me no pi".split() for b in "ra se ti vo xu".split()]


def words_of(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose with copies, near copies, a shared passage, recurring lines, and rows that are null, empty, equal or very long."""
    r = random.Random(5)
    passage, footer = words_of(r, 30), "Printed on page {} of the daily news of Oldtown"
    rows = []
    for i in range(90):
        text = "\n".join(words_of(r, r.randint(8, 25)) for _ in range(r.randint(1, 5)))
        if i % 6 == 0:
            text += "\n" + passage + " " + words_of(r, 4)
        if i % 4 == 0:
            text += "\n" + footer.format(i)
        rows.append((i, text, "en", f"s{i % 3}" if i % 3 else "hot", len(text)))
    rows += [(100 + k, rows[7][1], "en", "hot", 5) for k in range(12)]
    rows += [(120 + k, rows[8][1] + " tail" * k, "en", "hot", 5) for k in range(4)]
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (202, " \n\t ", "en", None, 4), (203, "one", "en", "s2", 3), (None, rows[3][1], "en", "s2", 3), (3, rows[3][1], "en", "s2", 3), (204, words_of(r, 6000), "en", "s1", 9)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    odd = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    # names that the operators use themselves
    return odd.withColumns({c: F.lit("x") for c in ("fp", "key", "copies", "toxic", "n_dropped", "part", "bundle", "row", "label", "size", "_good")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = "doc_id bigint, quality int, toxic int"


# -- 2


def fingerprint(text, size):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) > size else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_fingerprints():
    texts = ["", "A b", "a B c", "a b c a b c a b c", "x" * 5000, "Ünï côdé ÀB " * 40]
    assert simhash.fingerprints_of([t.encode() for t in texts]).tolist() == [fingerprint(t, 3) for t in texts]
    assert fingerprint("a b", 3) == fingerprint("A  B\n", 3)


def test_every_pair_within_the_radius_shares_a_key(spark):
    r = random.Random(1)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), r.randint(1, 3)):
            b ^= 1 << k
        pairs.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    one = df.withColumn("i", F.monotonically_increasing_id())
    keyed = lambda c: one.select("i", F.col(c).alias("fp")).select("i", F.explode(simhash.keys()).alias("key"))
    assert keyed("a").join(keyed("b"), ["i", "key"]).select("i").distinct().count() == len(pairs)


def reached(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_links_of_a_hot_bucket_in_blocks(spark):
    r, base = random.Random(2), 0x0123456789ABCDEF
    fps = sorted({base ^ sum(1 << k for k in r.sample(range(20), r.randint(0, 6))) for _ in range(120)})
    got = {(x["node"], x["label"]) for x in components(simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), block=8)).collect()}
    want = reached(fps)
    size = Counter(want)
    assert got == {(f, fps[w]) for f, w in zip(fps, want) if size[w] > 1}


def test_near_duplicates(docs, corpus):
    got = sorted((-1 if x["doc_id"] is None else x["doc_id"], x["component_id"], x["fp"] % (1 << 64)) for x in simhash.near_duplicates(docs).collect())
    fps = [fingerprint(t, 3) for _, t, *_ in corpus]
    group = reached(fps)
    least = {}
    for (i, *_), g in zip(corpus, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    assert got == sorted((-1 if i is None else i, least.get(g), f) for (i, *_), g, f in zip(corpus, group, fps))


def test_components_of_a_long_chain(spark):
    n = 40
    rows = [(i, i + 1) for i in range(n)] + [(100, 101), (100, 101), (101, 100), (7, 7)]
    got = {(x["node"], x["label"]) for x in components(spark.createDataFrame(rows, "u bigint, v bigint")).collect()}
    assert got == {(i, 0) for i in range(n + 1)} | {(100, 100), (101, 100)}


# -- 1


def test_toxicity(spark):
    r = random.Random(3)
    bad = ["scumbag", "moronic", "idiotic"]
    rows, labels = [], []
    for i in range(600):
        y = int(i % 5 == 0)
        w = words_of(r, r.randint(20, 60)).split()
        for _ in range(1 + len(w) // 25 if y else 0):
            w[r.randrange(len(w))] = r.choice(bad) + r.choice(["", ".", "!"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, y))
    rows += [(1000, None), (1001, ""), (1002, "1234 ---"), (None, "an idiotic text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("toxicity", F.lit("old"))
    model = toxicity.fit(docs, spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], LABELS))
    got = {x["doc_id"]: x for x in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= x["toxicity"] <= 1 for x in got.values())
    wrong = sum(got[i]["toxic"] != y for i, _, y in labels)
    assert wrong <= 6
    assert got[1000]["toxicity"] == got[1001]["toxicity"] == got[1002]["toxicity"] < 0.3


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs, none)
    assert toxicity.score(docs, model).filter("toxic = 1").count() == 0
    assert toxicity.score(empty, model).count() == 0


# -- 4


def brute_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [1, 2, 3][k % 3] for k, s in enumerate(names)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] > most * sizes[s] * w}
        if not over:
            return {s: Fraction(most * sizes[s]) if s in full else rest * weight[s] / w for s in names}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 1, None: 40}, {"a": 1, "b": 0, "é": 0}, {"z": 10, "Z": 1000, "b": 10, "d": 3, "e": 7}, {None: 9}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {x["source"]: x["target"] for x in mixing.targets(df).collect()}
    assert got == {s: pytest.approx(float(t)) for s, t in brute_targets(sizes).items()}


def test_split_is_exact(spark):
    quotas = {0: 300, 1: 0, 2: 1, 3: 47}
    rows = mixing.split(spark.createDataFrame(list(quotas.items()), "sid int, q int"), 3).collect()
    for s, q in quotas.items():
        assert sum(x["q"] for x in rows if x["sid"] == s) == q
    shards = Counter()
    for x in rows:
        assert x["q"] >= 0
        shards[x["shard"]] += x["q"]
    assert max(shards.values()) - min(shards.values()) <= 1 and set(shards) == set(range(8))


def test_draws_are_hypergeometric(spark):
    n = 400
    df = spark.range(n).withColumn("u", (F.col("id") + 0.5) / n)
    got = [x["k"] for x in df.select(mixing._drawn(F.lit(20), F.lit(8), F.lit(10), F.col("u")).alias("k")).collect()]
    want = [math.comb(8, k) * math.comb(12, 10 - k) / math.comb(20, 10) for k in range(9)]
    assert all(abs(got.count(k) / n - w) < 0.006 for k, w in enumerate(want))


def test_mix(docs, corpus, empty):
    out = mixing.mix(docs, blocks=16, depth=2).collect()
    assert len(out) == len(corpus)
    taken, target = Counter(), {}
    for x in out:
        assert x["size"] == len((x["text"] or "").encode().split()) and x["taken"] == x["size"] * len(x["copies"]) <= 3 * x["size"]
        assert len({c["epoch"] for c in x["copies"]}) == len(x["copies"]) and all(0 <= c["shard"] < 4 for c in x["copies"])
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    sizes = Counter()
    for _, t, _, s, _ in corpus:
        sizes[s] += len((t or "").encode().split())
    assert target == {s: pytest.approx(float(t)) for s, t in brute_targets(dict(sizes)).items()}
    longest = {s: max(len((t or "").encode().split()) for _, t, _, s2, _ in corpus if s2 == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    again = {(x["doc_id"], x["source"], x["text"]): x["copies"] for x in mixing.mix(docs.repartition(2), blocks=16, depth=2).collect()}
    assert all(again[x["doc_id"], x["source"], x["text"]] == x["copies"] for x in out)
    assert mixing.mix(empty).count() == 0
    assert mixing.drawn(mixing.mix(docs, blocks=16, depth=2)).count() == sum(len(x["copies"]) for x in out)


# -- 5

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav>
<div class="cookie-notice">We use cookies, truly, madly.</div><div id=main-content><h1>Title &amp; more</h1><p>One, two,
 three &eacute;&#233;<br>four.<p>Five <b>six</b> <a href=/x>seven</a>.<script>if (a < b) "</p>"</script><ul><li>a<li>b, c</ul><div class="ad-box">Buy, buy, buy now!</div>
<form><p>Your name, please</p></form><blockquote>Quoted, words.</blockquote></div><section id=comments><p>First, nice, text, really, good</p></section><aside><p>Side, bar, text.</p></aside><footer>&copy; me</footer></body></html>"""


def test_html():
    assert html.main_text(PAGE) == "Title & more\nOne, two, three éé four.\nFive six seven.\na\nb, c\nQuoted, words."
    assert html.main_text("") == "" and html.main_text("<nav>x</nav>") == ""
    assert html.main_text("just text &lt;b&gt;") == "just text <b>"
    assert html.main_text("<article><p>short</p></article><div><p>a, b, c, d</p></div>").startswith("short")
    assert html.main_text("<p>" * 3000 + "deep" + "</div>" * 50) == "deep"


def test_extract(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>x</p>"), (1, "u", PAGE), (4, "u", "<article>" + "<p>many, words here</p>" * 20000 + "</article>")]
    got = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert len(got) == 6 and all(x["n_chars"] == len(x["text"]) for x in got)
    assert next(x for x in got if x["page_id"] == 2)["text"] == "" and next(x for x in got if x["page_id"] == 4)["text"].count("\n") == 19999


# -- 7


def bare(text):
    return [x for x in ("".join(c for c in w.lower() if c.isalnum()) for w in (text or "").split()) if x]


def brute_leaks(rows, items):
    out = set()
    for i, t in rows:
        w = bare(t)
        for k, q in items:
            p = bare(q)
            n = min(5, len(p))
            if not p:
                continue
            a = Counter(tuple(p[j : j + n]) for j in range(len(p) - n + 1))
            for s in range(len(w) - len(p) + 1):
                x = w[s : s + len(p)]
                b = Counter(tuple(x[j : j + n]) for j in range(len(x) - n + 1))
                both = sum((a & b).values())
                if both / (sum(a.values()) + sum(b.values()) - both) >= 0.8:
                    out.add((i, k))
    return out


def test_leaks(spark, docs, empty):
    r = random.Random(4)
    items = [(k, words_of(r, n)) for k, n in enumerate([3, 5, 20, 40, 40, 60])] + [(90, None), (91, "..."), (92, words_of(random.Random(4), 3))]
    rows = [(i, words_of(r, 50)) for i in range(20)]
    for k, (i, t) in enumerate(rows[:10]):
        w, q = t.split(), items[k % 6][1].split()
        if k >= 6:
            q[len(q) // 2] = "changed"
            q = [x.upper() + "," for x in q]
        rows[k] = (i, " ".join(w[:10] + q + w[10:]))
    rows += [(30, None), (31, ""), (None, items[3][1]), (1, rows[1][1])]
    b = spark.createDataFrame(items, "item_id bigint, text string")
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = decontamination.leaks(d, b, least_words=1).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == brute_leaks(rows, items) and len(got) >= 9
    left = {x["doc_id"] for x in decontamination.decontaminated(d, b, least_words=1).collect()}
    assert left == {i for i, _ in rows} - {x["doc_id"] for x in got}
    assert decontamination.leaks(empty, b).count() == 0 and decontamination.leaks(docs, b.limit(0)).count() == 0
    assert decontamination.decontaminated(docs, b.limit(0)).count() == docs.count()


def test_multi_index_finds_all_within_the_radius():
    r = random.Random(6)
    x = decontamination.Index([(k, words_of(r, 12).encode()) for k in range(3000)])
    for k in r.sample(range(3000), 40):
        f = int(x.prints[k])
        for b in r.sample(range(64), decontamination.RADIUS):
            f ^= 1 << b
        want = [j for j in range(3000) if bin(int(x.prints[j]) ^ f).count("1") <= decontamination.RADIUS]
        assert sorted(x.near(5, 12, f)) == want and k in want


# -- 8


@pytest.mark.parametrize("part", [500, 10**6])
def test_substrings(spark, docs, corpus, empty, part):
    got = substrings.substring_dedup(docs, part).collect()
    assert len(got) == len(corpus)
    key = lambda i: 1 << 62 if i is None else i
    first, count = {}, Counter()
    split = [(key(i), (t or "").encode().split()) for i, t, *_ in corpus]
    for k, (i, w) in enumerate(split):
        for s in range(len(w) - 12):
            x = tuple(w[s : s + 13])
            first[x] = min(first.get(x, i), i)
    want = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - 12):
            if first[tuple(w[s : s + 13])] < i:
                gone[s : s + 13] = [True] * 13
        longest = 0
        length = 13
        others = lambda n: Counter(x for _, v in split for x in {tuple(v[s : s + n]) for s in range(len(v) - n + 1)})
        while (c := count.get(length) or count.setdefault(length, others(length))) and any(c[tuple(w[s : s + length])] > 1 for s in range(len(w) - length + 1)):
            longest, length = length, 2 * length
        want.append((i, len(w), sum(gone), longest, b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    assert sorted((key(x["doc_id"]), x["n_words"], x["n_removed"], x["longest"], x["kept"]) for x in got) == sorted(want)
    assert all(sum(s["words"] for s in x["spans"]) == x["n_removed"] for x in got)
    if part > 500:
        assert substrings.substring_dedup(empty).count() == 0


# -- 9


def test_token_counts(spark, docs, corpus, empty):
    path = tokens.vocabulary_path()
    c = tokens.counter(path)
    texts = [t for _, t, *_ in corpus if t] + ["", " ", "  ", " a", "a  b", "a   b ", "\n", " \n ", "\n\n a", "▁▁x", "a▁b", "\ta\t b", "é́\x00 ﻿z", "a\r\n  b", "日本語 text😀", "<s> </s><0x0A>", "x" * 3000]
    r = random.Random(8)
    texts += ["".join(r.choice(" \n\tabcé▁<>1.😀") for _ in range(r.randint(1, 40))) for _ in range(1500)]
    assert [c.count(t) for t in texts] == [len(x) for x in c.model.encode(texts)]
    got = {x["doc_id"]: x for x in tokens.token_counts(docs, path, 100).collect()}
    assert got[200]["n_tokens"] == 0 and got[200]["n_bytes"] == 0 and not got[200]["over_limit"] and got[204]["over_limit"]
    assert tokens.token_counts(docs, path).count() == len(corpus) and tokens.token_counts(empty, path).count() == 0


# -- 10


def test_quality(docs, corpus, empty):
    got = quality.quality_rules(docs).collect()
    assert len(got) == len(corpus)
    by = {x["doc_id"]: x for x in got}
    for i, t, *_ in corpus:
        t = t or ""
        w = t.encode().split()
        c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        x = by[i]
        symbols = sum(t.count(c) for c in "#*$%&|<>")
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == (len(w), sum(len(v.decode()) for v in w), symbols, dup, len(hit))
        assert x["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert x["kept"] == (not x["base_failed"] and brute_bands(t.encode()))
    assert {x["kept"] for x in got} == {True, False} and quality.quality_rules(empty).count() == 0


def brute_bands(t):
    """The whole text and its chunks, of 4,096 bytes or the largest half of that which fits three times, each by the band of its length."""
    import zstandard

    def fits(x):
        low = max(v for least, v in quality.LOWEST if least <= len(x))
        return low <= len(x) / len(zstandard.compress(x, 3)) <= 2.4 * 1.2 ** max(0, math.log2(len(x) / 256))

    size = next((c for c in (4096, 2048, 1024, 512, 256) if 3 * c <= len(t)), 0)
    pieces = [t[k : k + size] for k in range(0, len(t) - size + 1, size)] + ([t[-size:]] if size and len(t) % size else []) if size else []
    return fits(t) and sum(not fits(x) for x in pieces) <= 0.3 * len(pieces)


def test_bands():
    import zstandard

    pack = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    r = np.random.default_rng(1)
    noise = bytes(r.integers(0, 256, 30_000, dtype=np.uint8))
    same = b"the same line again and again\n" * 900
    for t in (noise, same):
        whole, full, outside, *_ = quality.ratios(t, pack)
        assert not quality.within_bands(len(t), whole, full, outside)
    assert quality.ratios(b"", pack)[:3] == (0.0, 0, 0)
    # licences and other ordinary prose stay
    prose = "Permission is granted to copy and distribute verbatim copies of this document, but changing it is not allowed. "
    assert quality.within_bands(*(lambda t: (len(t), *quality.ratios(t, pack)[:3]))(quality.__doc__.encode() + html.__doc__.encode() + toxicity.__doc__.encode()))
    assert not quality.within_bands(*(lambda t: (len(t), *quality.ratios(t, pack)[:3]))(prose.encode() * 30))
    half = " ".join("".join(r.choice(list("abcdefghijklmnop"), int(r.integers(2, 9)))) for _ in range(2500)).encode()
    whole, full, outside, *_ = quality.ratios(half + same[:12_000], pack)
    assert outside >= 2
