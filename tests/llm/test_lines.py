"""Line dedup against a version that follows the definition line by line."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from seiche.llm import lines

SCHEMA = "doc_id bigint, text string, n_chars bigint"
VOCAB = [a + b for a in "ab ce di fo gu ha ji ko".split() for b in "ra se ti vo".split()]


def brute(rows, recurs, constant):
    """(doc_id, text) with the lines that stay. Rows with a null id come last."""
    texts = {t for _, t in rows if t is not None}
    split = {t: [x.split() for x in t.split("\n")] for t in texts}
    leaf = lambda w: (len(w), tuple("<*>" if any(c in "0123456789" for c in x) else x for x in w[: lines.LEADING]))
    has, verbatim = defaultdict(set), defaultdict(set)
    for t, ls in split.items():
        for w in ls:
            for p, x in enumerate(w):
                has[leaf(w), p, x].add(t)
            if len(w) >= lines.LONG:
                verbatim[tuple(w)].add(t)
    of, seen = {}, defaultdict(set)
    for t, ls in split.items():
        for w in filter(None, ls):
            fixed = tuple(x if len(has[leaf(w), p, x]) >= recurs else "<*>" for p, x in enumerate(w))
            if sum(len(has[leaf(w), p, x]) >= recurs for p, x in enumerate(w)) >= constant * len(w):
                of[tuple(w)] = leaf(w), fixed
                seen[leaf(w), fixed].add(t)
    groups = lambda w: [g for g in ([of[w]] if w in of and len(seen[of[w]]) >= recurs else []) + ([w] if len(verbatim.get(w, ())) >= lines.LONG_RECURS else [])]
    first = {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0)):
        for at, w in enumerate(split[t]):
            for g in groups(tuple(w)):
                first.setdefault(g, (t, at))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        hit = [(at, w) for at, w in enumerate(split[t]) if groups(tuple(w))]
        copy = sum(len(w) for _, w in hit if len(w) >= lines.LONG) >= lines.COPY * max(1, sum(map(len, split[t])))
        gone = {at for at, w in hit if any(first[g] != (t, at) for g in groups(tuple(w))) and not (copy and len(w) >= lines.LONG)}
        out.append((i, "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone)))
    return out


def words_of(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    footer, passage, boiler = "Printed on page {} of the daily news of Oldtown", words_of(r, 60), "Copyright 2024 Acme Press and all its heirs"
    out = []
    for i in range(80):
        ls = [words_of(r, r.randint(5, 25)) for _ in range(r.randint(3, 8))]
        if i % 4 == 0:
            ls.insert(r.randint(0, len(ls)), footer.format(i))
        if i % 5 == 0:
            ls.append(boiler)
        if i in (11, 22, 33):
            ls = [words_of(r, 30) for _ in range(4)] + ls + [passage]
        if i in (40, 41):
            ls += [f"Printed on page {k} of the daily news of Oldtown" for k in range(12)]
        out.append((i, "\n".join(ls)))
    # ten lines of one document, in a leaf that other documents fill
    out.append((90, "\n".join(f"once upon a time the {x} family came to town" for x in VOCAB[:10])))
    out += [(91 + k, f"once upon a {words_of(r, 1)} {words_of(r, 6)}") for k in range(12)]
    body = [words_of(r, 24) for _ in range(6)]
    out += [(120 + k, "\n".join([*body[:5], body[5] + f" {VOCAB[k]}"])) for k in range(4)]  # near copies
    out += [(140 + k, out[7][1]) for k in range(12)]  # copies
    out += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (None, out[3][1]), (None, boiler), (3, out[3][1]), (7, "another text of a repeated id"), (204, "\n".join([words_of(r, 3000), boiler, words_of(r, 9)]))]
    return out


@pytest.mark.parametrize("recurs", [10, 5])
def test_lines_that_stay(spark, rows, recurs):
    names = ("n_dropped", "row", "leaf", "line", "of", "template", "first", "key", "total", "n")
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in names})
    got = lines.deduplicated(docs, recurs).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted([(x["doc_id"], x["text"]) for x in got], key=order) == sorted(brute(rows, recurs, lines.CONSTANT), key=order)
    assert all(x["n_chars"] == len(x["text"] or "") and x["row"] == "x" for x in got)


def test_what_the_rules_mean(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    by = {x["doc_id"]: x["text"] for x in lines.deduplicated(docs).collect()}
    was = dict(rows)
    assert by[90] == was[90]  # ten lines of a template in one document are one document
    assert "Printed on page 0 " in by[0] and "Printed" not in by[4] + by[41]
    assert "Copyright 2024" in by[0] and "Copyright 2024" not in by[5]  # a number that doesn't vary is constant
    assert was[22].endswith(by[11].split("\n")[-1]) and len(by[22].split()) == len(was[22].split()) - 60  # a passage of two documents
    assert all(by[k] == was[k] for k in range(120, 124)) and all(by[k] == was[k] for k in range(140, 152))  # copies stay whole


def test_empty_table(spark):
    assert lines.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_without_first_lines(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    assert all("Copyright 2024" not in (x["text"] or "") for x in lines.deduplicated(docs, keep_first=False).collect())
