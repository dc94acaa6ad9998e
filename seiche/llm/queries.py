"""One query for each operator: it applies the operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.llm import decontamination, html, lines, lm, mixing, quality, simhash, substrings, tokens, toxicity
from seiche.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of each document, by models of the labelled rows that aren't held out. Null and empty texts: the
    score of no evidence. A null id isn't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component ids of all documents by SimHash of 3-word shingles within 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the lines of recurring templates; the first line of each stays, so that what
    was copied survives once."""
    found = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return found.select("doc_id", F.col("n_dropped").cast("bigint").alias("n_dropped"), F.char_length(kept).cast("bigint").alias("n_chars"), F.sha2(kept, 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document the mix takes. Null and empty texts: size 0, nothing taken; a null source is the last one."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page. Null or empty html: empty text."""
    return html.extract(table(spark, sf_dir, "pages"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more each document is like those labelled good than like all. Null and empty texts: 0."""
    found = lm.cross_entropy_difference(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", "target_loss", "background_loss", "lm_score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document holds, and where."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the windows that an earlier one has. Null text: no words."""
    found = substrings.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "longest")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document. Null text: 0 of both."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.vocabulary_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document and whether it is kept. Null text: no words, not kept."""
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "zstd_ratio", "n_chunks", "n_chunks_outside")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op10_quality, which SQL can say."""
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size and target of each source of op4_mixing, which SQL can say."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(mixing.size_of(F.col("text"))).alias("source_size"))
    return mixing.targets(sizes).select("source", "source_size", F.round("target", 4).alias("target"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_html": op5_html,
    "op6_lm_scores": op6_lm_scores,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "quality_base": quality_base,
    "mixing_targets": mixing_targets,
}

#: DuckDB: the words of each document.
_WORDS = r"w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"


def _substrings_sql(levels: int = 12) -> str:
    """Windows of 13 words; those that several documents have, doubled as long as any document could be; what is left."""
    out = [
        f"WITH {_WORDS}",
        "p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS pos FROM w WHERE len(w) >= 13)",
        "a AS MATERIALIZED (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 12], ' ')) AS key FROM p)",
        "f AS (SELECT key, min(doc_id) AS first FROM a GROUP BY key)",
        "gone AS (SELECT DISTINCT a.doc_id, a.pos + k AS ix FROM a JOIN f USING (key) CROSS JOIN (SELECT unnest(generate_series(0, 12)) AS k) o WHERE f.first < a.doc_id)",
    ]
    before = "a"
    for k in range(levels):
        if k:
            out.append(f"a{k} AS MATERIALIZED (SELECT x.doc_id, x.pos, md5(x.key || y.key) AS key FROM {before} x JOIN {before} y ON y.doc_id = x.doc_id AND y.pos = x.pos + {13 << (k - 1)})")
            before = f"a{k}"
        out.append(f"s{k} AS MATERIALIZED (SELECT * FROM {before} WHERE key IN (SELECT key FROM {before} GROUP BY key HAVING count(DISTINCT doc_id) > 1))")
        before = f"s{k}"
    lengths = " UNION ALL ".join(f"SELECT doc_id, {13 << k} AS n FROM s{k}" for k in range(levels))
    return (
        ", ".join(out)
        + f", longest AS (SELECT doc_id, max(n) AS n FROM ({lengths}) x GROUP BY doc_id), each AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS ix FROM w WHERE len(w) > 0),"
        + " kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY ix) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, ix) GROUP BY doc_id)"
        + " SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256, coalesce(longest.n, 0)::BIGINT AS longest FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN longest USING (doc_id)"
    )


def _lines_sql() -> str:
    """Texts are counted, once each (x numbers them); the tree's templates and lines that recur word for word; what stays."""
    n = lines
    return rf"""WITH x AS MATERIALIZED (SELECT text, min(doc_id) AS id, row_number() OVER (ORDER BY min(doc_id)) AS x FROM documents WHERE text IS NOT NULL GROUP BY text),
l AS MATERIALIZED (SELECT x, id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS ix FROM x),
k AS MATERIALIZED (SELECT x, id, ix, w, len(w) AS n, array_to_string(w, ' ') AS t, len(w) || ' ' || array_to_string([CASE WHEN regexp_matches(v, '[0-9]') THEN '<*>' ELSE v END for v in w[1:{n.LEADING}]], ' ') AS leaf FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l) y WHERE len(w) > 0),
lv AS (SELECT leaf FROM k GROUP BY leaf HAVING count(DISTINCT x) >= {n.RECURS}),
e AS MATERIALIZED (SELECT x, leaf, t, unnest(w) AS tok, unnest(generate_series(1, n)) AS pos FROM k WHERE leaf IN (SELECT leaf FROM lv)),
c AS (SELECT leaf, pos, tok FROM e GROUP BY leaf, pos, tok HAVING count(DISTINCT x) >= {n.RECURS}),
m AS (SELECT DISTINCT e.leaf, e.t, e.pos, e.tok, c.tok IS NOT NULL AS ok FROM e LEFT JOIN c ON c.leaf = e.leaf AND c.pos = e.pos AND c.tok = e.tok),
p AS (SELECT leaf, t, string_agg(CASE WHEN ok THEN tok ELSE '<*>' END, ' ' ORDER BY pos) AS template FROM m GROUP BY leaf, t HAVING avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) >= {n.CONSTANT}),
r AS (SELECT p.leaf, p.template FROM k JOIN p USING (leaf, t) GROUP BY p.leaf, p.template HAVING count(DISTINCT x) >= {n.RECURS}),
v AS (SELECT t FROM k WHERE n >= {n.LONG} GROUP BY t HAVING count(DISTINCT x) >= {n.LONG_RECURS}),
hit AS MATERIALIZED (SELECT k.x, k.id, k.ix, k.n, 'tree ' || p.leaf || ' ' || p.template AS g FROM k JOIN p USING (leaf, t) JOIN r USING (leaf, template) UNION ALL SELECT x, id, ix, n, 'line ' || t FROM k WHERE n >= {n.LONG} AND t IN (SELECT t FROM v)),
copies AS (SELECT x FROM (SELECT DISTINCT x, ix, n FROM hit WHERE n >= {n.LONG}) y GROUP BY x HAVING sum(n) >= {n.COPY} * (SELECT sum(n) FROM k WHERE k.x = y.x)),
gone AS (SELECT DISTINCT x, ix FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY id, x, ix) AS place FROM hit) y WHERE place > 1 AND (n < {n.LONG} OR x NOT IN (SELECT x FROM copies))),
kept AS (SELECT x, string_agg(line, chr(10) ORDER BY ix) AS t FROM l ANTI JOIN gone USING (x, ix) GROUP BY x),
lost AS (SELECT x, count(*) AS n FROM gone GROUP BY x)
SELECT doc_id, coalesce(lost.n, 0)::BIGINT AS n_dropped, length(coalesce(kept.t, ''))::BIGINT AS n_chars, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM documents LEFT JOIN x USING (text) LEFT JOIN kept USING (x) LEFT JOIN lost USING (x)"""


_QUALITY_SQL = rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS pos, w FROM w WHERE len(w) >= 3),
k AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w[pos], w[pos + 1], w[pos + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT pos + o) AS n FROM k CROSS JOIN (VALUES (0), (1), (2)) x(o) WHERE k.n >= 2 GROUP BY doc_id),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) x WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > 0),
d AS (SELECT doc_id, count(*) AS n FROM l WHERE n > 1 GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, (len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w)) AS base_failed FROM w LEFT JOIN d USING (doc_id) LEFT JOIN r USING (doc_id)"""

#: Pouring by weight: a source is full if its limit by weight is at or below the level that the rest would have.
_TARGETS_SQL = r"""WITH s AS (SELECT source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))) AS BIGINT) AS source_size FROM documents GROUP BY source),
n AS (SELECT *, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3.0 * source_size AS most FROM s),
lv AS (SELECT a.most / a.weight AS edge, (SELECT sum(source_size) FROM n) AS total, sum(CASE WHEN b.most / b.weight <= a.most / a.weight THEN b.most ELSE 0 END) AS full_words, sum(CASE WHEN b.most / b.weight <= a.most / a.weight THEN 0 ELSE b.weight END) AS open_weight FROM n a CROSS JOIN n b GROUP BY a.source, a.most, a.weight),
c AS (SELECT edge, (total - full_words) / nullif(open_weight, 0) AS level FROM lv UNION ALL SELECT 0, (SELECT sum(source_size) FROM n) / (SELECT sum(weight) FROM n)),
f AS (SELECT min(level) AS level FROM c WHERE level >= edge AND NOT EXISTS (SELECT 1 FROM n WHERE n.most / n.weight > c.edge AND n.most / n.weight < c.level))
SELECT source, source_size, round(least(most, coalesce(f.level * weight, most)), 4)::DOUBLE AS target FROM n, f"""


ORACLE: dict[str, str] = {"quality_base": _QUALITY_SQL, "mixing_targets": _TARGETS_SQL, "op3_line_dedup": _lines_sql(), "op8_substring_dedup": _substrings_sql()}
