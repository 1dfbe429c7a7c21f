"""The queries of this subpackage: name to function of (spark, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from clonespark.llm.bpe import bpe_round_trip
from clonespark.llm.common import table
from clonespark.llm.divergence import divergence
from clonespark.llm.html_text import extract_text
from clonespark.llm.language import language_id
from clonespark.llm.licenses import license_scan
from clonespark.llm.lm_score import pseudo_likelihood
from clonespark.llm.mixing import mixture, quality_domains
from clonespark.llm.quality import quality_verdicts
from clonespark.llm.search import top_k
from clonespark.llm.secret_scan import secret_scan
from clonespark.llm.simhash import simhash_components
from clonespark.llm.token_counts import token_counts
from clonespark.llm.whitening import whiten


def op1_language_id(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


def op3_mixing(spark, sf_dir):
    return mixture(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")))


def op4_simhash(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_lm_score(spark, sf_dir):
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op6_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_rules(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op11_secret_scan(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


def secret_spans(spark, sf_dir):
    """The spans of op11 that SQL can express."""
    return op11_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def whitening_scatter(spark, sf_dir):
    """What op12 has in whole numbers."""
    return op12_whitening(spark, sf_dir).select("vec_id", "component", "n", "deviation")


def quality_counts(spark, sf_dir):
    """The counts of op7 that SQL can express."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def license_phrases(spark, sf_dir):
    """What op10 says of its fixed phrases."""
    return op10_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


QUERIES = {f.__name__: f for f in (op1_language_id, op2_html_extraction, op3_mixing, op4_simhash, op5_lm_score, op6_token_counts, op7_quality_rules, op8_bpe, op9_top_k, op10_license_scan, op11_secret_scan, op12_whitening, op13_divergence, secret_spans, whitening_scatter, quality_counts, license_phrases)}

#: DuckDB SQL for the queries that it can express. op2: the pages' articles are elements of their own, with headings and paragraphs alone.
ORACLES: dict[str, str] = {
    "op2_html_extraction": r"""
        WITH a AS (
            SELECT page_id, url, list_transform(regexp_split_to_array(replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:h1|p)>'), lambda x: regexp_replace(x, '</?b>', '', 'g')) AS blocks FROM pages
        ), b AS (
            SELECT page_id, url, list_filter(list_transform(blocks, lambda x: trim(regexp_replace(
                replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a
        )
        SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10) || chr(10))) AS BIGINT) AS n_chars FROM b
    """,
    "op13_divergence": r"""
        WITH d AS (
            SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d FROM documents
        ), w AS (
            SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), k AS (
            SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 30
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), c AS (
            SELECT g.lang, g.source, k.term, k.n AS n_lang, coalesce(x.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term) x USING (lang, source, term)
        ), t AS (
            SELECT *, sum(n) OVER s AS total, sum(n_lang) OVER s AS total_lang, count(*) OVER s AS v FROM c WINDOW s AS (PARTITION BY lang, source)
        ), p AS (
            SELECT lang, source, term, n, 1 + CAST(1000000000 * (n + 5) AS HUGEINT) // CAST(total + 5 * v AS HUGEINT) AS p, 1 + CAST(1000000000 * (n_lang + 5) AS HUGEINT) // CAST(total_lang + 5 * v AS HUGEINT) AS q FROM t
        ), o AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
            UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
        )
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o) WHERE part = 'pair' OR rank <= 50
    """,
    "whitening_scatter": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), f AS (
            SELECT DISTINCT x FROM v
        ), n AS (
            SELECT count(*) AS n FROM f
        ), s AS (
            SELECT list(s ORDER BY i) AS s FROM (SELECT i, sum(c) AS s FROM (SELECT unnest(x) AS c, generate_subscripts(x, 1) AS i FROM f) GROUP BY i)
        )
        SELECT vec_id, CAST(component AS INTEGER) AS component, n, CAST(list_sum(list_transform(list_zip(x, s), lambda z: CAST((n * z[1] - z[2]) * (n * z[1] - z[2]) AS HUGEINT))) AS BIGINT) AS deviation
        FROM v, n, s, (SELECT unnest(range(1, 1 + least(4, (SELECT max(len(x)) FROM v)))) AS component)
    """,
    "secret_spans": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), p AS (
            SELECT unnest(['assign', 'access', 'hex']) AS kind, unnest([1, 2, 3]) AS k,
                unnest(['((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)', '()(AKIA[A-Z0-9]{16,})', '()([0-9a-f]{24,})']) AS pattern, unnest([6, 20, 24]) AS least
        ), m AS (
            SELECT row, k, kind, least, regexp_extract_all(text, pattern, 0) AS whole, regexp_extract_all(text, pattern, 2) AS held, string_split_regex(text, pattern) AS between
            FROM d, p WHERE regexp_matches(text, pattern)
        ), s AS (
            SELECT row, k, kind, least, unnest(list_transform(range(1, len(whole) + 1), lambda i: {'start': list_sum(list_transform(between[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[:i - 1], lambda x: length(x))), 0), 'n': length(whole[i]), 'held': length(held[i])})) AS s FROM m
        ), f AS (
            SELECT row, count(*) FILTER (k = 1) AS n_assign, count(*) FILTER (k = 2) AS n_access, count(*) FILTER (k = 3) AS n_hex, string_agg(kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.n AS BIGINT), ',' ORDER BY s.start, k) AS spans
            FROM s WHERE s.held >= least GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN f USING (row)
    """,
    "quality_counts": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
        ), w AS (
            SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM d
        ), g AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM w
        ), r AS (
            SELECT doc_id, count(DISTINCT i + j) AS n FROM g, (SELECT unnest([0, 1, 2]) AS j) k WHERE n > 1 GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(words) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(words) AS base_failed
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "license_phrases": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
        ), p AS (
            SELECT unnest([['under', 'the', 'mit', 'license'], ['apache', 'license', 'version', '2'], ['cc', 'by', 'nc']]) AS phrase, unnest(['mit', 'apache-2', 'cc-by-nc']) AS label
        ), h AS (
            SELECT doc_id, label, unnest(list_filter(range(len(words)), lambda i: words[i + 1] = phrase[1] AND words[i + 1:i + len(phrase)] = phrase)) AS place FROM d, p
        ), s AS (
            SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM h GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(labels, '') AS base_labels FROM d LEFT JOIN s USING (doc_id)
    """,
    "op9_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
