"""Secret scans, whitening and the divergence audit against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from clonespark.llm import divergence, html_text, secret_scan, whitening

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    """(start, place of kind, kind, end, value) of the base kinds, over characters."""
    found = [(m.start(), 0, "assign", m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def told(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b, _ in found)


def test_secret_base_spans(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in secret_scan.secret_scan(docs).collect()}
    assert set(got) == set(texts) and any(plain_base(t) for t in texts.values())
    for i, t in texts.items():
        want, r = plain_base(t), got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[2] == k for x in want) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(told(want).encode()).hexdigest()
        assert set(filter(None, told(want).split(","))) <= set(r["spans"].split(","))


def test_secret_odd_texts(spark):
    rng = random.Random(3)
    bits = ["password", "TOKEN", "apiKey", "api_key", "tokEn", "=", ": ", '"', "'", " ", "ab1", "x.y=", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "0123456789abcdef", "é", "ſecret", "toKen=abcdefgh", "\n", "😀", "secret=a", "-", "://u:"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(600)] + [None, "", "token=" + "ab" * 60_000, "é" * 50_000 + " secret: hunter22", "token=token: abcdefg"]
    rows = [(None if i % 7 == 0 else i // 2, t, None if i % 5 == 0 else f"s{i % 4}", i, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row long, hash string, owners int")
    got = collections.Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in secret_scan.secret_scan(df).collect())
    want = collections.Counter()
    for i, t, *_ in rows:
        found = plain_base(t or "")
        want[(i, *(sum(x[2] == k for x in found) for k in ("assign", "access", "hex")), hashlib.sha256(told(found).encode()).hexdigest())] += 1
    assert got == want
    assert secret_scan.secret_scan(df.limit(0)).count() == 0


def test_secret_ownership(spark):
    """A key that many owners have is an example, one of a single owner may be live; base spans stay in either case."""
    common, own = "ghp_" + "R7t2Kq9LmZ4xVb8NcY3w", "ghp_" + "Q1w9Er7Ty5Ui3Op2As8D"
    rows = [(i, f"use {common} here", f"o{i}") for i in range(6)] + [(100 + i, f"my {own} there", "o1") for i in range(9)]
    rows += [(200, "token = 'R7t2Kq9LmZ4x' at https://me:R7t2Kq9L@host and AIzaXXXXXXXXXXXXXXXXXXXXXXXXXX", "o1"), (201, "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY----- é", "o2"), (202, "é zQ8r-Lm3Xw7_Tk9Pv2Hs5 and plainwordplainwordplainword", "o2")]
    got = {r["doc_id"]: r for r in secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["spans"] == "" and (got[i]["n_example"], got[i]["n_live"]) == (1, 0) for i in range(6))
    assert all(got[100 + i]["spans"] == "key:3:27" and (got[100 + i]["n_example"], got[100 + i]["n_live"]) == (0, 1) for i in range(9))
    assert got[200]["spans"].startswith("assign:0:21,url:") and got[200]["n_assign"] == 1
    assert got[201]["spans"] == "pem:0:65" and got[202]["spans"] == "random:2:23"
    counted = {r["hash"]: (r["repos"], r["owners"]) for r in secret_scan.ownership(spark.createDataFrame([("a", "x", "1"), ("a", "x", "2"), ("a", "x", "1"), ("a", "y", "1"), ("b", "y", "9")], "hash string, owner string, repo string")).collect()}
    assert counted == {"a": (3, 2), "b": (1, 1)}


def plain_whitening(vectors, k=4):
    """n, deviation of each vector, covariance: whole numbers and fractions."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[float(sum((Fraction(r[i]) - Fraction(s[i], n)) * (Fraction(r[j]) - Fraction(s[j], n)) for r in fit) / n) for j in range(len(s))] for i in range(len(s))]
    return x, n, s, [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x], np.array(cov)


def test_whitening(spark):
    rng = np.random.default_rng(5)
    made = (rng.normal(size=(300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) + 7).astype(np.float32)
    vectors = [v.tolist() for v in np.vstack((made, made[:50], made[:1]))]
    rows = [(None if i == 3 else i, v, "x", 1) for i, v in enumerate(vectors)] + [(900, None, "x", 1), (901, [None] + vectors[0][1:], "x", 1), (902, [float("nan")] * 6, "x", 1), (903, [float("-inf")] * 6, "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, component int").repartition(7)
    got = whitening.whiten(df).collect()
    x, n, s, deviation, cov = plain_whitening(vectors)
    assert len(got) == 4 * len(vectors) and {r["n"] for r in got} == {n} == {300}
    by = collections.defaultdict(dict)
    for r in got:
        by[r["vec_id"]][r["component"]] = r
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    w = np.array([[by[None if i == 3 else i][c]["whitened"] for c in range(1, 5)] for i in range(len(vectors))])
    for i, d in enumerate(deviation):
        assert {r["deviation"] for r in by[None if i == 3 else i].values()} == {d}
    for c in range(4):
        assert np.isclose(by[0][c + 1]["explained"], values[c] / values.sum(), rtol=1e-12)
    centred = np.array(x) - np.array(s) / n
    basis = np.linalg.lstsq(centred, w * np.sqrt(values[:4]), rcond=None)[0]  # the components, whatever their signs
    assert np.allclose(basis.T @ basis, np.eye(4), atol=1e-9) and np.allclose(cov @ basis, basis * values[:4], atol=1e-6)
    first = w[:300]
    assert np.allclose(np.cov(first.T, bias=True), np.eye(4), atol=1e-9) and {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening_is_exact(spark):
    """Whole numbers as large as a long gives, whatever the shift; and the narrow types agree with the wide ones."""
    rng = random.Random(9)
    rows = [[rng.randrange(-(1 << 61), 1 << 61) for _ in range(3)] for _ in range(40)]
    df = spark.createDataFrame([(r,) for r in rows], "x array<bigint>").repartition(5)
    for shift in ([0, 0, 0], rows[7]):
        n, sums, exact = whitening.scatter(df, shift)
        assert n == 40 and [a + n * b for a, b in zip(sums, shift)] == [sum(c) for c in zip(*rows)]
        s = [sum(c) for c in zip(*rows)]
        assert exact == [[40 * sum(r[i] * r[j] for r in rows) - s[i] * s[j] for j in range(3)] for i in range(3)]
    for v in (0, 1, -1, (1 << 32) - 1, 1 << 32, -(1 << 100) + 12345):
        assert sum(limb << (32 * p) for p, limb in whitening.limbs(v)) == v
    big = [(i, [float(r[0] >> 10), float(r[1] >> 10)]) for i, r in enumerate(rows)]
    got = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>"))
    assert got.count() == 80 and got.filter("deviation IS NOT NULL").count() == 0 and got.filter("identity_error > 1e-9").count() == 0


def test_whitening_edges(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(frame([(1, None), (2, [None])])).count() == 0 and whitening.whiten(frame([])).columns[0] == "vec_id"
    alone = whitening.whiten(frame([(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])])).collect()
    assert len(alone) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone} == {(1, 0, None, 0.0, 0.0)}
    ragged = whitening.whiten(frame([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [])])).collect()
    assert {r["n"] for r in ragged} == {3} and len(ragged) == 8  # [1] and [1, 0] are one


def plain_divergence(rows, least, top):
    """Rows (lang, source, part, item, value, rank) by loops."""
    groups, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
        groups[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, d in seen[lang].items() if d >= least)
        of = {s: c for (g, s), c in groups.items() if g == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in of.items()}
        q = share(sum(of.values(), collections.Counter()))
        for s in of:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in of if o != s]
            terms = [(-(p[s][t] - q[t]), t) for t in kept if of[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -f, i + 1) for i, (f, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -f, i + 1) for i, (f, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def test_divergence(spark):
    rng = random.Random(4)
    words = ["The", "the", "of", "é", "Éa", "漢字", "x1y", "don't", "[a]", "zz", "\x00q", "a　b"] + [f"w{c}{d}" for c, d in itertools.product("abcde", "fghij")]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice([None, "", "s1", "S1", "é", "s2", "s3"])) for _ in range(300)]
    rows += [(None, "fr", "s1"), ("", "fr", "s2"), ("alone", "xx", "s1"), ("w" * 3_000_000 + " the", "en", "s1"), (None, None, None), *[("the of zz", "en", "s1")] * 20]
    df = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, idx int").repartition(5)
    order = ["lang", "source", "part", "item", "value", "rank"]
    for least, top, terms, tile in ((5, 50, 2048, 64), (3, 4, 3, 2)):
        got = divergence.divergence(df, least_docs=least, top=top, terms=terms, tile=tile)
        assert sorted(tuple(r[c] for c in order) for r in got.collect()) == plain_divergence(rows, least, top)
    assert divergence.divergence(df.limit(0)).count() == 0


def test_divergence_parts():
    text = ("é" * 700_000 + " ab1cd " + "Zz" * 900_000 + "-end").encode()
    assert [w for part in divergence.term_pieces(text) for w in part] == text.translate(divergence.TERM_BYTES).split() and list(divergence.term_pieces(b"")) == []
    rng = random.Random(1)
    for _ in range(200):
        kinds = rng.randrange(1, 10**6)
        total = rng.randrange(0, 9 * 10**15 - 5 * kinds)
        count = rng.randrange(0, total + 1)
        got = divergence.probability(np.array([count], np.int64), np.array([total], np.int64), kinds)
        assert int(got[0]) == 1 + 10**9 * (count + 5) // (total + 5 * kinds)


def _comment_page(i, sibling=False):
    """A story with a notice that all pages have, readers' comments as articles of their own, and a linked card as an article."""
    inner = f"<section class='zz'><article class='u'><p>I read this and think reader {i} is wrong.</p></article><article class='u'><p>So do I, says {i * 7}.</p></article></section>"
    story = f"<h1>Title {i}</h1><p>First words of story {i} with detail {i * i}.</p><p class='xk'>Please switch off your blocker to read on.</p><p>Last words of story {i}, which are enough.</p>"
    card = f"<article class='rel'><p><a href='/x{i}'>Another story that may please you {i}</a></p></article>"
    body = f"<article>{story}</article><article><p>A reply by reader {i}.</p></article>" if sibling else f"<article>{story}{inner}</article>{inner}"
    return f"<html><body><nav><a href='/'>Home</a></nav><main>{body}{card}</main><footer>About us</footer></body></html>"


@pytest.mark.parametrize("sibling", [False, True])
def test_comments_notices_and_cards_in_articles(spark, sibling):
    wanted = lambda i: f"Title {i}\n\nFirst words of story {i} with detail {i * i}.\n\nLast words of story {i}, which are enough."
    pages = [html_text.Page(_comment_page(i, sibling)) for i in range(8)]
    rule = html_text.Rule.of(pages)
    assert ["\n\n".join(rule.blocks(p)) for p in pages] == [wanted(i) for i in range(8)]
    df = spark.createDataFrame([(i, f"http://a.example/{i}", _comment_page(i, sibling)) for i in range(8)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()} == {i: wanted(i) for i in range(8)}


def test_several_equal_articles(spark):
    """An index of articles keeps all of them; pages that are nearly copies of one another keep their text."""
    index = "<html><body><main>" + "".join(f"<article><h2>News {i}</h2><p>Text {i} of the day.</p></article>" for i in range(4)) + "</main></body></html>"
    alike = [f"<html><body><article><h1>One story</h1><p>It is the same everywhere, word for word.</p><p>Print {i}</p></article></body></html>" for i in range(9)]
    rows = [(0, "http://i.example/", index), *[(1 + i, "http://c.example/%d" % i, h) for i, h in enumerate(alike)]]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].count("News") == 4 and got[0].count("of the day") == 4
    assert all(got[1 + i] == f"One story\n\nIt is the same everywhere, word for word.\n\nPrint {i}" for i in range(9))


def test_words_merged_alone():
    import time

    import public_tokenizers as P

    from clonespark.llm import bpe

    pairs = bpe.byte_pairs(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(8)
    for _ in range(200):
        word = "".join(rng.choices(["ab", "c", "the", "ing", "é", "1", "zz", "er"], k=rng.randrange(1, 40))).encode()
        assert pairs.encode_alone(word) == pairs.encode_words([word])[0].tolist()
    began = time.perf_counter()
    assert pairs.encode_alone(b"abcabd" * 6_000) == pairs.encode_words([b"abcabd" * 6_000])[0].tolist()
    assert time.perf_counter() - began < 20


def test_search_with_many_blocks_of_queries(spark, monkeypatch):
    from pyspark.sql import functions as F

    from clonespark.llm import search

    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)) * rng.uniform(0.2, 3, (400, 1)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name, value in (("BUCKET_ROWS", 40), ("BLOCK_QUERIES", 10), ("BLOCKS_A_TASK", 2)):
        monkeypatch.setattr(search, name, value)
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    scores = x @ x.T
    wanted = sorted((q, r + 1, int(c), int(scores[q, c])) for q in range(0, 400, 4) for r, c in enumerate(sorted((c for c in range(400) if c != q), key=lambda c: (-scores[q, c], c))[:5]))
    assert sorted(tuple(r) for r in search.top_k(df, F.col("vec_id") % 4 == 0).collect()) == wanted


def test_equal_texts_have_equal_scores(spark):
    from clonespark.llm import lm_score

    rng = random.Random(3)
    kinds = [f"w{i}" for i in range(60)]
    held = [" ".join(rng.choices(kinds, k=rng.randrange(1, 400))) for _ in range(12)]
    rows = [(i, rng.choice(held)) for i in range(150)]
    got = lm_score.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), vocabulary=20).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[dict(rows)[r["doc_id"]]].add(r["log_prob"])
    assert len(got) == 150 and all(len(x) == 1 for x in by.values())


def test_near_duplicates_of_a_crowded_shingle(spark, monkeypatch):
    """A passage that all texts have, in prefixes cut into tiles of three: the same documents stay as by all pairs."""
    from clonespark.llm import simhash

    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [passage + " " + " ".join(rng.choices([f"t{j}" for j in range(4)], k=rng.choice((3, 4)))) for _ in range(70)]
    rows = list(enumerate(texts))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    wanted = sorted({find(i) for i in range(len(texts))})
    assert 1 < len(wanted) < len(set(texts))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(simhash, "COMMON", 2)
    for crowd in (4096, 3):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        # without the fingerprints' links, so that prefixes have to find all
        monkeypatch.setattr(simhash, "trie_links", lambda groups, plan, scratch: groups.select(groups["node"].alias("a"), groups["node"].alias("b")).limit(0))
        assert sorted(r["doc_id"] for r in simhash.without_near_duplicates(df).collect()) == wanted


def test_whole_license_texts(spark):
    """A whole text with words put in and left out is one span of its template, and not also its notices in part."""
    from clonespark.llm import license_texts, licenses

    rng, rows = random.Random(12), []
    for i, (label, text) in enumerate(license_texts.TEXTS):
        words = text.split()
        changed = [w for w in words if rng.random() > 0.02] if i % 2 else [x for w in words for x in ((w, "foo") if rng.random() < 0.02 else (w,))]
        rows.append((i, "Intro words stand here. " + " ".join(changed) + " And code follows.", label))
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for i, _, label in rows:
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.8
        longest = max(got[i]["spans"], key=lambda s: s["cover"])
        assert longest["label"] == label


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, columns named as the stages' own, and no rows at all."""
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    more = {"rate": "double", "p": "string", "node": "bigint", "quality": "int", "_row": "bigint", "_text": "string", "n_tokens": "int", "unit": "string"}
    odd = docs.limit(60).withColumns({c: F.lit(1).cast(k) for c, k in more.items()})
    odd = odd.unionByName(odd.limit(5)).unionByName(odd.limit(3).withColumn("doc_id", F.lit(None).cast("bigint"))).unionByName(odd.limit(2).withColumn("text", F.lit(None).cast("string")))
    for name, table in (("odd", odd), ("none", odd.limit(0))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / name / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    assert got.columns[:2] == ["doc_id", "n_tokens"] and 0 < got.count() <= 200
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_language_scores_against_one_ngram_at_a_time():
    import pyarrow as pa

    from clonespark.llm import language
    from clonespark.llm.words import blocks

    rng = np.random.default_rng(4)
    table, bias = rng.normal(size=(language.BUCKETS, 3)), rng.normal(size=3)
    model = language.LanguageModel(["a", "b", "c"], table, bias, 1.3, 20.0)
    texts = ["", "a", "Ab c", "é", "Straße und Öl", "x" * 300, "the quick brown fox " * 20, "😀 fin", "\\x00\\x01", "ABC abc"]

    def plain(text):
        data, total, n_grams = text.encode(), np.zeros(3), 0
        for n in language.SIZES:
            for i in range(len(data) - n + 1):
                h = n
                for b in data[i : i + n]:
                    h = ((h ^ int(language.FOLD[b])) * 0x01000193) & 0xFFFFFFFF
                total += table[(h ^ (h >> 15)) & (language.BUCKETS - 1)]
                n_grams += 1
        logits = (total / max(n_grams, 1) + bias) / 1.3 * (n_grams / (n_grams + 20.0 + 1e-9))
        e = np.exp(logits - logits.max())
        return e / e.sum()

    (block,) = blocks(pa.array([t.encode() for t in texts], pa.binary()))
    got = model.scores(block)
    alone = np.vstack([model.scores(next(iter(blocks(pa.array([t.encode()], pa.binary()))))) for t in texts])
    assert np.allclose(got, [plain(t) for t in texts]) and np.allclose(got, alone)


def test_pairs_of_sets_that_share_many_shingles_are_told_once(spark):
    """Pipeline, round 3: as many rows as pairs where units come one after another, not as many as shingles that pairs share."""
    from clonespark.llm import simhash

    odd = [0] * simhash.PARITY_WORDS
    rows = [(unit, node, node, 100, 0, odd) for unit in range(50) for node in range(20)]
    names, kinds = "unit bigint, node bigint, known bigint, size bigint, side int, parities array<bigint>", "a bigint, b bigint, least bigint, n bigint"
    df = spark.createDataFrame(rows, names).coalesce(1).sortWithinPartitions("unit", "known")
    got = df.mapInArrow(simhash._prefix_pairs(0.8), kinds).collect()
    assert sorted((r["a"], r["b"], r["n"]) for r in got) == [(a, b, 50) for a in range(20) for b in range(a + 1, 20)]


def test_a_crowd_of_near_copies_is_linked_without_all_its_pairs(spark):
    """Pipeline, round 3: near copies that the fingerprints left apart made a row for each pair of them; links are a few for each now, and connect the same."""
    from pyspark.sql import functions as F

    from clonespark.llm import simhash
    from clonespark.operators.components import components
    from clonespark.scratch import Scratch

    rng = np.random.default_rng(3)
    texts = []
    for _ in range(2):
        base = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        changed = [set(rng.integers(0, 200, 2).tolist()) for _ in range(90)]
        texts += [" ".join(f"c{i}x{j}" if j in at else w for j, w in enumerate(base)) for i, at in enumerate(changed)]
        texts += [" ".join(base[:150]) + f" other{i} " + " ".join(f"t{x}" for x in rng.integers(0, 10**6, 60)) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "node bigint, _text string")
    scratch = Scratch(spark)
    sets = simhash.set_fingerprints(df, carry="node", text_col="_text", shingle=5, words64=4, similarity=0.8)
    nodes = scratch.save(sets.select("node", F.col("node").alias("known"), "size", "prefix", "parities"))
    links = scratch.save(simhash.prefix_links(nodes, lambda n: df.join(n, "node", "left_semi"), 5, 0.8, scratch))
    own = [set(simhash.shingle_set(t.encode(), 5).tolist()) for t in texts]
    near = [(i, j) for i in range(len(own)) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
    root = list(range(len(own)))
    for _ in root:
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    got = {r["node"]: r["root"] for r in components(links, scratch).collect()}
    assert [got.get(i, i) for i in range(len(own))] == root and len(near) > 1_000
    assert {(max(r), min(r)) for r in links.collect()} <= set(near) and links.count() <= 8 * len(own) < len(near)


def test_sets_that_are_too_far_apart_make_no_pairs(spark):
    """Pipeline, round 3: sets of 400 with a similarity of 0.7 came through parities of 256 bits, and long sets that share one shingle by chance made pairs."""
    from clonespark.llm import simhash

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 470).astype(np.uint64)
    apart = [rng.permutation(base)[:400] for _ in range(30)]
    sets = [np.unique(np.concatenate((x[:330], rng.integers(0, 2**63, 70).astype(np.uint64)))) for x in apart]
    near = [base[:400], np.concatenate((base[:385], rng.integers(0, 2**63, 15).astype(np.uint64)))]
    names, kinds = "unit bigint, node bigint, known bigint, size bigint, side int, parities array<bigint>, own int", "a bigint, b bigint, least bigint, n bigint"
    rows = [(0, i, i, len(x), 0, simhash.parities(x).tolist(), len(x)) for i, x in enumerate([*sets, *near])]
    rows += [(1, i, i, 4_000, 0, simhash.parities(rng.integers(0, 2**63, 4_000).astype(np.uint64)).tolist(), 5) for i in range(100, 120)]
    df = spark.createDataFrame(rows, names).coalesce(1).sortWithinPartitions("unit", "known")
    assert [(r["a"], r["b"], r["n"]) for r in df.mapInArrow(simhash._prefix_pairs(0.8), kinds).collect()] == [(30, 31, 1)]
