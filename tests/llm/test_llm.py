"""The training-data operators against brute force, and their edge cases."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clonespark.llm import bpe, html_text, language, licenses, lm_score, mixing, quality, search, simhash, token_counts
from clonespark.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [None, "", " \n\t", "a", "A a  a\n", "\x1c\x85 x", "é" * 40, "word " * 4000, "x" * 50_000, "don't <|endoftext|> I'LL 12ab", "a　b​", "same text here now", "same text here now", "😀 " * 900 + "ab1" * 9000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, with null and repeated ids and columns whose names the operators use themselves."""
    rows = [(None if i == 3 else i // 2, t, "en" if i % 2 else None, "s", 1, "x", 2, 3.0) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, n_tokens int, score double")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_token_counts(docs, odd, empty):
    library = Tokenizer.from_file(JSON)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    t = texts(docs)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.token_counts(docs, JSON).collect()}
    assert got == {i: (len(x.encode()), count(x), count(x) > 1024) for i, x in t.items()}
    assert sorted(r["n_tokens"] for r in token_counts.token_counts(odd, JSON).collect()) == sorted(map(count, ODD))
    assert token_counts.token_counts(empty, JSON).count() == 0
    piece = P.path("piece_bpe_32k.model")
    assert token_counts.token_counts(odd, piece).filter("n_tokens > 0").count() >= 10


def test_pieces_leave_counts(monkeypatch):
    library = Tokenizer.from_file(JSON)
    rng = random.Random(1)
    for size in (7, 50):
        for _ in range(60):
            s = "".join(rng.choices(["a", "B", " ", "  ", "\n", "'s", "1", "é", "<|endoftext|>", ".", "\x1c", " ", "'"], k=120))
            parts = list(token_counts.pieces(s, size))
            assert "".join(parts) == s and sum(len(library.encode(p, add_special_tokens=False).ids) for p in parts) == len(library.encode(s, add_special_tokens=False).ids)


def test_bpe_round_trip(docs, odd, empty):
    ranks = bpe.byte_pairs(RANKS, P.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def wanted(t):
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    t = texts(docs)
    assert {r["doc_id"]: tuple(r)[1:] for r in bpe.bpe_round_trip(docs, RANKS, P.PATTERN).collect()} == {i: wanted(x) for i, x in t.items()}
    assert sorted(tuple(r)[1:] for r in bpe.bpe_round_trip(odd, RANKS, P.PATTERN).collect()) == sorted(map(wanted, ODD))
    back = bpe.bpe_decode(bpe.bpe_encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((x or "").encode() for x in ODD)
    assert bpe.bpe_encode(empty, RANKS, P.PATTERN).count() == 0


def test_bpe_odd_ranks(tmp_path):
    """Vocabularies in which a merge makes a pair of a lower rank, as trained ones don't."""
    import base64

    rng = random.Random(2)
    for n in range(30):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 330:
            new = rng.choice(tokens[97:100] + tokens[256:]) + rng.choice(tokens[97:100] + tokens[256:])
            if new not in tokens and len(new) < 7:
                tokens.append(new)
        order = tokens[:256] + rng.sample(tokens[256:], len(tokens) - 256)
        path = tmp_path / f"{n}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(order)))
        ours = bpe.BytePairs(str(path), r"[a-z]+|[^a-z]+")
        library = tiktoken.Encoding("o", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ours.ranks, special_tokens={})
        words = ["".join(rng.choices("abc", k=rng.randrange(1, 40))) for _ in range(50)]
        assert [x.tolist() for x in ours.encode(words)] == [library.encode_ordinary(w) for w in words]


def simhash64(t, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def reachable(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_shingles_of_long_texts(monkeypatch):
    t = " ".join(random.Random(25).choices(["a", "bb", "Ccc\t", "é\n\n", "x" * 30], k=800)).encode()
    whole = {k: simhash.shingle_hashes(t, k) for k in (1, 3, 5)}
    monkeypatch.setattr(simhash, "PIECE_BYTES", 40)
    assert all((simhash.shingle_hashes(t, k) == w).all() for k, w in whole.items())
    assert len(simhash.shingle_hashes(b" a b ", 3)) == 1 and not len(simhash.shingle_hashes(b" \n", 3))


def test_simhash(spark, docs, odd, empty):
    rng = random.Random(3)
    base = list(texts(docs).items())[:60]
    rows = base + [(1000 + i, t.replace(" ", "\n", 1) if i % 2 else t + " x") for i, (_, t) in enumerate(base[:30])]
    # a word changed in long texts moves few bits
    for i, (_, t) in enumerate(sorted(base, key=lambda r: -len(r[1]))[:10]):
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((2000 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [simhash64(t) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    roots = reachable(len(rows), lambda i, j: (prints[order[i]] ^ prints[order[j]]).bit_count() <= 3)
    wanted = {rows[order[i]][0]: (f"{prints[order[i]]:016x}", rows[order[r]][0]) for i, r in enumerate(roots)}
    assert {r["doc_id"]: tuple(r)[1:] for r in simhash.simhash_components(df).collect()} == wanted
    got = simhash.simhash_components(odd).collect()
    assert sorted(r["fingerprint"] for r in got) == sorted(f"{simhash64(t):016x}" for t in ODD)
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {0}
    assert simhash.simhash_components(empty).count() == 0


def test_simhash_large_groups(spark, monkeypatch):
    """Groups that are split once more give the same components."""
    rng = random.Random(4)
    centre = [rng.getrandbits(64) for _ in range(20)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centre for _ in range(15)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = reachable(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    from clonespark.operators.components import components
    from clonespark.scratch import Scratch

    df = spark.createDataFrame([(p,) for p in signed], "node long").select("node", F.array("node").alias("fingerprint"), F.col("node").alias("known"), F.array("node").alias("check"))
    for large in (10_000, 3):
        monkeypatch.setattr(simhash, "LARGE_GROUP", large)
        scratch = Scratch(spark)
        found = {r["node"]: r["root"] for r in components(simhash.trie_links(df, simhash.Plan(), scratch).select("a", "b"), scratch).collect()}
        groups = collections.defaultdict(set)
        for s, r in zip(signed, roots):
            groups[r].add(s)
        assert collections.Counter(found.get(s, s) for s in signed) == collections.Counter(min(g) for g in groups.values() for _ in g)


def test_pairs_meet_once(spark, monkeypatch):
    """With every link asked for, each pair within the bounds comes once, whatever bands and parts it agrees in."""
    from clonespark.scratch import Scratch

    rng = random.Random(14)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(128)
        prints += [base ^ sum(1 << b for b in rng.sample(range(128), rng.choice((0, 2, 5, 9, 14)))) for _ in range(8)]
    prints = sorted(set(prints))
    signed = [[w - (1 << 64) if w >> 63 else w for w in (p >> 64, p & (1 << 64) - 1)] for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "node long, fingerprint array<long>").select("node", "fingerprint", F.col("node").alias("known"), F.col("fingerprint").alias("check"))
    bands = lambda x: [(x >> 96 - 32 * b & (1 << 32) - 1).bit_count() for b in range(4)]
    wanted = sorted((i, j) for j in range(len(prints)) for i in range(j) if min(bands(prints[i] ^ prints[j])) <= 2 and (prints[i] ^ prints[j]).bit_count() <= 20)
    for large in (10_000, 4):
        monkeypatch.setattr(simhash, "LARGE_GROUP", large)
        links = simhash.trie_links(df, simhash.Plan(words64=2, bands=4, budget=2, checks=2, limit=20, sure=3), Scratch(spark), every=True)
        assert sorted((r["a"], r["b"]) for r in links.collect()) == wanted and wanted


def jaccard(a, b, k=5):
    x, y = (set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else {tuple(w)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_near_duplicates(spark, odd, empty):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    rows, groups = [], []
    for g in range(12):
        w = rng.choices(words, k=200)
        for c in range(6):
            v = list(w)
            for _ in range(c % 3):  # up to two words changed: a similarity over 0.9 with the first
                v[rng.randrange(200)] = rng.choice(words)
            rows.append((len(rows), " ".join(v)))
            groups.append(g)
        far = list(w)
        for i in range(0, 200, 8):
            far[i] = rng.choice(words)
        rows.append((len(rows), " ".join(far)))  # about 0.2: another text
        groups.append(100 + g)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in simhash.without_near_duplicates(df).collect()]
    split = [t.split() for _, t in rows]
    roots = reachable(len(rows), lambda i, j: jaccard(split[i], split[j]) >= 0.8)
    assert sorted(kept) == sorted(set(roots)) and len(kept) == 24
    left = simhash.without_near_duplicates(odd)
    assert left.columns == odd.columns and left.filter("text = 'same text here now'").count() == 1
    assert left.filter("trim(coalesce(text, '')) = ''").count() <= 1
    assert simhash.without_near_duplicates(empty).count() == 0


def test_near_duplicates_with_runs(spark):
    """A long run of one token makes no duplicates of different texts, and hides none."""
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    run, rows = ["."] * 400, []
    for g in range(6):
        w = rng.choices(words, k=300)
        rows += [(10 * g, " ".join(w + run)), (10 * g + 1, " ".join(w)), (10 * g + 2, " ".join(w + run + run))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.without_near_duplicates(df).collect()) == [10 * g for g in range(6)]


def test_near_duplicates_are_complete(spark, monkeypatch):
    """All pairs at 0.8 and just above it are found, and none below, with shingles that are common too."""
    rng = random.Random(16)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    lead, rows = rng.choices(words, k=30), []
    for g in range(150):
        w = lead + rng.choices(words, k=170)
        v = list(w)
        for i in rng.sample(range(35, 195, 7), 4):  # each takes five of 196 shingles
            v[i] = rng.choice(words)
        rows += [(2 * g, " ".join(w)), (2 * g + 1, " ".join(v))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    split = [t.split() for _, t in rows]
    wanted = [2 * g + c for g in range(150) for c in range(2) if not c or jaccard(split[2 * g], split[2 * g + 1]) < 0.8]
    assert 150 <= len(wanted) < 200
    for common, known in ((5, 1000), (5, 0), (10_000, 1000)):
        monkeypatch.setattr(simhash, "COMMON", common, raising=False)
        monkeypatch.setattr(simhash, "KNOWN_COMMON", known, raising=False)
        assert sorted(r["doc_id"] for r in simhash.without_near_duplicates(df).collect()) == wanted


def test_parities_bound_differences():
    """Sets differ in as many elements as their parities in bits, or more; equal sets in none."""
    rng = np.random.default_rng(30)
    for size, changed in ((50, 5), (300, 40), (2000, 900)):
        x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        y = np.unique(np.concatenate((x[changed:], rng.integers(0, 2**63, changed).astype(np.uint64))))
        a, b = simhash.parities(x).view(np.uint64), simhash.parities(y).view(np.uint64)
        assert 0 < np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y)) and (simhash.parities(x) == simhash.parities(x[::-1])).all()


def test_prefix_join_of_a_crowd(spark, monkeypatch):
    """Of many texts near one another but under the similarity few pairs leave the join, and those over it all do."""
    rng = random.Random(31)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    base = rng.choices(words, k=150)
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        w = list(base)
        for p in rng.sample(range(150), rng.choice((3, 5, 8))):
            w[p] = rng.choice(words)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    split = [t.split() for _, t in rows]
    roots = reachable(len(rows), lambda i, j: jaccard(split[i], split[j]) >= 0.8)
    made, own = [], simhash.confirmed

    def counted(links, *rest):
        made.append(links.distinct().count())
        return own(links, *rest)

    monkeypatch.setattr(simhash, "confirmed", counted)
    assert sorted(r["doc_id"] for r in simhash.without_near_duplicates(df).collect()) == sorted(set(roots))
    assert len(set(roots)) > 20 and made[-1] < 0.1 * len(rows) ** 2 / 2


def base_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality(spark, docs, odd, empty):
    got = quality.quality_verdicts(docs).collect()
    t = texts(docs)
    assert {r["doc_id"]: tuple(r)[1:7] for r in got} == {i: base_counts(x) for i, x in t.items()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    judged = [(r["kept"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(k == bool(q) for k, q in judged) >= 0.95 * len(judged)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert sorted(tuple(r)[1:7] for r in quality.quality_verdicts(odd).collect()) == sorted(map(base_counts, ODD))
    assert quality.quality_verdicts(empty).count() == 0 and quality.quality_filter(empty).columns == empty.columns
    assert quality.quality_filter(docs).count() == sum(r["kept"] for r in got)


def planted_votes(rng, n):
    """Votes of rules with known probabilities on good and low documents."""
    good = rng.random(n) < 0.85
    p_good = np.array([[0.001, 0.009, 0.99], [0.01, 0.09, 0.9], [0.02, 0.13, 0.85], [0.0, 0.03, 0.97], [0.005, 0.005, 0.99]])
    p_low = np.array([[0.6, 0.2, 0.2], [0.3, 0.3, 0.4], [0.4, 0.3, 0.3], [0.5, 0.2, 0.3], [0.1, 0.5, 0.4]])
    draw = rng.random((n, 5, 1))
    of = lambda p: np.array([-2, -1, 1])[(draw > np.cumsum(p, 1)[:, :2]).sum(2)]
    votes = np.where(good[:, None], of(p_good), of(p_low))
    votes[rng.random(votes.shape) < 0.1] = 0
    return good, votes, p_good, p_low


def test_repeats_under_colliding_hashes(monkeypatch):
    """Windows of one hash that aren't equal are counted as what they are."""
    import pyarrow as pa

    from clonespark.llm import words

    sample = ["a b c d a b c e f", "x y z x y q", "k " * 20, "", "one two"]
    monkeypatch.setattr(words, "mix", lambda x: x % np.uint64(3))
    for (block,) in (words.blocks(pa.array([t])) for t in sample):
        block.split()
        assert quality.repeated_words(block, block.hashes()).tolist() == [base_counts(sample[[x.strip() for x in sample].index(block.data.tobytes().decode().strip())])[4]]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(6)
    good, votes, p_good, p_low = planted_votes(rng, 40_000)
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_label_model(list("abcde"), patterns, counts)
    assert abs(model.share - 0.85) < 0.02 and np.abs(model.good - p_good).max() < 0.03 and np.abs(model.low - p_low).max() < 0.05
    right = 0.85 * p_good[:, 2] + 0.15 * p_low[:, :2].sum(1)
    assert np.abs(np.array(list(model.accuracy.values())) - right).max() < 0.03
    # the posterior tells more than a vote of all rules, and single low votes don't decide
    w = model.weights()
    score = np.log(model.share / (1 - model.share)) + sum(np.where(votes == v, w[:, k], 0).sum(1) for k, v in enumerate(quality.VOTES))
    lows = (votes < 0).sum(1)
    assert ((score > 0) == good).mean() > max(((lows == 0) == good).mean(), 0.97)
    assert (score[lows == 1] > 0).any() and (score[lows == 1] < 0).any()


def test_label_model_brute_force():
    """EM document by document, in plain Python, ends where EM over patterns does."""
    _, votes, *_ = planted_votes(np.random.default_rng(13), 300)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(list("abcde"), patterns, counts, rounds=25, tolerance=0)
    belief = [quality.START[min(3, -sum(min(v, 0) for v in row))] for row in votes.tolist()]
    for _ in range(25):
        share = (sum(belief) + quality.SHARE * quality.STRENGTH) / (len(votes) + quality.STRENGTH)
        tables = []
        for weight, prior in ((lambda b: b, quality.PRIOR_GOOD), (lambda b: 1 - b, quality.PRIOR_LOW)):
            table = [[quality.STRENGTH * x for x in prior] for _ in range(5)]
            for row, b in zip(votes.tolist(), belief):
                for r, v in enumerate(row):
                    if v:
                        table[r][quality.VOTES.index(v)] += weight(b)
            tables.append([[x / sum(t) for x in t] for t in table])
        belief = []
        for row in votes.tolist():
            a, b = share, 1 - share
            for r, v in enumerate(row):
                if v:
                    k = quality.VOTES.index(v)
                    a, b = a * tables[0][r][k], b * tables[1][r][k]
            belief.append(a / (a + b))
    assert math.isclose(model.share, share, rel_tol=1e-9) and np.allclose(model.good, tables[0]) and np.allclose(model.low, tables[1])


def test_quality_verdicts_weigh_votes(spark):
    """A document with one low vote may stay, so the verdict isn't that of all rules; junk of one kind goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = random.Random(21)
    numbers = " ".join(x for _ in range(60) for x in ("".join(rng.choices("abcdefgh", k=7)), "".join(rng.choices("0123456789", k=3))))
    docs = docs.unionByName(spark.createDataFrame([(900_000, numbers)], "doc_id long, text string"))
    rows = docs.select("doc_id", quality.quality_features().alias("f")).select("doc_id", "f.*").withColumns(quality.rules()).collect()
    lows = {r["doc_id"]: sum(r[x] < 0 for x in quality.rules()) for r in rows}
    got = [r for r in quality.quality_verdicts(docs).collect() if not r["base_failed"]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert lows[900_000] == 1 and {r["doc_id"]: r["kept"] for r in got}[900_000]
    assert not any(r["kept"] for r in got if lows[r["doc_id"]] > 2)
    judged = [r["kept"] == bool(labels[r["doc_id"]]) for r in got if r["doc_id"] in labels]
    assert sum(judged) >= 0.99 * len(judged)


def test_language(spark, docs, odd, empty):
    got = language.language_id(docs).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held) and all(0 <= r["score"] <= 1 for r in got)
    for r in language.language_id(docs.unionByName(odd.select(*docs.columns).withColumn("doc_id", F.col("doc_id") + 100_000))).filter("doc_id >= 100000 OR doc_id IS NULL").collect():
        assert (r["lang_pred"] == "und") == (r["score"] == 0.0)
    none = language.language_id(odd.filter("lang IS NULL")).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and language.language_id(empty).count() == 0
    assert language.language_filter(docs).count() >= 0.99 * docs.count()


def test_language_without_labels_keeps_all(docs):
    assert language.language_filter(docs.withColumn("lang", F.lit(None).cast("string"))).count() == docs.count()
    with pytest.raises(ValueError):
        language.fit_language_model(docs.withColumn("lang", F.col("doc_id").cast("string")).unionByName(docs.crossJoin(docs.select(F.col("doc_id").alias("n")).limit(20)).withColumn("lang", F.concat("doc_id", F.lit("-"), "n")).drop("n")))


def test_language_scores_are_calibrated(spark):
    """Over parts of held-out texts, short ones too, scores are near the share that is right; more of those under the threshold are wrong than of the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(22)
    rows = []
    for r in docs.filter(language.held_out("doc_id") & F.col("lang").isNotNull()).select("text", "lang").collect():
        for size in (6, 12, 25, 60, 200):
            at = rng.randrange(max(1, len(r["text"]) - size))
            rows.append((len(rows), r["text"][at : at + size], r["lang"]))
    model = language.fit_language_model(docs)
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    got = df.select("truth", language._predict(model)("text").alias("p")).select("truth", "p.*").filter("lang_pred != 'und'").collect()
    for low, high in ((0.25, 0.7), (0.7, 0.95), (0.95, 1.01)):
        part = [r for r in got if low <= r["score"] < high]
        assert len(part) > 20 and abs(sum(r["score"] for r in part) / len(part) - sum(r["lang_pred"] == r["truth"] for r in part) / len(part)) < 0.1
    wrong = lambda rows: sum(r["lang_pred"] != r["truth"] for r in rows) / max(1, len(rows))
    assert wrong([r for r in got if r["score"] < model.reject_below]) > wrong([r for r in got if r["score"] >= model.reject_below])


def test_snippets_come_from_anywhere():
    data = np.arange(10_000) % 251
    spans = [language.snippet(data.astype(np.uint8), 0, n) for n in range(5000, 6000)]
    assert all(0 <= a < b <= n for (a, b), n in zip(spans, range(5000, 6000))) and np.std([a for a, _ in spans]) > 1000


def test_long_text_in_pieces(monkeypatch):
    """A text gone through in pieces has the buckets of the whole."""
    data = np.frombuffer(random.Random(23).randbytes(5000), np.uint8)
    whole = language.histogram(data)
    monkeypatch.setattr(language, "SCORE_BYTES", 97)
    assert (language.histogram(data) == whole).all() and whole.sum() == sum(len(data) - n + 1 for n in language.SIZES)


def test_language_learns_from_its_fold_only(docs):
    """Labels of held-out rows change nothing."""
    false = docs.withColumn("lang", F.when(language.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    a, b = language.fit_language_model(docs), language.fit_language_model(false)
    assert a.langs == b.langs and np.array_equal(a.table, b.table)


def test_html():
    page = "<body><nav>m</nav><div class='side-bar ad'>x</div><article><h1>H &amp; h</h1><p>a <b>b</b><br>c<p>d<script>no()</script>e<ul><li>1<li>2</ul><section id=comments><p>troll</section></article><footer>f</footer>"
    assert html_text.main_text(page) == "H & h\n\na b c\n\nde\n\n1\n\n2"
    kept = {
        '<div class="layout has-sidebar"><p>body text</p></div>': "body text",
        '<div class="social-science"><p>t</p></div>': "t",
        '<div class="sidebar"><p>all there is</p></div>': "all there is",
        '<p title="hidden costs">one</p><div data-hidden="false">two</div>': "one\n\ntwo",
        "<p>a <span hidden>x <span>y</span> z</span> b</p><p style='display: none'>c</p>": "a b",
        "<p>a <img src=x> b<!-- c --> d</p><hr>e<article": "a b d\n\ne",
        "<p a='>z</p>": "z",
        "<div><i>" * 3000 + "deep<nav>menu</nav>": "deep",
    }
    assert {p: html_text.main_text(p) for p in kept} == kept
    for bad in ("", "<", "<p", "a<b", "<!-- x", "<b></i></u>t"):
        html_text.main_text(bad)


def test_broken_pages_take_linear_time():
    import time

    for unit in ("<script ", "<a ", '<p "', "<p a='", "<div>", "<x>", "</x>", "<li>", "<p>t", "<h2>a</h2><p>b</p><ul><li>c</ul>", "<!--", '<p a="b'):
        began = time.process_time()
        html_text.main_text(unit * (300_000 // len(unit)))
        assert time.process_time() - began < 5, unit


def test_wrappers_take_in_their_pages():
    fold = lambda *pages: html_text.fold([html_text.Page(p).skeleton for p in pages])
    wrapper = fold("<div><h1>a</h1><p>b</p></div>", "<div><p>b</p><p>c</p></div>", "<div><h1>a</h1><ul><li>x</ul></div>")
    assert wrapper == "div(h1(#)? p(#)+? ul(li(#))?)" and html_text.write(html_text.read(wrapper)) == wrapper
    rows = "<h2>a</h2><p>b</p><p>c</p>" * 30
    assert fold(rows, "<h2>a</h2><ul><li>x</ul>" * 40, "<h1>t</h1>" + rows) == "h1(#)? (h2(#) p(#)+)+? (h2(#) ul(li(#)))+?"
    many = "".join(f"<{x}>t</{x}>" for x in random.Random(17).choices(["h2", "p", "ul", "pre", "table"], k=600))
    skeleton = html_text.Page(many).skeleton
    assert html_text.write(html_text.align(html_text.read(skeleton), html_text.read(skeleton + " div(#)"))) == skeleton + " div(#)?"


def site(rng, n, article="div", menu="div"):
    """Pages of one host without telling names: menu, notice, article, footer; and the articles' texts."""
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    say = lambda k: " ".join(rng.choices(words, k=k))
    names = {x: "".join(rng.choices("qrstuvw", k=7)) for x in ("menu", "note", "text", "end", "page")}
    pages, texts = [], []
    for i in range(n):
        title, paragraphs = say(6), [say(rng.randrange(5, 120)) for _ in range(rng.randrange(1, 6))]
        links = "".join(f"<a href=/{x}>{x}</a> " for x in rng.choices(words, k=rng.randrange(3, 9)))
        note = "<p>We keep this notice on all of our pages for you.</p>" if i % 10 else ""
        own = f"<div class={''.join(rng.choices('xyz', k=9))}></div>"
        pages.append(f"<body><{menu} class={names['menu']}>{links}</{menu}>{own}<div class='{names['page']} post-{i}'><{article} class={names['text']}>{note}<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</{article}></div><div class={names['end']}>{say(4)}</div>")
        texts.append("\n\n".join([title, *paragraphs]))
    return pages, texts


def test_wrappers_decide(spark):
    """Without names that tell, an article comes out by its host's wrapper, and not without it."""
    rng = random.Random(18)
    rows, wanted, alone = [], {}, 0
    for h in range(3):
        pages, texts_ = site(rng, 60)
        for p, t in zip(pages, texts_):
            alone += html_text.main_text(p) == t
            wanted[len(rows)] = t
            rows.append((len(rows), f"https://h{h}.example/{len(rows)}", p))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()}
    assert got == wanted and alone < 0.3 * len(rows)
    rules = [html_text.Rule.of([html_text.Page(p) for _, u, p in rows if f"h{h}." in u]) for h in range(3)]
    assert [html_text.main_text(p, rules[int(u[9])]) for _, u, p in rows] == list(wanted.values())


def test_rules_in_rounds_and_shuffled(spark, monkeypatch):
    """Skeletons folded in several rounds, and rules that are too many to broadcast, give the same texts."""
    from clonespark.llm import common

    pages, texts_ = site(random.Random(19), 50)
    df = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    monkeypatch.setattr(html_text, "FOLD", 4)
    monkeypatch.setattr(html_text, "fits", lambda df: False)
    monkeypatch.setattr(common, "fits", lambda df: False)
    assert {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()} == dict(enumerate(texts_))


def test_pages_without_an_article_where_others_have_one():
    pages, texts_ = site(random.Random(20), 30, "article", "nav")
    rule = html_text.Rule.of([html_text.Page(p) for p in pages])
    assert rule.in_article and [html_text.main_text(p, rule).split("\n\n")[-1] for p in pages] == [t.split("\n\n")[-1] for t in texts_]
    assert html_text.main_text("<nav>a</nav><div><p>b</p></div>", rule) == "b"


def test_extract_text(spark):
    p = spark.read.parquet(f"{DATA}/pages.parquet")
    import html

    source = {r["page_id"]: r["html"] for r in p.collect()}
    for r in html_text.extract_text(p).collect():
        article = re.search(r"<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", " " if "br" in x else "", x))).strip() for x in re.split(r"</?(?:h1|p)>", article.replace("<br>", " "))]
        assert r["text"] == "\n\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, None, None), (None, "x", "<p>a</p>"), (1, "http://h/1", ""), (1, "http://h/1", "")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(r["text"] for r in html_text.extract_text(odd).collect()) == ["", "", "", "a"]
    assert html_text.extract_text(odd.limit(0)).count() == 0


def test_licenses(spark, docs, odd, empty):
    def base(t):
        w = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())]
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))

    more = [(9000, "Under the MIT License, cc by-nc; CC BY NC"), (9001, "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and associated documentation files"), (9002, "the license apache"), (9003, "under the mit license " * 300)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in licenses.license_scan(df).collect()}
    assert {i: tuple(r)[1:6] for i, r in got.items()} == {i: base(x) for i, x in texts(df).items()}
    assert got[9001]["labels"] == "mit" and 0.8 <= got[9001]["score"] <= 1 and got[9002]["labels"] == "" and got[9003]["n_base"] == 300
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"] for r in got.values())
    assert sorted(r["n_words"] for r in licenses.license_scan(odd).collect()) == sorted(base(t)[0] for t in ODD)
    assert licenses.license_scan(empty).count() == 0


def test_many_notices_take_no_square(spark):
    import time

    began = time.process_time()
    held = licenses.spans(licenses.templates(), [{"template": len(licenses.templates()) - 1, "diagonal": 3 * i, "votes": 1, "positions": [0]} for i in range(40_000)])
    assert len(held) == 40_000 and time.process_time() - began < 5


def brute_notices(t):
    """Labels by a plain search: spans of a notice's words in order, with little between them."""
    words = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())]
    labels = {label for p, label in licenses.PHRASES.items() if f" {p} " in f" {' '.join(words)} "}
    line = f" {' '.join(words)} "
    return labels | {label for label, text in licenses.NOTICES if f" {text} " in line}


def test_license_labels_hold_whole_notices(spark, docs):
    """Every notice that stands in a text word for word has its label unless a longer notice covers it, and no text without most of a notice's words has one."""
    rng = random.Random(24)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(500)]
    rows, wanted = [], {}
    for i, (label, text) in enumerate(licenses.NOTICES * 3):
        w = text.split()
        if i >= len(licenses.NOTICES):  # a word put in or left out
            if i % 2 or len(w) < 8:
                w.insert(rng.randrange(1, len(w)) if len(w) > 8 else 0, "odd")
            else:
                del w[len(w) // 2]
        rows.append((i, " ".join(rng.choices(words, k=40) + w + rng.choices(words, k=30)).upper()))
        wanted[i] = label
    rows += [(1000 + i, " ".join(rng.choices(words, k=60) + t.split()[: len(t.split()) // 2] + rng.choices(words, k=9))) for i, (_, t) in enumerate(licenses.NOTICES) if len(t.split()) > 10]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(df).collect()}
    assert {i: x for i, x in got.items() if i < 1000} == wanted and {x for i, x in got.items() if i >= 1000} == {""}
    for r in licenses.license_scan(docs).collect():
        assert brute_notices(texts(docs)[r["doc_id"]]) <= set(r["labels"].split(",")) if r["labels"] else not brute_notices(texts(docs)[r["doc_id"]])


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 16))[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 16)) * 0.02
    x *= rng.uniform(0.5, 2, (1500, 1))
    x[::7] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [float("nan")] * 16), (5002, [1.0] * 4), (5003, []), (None, [1.0] * 16), (5050, [float("inf")] * 16), (100, x[100].tolist()), (5100, [1e30] * 16), (5150, [0.0] * 16), (5200, [None] * 16)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")

    def whole(v):
        return None if v is None or any(y is None or not math.isfinite(y) for y in v) else [max(-(2**63), min(2**63 - 1, math.floor(256 * y))) for y in v]

    vectors = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    wanted = {}
    for i, v in vectors:
        if i % 50 == 0:
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in vectors if j != i)[:5]
            wanted[i] = [(k + 1, j, -s) for k, (s, j) in enumerate(scores)]
    for bucket, piece in ((16_384, 1024), (300, 64)):
        monkeypatch.setattr(search, "BUCKET_ROWS", bucket)
        monkeypatch.setattr(search, "SLICE_ROWS", piece)
        got = collections.defaultdict(list)
        for r in search.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(tuple(r)[1:])
        assert got == wanted
    assert search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert search.top_k(df.filter("vec_id < 3"), F.col("vec_id") == 0).count() == 2


def test_top_k_moves_what_survives(spark, monkeypatch):
    """Blocks go only to buckets that are long enough for them; what they find is the same."""
    rng = np.random.default_rng(26)
    x = rng.normal(size=(3000, 8)) * np.where(np.arange(3000) < 300, 8, 1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(search, "BUCKET_ROWS", 150)
    monkeypatch.setattr(search, "BLOCK_QUERIES", 10)
    seen, own = {}, search.reached

    def counted(first, buckets):
        out = own(first, buckets)
        seen["pairs"], seen["all"] = out.count(), first.count() * buckets.select("bucket").distinct().count()
        return out

    monkeypatch.setattr(search, "reached", counted)
    whole = np.floor(256 * x).astype(np.int64)
    got = collections.defaultdict(list)
    for r in search.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for i in range(0, 3000, 50):
        scores = whole @ whole[i]
        best = sorted((int(-s), j) for j, s in enumerate(scores) if j != i)[:5]
        assert got[i] == [(j, -s) for s, j in best]
    assert 0 < seen["pairs"] < 0.5 * seen["all"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    wanted = con.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(map(tuple, QUERIES[name](spark, DATA).select(*columns).collect())) == sorted(wanted.fetchall())


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op7", "op10"])
def test_long_texts_take_bounded_memory(name):
    """What numpy and Python hold beside a text of 8 MB, at the most."""
    import tracemalloc

    import pyarrow as pa

    from clonespark.llm.words import blocks

    rng = random.Random(29)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 10))) for _ in range(20_000)]
    unit = (" ".join(rng.choices(words, k=100_000)) + "\n").encode()
    text = (unit * (8 * 2**20 // len(unit) + 1))[: 8 * 2**20]
    array = pa.array([text], pa.binary())
    (block,) = blocks(array)
    model = language.LanguageModel(["a", "b", "c", "d"], np.ones((language.BUCKETS, 4), np.float32), np.zeros(4))
    domains = mixing.DomainModel(["a", "b"], np.zeros((mixing.BUCKETS, 2)), np.zeros((7, 2)))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), array], names=["key", "text"])
    work = {
        "op1": lambda: (language.letters(block), model.scores(block)),
        "op3": lambda: domains.posteriors(block),
        "op4": lambda: simhash._signature(simhash.shingle_hashes(text, 3), 1),
        "op5": lambda: lm_score.word_hashes(block),
        "op7": lambda: quality._all_features(array),
        "op10": lambda: [len(x[1]) for x in licenses._rolling(np.array([1]))(batch)],
    }
    tracemalloc.start()
    work[name]()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 250 * 2**20


def test_lm_score(spark, docs, odd, empty):
    got = {r["doc_id"]: r for r in lm_score.pseudo_likelihood(docs).collect()}
    t = texts(docs)
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", x)) for i, x in t.items()}
    assert all(r["log_prob"] < 0 for r in got.values() if r["n_tokens"])
    # the order of words counts: shuffled texts are less likely
    longest = sorted(t.items(), key=lambda r: -len(r[1]))[:40]
    words = lm_score.lexicon(lm_score.word_counts(docs))
    net = lm_score.train(docs, words, rounds=2)
    from clonespark.llm.words import blocks
    import pyarrow as pa

    rng = random.Random(8)
    score = lambda xs: np.concatenate([lm_score.score(net, words, b)[1] for b in blocks(pa.array(xs))])
    real, mixed = score([x for _, x in longest]), score([" ".join(rng.sample(x.split(), len(x.split()))) for _, x in longest])
    assert (real > mixed).mean() >= 0.8
    out = lm_score.pseudo_likelihood(odd).collect()
    assert len(out) == len(ODD) and all((r["mean_log_prob"] is None) == (r["n_tokens"] == 0) for r in out)
    assert lm_score.pseudo_likelihood(empty).count() == 0


def test_lm_brute_force(spark):
    """Probabilities of each place, one by one, by a plain model of the same weights; of all words they add up to one."""
    from clonespark.llm.words import blocks
    import pyarrow as pa

    rng = random.Random(27)
    kinds = [f"w{i}" for i in range(60)]
    df = spark.createDataFrame([(i, " ".join(rng.choices(kinds, weights=range(1, 61), k=50))) for i in range(80)], "doc_id long, text string")
    counts = {r["hash"]: r["n"] for r in lm_score.word_counts(df).collect()}
    words = lm_score.lexicon(lm_score.word_counts(df), 20)
    net = lm_score.train(df, words)

    def predicted(before, after):
        """Probability of each kind of word between two words on either side."""
        near = [lm_score.word_hashes(b) for b in blocks(pa.array([" ".join(before + after)]))][0]
        ids = words.ids(near).tolist()
        h = np.zeros(lm_score.HIDDEN)
        for k, i in enumerate(ids):
            h += net.table[k * (words.size + 1) + i]
        h = np.tanh(h)
        e = np.exp(net.classes.astype(float) @ h + net.bias + net.log_class)
        of_class = e / e.sum()
        out = {}
        for kind, key in zip(kinds, lm_score.word_hashes(next(blocks(pa.array([" ".join(kinds)])))).tolist()):
            i = int(words.ids(np.array([key]))[0])
            e = np.exp(net.cells[words.class_of[i]].astype(float) @ h + net.biases[words.class_of[i]] + net.log_cell[words.class_of[i]])
            out[kind] = of_class[words.class_of[i]] * (e / e.sum())[words.cell_of[i]] * counts[key] / np.exp(words.log_mass[i])
        return out

    p = predicted(["w9", "w50"], ["w3", "w59"])
    assert 0.9 < sum(p.values()) <= 1 + 1e-6  # the rest is what groups without a word are given
    scores = {}
    for kind in kinds:
        (block,) = blocks(pa.array([f"w9 w50 {kind} w3 w59"]))
        hashes = lm_score.word_hashes(block)
        ids = words.ids(hashes)
        logs = net.log_probabilities(net.context(ids, block.text, np.array([2])), words.class_of[ids[2:3]], words.cell_of[ids[2:3]])[0]
        scores[kind] = math.exp(logs) * counts[int(hashes[2])] / math.exp(words.log_mass[ids[2]])
    assert all(math.isclose(scores[k], p[k], rel_tol=1e-3) for k in kinds)


def test_lm_gradient(spark, monkeypatch):
    """A step goes down the slope of the summed log-probabilities, as differences of them tell."""
    monkeypatch.setattr(lm_score, "OTHERS", 13)
    hashes = np.sort(np.random.default_rng(1).integers(-(2**62), 2**62, 12))
    words = lm_score.Lexicon(hashes, np.random.default_rng(2).permutation(25), np.log(np.arange(1.0, 26)))
    net = lm_score.Network(words)
    rng = np.random.default_rng(3)
    ids, owner = rng.integers(0, 25, 40), np.repeat([0, 1], 20)
    context, classes, cells = net.context(ids, owner, np.arange(40)), words.class_of[ids], words.cell_of[ids]
    loss = lambda rows: -net_of(rows).log_probabilities(context, classes, cells).sum()
    net_of = lambda rows: lm_score.Network(words, rows)
    grads = {}

    def step(rows, grad, count):
        at = np.arange(len(net.rows))[rows] if isinstance(rows, slice) else rows
        grads.update(zip(at.tolist(), grad))

    monkeypatch.setattr(net, "_step", step)
    net.learn(context, classes, cells)
    for row in rng.choice(sorted(grads), 60):
        for h in (0, 7, 15):
            up, down = net.rows.copy(), net.rows.copy()
            up[row, h] += 0.05
            down[row, h] -= 0.05
            assert abs((loss(up) - loss(down)) / 0.1 - grads[row][h]) < 0.02 + 0.02 * abs(grads[row][h])


def test_lm_sees_context(spark):
    """Rare words, too, are likelier where they belong."""
    rng = random.Random(28)
    pairs = [("".join(rng.choices("abcd", k=6)), "".join(rng.choices("efgh", k=6))) for _ in range(40)]
    rows = [(i, " ".join(x for _ in range(40) for x in rng.choice(pairs))) for i in range(300)]
    wrong = [(1000 + i, " ".join(y for _ in range(40) for y in (rng.choice(pairs)[0], rng.choice(pairs)[1]))) for i in range(20)]
    df = spark.createDataFrame(rows + wrong, "doc_id long, text string")
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm_score.pseudo_likelihood(df, vocabulary=10, rounds=6).collect()}
    right, other = [got[i] for i, _ in rows], [got[i] for i, _ in wrong]
    assert sum(right) / len(right) > sum(other) / len(other) + 0.3


def test_lm_ids(monkeypatch):
    """Ids come out whatever the tables have room for."""
    hashes = np.sort(np.random.default_rng(4).integers(-(2**62), 2**62, 300))
    asked = np.concatenate((hashes, hashes + 1))
    for slots in (1 << 18, 64):
        monkeypatch.setattr(lm_score, "SLOTS", slots)
        words = lm_score.Lexicon(hashes, np.arange(300 + lm_score.OTHERS), np.zeros(300 + lm_score.OTHERS))
        assert (words.ids(asked)[:300] == np.arange(300)).all() and (words.ids(asked)[300:] >= 300).all()


def test_lm_words_have_their_own_counts(spark, monkeypatch):
    """Words without an id of their own that share a group differ by their counts."""
    from clonespark.llm.words import blocks, mix
    import pyarrow as pa

    kinds = [f"w{i}" for i in range(300)]
    (block,) = blocks(pa.array([" ".join(kinds)]))
    group = mix(lm_score.word_hashes(block).astype(np.uint64)) % np.uint64(lm_score.OTHERS)
    a, b = [k for k, g in zip(kinds, group) if g == group[0]][:2]
    df = spark.createDataFrame([(1, a), (2, b), *((3 + i, "the of " * 20 + a) for i in range(4)), (None, a)], "doc_id long, text string")
    for kinds in (1000, 0):
        monkeypatch.setattr(lm_score, "BROADCAST_KINDS", kinds, raising=False)
        got = {r["doc_id"]: r["log_prob"] for r in lm_score.pseudo_likelihood(df, vocabulary=2).collect()}
        assert math.isclose(got[1] - got[2], math.log(6), rel_tol=1e-6) and got[None] == got[1] and len(got) == 7


def test_lm_trains_on_every_place(docs):
    import pyarrow as pa

    words = lm_score.lexicon(lm_score.word_counts(docs))
    sample = [x for _, x in sorted(texts(docs).items())[:20]]
    batch = pa.RecordBatch.from_arrays([pa.array([x.encode() for x in sample])], names=["text"])
    seen = 0
    for turn in range(lm_score.ROUNDS):
        rows = {r: s for b in lm_score._train(words, None, turn)(iter([batch])) for r, s in zip(b["row"].to_pylist(), b["seen"].to_pylist())}
        seen += rows[max(rows)]  # a row of biases, which every masked place moves
    assert seen == sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in sample)


def nearest_rates(p, n, target, steps=100_000):
    """Plain projected gradient on nonnegative rates, by itself."""
    a = (p * n[:, None]).T / n.sum()
    scale, w = np.linalg.pinv(a @ p), np.ones(len(p))
    for _ in range(steps):
        new = np.maximum(w - p @ (scale @ (a @ w - target)), 0)
        if np.abs(new - w).max() < 1e-10:
            break
        w = new
    return a @ w


def test_mixing(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    labels = mixing.quality_domains(labels)
    for targets in ({"q1_t0": 0.4, "q0_t0": 0.3, "q1_t1": 0.2, "q0_t1": 0.1}, {"q1_t0": 0.2, "q0_t0": 0.6, "q1_t1": 0.2}, None):
        got = mixing.mixture(docs, labels, targets).collect()
        n = np.array([r["n_tokens"] for r in got], float)
        names = sorted(got[0]["posteriors"])
        p = np.array([[r["posteriors"][k] for k in names] for r in got])
        w = np.array([r["rate"] for r in got])
        assert (w >= 0).all() and np.allclose(p.sum(1), 1)
        share, said = (w * n) @ p / n.sum(), got[0]["shares"]
        given = np.array([(targets or mixing.TARGETS).get(k, 0.0) for k in names])
        assert np.allclose(share, [said[k]["attained"] for k in names], atol=1e-6) and np.allclose(given / given.sum(), [said[k]["target"] for k in names])
        best = nearest_rates(p[n > 0], n[n > 0], given / given.sum())
        assert np.abs(share - best).max() < 0.005 and (targets is None or len(targets) < 4 or np.abs(share - given).max() < 1e-3)
    capped = mixing.mixture(docs, labels, {"q1_t0": 0.2, "q0_t0": 0.6, "q1_t1": 0.2}, most=3.0).collect()
    assert 2.5 < max(r["rate"] for r in capped) <= 3.0 and capped[0]["shares"]["q0_t0"]["attained"] < 0.5
    out = mixing.mixed(docs, labels, targets, copy_col="copy")
    assert out.count() == sum(r["copies"] for r in got) and out.select("doc_id", "copy").distinct().count() <= out.count()
    assert {r["rate"] for r in mixing.mixture(odd, labels.limit(0)).collect()} == {1.0}
    assert mixing.mixture(empty, labels).count() == 0 and mixing.mixed(empty, labels).columns == empty.columns
    assert mixing.mixture(docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 900_000)), labels).count() == docs.count() + len(ODD)


def test_rows_without_ids_draw_by_their_texts(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(2000)], "doc_id long, text string").repartition(5)
    n = df.select(mixing.copies(F.lit(1.5), mixing._draw("doc_id", "text")).alias("n")).agg(F.sum("n")).first()[0]
    assert 2900 < n < 3100


def test_rates_meet_feasible_targets(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.3, 0.3, 0.3], 3000)
    n = rng.integers(0, 500, 3000)
    df = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n)], "p array<double>, n_tokens long")
    for target in ([0.6, 0.3, 0.1], [0.98, 0.01, 0.01], [0.05, 0.05, 0.9]):
        rates = mixing.fit_rates(df, np.array(target))
        w = rates.of(p, n)
        assert (w >= 0).all() and np.allclose((w * n) @ p / n.sum(), target, atol=2e-3) and np.allclose(rates.attained, (w * n) @ p / n.sum())


def test_pipeline(spark, docs):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    kept, columns = docs, docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, kept, DATA)
        if i < len(names) - 1:
            assert kept.columns == columns
            rows = kept.collect()
            kept = spark.createDataFrame(rows, docs.schema)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.byte_pairs(RANKS, P.PATTERN).ranks, special_tokens={})
    t = texts(docs)
    out = kept.collect()
    assert out and all(r["ids"] == library.encode_ordinary(t[r["doc_id"]]) for r in out)
    assert corpus_pipeline.run(spark, DATA).count() == len(out)


def test_pattern_classes_agree():
    """The pattern splits as the tokenizer's own engine does, for every character."""
    ours = bpe.byte_pairs(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    sample = [f"a{chr(c)}1 {chr(c)}{chr(c)}. {chr(c)}z" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert [x.tolist() for x in ours.encode(sample)] == library.encode_ordinary_batch(sample)
    assert regex.findall(P.PATTERN, "a b") == ["a", " b"]
