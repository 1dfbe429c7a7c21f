"""Soft-membership mixing of documents to target weights of domains.

A classifier, fitted to a table of labelled documents, gives each document a probability for each domain. Projected-gradient least
squares then finds rates, one for each document and none negative, such that the expected tokens of each domain meet their
targets. A rate is how many times a document is to be taken on average.

With p the posteriors and n the tokens of documents, the tokens of domain k at rates w are A w = sum of n w p_k. A step from rates of one along
the gradient, projected on what rates may be, is w = max(0, 1 - p . l): of all rates that attain their totals these lie nearest to one, if l
is right. l, a number for each domain, moves against the gradient of the miss, A w - target, scaled by G^-1, where G is the sum of n p p' over the
documents whose rate isn't clipped: so a step meets the targets but for the rates that it clips itself, and is halved while it doesn't come
nearer. An iteration needs only sums from all documents, a number for each domain and pair of domains, and l is all that it takes to compute any
document's rate. What totals the rates attain is reported beside the targets; targets that no rates can meet are met as closely as EASE makes worth it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import column_function, map_batches, utf8
from clonespark.llm.words import LOWER, Block, blocks
from clonespark.scratch import Scratch

#: Labelled documents that the classifier is fitted to, shared evenly among the domains.
SAMPLE_DOCS = 6000
BUCKETS = 1 << 15
#: A word counts if a likelihood-ratio test (G, one degree of freedom) tells that it goes with a domain, or against it.
LEAST_G = 20.0
MARKS = [np.isin(np.arange(256), list(x)) for x in (b"#*$%&|<>", b"!", bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A)))]
#: Steps at most, and the largest miss of a domain, as a share of all tokens, at which they end.
ITERATIONS, TOLERANCE = 60, 1e-5
#: What moving rates off one costs beside missing targets, both as mean squares: keeps rates finite where targets can't be met.
EASE = 1e-5


def _parts(block: Block):
    """Of each word its text and bucket, and of each text shares of some kinds of characters."""
    shape = np.stack([block.per_text(m[block.data]) for m in MARKS], 1) / np.maximum(np.diff(block.offsets), 1)[:, None]
    block.data = LOWER[block.data]
    letters = np.isin(np.arange(256), [*range(0x61, 0x7B), *range(0x80, 0x100)])
    block.split(letters)
    bucket = (block.hashes() & np.uint64(BUCKETS - 1)).astype(np.int64)
    return bucket, np.minimum(shape * 10, 1)


def _tokens(block: Block) -> np.ndarray:
    block.split()
    return block.counts


@dataclass
class DomainModel:
    domains: list[str]
    odds: np.ndarray  # BUCKETS x domains
    layer: np.ndarray  # features x domains, the last row being the bias

    def posteriors(self, block: Block) -> np.ndarray:
        bucket, shape = _parts(block)
        pairs = np.unique(block.text * BUCKETS + bucket)
        text, bucket = pairs // BUCKETS, pairs % BUCKETS
        sums = np.stack([np.bincount(text, self.odds[bucket, k], block.n) for k in range(len(self.domains))], 1)
        return softmax(features(sums, shape) @ self.layer)


def features(sums: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.hstack((np.tanh(sums / 4), shape, np.ones((len(shape), 1))))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_domains(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", sample: int = SAMPLE_DOCS, least_share: float = 0.0) -> DomainModel | None:
    """Fit to about `sample` documents that `labelled` (id_col, domain_col) names, chosen by a hash of the id, of all domains alike.

    Only sets of buckets come to the driver, at most 2 * BUCKETS bytes each. None if no document is labelled. least_share: domains with a smaller
    share of the labelled documents are left out (none by default).
    """
    known = labelled.select(F.col(id_col).alias("_id"), F.col(domain_col).cast("string").alias("_domain")).filter("_id IS NOT NULL AND _domain IS NOT NULL")
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counts = {r["_domain"]: r["count"] for r in known.join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi").groupBy("_domain").count().collect()}
    counts = {d: n for d, n in counts.items() if n >= least_share * sum(counts.values())}
    if not counts:
        return None
    domains, quota = sorted(counts), max(50, sample // len(counts))
    rate = F.create_map(*(F.lit(x) for k in domains for x in (k, min(1.0, quota / counts[k]))))
    draw = F.pmod(F.xxhash64("_id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter((draw < F.coalesce(F.element_at(rate, F.col("_domain")), F.lit(0.0))))
    # About `sample` ids and domains, whatever the input: broadcast, so that no text is shuffled to find them.
    rows = ids.join(F.broadcast(chosen), "_id").select(utf8("_text"), "_domain", F.pmod(F.xxhash64("_id", F.lit(30)), F.lit(2)).cast("int").alias("_half"))

    def run(batch: pa.RecordBatch):
        sets, shapes = [], []
        for block in blocks(batch.column(0)):
            bucket, shape = _parts(block)
            begin = np.searchsorted(block.text, np.arange(block.n + 1))
            sets += [np.unique(bucket[a:b]).astype(np.uint16).tobytes() for a, b in zip(begin[:-1], begin[1:])]
            shapes += shape.tolist()
        return batch.column(1), batch.column(2), sets, shapes

    data = map_batches(rows, run, "domain string, half int, buckets binary, shape array<double>").collect()
    data.sort(key=lambda r: (r["domain"], r["half"], bytes(r["buckets"])))
    return train(domains, np.array([counts[d] for d in domains], float), [(domains.index(r["domain"]), r["half"], np.frombuffer(r["buckets"], np.uint16).astype(np.int64), r["shape"]) for r in data])


def train(domains: list[str], prior: np.ndarray, data: list[tuple[int, int, np.ndarray, list[float]]], steps: int = 800) -> DomainModel:
    """Log-odds of words from one half of the rows, and a softmax layer over their sums from the other.

    The rows are of all domains alike; the bias makes up for it, by how often the domains are labelled (prior).
    """
    k = len(domains)
    first = [x for x in data if x[1] == 0] or data
    second = [x for x in data if x[1] == 1] or data
    docs, having = np.zeros(k), np.zeros((BUCKETS, k))
    for domain, _, buckets, _ in first:
        docs[domain] += 1
        having[buckets, domain] += 1
    p = (having + 0.5) / (docs + 1)
    rest = (having.sum(1, keepdims=True) - having + 0.5) / (docs.sum() - docs + 1)
    odds = np.log(p / rest)
    odds[_g_test(having, docs) < LEAST_G] = 0
    x = features(np.array([odds[b].sum(0) for _, _, b, _ in second]).reshape(-1, k), np.array([s for *_, s in second]).reshape(len(second), -1))
    y = np.eye(k)[[d for d, *_ in second]]
    layer = np.zeros((x.shape[1], k))
    squares = np.full_like(layer, 1e-8)
    for _ in range(steps):
        grad = x.T @ (softmax(x @ layer) - y) / max(len(x), 1) + 1e-4 * layer
        squares += grad * grad
        layer -= 0.5 * grad / np.sqrt(squares)
    layer[-1] += np.log(prior / prior.sum()) - np.log((y.sum(0) + 1) / (len(y) + k))
    return DomainModel(domains, odds, layer)


def _g_test(having: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each word and domain, how far the documents with and without the word are from independent of the domain."""
    with_word, total = having.sum(1, keepdims=True), docs.sum()
    out = np.zeros_like(having)
    for word, count in ((having, with_word), (docs - having, total - with_word)):
        for seen, size in ((word, docs), (count - word, total - docs)):
            expected = count * size / max(total, 1)
            out += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return 2 * out


@dataclass
class Rates:
    """The multiplier of each domain; most: the greatest rate, if there is one. And shares of tokens by domain."""

    multipliers: np.ndarray
    most: float = np.inf
    target: np.ndarray | None = None
    present: np.ndarray | None = None
    attained: np.ndarray | None = None

    def of(self, posteriors: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens > 0, np.clip(1 - posteriors @ self.multipliers, 0, self.most), 1.0)


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, k)


def _totals(posteriors: DataFrame, rates: Rates, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens of each domain at the rates, G over the documents whose rate isn't clipped, and the part of the objective that is summed over documents."""

    def sums(batch: pa.RecordBatch):
        p, n = _matrix(batch.column(0), k), batch.column(1).to_numpy().astype(float)
        z = 1 - p @ rates.multipliers
        w = np.clip(z, 0, rates.most)
        free = (w > 0) & (w < rates.most)
        return list(range(k + k * k + 1)), np.concatenate(((w * n) @ p, (p[free].T @ (p[free] * n[free, None])).ravel(), [n @ (w * np.maximum(z, 0) - w * w / 2)]))

    out = np.zeros(k + k * k + 1)
    for r in map_batches(posteriors.select("p", "n_tokens"), sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out[:k], out[k:-1].reshape(k, k), float(out[-1])


def fit_rates(posteriors: DataFrame, targets: np.ndarray, *, iterations: int = ITERATIONS, tolerance: float = TOLERANCE, ease: float = EASE, most: float | None = None) -> Rates:
    """Least squares over a table of p (array<double>) and n_tokens. A few numbers for each batch are summed by Spark.

    targets: shares of all tokens, brought to a sum of one. most: no rate exceeds it (by default there is no such bound).
    """
    k, rates = len(targets), Rates(np.zeros(len(targets)), np.inf if most is None else most)
    held, gram, cost = _totals(posteriors, rates, k)
    total, whole = held.sum(), gram  # posteriors add up to one
    if total <= 0:
        return rates
    wanted = targets / targets.sum() * total
    rates.target, rates.present, rates.attained = wanted / total, held / total, held / total
    objective = lambda cost, x: cost + x @ wanted + ease / 2 * x @ whole @ x
    best = objective(cost, rates.multipliers)
    for _ in range(iterations):
        gradient = wanted - held + ease * whole @ rates.multipliers
        if min(np.abs(held - wanted).max(), np.abs(gradient).max() * 10) <= tolerance * total:
            break
        step = -np.linalg.pinv(gram + ease * whole, rcond=1e-14, hermitian=True) @ gradient
        for size in 0.5 ** np.arange(12):
            new = Rates(rates.multipliers + size * step, rates.most, rates.target, rates.present)
            held_new, gram_new, cost_new = _totals(posteriors, new, k)
            if objective(cost_new, new.multipliers) <= best + 1e-4 * size * (gradient @ step):
                break
        else:
            break
        rates, held, gram, best = new, held_new, gram_new, objective(cost_new, new.multipliers)
        rates.attained = held / total
    return rates


#: Shares of tokens by default: few of low quality, fewer toxic ones.
TARGETS = {"q1_t0": 0.94, "q1_t1": 0.02, "q0_t0": 0.03, "q0_t1": 0.01}


def quality_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain (q1_t0: of quality, not toxic) from a table of labels."""
    return labels.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("_t"), F.col("toxic").cast("string")).alias("domain"))


def toxicity_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain (clean or toxic) from a table of labels."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean").alias("domain"))


def _posteriors(model: DomainModel):
    """A column function: p and n_tokens of texts."""

    def run(texts: pa.Array):
        p, n = [], []
        for block in blocks(texts):
            n.append(_tokens(Block(block.first, block.data, block.offsets)))
            p.append(model.posteriors(block))
        p, k = np.concatenate(p), len(model.domains)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * k), pa.array(p.ravel())), np.concatenate(n)]

    return column_function(run, "struct<p: array<double>, n_tokens: bigint>")


def _rate(rates: Rates) -> Column:
    """The rate of a row with p and n_tokens, in the JVM."""
    each = F.array(*map(F.lit, rates.multipliers.tolist()))
    dot = F.aggregate(F.zip_with("p", each, lambda x, y: x * y), F.lit(0.0), lambda a, b: a + b)
    return F.when(F.col("n_tokens") > 0, F.least(F.greatest(1 - dot, F.lit(0.0)), F.lit(float(rates.most)))).otherwise(1.0)


def _solved(posteriors: DataFrame, domains: list[str], targets: dict[str, float], most: float | None) -> Rates:
    given = np.array([max(targets.get(d, 0.0), 0.0) for d in domains])
    return fit_rates(posteriors, given if given.sum() else np.ones(len(domains)), most=most)


def copies(rate: Column, draw: Column) -> Column:
    """Whole copies for a rate: its floor, and one more for as many rows, by their draw, as its fraction says."""
    return F.floor(rate + F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)).cast("bigint")


def _draw(id_col: str, text_col: str) -> Column:
    """A hash of id and text, so that rows without an id don't share one."""
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit(31))


def mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS, most: float | None = None, least_share: float = 0.0) -> DataFrame:
    """Rates of all documents at which the domains' expected shares of tokens meet the targets.

    labelled: id_col and domain. targets: shares by domain, brought to a sum of one over the domains that are labelled; TARGETS by
    default. The expected total stays that of docs. Returns id_col, n_tokens (words), domain (the likeliest), posteriors
    (by name), rate, copies, and shares, the same in every row: by domain its target, present and attained share of the tokens. Without labelled
    documents the domain is null and all rates are one, as is that of a text without words. Targets that no rates can meet
    are met in the least-squares sense: shares tells. most: no rate exceeds it; least_share: domains with a smaller share of the
    labels are left out; neither holds by default. Null and repeated ids are rated row by row; other columns are ignored; an empty
    table gives an empty result.
    """
    shares = "map<string,struct<target:double,present:double,attained:double>>"
    model = fit_domains(docs, labelled, id_col=id_col, text_col=text_col, sample=sample, least_share=least_share)
    if model is None:
        words = F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("domain", "string"), ("posteriors", "map<string,double>"))]
        return docs.select(id_col, words.alias("n_tokens"), *none, F.lit(1.0).alias("rate"), F.lit(1).cast("bigint").alias("copies"), F.lit(None).cast(shares).alias("shares"))
    rows = docs.select(F.col(id_col).alias("_id"), _draw(id_col, text_col).alias("_draw"), _posteriors(model)(text_col).alias("_p"))
    posteriors = Scratch(docs.sparkSession).save(rows).select("_id", "_draw", "_p.*")
    rates = _solved(posteriors, model.domains, TARGETS if targets is None else targets, most)
    names = F.array(*map(F.lit, model.domains))
    top = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    said = F.lit(None)
    if rates.target is not None:
        row = lambda i: F.struct(*(F.lit(float(x[i])).alias(n) for n, x in (("target", rates.target), ("present", rates.present), ("attained", rates.attained))))
        said = F.create_map(*(x for i, d in enumerate(model.domains) for x in (F.lit(d), row(i))))
    rated = posteriors.withColumn("rate", _rate(rates))
    return rated.select(F.col("_id").alias(id_col), "n_tokens", top.alias("domain"), F.map_from_arrays(names, F.col("p")).alias("posteriors"), "rate", copies(F.col("rate"), F.col("_draw")).alias("copies"), said.cast(shares).alias("shares"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS, most: float | None = None, least_share: float = 0.0, copy_col: str | None = None) -> DataFrame:
    """The documents themselves at those rates: each row as often as its copies say, with the columns of docs.

    copy_col: a further column with the number of the copy, from 1. Without labelled documents all rows stay once. A text without words stays once. For the
    rest see mixture.
    """
    model = fit_domains(docs, labelled, id_col=id_col, text_col=text_col, sample=sample, least_share=least_share)
    if model is None:
        return docs.withColumn(copy_col, F.lit(1).cast("bigint")) if copy_col else docs
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), _draw(id_col, text_col).alias("_draw"), _posteriors(model)(text_col).alias("_p"))
    saved = Scratch(docs.sparkSession).save(rows)
    rates = _solved(saved.select("_p.*"), model.domains, TARGETS if targets is None else targets, most)
    rated = saved.select("_row", "_draw", "_p.*").withColumn("_copies", copies(_rate(rates), F.col("_draw"))).filter("_copies > 0")
    out = rated.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy"))
    return out.select("_row.*", F.col("_copy").alias(copy_col)) if copy_col else out.select("_row.*")
