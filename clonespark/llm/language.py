"""Language ID: averages of hashed subword embeddings under a linear softmax.

A text's subwords are its byte n-grams. The model is trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows; a held-back part of the sample sets the temperature that calibrates its
probabilities and the score below which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import column_function, map_batches, text_bytes, utf8
from clonespark.llm.words import LOWER, Block, blocks

#: Labelled documents that the model is fitted to, shared evenly among the languages.
SAMPLE_DOCS = 2000
LEAST_DOCS, MOST_LANGS = 20, 1000
BUCKETS, DIM, SIZES = 1 << 15, 8, (2, 3, 4)
EPOCHS, RATE, BATCH = 8, 8.0, 16
#: Bytes of text scored together.
SCORE_BYTES = 1 << 18
UNKNOWN = "und"
#: Every byte that is no ASCII letter and belongs to no longer character counts as one space.
FOLD = LOWER.copy()
FOLD[[x for x in range(128) if not chr(x).isalpha()]] = 0x20
LETTER = np.zeros(256, bool)
LETTER[[x for x in range(128) if chr(x).isalpha()]] = True
ANY_LETTER = regex.compile(r"\p{L}")


def subwords(block: Block):
    """For each n-gram size: the bucket of the n-gram at each place, and whether it lies in one text."""
    x = FOLD[block.data].astype(np.uint32)
    left = np.repeat(block.offsets[1:], np.diff(block.offsets)) - np.arange(len(x))  # bytes to the text's end
    for n in SIZES:
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, n, np.uint32)
        for j in range(n):
            h = (h ^ x[j : len(x) - n + 1 + j]) * np.uint32(0x01000193)
        yield ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64), left[: len(h)] >= n


def histogram(data: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in one text, which is gone through in pieces that overlap by an n-gram."""
    held, reach = np.zeros(BUCKETS, np.int64), max(SIZES) - 1
    for at in range(0, len(data), SCORE_BYTES):
        piece = data[at : at + SCORE_BYTES + reach]
        for buckets, inside in subwords(Block(0, piece, np.array([0, len(piece)]))):
            held += np.bincount(buckets[inside][:SCORE_BYTES], minlength=BUCKETS)
    return held


def letters(block: Block) -> np.ndarray:
    """Whether each text has a letter."""
    out = block.per_text(LETTER[block.data]) > 0
    for i in np.flatnonzero(~out).tolist():
        raw = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes()
        out[i] = ANY_LETTER.search(raw.decode("utf-8", "replace")) is not None
    return out


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # BUCKETS x languages: each embedding times the softmax layer
    bias: np.ndarray
    temperature: float = 1.0
    half_at: float = 0.0
    reject_below: float = 0.0

    def scores(self, block: Block) -> np.ndarray:
        """Calibrated probabilities of each language for each text."""
        if block.n == 1:  # maybe a long one
            held = histogram(block.data)
            count = np.array([held.sum()], float)
            mean = (held @ self.table / max(count[0], 1))[None]
            return softmax(calibrated(mean + self.bias, count, self.temperature, self.half_at))
        total, count = np.zeros((block.n, len(self.langs))), np.zeros(block.n)
        for buckets, inside in subwords(block):
            sums = np.vstack((np.zeros((1, len(self.langs))), np.cumsum(np.where(inside[:, None], self.table[buckets], 0), axis=0, dtype=np.float64)))
            ends = np.minimum(block.offsets, len(buckets))
            total += sums[ends[1:]] - sums[ends[:-1]]
            held = np.concatenate(([0], np.cumsum(inside)))
            count += held[ends[1:]] - held[ends[:-1]]
        return softmax(calibrated(total / np.maximum(count, 1)[:, None] + self.bias, count, self.temperature, self.half_at))


def calibrated(logits: np.ndarray, count: np.ndarray, temperature: float, half_at: float) -> np.ndarray:
    """Logits over the temperature, shrunk for texts of few subwords (by half for half_at of them)."""
    return logits / temperature * (count / (count + half_at + 1e-9))[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def snippet(data: np.ndarray, begin: int, end: int) -> tuple[int, int]:
    """A part of 4 to 512 bytes of the text data[begin:end], all of it if it is shorter. Place and length follow from its hash."""
    draw = xxhash.xxh64_intdigest(data[begin:end].tobytes(), 19)
    size = min(4 << draw % 8, end - begin)
    at = begin + (draw >> 8) % (end - begin - size + 1)
    return at, at + size


def _counts(batch: pa.RecordBatch):
    """Sparse bucket counts of each text, as bytes: of uint16 buckets, of float32 shares.

    A text of the calibration fold comes twice, whole and as a snippet of 4 to 512 bytes from a place that its hash gives: scores have to hold for
    short texts too, from anywhere.
    """
    out = []
    data, offsets = text_bytes(batch.column(0))
    for i, (lang, fold) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
        spans = [(offsets[i], offsets[i + 1])]
        if fold == 0 and offsets[i + 1] > offsets[i]:
            spans.append(snippet(data, int(offsets[i]), int(offsets[i + 1])))
        for a, b in spans:
            held = histogram(data[a:b])
            at = np.flatnonzero(held)
            out.append((lang, fold, at.astype(np.uint16).tobytes(), (held[at] / max(held.sum(), 1)).astype(np.float32).tobytes(), int(held.sum())))
    return zip(*out)


def held_out(id_col: str) -> Column:
    """True for a fifth of the ids; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_language_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS, max_error: float = 0.01) -> LanguageModel | None:
    """Fit to about `sample` labelled documents that aren't held out, of all languages alike.

    Chosen by a hash of the id, so the same whatever the partitions; whole texts; only their bucket counts come to the
    driver (at most 6 bytes for each of BUCKETS). A language has sample / languages documents, or LEAST_DOCS if that is less, or all that it
    has. None if no row is labelled. More than MOST_LANGS languages are an error: the column is no language then.
    """
    known = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang")).filter(F.col("_lang").isNotNull() & F.col("_id").isNotNull() & F.col("_text").isNotNull() & ~held_out("_id"))
    counts = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().limit(MOST_LANGS + 1).collect()}
    if not counts:
        return None
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} values of {lang_col}")
    langs, quota = sorted(counts), max(LEAST_DOCS, sample // len(counts))
    rate = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, quota / counts[k]))))
    draw = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(draw < F.element_at(rate, F.col("_lang"))).withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit(18)), F.lit(4)).cast("int"))
    rows = map_batches(chosen.select(utf8("_text"), "_lang", "_fold"), _counts, "lang string, fold int, buckets binary, shares binary, n bigint").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["buckets"]), bytes(r["shares"])))
    data = [(np.frombuffer(r["buckets"], np.uint16), np.frombuffer(r["shares"], np.float32), langs.index(r["lang"]), r["fold"] == 0, r["n"]) for r in rows]
    del rows
    return train(langs, data, max_error)


def train(langs: list[str], data: list[tuple[np.ndarray, np.ndarray, int, bool, int]], max_error: float) -> LanguageModel:
    """Gradient descent on rows (buckets, shares, language, whether held back for calibration, subwords)."""
    rng = np.random.default_rng(7)
    embed = rng.uniform(-0.5, 0.5, (BUCKETS, DIM)) / DIM
    layer, bias = rng.uniform(-0.5, 0.5, (DIM, len(langs))), np.zeros(len(langs))
    fit = [x for x in data if not x[3]] or data
    steps = EPOCHS * len(fit)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(fit))
        for k in range(0, len(order), BATCH):
            rate = RATE * (1 - (epoch * len(fit) + k) / steps)
            chosen = [fit[i] for i in order[k : k + BATCH]]
            means = np.array([share @ embed[at] for at, share, *_ in chosen])
            error = softmax(means @ layer + bias)
            error[np.arange(len(chosen)), [x[2] for x in chosen]] -= 1
            back = error @ layer.T
            layer -= rate / len(chosen) * means.T @ error
            bias -= rate / 100 * error.mean(0)
            for (at, share, *_), g in zip(chosen, back):
                embed[at] -= rate * share[:, None] * g
    model = LanguageModel(langs, (embed @ layer).astype(np.float32), bias)
    held = [x for x in data if x[3]] or data
    logits = np.array([share @ model.table[at] for at, share, *_ in held]) + bias
    truth, sizes = np.array([x[2] for x in held]), np.array([x[4] for x in held], float)
    best = np.inf
    for t in np.exp(np.linspace(-4, 2, 37)):
        for half_at in (0, 4, 8, 16, 32, 64, 128, 256, 512):
            p = softmax(calibrated(logits, sizes, t, half_at))
            if (loss := -np.log(p[np.arange(len(held)), truth] + 1e-12).mean()) < best:
                best, model.temperature, model.half_at = loss, float(t), float(half_at)
    model.reject_below = rejection(softmax(calibrated(logits, sizes, model.temperature, model.half_at)), truth, max_error)
    return model


def rejection(probabilities: np.ndarray, truth: np.ndarray, max_error: float) -> float:
    """The lowest score from which on predictions err in at most max_error of the cases, at most one half.

    Scores are calibrated: a prediction that is rejected is likelier wrong than right.
    """
    top = probabilities.max(1)
    order = np.argsort(-top, kind="stable")
    wrong = np.cumsum(probabilities.argmax(1)[order] != truth[order])
    fine = np.flatnonzero(wrong <= max_error * np.arange(1, len(order) + 1))
    return min(0.5, float(top[order][fine[-1]]) if len(fine) else 0.5)


def _predict(model: LanguageModel | None):
    """A column function: lang_pred and score of texts."""

    def run(texts: pa.Array):
        names, tops = [], []
        for block in blocks(texts, SCORE_BYTES):
            some = letters(block)
            if model is None:
                names += [UNKNOWN] * block.n
                tops.append(np.zeros(block.n))
                continue
            p = model.scores(block)
            best = p.argmax(1)
            names += [model.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some)]
            tops.append(np.where(some, p.max(1), 0.0))
        return [names, np.concatenate(tops)]

    return column_function(run, "struct<lang_pred: string, score: double>")


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> DataFrame:
    """Predict the language of every whole text.

    Returns id_col, held_out (crc32 of the id modulo 5 is 0; such rows are never learned from), lang_pred (a learned
    value of lang_col, or UNKNOWN), score (calibrated, 0 to 1) and rejected (UNKNOWN, or a score under
    the model's threshold). A null text, or one without a letter, is UNKNOWN with score 0; so is every
    text if no row is labelled. Nulls and repeats of ids are predicted row by row; other columns
    are ignored; ties go to the language that sorts first; an empty table gives an empty result.
    """
    model = fit_language_model(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample)
    out = docs.select(F.col(id_col).alias("_id"), _predict(model)(text_col).alias("_p")).select("_id", "_p.*")
    return out.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), "lang_pred", "score", _rejected(model).alias("rejected"))


def _rejected(model: LanguageModel | None) -> Column:
    return (F.col("lang_pred") == UNKNOWN) | (F.col("score") < (model.reject_below if model else 0.0))


def language_filter(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of docs whose language isn't rejected (see language_id), with their columns as they are.

    A null text, or one without a letter, is rejected. If no row is labelled there is nothing to tell languages by: all rows stay. Rows that repeat stay as
    often as they are; names of docs may clash with those of the prediction; an empty table gives an empty result.
    """
    model = fit_language_model(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample)
    if model is None:
        return docs
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), _predict(model)(text_col).alias("_p"))
    return rows.select("_row", "_p.*").filter(~_rejected(model)).select("_row.*")
