"""Quality rules as weak supervision.

Each rule votes good (1), low (-1) or very low (-2) or abstains (0). Expectation-maximisation over the vote patterns of all
documents estimates how often each rule casts each vote on good and on low documents, and so how far to trust it; a document is kept
by its posterior probability, not by passing every rule. Rules look at each kind of defect in two ways or more (symbols by number and by
words that have them, repetition by windows, lines and distinct words), so that junk of one kind, too, is seen by several.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import column_function
from clonespark.llm.words import ALNUM, Block, blocks
from clonespark.scratch import Scratch

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER, DIGIT, BANG, NEWLINE = (np.zeros(256, bool) for _ in range(4))
UPPER[0x41:0x5B], DIGIT[0x30:0x3A], BANG[0x21], NEWLINE[0x0A] = True, True, True, True
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_bangs", "n_distinct", "n_symbol_words", "n_plain_words")


def repeated_words(block: Block, hashes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of three words which the text holds twice or more."""
    keys, first = block.grams(hashes, 3)
    if not len(keys):
        return np.zeros(block.n, np.int64)
    owner = block.text[first]
    order = np.lexsort((keys, owner))
    keys, owner, first = keys[order], owner[order], first[order]
    same = np.flatnonzero((keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1]))
    # Equal hashes: the words themselves are compared.
    equal = np.logical_and.reduce([block.same_words(first[same] + j, first[same + 1] + j) for j in range(3)])
    covered = np.zeros(len(block.starts), bool)
    for at in (first[same], first[same + 1]):
        for j in range(3):
            covered[at + j] = True
    out = np.bincount(block.text[covered], minlength=block.n)
    for i in np.unique(owner[same[~equal]]).tolist():  # different windows of one hash
        out[i] = _counted(block, i)
    return out


def _counted(block: Block, i: int) -> int:
    """repeated_words of one text by its windows as such."""
    at = np.flatnonzero(block.text == i)
    words = [block.data[s:e].tobytes() for s, e in zip(block.starts[at].tolist(), block.ends[at].tolist())]
    windows = list(zip(words, words[1:], words[2:]))
    found = Counter(windows)
    return len({k + j for k, w in enumerate(windows) if found[w] > 1 for j in range(3)})


def distinct_words(block: Block, hashes: np.ndarray) -> np.ndarray:
    order = np.lexsort((hashes, block.text))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (block.text[order][1:] != block.text[order][:-1])
    return np.bincount(block.text[order][new], minlength=block.n)


def words_with(block: Block, mask: np.ndarray) -> np.ndarray:
    """Words of each text that have a byte for which the mask holds."""
    if not len(block.starts):
        return np.zeros(block.n, np.int64)
    edges = np.stack((block.starts, block.ends), 1).ravel()
    held = np.logical_or.reduceat(np.append(mask, False), edges)[::2]
    return np.bincount(block.text[held], minlength=block.n)


def _features(block: Block) -> list[np.ndarray]:
    block.split()
    data = block.data
    word_chars = block.per_text(((data & 0xC0) != 0x80) & (data != 0x20) & ~((data >= 0x09) & (data <= 0x0D)))
    dup, lines = np.zeros(block.n, np.int64), np.zeros(block.n, np.int64)
    raw, several = data.tobytes(), block.per_text(NEWLINE[data]) > 0
    for i in range(block.n):
        if several[i]:
            with_word = [x for x in raw[block.offsets[i] : block.offsets[i + 1]].split(b"\n") if x.strip()]
            lines[i], dup[i] = len(with_word), len(with_word) - len(set(with_word))
        else:
            lines[i] = block.counts[i] > 0
    hashes = block.hashes()
    marks = (block.per_text(m[data]) for m in (UPPER, DIGIT, BANG))
    by_word = distinct_words(block, hashes), words_with(block, SYMBOLS[data]), block.counts - words_with(block, ALNUM[data])
    return [block.counts, word_chars, block.per_text(SYMBOLS[data]), dup, repeated_words(block, hashes), lines, *marks, *by_word]


def _all_features(texts: pa.Array) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*(_features(b) for b in blocks(texts)))]


def quality_features(text_col: str = "text") -> Column:
    """FEATURES of every whole text (null: no words), as a struct."""
    return column_function(_all_features, "struct<" + ", ".join(f"{x}: bigint" for x in FEATURES) + ">")(text_col)


def ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


INF = float("inf")


def graded(value: Column, worst: tuple[float, float], low: tuple[float, float], good: tuple[float, float]) -> Column:
    """-2 outside of worst, -1 outside of low, 1 inside of good, else 0. Each range lies in the one before."""
    outside = lambda x: (value < x[0]) | (value > x[1])
    return F.when(outside(worst), -2).when(outside(low), -1).when(~outside(good), 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Rule to vote, from the columns FEATURES."""
    return {
        "length": F.when(F.col("n_words") >= 100, 1).otherwise(0),
        "word_length": graded(ratio("word_chars", "n_words"), (2.5, 12), (3.5, 7.5), (4, 6.5)),
        "symbols": graded(ratio("n_symbols", "n_words"), (0, 0.3), (0, 0.1), (0, 0.01)),
        "symbol_words": graded(ratio("n_symbol_words", "n_words"), (0, 0.3), (0, 0.1), (0, 0.01)),
        "plain_words": graded(ratio("n_plain_words", "n_words"), (0, 0.3), (0, 0.1), (0, 0.02)),
        "dup_lines": graded(ratio("n_dup_lines", "n_lines"), (0, 0.6), (0, 0.4), (0, 0.1)),
        "repeats": graded(ratio("n_repeat_words", "n_words"), (0, 0.5), (0, 0.3), (0, 0.15)),
        "distinct": graded(ratio("n_distinct", "n_words"), (0.1, INF), (0.3, INF), (0.45, INF)),
        "capitals": graded(ratio("n_upper", "word_chars"), (0, 0.4), (0, 0.2), (0, 0.1)),
        "digits": graded(ratio("n_digits", "word_chars"), (0, 0.5), (0, 0.2), (0, 0.1)),
        "bangs": graded(ratio("n_bangs", "n_words"), (0, 0.5), (0, 0.2), (0, 0.05)),
    }


#: What a rule may vote, abstentions left out.
VOTES = (-2, -1, 1)


@dataclass
class LabelModel:
    """What expectation-maximisation found: share of good documents, and of each rule the probabilities of VOTES, given that it votes."""

    names: list[str]
    share: float
    good: np.ndarray  # rules x VOTES
    low: np.ndarray

    @property
    def accuracy(self) -> dict[str, float]:
        """How often each rule is right when it votes, low and very low being one."""
        right = self.share * self.good[:, 2] + (1 - self.share) * self.low[:, :2].sum(1)
        return dict(zip(self.names, right.tolist()))

    def weights(self) -> np.ndarray:
        return np.log(self.good / self.low)

    def posterior(self) -> Column:
        """Probability that a row, with a column for each rule's vote, is of good quality."""
        rounded = [[round(float(x), 9) for x in row] for row in self.weights()]
        parts = [F.element_at(F.array(*map(F.lit, (w[0], w[1], 0.0, w[2]))), F.col(x) + 3) for x, w in zip(self.names, rounded)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, parts, F.lit(round(float(np.log(self.share / (1 - self.share))), 9)))))


#: Pseudo-counts, as of so many documents, that keep estimates off zero and tell the classes apart: good ones are the more, and rules seldom call them
#: low. They count for nothing beside the documents of a corpus.
STRENGTH, SHARE = 4.0, 0.8
PRIOR_GOOD, PRIOR_LOW = np.array([0.005, 0.045, 0.95]), np.array([0.2, 0.2, 0.6])
#: Where EM begins: probability of good quality by how far a pattern's votes go down together.
START = np.array([0.97, 0.6, 0.2, 0.05])


def fit_label_model(names: list[str], votes: np.ndarray, counts: np.ndarray, rounds: int = 1000, tolerance: float = 1e-9) -> LabelModel:
    """EM for two classes over distinct vote patterns (rows of votes) and how many documents have each.

    Only votes count, abstentions tell nothing: the model is of a rule's vote given that it votes.
    """
    votes, counts = votes.reshape(-1, len(names)), counts.astype(float)
    good = START[np.minimum(-np.minimum(votes, 0).sum(1), 3)] if len(votes) else np.zeros(0)
    hot = np.stack([votes == v for v in VOTES], 2).astype(float)  # pattern, rule, vote
    for _ in range(rounds):
        share = (good @ counts + SHARE * STRENGTH) / (counts.sum() + STRENGTH)
        p_good = np.einsum("p,prv->rv", good * counts, hot) + STRENGTH * PRIOR_GOOD
        p_low = np.einsum("p,prv->rv", (1 - good) * counts, hot) + STRENGTH * PRIOR_LOW
        model = LabelModel(names, float(share), p_good / p_good.sum(1, keepdims=True), p_low / p_low.sum(1, keepdims=True))
        new = 1 / (1 + np.exp(-(np.log(share / (1 - share)) + np.einsum("prv,rv->p", hot, model.weights()))))
        if not len(new) or np.abs(new - good).max() < tolerance:
            break
        good = new
    return model


def label_model(features: DataFrame) -> LabelModel:
    """Fit to all rows. There are at most 4 ** rules patterns to collect, whatever the input, and few that occur."""
    votes = rules()
    names = list(votes)
    rows = features.select([v.alias(x) for x, v in votes.items()]).groupBy(names).count().collect()
    rows.sort()
    return fit_label_model(names, np.array([r[:-1] for r in rows], np.int64), np.array([r[-1] for r in rows]))


def judged(features: DataFrame, model: LabelModel, threshold: float) -> DataFrame:
    """Adds base_failed, quality (the posterior) and kept."""
    votes = rules()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = features.withColumns(votes).withColumns({"base_failed": failed, "quality": model.posterior()})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop(*votes)


def quality_verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Counts and verdict for every whole text.

    Returns id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality.
    base_failed: fewer than 50 words, or over half of them in repeated windows. kept: not base_failed, and a
    posterior of at least threshold. A null or empty text has no words: base_failed. Null and repeated ids
    are judged row by row; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), quality_features(text_col).alias("_f"))
    features = Scratch(docs.sparkSession).save(rows).select("_id", "_f.*")
    out = judged(features, label_model(features), threshold)
    return out.select(F.col("_id").alias(id_col), *FEATURES[:5], "base_failed", "kept", "quality")


def quality_filter(docs: DataFrame, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that quality_verdicts keeps, with their columns as they are.

    Texts are read once: the rows are written with their counts, and filtered when the model is fitted. A null, empty or
    short text goes; rows that repeat stay as often as they are; names of docs may clash with those of the counts; an empty table gives an
    empty result.
    """
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), quality_features(text_col).alias("_f"))
    saved = Scratch(docs.sparkSession).save(rows)
    return judged(saved.select("_row", "_f.*"), label_model(saved.select("_f.*")), threshold).filter("kept").select("_row.*")
