"""Merging of paired reads by a statistical test of their overlap.

Every shift of a read and its mate has an expected score from both reads' qualities: what it gains where bases agree and loses where they differ, as far as they are to be
trusted. The best shift is taken if chance alone would hardly reach its score at any shift. All pairs of one size are held against each other together.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.functions.dna import reverse_complement

#: Quality of bases without one.
PLAIN_QUALITY = 30
#: Share of equal bases of unrelated reads.
CHANCE = 0.25


def _errors(qualities: np.ndarray) -> np.ndarray:
    """Chance that a base is wrong, from its Phred quality."""
    return 10.0 ** (-qualities / 10.0)


def expected_weights(equal: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What two bases that agree or differ as read are worth, if true agreement is worth 1 and difference -1; p, q: chances that either is wrong."""
    both = (1 - p) * (1 - q)
    same = np.where(equal, both + p * q / 3, (1 - p) * q / 3 + (1 - q) * p / 3 + 2 * p * q / 9)
    return 2 * same - 1


@lru_cache(1 << 16)
def _below(n: int, k: int) -> float:
    """The chance of fewer than k equal bases of n unrelated ones."""
    if k <= 0:
        return 0.0
    if k > n:
        return 1.0
    logs = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
    i = np.arange(k, n + 1)
    tail = np.exp(logs[n] - logs[i] - logs[n - i] + i * np.log(CHANCE) + (n - i) * np.log(1 - CHANCE)).sum()
    return max(0.0, 1.0 - float(tail))


def p_value(score: float, gain: float, loss: float, length_a: int, length_b: int, least: int) -> float:
    """The chance that unrelated reads reach a score at one of their shifts at least; gain and loss: worth of equal and unequal bases, on average."""
    out = 1.0
    for n in range(least, min(length_a, length_b) + 1):
        need = int(np.ceil((score - loss * n) / max(gain - loss, 1e-9) - 1e-9))  # equal bases that an overlap of n needs
        shifts = 2 if n < min(length_a, length_b) else abs(length_a - length_b) + 1
        out *= _below(n, need) ** shifts
    return 1.0 - out


def merge_alike(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, least: int, level: float) -> list[tuple[int, float] | None]:
    """The shift of each mate against its read (rows of one length each, and their errors), and its p-value; None where no overlap of `least` passes the level.

    A shift is the place in the read where the mate begins, below 0 if the fragment is shorter than the mate.
    """
    n, m = a.shape[1], b.shape[1]
    best, at = np.full(len(a), -np.inf), np.zeros(len(a), np.int64)
    gains, losses = np.ones(len(a)), -np.ones(len(a))
    for shift in range(least - m, n - least + 1):
        x, y = slice(max(shift, 0), min(n, shift + m)), slice(max(-shift, 0), min(m, n - shift))
        size = x.stop - x.start
        if size < least:
            continue
        equal = a[:, x] == b[:, y]
        worth = expected_weights(equal, p[:, x], q[:, y])
        score = worth.sum(1)
        better = score > best
        if better.any():
            best[better], at[better] = score[better], shift
            hits = equal[better].sum(1)
            gains[better] = np.where(hits > 0, np.where(equal[better], worth[better], 0).sum(1) / np.maximum(hits, 1), 1.0)
            losses[better] = np.where(hits < size, np.where(equal[better], 0, worth[better]).sum(1) / np.maximum(size - hits, 1), -1.0)
    out: list[tuple[int, float] | None] = []
    for score, shift, gain, loss in zip(best.tolist(), at.tolist(), gains.tolist(), losses.tolist()):
        chance = p_value(score, gain, loss, n, m, least) if np.isfinite(score) and score > 0 else 1.0
        out.append((shift, chance) if chance <= level else None)
    return out


def _joined(a: str, b: str, qa: str | None, qb: str | None, shift: int) -> tuple[str, str | None]:
    """The fragment: where both reads tell a base, the surer one, and of equal ones the better quality. What either has beyond the fragment isn't part of it."""
    start, end = max(shift, 0), min(len(a), shift + len(b))
    over = list(zip(a[start:end], b[start - shift : end - shift]))
    head, tail = (a[:start], b[end - shift :]) if shift >= 0 else ("", b[end - shift :])
    if shift < 0 and len(b) + shift < len(a):
        tail = ""
    if not (qa and qb):
        return head + "".join(x for x, _ in over) + tail, None
    surer = [(x, u) if u >= v else (y, v) for (x, y), u, v in zip(over, qa[start:end], qb[start - shift : end - shift])]
    return head + "".join(x for x, _ in surer) + tail, (qa[:start] if head else "") + "".join(u for _, u in surer) + (qb[end - shift :] if tail else "")


def merge_reads(a: list, b: list, qa: list, qb: list, least: int, level: float) -> list[tuple[str | None, str | None, float | None]]:
    """merged, its quality and the p-value of each pair (mates already turned); None where they don't overlap surely."""
    sizes = defaultdict(list)
    for i, (x, y) in enumerate(zip(a, b)):
        if x and y and min(len(x), len(y)) >= least:
            sizes[len(x), len(y)].append(i)
    out: list[tuple[str | None, str | None, float | None]] = [(None, None, None)] * len(a)
    for rows in sizes.values():
        for at in range(0, len(rows), 1_000):
            part = rows[at : at + 1_000]
            letters = [np.array([np.frombuffer(s[i].encode("ascii", "replace"), np.uint8) for i in part]) for s in (a, b)]
            errors = [_errors(np.array([np.frombuffer(q[i].encode("ascii", "replace"), np.uint8) - 33.0 if q[i] and len(q[i]) == len(s[i]) else np.full(len(s[i]), float(PLAIN_QUALITY)) for i in part])) for s, q in ((a, qa), (b, qb))]
            for i, found in zip(part, merge_alike(*letters, *errors, least, level)):
                if found:
                    told = qa[i] and qb[i] and len(qa[i]) == len(a[i]) and len(qb[i]) == len(b[i])
                    out[i] = (*_joined(a[i], b[i], qa[i] if told else None, qb[i] if told else None, found[0]), found[1])
    return out


def merge_pairs(pairs: DataFrame, forward: str = "r1", reverse: str = "r2", least: int = 10, level: float = 0.01, qualities: tuple[str, str] | None = None) -> DataFrame:
    """Adds merged, null where the reads don't overlap by `least` bases more surely than unrelated ones would at the level, and merge_p, the chance of such an overlap.

    reverse: as sequenced. qualities: the columns of both reads' qualities (Phred, from !); they weigh the bases, decide where the reads differ, and merged_quality is added.
    Null and short reads have no overlap.
    """

    def join(a: pd.Series, b: pd.Series, p: pd.Series, q: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(merge_reads(a.tolist(), b.tolist(), p.tolist(), q.tolist(), least, level), columns=["merged", "merged_quality", "merge_p"]).astype({"merged": object, "merged_quality": object, "merge_p": float})

    columns = [F.col(qualities[0]), F.reverse(F.col(qualities[1]))] if qualities else [F.lit(None).cast("string")] * 2
    made = pairs.withColumn("_m", F.pandas_udf(join, "merged string, merged_quality string, merge_p double")(F.col(forward), reverse_complement(reverse), *columns))
    return made.select("*", "_m.merged", *(["_m.merged_quality"] if qualities else []), "_m.merge_p").drop("_m")
