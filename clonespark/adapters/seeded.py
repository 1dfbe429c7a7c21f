"""Seeded local alignment of sequences to genes, as nucleotide searches do it.

Spark joins the words of all sequences to those of the genes; seeds gather on diagonals. The seeded diagonals of a pair are scored without gaps, and around
the best one an alignment with affine gaps is made for many pairs at once, in a band. Scores become e-values by the statistics of Karlin and Altschul (1990).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.adapters.align import ALIGNMENT, described
from clonespark.scratch import Scratch

#: Places on either side of the seeds' diagonals in which an alignment may run.
BAND = 16
#: Cells of the tables of a batch of pairs.
CELLS = 4_000_000
#: Bytes of genes' words up to which they go to all tasks.
WORD_ROWS = 200_000
#: A cell that nothing reaches.
NEVER = np.int32(-(1 << 28))


@dataclass(frozen=True)
class Scoring:
    """Scores of a match and a mismatch, cost of opening a gap and of each place in it."""

    match: int = 1
    mismatch: int = -2
    gap_open: int = 1
    gap_extend: int = 2


@lru_cache
def karlin_altschul(match: int, mismatch: int) -> tuple[float, float]:
    """lambda and K of ungapped scores, for equally frequent bases."""
    p = {match: 0.25, mismatch: 0.75}
    low, high = 1e-9, 50.0  # of the sum of p e^(lambda s): below one at first, then above
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(q * math.exp(mid * s) for s, q in p.items()) < 1 else (low, mid)
    lam = (low + high) / 2
    entropy = lam * sum(s * q * math.exp(lam * s) for s, q in p.items())
    sigma, walk = 0.0, {0: 1.0}
    for k in range(1, 80):
        step: dict[int, float] = {}
        for at, q in walk.items():
            for s, r in p.items():
                step[at + s] = step.get(at + s, 0.0) + q * r
        walk = step
        sigma += sum(q * (math.exp(lam * at) if at < 0 else 1.0) for at, q in walk.items()) / k
    unit = math.gcd(match, mismatch)
    return lam, unit * lam * math.exp(-2 * sigma) / (entropy * (1 - math.exp(-lam * unit)))


def e_value(score: int, length: int, total: int, scoring: Scoring) -> float:
    """Alignments of that score that chance brings about between a sequence and genes of that total length (by the ungapped parameters)."""
    lam, k = karlin_altschul(scoring.match, scoring.mismatch)
    return k * length * total * math.exp(-lam * score)


def _codes(seqs: list[str], fill: int) -> np.ndarray:
    """Bytes of sequences as rows, filled up to the longest."""
    raw = [np.frombuffer(s.encode("ascii", "replace"), np.uint8) for s in seqs]
    out = np.full((len(raw), max(map(len, raw), default=0)), fill, np.uint8)
    for row, r in zip(out, raw):
        row[: len(r)] = r
    return out


def diagonal_scores(q: np.ndarray, g: np.ndarray, diagonals: np.ndarray, scoring: Scoring) -> np.ndarray:
    """The best run without gaps on each pair's diagonal (place in the gene less place in the sequence). 1 and 0 stand for no letter."""
    i = np.arange(q.shape[1])
    j = i[None, :] + diagonals[:, None]
    inside = (j >= 0) & (j < g.shape[1])
    other = np.where(inside, np.take_along_axis(g, np.clip(j, 0, g.shape[1] - 1), 1), 0)
    steps = np.where(q == other, scoring.match, scoring.mismatch)
    steps = np.where((q == 1) | (other == 0), -(1 << 20), steps)  # off the end of either
    sums = np.cumsum(steps, 1, dtype=np.int64)
    before = np.minimum.accumulate(np.concatenate((np.zeros((len(q), 1), np.int64), sums[:, :-1]), 1), 1)
    return (sums - before).max(1, initial=0)


def banded(q: np.ndarray, g: np.ndarray, lowest: np.ndarray, width: int, scoring: Scoring) -> list[tuple[int, int, int, list[int]]]:
    """The best local alignment of each pair within `width` diagonals from the lowest: score, and where it begins in the sequence and the gene (from 0), and its steps
    (0 both, 1 the sequence alone, 2 the gene alone). All pairs go along their sequences together."""
    n, m = q.shape
    open_, extend = scoring.gap_open + scoring.gap_extend, scoring.gap_extend
    k = np.arange(width)
    best_h, up = np.zeros((n, width), np.int32), np.full((n, width), NEVER, np.int32)
    trace = np.zeros((n, m, width), np.uint8)  # bits: 1-2 where H came from, 4 the upward gap goes on, 8 the leftward one does
    top, at_i, at_k = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(m):
        j = i + lowest[:, None] + k
        inside = (j >= 0) & (j < g.shape[1])
        other = np.where(inside, np.take_along_axis(g, np.clip(j, 0, g.shape[1] - 1), 1), 0)
        mine = q[:, i : i + 1]
        live = inside & (mine != 1) & (other != 0)
        diagonal = best_h + np.where(mine == other, scoring.match, scoring.mismatch)
        # a letter of the sequence alone: from the row before, one diagonal higher
        shifted_h = np.concatenate((best_h[:, 1:], np.zeros((n, 1), np.int32)), 1)
        shifted_up = np.concatenate((up[:, 1:], np.full((n, 1), NEVER, np.int32)), 1)
        up = np.maximum(shifted_h - open_, shifted_up - extend)
        goes_up = shifted_up - extend > shifted_h - open_
        h = np.maximum(np.maximum(diagonal, up), 0)
        h = np.where(live, h, 0)
        # letters of the gene alone: the best of what stands left, less the gap
        reach = np.maximum.accumulate(h + extend * k, 1)
        left = np.full_like(h, NEVER)
        left[:, 1:] = reach[:, :-1] - extend * k[1:] - scoring.gap_open
        whole = np.where(live, np.maximum(h, left), 0)
        came = np.where(whole == 0, 0, np.where(whole == diagonal, 1, np.where(whole == up, 2, 3)))
        goes_left = np.zeros_like(live)
        goes_left[:, 1:] = left[:, :-1] - extend > whole[:, :-1] - open_
        trace[:, i] = came | (goes_up << 2) | (goes_left << 3)
        best_h, up = whole.astype(np.int32), np.where(live, up, NEVER)
        here = best_h.max(1)
        better = here > top
        top, at_i, at_k = np.where(better, here, top), np.where(better, i, at_i), np.where(better, best_h.argmax(1), at_k)
    out = []
    for p in range(n):
        i, c, steps, state = int(at_i[p]), int(at_k[p]), [], 0
        while i >= 0 and 0 <= c < width:
            t = int(trace[p, i, c])
            if state == 0:
                state = t & 3
                if not state:
                    break
                if state == 1:
                    steps.append(0)
                    i, state = i - 1, 0
                    continue
            if state == 2:
                steps.append(1)
                state = 2 if t & 4 else 0
                i, c = i - 1, c + 1
            else:
                steps.append(2)
                state = 3 if t & 8 else 0
                c -= 1
        steps.reverse()
        length_q, length_g = steps.count(0) + steps.count(1), steps.count(0) + steps.count(2)
        out.append((int(top[p]), int(at_i[p]) + 1 - length_q, int(at_i[p] + lowest[p] + at_k[p]) + 1 - length_g, steps))
    return out


def best_alignments(pairs: list[tuple[str, str, list[int]]], scoring: Scoring) -> list[tuple[int, dict] | None]:
    """Score and description of the best alignment of each (sequence, gene, seeded diagonals)."""
    out: list[tuple[int, dict] | None] = [None] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda x: (len(pairs[x][0]), len(pairs[x][1])))
    at = 0
    while at < len(order):
        size = (len(pairs[order[at]][0]) + 16) * (2 * BAND + 1)
        chunk = order[at : at + max(1, CELLS // size)]
        at += len(chunk)
        q, g = _codes([pairs[x][0] for x in chunk], 1), _codes([pairs[x][1] for x in chunk], 0)
        if not q.size or not g.size:
            continue
        # the seeded diagonals of each pair: the best without gaps is the middle of the band
        many = [(row, d) for row, x in enumerate(chunk) for d in pairs[x][2]]
        rows, diagonals = np.array([r for r, _ in many], np.int64), np.array([d for _, d in many], np.int64)
        scores = np.concatenate([diagonal_scores(q[rows[a : a + 512]], g[rows[a : a + 512]], diagonals[a : a + 512], scoring) for a in range(0, len(rows), 512)])
        middle = np.zeros(len(chunk), np.int64)
        for r, d, s in sorted(zip(rows.tolist(), diagonals.tolist(), scores.tolist()), key=lambda x: (x[2], -abs(x[1]))):
            middle[r] = d
        for x, (score, i, j, steps) in zip(chunk, banded(q, g, middle - BAND, 2 * BAND + 1, scoring)):
            if score > 0:
                s, t, a, b, left, right = *pairs[x][:2], i, j, [], []
                for step in steps:
                    left.append("-" if step == 2 else s[a])
                    right.append("-" if step == 1 else t[b])
                    a, b = a + (step != 2), b + (step != 1)
                out[x] = score, described("".join(left), "".join(right), i + 1, j + 1, 0)
    return out


def align_to_genes(df: DataFrame, genes: DataFrame, seq: str = "full_NT", top: int = 1, word: int = 10, most_e: float = 1e-5, scoring: Scoring = Scoring()) -> DataFrame:  # noqa: B008
    """Adds aln: the best local alignments of each sequence to genes (index, full_NT) that share a word with it, up to that e-value, and evalue, the best one's.

    A sequence or gene that is null or shorter than a word has none. Of equal scores the gene with the smaller index comes first. Genes are a reference: their texts go to every task; their words
    too up to WORD_ROWS, beyond it the words of both sides are dealt by word.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    # Rows and pairs are few bytes and much work: dealt by size, as files and adaptive plans deal them, they are one task's or two's.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = scratch.save(df.repartition(tasks).withColumn("_row", F.monotonically_increasing_id()))
    known = scratch.save(genes.filter(F.col("full_NT").isNotNull()).select(F.col("index").cast("int").alias("gene"), F.col("full_NT").alias("text")))
    texts = {r["gene"]: r["text"] for r in known.collect()}  # a reference of genes
    total = sum(map(len, texts.values()))
    places = lambda c: F.sequence(F.lit(1), F.length(c) - word + 1)
    words = lambda d, key, c, at: d.filter(F.length(c) >= word).select(key, F.col(c).alias("_s"), F.explode(places(c)).alias(at)).select(key, at, F.substring("_s", F.col(at), F.lit(word)).alias("word"))
    of_genes = words(known, "gene", "text", "p")
    of_genes = F.broadcast(of_genes) if sum(max(0, len(t) - word + 1) for t in texts.values()) <= WORD_ROWS else of_genes
    hits = words(rows.select("_row", seq), "_row", seq, "i").join(of_genes, "word").select("_row", "gene", (F.col("p") - F.col("i")).alias("diagonal")).distinct()
    pairs = hits.groupBy("_row", "gene").agg(F.collect_list("diagonal").alias("diagonals")).join(rows.select("_row", F.col(seq).alias("_s")), "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                row, gene, diagonals, s = (c.to_pylist() for c in batch.slice(at, 2_000).columns)
                made = []
                for r, x, q, found in zip(row, gene, s, best_alignments([(q, texts[x], d) for q, x, d in zip(s, gene, diagonals)], scoring)):
                    if found and (e := e_value(found[0], len(q), total, scoring)) <= most_e:
                        made.append((r, -found[0], x, e, {**found[1], "sbjct_index": x}))
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*made)))), schema=arrow) if made else pa.RecordBatch.from_pylist([], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    one = ALIGNMENT[ALIGNMENT.index("array<") + len("array<") : -2]
    kinds = _parse_datatype_string(f"_row bigint, lost int, gene int, evalue double, found {one}")
    names, arrow = kinds.fieldNames(), to_arrow_schema(kinds)
    # By a hash of its own: a key by which pairs lie already would be left out of the plan, and small partitions put together.
    scored = pairs.select("_row", "gene", "diagonals", "_s").repartition(tasks, F.xxhash64("_row", "gene")).mapInArrow(run, kinds)
    held = scored.groupBy("_row").agg(F.slice(F.sort_array(F.collect_list(F.struct("lost", "gene", "evalue", "found"))), 1, top).alias("_best"))
    aln = F.struct(F.size("_best").alias("num_alignments"), F.transform("_best", lambda b: b["found"]).alias("alignments"))
    none = F.from_json(F.lit('{"num_alignments": 0, "alignments": []}'), ALIGNMENT)
    return rows.join(held, "_row", "left").select(*df.columns, F.when(F.col("_best").isNotNull(), aln).otherwise(none).alias("aln"), F.col("_best")[0]["evalue"].alias("evalue"))
