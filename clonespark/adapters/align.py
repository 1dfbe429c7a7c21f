"""Alignments: BLAST's pairwise text, and native aligners for clusters."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.adapters.profiles import pair_sum, progressive, refined

ALIGNMENT = (
    "struct<num_alignments:int,alignments:array<struct<matched:int,whole:int,sbjct_index:int,query_start:int,query_end:int,sbjct_start:int,sbjct_end:int,"
    "num_mismatches:int,mismatches:array<struct<query:string,sbjct:string,query_loc:int,sbjct_loc:int>>,match_pattern:string>>>"
)


def described(q: str, s: str, q0: int, s0: int, index: int) -> dict:
    """An alignment of two gapped rows that begin at q0 and s0 (from 1)."""
    pattern, wrong, i, j = [], [], q0, s0
    for a, b in zip(q, s):
        if a == "-" or b == "-":
            pattern.append("q" if a == "-" else "s")
        else:
            pattern.append("|" if a == b else " ")
            if a != b:
                wrong.append({"query": a, "sbjct": b, "query_loc": i, "sbjct_loc": j})
        i, j = i + (a != "-"), j + (b != "-")
    return {
        "matched": pattern.count("|"), "whole": len(q), "sbjct_index": index, "query_start": q0, "query_end": i - 1, "sbjct_start": s0, "sbjct_end": j - 1,
        "num_mismatches": len(q) - pattern.count("|"), "mismatches": wrong, "match_pattern": "".join(pattern),
    }


def parse_blast(text: str, index_of: dict[str, int] | None = None, alignments: int = 10) -> pd.DataFrame:
    """query and aln of each query of BLAST's pairwise text: the first match of each of the first subjects.

    index_of: subjects' names to numbers; without it, or for other names, subjects count from 0 in the text's order.
    """
    rows = []
    for block in re.split(r"(?m)^Query= ", text)[1:]:
        found = []
        for k, subject in enumerate(re.split(r"(?m)^>\s?", block)[1:][:alignments]):
            first = re.split(r"(?m)^\s*Score =", subject)
            if len(first) < 2:
                continue
            q = re.findall(r"(?m)^Query\s+(\d+)\s+(\S+)\s+\d+", first[1])
            s = re.findall(r"(?m)^Sbjct\s+(\d+)\s+(\S+)\s+\d+", first[1])
            name = subject.split("\n", 1)[0].strip()
            if q and s:
                found.append(described("".join(x for _, x in q), "".join(x for _, x in s), int(q[0][0]), int(s[0][0]), (index_of or {}).get(name, k)))
        rows.append((block.split("\n", 1)[0].strip(), {"num_alignments": len(found), "alignments": found}))
    return pd.DataFrame(rows, columns=["query", "aln"])


def global_alignment(a: str, b: str, band: int) -> tuple[str, str]:
    """Least edits from a to b, of alignments that stray at most `band` from the diagonal (as many as their lengths differ at least)."""
    band = max(band, abs(len(a) - len(b))) + 1
    far, width = len(a) + len(b) + 2, 2 * band + 1
    k = np.arange(width)  # of row i: place j = i + k - band in b
    other = np.concatenate((np.zeros(band + 1, np.uint32), np.array([ord(c) for c in b], np.uint32), np.zeros(band + 1 + max(0, len(a) - len(b)), np.uint32)))
    cost = np.full((len(a) + 1, width + 1), far, np.int32)
    cost[0, :width] = np.where((k >= band) & (k - band <= len(b)), k - band, far)
    for i, c in enumerate(a, 1):
        j = i + k - band
        unequal = other[i : i + width] != ord(c)
        row = np.minimum(np.where(j >= 1, cost[i - 1, :width] + unequal, far), cost[i - 1, 1:] + 1)
        row = np.where((j >= 0) & (j <= len(b)), row, far)
        cost[i, :width] = np.where((j >= 0) & (j <= len(b)), np.minimum.accumulate(row - k) + k, far)
    x, y, i, j = [], [], len(a), len(b)
    while i or j:
        at = j - i + band
        if i and j and cost[i, at] == cost[i - 1, at] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            x.append(a[i])
            y.append(b[j])
        elif i and cost[i, at] == cost[i - 1, at + 1] + 1:
            i -= 1
            x.append(a[i])
            y.append("-")
        else:
            j -= 1
            x.append("-")
            y.append(b[j])
    return "".join(reversed(x)), "".join(reversed(y))


def star_alignment(seed: str, others: list[str], band: int) -> list[str]:
    """Rows of one length for the seed and the others, each aligned with the seed; gaps that one calls for go to all."""
    pairs = [global_alignment(seed, o, band) for o in others]
    room = [0] * (len(seed) + 1)  # bases put in before each place of the seed
    for x, _ in pairs:
        at = run = 0
        for c in x:
            if c == "-":
                run += 1
            else:
                room[at] = max(room[at], run)
                at, run = at + 1, 0
        room[at] = max(room[at], run)

    def spread(x: str, y: str) -> str:
        out, at, held = [], 0, []
        for c, d in zip(x, y):
            if c == "-":
                held.append(d)
            else:
                out += [*held, *"-" * (room[at] - len(held)), d]
                at, held = at + 1, []
        return "".join([*out, *held, *"-" * (room[at] - len(held))])

    return [spread(seed, seed), *(spread(x, y) for x, y in pairs)]


#: Sequences up to which a cluster is aligned by profiles too.
PROFILE_ROWS = 300


def cluster_alignment(seed: str, others: list[str], band: int) -> list[str]:
    """Rows of one length for the seed and the others: along a guide tree by profiles, with each row aligned anew, or all to the seed, whichever has the higher sum over pairs.

    Sequences that need no gap, and clusters of over PROFILE_ROWS, are aligned to the seed alone.
    """
    star = star_alignment(seed, others, band)
    if not any("-" in r for r in star) or len(star) > PROFILE_ROWS or not all(star):
        return star
    kinds = list(dict.fromkeys([seed, *others]))
    rows = dict(zip(kinds, refined(progressive(kinds))))
    whole = [rows[s] for s in (seed, *others)]
    return whole if pair_sum(whole) > pair_sum(star) else star


def align_clusters(reads: DataFrame, keys: list[str], seed: str = "seed", seq: str = "full_NT", count: str = "readcount", band: int = 5) -> DataFrame:
    """keys, sequence (with gaps) and count: each cluster's reads in a multiple alignment with its seed (see cluster_alignment). Clusters are as small as their UMIs' reads."""
    distinct = reads.groupBy(*keys, seed, seq).agg(F.sum(count).alias(count))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.select(*keys).schema)

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(seq)
        lines = cluster_alignment(rows[seed].iloc[0], rows[seq].tolist(), band)[1:]
        return pd.DataFrame({**dict(zip(keys, key)), "sequence": lines, count: rows[count]})

    return distinct.groupBy(*keys).applyInPandas(one, f"{kinds}, sequence string, `{count}` bigint")


def chicken_regions(fr_hits: DataFrame, seq: str = "seq", loose: bool = False) -> DataFrame:
    """CDRs between framework hits: struct columns FR1 to FR4 (query_start, query_end, sbjct_start, sbjct_end, length; from 1), null without a hit.

    Strict: a framework counts if its alignment reaches the end next to the CDR. Loose: ends are extrapolated. E/F where a CDR can't be cut.
    Adds CDR1 to CDR3, and failed (no CDR3).
    """

    def end(f: str):
        h = F.col(f)
        return h["query_end"] + h["length"] - h["sbjct_end"] if loose else F.when(h["sbjct_end"] == h["length"], h["query_end"])

    def start(f: str):
        h = F.col(f)
        return h["query_start"] - (h["sbjct_start"] - 1) if loose else F.when(h["sbjct_start"] == 1, h["query_start"])

    out = fr_hits
    for i in (1, 2, 3):
        a, b = end(f"FR{i}"), start(f"FR{i + 1}")
        out = out.withColumn(f"CDR{i}", F.coalesce(F.when((b > a) & (a >= 0), F.substring(F.col(seq), a + 1, b - a - 1)), F.lit("E/F")))
    return out.withColumn("failed", F.col("CDR3") == "E/F")
