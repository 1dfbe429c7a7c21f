"""Protein functions: liability motifs, hydropathy, charge, residue numbering."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonespark.functions.dna import _col, sequence_class, translate_dna
from clonespark.scratch import Scratch

# Liability motifs by the name of their column.
MOTIFS = {
    "Deamidation": "NS|NG|NH",
    "Aspartate_Isomerization": "DG|DS|DT|DD|DA",
    "N Glycosylation": "N[^P][ST]",
    "Cleavage": "DP|DQ|NS",
    "Oxidation": "[MW]",
    "Free Cysteine": "C",
    "Sulfation": "Y",
    "Methylation": "[KR]",
}
# Hydropathy of residues (Kyte and Doolittle, 1982).
HYDROPATHY = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5, "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5,
    "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2,
}
# pK of charged groups (Bjellqvist and others, 1993), and of ends that depend on the residue.
PK_PLUS = {"n": 7.5, "K": 10.0, "R": 12.0, "H": 5.98}
PK_MINUS = {"c": 3.55, "D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
PK_N_END = {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
PK_C_END = {"D": 4.55, "E": 4.75}


def motif_count(protein: Column | str, pattern: str) -> Column:
    """Matches of a pattern, from the left, none overlapping; 0 for null."""
    return F.coalesce(F.regexp_count(_col(protein), F.lit(pattern)), F.lit(0)).cast("bigint")


def motif_matches(protein: Column | str, pattern: str) -> Column:
    """The matches themselves, in order."""
    return F.coalesce(F.regexp_extract_all(_col(protein), F.lit(pattern), 0), F.array().cast("array<string>"))


def ptm_counts(df: DataFrame, protein: str = "query") -> DataFrame:
    """A column for each of MOTIFS."""
    return df.withColumns({name: motif_count(protein, p) for name, p in MOTIFS.items()})


def marked_residues(df: DataFrame, protein: str = "query", prefix: str = "R") -> DataFrame:
    """Adds residues: map from prefix and number (from 1) to the residue, before it a {bg_color:name} for each motif that it is in."""
    s = _col(protein)

    def inside(pattern: str) -> Column:
        """A text as long as the sequence, with a tilde where a match is: blanks for what stands before each match, tildes for the match."""
        found, rest = motif_matches(s, pattern), F.split(s, pattern)
        return F.array_join(F.zip_with(rest, found, lambda r, f: F.concat(F.repeat(F.lit(" "), F.length(r)), F.coalesce(F.repeat(F.lit("~"), F.length(f)), F.lit("")))), "")

    masks = F.struct(*(inside(p).alias(f"m{k}") for k, p in enumerate(MOTIFS.values())))

    def mark(m: Column, i: Column) -> Column:
        tags = [F.when(F.substring(m[f"m{k}"], i, F.lit(1)) == "~", F.lit(f"{{bg_color:{name}}}")).otherwise("") for k, name in enumerate(MOTIFS)]
        return F.struct(F.concat(F.lit(prefix), i.cast("string")).alias("key"), F.concat(*tags, F.substring(s, i, F.lit(1))).alias("value"))

    # masks are a variable of a function, so they are made once for a sequence and not anew for each residue
    marked = F.transform(F.array(masks), lambda m: F.map_from_entries(F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: mark(m, i))))[0]
    return df.withColumn("residues", F.when(F.length(s) > 0, marked).otherwise(F.create_map().cast("map<string,string>")))


def gravy(protein: Column | str) -> Column:
    """Mean hydropathy; unknown residues count as 0; null for an empty sequence."""
    s = _col(protein)
    table = F.create_map(*(F.lit(x) for pair in HYDROPATHY.items() for x in pair))
    total = F.aggregate(F.split(s, ""), F.lit(0.0), lambda t, c: t + F.coalesce(F.try_element_at(table, c), F.lit(0.0)))
    return F.when(F.length(s) > 0, total / F.length(s))


def charged_groups(protein: Column) -> tuple[list[tuple[Column, Column]], list[tuple[Column, Column]]]:
    """Number and pK of an upper-case sequence's groups that may be positive, and of those that may be negative."""
    end = lambda table, residue, other: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), residue), F.lit(other))
    n_end, c_end = end(PK_N_END, F.substring(protein, 1, 1), PK_PLUS["n"]), end(PK_C_END, F.substring(protein, -1, 1), PK_MINUS["c"])
    count = lambda c: F.length(protein) - F.length(F.replace(protein, F.lit(c)))
    plus = [(F.lit(1), n_end), *((count(c), F.lit(pk)) for c, pk in PK_PLUS.items() if c != "n")]
    minus = [(F.lit(1), c_end), *((count(c), F.lit(pk)) for c, pk in PK_MINUS.items() if c != "c")]
    return plus, minus


def charge(protein: Column, ph: Column) -> Column:
    """Net charge of an upper-case sequence at a pH."""
    plus, minus = charged_groups(protein)
    held = [n / (1 + F.pow(F.lit(10.0), ph - pk)) for n, pk in plus] + [-n / (1 + F.pow(F.lit(10.0), pk - ph)) for n, pk in minus]
    return reduce(lambda a, b: a + b, held)


def isoelectric_point(protein: Column | str, halvings: int = 60) -> Column:
    """The pH at which the charge is zero, by bisection; null for an empty sequence.

    Spark counts the charged groups once; the halvings of a batch go along together.
    """
    s = F.upper(_col(protein))
    plus, minus = charged_groups(s)
    positive = len(plus)

    def bisected(*columns: pd.Series) -> pd.Series:
        held = [c.to_numpy(np.float64) for c in columns]
        counts, pks = held[::2], held[1::2]
        low, high = np.zeros(len(columns[0])), np.full(len(columns[0]), 14.0)
        for _ in range(halvings):
            ph = (low + high) / 2
            total = np.zeros(len(ph))
            for k, (n, pk) in enumerate(zip(counts, pks)):
                total += n / (1 + np.power(10.0, ph - pk)) if k < positive else -n / (1 + np.power(10.0, pk - ph))
            low, high = np.where(total > 0, ph, low), np.where(total > 0, high, ph)
        return pd.Series((low + high) / 2)

    bisected.__annotations__ = {"columns": pd.Series, "return": pd.Series}
    point = F.pandas_udf(bisected, "double")(*(x.cast("double") for pair in plus + minus for x in pair))
    return F.when(F.length(s) > 0, point)


# Residue labels of CDR3; the letter of the label in the middle goes on as the longest sequence needs.
CDR3_LABELS = {
    "heavy": ("HCDR3", ["95", "96", "97", "98", "99", "100"], "100", ["101", "102"]),
    "light": ("LCDR3", ["24", "25", "26", "27", "28", "29", "30"], "30", ["31", "32", "33", "34"]),
}


def cdr3_labels(chain: str, longest: int) -> list[str]:
    """All labels, with as many letters after the middle one as the longest sequence needs, one at least."""
    _, left, middle, right = CDR3_LABELS[chain]
    letters = max(1, longest - len(left) - len(right))
    return left + [middle + chr(ord("A") + i) for i in range(letters)] + right


def number_cdr3(df: DataFrame, chain: str, seq: str = "query", nucleotides: bool = False) -> DataFrame:
    """Adds the sequence under HCDR3 or LCDR3 and residues: map from label to residue, blank where there is none.

    Two passes: the longest sequence of all gives the labels. The last labels are filled from the right, the others from the
    left. '-', 'X' and empty sequences have blanks only.
    """
    key, left, _, right = CDR3_LABELS[chain]
    s = translate_dna(seq) if nucleotides else _col(seq)
    none = _col(seq).isin("-", "X", "")
    longest = df.agg(F.max(F.when(~none, F.length(s)))).first()[0] or 0
    labels = cdr3_labels(chain, longest)
    n_right = F.least(F.lit(len(right)), F.greatest(F.length(s) - 1, F.lit(0)))
    n_left = F.length(s) - n_right

    def residue(i: int) -> Column:
        from_end = len(labels) - i  # 1: the last label
        r = F.when(F.lit(from_end) <= n_right, F.substring(s, F.length(s) - from_end + 1, F.lit(1))).when(F.lit(i) < n_left, F.substring(s, i + 1, 1)).otherwise("")
        return F.when(none, "").otherwise(r)

    filled = F.create_map(*(x for i, label in enumerate(labels) for x in (F.lit(label), residue(i))))
    return df.withColumns({key: F.when(none, F.lit("-")).otherwise(s), "residues": filled})


# First and last number of each region, and the label with a letter after which insertions go.
REGION_LABELS = {
    "light": ("L", {"FR1": (0, 23, None), "CDR1": (24, 34, "27A"), "FR2": (35, 49, None), "CDR2": (50, 56, None), "FR3": (57, 88, None), "CDR3": (89, 97, "95A"), "FR4": (98, 109, "106A")}),
    "heavy": ("H", {"FR1": (0, 30, None), "CDR1": (31, 35, "35A"), "FR2": (36, 49, None), "CDR2": (50, 65, "52A"), "FR3": (66, 94, "82A"), "CDR3": (95, 102, "100A"), "FR4": (103, 113, None)}),
}


def region_labels(chain: str, name: str, longest: int = 0) -> list[str]:
    """Labels of a region, with letters for the longest sequence."""
    letter, regions = REGION_LABELS[chain]
    first, last, extra = regions[name]
    labels = []
    for n in range(first, last + 1):
        labels.append(f"{letter}{n}")
        if extra and extra[:-1] == str(n):
            labels.append(f"{letter}{extra}")
    if extra and longest > len(labels):
        at = labels.index(f"{letter}{extra}") + 1
        labels[at:at] = [f"{letter}{extra[:-1]}{chr(ord(extra[-1]) + 1 + i)}" for i in range(longest - len(labels))]
    return labels


def running_max(df: DataFrame, value: Column, order_col: str, name: str) -> DataFrame:
    """Adds the greatest value of all rows up to a row, in order_col (rows of equal order count for each other or not as they fall).

    Rows are dealt by ranges of the order; each range has its own running maximum, and what the ranges before came to is held against it.
    """
    ranged = df.withColumn("_value", value).repartitionByRange(order_col).withColumn("_range", F.spark_partition_id())
    local = Scratch(df.sparkSession).save(ranged.withColumn(name, F.max("_value").over(Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0))))
    tops = local.groupBy("_range").agg(F.max("_value").alias("_top"))  # a row for each range
    before = tops.select("_range", F.max("_top").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    return local.join(F.broadcast(before), "_range").withColumn(name, F.greatest(name, "_before")).select(*df.columns, name)


def number_regions(df: DataFrame, chain: str, order_col: str, blank: str = "{bg_color:gray}-") -> DataFrame:
    """Adds a map from label to residue for each region that df has as a column: <region>_residues.

    FR1 is filled from the right and FR4 from the left; in others, what follows the lettered label is filled from the right and the
    rest from the left; regions without one from the left, cut to their labels. Nucleotides are translated. The light FR4, filled from
    the left through its letter, keeps for each row the labels that the longest sequence up to it, in order_col, called for.
    """
    out = df
    for name, (_, _, extra) in REGION_LABELS[chain][1].items():
        if name not in df.columns:
            continue
        s = F.when(sequence_class(name), translate_dna(name)).otherwise(F.col(name))
        out = out.withColumn(f"_{name}", s)
        longest = out.agg(F.max(F.length(f"_{name}"))).first()[0] or 0
        labels = region_labels(chain, name, longest)
        size = F.length(f"_{name}")
        growing = chain == "light" and name == "FR4" and longest > len(region_labels(chain, name))
        if growing:  # the running maximum over all rows, in their order
            out = running_max(out, size, order_col, "_running")
        tail = len(labels) - 1 - max(i for i, x in enumerate(labels) if x[-1].isalpha()) if extra else 0
        if name == "FR1":
            left = F.lit(0)
        elif name == "FR4" or not extra:
            left = F.least(size, F.lit(len(labels)))
        else:
            left = F.greatest(size - tail, F.lit(0))
        right = size - left if name == "FR1" or extra and name != "FR4" else F.lit(0)

        def residue(i: int, label: str, s: str = f"_{name}", left: Column = left, right: Column = right, size: Column = size, n: int = len(labels), growing: bool = growing) -> Column:
            place = F.lit(i)
            if growing:
                base = region_labels(chain, "FR4")
                at = base.index("L106A")
                known = F.greatest(F.col("_running"), F.lit(len(base)))
                extra_now = known - len(base)
                if i > at and label not in base:
                    return F.when(F.lit(i - at) > extra_now, F.lit(blank)).otherwise(F.when(place < left, F.substring(s, i + 1, 1)).otherwise(blank))
                if i > at:
                    place = F.lit(i - (n - len(base))) + extra_now
            from_end = n - i
            return F.when(F.lit(from_end) <= right, F.substring(s, size - from_end + 1, F.lit(1))).when(place < left, F.substring(F.col(s), (place + 1).cast("int"), F.lit(1))).otherwise(blank)

        filled = F.create_map(*(x for i, label in enumerate(labels) for x in (F.lit(label), F.coalesce(residue(i, label), F.lit(blank)))))
        out = out.withColumn(f"{name}_residues", filled).drop(f"_{name}", "_running")
    return out
