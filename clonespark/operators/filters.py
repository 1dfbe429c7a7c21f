"""Row filters and their pass rates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CDRS = ["CDR1_AA", "CDR2_AA", "CDR3_AA"]


def umi_length(umi: str = "umi", low: int = 13, high: int = 15) -> Column:
    return F.length(umi).between(low, high)


def c_gene_hit(aln: str = "aln", whole: tuple[int, int] = (74, 94), mismatches: int = 5, sbjct_start: int = 10, query_start: int = 400) -> Column:
    """The top alignment to a constant gene is long, close and in place."""
    a = F.get(F.col(f"{aln}.alignments"), F.lit(0))
    return F.coalesce((F.col(f"{aln}.num_alignments") > 0) & a["whole"].between(*whole) & (a["num_mismatches"] <= mismatches) & (a["sbjct_start"] <= sbjct_start) & (a["query_start"] <= query_start), F.lit(False))


def functional(isotypes: list[str] | None = None, v: str = "V_gene", j: str = "J_gene", protein: str = "full_AA", cdrs: list[str] | None = None) -> Column:
    """An isotype of the list, both genes, all CDRs, and no stop or unknown residue in any of them or the whole."""
    parts = CDRS if cdrs is None else cdrs
    tests = [F.col(c).isNotNull() & (F.col(c) != "N/A") for c in (v, j, *parts)]
    tests += [~F.col(c).contains(x) for c in (protein, *parts) for x in ("X", "*")]
    if isotypes is not None:
        tests.insert(0, F.col("isotype").isin(isotypes))
    return F.coalesce(reduce(and_, tests), F.lit(False))


def donor_functional(min_length: int = 250, min_fr1: int = 80) -> Column:
    """Both genes, a hit in frame, and a sequence long enough with a whole framework 1."""
    named = [F.col(c).isNotNull() & (F.col(c) != "N/A") for c in ("V_gene", "J_gene")]
    return F.coalesce(reduce(and_, named) & F.col("hit") & (F.col("VJ_frame") != "Out") & (F.length("full_NT") >= min_length) & (F.col("FR1_to") >= min_fr1), F.lit(False))


def pass_rates(df: DataFrame, keep: Column, count: str = "readcount") -> DataFrame:
    """Rows and reads, how many pass, and the rates rounded to two places; null rates for an empty table."""
    return df.agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum(keep.cast("bigint")), F.lit(0)).alias("rows_passed"),
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("n_reads"), F.coalesce(F.sum(F.when(keep, F.col(count)).otherwise(0)), F.lit(0)).cast("bigint").alias("reads_passed"),
    ).withColumns({"row_rate": F.round(F.try_divide("rows_passed", "n_rows"), 2), "read_rate": F.round(F.try_divide("reads_passed", "n_reads"), 2)})


def _total(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0)) for c in columns))


def without_singletons(df: DataFrame, samples: list[str]) -> DataFrame:
    """Rows with more than one read over the samples."""
    return df.filter(_total(samples) > 1)


def without_one_hot(df: DataFrame, samples: list[str]) -> DataFrame:
    """Rows but those without a read, and those with a single read in one sample. Counts aren't negative."""
    return df.filter(_total(samples) > 1)


def consensus_clusters(n_seq: str = "n_seq", reads: str = "rc_sum") -> Column:
    """Clusters that can have a consensus: neither one read nor two sequences of one read each."""
    return ~((F.col(reads) == 1) | ((F.col(n_seq) == 2) & (F.col(reads) == 2)))


def known_isotype(isotypes: list[str], isotype: str = "isotype") -> Column:
    return F.col(isotype).isin(isotypes)
