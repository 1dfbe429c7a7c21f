"""Diversity of a repertoire, overlap of two, and quality of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def diversity(df: DataFrame, count: str, by: list[str] | None = None) -> DataFrame:
    """Richness, Shannon entropy (natural), Gini-Simpson and Simpson index, and Berger-Parker dominance of counts.

    One pass: with S the sum of counts c, entropy is ln S - sum(c ln c) / S and Simpson's index sum(c^2) / S^2. Zero counts
    add to richness only; null without any count.
    """
    c = F.col(count).cast("double")
    keys = by or []
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("richness"), F.sum(c).alias("s"), F.sum(c * c).alias("s2"), F.max(c).alias("m"), F.sum(F.when(c > 0, c * F.ln(c)).otherwise(0.0)).alias("l")
    )
    total, simpson = F.nullif(F.col("s"), F.lit(0.0)), F.col("s2") / F.pow(F.nullif(F.col("s"), F.lit(0.0)), 2)
    return sums.select(*keys, "richness", (F.ln(total) - F.col("l") / total).alias("shannon"), (1 - simpson).alias("gini_simpson"), simpson.alias("simpson"), (F.col("m") / total).alias("berger_parker"))


def morisita(a: DataFrame, b: DataFrame, id_col: str, count: str) -> DataFrame:
    """Morisita-Horn overlap of two count tables, 2 sum(xy) / (sum x^2 / X^2 + sum y^2 / Y^2) / (XY) by frequencies x / X, y / Y."""
    x, y = (df.select(F.col(id_col).alias("id"), F.col(count).cast("double").alias(n)) for df, n in ((a, "x"), (b, "y")))
    both = x.join(y, "id", "full_outer").select(F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("y", F.lit(0.0)).alias("y"))
    sums = both.agg(*(F.sum(e).alias(n) for n, e in {"xy": F.col("x") * F.col("y"), "xx": F.col("x") * F.col("x"), "yy": F.col("y") * F.col("y"), "sx": F.col("x"), "sy": F.col("y")}.items()))
    return sums.select(F.try_divide(2 * F.col("xy"), F.col("xx") + F.col("yy")).alias("morisita_counts"), F.try_divide(2 * F.col("xy"), (F.try_divide("xx", F.col("sx") * F.col("sx")) + F.try_divide("yy", F.col("sy") * F.col("sy"))) * F.col("sx") * F.col("sy")).alias("morisita_horn"))


def phred(quality: Column | str, offset: int = 33) -> Column:
    """Scores of a FASTQ quality line."""
    q = F.col(quality) if isinstance(quality, str) else quality
    return F.when(F.length(q) > 0, F.transform(F.split(q, ""), lambda c: F.ascii(c) - offset)).otherwise(F.array().cast("array<int>"))


def median_score(scores: Column) -> Column:
    """The median, cut to a whole number."""
    s, n = F.array_sort(scores), F.size(scores)
    mid = (F.try_element_at(s, (F.floor((n - 1) / 2) + 1).cast("int")) + F.try_element_at(s, (F.floor(n / 2) + 1).cast("int"))) / 2
    return F.floor(mid).cast("int")


def read_totals(reads: DataFrame, scores: str) -> DataFrame:
    """Number of reads, least, greatest and mean length, and mean score of all bases."""
    n = F.size(scores)
    total = F.aggregate(scores, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return reads.agg(F.count("*").alias("n_reads"), F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.avg(n).alias("mean_length"), F.try_divide(F.sum(total), F.sum(n)).alias("mean_score"))


def score_histogram(reads: DataFrame, scores: str, forward: int = 0, reverse: int = 0, top: int = 40, wrap: bool = False) -> DataFrame:
    """For each score from top to 0: reads by their least and by their median score, with percentages and running sums.

    `forward` and `reverse` scores are trimmed from the ends; reads without scores left are not counted. Scores above top count
    as top, or with wrap as top + 1 places below (41 as 0).
    """
    trimmed = reads.select(F.slice(F.col(scores), forward + 1, F.greatest(F.size(scores) - forward - reverse, F.lit(0))).alias("s")).filter(F.size("s") > 0)
    bin_of = (lambda x: F.when(x > top, x - (top + 1)).otherwise(x)) if wrap else (lambda x: F.least(x, F.lit(top)))
    binned = trimmed.select(bin_of(F.array_min("s")).alias("least"), bin_of(median_score(F.col("s"))).alias("median"))
    # at most (top + 1)^2 pairs of bins are left after this, whatever the reads
    counts = binned.groupBy("least", "median").count()
    bins = reads.sparkSession.range(top + 1).select(F.col("id").cast("int").alias("qscore"))
    both = bins
    for name in ("least", "median"):
        each = counts.groupBy(F.col(name).alias("qscore")).agg(F.sum("count").alias(name))
        both = both.join(F.broadcast(each), "qscore", "left")
    down, every = Window.orderBy(F.desc("qscore")).rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(F.desc("qscore")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = both.fillna(0)
    for name in ("least", "median"):
        total = F.sum(name).over(every)
        out = out.withColumns({f"{name}_pct": F.try_divide(100.0 * F.col(name), total), f"{name}_cum": F.sum(name).over(down), f"{name}_cum_pct": F.try_divide(100.0 * F.sum(name).over(down), total)})
    return out
