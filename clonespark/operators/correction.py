"""Error correction across samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonespark.operators.filters import without_one_hot
from clonespark.scratch import Scratch


def substitutions(seq: Column) -> Column:
    """The sequence with one base replaced by another, N included."""
    places = F.sequence(F.lit(1), F.length(seq))
    changed = F.flatten(F.transform(places, lambda i: F.transform(F.array(*map(F.lit, "ATGCN")), lambda b: F.concat(F.substring(seq, F.lit(1), i - 1), b, F.substring(seq, i + 1, F.length(seq))))))
    return F.when(F.length(seq) > 0, F.filter(changed, lambda x: x != seq)).otherwise(F.array().cast("array<string>"))


def zeroed(df: DataFrame, key: str, seq: str, sample: str, evalue: float, neighbours: DataFrame, scratch: Scratch) -> DataFrame:
    """Keys whose count in a sample is an error: a neighbour that is itself none has more than 1 / evalue times as many reads.

    Only clones with reads * evalue of 2 or more act, on neighbours with fewer than reads * evalue. So reads fall along a chain by
    the factor evalue: a round settles the clones on which no unsettled one acts, and there are as many rounds as a chain has
    links, a logarithm of the largest count.
    """
    counts = df.select(F.col(key).alias("k"), F.col(sample).cast("double").alias("n")).filter("n > 0")
    acts = neighbours.join(counts.select(F.col("k").alias("from"), F.col("n").alias("fn")), "from").join(counts.select(F.col("k").alias("to"), F.col("n").alias("tn")), "to")
    edges = scratch.save(acts.filter((F.col("fn") * evalue >= 2) & (F.col("tn") < F.col("fn") * evalue)).select("from", "to"))
    out = None
    while not edges.isEmpty():
        # actors that nothing acts on are real: what they act on is zeroed, and those edges are done
        real = edges.select(F.col("from").alias("k")).distinct().join(edges.select(F.col("to").alias("k")).distinct(), "k", "left_anti")
        hit = scratch.save(edges.join(real.select(F.col("k").alias("from")), "from", "left_semi").select(F.col("to").alias("k")).distinct())
        out = hit if out is None else out.unionAll(hit)
        settled = hit.unionAll(real)
        edges = scratch.save(edges.join(settled.select(F.col("k").alias("from")), "from", "left_anti").join(hit.select(F.col("k").alias("to")), "to", "left_anti"))
    return out if out is not None else df.select(F.col(key).alias("k")).limit(0)


def correct_errors(df: DataFrame, key: str, seq: str, samples: list[str], evalue: float) -> DataFrame:
    """Counts with errors set to 0 sample by sample, without the rows that then have no read, or one in a single sample.

    Sequences are expected once; of repeated ones, each row takes part.
    """
    scratch = Scratch(df.sparkSession)
    around = df.select(F.col(key).alias("from"), F.explode(substitutions(F.col(seq))).alias("_s"))
    neighbours = scratch.save(around.join(df.select(F.col(key).alias("to"), F.col(seq).alias("_s")), "_s").select("from", "to"))
    out = df
    for sample in samples:
        errors = zeroed(df, key, seq, sample, evalue, neighbours, scratch).select(F.col("k").alias(key), F.lit(True).alias("_zero"))
        out = out.join(errors, key, "left").withColumn(sample, F.when(F.col("_zero"), 0).otherwise(F.col(sample))).drop("_zero")
    return without_one_hot(out.select(df.columns), samples)


