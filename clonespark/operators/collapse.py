"""Grouping rows by sequence: sums, pivots, and the first row's values for what isn't summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonespark.functions.dna import gene_family, translate_dna, trim_to_frame
from clonespark.scratch import Scratch

# Isotypes of the wide tables.
ISOTYPES7 = ["M", "G1", "G2", "G3", "G4", "A1", "A2"]
ISOTYPES9 = ["M", "D", "E", "G1", "G2", "G3", "G4", "A1", "A2"]


def first_row(df: DataFrame, keys: list[str], order_col: str, sums: list[str]) -> DataFrame:
    """One row for each key: the sums, and the other columns of the row that comes first in order_col."""
    rest = [c for c in df.columns if c not in keys and c not in sums]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order_col)).alias("_first"), *(F.sum(c).alias(c) for c in sums)) if rest else df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    wanted = {**{c: F.col(c) for c in keys + sums}, **{c: F.col(f"_first.{c}").alias(c) for c in rest}}
    return out.select(*(wanted[c] for c in df.columns))


def collapse_isotypes(df: DataFrame, seq: str = "full_NT", isotype: str = "isotype", count: str = "readcount") -> DataFrame:
    """Read counts by sequence and isotype."""
    return df.groupBy(seq, isotype).agg(F.sum(count).alias(count))


def trim_and_merge(df: DataFrame, order_col: str, seq: str = "full_NT", fr1_to: str = "FR1_to", keys: tuple[str, ...] = ("isotype",), sums: tuple[str, ...] = ("readcount",)) -> DataFrame:
    """Sequences trimmed to their frame and merged; rows without a framework 1 are dropped. Adds full_AA and drops fr1_to."""
    trimmed = df.filter(F.col(fr1_to).isNotNull()).withColumn(seq, trim_to_frame(seq, fr1_to)).drop(fr1_to)
    return first_row(trimmed, [seq, *keys], order_col, list(sums)).withColumn("full_AA", translate_dna(seq))


def isotype_pivot(df: DataFrame, seq: str = "full_NT", isotype: str = "isotype", count: str = "readcount", isotypes: list[str] | None = None) -> DataFrame:
    """A column of read counts for each isotype, 0 where there is none; rows of other isotypes are dropped."""
    names = ISOTYPES7 if isotypes is None else isotypes
    wide = df.filter(F.col(isotype).isin(names)).groupBy(seq).pivot(isotype, names).agg(F.sum(count))
    return wide.fillna(0, names)


def network_pivot(df: DataFrame, order_col: str, seq: str = "full_NT", sample: str = "sample", isotype: str = "isotype", count: str = "readcount") -> DataFrame:
    """By sample and sequence: nine isotype columns instead of isotype and count, the first row's values for the rest."""
    wide = df.select("*", *(F.when(F.col(isotype) == i, F.col(count)).otherwise(F.lit(0)).cast("bigint").alias(i) for i in ISOTYPES9)).drop(isotype, count)
    return first_row(wide, [sample, seq], order_col, ISOTYPES9)


def timepoint_arrays(df: DataFrame, order_col: str, points: list[str], seq: str = "full_NT", isotype: str = "isotype") -> DataFrame:
    """By sequence, an array of counts over the time points for each of nine isotypes, named IGHM and so on in the input.

    An isotype outside the nine is an error, as its counts would be lost.
    """
    known = F.substring(F.col(isotype), 4, 10)
    checked = df.withColumn("_iso", F.when(known.isin(ISOTYPES9), known).otherwise(F.raise_error(F.concat(F.lit("unknown isotype "), F.coalesce(F.col(isotype), F.lit("null"))))))
    cells = [F.sum(F.when(F.col("_iso") == i, F.col(p)).otherwise(0)).cast("bigint").alias(f"_{i}_{p}") for i in ISOTYPES9 for p in points]
    rest = [c for c in df.columns if c not in (seq, isotype, *points)]
    out = checked.groupBy(seq).agg(F.min_by(F.struct(*rest), F.col(order_col)).alias("_first"), *cells)
    return out.select(seq, *(F.col(f"_first.{c}").alias(c) for c in rest), *(F.array(*(f"_{i}_{p}" for p in points)).alias(i) for i in ISOTYPES9))


def dotted(counts: Column | str) -> Column:
    """An array of counts as text, with dots between: for sinks."""
    return F.array_join(F.transform(F.col(counts) if isinstance(counts, str) else counts, lambda x: x.cast("string")), ".")


def numbered(df: DataFrame, order: list[Column | str], name: str, by: list[str] | None = None) -> DataFrame:
    """Adds a running number from 1 in the given order, within the values of `by` if any.

    A window over all rows, or over a key that holds many, is one task's work. Here rows are dealt by ranges of the order and numbered within
    them; what the ranges before hold of each key is added.
    """
    keys, cols = by or [], [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*cols).withColumn("_part", F.spark_partition_id())
    local = Scratch(df.sparkSession).save(ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*cols))))
    totals = local.groupBy("_part", *keys).agg(F.max("_place").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, ["_part", *keys]).withColumn(name, F.col("_before") + F.col("_place")).select(*df.columns, name)


def set_ids(df: DataFrame, seq: str, order_col: str, prefix: str = "", id_col: str = "seq_id") -> DataFrame:
    """An id of prefix, length and running number among the sequences of that length, in order_col."""
    out = numbered(df.withColumn("_len", F.length(seq)), [order_col], "_number", ["_len"])
    return out.select(F.concat(F.lit(prefix), F.col("_len").cast("string"), F.lit("-"), F.col("_number").cast("string")).alias(id_col), *df.columns)


def rarefy(df: DataFrame, size: int, count: str = "readcount", seed: int = 0, id_col: str | None = None) -> DataFrame:
    """`size` reads drawn without replacement, counted again by row; all if there are fewer.

    Every read gets a hash of its row, its number in it and the seed, and those with the `size` least hashes stay. With id_col the draw is the same
    however rows are dealt; without it, rows are told apart by where they are. The hashes' beginnings are counted first, so that only reads that begin as
    the last one drawn does are put in order.
    """
    keys = [c for c in df.columns if c != count]
    row = F.col(id_col).cast("string") if id_col else F.monotonically_increasing_id().cast("string")
    scratch = Scratch(df.sparkSession)
    given = df.filter(F.col(count) > 0).withColumn("_row", row)
    given = given if id_col else scratch.save(given)
    reads = given.withColumn("_read", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count).cast("bigint"))))
    reads = reads.withColumn("_draw", F.md5(F.concat_ws("-", F.col("_row"), F.col("_read").cast("string"), F.lit(str(seed)))))
    begin = F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int")
    total, last, before = 0, None, 0
    for r in sorted(reads.groupBy(begin.alias("b")).count().collect()):  # 65,536 at most
        if total + r["count"] > size:
            last, before = r["b"], total
            break
        total += r["count"]
    if last is not None:
        edge = reads.filter(begin == last).orderBy("_draw", "_row", "_read").limit(size - before)
        reads = reads.filter(begin < last).unionAll(edge)
    return reads.groupBy("_row", *keys).agg(F.count("*").alias(count)).select(*df.columns)


def union_samples(samples: dict[str, DataFrame], tag: str = "sample") -> DataFrame:
    """Tables of several samples with the sample's name; columns are those of the first."""
    out = None
    for name, df in samples.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged.select(*(c for c in tagged.columns if c in out.columns)), allowMissingColumns=True)
    return out


def sample_pairs(samples: DataFrame, name: str, order_col: str, added: list[str] | None = None) -> DataFrame:
    """Pairs of samples (a before b in order_col), with one of `added` at least, if given."""
    a, b = samples.select(F.col(name).alias("a"), F.col(order_col).alias("_a")), samples.select(F.col(name).alias("b"), F.col(order_col).alias("_b"))
    pairs = a.join(b, F.col("_a") < F.col("_b"))
    return (pairs.filter(F.col("a").isin(added) | F.col("b").isin(added)) if added else pairs).select("a", "b")


def partition_rows(df: DataFrame, index: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is in index, and the others."""
    return df.join(index, key, "left_semi"), df.join(index, key, "left_anti")


def component_reads(df: DataFrame, component: str, counts: list[str]) -> DataFrame:
    """Reads of each component over all count columns."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in counts[1:]), F.coalesce(F.col(counts[0]), F.lit(0)))
    return df.groupBy(component).agg(F.sum(total).alias("reads"), F.count("*").alias("size"))


def size_rank(df: DataFrame, component: str, order_col: str, name: str = "rank") -> DataFrame:
    """Components numbered from 1 by size, largest first; of equal ones the one whose first row comes first."""
    sizes = df.groupBy(component).agg(F.count("*").alias("_size"), F.min(order_col).alias("_first"))
    ranked = numbered(sizes, [F.desc("_size"), F.col("_first")], name)
    return df.join(ranked.select(component, F.col(name).cast("int").alias(name)), component)


def shared_components(df: DataFrame, component: str, sample: str = "sample") -> DataFrame:
    """Rows of components that several samples have."""
    several = df.groupBy(component).agg(F.countDistinct(sample).alias("_n")).filter("_n > 1").select(component)
    return df.join(several, component, "left_semi")


def with_family(df: DataFrame, *genes: str) -> DataFrame:
    """Gene columns without alleles."""
    return df.withColumns({g: gene_family(g) for g in genes})
