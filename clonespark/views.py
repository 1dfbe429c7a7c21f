"""Sequences made of the plain tables, the same in Spark and in any SQL with md5: for queries, tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, DNA = "0123456789abcdef", "ACGTACGTACGTACGT"
AMINO = "ACDEFGHIKLMNPQRS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt to all tasks: what is made of a table of few splits would be few tasks' work."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), key)


def letters(x: Column, alphabet: str, length: int, salts: tuple[str, ...] = ("",)) -> Column:
    """A sequence of up to 32 letters for each salt."""
    parts = [F.translate(F.md5(F.concat(x.cast("string"), F.lit(s))), HEX, alphabet) for s in salts]
    return F.substring(F.concat(*parts) if len(parts) > 1 else parts[0], 1, length)


def dna(x: Column | str, length: int, salts: tuple[str, ...] = ("",)) -> Column:
    return letters(F.col(x) if isinstance(x, str) else x, DNA, length, salts)


def protein(x: Column | str, length: int, salts: tuple[str, ...] = ("",)) -> Column:
    return letters(F.col(x) if isinstance(x, str) else x, AMINO, length, salts)


def clones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From part: id, seq (12 bases), V_gene, J_gene (with allele), readcount, component_ID."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), dna("p_partkey", 12).alias("seq"), F.concat(F.col("p_brand"), F.lit("*01")).alias("V_gene"), F.substring("p_type", 1, 5).alias("J_gene"),
        F.col("p_size").cast("bigint").alias("readcount"), (F.col("p_partkey") % 97).alias("component_ID"),
    )


#: The same in DuckDB SQL, as the first part of a WITH clause.
CLONES = f"""clones AS (SELECT p_partkey AS id, substr(translate(md5(CAST(p_partkey AS VARCHAR)), '{HEX}', '{DNA}'), 1, 12) AS seq,
    p_brand || '*01' AS V_gene, substr(p_type, 1, 5) AS J_gene, CAST(p_size AS BIGINT) AS readcount, p_partkey % 97 AS component_ID FROM part)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From lineitem: row (its order), full_NT (24 bases by order), isotype (one of nine, or X), sample, TP1 to TP3, readcount."""
    k = ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")
    names = F.array(*map(F.lit, ["M", "D", "E", "G1", "G2", "G3", "G4", "A1", "A2", "X"]))
    return table(spark, sf_dir, "lineitem").select(
        k.alias("row"), dna(F.col("l_orderkey") % 500, 24).alias("full_NT"), F.get(names, (F.col("l_partkey") % 10).cast("int")).alias("isotype"), (F.col("l_suppkey") % 3).alias("sample"),
        F.col("l_quantity").cast("bigint").alias("readcount"), *(((F.col("l_partkey") + i) % 5).alias(f"TP{i}") for i in (1, 2, 3)), F.concat(F.lit("V"), (F.col("l_suppkey") % 7).cast("string")).alias("V_gene"),
        (F.col("l_partkey") % 12).cast("int").alias("FR1_to"),
    )


READS = f"""reads AS (SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS row, substr(translate(md5(CAST(l_orderkey % 500 AS VARCHAR)), '{HEX}', '{DNA}'), 1, 24) AS full_NT,
    (['M', 'D', 'E', 'G1', 'G2', 'G3', 'G4', 'A1', 'A2', 'X'])[l_partkey % 10 + 1] AS isotype, l_suppkey % 3 AS sample, CAST(l_quantity AS BIGINT) AS readcount,
    (l_partkey + 1) % 5 AS TP1, (l_partkey + 2) % 5 AS TP2, (l_partkey + 3) % 5 AS TP3, 'V' || CAST(l_suppkey % 7 AS VARCHAR) AS V_gene, CAST(l_partkey % 12 AS INTEGER) AS FR1_to FROM lineitem)"""
