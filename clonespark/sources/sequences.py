"""FASTA and FASTQ files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark.sources.lines import numbered_lines


def read_fasta(spark: SparkSession, path: str | list[str], upper: bool = True) -> DataFrame:
    """name, sequence (of all lines, upper-cased if asked), file and _row_id.

    A file that doesn't begin with > is an error. Records are split by Spark's reader, so large files are read in parallel.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_row_id"))
    firsts = records.groupBy("file", "_start").agg(F.min("_row_id").alias("_row_id")).filter("_start = 0").select("_row_id", F.lit(True).alias("_first"))
    marked = records.join(firsts, "_row_id", "left")  # a row for each file: Spark sees if that is few
    body = F.when(F.col("_first") & ~F.col("value").startswith(">"), F.raise_error(F.concat(F.lit("not FASTA: "), F.col("file")))).otherwise(F.regexp_replace("value", "^>", ""))
    lines = marked.select("_row_id", "file", body.alias("b")).filter(F.trim("b") != "")
    seq = F.regexp_replace(F.regexp_replace("b", r"^[^\n]*\n?", ""), r"[\r\n]", "")
    return lines.select(F.regexp_replace(F.regexp_extract("b", r"^([^\n]*)", 1), r"\r$", "").alias("name"), (F.upper(seq) if upper else seq).alias("sequence"), "file", "_row_id")


def read_clusters(spark: SparkSession, pattern: str) -> DataFrame:
    """FASTA files (or folders of them) named umi_sequences_reads.fasta: umi, n_seq, rc_sum, readcount (the record's name), sequence."""
    parts = F.split(F.regexp_extract("file", r"([^/=]+)\.fasta(?:/[^/]*)?$", 1), "_")
    return read_fasta(spark, pattern, upper=False).select(F.get(parts, F.lit(0)).alias("umi"), F.get(parts, F.lit(1)).cast("bigint").alias("n_seq"), F.get(parts, F.lit(2)).cast("bigint").alias("rc_sum"), F.col("name").cast("bigint").alias("readcount"), "sequence", "_row_id")


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """id, sequence, plus, quality of each record of four lines; .gz files too.

    Lines go to records by their number in the file, so splits may begin anywhere.
    """
    # Dealt by record before they are put together: a task that reads a whole compressed file would sort all its lines for that.
    lines = numbered_lines(spark, path).withColumn("record", F.floor(F.col("line") / 4)).repartition("file", "record")
    names = ("id", "sequence", "plus", "quality")
    four = lines.groupBy("file", "record").agg(*(F.max(F.when(F.col("line") % 4 == i, F.col("value"))).alias(name) for i, name in enumerate(names)))
    return four.select(F.regexp_replace("id", "^@", "").alias("id"), "sequence", "plus", "quality", "file", "record")


def paired_files(spark: SparkSession, folder: str) -> DataFrame:
    """R1 files of a folder with their R2 mates: sample, r1, r2, size; largest first."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.fastq.gz").load(folder).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    parts = files.select("path", "length", F.regexp_extract(name, r"^(.*)_S\d+_L\d+_R[12]_.*\.fastq\.gz$", 1).alias("sample"), F.regexp_replace(name, r"_R[12]_", "_R_").alias("stem"), F.regexp_extract(name, r"_S\d+_L\d+_(R[12])_", 1).alias("mate"))
    a, b = parts.filter("mate = 'R1'"), parts.filter("mate = 'R2'")
    both = a.join(b.select("stem", F.col("path").alias("r2"), F.col("length").alias("l2")), "stem")
    return both.select("sample", F.col("path").alias("r1"), "r2", (F.col("length") + F.col("l2")).alias("size")).orderBy(F.desc("size"))


def write_fasta(df: DataFrame, path: str, name: str = "name", seq: str = "sequence", order_col: str | None = None) -> None:
    """Records of a name line and a sequence line; sorted if an order is given."""
    rows = df.orderBy(order_col) if order_col else df
    rows.select(F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.coalesce(F.col(seq), F.lit(""))).alias("value")).write.mode("overwrite").text(path)


def write_clusters(df: DataFrame, path: str, umi: str = "umi", seq: str = "sequence", count: str = "readcount") -> None:
    """A folder of FASTA for each UMI, named umi_sequences_reads.fasta, with records named by their read counts: what read_clusters reads."""
    sums = df.groupBy(umi).agg(F.count("*").alias("_n"), F.sum(count).alias("_sum"))
    name = F.concat(F.concat_ws("_", F.col(umi), F.col("_n").cast("string"), F.col("_sum").cast("string")), F.lit(".fasta"))
    record = F.concat(F.lit(">"), F.col(count).cast("string"), F.lit("\n"), F.col(seq))
    df.join(sums, umi).select(record.alias("value"), name.alias("cluster")).repartition("cluster").write.mode("overwrite").partitionBy("cluster").text(path)
