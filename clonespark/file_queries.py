"""Queries of readers and writers: tables written out in a format and read back."""

from __future__ import annotations

import io
import re
import zipfile

from pyspark.sql import functions as F

from clonespark import views as V
from clonespark.functions import cells
from clonespark.operators import collapse
from clonespark.plans import read_quality
from clonespark.queries import DNA36, part, query
from clonespark.scratch import Scratch
from clonespark.sources import database, delimited, sequences, trees

RAGGED = """c AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 5 = 0 THEN 'NULL' ELSE p_brand END AS brand,
    CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE CAST(p_size AS VARCHAR) END AS size FROM part)"""


def ragged(spark, sf_dir):
    """A path of lines without a header: three cells, or two, or four."""
    path = Scratch(spark).path()
    k = F.col("p_partkey")
    brand = F.when(k % 5 == 0, "NULL").otherwise(F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')))
    line = F.concat_ws(",", k.cast("string"), brand, F.when(k % 3 != 1, F.when(k % 7 == 0, "-").otherwise(F.col("p_size").cast("string"))), F.when(k % 3 == 0, F.lit("more")))
    V.table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    return path


@query(f"WITH {RAGGED} SELECT id, CASE brand WHEN 'NULL' THEN 'None' ELSE brand END AS brand, CASE WHEN p_partkey % 3 = 1 THEN '' ELSE size END AS size FROM c")
def read_padded(spark, sf_dir):
    return delimited.read_padded(spark, ragged(spark, sf_dir), names=["id", "brand", "size"]).drop("_row_id")


@query(f"WITH {RAGGED} SELECT id, brand, size FROM c WHERE p_partkey % 3 = 2")
def read_exact(spark, sf_dir):
    return delimited.read_exact(spark, ragged(spark, sf_dir), names=["id", "brand", "size"]).drop("_row_id")


@query(f"WITH {RAGGED} SELECT CAST(id AS BIGINT) AS id, brand, TRY_CAST(size AS INTEGER) AS size FROM c WHERE p_partkey % 3 = 2")
def read_typed(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string

    return delimited.read_exact(spark, ragged(spark, sf_dir), names=["id", "brand", "size"], schema=_parse_datatype_string("id bigint, brand string, size int")).drop("_row_id")


@query("SELECT * FROM (VALUES (0, 'p_partkey'), (1, 'p_name'), (2, 'p_brand'), (3, 'p_type'), (4, 'p_size'), (5, 'p_retailprice')) AS t(place, name)")
def read_header(spark, sf_dir):
    path = Scratch(spark).path()
    delimited.write_table(V.table(spark, sf_dir, "part"), path)
    return spark.createDataFrame(list(enumerate(delimited.header(spark, path))), "place int, name string")


@query("SELECT p_type AS kind, p_partkey AS key, CASE WHEN p_partkey % 4 = 0 THEN 'N/A' ELSE p_name END AS name FROM part")
def write_columns(spark, sf_dir):
    """Some columns in another order, null as N/A, in files of 100 rows."""
    path = Scratch(spark).path()
    df = V.table(spark, sf_dir, "part").withColumn("name", F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")))
    delimited.write_table(df.withColumnsRenamed({"p_type": "kind", "p_partkey": "key"}), path, ["kind", "key", "name"], sep="\t", na="N/A", rows_per_file=100)
    return spark.read.csv(path, sep="\t", header=True, schema="kind string, key bigint, name string")


@query("SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) AS files, count(*) AS rows FROM part")
def split_files(spark, sf_dir):
    path = Scratch(spark).path()
    delimited.write_table(V.table(spark, sf_dir, "part").select("p_partkey", "p_name").coalesce(1), path, rows_per_file=100)
    return spark.read.csv(path, header=True).select(F.col("_metadata.file_path").alias("f")).agg(F.countDistinct("f").alias("files"), F.count("*").alias("rows"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier")
def union_folders(spark, sf_dir):
    scratch = Scratch(spark)
    folders = [scratch.path(), scratch.path()]
    for folder, table, key in zip(folders, ("customer", "supplier"), ("c_custkey", "s_suppkey")):
        delimited.write_table(V.table(spark, sf_dir, table).select(F.col(key).alias("id"), F.col(f"{key[0]}_name").alias("name")), f"{folder}/a.csv")
    out = scratch.path()
    delimited.union_folders(spark, folders, out, ["a.csv"])
    return delimited.read_union(spark, [f"{out}/a.csv"])


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS name, {DNA36} AS sequence FROM part")
def read_fasta(spark, sf_dir):
    path = Scratch(spark).path()
    sequences.write_fasta(part(spark, sf_dir).select(F.col("p_partkey").alias("name"), F.lower("seq").alias("sequence")), path)
    return sequences.read_fasta(spark, path).select("name", "sequence")


@query(f"SELECT 'part ' || CAST(p_partkey AS VARCHAR) || ' x' AS name, lower(substr({DNA36}, 1, 20)) || substr({DNA36}, 21) AS sequence FROM part")
def read_fasta_lines(spark, sf_dir):
    """Sequences of several lines, their case as it is."""
    path = Scratch(spark).path()
    record = F.concat(F.lit(">part "), F.col("p_partkey").cast("string"), F.lit(" x\n"), F.lower(F.substring("seq", 1, 20)), F.lit("\n"), F.substring("seq", 21, 9), F.lit("\n"), F.substring("seq", 30, 99))
    part(spark, sf_dir).select(record.alias("value")).write.text(path)
    return sequences.read_fasta(spark, path, upper=False).select("name", "sequence")


@query(f"SELECT {DNA36} AS sequence, CAST(p_size AS BIGINT) AS readcount FROM part")
def read_reads(spark, sf_dir):
    path = Scratch(spark).path()
    delimited.write_table(part(spark, sf_dir).select(F.col("seq").alias("any"), F.col("p_size").alias("header")), path)
    return delimited.read_reads(spark, path)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS "from", p_name AS "to", CAST(p_size % 4 AS INTEGER) AS dist FROM part WHERE p_size % 4 > 0""")
def read_edges(spark, sf_dir):
    """Parts of an edge table, written apart and read as one."""
    scratch = Scratch(spark)
    edges = V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("from"), F.col("p_name").alias("to"), (F.col("p_size") % 4).alias("dist"))
    paths = [scratch.path() for _ in range(3)]
    for i, path in enumerate(paths):
        delimited.write_table(edges.filter(F.col("from") % 3 == i), path)
    return delimited.read_edges(spark, paths, positive=True)


QUALITY = "translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', '!#%&+05:=?ACEGHI')"


def fastq(spark, sf_dir):
    """A path of gzipped FASTQ: 32 bases and scores from 0 to 40 for each part."""
    path = Scratch(spark).path()
    h = F.translate(F.md5(F.col("p_partkey").cast("string")), V.HEX, "!#%&+05:=?ACEGHI")
    record = F.concat_ws("\n", F.concat(F.lit("@r"), F.col("p_partkey").cast("string")), F.substring("seq", 1, 32), F.lit("+"), h)
    part(spark, sf_dir).select(record.alias("value")).write.option("compression", "gzip").text(path)
    return path


@query(f"SELECT 'r' || CAST(p_partkey AS VARCHAR) AS id, substr({DNA36}, 1, 32) AS sequence, {QUALITY} AS quality FROM part")
def read_fastq(spark, sf_dir):
    return sequences.read_fastq(spark, fastq(spark, sf_dir)).select("id", "sequence", "quality")


SCORED = f"s AS (SELECT list_sort(list_transform(string_split(substr({QUALITY}, 3, 29), ''), lambda c: ascii(c) - 33)) AS s FROM part)"


@query(f"""WITH {SCORED}, b AS (SELECT least(s[1], 40) AS l, least(CAST(s[15] AS INTEGER), 40) AS m FROM s), k AS (SELECT CAST(range AS INTEGER) AS qscore FROM range(41))
    SELECT qscore, (SELECT count(*) FROM b WHERE l = qscore) AS least, (SELECT count(*) FROM b WHERE m = qscore) AS median, CAST((SELECT count(*) FROM b WHERE l >= qscore) AS BIGINT) AS least_cum FROM k""")
def quality_report(spark, sf_dir):
    _, histogram = read_quality.report(spark, fastq(spark, sf_dir), forward=2, reverse=1)
    return histogram.select("qscore", "least", "median", "least_cum")


@query(f"""WITH q AS (SELECT list_transform(string_split({QUALITY}, ''), lambda c: ascii(c) - 33) AS s FROM part)
    SELECT count(*) AS n_reads, CAST(min(len(s)) AS INTEGER) AS min_length, CAST(max(len(s)) AS INTEGER) AS max_length, round(avg(len(s)), 6) AS mean_length, round(sum(list_sum(s)) / sum(len(s)), 6) AS mean_score FROM q""")
def quality_totals(spark, sf_dir):
    totals, _ = read_quality.report(spark, fastq(spark, sf_dir))
    return totals.select("n_reads", "min_length", "max_length", F.round("mean_length", 6).alias("mean_length"), F.round("mean_score", 6).alias("mean_score"))


@query("SELECT region.r_name AS umi, count(*) OVER (PARTITION BY r_name) AS n_seq, CAST(sum(n_nationkey + 1) OVER (PARTITION BY r_name) AS BIGINT) AS rc_sum, CAST(n_nationkey + 1 AS BIGINT) AS readcount, substr(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20) AS sequence FROM nation JOIN region ON n_regionkey = r_regionkey")
def read_clusters(spark, sf_dir):
    """A FASTA for each cluster, its sums in its name."""
    path = Scratch(spark).path()
    rows = V.table(spark, sf_dir, "nation").join(V.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sequences.write_clusters(rows.select(F.replace("r_name", F.lit(" "), F.lit("~")).alias("umi"), V.dna("n_name", 20).alias("sequence"), (F.col("n_nationkey") + 1).cast("bigint").alias("readcount")), path)
    return sequences.read_clusters(spark, f"{path}/*").drop("_row_id").withColumn("umi", F.replace("umi", F.lit("~"), F.lit(" ")))


@query("SELECT 'S' || CAST(r_regionkey AS VARCHAR) AS sample, CAST(2 * r_regionkey + 3 AS BIGINT) AS size FROM region WHERE r_regionkey <> 2")
def paired_files(spark, sf_dir):
    """Pairs of files by their names; one has no mate."""
    scratch = Scratch(spark)
    folder = scratch.path()
    for r in V.table(spark, sf_dir, "region").select("r_regionkey").collect():
        k = r["r_regionkey"]
        scratch.put(f"{folder}/S{k}_S{k + 1}_L001_R1_001.fastq.gz", b"x" * (k + 1))
        if k != 2:
            scratch.put(f"{folder}/S{k}_S{k + 1}_L001_R2_001.fastq.gz", b"x" * (k + 2))
    return sequences.paired_files(spark, folder).select("sample", "size")


@query("SELECT r_name AS key, '/log/' || CAST(r_regionkey AS VARCHAR) AS value FROM region")
def read_config(spark, sf_dir):
    scratch = Scratch(spark)
    rows = V.table(spark, sf_dir, "region").select("r_name", "r_regionkey").collect()
    path = scratch.path(".ini")
    scratch.put(path, ("[other]\nA = 1\n[names]\n" + "".join(f"{r['r_name']} = $logfile/{r['r_regionkey']}\n" for r in rows)).encode())
    return spark.createDataFrame(list(delimited.read_config(path, "names", spark, logfile="/log").items()), "key string, value string")


@query("SELECT n_name AS name, substr(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 24) AS \"full_NT\", CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS index FROM nation")
def read_genes(spark, sf_dir):
    path = Scratch(spark).path()
    genes = V.table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.col("n_name").alias("name"), V.dna("n_name", 24).alias("full_NT"))
    delimited.write_table(genes, path)
    return delimited.read_genes(spark, path)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'green' WHEN n_nationkey % 3 = 0 THEN 'red' ELSE 'none' END AS fill FROM nation")
def write_workbook(spark, sf_dir):
    """A workbook with fills, its sheet read back as XML."""
    rows = V.table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("{bg_color:red}"), F.col("n_name"))).otherwise(F.col("n_name")).alias("n_name"))
    held = io.BytesIO()
    delimited.write_workbook({"a & b": rows}, held, highlight=F.col("n_nationkey") % 2 == 0, widths={"a & b": [(0, 1, 20)]})
    with zipfile.ZipFile(held) as z:
        sheet, styles = z.read("xl/worksheets/sheet1.xml").decode(), z.read("xl/styles.xml").decode()
    fills = ["none", *re.findall(r'<fgColor rgb="(\w+)"', styles)]
    names = {"FF92D050": "green", "FFFF0000": "red", "none": "none"}
    found = [re.findall(r'<c s="(\d+)"[^>]*>(?:<v>|<is><t>)([^<]*)<', r) for r in re.findall(r"<row>(.*?)</row>", sheet)[1:]]
    return spark.createDataFrame([(r[0][1], r[1][1], names[fills[int(r[1][0])]]) for r in found], "key string, name string, fill string")


@query("SELECT r_regionkey AS key, upper(r_name) AS name FROM region")
def run_scripts(spark, sf_dir):
    """Statements of script files, one of them with a semicolon in quotes."""
    scratch = Scratch(spark)
    folder = scratch.path()
    scratch.put(f"{folder}/setup_1.sql", f"CREATE OR REPLACE TEMPORARY VIEW script_rows AS SELECT *, ';' AS mark FROM parquet.`{sf_dir}/region.parquet`;\n".encode())
    scratch.put(f"{folder}/setup_2.sql", b"CREATE OR REPLACE TEMPORARY VIEW script_names AS\nSELECT r_regionkey AS key, upper(r_name) AS name FROM script_rows WHERE mark = ';'")
    assert database.run_scripts(spark, f"{folder}/setup_*.sql") == 2
    return spark.table("script_names")


@query("""WITH n AS (SELECT n_regionkey AS g, n_nationkey AS k, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, count(*) OVER (PARTITION BY n_regionkey) AS c FROM nation)
    SELECT CAST(g AS VARCHAR) AS tree, 'I' || CAST(i AS VARCHAR) AS "from", 'I' || CAST(i + 1 AS VARCHAR) AS "to", i / 4.0 AS length, CASE WHEN i = 1 THEN 1 ELSE 0 END AS root FROM n WHERE i < c
    UNION ALL SELECT CAST(g AS VARCHAR), 'I' || CAST(i AS VARCHAR), 'leaf ' || CAST(k AS VARCHAR), 0.5, CASE WHEN i = 1 THEN 1 ELSE 0 END FROM n""".replace("i / 4.0 AS length", "CAST(i / 4.0 AS DOUBLE) AS length").replace("0.5, CASE", "CAST(0.5 AS DOUBLE), CASE"))
def read_nexus(spark, sf_dir):
    """A tree for each region, a comb of its nations, by way of Nexus files."""
    path = Scratch(spark).path()
    from pyspark.sql import Window

    by = Window.partitionBy("n_regionkey")
    n = V.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("g"), F.col("n_nationkey").alias("k"), F.row_number().over(by.orderBy("n_nationkey")).alias("i"), F.count("*").over(by).alias("c"))
    node = lambda i: F.concat(F.lit("I"), i.cast("string"))
    inner = n.filter("i < c").select("g", node(F.col("i")).alias("from"), node(F.col("i") + 1).alias("to"), (F.col("i") / 4).alias("length"))
    leaves = n.select("g", node(F.col("i")).alias("from"), F.concat(F.lit("leaf "), F.col("k").cast("string")).alias("to"), F.lit(0.5).alias("length"))
    trees.write_nexus(inner.unionByName(leaves), path, "g")
    return trees.read_nexus(spark, f"{path}/*").select("tree", "from", "to", "length", "root")


@query("SELECT p_partkey, coalesce(CAST(CASE WHEN p_size % 3 > 0 THEN p_size END AS VARCHAR), 'N/A') AS size FROM part")
def write_na(spark, sf_dir):
    return V.table(spark, sf_dir, "part").select("p_partkey", cells.or_na(F.when(F.col("p_size") % 3 > 0, F.col("p_size"))).alias("size"))


@query("SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size > 45) THEN 'in' ELSE 'out' END AS side FROM part")
def partition_rows(spark, sf_dir):
    df = V.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    inside, outside = collapse.partition_rows(df, df.filter("p_size > 45").select("p_brand").distinct(), "p_brand")
    return inside.select("p_partkey", F.lit("in").alias("side")).unionAll(outside.select("p_partkey", F.lit("out").alias("side")))
