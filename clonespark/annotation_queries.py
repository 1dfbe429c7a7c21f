"""Queries of region cuts, filters, annotation by parsed results, aligners and trees."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from clonespark import views as V
from clonespark.adapters import align, igblast, seeded
from clonespark.adapters import pairs as read_pairs
from clonespark.adapters.tools import ChainType
from clonespark.functions import dna
from clonespark.operators import collapse, filters, similarity, umi
from clonespark.plans import repertoire
from clonespark.queries import CODE, DNA36, LIN, PROT, lineages, part, query
from clonespark.scratch import Scratch


def translated(seq: str) -> str:
    """SQL of the translation of a sequence of A, C, G and T."""
    return f"""coalesce(array_to_string(list_transform(range(CAST(ceil(length({seq}) / 3.0) AS BIGINT)), lambda i: CASE WHEN length(substr({seq}, CAST(3 * i + 1 AS INTEGER), 3)) < 3 THEN 'X' ELSE substr({CODE},
      CAST(16 * (instr('TCAG', substr({seq}, CAST(3 * i + 1 AS INTEGER), 1)) - 1) + 4 * (instr('TCAG', substr({seq}, CAST(3 * i + 2 AS INTEGER), 1)) - 1) + instr('TCAG', substr({seq}, CAST(3 * i + 3 AS INTEGER), 1)) AS INTEGER), 1) END), ''), '')"""


# cuts and filters


@query(f"""WITH s AS (SELECT p_partkey, {DNA36} AS seq, {PROT} AS prot, CAST(10 + p_size % 20 AS INTEGER) AS f, CAST(p_partkey % 12 AS INTEGER) AS n FROM part)
    SELECT p_partkey, substr(seq, greatest(f - 7, 1)) AS anchored, CASE WHEN n % 3 = 0 THEN 'In' ELSE 'Out' END AS frame, contains(prot || CASE WHEN n = 0 THEN '*' ELSE '' END, '*') AS stop_codon,
      substr(prot, f % 10 + 3, 28) AS "CDR3_AA_temp", {translated('substr(seq, 2)')} AS "full_AA", 'V' || CAST(n AS VARCHAR) AS family, 'aa' || substr(seq, 1, 5) || '-' || substr(seq, 6, 5) || 'bb' AS vector FROM s""")
def region_cuts(spark, sf_dir):
    s = part(spark, sf_dir).withColumns({"f": (10 + F.col("p_size") % 20).cast("int"), "n": (F.col("p_partkey") % 12).cast("int")})
    stop = F.concat("prot", F.when(F.col("n") == 0, "*").otherwise(""))
    return s.select(
        "p_partkey", dna.anchored_cut("seq", "f", keep=8).alias("anchored"), dna.frame(F.substring("seq", F.lit(1), F.col("n"))).alias("frame"), dna.has_stop(stop).alias("stop_codon"),
        dna.cdr3_window("prot", F.col("f") % 10).alias("CDR3_AA_temp"), dna.tcr_protein("seq").alias("full_AA"), dna.gene_family(F.concat(F.lit("V"), F.col("n").cast("string"), F.lit("*02"))).alias("family"),
        dna.vector_insert(F.lit("aaXXXXbb"), "XXXX", F.substring("seq", 1, 5), "-", F.substring("seq", 6, 5)).alias("vector"),
    )


@query("""SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_size % 3 <> 1 AND p_partkey % 11 <> 0 AND 240 + p_size >= 250 AND p_size * 4 >= 80""")
def donor_filter(spark, sf_dir):
    k = F.col("p_partkey")
    df = part(spark, sf_dir).select(
        "p_partkey", F.when(k % 5 == 0, "N/A").otherwise("V1").alias("V_gene"), F.when(k % 7 != 0, "J1").alias("J_gene"), (F.col("p_size") % 3 != 1).alias("hit"), F.when(k % 11 == 0, "Out").otherwise("In").alias("VJ_frame"),
        F.rpad(F.lit("A"), (240 + F.col("p_size")).cast("int"), "C").alias("full_NT"), (F.col("p_size") * 4).alias("FR1_to"),
    )
    return df.filter(filters.donor_functional()).select("p_partkey")


@query(f"""WITH {V.READS}, r AS (SELECT * FROM reads WHERE "FR1_to" > 3) SELECT substr(full_NT, "FR1_to" % 3 + 1) AS full_NT, isotype, CAST(sum(readcount) AS BIGINT) AS readcount, min(row) AS row, {translated('substr(full_NT, "FR1_to" % 3 + 1)')} AS "full_AA" FROM r GROUP BY 1, 2, 5""".replace("full_NT AS", "full_NT AS"))
def trim_known_fr1(spark, sf_dir):
    """Rows without a framework 1 are dropped before the merge."""
    df = V.reads(spark, sf_dir).select("full_NT", "isotype", "readcount", "row", F.when(F.col("FR1_to") > 3, F.col("FR1_to")).alias("FR1_to"))
    return collapse.trim_and_merge(df, "row")


@query("WITH w AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size % 3 ELSE 0 END AS s0, CASE WHEN p_partkey % 4 = 0 THEN p_size % 2 ELSE 0 END AS s1, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS s2 FROM part) SELECT p_partkey FROM w WHERE NOT (s0 + s1 + s2 = 0 OR (greatest(s0, s1, s2) = 1 AND s0 + s1 + s2 = 1))")
def zero_onehot_removal(spark, sf_dir):
    k = F.col("p_partkey")
    df = part(spark, sf_dir).select("p_partkey", F.when(k % 3 == 0, F.col("p_size") % 3).otherwise(0).alias("s0"), F.when(k % 4 == 0, F.col("p_size") % 2).otherwise(0).alias("s1"), F.when(k % 5 == 0, 1).otherwise(0).alias("s2"))
    return filters.without_one_hot(df, ["s0", "s1", "s2"]).select("p_partkey")


@query(f"""WITH {LIN} SELECT a.lineage AS "from", b.lineage AS "to", CAST(min(levenshtein(a.s, b.s)) AS BIGINT) AS min_dist, round(avg(levenshtein(a.s, b.s)), 6) AS mean_dist FROM l a JOIN l b ON a.rep = 0 AND b.rep = 1 AND a.v = b.v GROUP BY a.lineage, b.lineage""")
def component_min_mean_edits(spark, sf_dir):
    df = lineages(spark, sf_dir)
    d = similarity.group_distances(df.filter("rep = 0"), df.filter("rep = 1"), "lineage_id", "cdr3", ["v_call"], metric="levenshtein")
    return d.select("from", "to", F.col("min_dist").cast("bigint").alias("min_dist"), F.round("mean_dist", 6).alias("mean_dist"))


@query("""WITH a AS (SELECT p_partkey % 100 AS g, CAST(p_size AS BIGINT) AS n, substr(translate(md5(CAST(p_partkey % 300 AS VARCHAR)), '0123456789abcdef', 'AAAAAAAAAAAAAAAC'), 1, 4) AS s FROM part),
    l AS (SELECT g, n, CAST(unnest(range(1, 5)) AS INTEGER) AS p, s FROM a), b AS (SELECT g, p, substr(s, p, 1) AS b, sum(n) AS n FROM l GROUP BY 1, 2, 3),
    v AS (SELECT g, p, b, n, sum(n) OVER (PARTITION BY g, p) AS t, row_number() OVER (PARTITION BY g, p ORDER BY n DESC, instr('AGTC-', b)) AS k FROM b),
    c AS (SELECT g, string_agg(CASE WHEN n / t > 0.6 THEN b ELSE 'X' END, '' ORDER BY p) AS s FROM v WHERE k = 1 GROUP BY g)
    SELECT s AS "full_NT", count(*) AS readcount FROM c WHERE NOT contains(s, 'X') GROUP BY s""")
def consensus_counts(spark, sf_dir):
    """Clusters with the same consensus; those with a place that has none are rejected."""
    rows = V.table(spark, sf_dir, "part").select((F.col("p_partkey") % 100).alias("g"), F.col("p_size").cast("bigint").alias("readcount"), F.substring(F.translate(F.md5((F.col("p_partkey") % 300).cast("string")), V.HEX, "AAAAAAAAAAAAAAAC"), 1, 4).alias("sequence"))
    return umi.consensus_counts(umi.consensus(rows, ["g"]))


# results of IgBLAST and BLAST


def igblast_file(spark, sf_dir, regions: list[str], with_d: bool, protein: bool = False):
    """A path of results for each part: none for every tenth. FR1 begins 0 to 2 after the first base, and there are mismatches and gaps."""
    path = Scratch(spark).path()
    k, tab = F.col("p_partkey"), "\t"
    text = lambda x: x.cast("string")
    genes = [F.concat(F.lit("V"), text(k % 9), F.lit("*01")), *([F.lit("D2")] if with_d else []), F.lit("J3"), F.lit("VH"), F.lit("No"), F.when(k % 4 == 0, "Out-of-frame").otherwise("In-frame"), F.lit("Yes"), F.lit("+")]
    lines = [F.concat_ws(tab, F.lit(name), text(F.lit(5 * i + 1) + (k % 3 if i == 0 else 0)), text(F.lit(5 * i + 5)), text(F.lit(5) + k % 2), text(F.lit(4)), text(k % 3), text(k % 2), F.lit("80")) for i, name in enumerate(regions)]
    sub = F.concat_ws(tab, F.lit("CDR3"), F.substring("seq", 26, 6), F.lit("XX"), F.lit("26"), text(F.lit(31)))
    parts = [F.concat(F.lit("Query= q"), text(k)), F.lit("")]
    if protein:
        parts += [F.lit("Sequences producing significant alignments:  (Bits)\n"), F.concat(F.lit("V"), text(k % 9), F.lit("*01  100")), F.lit("")]
    else:
        parts += [F.lit("V-(D)-J rearrangement summary for query sequence (Top V gene match, ...)"), F.concat_ws(tab, *genes), F.lit(""), F.lit("Sub-region sequence details (nucleotide sequence, translation, start, end)"), sub, F.lit("")]
    parts += [F.lit("Alignment summary between query and top germline V gene hit (from, to, length, matches, mismatches, gaps, percent identity)"), *lines, F.lit("Total\tN/A\tN/A\t30\t24\t3\t3\t80"), F.lit("")]
    none = F.concat(F.lit("Query= q"), text(k), F.lit("\n\n***** No hits found *****\n"))
    block = F.when(k % 10 == 0, none).otherwise(F.concat_ws("\n", *parts))
    part(spark, sf_dir).select(block.alias("value")).write.text(path)
    return path


def igblast_sql(names: int, with_d: bool, protein: bool = False) -> str:
    start = "CASE WHEN hit THEN CAST(p_partkey % 3 + ((5 - p_partkey % 3 + p_partkey % 2) % 3) AS INTEGER) END"
    gene = lambda x: f"CASE WHEN hit THEN {x} ELSE '' END"
    return f"""h AS (SELECT p_partkey, p_partkey % 10 <> 0 AS hit, {DNA36} AS seq FROM part),
      a AS (SELECT p_partkey, seq, 'q' || CAST(p_partkey AS VARCHAR) AS query, hit, {gene("'V' || CAST(p_partkey % 9 AS VARCHAR) || '*01'")} AS "V_gene", {gene("'D2'") if with_d and not protein else "''"} AS "D_gene", {"''" if protein else gene("'J3'")} AS "J_gene",
        {'CAST(NULL AS VARCHAR)' if protein else "CASE WHEN hit THEN CASE WHEN p_partkey % 4 = 0 THEN 'Out' ELSE 'In' END END"} AS "VJ_frame", {"'-'" if protein else "CASE WHEN hit THEN substr(seq, 26, 6) ELSE '-' END"} AS "CDR3_NT", {start} AS "FR1_from", CASE WHEN hit THEN 5 END AS "FR1_to",
        CASE WHEN hit THEN 20 END AS "FR3_from", CASE WHEN hit THEN 25 END AS "FR3_to", CASE WHEN hit THEN CAST({names} * (5 + p_partkey % 2) AS INTEGER) END AS aligned_length_to_V_gene, CASE WHEN hit THEN CAST({names} * (p_partkey % 3 + p_partkey % 2) AS INTEGER) END AS distance_from_V_gene FROM h)"""


KEPT = ["query", "hit", "V_gene", "D_gene", "J_gene", "VJ_frame", "CDR3_NT", "FR1_from", "FR1_to", "FR3_from", "FR3_to", "aligned_length_to_V_gene", "distance_from_V_gene"]
PARSED = ", ".join(f'"{c}"' for c in KEPT)
KABAT, IMGT = ["FR1", "CDR1", "FR2", "CDR2", "FR3"], ["FR1-IMGT", "CDR1-IMGT", "FR2-IMGT", "CDR2-IMGT", "FR3-IMGT"]


@query(f"WITH {igblast_sql(5, True)} SELECT {PARSED} FROM a")
def igblast_heavy(spark, sf_dir):
    return igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, KABAT, True)), ChainType.HUMAN_HEAVY).select(*KEPT)


@query(f"WITH {igblast_sql(5, False)} SELECT {PARSED} FROM a")
def igblast_light(spark, sf_dir):
    return igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, KABAT, False)), ChainType.RABBIT_KAPPA).select(*KEPT)


@query(f"WITH {igblast_sql(5, True)} SELECT {PARSED} FROM a")
def igblast_tcr(spark, sf_dir):
    return igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, IMGT, True)), ChainType.HUMAN_BETA).select(*KEPT)


@query(f"WITH {igblast_sql(5, False, protein=True)} SELECT {PARSED} FROM a")
def igblast_protein(spark, sf_dir):
    return igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, KABAT, False, protein=True)), ChainType.HUMAN_HEAVY, protein=True).select(*KEPT)


@query(f"""WITH {igblast_sql(5, True)}, c AS (SELECT *, substr(seq, "FR1_from" + 1, 5 - "FR1_from") AS fr1, substr(seq, 6, 5) AS cdr1, substr(seq, 32, 33) AS fr4 FROM a WHERE hit)
    SELECT query, fr1 AS "FR1_NT", {translated('fr1')} AS "FR1_AA", cdr1 AS "CDR1_NT", {translated('cdr1')} AS "CDR1_AA", {translated('"CDR3_NT"')} AS "CDR3_AA", fr4 AS "FR4_NT", 'In' AS frame, contains({translated('"CDR3_NT"')}, '*') AS stop_codon, 'own' AS "V_gene" FROM c""")
def annotate_regions(spark, sf_dir):
    """Regions cut out of the sequences by parsed results; a column that the sequences have stays."""
    found = igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, KABAT, True)), ChainType.HUMAN_HEAVY)
    seqs = part(spark, sf_dir).select(F.concat(F.lit("q"), F.col("p_partkey").cast("string")).alias("query"), F.col("seq").alias("full_NT"), F.lit("own").alias("V_gene"))
    return igblast.annotate(seqs, found).filter("hit").select("query", "FR1_NT", "FR1_AA", "CDR1_NT", "CDR1_AA", "CDR3_AA", "FR4_NT", "frame", "stop_codon", "V_gene")


@query(f"""WITH {igblast_sql(5, True)}, c AS (SELECT *, substr(seq, 6, 5) AS cdr1 FROM a WHERE hit) SELECT query, {translated('cdr1')} AS "CDR1_AA", {translated('substr(seq, 2)')} AS "full_AA" FROM c""")
def annotate_tcr(spark, sf_dir):
    found = igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, IMGT, True)), ChainType.MOUSE_BETA)
    seqs = part(spark, sf_dir).select(F.concat(F.lit("q"), F.col("p_partkey").cast("string")).alias("query"), F.col("seq").alias("full_NT"))
    return igblast.annotate(seqs, found, tcr=True).filter("hit").select("query", "CDR1_AA", "full_AA")


@query(f"""WITH {igblast_sql(5, False, protein=True)}, c AS (SELECT a.*, substr(p.prot, 1, 30) AS prot FROM a JOIN (SELECT p_partkey, {PROT} AS prot FROM part) p USING (p_partkey) WHERE hit)
    SELECT query, substr(prot, "FR1_from" + 1, 5 - "FR1_from") AS "FR1_AA", substr(prot, 21, 5) AS "FR3_AA", substr(prot, 28, 28) AS "CDR3_AA_temp" FROM c""")
def annotate_protein(spark, sf_dir):
    found = igblast.parse(igblast.read_blocks(spark, igblast_file(spark, sf_dir, KABAT, False, protein=True)), ChainType.HUMAN_HEAVY, protein=True)
    seqs = part(spark, sf_dir).select(F.concat(F.lit("q"), F.col("p_partkey").cast("string")).alias("query"), F.substring("prot", 1, 30).alias("full_AA"))
    return igblast.annotate(seqs, found, seq="full_AA", protein=True).filter("hit").select("query", "FR1_AA", "FR3_AA", "CDR3_AA_temp")


@query(f"""SELECT p_partkey, 'q' || CAST(p_partkey AS VARCHAR) AS query, 1 AS num_alignments, 23 AS matched, 24 AS whole, 5 AS query_start, 28 AS query_end, 1 AS sbjct_start, 24 AS sbjct_end, 1 AS num_mismatches, CAST(p_partkey % 24 + 5 AS INTEGER) AS query_loc,
    substr({DNA36}, CAST(p_partkey % 24 + 5 AS INTEGER), 1) AS base FROM part WHERE p_partkey % 6 > 0""")
def blast_pairs(spark, sf_dir):
    """BLAST's pairwise text of each part against one subject with one base changed to N."""
    k = F.col("p_partkey")
    rows = part(spark, sf_dir).select("p_partkey", F.substring("seq", 5, 24).alias("q"), (k % 24).cast("int").alias("at"), (k % 6 == 0).alias("none"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            text = "BLASTN 2\n\n"
            for key, q, at, none in zip(f["p_partkey"], f["q"], f["at"], f["none"]):
                s = q[:at] + "N" + q[at + 1 :]
                hit = "***** No hits found *****\n" if none else f"> gene1\nLength=24\n\n Score = 40 bits (20)\n\nQuery  5   {q[:14]}  18\n           ||\nSbjct  1   {s[:14]}  14\n\nQuery  19  {q[14:]}  28\n           ||\nSbjct  15  {s[14:]}  24\n\n"
                text += f"Query= q{key}\n\n{hit}"
            out = align.parse_blast(text, {"gene1": 0}) if len(f) else pd.DataFrame({"query": [], "aln": []})
            yield pd.DataFrame({"p_partkey": f["p_partkey"], "query": out["query"], "aln": out["aln"]})

    hits = rows.mapInPandas(run, f"p_partkey bigint, query string, aln {align.ALIGNMENT}").filter("aln.num_alignments > 0")
    a = F.get("aln.alignments", F.lit(0))
    wrong = F.get(a["mismatches"], F.lit(0))
    return hits.select("p_partkey", "query", "aln.num_alignments", *(a[c].alias(c) for c in ("matched", "whole", "query_start", "query_end", "sbjct_start", "sbjct_end", "num_mismatches")), wrong["query_loc"].alias("query_loc"), wrong["query"].alias("base"))


GENES = ["IGHG1*01", "IGHM*02", "IGHA1*01", "IGHD*01"]


@query(f"""WITH r AS (SELECT {DNA36} AS s, CAST(p_partkey % 4 AS INTEGER) AS g, CAST(p_size AS BIGINT) AS n FROM part) SELECT s AS "full_NT", (['G1', 'M', 'A1', 'D'])[g + 1] AS isotype, CAST(sum(n) AS BIGINT) AS readcount FROM r GROUP BY 1, 2""")
def constant_genes(spark, sf_dir):
    """Isotypes by native alignment to constant genes, of which each sequence ends in one."""
    from clonespark.sources.delimited import read_genes, write_table

    path = Scratch(spark).path()
    made = [F.concat(*(V.letters(F.lit(f"{g}{i}"), V.DNA, 20) for i in range(4))) for g in GENES]
    reference = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(g).alias("name"), s.alias("full_NT")) for g, s in zip(GENES, made)))).alias("g")).select("g.*")
    write_table(reference.coalesce(1), path)
    seqs = part(spark, sf_dir).select(F.concat("seq", F.get(F.array(*made), (F.col("p_partkey") % 4).cast("int"))).alias("full_NT"), F.col("p_size").cast("bigint").alias("readcount"))
    return repertoire.with_isotypes(seqs, read_genes(spark, path))


@query(f"""WITH s AS (SELECT p_partkey, {DNA36} || substr(translate(md5(p_partkey || 'b'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 24) AS s FROM part) SELECT p_partkey, s AS merged FROM s""")
def merge_pairs(spark, sf_dir):
    """Reads of 40 bases from both ends of 60, joined where they overlap."""
    s = part(spark, sf_dir).withColumn("s", F.concat("seq", V.dna("p_partkey", 24, ("b",))))
    pairs = s.select("p_partkey", F.substring("s", 1, 40).alias("r1"), dna.reverse_complement(F.substring("s", 21, 40)).alias("r2"))
    return read_pairs.merge_pairs(pairs, least=15).select("p_partkey", "merged")


@query(f"""WITH s AS (SELECT p_partkey, {DNA36} || substr(translate(md5(p_partkey || 'b'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 24) AS s FROM part) SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN s END AS merged FROM s""")
def merge_pairs_tested(spark, sf_dir):
    """The same where every third mate is of another fragment: at this level none of these is joined by chance."""
    k = F.col("p_partkey")
    s = part(spark, sf_dir).withColumn("s", F.concat("seq", V.dna("p_partkey", 24, ("b",))))
    mate = F.when(k % 3 > 0, F.substring("s", 21, 40)).otherwise(V.dna("p_partkey", 40, ("c", "d")))
    pairs = s.select("p_partkey", F.substring("s", 1, 40).alias("r1"), dna.reverse_complement(mate).alias("r2"))
    return read_pairs.merge_pairs(pairs, level=1e-8).select("p_partkey", "merged")


@query("""SELECT p_partkey, 1 AS num_alignments, CAST(p_partkey % 4 AS INTEGER) AS sbjct_index, 79 AS matched, 80 AS whole, 37 AS query_start, 115 AS query_end, 1 AS sbjct_start, 80 AS sbjct_end, 1 AS num_mismatches, true AS sure FROM part""")
def gene_hits(spark, sf_dir):
    """Sequences that end in a gene of 80 bases, but for one base in the middle, which calls for a gap."""
    k = F.col("p_partkey")
    made = [F.concat(*(V.letters(F.lit(f"{g}{i}"), V.DNA, 20) for i in range(4))) for g in GENES]
    genes = spark.range(1).select(F.posexplode(F.array(*made)).alias("index", "full_NT"))
    gene, at = F.get(F.array(*made), (k % 4).cast("int")), (30 + k % 20).cast("int")
    rows = part(spark, sf_dir).select("p_partkey", F.concat("seq", F.substring(gene, F.lit(1), at), F.substring(gene, at + 2, F.lit(99))).alias("full_NT"))
    out = seeded.align_to_genes(rows, genes)
    a = F.get("aln.alignments", F.lit(0))
    return out.select("p_partkey", "aln.num_alignments", *(a[c].alias(c) for c in ("sbjct_index", "matched", "whole", "query_start", "query_end", "sbjct_start", "sbjct_end", "num_mismatches")), (F.col("evalue") < 1e-20).alias("sure"))


@query("""WITH r AS (SELECT p_partkey % 40 AS cluster, substr(translate(md5(CAST(p_partkey % 40 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20) AS s, CAST(p_partkey % 19 + 1 AS INTEGER) AS p, CAST(p_size AS BIGINT) AS n FROM part)
    SELECT cluster, substr(s, 1, p) || 'N' || substr(s, p + 2) AS sequence, CAST(sum(n) AS BIGINT) AS readcount FROM r GROUP BY 1, 2""")
def align_clusters(spark, sf_dir):
    """Reads that differ from their seed by a substitution need no gaps."""
    k, seed = F.col("p_partkey"), V.dna(F.col("p_partkey") % 40, 20)
    at = (k % 19 + 1).cast("int")
    read = F.concat(F.substring(seed, F.lit(1), at), F.lit("N"), F.substring(seed, at + 2, F.lit(99)))
    rows = part(spark, sf_dir).select((k % 40).alias("cluster"), seed.alias("seed"), read.alias("full_NT"), F.col("p_size").cast("bigint").alias("readcount"))
    return align.align_clusters(rows, ["cluster"], band=2)


@query("""WITH r AS (SELECT p_partkey % 40 AS cluster, substr(translate(md5(CAST(p_partkey % 40 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20) AS s, CAST(p_partkey % 7 * 2 + 3 AS INTEGER) AS p, CAST(p_size AS BIGINT) AS n FROM part)
    SELECT cluster, substr(s, 1, p) || substr(s, p + 2) AS letters, 20 AS columns, 1 AS gaps, CAST(sum(n) AS BIGINT) AS readcount FROM r GROUP BY 1, 2""")
def align_indels(spark, sf_dir):
    """Reads that lack a base of their seed have one gap each."""
    k, seed = F.col("p_partkey"), V.dna(F.col("p_partkey") % 40, 20)
    at = (k % 7 * 2 + 3).cast("int")
    rows = part(spark, sf_dir).select((k % 40).alias("cluster"), seed.alias("seed"), F.concat(F.substring(seed, F.lit(1), at), F.substring(seed, at + 2, F.lit(99))).alias("full_NT"), F.col("p_size").cast("bigint").alias("readcount"))
    out = align.align_clusters(rows, ["cluster"], band=2)
    letters = F.replace("sequence", F.lit("-"), F.lit(""))
    return out.select("cluster", letters.alias("letters"), F.length("sequence").alias("columns"), (F.length("sequence") - F.length(letters)).alias("gaps"), "readcount")


def chicken(spark, sf_dir, loose: bool):
    k = F.col("p_partkey")
    hit = lambda start, end, first, last, length: F.struct(start.alias("query_start"), end.alias("query_end"), first.alias("sbjct_start"), last.alias("sbjct_end"), F.lit(length).alias("length"))
    one = F.lit(1)
    rows = part(spark, sf_dir).select(
        "p_partkey", "seq", hit(one, F.lit(6), one, (6 - k % 2).cast("int"), 6).alias("FR1"), hit(F.lit(10), F.lit(14), (1 + k % 3).cast("int"), F.lit(5), 5).alias("FR2"),
        F.when(k % 7 != 0, hit(F.lit(18), F.lit(24), one, F.lit(7), 7)).alias("FR3"), hit(F.lit(30), F.lit(36), one, F.lit(7), 7).alias("FR4"),
    )
    return align.chicken_regions(rows, loose=loose).select("p_partkey", "CDR1", "CDR2", "CDR3", "failed")


@query(f"""WITH s AS (SELECT p_partkey AS k, {DNA36} AS seq FROM part) SELECT k AS p_partkey, CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN substr(seq, 7, 3) ELSE 'E/F' END AS "CDR1", CASE WHEN k % 7 <> 0 THEN substr(seq, 15, 3) ELSE 'E/F' END AS "CDR2",
    CASE WHEN k % 7 <> 0 THEN substr(seq, 25, 5) ELSE 'E/F' END AS "CDR3", k % 7 = 0 AS failed FROM s""")
def chicken_strict(spark, sf_dir):
    return chicken(spark, sf_dir, False)


@query(f"""WITH s AS (SELECT p_partkey AS k, {DNA36} AS seq FROM part) SELECT k AS p_partkey, substr(seq, CAST(7 + k % 2 AS INTEGER), CAST(3 - k % 2 - k % 3 AS INTEGER)) AS c, k % 7 = 0 AS failed, CASE WHEN k % 7 <> 0 THEN substr(seq, 15, 3) ELSE 'E/F' END AS "CDR2",
    CASE WHEN k % 7 <> 0 THEN substr(seq, 25, 5) ELSE 'E/F' END AS "CDR3" FROM s""".replace("AS c,", 'AS "CDR1",'))
def chicken_loose(spark, sf_dir):
    return chicken(spark, sf_dir, True)
