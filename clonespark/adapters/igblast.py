"""IgBLAST's text output, and region annotation from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark.adapters.tools import ALPHA, BETA, CHICKEN, HEAVY, LIGHT, ChainType
from clonespark.functions.dna import fr4, frame, has_stop, region, translate_dna

REGIONS = ("FR1", "CDR1", "FR2", "CDR2", "FR3", "CDR3")
FIELDS = ("from", "to", "length", "matches", "mismatches", "gaps")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row (block) for each query of a result file."""
    blocks = spark.read.option("lineSep", "Query= ").text(path).select(F.col("value").alias("block"))
    return blocks.filter(F.col("block").contains("\n") & ~F.col("block").rlike(r"^I?G?BLAST[NP]? |^Database:"))


def _line_after(title: str, block: Column) -> Column:
    """Tab-separated cells of the line after the one that begins with a title; null if there is none."""
    line = F.regexp_extract(block, rf"(?m)^{title}[^\n]*\n([^\n]+)", 1)
    return F.when(line != "", F.split(line, "\t"))


def _summary(block: Column, strip: bool) -> Column:
    """Rows of the alignment summary: array of (region, numbers); the total isn't one."""
    text = F.regexp_extract(block, r"(?ms)^Alignment summary[^\n]*\n(.*?)^Total", 1)
    rows = F.transform(F.filter(F.split(text, "\n"), lambda x: x.contains("\t")), lambda x: F.split(x, "\t"))
    name = lambda r: F.regexp_replace(F.get(r, F.lit(0)), "-IMGT| .*", "") if strip else F.regexp_replace(F.get(r, F.lit(0)), " .*", "")
    return F.transform(rows, lambda r: F.struct(name(r).alias("region"), *(F.get(r, F.lit(i + 1)).try_cast("int").alias(f) for i, f in enumerate(FIELDS))))


def parse(blocks: DataFrame, chain: ChainType, domain_system: str | None = None, protein: bool = False) -> DataFrame:
    """Annotations of queries: query, hit, V_gene, D_gene, J_gene, CDR3, VJ_frame, ends of regions, and sums over them.

    Positions are from 0, ends left out. FR1 begins where its length, with gaps, is a multiple of three. Genes and CDR3 are empty or "-" without
    a hit, as in the tool's text. Chains that have no format here are an error.
    """
    b = F.col("block")
    query = F.trim(F.regexp_extract(b, r"^([^\n]*)", 1))
    none = b.contains("No hits found")
    if chain in CHICKEN:
        cells = _line_after(r"V-\(D\)-J junction details", b)
        cdr3 = F.coalesce(F.get(cells, F.lit(3 if chain == ChainType.CHICKEN_HEAVY else 1)), F.lit(""))
        return blocks.select(query.alias("query"), (~none & (cdr3 != "")).alias("hit"), cdr3.alias("CDR3_NT"))
    if chain not in HEAVY | LIGHT | BETA | ALPHA:
        raise ValueError(f"no format of results is known for {chain.name}")
    system = domain_system or ("imgt" if chain in BETA | ALPHA else "kabat")
    genes = _line_after(r"V-\(D\)-J rearrangement summary", b)
    sub = _line_after("Sub-region sequence details", b)
    found = F.get(sub, F.lit(0)) == "CDR3"
    with_d = chain in HEAVY | BETA
    gene = lambda i: F.coalesce(F.get(genes, F.lit(i)), F.lit(""))
    v = F.coalesce(F.regexp_extract(b, r"(?ms)^Sequences producing significant alignments[^\n]*\n\s*\n?(\S+)", 1), F.lit("")) if protein else gene(0)
    rows = blocks.withColumn("_s", _summary(b, system == "imgt"))
    at = lambda name: F.get(F.filter("_s", lambda r: r["region"] == name), F.lit(0))
    out = {
        "query": query,
        "hit": F.coalesce(F.size("_s") > 0, F.lit(False)) & ~none if protein else F.coalesce(found, F.lit(False)) & ~none,
        "V_gene": v, "D_gene": F.lit("") if protein or not with_d else gene(1), "J_gene": F.lit("") if protein else gene(2 if with_d else 1),
        "VJ_frame": F.substring_index(F.get(genes, F.lit(5 if with_d else 4)), "-", 1),
        "CDR3_NT": F.when(found, F.get(sub, F.lit(1))).otherwise("-"), "FR4_from": F.when(found, F.get(sub, F.lit(4)).try_cast("int")),
    }
    for name in REGIONS:
        r = at(name)
        start = r["from"] - 1
        if name == "FR1":
            start = start + F.pmod(r["to"] - start + F.coalesce(r["gaps"], F.lit(0)), F.lit(3)).cast("int")
        out |= {f"{name}_from": start, f"{name}_to": r["to"]}
    total = lambda f: F.when(F.size("_s") > 0, F.aggregate("_s", F.lit(0), lambda a, r: a + F.coalesce(f(r), F.lit(0))))
    out |= {"aligned_length_to_V_gene": total(lambda r: r["length"]), "distance_from_V_gene": total(lambda r: r["mismatches"] + r["gaps"])}
    return rows.select(*(c.alias(n) for n, c in out.items()))


def annotate(seqs: DataFrame, annotations: DataFrame, seq: str = "full_NT", id_col: str = "query", protein: bool = False, tcr: bool = False, spaced: bool = False) -> DataFrame:
    """The sequences' columns with genes, regions cut out and translated, frame and stop codon.

    Joined by id. Columns that seqs has already stay as they are there. spaced: names of added columns have blanks for underscores ("V gene").
    """
    marks = annotations.drop(*(c for c in annotations.columns if c in seqs.columns and c != id_col))
    rows = seqs.join(marks, id_col, "left")
    cuts = {}
    for name in REGIONS[:5]:
        part = region(seq, f"{name}_from", f"{name}_to")
        cuts |= {f"{name}_AA": part} if protein else {f"{name}_NT": part, f"{name}_AA": translate_dna(part)}
    if not protein:
        cdr3 = F.when(F.col("CDR3_NT") != "-", F.col("CDR3_NT"))
        tail = fr4(seq, "FR4_from")
        cuts |= {"CDR3_AA": translate_dna(cdr3), "FR4_NT": tail, "FR4_AA": translate_dna(tail), "frame": frame(cdr3), "stop_codon": has_stop(translate_dna(cdr3))}
    else:
        cuts |= {"CDR3_AA_temp": F.substring(F.col(seq), F.col("FR3_to") + 3, F.lit(28))}
    if tcr:
        cuts["full_AA"] = translate_dna(F.substring(F.col(seq), F.lit(2), F.lit(2147483647)))
    out = rows.withColumns({n: c for n, c in cuts.items() if n not in seqs.columns})
    return out.withColumnsRenamed({c: c.replace("_", " ") for c in out.columns if spaced and c not in seqs.columns})
