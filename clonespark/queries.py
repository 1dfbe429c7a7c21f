"""The queries of the library's own operators over the plain tables, and DuckDB SQL for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark import views as V
from clonespark.functions import cells, distance, dna, protein
from clonespark.operators import collapse, correction, diversity, filters, germline, graph, merging, similarity, umi
from clonespark.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


CODE = "'" + dna.CODE + "'"
DNA36 = "substr(translate(md5(CAST(p_partkey AS VARCHAR)) || md5(p_partkey || 'a'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 36)"
PROT = "translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')"


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey with seq (36 bases), prot (32 residues)."""
    return V.table(spark, sf_dir, "part").withColumns({"seq": V.dna("p_partkey", 36, ("", "a")), "prot": V.protein("p_partkey", 32)})


# functions


@query(f"SELECT p_partkey, reverse(translate({DNA36}, 'AGTC', 'TCAG')) AS rc FROM part")
def reverse_complement(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", dna.reverse_complement("seq").alias("rc"))


@query(f"""WITH s AS (SELECT p_partkey, substr({DNA36}, 1, CAST(p_partkey % 37 AS INTEGER)) AS seq FROM part),
    c AS (SELECT p_partkey, seq, list_transform(range(CAST(ceil(length(seq) / 3.0) AS BIGINT)), lambda i: substr(seq, CAST(3 * i + 1 AS INTEGER), 3)) AS codons FROM s)
    SELECT p_partkey, coalesce(array_to_string(list_transform(codons, lambda k: CASE WHEN length(k) < 3 THEN 'X' ELSE substr({CODE},
      CAST(16 * (instr('TCAG', substr(k, 1, 1)) - 1) + 4 * (instr('TCAG', substr(k, 2, 1)) - 1) + instr('TCAG', substr(k, 3, 1)) AS INTEGER), 1) END), ''), '') AS aa FROM c""")
def translate_dna(spark, sf_dir):
    s = F.substring("seq", F.lit(1), (F.col("p_partkey") % 37).cast("int"))
    return part(spark, sf_dir).select("p_partkey", dna.translate_dna(s).alias("aa"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(translate(p_name, 'abcdefghijklmnopqrstuvwxyz', 'ABCDGHKMNRSTVWYACGTNRYSWKM'), ''), lambda c: CASE c WHEN 'W' THEN '[AT]' WHEN 'S' THEN '[CG]' WHEN 'M' THEN '[AC]' WHEN 'K' THEN '[GT]' WHEN 'R' THEN '[AG]' WHEN 'Y' THEN '[CT]' WHEN 'B' THEN '[CGT]' WHEN 'D' THEN '[AGT]' WHEN 'H' THEN '[ACT]' WHEN 'V' THEN '[ACG]' WHEN 'N' THEN '[ACGT]' ELSE c END), '') AS pattern FROM part")
def iupac_regex(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", dna.iupac_pattern(F.translate("p_name", "abcdefghijklmnopqrstuvwxyz", "ABCDGHKMNRSTVWYACGTNRYSWKM")).alias("pattern"))


PAIR = f"""p AS (SELECT p_partkey, translate(substr({DNA36}, 1, 12), 'A', CASE WHEN p_partkey % 3 = 0 THEN '.' ELSE 'A' END) AS a,
    substr({DNA36}, 13, CASE WHEN p_partkey % 5 = 0 THEN 11 ELSE 12 END) AS b FROM part)"""


def pairs(spark, sf_dir):
    a = F.substring("seq", 1, 12)
    return part(spark, sf_dir).select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.translate(a, "A", ".")).otherwise(a).alias("a"), F.substring("seq", F.lit(13), F.when(F.col("p_partkey") % 5 == 0, 11).otherwise(12)).alias("b"))


@query(f"""WITH {PAIR} SELECT p_partkey, CAST(CASE WHEN length(a) <> length(b) THEN greatest(length(a), length(b)) ELSE
    len(list_filter(range(1, 13), lambda i: substr(a, CAST(i AS INTEGER), 1) <> substr(b, CAST(i AS INTEGER), 1) AND substr(a, CAST(i AS INTEGER), 1) <> '.' AND substr(b, CAST(i AS INTEGER), 1) <> '.')) END AS BIGINT) AS d FROM p""")
def hamming_dot(spark, sf_dir):
    return pairs(spark, sf_dir).select("p_partkey", distance.hamming("a", "b").cast("bigint").alias("d"))


@query(f"SELECT p_partkey, CAST(hamming(substr({DNA36}, 1, 18), substr({DNA36}, 19, 18)) AS BIGINT) AS d FROM part")
def bitstream_hamming(spark, sf_dir):
    a, b = distance.bit_planes(F.substring("seq", 1, 18)), distance.bit_planes(F.substring("seq", 19, 18))
    return part(spark, sf_dir).select("p_partkey", distance.hamming_of_planes(a, b).cast("bigint").alias("d"))


DIFF = f"WITH s AS (SELECT p_partkey, substr({DNA36}, 1, 12) AS r, substr({DNA36}, 13, 12) AS a, substr({DNA36}, 25, 12) AS b FROM part)"


@query(f"""{DIFF} SELECT p_partkey, CAST(len(list_filter(range(1, 13), lambda i: substr(r, CAST(i AS INTEGER), 1) <> substr(a, CAST(i AS INTEGER), 1))) AS BIGINT) AS n,
    coalesce(array_to_string(list_transform(list_filter(range(1, 13), lambda i: substr(r, CAST(i AS INTEGER), 1) <> substr(a, CAST(i AS INTEGER), 1)), lambda i: CAST(i - 1 AS VARCHAR) || substr(a, CAST(i AS INTEGER), 1)), ','), '') AS diff, CAST(hamming(a, b) AS BIGINT) AS d FROM s""")
def seq_diff(spark, sf_dir):
    r, a, b = (F.substring("seq", i, 12) for i in (1, 13, 25))
    x, y = distance.differences(r, a), distance.differences(r, b)
    text = F.array_join(F.transform(x, lambda d: F.concat(d["pos"].cast("string"), d["base"])), ",")
    return part(spark, sf_dir).select("p_partkey", F.size(x).cast("bigint").alias("n"), text.alias("diff"), distance.hamming_of_differences(x, y).cast("bigint").alias("d"))


@query("SELECT p_partkey, " + ", ".join(f"CAST(len(regexp_extract_all({PROT}, '{p}')) AS BIGINT) AS \"{n}\"" for n, p in protein.MOTIFS.items()) + " FROM part")
def ptm_counts(spark, sf_dir):
    return protein.ptm_counts(part(spark, sf_dir).select("p_partkey", "prot"), "prot").drop("prot")


@query(f"SELECT p_partkey, round(list_sum(list_transform(string_split({PROT}, ''), lambda c: CASE c " + " ".join(f"WHEN '{a}' THEN {h}" for a, h in protein.HYDROPATHY.items()) + " ELSE 0.0 END)) / 32, 6) AS gravy FROM part")
def gravy(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", F.round(protein.gravy("prot"), 6).alias("gravy"))


def _count(c: str) -> str:
    return f"(length(prot) - length(replace(prot, '{c}', '')))"


def _end(table: dict[str, float], place: int, other: float) -> str:
    return f"CASE substr(prot, {place}, 1) " + " ".join(f"WHEN '{a}' THEN {pk}" for a, pk in table.items()) + f" ELSE {other} END"


CHARGE = " + ".join(f"{n} / (1 + pow(10, ph - ({pk})))" for n, pk in [("1", _end(protein.PK_N_END, 1, protein.PK_PLUS["n"])), *((_count(c), pk) for c, pk in protein.PK_PLUS.items() if c != "n")])
CHARGE += "".join(f" - {n} / (1 + pow(10, ({pk}) - ph))" for n, pk in [("1", _end(protein.PK_C_END, 32, protein.PK_MINUS["c"])), *((_count(c), pk) for c, pk in protein.PK_MINUS.items() if c != "c")])


@query(f"""WITH RECURSIVE b AS (SELECT p_partkey, {PROT} AS prot, 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(14 AS DOUBLE) AS high FROM part
    UNION ALL SELECT p_partkey, prot, i + 1, CASE WHEN charge > 0 THEN ph ELSE low END, CASE WHEN charge > 0 THEN high ELSE ph END FROM (SELECT *, {CHARGE} AS charge FROM (SELECT *, (low + high) / 2 AS ph FROM b WHERE i < 60) x) y)
    SELECT p_partkey, round((low + high) / 2, 6) AS pi FROM b WHERE i = 60""")
def isoelectric_point(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", F.round(protein.isoelectric_point("prot"), 6).alias("pi"))


@query(f"""WITH s AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {DNA36} WHEN 1 THEN {PROT} WHEN 2 THEN '' ELSE p_type END AS s FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(s, '^[AGTCagtc. -]*$') THEN 'nucleotide' WHEN regexp_matches(s, '^[ACDEFGHIKLMNPQRSTVWXYacdefghiklmnpqrstvwxy*. -]*$') THEN 'protein' ELSE 'neither' END AS kind FROM s""")
def alphabet_class(spark, sf_dir):
    k = F.col("p_partkey") % 4
    s = F.when(k == 0, F.col("seq")).when(k == 1, F.col("prot")).when(k == 2, "").otherwise(F.col("p_type"))
    c = dna.sequence_class(s)
    return part(spark, sf_dir).select("p_partkey", F.when(c, "nucleotide").when(~c, "protein").otherwise("neither").alias("kind"))


CELLS = "(['12', '-7', '0.5', '1e5', 'True', 'None', 'NULL', '007', '1.0.0', '350-1', '', '\"q\"'])"


@query(f"""WITH s AS (SELECT p_partkey, replace({CELLS}[p_partkey % 12 + 1], '"', '') AS s FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(s, '^[+-]?(0+|[1-9][0-9]*)$') THEN 'int' WHEN regexp_matches(s, '^[+-]?([0-9]+[.][0-9]*|[.][0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$') AND regexp_matches(s, '[.eE]') THEN 'float'
      WHEN s IN ('True', 'False') THEN 'bool' WHEN s = 'None' THEN 'none' ELSE 'str' END AS kind,
      CASE WHEN regexp_matches(s, '^[+-]?(0+|[1-9][0-9]*)$') THEN TRY_CAST(s AS BIGINT) END AS long, CASE WHEN s IN ('0.5', '1e5') THEN TRY_CAST(s AS DOUBLE) END AS double FROM s""")
def literal_typing(spark, sf_dir):
    names = F.array(*map(F.lit, ["12", "-7", "0.5", "1e5", "True", "None", "NULL", "007", "1.0.0", "350-1", "", '"q"']))
    t = cells.typed(F.get(names, (F.col("p_partkey") % 12).cast("int")))
    return part(spark, sf_dir).select("p_partkey", t.alias("t")).select("p_partkey", "t.kind", "t.long", "t.double")


@query("SELECT p_partkey, p_brand AS bare, p_type AS color FROM part")
def cell_formats(spark, sf_dir):
    cell = F.concat(F.lit("{bg_color:"), F.col("p_type"), F.lit("}"), F.col("p_brand"))
    return part(spark, sf_dir).select("p_partkey", cells.without_formats(cell).alias("bare"), F.try_element_at(cells.formats(cell), F.lit("bg_color")).alias("color"))


@query(f"""WITH s AS (SELECT p_partkey, substr({PROT}, 1, CAST(1 + p_partkey % 14 AS INTEGER)) AS s FROM part),
    r AS (SELECT p_partkey, s, length(s) AS n, least(2, length(s) - 1) AS k FROM s)
    SELECT p_partkey, s AS "HCDR3", substr(s, 1, 1) AS r95, CASE WHEN n - k > 6 THEN substr(s, 7, 1) ELSE '' END AS r100a,
      CASE WHEN k >= 2 THEN substr(s, n - 1, 1) ELSE '' END AS r101, CASE WHEN k >= 1 THEN substr(s, n, 1) ELSE '' END AS r102 FROM r""")
def numbering_cdr3(spark, sf_dir):
    s = part(spark, sf_dir).select("p_partkey", F.substring("prot", F.lit(1), (1 + F.col("p_partkey") % 14).cast("int")).alias("query"))
    r = protein.number_cdr3(s, "heavy")
    return r.select("p_partkey", "HCDR3", *(F.col("residues")[k].alias(n) for k, n in (("95", "r95"), ("100A", "r100a"), ("101", "r101"), ("102", "r102"))))


NUMBERED = [f"L{n}" for n in (24, 25, 26, 27)] + ["L27A"] + [f"L{n}" for n in range(28, 35)]


@query(f"""WITH s AS (SELECT p_partkey, 'Y' || substr({PROT}, 1, CAST(3 + p_partkey % 9 AS INTEGER)) AS s, 'Y' || substr({PROT}, 5, CAST(8 + p_partkey % 5 AS INTEGER)) AS f FROM part), n AS (SELECT *, length(s) AS n, greatest(length(s) - 7, 0) AS l FROM s)
    SELECT p_partkey, array_to_string([{", ".join(f"'{label}=' || CASE WHEN {12 - i} <= n - l THEN substr(s, n - {12 - i} + 1, 1) WHEN {i} < l THEN substr(s, {i + 1}, 1) ELSE '-' END" for i, label in enumerate(NUMBERED))}], ';') AS cdr1,
      array_to_string([{", ".join(f"'L{i}=' || CASE WHEN {24 - i} <= length(f) THEN substr(f, length(f) - {24 - i} + 1, 1) ELSE '-' END" for i in range(24))}], ';') AS fr1 FROM n""")
def numbering_regions(spark, sf_dir):
    """CDR1 from both ends, FR1 from the right, of residues as they are (the Y keeps them from being read as nucleotides)."""
    k = F.col("p_partkey")
    rows = part(spark, sf_dir).select("p_partkey", F.concat(F.lit("Y"), F.substring("prot", F.lit(1), (3 + k % 9).cast("int"))).alias("CDR1"), F.concat(F.lit("Y"), F.substring("prot", F.lit(5), (8 + k % 5).cast("int"))).alias("FR1"))
    out = protein.number_regions(rows, "light", "p_partkey", blank="-")
    text = lambda name, labels: F.array_join(F.array(*(F.concat(F.lit(f"{x}="), F.element_at(f"{name}_residues", F.lit(x))) for x in labels)), ";")
    return out.select("p_partkey", text("CDR1", NUMBERED).alias("cdr1"), text("FR1", [f"L{i}" for i in range(24)]).alias("fr1"))


FR4 = [f"L{n}" for n in range(98, 110)]
FR4 = FR4[: FR4.index("L106") + 1] + ["L106A"] + FR4[FR4.index("L106") + 1 :]


def _growing(most: int) -> str:
    """FR4 of a row: labels through the lettered one from the left, then letters as many as the longest sequence so far calls for, then the last labels."""
    at, n = FR4.index("L106A"), len(FR4)
    cell = lambda i: f"CASE WHEN {i} < n THEN substr(f, CAST({i} + 1 AS INTEGER), 1) ELSE '-' END"
    head = [f"'{x}=' || {cell(i)}" for i, x in enumerate(FR4[: at + 1])]
    letters = [f"'L106{chr(ord('B') + i)}=' || CASE WHEN {i + 1} <= greatest(m, {n}) - {n} THEN {cell(at + 1 + i)} ELSE '-' END" for i in range(most - n)]
    tail = [f"'{x}=' || {cell(f'({at + 1 + i} + greatest(m, {n}) - {n})')}" for i, x in enumerate(FR4[at + 1 :])]
    return f"array_to_string([{', '.join(head + letters + tail)}], ';')"


@query(f"""WITH s AS (SELECT p_partkey, 'Y' || substr({PROT}, 5, CAST(8 + p_partkey * 7 % 11 AS INTEGER)) AS f FROM part), r AS (SELECT *, length(f) AS n, max(length(f)) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS m FROM s)
    SELECT p_partkey, {_growing(19)} AS fr4 FROM r""")
def numbering_all(spark, sf_dir):
    """The light FR4, whose labels grow with the longest sequence up to each row."""
    k = F.col("p_partkey")
    rows = part(spark, sf_dir).select("p_partkey", F.concat(F.lit("Y"), F.substring("prot", F.lit(5), (8 + k * 7 % 11).cast("int"))).alias("FR4"))
    out = protein.number_regions(rows, "light", "p_partkey", blank="-")
    return out.select("p_partkey", F.array_join(F.transform(F.map_entries("FR4_residues"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("fr4"))


def _spans(pattern: str) -> str:
    """Places (from 0) that lie in a match: what stands before each match, and the matches themselves, from the left."""
    found, rest = f"regexp_extract_all(prot, '{pattern}')", f"regexp_split_to_array(prot, '{pattern}')"
    return f"""list_distinct(flatten(list_transform(range(1, len({found}) + 1), lambda k: range(
      CAST(list_sum(list_transform({rest}[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform({found}[1:k - 1], lambda x: length(x))), 0) AS BIGINT),
      CAST(list_sum(list_transform({rest}[1:k], lambda x: length(x))) + list_sum(list_transform({found}[1:k], lambda x: length(x))) AS BIGINT)))))"""


@query(f"WITH s AS (SELECT p_partkey, {PROT} AS prot FROM part), m AS (SELECT p_partkey, prot, " + ", ".join(f"{_spans(p)} AS m{i}" for i, p in enumerate(protein.MOTIFS.values())) + " FROM s) SELECT p_partkey, array_to_string(list_transform(range(0, 32), lambda i: 'R' || CAST(i + 1 AS VARCHAR) || ' ' || "
    + " || ".join(f"CASE WHEN list_contains(m{i}, i) THEN '{{bg_color:{n}}}' ELSE '' END" for i, n in enumerate(protein.MOTIFS)) + " || substr(prot, CAST(i + 1 AS INTEGER), 1)), ';') AS residues FROM m")
def residue_marks(spark, sf_dir):
    marked = protein.marked_residues(part(spark, sf_dir).select("p_partkey", F.col("prot").alias("query")))
    text = F.array_join(F.transform(F.map_entries("residues"), lambda e: F.concat_ws(" ", e["key"], e["value"])), ";")
    return marked.select("p_partkey", text.alias("residues"))


@query(f"""WITH s AS (SELECT p_partkey, {DNA36} AS seq, CAST(p_size % 12 AS INTEGER) AS f, CAST(p_partkey % 9 AS INTEGER) - 4 AS d FROM part)
    SELECT p_partkey, substr(seq, f % 3 + 1) AS trimmed, substr(seq, 1, CASE WHEN d >= 0 THEN d ELSE 36 + d END) AS variable, substr(seq, f + 1, 9) AS region, 'G' || CAST(f AS VARCHAR) AS isotype, substr(seq, f + 1, 33) AS fr4 FROM s""")
def sequence_cuts(spark, sf_dir):
    s = part(spark, sf_dir).withColumns({"f": (F.col("p_size") % 12).cast("int"), "d": (F.col("p_partkey") % 9 - 4).cast("int")})
    gene = F.concat(F.lit("IGHG"), F.col("f").cast("string"), F.lit("*01"))
    return s.select("p_partkey", dna.trim_to_frame("seq", "f").alias("trimmed"), dna.variable_region("seq", "d", F.lit(0)).alias("variable"), dna.region("seq", "f", F.col("f") + 9).alias("region"), dna.isotype_of(gene).alias("isotype"), dna.fr4("seq", "f").alias("fr4"))


# collapse and filters


@query(f"""WITH {V.CLONES} SELECT 'H' || length(seq) || '-' || row_number() OVER (PARTITION BY length(seq) ORDER BY id) AS seq_id, id FROM clones""")
def set_id(spark, sf_dir):
    return collapse.set_ids(V.clones(spark, sf_dir), "seq", "id", "H").select("seq_id", "id")


@query(f"WITH {V.READS} SELECT full_NT, isotype, CAST(sum(readcount) AS BIGINT) AS readcount FROM reads GROUP BY ALL")
def isotype_collapse(spark, sf_dir):
    return collapse.collapse_isotypes(V.reads(spark, sf_dir))


@query(f"""WITH {V.READS} SELECT full_NT, isotype, CAST(sum(readcount) AS BIGINT) AS readcount, arg_min(sample, row) AS sample, arg_min("V_gene", row) AS "V_gene", min(row) AS row FROM reads GROUP BY full_NT, isotype""")
def first_wins_collapse(spark, sf_dir):
    df = V.reads(spark, sf_dir).select("full_NT", "isotype", "readcount", "sample", "V_gene", "row")
    return collapse.first_row(df, ["full_NT", "isotype"], "row", ["readcount"])


@query(f"""WITH {V.READS} SELECT substr(full_NT, "FR1_to" % 3 + 1) AS full_NT, isotype, CAST(sum(readcount) AS BIGINT) AS readcount, arg_min("V_gene", row) AS "V_gene", min(row) AS row FROM reads GROUP BY 1, 2""")
def trim_merge(spark, sf_dir):
    df = V.reads(spark, sf_dir).select("full_NT", "isotype", "readcount", "V_gene", "row", "FR1_to")
    return collapse.trim_and_merge(df, "row").drop("full_AA")


@query(f"WITH {V.READS} SELECT full_NT, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN isotype = '{i}' THEN readcount END), 0) AS BIGINT) AS \"{i}\"" for i in collapse.ISOTYPES7) + f" FROM reads WHERE isotype IN ({', '.join(repr(i) for i in collapse.ISOTYPES7)}) GROUP BY full_NT")
def isotype_pivot(spark, sf_dir):
    return collapse.isotype_pivot(V.reads(spark, sf_dir))


@query(f"WITH {V.READS} SELECT sample, full_NT, arg_min(\"V_gene\", row) AS \"V_gene\", " + ", ".join(f"CAST(sum(CASE WHEN isotype = '{i}' THEN readcount ELSE 0 END) AS BIGINT) AS \"{i}\"" for i in collapse.ISOTYPES9) + " FROM reads GROUP BY sample, full_NT")
def net_pivot(spark, sf_dir):
    df = V.reads(spark, sf_dir).select("row", "sample", "full_NT", "V_gene", "isotype", "readcount")
    return collapse.network_pivot(df, "row").drop("row")


@query(f"WITH {V.READS} SELECT full_NT, " + ", ".join(f"concat_ws('.', " + ", ".join(f"CAST(sum(CASE WHEN isotype = '{i}' THEN {tp} ELSE 0 END) AS BIGINT)" for tp in ("TP1", "TP2", "TP3")) + f") AS \"{i}\"" for i in collapse.ISOTYPES9) + " FROM reads WHERE isotype <> 'X' GROUP BY full_NT")
def timepoint_arrays(spark, sf_dir):
    df = V.reads(spark, sf_dir).filter("isotype != 'X'").select("row", "full_NT", F.concat(F.lit("IGH"), "isotype").alias("isotype"), "TP1", "TP2", "TP3")
    out = collapse.timepoint_arrays(df, "row", ["TP1", "TP2", "TP3"])
    return out.select("full_NT", *(collapse.dotted(i).alias(i) for i in collapse.ISOTYPES9))


FUNCTIONAL = f"""f AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'N/A' ELSE p_brand END AS v, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS j, CAST(p_size AS BIGINT) AS readcount, CASE WHEN p_partkey % 2 = 0 THEN 'M' WHEN p_partkey % 3 = 0 THEN 'D' ELSE 'G1' END AS isotype,
    substr({PROT}, 1, 20) || CASE WHEN p_partkey % 13 = 0 THEN '*' ELSE '' END AS full_aa, substr({PROT}, 1, 5) AS c1, substr({PROT}, 6, 5) AS c2, CASE WHEN p_partkey % 17 = 0 THEN 'AX' ELSE substr({PROT}, 11, 5) END AS c3 FROM part),
  g AS (SELECT *, coalesce(isotype IN ('M', 'G1') AND v <> 'N/A' AND j <> 'N/A' AND NOT contains(full_aa, '*') AND NOT contains(full_aa, 'X') AND NOT contains(c3, 'X') AND NOT contains(c3, '*'), false) AS ok FROM f)"""


def annotated(spark, sf_dir):
    k = F.col("p_partkey")
    return part(spark, sf_dir).select(
        "p_partkey", F.when(k % 7 == 0, "N/A").otherwise(F.col("p_brand")).alias("V_gene"), F.when(k % 11 == 0, None).otherwise(F.col("p_type")).alias("J_gene"), F.col("p_size").cast("bigint").alias("readcount"),
        F.when(k % 2 == 0, "M").when(k % 3 == 0, "D").otherwise("G1").alias("isotype"), F.concat(F.substring("prot", 1, 20), F.when(k % 13 == 0, "*").otherwise("")).alias("full_AA"),
        F.substring("prot", 1, 5).alias("CDR1_AA"), F.substring("prot", 6, 5).alias("CDR2_AA"), F.when(k % 17 == 0, "AX").otherwise(F.substring("prot", 11, 5)).alias("CDR3_AA"),
    )


@query(f"WITH {FUNCTIONAL} SELECT p_partkey FROM g WHERE ok")
def functional_filter(spark, sf_dir):
    return annotated(spark, sf_dir).filter(filters.functional(["M", "G1"])).select("p_partkey")


@query(f"""WITH {FUNCTIONAL} SELECT count(*) AS n_rows, CAST(sum(CAST(ok AS BIGINT)) AS BIGINT) AS rows_passed, CAST(sum(readcount) AS BIGINT) AS n_reads, CAST(sum(CASE WHEN ok THEN readcount ELSE 0 END) AS BIGINT) AS reads_passed,
    round(sum(CAST(ok AS BIGINT)) / count(*), 2) AS row_rate, round(sum(CASE WHEN ok THEN readcount ELSE 0 END) / sum(readcount), 2) AS read_rate FROM g""")
def pass_rates(spark, sf_dir):
    return filters.pass_rates(annotated(spark, sf_dir), filters.functional(["M", "G1"]))


@query("""SELECT p_partkey FROM part WHERE p_partkey % 4 <> 0 AND 70 + p_size % 30 BETWEEN 74 AND 94 AND p_partkey % 8 <= 5 AND p_partkey % 13 <= 10 AND p_size * 10 <= 400""")
def cgene_hit_filter(spark, sf_dir):
    k = F.col("p_partkey")
    hit = F.struct((70 + F.col("p_size") % 30).alias("whole"), (k % 8).alias("num_mismatches"), (k % 13).alias("sbjct_start"), (F.col("p_size") * 10).alias("query_start"))
    none = k % 4 == 0
    aln = F.struct(F.when(none, 0).otherwise(1).alias("num_alignments"), F.when(none, F.array().cast("array<struct<whole:int,num_mismatches:bigint,sbjct_start:bigint,query_start:int>>")).otherwise(F.array(hit)).alias("alignments"))
    return part(spark, sf_dir).withColumn("aln", aln).filter(filters.c_gene_hit()).select("p_partkey")


@query(f"""WITH {V.READS}, w AS (SELECT row, CASE WHEN sample = 0 THEN readcount % 3 ELSE 0 END AS s0, CASE WHEN sample = 1 THEN readcount % 3 ELSE 0 END AS s1, CASE WHEN sample = 2 THEN readcount % 2 ELSE 0 END AS s2 FROM reads) SELECT row FROM w WHERE s0 + s1 + s2 > 1""")
def singleton_removal(spark, sf_dir):
    df = V.reads(spark, sf_dir).select("row", *(F.when(F.col("sample") == i, F.col("readcount") % m).otherwise(0).alias(f"s{i}") for i, m in ((0, 3), (1, 3), (2, 2))))
    return filters.without_singletons(df, ["s0", "s1", "s2"]).select("row")


# networks

LEV3 = "WITH {0} SELECT least(a.id, b.id) AS \"from\", greatest(a.id, b.id) AS \"to\", CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS dist FROM c a JOIN c b ON a.id < b.id AND length(a.seq) = length(b.seq) WHERE levenshtein(a.seq, b.seq) <= {1}"
SHORT_ALL = f"c AS (SELECT p_partkey AS id, substr({DNA36}, 1, CAST(9 + 3 * (p_partkey % 3) AS INTEGER)) AS seq, p_brand AS v, substr(p_type, 1, 3) AS j FROM part)"
C12 = f"c AS (SELECT p_partkey AS id, substr({DNA36}, 1, 12) AS seq, p_partkey % 97 AS component FROM part)"


@query(LEV3.format(C12, 2))
def lev_edges(spark, sf_dir):
    return similarity.similarity_join(V.clones(spark, sf_dir).select("id", "seq"), "id", "seq", 2)


def by_length(spark, sf_dir):
    rows = V.spread(V.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), "p_partkey")
    return rows.select(F.col("p_partkey").alias("id"), F.substring(V.dna("p_partkey", 36, ("", "a")), F.lit(1), (9 + 3 * (F.col("p_partkey") % 3)).cast("int")).alias("seq"), F.col("p_brand").alias("v"), F.substring("p_type", 1, 3).alias("j"))


@query("WITH " + SHORT_ALL + " SELECT least(a.id, b.id) AS \"from\", greatest(a.id, b.id) AS \"to\", CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS dist FROM c a JOIN c b ON a.v = b.v AND ((a.id < b.id AND length(a.seq) = length(b.seq)) OR length(b.seq) = length(a.seq) + 3) WHERE levenshtein(a.seq, b.seq) <= 3")
def lev_edges_all(spark, sf_dir):
    return similarity.similarity_join(by_length(spark, sf_dir), "id", "seq", 3, block_by=["v"], cross_length="all")


@query("WITH " + SHORT_ALL + ", m AS (SELECT v, length(seq) AS n, max(id) AS id FROM c GROUP BY 1, 2) SELECT least(a.id, b.id) AS \"from\", greatest(a.id, b.id) AS \"to\", CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS dist FROM c a JOIN c b ON a.v = b.v AND ((a.id < b.id AND length(a.seq) = length(b.seq)) OR (length(b.seq) = length(a.seq) + 3 AND a.id IN (SELECT id FROM m))) WHERE levenshtein(a.seq, b.seq) <= 3")
def lev_edges_last(spark, sf_dir):
    return similarity.similarity_join(by_length(spark, sf_dir), "id", "seq", 3, block_by=["v"], cross_length="last")


@query("WITH " + SHORT_ALL + " SELECT a.id AS \"from\", b.id AS \"to\", CAST(hamming(a.seq, b.seq) AS INTEGER) AS dist FROM c a JOIN c b ON a.id < b.id AND a.v = b.v AND a.j = b.j AND length(a.seq) = length(b.seq) WHERE hamming(a.seq, b.seq) <= 6")
def hamming_edges_vjlen(spark, sf_dir):
    return similarity.similarity_join(by_length(spark, sf_dir), "id", "seq", 6, metric="hamming", block_by=["v", "j"])


@query(f"""WITH {C12}, e AS ({LEV3.format(C12, 2)[len("WITH ") + len(C12) + 1:]}), n AS (SELECT "from" AS id, dist FROM e UNION ALL SELECT "to", dist FROM e), m AS (SELECT id, min(dist) AS d FROM n WHERE dist > 0 GROUP BY id)
    SELECT c.id AS seq_id, coalesce(CAST(m.d AS VARCHAR), 'N/A') AS min_dist, CAST(length(c.seq) AS BIGINT) AS seq_len FROM c LEFT JOIN m ON c.id = m.id""")
def nn_min_dist(spark, sf_dir):
    v = V.clones(spark, sf_dir).select("id", "seq")
    n = similarity.nearest(v, similarity.similarity_join(v, "id", "seq", 2), "id", "seq")
    return n.select("seq_id", cells.or_na("min_dist").alias("min_dist"), F.col("seq_len").cast("bigint").alias("seq_len"))


@query(f"""WITH {V.CLONES}, c AS (SELECT *, substr({DNA36.replace('p_partkey', 'id')}, 1, CAST(30 + id % 7 AS INTEGER)) AS full_nt FROM clones)
    SELECT a.id AS "from", b.id AS "to", CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS dist FROM c a JOIN c b ON a.id < b.id AND a."V_gene" = b."V_gene" AND a."J_gene" = b."J_gene"
    WHERE levenshtein(a.seq, b.seq) <= 5 AND levenshtein(a.seq, b.seq) / 12.0 <= 0.4 AND abs(length(a.full_nt) - length(b.full_nt)) <= 3""")
def edge_filter(spark, sf_dir):
    v = V.clones(spark, sf_dir).withColumn("full_NT", F.substring(V.dna("id", 36, ("", "a")), F.lit(1), (30 + F.col("id") % 7).cast("int")))
    return similarity.filtered_join(v, "id", "seq", 5, 0.4)


@query(f"WITH {C12} SELECT a.id AS \"from\", b.id AS \"to\", CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS dist, a.component FROM c a JOIN c b ON a.component = b.component AND a.id < b.id")
def component_pairs(spark, sf_dir):
    v = V.clones(spark, sf_dir).withColumnRenamed("component_ID", "component")
    return similarity.component_edges(v, "id", "seq", "component")


LIN = f"l AS (SELECT p_partkey % 40 AS lineage, substr({DNA36}, 1, 15) AS s, p_brand AS v, p_partkey % 2 AS rep FROM part)"


def lineages(spark, sf_dir):
    p = part(spark, sf_dir)
    return p.select((F.col("p_partkey") % 40).alias("lineage_id"), F.substring("seq", 1, 15).alias("cdr3"), F.col("p_brand").alias("v_call"), F.col("p_brand").alias("j_call"), (F.col("p_partkey") % 2).alias("rep"))


@query(f"""WITH {LIN} SELECT a.lineage AS "from", b.lineage AS "to", round(avg(hamming(a.s, b.s)) / 15, 6) AS dist FROM l a JOIN l b ON a.rep = 0 AND b.rep = 1 AND a.v = b.v GROUP BY a.lineage, b.lineage
    HAVING avg(hamming(a.s, b.s)) / 15 < 0.72""")
def lineage_distance(spark, sf_dir):
    df = lineages(spark, sf_dir)
    return similarity.lineage_distances(df.filter("rep = 0"), df.filter("rep = 1"), 0.72).select("from", "to", F.round("dist", 6).alias("dist"))


@query(f"""WITH {LIN} SELECT a.lineage AS "from", b.lineage AS "to", CAST(min(hamming(a.s, b.s)) AS BIGINT) AS min_dist, round(avg(hamming(a.s, b.s)), 6) AS mean_dist FROM l a JOIN l b ON a.rep = 0 AND b.rep = 1 AND a.v = b.v GROUP BY a.lineage, b.lineage""")
def component_min_mean_dist(spark, sf_dir):
    df = lineages(spark, sf_dir)
    d = similarity.group_distances(df.filter("rep = 0"), df.filter("rep = 1"), "lineage_id", "cdr3", ["v_call"])
    return d.select("from", "to", F.col("min_dist").cast("bigint").alias("min_dist"), F.round("mean_dist", 6).alias("mean_dist"))


EVENTS = "e AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)"


def event_counts(spark, sf_dir):
    return V.table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))


@query(f"""WITH {EVENTS}, t AS (SELECT event_type, n, sum(n) OVER (PARTITION BY event_type) AS s FROM e)
    SELECT event_type, count(*) AS richness, round(-sum(n / s * ln(n / s)), 6) AS shannon, round(1 - sum(n / s * n / s), 6) AS gini_simpson, round(sum(n / s * n / s), 6) AS simpson, round(max(n / s), 6) AS berger_parker FROM t GROUP BY event_type""")
def diversity_indices(spark, sf_dir):
    d = diversity.diversity(event_counts(spark, sf_dir), "n", ["event_type"])
    return d.select("event_type", "richness", *(F.round(c, 6).alias(c) for c in d.columns[2:]))


@query(f"""WITH {EVENTS}, k AS (SELECT min(event_type) AS a, max(event_type) AS b FROM e), x AS (SELECT user_id, n FROM e, k WHERE event_type = a), y AS (SELECT user_id, n FROM e, k WHERE event_type = b),
    j AS (SELECT CAST(coalesce(x.n, 0) AS DOUBLE) AS x, CAST(coalesce(y.n, 0) AS DOUBLE) AS y FROM x FULL OUTER JOIN y USING (user_id))
    SELECT round(2 * sum(x * y) / (sum(x * x) + sum(y * y)), 6) AS morisita_counts, round(2 * sum(x * y) / ((sum(x * x) / (sum(x) * sum(x)) + sum(y * y) / (sum(y) * sum(y))) * sum(x) * sum(y)), 6) AS morisita_horn FROM j""")
def morisita_overlap(spark, sf_dir):
    e = event_counts(spark, sf_dir)
    k = e.agg(F.min("event_type").alias("a"), F.max("event_type").alias("b"))
    x, y = (e.join(F.broadcast(k.select(F.col(c).alias("event_type"))), "event_type") for c in "ab")
    return diversity.morisita(x, y, "user_id", "n").select(*(F.round(c, 6).alias(c) for c in ("morisita_counts", "morisita_horn")))


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1)")
def shared_components(spark, sf_dir):
    return collapse.shared_components(V.table(spark, sf_dir, "events"), "user_id", "event_type").select("event_id", "user_id", "event_type")


@query("""WITH s AS (SELECT user_id, count(*) AS n, min(event_id) AS f FROM events GROUP BY user_id), r AS (SELECT user_id, CAST(row_number() OVER (ORDER BY n DESC, f) AS INTEGER) AS rank FROM s) SELECT event_id, user_id, rank FROM events JOIN r USING (user_id)""")
def component_size_rank(spark, sf_dir):
    return collapse.size_rank(V.table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", "event_id")


@query("SELECT l_suppkey AS component, CAST(sum(l_quantity + l_linenumber) AS BIGINT) AS reads, count(*) AS size FROM lineitem GROUP BY l_suppkey")
def component_reads(spark, sf_dir):
    df = V.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("component"), F.col("l_quantity").cast("bigint").alias("q"), F.col("l_linenumber").cast("bigint").alias("n"))
    return collapse.component_reads(df, "component", ["q", "n"])


@query("WITH s AS (SELECT n_name, n_nationkey FROM nation) SELECT x.n_name AS a, y.n_name AS b FROM s x JOIN s y ON x.n_nationkey < y.n_nationkey WHERE x.n_name IN ('FRANCE', 'NATION_3', 'CHINA') OR y.n_name IN ('FRANCE', 'NATION_3', 'CHINA')")
def sample_pairs(spark, sf_dir):
    return collapse.sample_pairs(V.table(spark, sf_dir, "nation"), "n_name", "n_nationkey", ["FRANCE", "NATION_3", "CHINA"])


@query("SELECT c_custkey AS id, c_name AS name, 'customer' AS sample FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def union_tag(spark, sf_dir):
    a = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return collapse.union_samples({"customer": a, "supplier": b})


SCORES = "q AS (SELECT p_partkey, list_transform(range(1, CAST(21 + p_partkey % 8 AS BIGINT)), lambda i: CAST(ascii(substr(md5(CAST(p_partkey AS VARCHAR)), CAST(i AS INTEGER), 1)) % 45 AS INTEGER)) AS s FROM part), t AS (SELECT list_sort(s[3:len(s) - 1]) AS s FROM q)"


def scored(spark, sf_dir):
    h = F.md5(F.col("p_partkey").cast("string"))
    return V.table(spark, sf_dir, "part").select("p_partkey", F.transform(F.sequence(F.lit(1), (20 + F.col("p_partkey") % 8).cast("int")), lambda i: F.ascii(F.substring(h, i, F.lit(1))) % 45).alias("s"))


@query(f"""WITH {SCORES}, b AS (SELECT least(s[1], 40) AS l, least(CAST(floor((s[CAST(floor((len(s) - 1) / 2.0) AS INTEGER) + 1] + s[CAST(floor(len(s) / 2.0) AS INTEGER) + 1]) / 2.0) AS INTEGER), 40) AS m FROM t),
    k AS (SELECT CAST(range AS INTEGER) AS qscore FROM range(41)), c AS (SELECT qscore, (SELECT count(*) FROM b WHERE l = qscore) AS least, (SELECT count(*) FROM b WHERE m = qscore) AS median FROM k)
    SELECT qscore, least, median, round(100.0 * least / sum(least) OVER (), 6) AS least_pct, CAST(sum(least) OVER (ORDER BY qscore DESC) AS BIGINT) AS least_cum, round(100.0 * sum(least) OVER (ORDER BY qscore DESC) / sum(least) OVER (), 6) AS least_cum_pct,
    round(100.0 * median / sum(median) OVER (), 6) AS median_pct, CAST(sum(median) OVER (ORDER BY qscore DESC) AS BIGINT) AS median_cum, round(100.0 * sum(median) OVER (ORDER BY qscore DESC) / sum(median) OVER (), 6) AS median_cum_pct FROM c""")
def qscore_histogram(spark, sf_dir):
    h = diversity.score_histogram(scored(spark, sf_dir), "s", 2, 1)
    return h.select("qscore", "least", "median", *(c for n in ("least", "median") for c in (F.round(f"{n}_pct", 6).alias(f"{n}_pct"), f"{n}_cum", F.round(f"{n}_cum_pct", 6).alias(f"{n}_cum_pct"))))


@query("WITH q AS (SELECT list_transform(range(1, CAST(21 + p_partkey % 8 AS BIGINT)), lambda i: ascii(substr(md5(CAST(p_partkey AS VARCHAR)), CAST(i AS INTEGER), 1)) % 45) AS s FROM part) SELECT count(*) AS n_reads, CAST(min(len(s)) AS INTEGER) AS min_length, CAST(max(len(s)) AS INTEGER) AS max_length, round(avg(len(s)), 6) AS mean_length, round(sum(list_sum(s)) / sum(len(s)), 6) AS mean_score FROM q")
def read_totals(spark, sf_dir):
    t = diversity.read_totals(scored(spark, sf_dir), "s")
    return t.select("n_reads", "min_length", "max_length", F.round("mean_length", 6).alias("mean_length"), F.round("mean_score", 6).alias("mean_score"))


# umis


TEMPLATE = "ACGTACGTTAGC"


def umi_reads(spark, sf_dir):
    """From part: row, umi (13 bases, of families of ten rows, with one base changed or left out in some), full_NT, readcount."""
    k = F.col("p_partkey")
    base = V.dna(F.floor(k / 10), 13)
    umi_ = F.when(k % 5 == 0, F.concat(F.substring(base, 1, 4), F.lit("A"), F.substring(base, 6, 8))).when(k % 7 == 0, F.concat(F.substring(base, 1, 6), F.substring(base, 8, 6))).otherwise(base)
    body = V.dna(F.concat(F.lit("s"), F.floor(k / 5).cast("string")), 24)
    seq = F.when(k % 3 == 0, F.concat(F.substring(body, 1, 10), F.lit("T"), F.substring(body, 12, 13))).otherwise(body)
    return V.table(spark, sf_dir, "part").select(k.alias("row"), umi_.alias("umi"), seq.alias("full_NT"), F.col("p_size").cast("bigint").alias("readcount"))


UMI_READS = """b AS (SELECT p_partkey AS row, CAST(p_size AS BIGINT) AS readcount, substr(translate(md5(CAST(p_partkey // 10 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 13) AS u,
      substr(translate(md5('s' || CAST(p_partkey // 5 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 24) AS s FROM part),
    r AS (SELECT row, readcount, CASE WHEN row % 5 = 0 THEN substr(u, 1, 4) || 'A' || substr(u, 6, 8) WHEN row % 7 = 0 THEN substr(u, 1, 6) || substr(u, 8, 6) ELSE u END AS umi,
      CASE WHEN row % 3 = 0 THEN substr(s, 1, 10) || 'T' || substr(s, 12, 13) ELSE s END AS full_nt FROM b)"""


@query(f"""WITH RECURSIVE {UMI_READS}, n AS (SELECT umi, sum(readcount) AS rc, min(row) AS f FROM r GROUP BY umi), o AS (SELECT umi, CAST(row_number() OVER (ORDER BY rc DESC, f) AS BIGINT) AS k FROM n),
    e AS (SELECT a.k AS x, b.k AS y FROM o a JOIN o b ON a.k < b.k AND ((length(a.umi) = length(b.umi) AND hamming(a.umi, b.umi) = 1) OR (length(b.umi) = length(a.umi) - 1
      AND len(list_filter(range(1, length(a.umi) + 1), lambda i: substr(a.umi, 1, CAST(i - 1 AS INTEGER)) || substr(a.umi, CAST(i + 1 AS INTEGER)) = b.umi)) > 0))),
    t AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS seeds UNION ALL
      SELECT t.k + 1, CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.y = t.k + 1 AND list_contains(t.seeds, e.x)) THEN t.seeds ELSE list_append(t.seeds, t.k + 1) END FROM t WHERE t.k < (SELECT max(k) FROM o)),
    s AS (SELECT seeds FROM t ORDER BY k DESC LIMIT 1), d AS (SELECT unnest(seeds) AS k FROM s),
    m AS (SELECT o.umi, coalesce((SELECT min(e.x) FROM e WHERE e.y = o.k AND e.x IN (SELECT k FROM d) AND o.k NOT IN (SELECT k FROM d)), o.k) AS seed FROM o)
    SELECT r.row, o.umi AS merged_umi FROM r JOIN m ON r.umi = m.umi JOIN o ON o.k = m.seed""")
def umi_merge(spark, sf_dir):
    return umi.merge_umis(umi_reads(spark, sf_dir), "row").select("row", "merged_umi")


@query(f"""WITH RECURSIVE {UMI_READS}, o AS (SELECT row // 100 AS g, row, readcount, full_nt, CAST(row_number() OVER (PARTITION BY row // 100 ORDER BY readcount DESC, row) AS BIGINT) AS k FROM r),
    t AS (SELECT g, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS seeds FROM (SELECT DISTINCT g FROM o) UNION ALL
      SELECT t.g, t.k + 1, CASE WHEN len(list_filter(t.seeds, lambda s: levenshtein(s, o.full_nt) <= 5)) > 0 THEN t.seeds ELSE list_append(t.seeds, o.full_nt) END FROM t JOIN o ON o.g = t.g AND o.k = t.k + 1),
    z AS (SELECT g, arg_max(seeds, k) AS seeds FROM t GROUP BY g),
    p AS (SELECT o.g, o.row, o.readcount, list_position(z.seeds, list_filter(z.seeds, lambda s: levenshtein(s, o.full_nt) <= 5)[1]) AS i FROM o JOIN z ON o.g = z.g),
    c AS (SELECT g, i, sum(readcount) AS rc, count(*) AS n FROM p GROUP BY g, i HAVING sum(readcount) > 1), w AS (SELECT g, i, CAST(rc AS BIGINT) AS rc_sum, n AS n_seq, CAST(row_number() OVER (PARTITION BY g ORDER BY i) AS INTEGER) AS cluster FROM c)
    SELECT p.row, w.cluster, w.rc_sum, w.n_seq FROM p JOIN w ON p.g = w.g AND p.i = w.i""")
def subcluster(spark, sf_dir):
    reads = umi_reads(spark, sf_dir).withColumn("merged_umi", F.floor(F.col("row") / 100))
    return umi.sub_clusters(reads, "row").select("row", "cluster", "rc_sum", "n_seq")


@query(f"""WITH a AS (SELECT p_partkey % 100 AS g, CAST(p_size AS BIGINT) AS n, substr(translate(md5(CAST(p_partkey % 300 AS VARCHAR)), '0123456789abcdef', 'AAAAAACGTTTT-ACG'), 1, 12) AS s FROM part),
    l AS (SELECT g, n, CAST(unnest(range(1, 13)) AS INTEGER) AS p, s FROM a), b AS (SELECT g, p, substr(s, p, 1) AS b, sum(n) AS n FROM l GROUP BY 1, 2, 3),
    v AS (SELECT g, p, b, n, sum(n) OVER (PARTITION BY g, p) AS t, row_number() OVER (PARTITION BY g, p ORDER BY n DESC, instr('AGTC-', b)) AS k FROM b)
    SELECT g, replace(string_agg(CASE WHEN n / t > 0.6 THEN b ELSE 'X' END, '' ORDER BY p), '-', '') AS "full_NT" FROM v WHERE k = 1 GROUP BY g""")
def consensus_vote(spark, sf_dir):
    rows = V.table(spark, sf_dir, "part").select((F.col("p_partkey") % 100).alias("g"), F.col("p_size").cast("bigint").alias("readcount"), F.substring(F.translate(F.md5((F.col("p_partkey") % 300).cast("string")), V.HEX, "AAAAAACGTTTT-ACG"), 1, 12).alias("sequence"))
    return umi.consensus(rows, ["g"])


PRIMERS_F, PRIMERS_R = ["ACGTACGTAC", "TTGGCCAATT"], ["GGATCCGGAT", "CCTTAAGGCC"]


@query("""WITH s AS (SELECT p_partkey, CAST(p_size AS BIGINT) AS readcount, translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS body,
      CASE p_partkey % 4 WHEN 0 THEN 'ACGTACGTAC' WHEN 1 THEN 'TTGGCCAATT' WHEN 2 THEN 'ACGTAGTAC' ELSE 'ACGTACNTAC' END AS f, CASE p_partkey % 3 WHEN 0 THEN 'ATCCGGATCC' WHEN 1 THEN 'GGCCTTAAGG' ELSE 'ATCCGTATCC' END AS r, CAST(12 + p_partkey % 5 AS INTEGER) AS n FROM part)
    SELECT p_partkey, substr(body, 17, n) AS umi, 'TC' || substr(body, 1, 16) || 'AGAG' AS full_nt, readcount FROM s WHERE n BETWEEN 13 AND 15 AND p_partkey % 4 <> 3""".replace("AS full_nt, readcount", 'AS "full_NT", readcount'))
def primer_umi(spark, sf_dir):
    k = F.col("p_partkey")
    keys = V.spread(V.table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    body = V.dna("p_partkey", 32)
    f = F.get(F.array(*map(F.lit, ["ACGTACGTAC", "TTGGCCAATT", "ACGTAGTAC", "ACGTACNTAC"])), (k % 4).cast("int"))
    r = F.get(F.array(*map(F.lit, ["ATCCGGATCC", "GGCCTTAAGG", "ATCCGTATCC"])), (k % 3).cast("int"))
    read = F.concat(f, F.lit("TC"), F.substring(body, 1, 16), F.lit("AGAG"), r, F.substring(body, F.lit(17), (12 + k % 5).cast("int")))
    rows = keys.select("p_partkey", read.alias("sequence"), F.struct("p_partkey", F.col("p_size").cast("bigint").alias("n")).alias("readcount"))
    out = umi.extract_umis(rows, PRIMERS_F, PRIMERS_R)
    return out.select("readcount.p_partkey", "umi", "full_NT", F.col("readcount.n").alias("readcount"))


@query(f"""WITH {UMI_READS} SELECT umi, count(*) AS n_seq, CAST(sum(readcount) AS BIGINT) AS rc_sum FROM r GROUP BY umi HAVING NOT (sum(readcount) = 1 OR (count(*) = 2 AND sum(readcount) = 2))""")
def umi_counts(spark, sf_dir):
    return umi.umi_summary(umi_reads(spark, sf_dir), "umi").filter(filters.consensus_clusters())


ERRORS = f"""b AS (SELECT *, translate(md5(CAST(p_partkey // 6 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS t FROM part),
    c AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN substr(t, 1, 12) ELSE substr(t, 1, CAST(p_partkey % 6 AS INTEGER)) || 'T' || substr(t, CAST(p_partkey % 6 + 2 AS INTEGER), CAST(11 - p_partkey % 6 AS INTEGER)) END AS s, CAST(p_size * p_size AS BIGINT) AS n FROM b),
    u AS (SELECT s, min(id) AS id, CAST(sum(n) AS BIGINT) AS n0, CAST(sum(n * (id % 3)) AS BIGINT) AS n1 FROM c GROUP BY s)"""


def erroneous(spark, sf_dir):
    k = F.col("p_partkey")
    t, at = V.dna(F.floor(k / 6), 32), (k % 6).cast("int")
    changed = F.concat(F.substring(t, F.lit(1), at), F.lit("T"), F.substring(t, at + 2, 11 - at))
    c = V.table(spark, sf_dir, "part").select(k.alias("id"), F.when(k % 3 == 0, F.substring(t, 1, 12)).otherwise(changed).alias("s"), (F.col("p_size") * F.col("p_size")).cast("bigint").alias("n"))
    return c.groupBy("s").agg(F.min("id").alias("id"), F.sum("n").alias("n0"), F.sum(F.col("n") * (F.col("id") % 3)).alias("n1"))


def _zeroed_sql(n: str) -> str:
    """Evaluated clone by clone in descending counts, as a list of those that act or are zeroed."""
    return f"""o_{n} AS (SELECT id, s, {n} AS n, CAST(row_number() OVER (ORDER BY {n} DESC, id) AS BIGINT) AS k FROM u),
    e_{n} AS (SELECT a.k AS x, b.k AS y FROM o_{n} a JOIN o_{n} b ON length(a.s) = length(b.s) AND hamming(a.s, b.s) = 1 AND a.n * 0.1 >= 2 AND b.n < a.n * 0.1 AND b.n > 0),
    t_{n} AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS z UNION ALL SELECT t.k + 1, CASE WHEN EXISTS (SELECT 1 FROM e_{n} e WHERE e.y = t.k + 1 AND NOT list_contains(t.z, e.x)) THEN list_append(t.z, t.k + 1) ELSE t.z END FROM t_{n} t WHERE t.k < (SELECT max(k) FROM o_{n})),
    z_{n} AS (SELECT o.id FROM o_{n} o, (SELECT z FROM t_{n} ORDER BY k DESC LIMIT 1) q WHERE list_contains(q.z, o.k))"""


@query(f"""WITH RECURSIVE {ERRORS}, {_zeroed_sql('n0')}, {_zeroed_sql('n1')}, f AS (SELECT id, CASE WHEN id IN (SELECT id FROM z_n0) THEN 0 ELSE n0 END AS n0, CASE WHEN id IN (SELECT id FROM z_n1) THEN 0 ELSE n1 END AS n1 FROM u)
    SELECT id, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1 FROM f WHERE n0 + n1 > 1""")
def error_correct(spark, sf_dir):
    return correction.correct_errors(erroneous(spark, sf_dir), "id", "s", ["n0", "n1"], 0.1).select("id", "n0", "n1")


# graphs


@query(f"""WITH RECURSIVE {C12}, e AS ({LEV3.format(C12, 3)[len("WITH ") + len(C12) + 1:]}), b AS (SELECT "from" AS x, "to" AS y FROM e UNION SELECT "to", "from" FROM e),
    r(id, root) AS (SELECT id, id FROM c UNION SELECT b.y, r.root FROM r JOIN b ON b.x = r.id WHERE r.root < b.y) SELECT id, min(root) AS component FROM r GROUP BY id""")
def connected_components(spark, sf_dir):
    v = V.clones(spark, sf_dir).select("id", "seq")
    rows = v.select("id", F.col("seq").alias("s"), F.col("id").alias("root"))
    return similarity.radius_clusters(rows, [], 3, Scratch(spark), cross_length=False).select("id", F.col("root").alias("component"))


@query(f"""WITH RECURSIVE {V.CLONES}, o AS (SELECT id, substr(seq, 1, 4) AS s, split_part("V_gene", '*', 1) || '|' || "J_gene" AS g, readcount FROM clones),
    k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY readcount DESC, id) AS k FROM o), b AS (SELECT g, list(s ORDER BY k) AS seqs, list(id ORDER BY k) AS ids, range(1, count(*) + 1) AS every FROM k GROUP BY g),
    t AS (SELECT g, CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS left_, CAST(1 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS held, every AS rest, CAST(-1 AS BIGINT) AS num, CAST([] AS BIGINT[]) AS members, CAST([] AS BIGINT[]) AS numbers FROM b
      UNION ALL SELECT g, step + 1, CASE WHEN go THEN left_ ELSE rest[1:len(rest) - 1] END, CASE WHEN go THEN i + 1 ELSE 1 END, CASE WHEN NOT go THEN [rest[len(rest)]] WHEN close THEN list_append(held, left_[i]) ELSE held END,
        CASE WHEN NOT go THEN CAST([] AS BIGINT[]) WHEN close THEN rest ELSE list_append(rest, left_[i]) END, CASE WHEN go THEN num ELSE num + 1 END,
        CASE WHEN NOT go THEN list_append(members, rest[len(rest)]) WHEN close THEN list_append(members, left_[i]) ELSE members END, CASE WHEN NOT go THEN list_append(numbers, num + 1) WHEN close THEN list_append(numbers, num) ELSE numbers END
      FROM (SELECT t.*, i <= len(left_) AS go, i <= len(left_) AND len(list_filter(held, lambda h: hamming(b.seqs[h], b.seqs[left_[i]]) < 2)) > 0 AS close FROM t JOIN b USING (g)) x WHERE go OR len(rest) > 0),
    f AS (SELECT g, arg_max(members, step) AS members, arg_max(numbers, step) AS numbers FROM t GROUP BY g), m AS (SELECT g, unnest(members) AS k, unnest(numbers) AS n FROM f),
    r AS (SELECT k.id, m.g, m.n FROM m JOIN k USING (g, k)), z AS (SELECT g, n, row_number() OVER (ORDER BY count(*) DESC, min(id)) AS rank FROM r GROUP BY g, n)
    SELECT c.id, substr(c.seq, 1, 4) AS "CDR3_AA", c."V_gene", c."J_gene", c.id AS "component_ID", c.id % 2 AS sample, c.readcount, CAST(z.rank AS INTEGER) AS "component_ID_merged" FROM clones c JOIN r ON r.id = c.id JOIN z ON z.g = r.g AND z.n = r.n""")
def component_merge(spark, sf_dir):
    v = V.clones(spark, sf_dir).select("id", F.substring("seq", 1, 4).alias("CDR3_AA"), "V_gene", "J_gene", F.col("id").alias("component_ID"), (F.col("id") % 2).alias("sample"), "readcount")
    return merging.merge_components(v, "id", 2, ["readcount"])


@query(f"""WITH RECURSIVE {V.CLONES}, v AS (SELECT CAST(id AS VARCHAR) AS name, seq, "component_ID" AS c, CAST(id % 5 AS INTEGER) AS d FROM clones),
    e AS (SELECT a.c, a.name AS a, b.name AS b, CAST(levenshtein(a.seq, b.seq) AS INTEGER) AS d, row_number() OVER (PARTITION BY a.c ORDER BY a.name, b.name) AS i FROM v a JOIN v b ON a.c = b.c AND a.name < b.name),
    n AS (SELECT c, count(*) AS size, min(d) AS least FROM v GROUP BY c), f AS (SELECT v.c, n.size, n.least, list(v.name) AS front FROM v JOIN n ON v.c = n.c AND v.d = n.least GROUP BY ALL), p AS (SELECT c, list({{'i': i, 'a': a, 'b': b, 'd': d}}) AS edges FROM e GROUP BY c),
    t AS (SELECT f.c, CAST(0 AS BIGINT) AS step, f.front AS reached, CAST([] AS BIGINT[]) AS chosen, p.edges FROM f JOIN p ON f.c = p.c WHERE NOT (f.size = 2 AND len(f.front) = 2)
      UNION ALL SELECT c, step + 1, list_distinct(list_concat(reached, list_concat(list_transform(kept, lambda x: x.a), list_transform(kept, lambda x: x.b)))), list_concat(chosen, list_transform(kept, lambda x: x.i)), edges
      FROM (SELECT *, CASE WHEN len(list_filter(crossing, lambda x: x.d <= 7)) > 0 THEN list_filter(crossing, lambda x: x.d <= 7) ELSE list_filter(crossing, lambda x: x.d = list_min(list_transform(crossing, lambda y: y.d))) END AS kept
        FROM (SELECT *, list_filter(edges, lambda x: NOT list_contains(chosen, x.i) AND list_contains(reached, x.a) <> list_contains(reached, x.b)) AS crossing FROM t) y) z WHERE len(crossing) > 0),
    l AS (SELECT c, arg_max(chosen, step) AS chosen FROM t GROUP BY c)
    SELECT 'V' || CAST(f.c % 3 AS VARCHAR) || '|J1' AS "from", unnest(f.front) AS "to", CAST(f.least + 1 AS INTEGER) AS dist FROM f
    UNION ALL SELECT e.a, e.b, e.d FROM e JOIN l ON e.c = l.c WHERE list_contains(l.chosen, e.i) OR e.d <= 7""")
def germline_graph(spark, sf_dir):
    k = F.col("id")
    v = V.clones(spark, sf_dir).select(k.cast("string").alias("name"), F.col("seq").alias("full_NT"), "component_ID", F.concat(F.lit("V"), (F.col("component_ID") % 3).cast("string")).alias("V_gene"), F.lit("J1*01").alias("J_gene"), (k % 5).cast("int").alias("distance_from_V_gene"))
    return germline.germline_graph(v, 7)[1]


TREES = f"""{V.CLONES}, v AS (SELECT "component_ID" AS c, CAST(id AS VARCHAR) AS name, seq, row_number() OVER (PARTITION BY "component_ID" ORDER BY CAST(id AS VARCHAR)) AS i FROM clones),
    h AS (SELECT a.c, a.i, list(hamming(a.seq, b.seq) ORDER BY b.i) AS row FROM v a JOIN v b ON a.c = b.c GROUP BY a.c, a.i), m AS (SELECT c, list(row ORDER BY i) AS d FROM h GROUP BY c),
    t AS (SELECT c, CAST(1 AS BIGINT) AS step, list({{'label': name, 'h': CAST(0 AS DOUBLE), 'leaves': [i]}} ORDER BY i) AS cl, list({{'a': name, 'b': name, 'n': CAST(0 AS DOUBLE)}})[1:0] AS edges FROM v GROUP BY c
      UNION ALL SELECT c, step + 1, list_concat(list_concat(list_concat(cl[1:p.i - 1], [{{'label': 'Inner' || CAST(step AS VARCHAR), 'h': p.m / 2, 'leaves': list_concat(cl[p.i].leaves, cl[p.j].leaves)}}]), cl[p.i + 1:p.j - 1]), cl[p.j + 1:]),
        list_concat(edges, [{{'a': 'Inner' || CAST(step AS VARCHAR), 'b': cl[p.i].label, 'n': (p.m / 2 - cl[p.i].h) / 12}}, {{'a': 'Inner' || CAST(step AS VARCHAR), 'b': cl[p.j].label, 'n': (p.m / 2 - cl[p.j].h) / 12}}])
      FROM (SELECT t.*, list_sort(flatten(list_transform(range(1, len(cl)), lambda x: list_transform(range(x + 1, len(cl) + 1), lambda y: {{
        'm': CAST(list_sum(list_transform(cl[x].leaves, lambda u: list_sum(list_transform(cl[y].leaves, lambda w: m.d[u][w])))) AS DOUBLE) / (len(cl[x].leaves) * len(cl[y].leaves)), 'i': x, 'j': y}}))))[1] AS p FROM t JOIN m USING (c) WHERE len(cl) > 1) z),
    f AS (SELECT c, arg_max(cl, step) AS cl, arg_max(edges, step) AS edges, max(step) - 1 AS last FROM t GROUP BY c), e AS (SELECT c, last, unnest(edges) AS e FROM f)"""


@query(f"""WITH RECURSIVE {TREES} SELECT c AS "component_ID", e.a AS "from", e.b AS "to", round(e.n, 6) AS length, CASE WHEN e.a = 'Inner' || CAST(last AS VARCHAR) THEN 1 ELSE 0 END AS root FROM e""")
def phylo_trees(spark, sf_dir):
    t = graph.trees(V.clones(spark, sf_dir).select("component_ID", F.col("id").cast("string").alias("name"), F.col("seq").alias("sequence")), "component_ID")
    return t.withColumn("length", F.round("length", 6))


@query(f"""WITH RECURSIVE {TREES}, l AS (SELECT f.c, v.name, u.k AS leaf_rank FROM f, (SELECT c, unnest(cl[1].leaves) AS i, unnest(range(1, len(cl[1].leaves) + 1)) AS k FROM f) u, v WHERE u.c = f.c AND v.c = f.c AND v.i = u.i),
    up AS (SELECT c, e.b AS b, CASE WHEN round(e.n, 9) > 0.2 THEN NULL ELSE e.a END AS a FROM e), w AS (SELECT c, name, name AS node, 0 AS n FROM l UNION ALL SELECT w.c, w.name, up.a, n + 1 FROM w JOIN up ON up.c = w.c AND up.b = w.node WHERE up.a IS NOT NULL),
    peaks AS (SELECT c, name, arg_max(node, n) AS peak FROM w GROUP BY c, name), k AS (SELECT l.*, min(l.leaf_rank) OVER (PARTITION BY l.c, peak) AS least FROM l JOIN peaks USING (c, name))
    SELECT c AS "component_ID", name, CAST(leaf_rank AS INTEGER) AS leaf_rank, CAST(dense_rank() OVER (PARTITION BY c ORDER BY least) AS INTEGER) AS subtree FROM k""")
def phylo_ranks(spark, sf_dir):
    return graph.tree_ranks(V.clones(spark, sf_dir).select("component_ID", F.col("id").cast("string").alias("name"), F.col("seq").alias("sequence")), "component_ID", threshold=0.2)


@query(f"""WITH {V.CLONES}, r AS (SELECT id, seq, unnest(range(1, readcount + 1)) AS i FROM clones), d AS (SELECT id, seq, i, md5(CAST(id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '-7') AS h FROM r),
    k AS (SELECT * FROM d ORDER BY h, id, i LIMIT 5000) SELECT id, seq, count(*) AS readcount FROM k GROUP BY id, seq""")
def rarefy(spark, sf_dir):
    return collapse.rarefy(V.clones(spark, sf_dir).select("id", "seq", "readcount"), 5000, seed=7, id_col="id")


from clonespark import annotation_queries, file_queries  # noqa: E402, F401 they add theirs
