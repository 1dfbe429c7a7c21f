"""Operators against plain models of what they do, and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clonespark.adapters import align, igblast, pairs, seeded
from clonespark.adapters.tools import ChainType
from clonespark.functions import cells, distance, dna, protein
from clonespark.operators import collapse, correction, filters, germline, graph, merging, prefix_tree, similarity, umi
from clonespark.operators.components import components
from clonespark.plans import repertoire
from clonespark.scratch import Scratch
from clonespark.sources import delimited, sequences
from clonespark.streaming import collapse as stream


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_scalar_functions(spark):
    df = spark.createDataFrame([("ATGTAG", 4, 1), ("atg", 0, 5), ("", 1, 1), ("AT", 2, 0), (".../x", 3, 3)], "s string, a int, b int")
    got = [tuple(r) for r in df.select(dna.translate_dna("s"), dna.translate_dna("s", "suppressed"), dna.reverse_complement("s")).collect()]
    assert got == [("M*", "MQ", "CTACAT"), ("X", "X", "gta"), ("", "", ""), ("X", "X", "AT"), (".X", "XX", "x/...")]
    cut = spark.createDataFrame([("ACGTACGT", 3, 1), ("ACGTACGT", 1, 3), ("ACG", 0, 9)], "s string, a int, b int").select(dna.variable_region("s", "a", "b")).collect()
    assert [r[0] for r in cut] == ["ACGTACGT"[: 3 - 1], "ACGTACGT"[: 1 - 3], "ACG"[:-9]]
    kinds = spark.createDataFrame([("ACG",), ("MKL",), ("12",), ("",)], "s string").select(dna.sequence_class("s")).collect()
    assert [r[0] for r in kinds] == [True, False, None, True]
    assert spark.range(1).select(dna.iupac_pattern(F.lit("ARu")), dna.iupac_pattern(F.lit("AR"), False)).first()[:] == ("A[AG]U", "[CT]T")
    assert spark.range(1).select(dna.vector_insert(F.lit("aaXXbb"), "XX", F.lit("L"), "-", F.lit("H"))).first()[0] == "aaL-Hbb"


def test_distances(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choices("ACGT", k=n)), "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("ACGT", k=n))) for n in (1, 7, 31, 32, 70)]
    df = spark.createDataFrame(rows, "a string, b string, r string")
    h = distance.hamming("a", "b")
    planes = distance.hamming_of_planes(distance.bit_planes("a"), distance.bit_planes("b"))
    diff = distance.hamming_of_differences(distance.differences("r", "a"), distance.differences("r", "b"))
    for r, (a, b, _) in zip(df.select(h, planes, diff).collect(), rows):
        assert set(r) == {sum(x != y for x, y in zip(a, b))}
    odd = spark.createDataFrame([("A.C", "ATG"), ("AC", "ACG"), ("", "")], "a string, b string").select(h, distance.differences("a", "b"))
    assert [r[0] for r in odd.collect()] == [1, 3, 0]
    assert spark.range(1).select(distance.bit_planes(F.lit("ACN"))).first()[0] is None


def test_protein(spark):
    df = spark.createDataFrame([("NGNSTW",), ("",), (None,)], "query string")
    assert [tuple(r)[1:4] for r in protein.ptm_counts(df).collect()] == [(2, 0, 1), (0, 0, 0), (0, 0, 0)]
    marked = protein.marked_residues(df.limit(1)).first()["residues"]
    assert marked["R1"] == "{bg_color:Deamidation}N" and marked["R6"] == "{bg_color:Oxidation}W" and marked["R5"] == "{bg_color:N Glycosylation}T"
    assert spark.range(1).select(protein.gravy(F.lit("AR"))).first()[0] == pytest.approx((1.8 - 4.5) / 2)
    pi = [r[0] for r in spark.createDataFrame([("K",), ("D",), ("",)], "s string").select(protein.isoelectric_point("s")).collect()]
    # midway between the two groups around zero: both amino groups of K, both acids of D
    assert pi[0] == pytest.approx((7.5 + 10.0) / 2, abs=0.01) and pi[1] == pytest.approx((4.05 + 4.55) / 2, abs=0.01) and pi[2] is None


def test_numbering(spark):
    df = spark.createDataFrame([("ABCDEFGHIJ",), ("A",), ("AB",), ("-",)], "query string")
    out = {r["query"]: r for r in protein.number_cdr3(df, "heavy").collect()}
    first = out["ABCDEFGHIJ"]["residues"]
    assert (first["95"], first["100"], first["100A"], first["100B"], first["101"], first["102"]) == ("A", "F", "G", "H", "I", "J")
    assert out["A"]["residues"]["95"] == "A" and out["AB"]["residues"]["102"] == "B" and out["-"]["HCDR3"] == "-"
    regions = spark.createDataFrame([(1, "CDEFGHIKLMNPQ", "W"), (2, "CD", "WGQGTKVEIKRTPP"), (3, "CD", "WGQGTKVEIKRTPA")], "o int, CDR1 string, FR4 string")
    got = {r["o"]: r for r in protein.number_regions(regions, "light", "o").collect()}
    assert "L27B" in got[1]["CDR1_residues"] and got[1]["CDR1_residues"]["L34"] == "Q" and got[2]["CDR1_residues"]["L33"] == "C"
    assert got[1]["FR4_residues"]["L98"] == "W" and got[3]["FR4_residues"]["L109"] == "A"


def test_cells(spark):
    df = spark.createDataFrame([("12",), ("007",), ("1e5",), ("NULL",), ("None",), ('"x"',)], "s string").select(cells.typed("s").alias("t")).select("t.*")
    assert [r["kind"] for r in df.collect()] == ["int", "str", "float", "str", "none", "str"]
    f = spark.createDataFrame([("{a:1}x{b:2}{a:3}",), ("x",)], "s string").select(cells.without_formats("s"), cells.formats("s"))
    assert [tuple(r) for r in f.collect()] == [("x", {"a": "3", "b": "2"}), ("x", {})]


@pytest.mark.parametrize("method", ["pairs", "segments", "tree"])
@pytest.mark.parametrize("metric", ["levenshtein", "hamming"])
def test_similarity_join(spark, method, metric):
    rng = random.Random(3)
    base = ["".join(rng.choices("ACGT", k=k)) for k in (16, 16, 19)]
    rows = []
    for i in range(60):
        s = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            p = rng.randrange(len(s))
            if rng.random() < 0.5:
                s[p] = rng.choice("ACGT")
            else:  # a base moved: edits beyond substitutions, of one length
                s.insert(rng.randrange(len(s)), s.pop(p))
        rows.append((i, "".join(s)))
    df = spark.createDataFrame(rows, "id int, s string")
    d = lev if metric == "levenshtein" else lambda a, b: sum(x != y for x, y in zip(a, b))
    wanted = sorted((i, j, d(a, b)) for i, a in rows for j, b in rows if i < j and len(a) == len(b) and d(a, b) <= 3)
    assert values(similarity.similarity_join(df, "id", "s", 3, metric=metric, method=method), "from", "to", "dist") == wanted and wanted


def test_lineage_distances(spark):
    rng = random.Random(13)
    side = lambda: [(rng.randrange(4), "".join(rng.choices("AC.", [5, 5, 1], k=rng.choice((4, 5)))), rng.choice(("V1*01", "V1*02", "V2*01")), "J1") for _ in range(40)]
    a, b = side(), side()
    d = lambda x, y: sum(p != q and "." not in (p, q) for p, q in zip(x, y))
    wanted = {}
    for i, s, v, _ in a:
        for j, t, w, _ in b:
            if v[:2] == w[:2] and len(s) == len(t):
                wanted.setdefault((i, j, len(s)), []).append(d(s, t))
    schema = "lineage_id int, cdr3 string, v_call string, j_call string"
    got = similarity.lineage_distances(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 0.42).collect()
    means = sorted((i, j, round(sum(x) / len(x) / n, 9)) for (i, j, n), x in wanted.items() if sum(x) / len(x) / n < 0.42)
    assert sorted((r["from"], r["to"], round(r["dist"], 9)) for r in got) == means and means


def test_nearest_and_empty(spark):
    v = spark.createDataFrame([(1, "AAAA"), (2, "AAAA"), (3, "AAAT"), (4, "GGGG")], "id int, s string")
    e = similarity.similarity_join(v, "id", "s", 1)
    assert values(similarity.nearest(v, e, "id", "s").fillna(-1), "seq_id", "min_dist") == [(1, 1), (2, 1), (3, 1), (4, -1)]
    assert similarity.similarity_join(v.limit(0), "id", "s", 1).count() == 0


def greedy(order, reach):
    seed = {}
    for n in order:
        if n not in seed:
            seed[n] = n
            for m in order:
                if m not in seed and (n, m) in reach:
                    seed[m] = n
    return seed


def test_greedy_stars(spark):
    rng = random.Random(5)
    for _ in range(4):
        nodes = [(i, rng.randrange(5), i) for i in range(25)]
        reach = {(rng.randrange(25), rng.randrange(25)) for _ in range(60)}
        order = [n[0] for n in sorted(nodes, key=lambda n: n[1:])]
        got = umi.greedy_stars(spark.createDataFrame(nodes, "k int, p int, q int"), spark.createDataFrame([r for r in reach if r[0] != r[1]], "from int, to int"), "k", ["p", "q"], Scratch(spark))
        assert {r["k"]: r["seed"] for r in got.collect()} == greedy(order, reach)


def test_sub_clusters(spark, monkeypatch):
    rng = random.Random(17)
    rows, row = [], 0
    for u in "ab":
        base = ["".join(rng.choices("ACGT", k=14)) for _ in range(4)]
        for _ in range(25):
            s = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                s[rng.randrange(len(s))] = rng.choice(["", "A", "CG"])
            rows.append((row, u, "".join(s), rng.randrange(1, 5)))
            row += 1
    wanted = {}
    for u in "ab":
        seeds, place = [], {}
        for r in sorted((r for r in rows if r[1] == u), key=lambda r: (-r[3], r[0])):
            k = next((k for k, s in enumerate(seeds) if lev(s, r[2]) <= 3), None)
            if k is None:
                k = len(seeds)
                seeds.append(r[2])
            place[r[0]] = k
        reads = {k: sum(r[3] for r in rows if place.get(r[0]) == k) for k in range(len(seeds))}
        kept = [k for k in range(len(seeds)) if reads[k] > 1]
        wanted |= {r: (kept.index(k) + 1, reads[k]) for r, k in place.items() if k in kept}
    df = spark.createDataFrame(rows, "row int, merged_umi string, full_NT string, readcount int")
    for most in (5000, 10):
        monkeypatch.setattr(umi, "FOLD_ROWS", most)
        assert {r["row"]: (r["cluster"], r["rc_sum"]) for r in umi.sub_clusters(df, "row", threshold=3).collect()} == wanted


def test_consensus(spark):
    df = spark.createDataFrame([(1, "A-C", 3), (1, "AGC", 2), (1, "TGT", 5), (2, "AA", 1)], "g int, sequence string, readcount long")
    assert values(umi.consensus(df, ["g"]), "g", "full_NT") == [(1, "XGX"), (2, "AA")]
    with pytest.raises(Exception, match="not a base"):
        umi.consensus(spark.createDataFrame([(1, "AN", 3)], "g int, sequence string, readcount long"), ["g"]).collect()


def test_correction(spark):
    rng = random.Random(7)
    seqs = sorted({"".join(rng.choices("AC", k=5)) for _ in range(40)})
    rows = [(i, s, rng.choice([0, 1, 5, 40, 300, 2000])) for i, s in enumerate(seqs)]
    n = {i: c for i, _, c in rows}
    for i, s, _ in sorted(rows, key=lambda r: -r[2]):
        if n[i] * 0.1 >= 2:
            for j, t, _ in rows:
                if sum(x != y for x, y in zip(s, t)) == 1 and n[j] < n[i] * 0.1:
                    n[j] = 0
    got = correction.correct_errors(spark.createDataFrame(rows, "k int, s string, a long"), "k", "s", ["a"], 0.1)
    assert values(got, "k", "a") == sorted((i, c) for i, c in n.items() if c > 1)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a int, b int"), Scratch(spark)).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}
    assert components(spark.createDataFrame([], "a int, b int"), Scratch(spark)).count() == 0


def plain_merge(components, threshold, linkage):
    """Groups by the pass itself: components by descending reads, as lists of CDR3s."""
    d = lambda x, y: sum(p != q and "." not in (p, q) for p, q in zip(x, y))
    group, left, number = [-1] * len(components), list(range(len(components))), 0
    while left:
        ref = left.pop()
        group[ref], held, rest = number, list(components[ref]), []
        for c in left:
            far = [d(x, y) for x in held for y in components[c]]
            if (min(far) if linkage == "min" else sum(far) / len(far)) < threshold:
                group[c] = number
                held += components[c]
            else:
                rest.append(c)
        left, number = rest, number + 1
    return group


def test_absorption_grows_within_a_pass(spark):
    # what a pass went by stays apart, though the reference has come closer; what comes later is held against all it has grown to
    assert plain_merge([["AACC"], ["AAAC"], ["AAAA"]], 2, "min") == [1, 0, 0]
    assert plain_merge([["AAAC"], ["AACC"], ["AAAA"]], 2, "min") == [0, 0, 0]


@pytest.mark.parametrize("linkage", ["min", "mean"])
def test_merged_components(spark, linkage, monkeypatch):
    rng = random.Random(51)
    rows, k = [], 0
    for c in range(130):
        gene, size = rng.choice(("V1*01", "V1*02", "V2*01")), rng.choice((5, 6))
        for _ in range(rng.randrange(1, 4)):
            k += 1
            text = "".join(rng.choices("ACD.", [6, 5, 5, 1], k=size if rng.random() < 0.9 else 4))
            rows.append((k, "x", c, text, gene, "J1", rng.randrange(1, 6)))
    rows += [(k + 1, "x", 900, None, "V1*01", "J1", 2), (k + 2, "x", 901, None, "V1*01", "J1", 1), (k + 3, "x", 902, "", "V1*01", "J1", 1)]
    df = spark.createDataFrame(rows, "id int, sample string, component_ID int, CDR3_AA string, V_gene string, J_gene string, n int").repartition(3)
    buckets = {}
    for c in sorted({r[2] for r in rows}):
        own = sorted(r for r in rows if r[2] == c)
        length = None if own[0][3] is None else len(own[0][3])
        texts = sorted({r[3] or "" for r in own if len(r[3] or "") == (length or 0)})
        buckets.setdefault((length, own[0][4][:2]), []).append((-sum(r[6] for r in own), own[0][0], c, texts))
    wanted = set()
    for threshold in (2, 2.5):
        for held in buckets.values():
            held.sort()
            groups = plain_merge([x[3] for x in held], threshold, linkage)
            wanted |= {(threshold, frozenset(x[2] for x, h in zip(held, groups) if h == g)) for g in set(groups)}
    assert any(len(g) > 2 for _, g in wanted) and len({len(g) for _, g in wanted}) > 2
    for links in (5_000_000, 3):
        monkeypatch.setattr(merging, "PART_LINKS", links)
        got = set()
        for threshold in (2, 2.5) if links > 3 else (2,):
            found = {}
            for r in merging.merge_components(df, "id", threshold, ["n"], linkage=linkage).select("component_ID", "component_ID_merged").collect():
                found.setdefault(r[1], set()).add(r[0])
            got |= {(threshold, frozenset(x)) for x in found.values()}
        assert got == {w for w in wanted if links > 3 or w[0] == 2}
        if linkage == "mean":
            break


def test_profiles_give_mean_distances():
    rng = random.Random(52)
    d = lambda x, y: sum(p != q and "." not in (p, q) for p, q in zip(x, y))
    for _ in range(50):
        x, y, z = (["".join(rng.choices("AC.", k=4)) for _ in range(rng.randrange(1, 5))] for _ in range(3))
        held = merging.Profile(x)
        held.add(merging.Profile(z))
        assert held.mean(merging.Profile(y)) == pytest.approx(np.mean([d(a, b) for a in x + z for b in y]))


def plain_roots(vertices, edges, root, threshold):
    """Edges of a component by growing from its nearest vertices, all pairs given."""
    least = min(d for _, d in vertices)
    front = [n for n, d in vertices if d == least]
    out = [(root, n, least + 1) for n in front]
    if len(vertices) == 2 and len(front) == 2:
        return out
    reached, left = set(front), list(edges)
    while crossing := [e for e in left if (e[0] in reached) != (e[1] in reached)]:
        kept = [e for e in crossing if e[2] <= threshold] or [e for e in crossing if e[2] == min(x[2] for x in crossing)]
        out += kept
        left = [e for e in left if e not in kept]
        reached |= {n for e in kept for n in e[:2]}
    return out + [e for e in left if e[2] <= threshold]


def test_germline_graphs(spark):
    v = [("a", 1), ("b", 3), ("c", 5)]
    assert plain_roots(v, [("a", "b", 2), ("a", "c", 9), ("b", "c", 8)], "V|J", 3) == [("V|J", "a", 2), ("a", "b", 2), ("b", "c", 8)]
    rng = random.Random(53)
    rows = []
    for c in range(9):
        centres = ["".join(rng.choices("ACGT", k=rng.choice((11, 12, 12)))) for _ in range(3)]
        for i in range((1, 2, 2, 12, 14, 16, 9, 20, 3)[c]):
            s = "".join(x if rng.random() > 0.12 else rng.choice("ACGT") for x in rng.choice(centres))
            rows.append((f"{c}-{i:02}", s, c, rng.choice((0, 1, 2, 5)) if c != 1 else 3, f"V{c % 2}*01", "J1*02"))
    df = spark.createDataFrame(rows, "name string, full_NT string, component_ID int, distance_from_V_gene int, V_gene string, J_gene string").repartition(3)
    wanted = []
    for c in range(9):
        own = sorted(r for r in rows if r[2] == c)
        pairs = [(a[0], b[0], lev(a[1], b[1])) for a in own for b in own if a[0] < b[0]]
        wanted += plain_roots([(r[0], r[3]) for r in own], pairs, f"V{c % 2}|J1", 2)
    assert any(d > 3 for a, _, d in wanted if "|" not in a)
    every, edges = germline.germline_graph(df, 2)
    assert values(edges, "from", "to", "dist") == sorted(wanted) and every.count() == len(rows) + 2


def test_trees():
    d = np.array([[0, 2, 6], [2, 0, 6], [6, 6, 0]], float)
    edges = graph.upgma(["x", "y", "z"], d)
    assert sorted((b, length) for _, b, length in edges) == [("Inner1", 2.0), ("x", 1.0), ("y", 1.0), ("z", 3.0)]
    assert sorted(graph.leaf_order(edges)) == ["x", "y", "z"]
    assert sorted(map(sorted, graph.cut_tree(edges, 1.5))) == [["x", "y"], ["z"]]


def test_collapse_edges(spark):
    df = spark.createDataFrame([(1, "AAA", "M", 2, 4), (2, "AAA", "M", 3, None), (3, "TAAA", "G1", 1, 4)], "row int, full_NT string, isotype string, readcount int, FR1_to int")
    assert values(collapse.trim_and_merge(df, "row"), "full_NT", "isotype", "readcount", "full_AA") == [("AA", "M", 2, "X"), ("AAA", "G1", 1, "K")]
    ids = collapse.set_ids(spark.range(100).withColumn("s", F.when(F.col("id") % 3 == 0, "AA").otherwise("AAA")), "s", "id")
    two = [r["seq_id"] for r in ids.filter("s = 'AA'").orderBy("id").collect()]
    assert two == [f"2-{i + 1}" for i in range(34)]
    drawn = collapse.rarefy(spark.createDataFrame([("a", 5), ("b", 0), ("c", 3)], "s string, readcount long"), 4, seed=1)
    assert drawn.agg(F.sum("readcount")).first()[0] == 4 and drawn.filter("s = 'b'").count() == 0
    assert filters.pass_rates(df.limit(0), filters.umi_length("full_NT")).first()["row_rate"] is None


def test_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\n1,NULL\n2,"x",y,z\n-3,p-q,r\n')
    assert values(delimited.read_padded(spark, str(tmp_path / "t.csv")), "_row_id", "a", "b", "c") == [(1, "1", "None", ""), (2, "2", "x", "y"), (3, "-3", "p-q", "r")]
    exact = delimited.read_exact(spark, str(tmp_path / "t.csv"), schema=spark.createDataFrame([], "a long").schema)
    assert values(exact, "a", "b") == [(-3, "p-q")] and delimited.header(spark, str(tmp_path / "t.csv")) == ["a", "b", "c"]
    (tmp_path / "s.fasta").write_text(">one x\nac\ngt\n>two\nTT\n")
    assert values(sequences.read_fasta(spark, str(tmp_path / "s.fasta")), "name", "sequence") == [("one x", "ACGT"), ("two", "TT")]
    (tmp_path / "bad.fasta").write_text("one\nACGT\n")
    with pytest.raises(Exception, match="not FASTA"):
        sequences.read_fasta(spark, str(tmp_path / "bad.fasta")).collect()
    (tmp_path / "UMI-1_2_7.fasta").write_text(">4\nACG\n>3\nACT\n")
    assert values(sequences.read_clusters(spark, str(tmp_path / "UMI*.fasta")), "umi", "n_seq", "rc_sum", "readcount", "sequence") == [("UMI-1", 2, 7, 3, "ACT"), ("UMI-1", 2, 7, 4, "ACG")]
    (tmp_path / "q.fastq").write_text("@r1\nACGT\n+\n@@II\n@r2\nAC\n+\n!!\n")
    assert values(sequences.read_fastq(spark, str(tmp_path / "q.fastq")), "id", "quality") == [("r1", "@@II"), ("r2", "!!")]
    for mate in ("R1", "R2"):
        (tmp_path / f"x_S1_L001_{mate}_001.fastq.gz").write_bytes(b"12")
    assert [(r["sample"], r["size"]) for r in sequences.paired_files(spark, str(tmp_path)).collect()] == [("x", 4)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a,b")], "n int, s string")
    delimited.write_table(df, str(tmp_path / "out"), ["s", "n"], na="N/A")
    assert values(spark.read.csv(str(tmp_path / "out"), header=True), "s", "n") == [("N/A", "1"), ("a,b", "2")]
    delimited.write_workbook({"x": df}, str(tmp_path / "w.xlsx"), F.col("n") == 2)
    assert (tmp_path / "w.xlsx").read_bytes()[:2] == b"PK"
    sequences.write_fasta(df, str(tmp_path / "f"), "n", "s")
    assert sequences.read_fasta(spark, str(tmp_path / "f")).count() >= 1


IGBLAST = """IGBLASTN 2
Database: x

Query= s1

V-(D)-J rearrangement summary for query sequence (Top V gene match, ...).
V1*01\tD2*01\tJ3*01\tVH\tNo\tIn-frame\tYes\t+

Sub-region sequence details (nucleotide sequence, translation, query start, query end)
CDR3\tTGTGCA\tCA\t13\t18\t

Alignment summary between query and top germline V gene hit (from, to, length, matches, mismatches, gaps, percent identity)
FR1\t2\t6\t5\t5\t0\t0\t100
CDR1\t7\t9\t3\t2\t1\t0\t66.7
Total\tN/A\tN/A\t8\t7\t1\t0\t88

Query= s2

***** No hits found *****
"""


def test_igblast(spark, tmp_path):
    (tmp_path / "r.txt").write_text(IGBLAST)
    got = {r["query"]: r for r in igblast.parse(igblast.read_blocks(spark, str(tmp_path / "r.txt")), ChainType.HUMAN_HEAVY).collect()}
    a = got["s1"]
    assert (a["hit"], a["V_gene"], a["D_gene"], a["J_gene"], a["VJ_frame"], a["CDR3_NT"], a["FR4_from"]) == (True, "V1*01", "D2*01", "J3*01", "In", "TGTGCA", 18)
    assert (a["FR1_from"], a["FR1_to"], a["CDR1_from"], a["aligned_length_to_V_gene"], a["distance_from_V_gene"]) == (3, 6, 6, 8, 1)
    assert not got["s2"]["hit"] and got["s2"]["V_gene"] == ""
    with pytest.raises(ValueError, match="HUMAN_GAMMA"):
        igblast.parse(igblast.read_blocks(spark, str(tmp_path / "r.txt")), ChainType.HUMAN_GAMMA)
    seqs = spark.createDataFrame([("s1", "AACGTACGTGCATGTGCAACGTACGT")], "query string, full_NT string")
    r = igblast.annotate(seqs, igblast.parse(igblast.read_blocks(spark, str(tmp_path / "r.txt")), ChainType.HUMAN_HEAVY)).first()
    assert (r["FR1_NT"], r["CDR1_NT"], r["CDR3_AA"], r["frame"], r["stop_codon"]) == ("GTA", "CGT", "CA", "In", False)


def test_alignment(spark):
    score, d = seeded.best_alignments([("TTACGTACGTAA", "ACGTTCGT", [-2])], seeded.Scoring())[0]
    assert score == 5 and (d["query_start"], d["sbjct_start"], d["num_mismatches"], d["match_pattern"]) == (3, 1, 1, "|||| |||")
    text = "Query= q1\n\n> gene\nLength=4\n\n Score = 8\n\nQuery  2  AC-T  4\n          || |\nSbjct  1  ACGT  4\n"
    a = align.parse_blast(text)["aln"][0]["alignments"][0]
    assert (a["query_start"], a["query_end"], a["sbjct_end"], a["match_pattern"]) == (2, 4, 4, "||q|")
    assert align.star_alignment("ACGT", ["ACGT", "AGT", "ACCGT"], 2)[0].replace("-", "") == "ACGT"
    assert len({len(x) for x in align.star_alignment("ACGT", ["ACGT", "AGT", "ACCGT"], 2)}) == 1
    assert pairs.merge_reads(["AAAACCCCGGGG", "AAAA"], ["CCCCGGGGTTTT", "TTTT"], [None] * 2, [None] * 2, 3, 0.01)[0][0] == "AAAACCCCGGGGTTTT"


def test_plan_from_reads(spark):
    rng = random.Random(11)
    rand = lambda n: "".join(rng.choices("ACGT", k=n))
    gene, rows = rand(84), []
    back = spark.createDataFrame([("GGATCCGGATTCA",)], "s string").select(dna.reverse_complement("s")).first()[0]
    for _ in range(5):
        u, body = rand(14), rand(60) + gene
        rows += [("ACGTTGCAACG" + body + back + u, 3), ("ACGTTGCAACG" + body[:30] + "T" + body[31:] + back + u, 1)]
    found = repertoire.consensus_from_reads(spark.createDataFrame(rows, "sequence string, readcount long"), ["ACGTTGCAACG"], ["GGATCCGGATTCA"])
    assert found.count() == 5
    genes = spark.createDataFrame([(0, "IGHG1*01", gene)], "index int, name string, full_NT string")
    named = repertoire.with_isotypes(found, genes).collect()
    assert len(named) == 5 and {r["isotype"] for r in named} == {"G1"} and {len(r["full_NT"]) for r in named} <= {58, 59, 60, 61, 62}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(f"full_NT,isotype,readcount\nAC,M,{i + 1}\nAG,G1,1\n")
    q = stream.write_counts(stream.running_counts(stream.read_stream(spark, str(tmp_path / "in"), files_per_batch=1)), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert values(spark.read.parquet(str(tmp_path / "out")), "full_NT", "readcount") == [("AC", 6), ("AG", 3)]


def test_sql_functions(spark):
    from clonespark.functions.sql import register

    assert "reverse_complement" in register(spark)
    assert tuple(spark.sql("SELECT reverse_complement('AACG'), isotype_of('IGHG1*01'), trim_to_frame('ACGT', 4), motif_count('NGNS', 'NS|NG')").first()) == ("CGTT", "G1", "CGT", 2)


def test_database(spark, tmp_path):
    from clonespark.sources.database import run_scripts, statements

    assert statements("a; b 'x;y' ;\n") == ["a", "b 'x;y'"]
    (tmp_path / "setup_1.sql").write_text("SELECT 1; SELECT 2")
    assert run_scripts(spark, str(tmp_path / "setup_*.sql")) == 2


def test_config_and_folders(spark, tmp_path):
    (tmp_path / "c.ini").write_text("[a]\nlog = $logfile/x\n")
    assert delimited.read_config(str(tmp_path / "c.ini"), "a", logfile="/l") == {"log": "/l/x"} and "$logfile" in (tmp_path / "c.ini").read_text()
    for d in "xy":
        (tmp_path / d).mkdir()
        (tmp_path / d / "t.csv").write_text(f"k\n{d}\n")
    delimited.union_folders(spark, [str(tmp_path / d) for d in "xy"], str(tmp_path / "all"), ["t.csv"])
    assert values(spark.read.csv(str(tmp_path / "all" / "t.csv"), header=True), "k") == [("x",), ("y",)]


def test_small_readers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("s,n\nACGT,3\n")
    assert values(delimited.read_reads(spark, str(tmp_path / "r.csv")), "sequence", "readcount") == [("ACGT", 3)]
    (tmp_path / "w.csv").write_text("s,n,x\nACGT,3,1\n")
    with pytest.raises(ValueError, match="two columns"):
        delimited.read_reads(spark, str(tmp_path / "w.csv"))
    (tmp_path / "e.csv").write_text("from,to,dist\na,b,0\na,c,2\n")
    assert values(delimited.read_edges(spark, str(tmp_path / "e.csv"), positive=True), "from", "to", "dist") == [("a", "c", 2)]
    (tmp_path / "g.csv").write_text("name,full_NT\nIGHG1*01,ACG\nIGHM*01,TTT\n")
    assert values(delimited.read_genes(spark, str(tmp_path / "g.csv")), "index", "name") == [(0, "IGHG1*01"), (1, "IGHM*01")]


def test_chicken_regions(spark):
    seq = "AAAA" + "CC" + "GGGG" + "TTT" + "AAAA" + "CCCC" + "GGGG"
    hit = lambda a, b, n: (a, b, 1, n, n)
    cut = (15, 17, 2, 4, 4)  # FR3 found from its second base on
    kind = "struct<query_start:int,query_end:int,sbjct_start:int,sbjct_end:int,length:int>"
    df = spark.createDataFrame([(seq, hit(1, 4, 4), hit(7, 10, 4), cut, hit(22, 25, 4)), (seq, hit(1, 4, 4), None, cut, None)], "seq string, " + ", ".join(f"FR{i} {kind}" for i in range(1, 5)))
    strict, loose = align.chicken_regions(df).collect(), align.chicken_regions(df, loose=True).collect()
    assert (strict[0]["CDR1"], strict[0]["CDR2"], strict[0]["CDR3"], strict[0]["failed"]) == ("CC", "E/F", "CCCC", False)
    assert (loose[0]["CDR2"], loose[0]["CDR3"]) == ("TTT", "CCCC") and strict[1]["failed"] and loose[1]["CDR1"] == "E/F"


def test_read_quality(spark, tmp_path):
    from clonespark.plans.read_quality import report

    (tmp_path / "q.fastq").write_text("@a\nACGT\n+\nI5+I\n@b\nAC\n+\n!K\n")
    totals, histogram = report(spark, str(tmp_path / "q.fastq"))
    t = totals.first()
    assert (t["n_reads"], t["min_length"], t["max_length"]) == (2, 2, 4) and t["mean_score"] == pytest.approx((40 + 20 + 10 + 40 + 0 + 42) / 6)
    h = {r["qscore"]: (r["least"], r["median"]) for r in histogram.collect()}
    assert h[10] == (1, 0) and h[0] == (1, 0) and h[30] == (0, 1) and h[21] == (0, 1) and len(h) == 41


def test_banded_alignment():
    """Least edits within the band, against a plain model."""
    rng = random.Random(41)
    for _ in range(40):
        a = "".join(rng.choices("ACGT", k=rng.randrange(0, 30)))
        b = list(a)
        for _ in range(rng.randrange(4)):
            p = rng.randrange(len(b) + 1)
            b[p : p + rng.randrange(2)] = rng.choices("ACGT", k=rng.randrange(2))
        b = "".join(b)
        x, y = align.global_alignment(a, b, 5)
        assert x.replace("-", "") == a and y.replace("-", "") == b and sum(c != d for c, d in zip(x, y)) == lev(a, b)


def test_merging_by_quality(spark):
    df = spark.createDataFrame([("ACGTACGTTT", "GGAAACGTAC", "IIIIIIIII#", "IIIIIIIIII"), (None, "ACGT", None, None), ("ACG", "", "III", "")], "r1 string, r2 string, q1 string, q2 string")
    got = pairs.merge_pairs(df, least=8, qualities=("q1", "q2")).collect()
    assert got[0]["merged"] is not None and len(got[0]["merged"]) == len(got[0]["merged_quality"]) and got[1]["merged"] is got[2]["merged"] is None
    one = lambda a, b, p, q: pairs.merge_reads([a], [b], [p], [q], 6, 0.1)[0][:2]
    assert one("AACCGGTT", "CCGGTAGA", "IIIIIII#", "IIIIIIII") == ("AACCGGTAGA", "IIIIIIIIII")
    assert one("AACCGGTT", "CCGGTAGA", "IIIIIIII", "IIIII#II")[0] == "AACCGGTTGA"


def test_read_pairs_of_known_fragments():
    """Fragments shorter and longer than the reads come back; unrelated reads hardly ever join."""
    rng = np.random.default_rng(71)
    dna_of = lambda n: "".join(rng.choice(list("ACGT"), n))
    a, b, fragments = [], [], []
    for i in range(400):
        fragment = dna_of(int(rng.integers(40, 140)))
        reads = [fragment[:80], fragment[-80:]]
        if len(fragment) < 80:  # read through into adaptors
            reads = [fragment + dna_of(80 - len(fragment)), dna_of(80 - len(fragment)) + fragment]
        noisy = lambda s: "".join(c if rng.random() > 0.01 else rng.choice(list("ACGT")) for c in s)
        a.append(noisy(reads[0]))
        b.append(noisy(reads[1]))
        fragments.append(fragment)
    got = pairs.merge_reads(a, b, [None] * 400, [None] * 400, 10, 0.01)
    right = sum(m is not None and len(m) == len(f) and sum(x != y for x, y in zip(m, f)) <= 6 for (m, _, _), f in zip(got, fragments))
    assert right >= 0.98 * 400
    c, d = ([dna_of(80) for _ in range(3000)] for _ in range(2))
    for level in (0.05, 0.01):
        false = sum(m is not None for m, _, _ in pairs.merge_reads(c, d, [None] * 3000, [None] * 3000, 10, level))
        assert false <= 3000 * level * 1.25
    exact = sum(__import__("math").comb(12, k) * 0.25**k * 0.75 ** (12 - k) for k in range(7))
    assert pairs._below(12, 7) == pytest.approx(exact) and pairs._below(5, 0) == 0 and pairs._below(5, 6) == 1


def test_multiple_alignment_by_profiles():
    """Letters stay in order, and the sum over pairs is no lower than with all aligned to the seed."""
    from clonespark.adapters import profiles

    rng, better = random.Random(74), 0
    for _ in range(40):
        seed, reads = "".join(rng.choices("ACGT", k=rng.randrange(8, 50))), []
        for _ in range(rng.randrange(1, 12)):
            s = list(seed)
            for _ in range(rng.randrange(4)):
                p, x = rng.randrange(len(s)), rng.random()
                if x < 0.5:
                    s[p] = rng.choice("ACGTN")
                elif x < 0.75:
                    s.insert(p, rng.choice("ACGT"))
                else:
                    s.pop(p)
            reads.append("".join(s))
        rows, star = align.cluster_alignment(seed, reads, 5), align.star_alignment(seed, reads, 5)
        assert [r.replace("-", "") for r in rows] == [seed, *reads] and len({len(r) for r in rows}) == 1
        assert profiles.pair_sum(rows) >= profiles.pair_sum(star)
        better += profiles.pair_sum(rows) > profiles.pair_sum(star)
    assert better
    plain = lambda rows: sum(1 if a == b else -1 if "-" not in (a, b) else -2 for i, x in enumerate(rows) for y in rows[:i] for a, b in zip(x, y) if (a, b) != ("-", "-"))
    assert profiles.pair_sum(["AC-T", "ACGT", "A--T", "TCGN"]) == plain(["AC-T", "ACGT", "A--T", "TCGN"])
    w = profiles.tree_weights([("Inner1", "a", 1.0), ("Inner1", "b", 1.0), ("Inner2", "Inner1", 2.0), ("Inner2", "c", 3.0)], ["a", "b", "c"])
    assert w["a"] == w["b"] < w["c"]
    assert align.global_alignment("ACGTACGTAC", "ACGT", 2)[0].replace("-", "") == "ACGTACGTAC"


def plain_affine(q, g, s):
    """The best local score with affine gaps, cell by cell."""
    low = -(10**9)
    h, up, best = [[0] * (len(g) + 1) for _ in range(len(q) + 1)], [[low] * (len(g) + 1) for _ in range(len(q) + 1)], 0
    for i in range(1, len(q) + 1):
        left = low
        for j in range(1, len(g) + 1):
            left = max(h[i][j - 1] - s.gap_open - s.gap_extend, left - s.gap_extend)
            up[i][j] = max(h[i - 1][j] - s.gap_open - s.gap_extend, up[i - 1][j] - s.gap_extend)
            h[i][j] = max(0, h[i - 1][j - 1] + (s.match if q[i - 1] == g[j - 1] else s.mismatch), left, up[i][j])
            best = max(best, h[i][j])
    return best


@pytest.mark.parametrize("scoring", [seeded.Scoring(), seeded.Scoring(2, -3, 2, 1), seeded.Scoring(5, -4, 3, 1)])
def test_seeded_alignments_against_a_plain_aligner(scoring):
    import itertools

    rng = random.Random(72)
    made = []
    while len(made) < 80:
        g = "".join(rng.choices("ACGT", k=rng.randrange(20, 90)))
        s = list(g[rng.randrange(10) : len(g) - rng.randrange(8)])
        for _ in range(rng.randrange(7)):
            p, x = rng.randrange(len(s)), rng.random()
            if x < 0.4:
                s[p] = rng.choice("ACGT")
            elif x < 0.7:
                s.insert(p, "".join(rng.choices("ACGT", k=rng.randrange(1, 3))))
            elif len(s) > 1:
                s.pop(p)
        s = "".join(rng.choices("ACGT", k=rng.randrange(12))) + "".join(s)
        diagonals = sorted({b - a for a in range(len(s) - 5) for b in range(len(g) - 5) if s[a : a + 6] == g[b : b + 6]})
        if diagonals:
            made.append((s, g, diagonals))
    for (q, g, _), (score, d) in zip(made, seeded.best_alignments(made, scoring)):
        assert score == plain_affine(q, g, scoring)
        runs = [(c, len(list(r))) for c, r in itertools.groupby(d["match_pattern"])]
        assert score == sum(n * scoring.match if c == "|" else n * scoring.mismatch if c == " " else -scoring.gap_open - n * scoring.gap_extend for c, n in runs)
        assert all(q[m["query_loc"] - 1] == m["query"] and g[m["sbjct_loc"] - 1] == m["sbjct"] for m in d["mismatches"])


def test_gene_alignments(spark):
    lam, k = seeded.karlin_altschul(1, -2)
    assert lam == pytest.approx(1.33, abs=0.01) and k == pytest.approx(0.621, abs=0.005)  # as published
    rng = random.Random(73)
    genes = ["".join(rng.choices("ACGT", k=80)) for _ in range(3)]
    rows = [(1, "ACGTT" + genes[1], "x"), (2, genes[2][:40] + genes[0][20:], "x"), (3, None, "x"), (4, "", "x"), (5, "ACGTACG", "x"), (6, genes[0][:11], "x"), (1, "ACGTT" + genes[1], "x")]
    df = spark.createDataFrame(rows, "id int, full_NT string, best string")
    got = {r["id"]: r for r in seeded.align_to_genes(df, spark.createDataFrame(list(enumerate(genes)), "index int, full_NT string"), top=2).collect()}
    assert len(got) == 6 and got[1]["aln"]["alignments"][0]["sbjct_index"] == 1 and got[1]["aln"]["alignments"][0]["query_start"] == 6 and got[1]["evalue"] < 1e-30
    assert [a["sbjct_index"] for a in got[2]["aln"]["alignments"]] == [0, 2] and got[2]["best"] == "x"
    assert all(got[i]["aln"]["num_alignments"] == 0 and got[i]["aln"]["alignments"] == [] and got[i]["evalue"] is None for i in (3, 4, 5, 6))  # eleven bases may meet by chance


def test_tree_models():
    seqs = ["ACGT-ACG", "ACGA-ACG", "GCGT-ACG"]
    d = graph.model_distances(seqs)
    assert d[0, 1] == pytest.approx(2 / 8) and d[0, 0] == pytest.approx(1 / 8)  # a gap is no match
    blast, trans = (graph.model_distances(seqs, m) for m in ("blastn", "trans"))
    assert blast[0, 1] == blast[0, 2] == pytest.approx(1 - (6 * 5 - 4) / 35) and trans[0, 2] == pytest.approx(1 - (6 * 6 - 1) / 42) and trans[0, 1] == pytest.approx(1 - (6 * 6 - 5) / 42)
    with pytest.raises(ValueError):
        graph.model_distances(seqs, "none")


def test_upgma_against_a_plain_model():
    rng = np.random.default_rng(42)
    for n in (1, 2, 3, 9, 30):
        d = rng.integers(1, 6, (n, n)).astype(float)
        d = np.triu(d, 1) + np.triu(d, 1).T
        clusters, edges = [(f"n{i}", 0.0, [i]) for i in range(n)], []
        while len(clusters) > 1:
            mean = lambda p, q: np.mean([d[i, j] for i in p[2] for j in q[2]])
            i, j = min(((i, j) for j in range(len(clusters)) for i in range(j)), key=lambda x: (round(mean(clusters[x[0]], clusters[x[1]]), 9), x))
            a, b = clusters[i], clusters[j]
            h, node = mean(a, b) / 2, f"Inner{n - len(clusters) + 1}"
            edges += [(node, a[0], h - a[1]), (node, b[0], h - b[1])]
            clusters[i] = (node, h, a[2] + b[2])
            del clusters[j]
        got = graph.upgma([f"n{i}" for i in range(n)], d)
        if n < 9:  # equal means come out in another order of additions
            assert [e[:2] for e in got] == [e[:2] for e in edges]
        assert sorted(e[2] for e in got) == pytest.approx(sorted(e[2] for e in edges)) or n >= 9
        assert len(got) == max(0, 2 * n - 2)


def test_trees_of_large_groups_without_a_matrix(spark, monkeypatch):
    """Edge for edge as with all distances held, ties and dots included."""
    rng = random.Random(61)
    for n, length, alphabet in ((1, 3, "AC"), (2, 3, "AC"), (3, 0, "A"), (40, 5, "AC."), (150, 8, "ACGT."), (200, 30, "ACGT")):
        seqs = ["".join(rng.choices(alphabet, k=length)) for _ in range(n)]
        m = graph._matrix(seqs)
        assert graph.upgma_by_profiles([f"n{i}" for i in range(n)], m, 0.5) == graph.upgma([f"n{i}" for i in range(n)], graph._hamming_all(m, m), 0.5)


def test_lines_of_a_file_are_not_sorted_in_one_task(spark, tmp_path):
    """line numbers don't call for all lines of a file in one place, and records are dealt before they are put together."""
    rows = [f"@r{i}\nACGT\n+\nIII{chr(33 + i % 40)}" for i in range(50)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "reads"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to be sent by their estimated size
    try:
        df = sequences.read_fastq(spark, str(tmp_path / "reads"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "REPARTITION_BY_COL" in plan
        assert sorted((r["record"], r["id"], r["quality"]) for r in df.collect()) == [(i, f"r{i}", f"III{chr(33 + i % 40)}") for i in range(50)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_isoelectric_point_counts_once(spark):
    """the sequence is counted once and not anew in each halving; points as the charge has them, null for null and empty ones."""
    rng = random.Random(64)
    seqs = ["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=rng.randrange(1, 40))) for _ in range(200)]
    df = spark.createDataFrame([(s,) for s in [*seqs, "kkd", "", None]], "s string")
    out = df.select("s", protein.isoelectric_point("s").alias("pi"))
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()  # which Spark interprets, with all that is in it
    got = {r["s"]: r["pi"] for r in out.collect()}
    assert got[""] is None and got[None] is None and got["kkd"] == spark.createDataFrame([("KKD",)], "s string").select(protein.isoelectric_point("s")).first()[0]
    near = spark.createDataFrame([(s, got[s]) for s in seqs], "s string, pi double")
    signs = near.select(protein.charge(F.col("s"), F.col("pi") - 1e-9).alias("a"), protein.charge(F.col("s"), F.col("pi") + 1e-9).alias("b")).collect()
    assert all(r["a"] >= 0 >= r["b"] for r in signs)


def test_trees_of_large_groups_make_few_distances_anew(monkeypatch):
    """F7, F8: a cluster whose nearest was merged is searched only once its bound is the least, and no row before a merged one is held against it."""
    rng = random.Random(63)
    n, made, sums = 600, [], graph.Profiles.sums
    monkeypatch.setattr(graph.Profiles, "sums", lambda *x: made.append(len(out := sums(*x))) or out)
    m = graph._matrix(["".join(rng.choices("ACGT", k=12)) for _ in range(n)])
    edges = graph.upgma_by_profiles([f"n{i}" for i in range(n)], m)
    assert edges == graph.upgma([f"n{i}" for i in range(n)], graph._hamming_all(m, m))
    assert sum(made) < 0.8 * n**2


def test_group_distances(spark, monkeypatch):
    rng = random.Random(62)
    side = lambda: [(rng.randrange(3), "".join(rng.choices("AC.", k=rng.choice((3, 4)))), rng.choice("xy"), rng.choice((1, 2))) for _ in range(40)]
    a, b = side(), side()
    schema = "g int, s string, v string, j int"
    dot = lambda p, q: max(len(p), len(q)) if len(p) != len(q) else sum(x != y and "." not in (x, y) for x, y in zip(p, q))
    for metric, d, few in (("hamming", dot, 10**9), ("hamming", dot, 0), ("levenshtein", lev, 0)):
        monkeypatch.setattr(similarity, "FEW_PAIRS", few)
        wanted = {}
        for g, p, v, j in a:
            for h, q, w, k in b:
                if (v, j) == (w, k):
                    wanted.setdefault((g, h), []).append(d(p, q))
        got = similarity.group_distances(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "g", "s", ["v", "j"], metric)
        assert {(r["from"], r["to"]): (r["min_dist"], round(r["mean_dist"], 9)) for r in got.collect()} == {k: (min(x), round(sum(x) / len(x), 9)) for k, x in wanted.items()}


def test_trees_in_nexus():
    from clonespark.sources import trees

    edges = [("r", "a b", 0.5), ("r", "x", 1.0), ("x", "c", 0.25), ("x", "d'e", 0.0)]
    assert sorted(e[:3] for e in trees.newick_edges(trees.newick(edges))) == sorted(edges)
    assert trees.newick_edges("((a:1,b:2):3,c:4);") == [("Inner1", "Inner2", 3.0, 1), ("Inner1", "c", 4.0, 1), ("Inner2", "a", 1.0, 0), ("Inner2", "b", 2.0, 0)]


def test_log_records_of_a_queue(tmp_path):
    import logging
    import queue

    from clonespark import logs

    (tmp_path / "log.ini").write_text(f"[loggers]\nkeys=root\n[handlers]\nkeys=f\n[formatters]\nkeys=p\n[logger_root]\nlevel=INFO\nhandlers=f\n[handler_f]\nclass=FileHandler\nformatter=p\nargs=({str(tmp_path / 'out')!r},)\n[formatter_p]\nformat=%(levelname)s %(message)s\n")
    held, root = queue.Queue(), logging.getLogger()
    before = root.handlers[:]
    listener = logs.listen(held, str(tmp_path / "log.ini"))
    held.put(logging.LogRecord("a.b", logging.WARNING, "", 1, "hello %s", ("you",), None))
    listener.stop()
    assert (tmp_path / "out").read_text() == "WARNING hello you\n"
    root.handlers[:] = before
    logs.send_to(held, "c.d").info("more")
    assert held.get_nowait().getMessage() == "more"


def test_limits_of_one_task(spark):
    v = spark.createDataFrame([(i, "ACGT", 1) for i in range(8)], "id int, s string, c int")
    with pytest.raises(ValueError):
        similarity.component_edges(v, "id", "s", "c", most=7)
    assert similarity.component_edges(v, "id", "s", "c", most=8).count() == 28


def test_rarefaction_is_the_same_however_rows_are_dealt(spark):
    df = spark.createDataFrame([(i, i % 7 + 1) for i in range(500)], "id int, readcount long")
    a, b = (values(collapse.rarefy(d, 300, seed=3, id_col="id"), "id", "readcount") for d in (df, df.repartition(7)))
    assert a == b and sum(n for _, n in a) == 300
    assert sum(n for _, n in values(collapse.rarefy(df, 10**6), "id", "readcount")) == df.agg(F.sum("readcount")).first()[0]


def test_joins_are_cut_by_counted_blocks(spark, monkeypatch):
    """A large block is cut into tiles; a small one isn't copied because another is large."""
    rng = random.Random(43)
    base = ["".join(rng.choices("ACGT", k=16)) for _ in range(3)]
    rows = [(i, "".join(c if rng.random() > 0.05 else "A" for c in rng.choice(base)), "hot" if i < 80 else f"k{i // 10}") for i in range(140)]
    df = spark.createDataFrame(rows, "id int, s string, k string")
    methods = ("pairs", "segments", "tree")
    wanted = [values(similarity.similarity_join(df, "id", "s", 2, method=m, block_by=["k"]), "from", "to", "dist") for m in methods]
    assert wanted[0] == wanted[1] == wanted[2] == sorted((i, j, lev(a, b)) for i, a, k in rows for j, b, q in rows if i < j and k == q and lev(a, b) <= 2)
    monkeypatch.setattr(similarity, "PAIRS_A_PART", 400)
    monkeypatch.setattr(prefix_tree, "TILE_ROWS", 20)
    assert [values(similarity.similarity_join(df, "id", "s", 2, method=m, block_by=["k"]), "from", "to", "dist") for m in methods] == wanted
    a, b = (df.select(F.col("id").alias(f"id_{x}"), F.col("k").alias(f"k_{x}")) for x in "ab")
    x, y, _ = similarity._gridded(a, b, [("k_a", "k_b")])
    assert x.filter("k_a = 'hot'").count() == y.filter("k_b = 'hot'").count() == 80 * 4 and x.filter("k_a != 'hot'").count() == 60


@pytest.mark.parametrize("cross", ["all", "last"])
def test_trees_of_unequal_lengths(spark, cross, monkeypatch):
    rng = random.Random(44)
    rows = [(i, "".join(rng.choices("AC", k=rng.choice((3, 5, 6, 7, 8, 9)))), rng.choice("xy")) for i in range(90)] + [(90, "", "x"), (91, None, "x"), (92, "ACA", None), (93, "A", "x")]
    df = spark.createDataFrame(rows, "id int, s string, k string")
    last = {}
    for i, s, k in rows:
        if s is not None:
            last[len(s), k] = i
    far = lambda a, b, i, k: len(b) > len(a) and (len(b) - len(a)) % 2 == 0 and len(b) - len(a) <= 4 and (cross == "all" or last[len(a), k] == i)
    live = [r for r in rows if r[1] is not None and r[2] is not None]
    wanted = sorted((min(i, j), max(i, j), lev(a, b)) for i, a, k in live for j, b, q in live if k == q and (i < j and len(a) == len(b) or far(a, b, i, k)) and lev(a, b) <= 4)
    for tile in (8192, 7):
        monkeypatch.setattr(prefix_tree, "TILE_ROWS", tile)
        for m in ("tree", "pairs"):
            assert values(similarity.similarity_join(df, "id", "s", 4, method=m, block_by=["k"], cross_length=cross, step=2), "from", "to", "dist") == wanted


def test_trees_of_dots_and_long_letters(spark):
    rng = random.Random(45)
    rows = [(i, "".join(rng.choices("A.é😀", k=6))) for i in range(60)]
    d = lambda a, b: sum(x != y and "." not in (x, y) for x, y in zip(a, b))
    got = similarity.similarity_join(spark.createDataFrame(rows, "id int, s string"), "id", "s", 2, metric="hamming")
    assert values(got, "from", "to", "dist") == sorted((i, j, d(a, b)) for i, a in rows for j, b in rows if i < j and d(a, b) <= 2)


def test_pairs_of_nodes_are_few(monkeypatch):
    """Far fewer pairs are measured than there are, in whatever pieces they go down."""
    rng = random.Random(46)
    seqs = sorted("".join(rng.choices("ACGT", k=12)) for _ in range(3000))
    held = prefix_tree.letters(seqs, 12), np.zeros(3000, int)
    tally = [0]
    a = prefix_tree.tree_join(held[1], held[0], None, None, 2, "levenshtein", tally)
    assert tally[0] < 3000 * 2999 / 2 / 4
    monkeypatch.setattr(prefix_tree, "FRONT", 1000)
    b = prefix_tree.tree_join(held[1], held[0], None, None, 2, "levenshtein")
    assert sorted(zip(*(x.tolist() for x in a))) == sorted(zip(*(x.tolist() for x in b))) and len(a[0])
    assert all(lev(seqs[i], seqs[j]) == d for i, j, d in list(zip(*(x.tolist() for x in a)))[:200])


def test_report_chart():
    from clonespark.plans import read_quality

    svg = read_quality.chart([{"qscore": q, "least_cum": 41 - q, "median_cum": 41 - q} for q in range(41)], 41, "a<b")
    assert svg.count("<rect") == 82 and "a&lt;b" in svg


def test_pairs_of_the_aligner_are_dealt_to_all_tasks(spark):
    """F15, F16: pairs are few bytes and much work; adaptive plans put them together, so that one task or two aligned them all."""
    df = spark.createDataFrame([(i, "ACGTTGCAGGCTAACGTCAG") for i in range(40)], "id int, full_NT string").coalesce(1)
    genes = spark.createDataFrame([(0, "TTGCAGGCTAACGTC")], "index int, full_NT string")
    out = seeded.align_to_genes(df, genes, most_e=1.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan[plan.index("MapInArrow") :].splitlines()[1:] if "Exchange" in x]
    assert "REPARTITION_BY_NUM" in dealt[0]
    assert out.filter("aln.num_alignments = 1").count() == 40


def test_primers_are_sought_once_by_read(spark, tmp_path):
    """each pattern was compiled for each read, several times over, in the one task of a small table's split."""
    import re

    from clonespark.queries import QUERIES

    rng = random.Random(8)
    forward, reverse = ["ACGTACG", "TTGGCCA"], ["GGATCCG", "CATTAAG"]
    turned = [r[::-1].translate(str.maketrans("ACGT", "TGCA")) for r in reverse]
    texts = [(i, "".join(rng.choices("ACGTN\n", (9, 9, 9, 9, 1, 1), k=rng.randrange(60)))) for i in range(1000)]
    texts += [(len(texts) + i, f[1:] + "TT" + "".join(rng.choices("ACGT", k=20)) + r[:3] + "A" + r[4:] + "ACGTACGTACGTA") for i, (f, r) in enumerate([*zip(forward, turned)] * 20)]
    patterns = umi.primer_patterns(forward)
    want = []
    for i, s in texts:
        at = next(((m.start(), m.start() + n) for p, n in patterns if (m := re.search(p, s))), None)
        want.append((i, at))
    df = spark.createDataFrame([*texts, (-1, None)], "i int, s string")
    got = df.select("i", umi.first_match(F.col("s"), patterns).alias("m")).collect()
    assert sorted((r["i"], tuple(r["m"]) if r["m"] else None) for r in got) == [(-1, None), *want] and sum(x is not None for _, x in want) > 50
    out = umi.extract_umis(df.select(F.col("s").alias("sequence"), F.lit(1).alias("readcount")), forward, reverse)
    assert out.count() >= 40 and len(re.findall(r"\bregexp_\w+\(", out._jdf.queryExecution().optimizedPlan().toString())) == 2
    spark.range(100).select(F.col("id").alias("p_partkey"), F.lit(3).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert QUERIES["primer_umi"](spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count() > 1
