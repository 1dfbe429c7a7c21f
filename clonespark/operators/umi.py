"""UMIs: primers in reads, merging of neighbouring UMIs, sub-clusters, consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonespark.functions.dna import insert_of, reverse_complement, umi_of
from clonespark.operators.similarity import similarity_join
from clonespark.scratch import Scratch

# The default primers.
FORWARD_PRIMERS = [
    "GGCCTCAGTGAAGGTCTCCTGCAAG", "GTCTGGTCCTACGCTGGTGAACCC", "CTGGGGGGTCCCTGAGACTCTCCTG",
    "CTTCGGAGACCCTGTCCCTCACCTG", "CGGGGAGTCTCTGAAGATCTCCTGT", "TCGCAGACCCTCTCACTCACCTGTG",
]
REVERSE_PRIMERS = ["GAAGGAAGTCCTGTGCGAG", "GGGAAGTAGTCCTTGACCA", "GGGGAAGAAGCCCTGGAC", "TGGGTGGTACCCAGTTATCAA", "AAGTAGCCCGTGGCCAGG"]
BASES = "ACGTN"
TAIL, HEAD = 40, 30


def primer_patterns(primers: list[str]) -> list[tuple[str, int]]:
    """Patterns in order of preference, and the length that each matches: all primers as they are, then with one base left out or any."""
    out = [(p, len(p)) for p in primers]
    for p in primers:
        for i in range(len(p)):
            out += [(p[:i] + p[i + 1 :], len(p) - 1), (f"{p[:i]}[ATGC]{p[i + 1:]}", len(p))]
    return out


def first_match(text: Column, patterns: list[tuple[str, int]]) -> Column:
    """(start, end) from 0 of the first pattern of the list that occurs, wherever it does; null if none does.

    One expression tries the patterns in their order, each from the text's first letter on, so a text is gone over once and nothing is compiled by row.
    """
    ordered = "|".join(f"(?<b{i}>.*?)(?<m{i}>{p})" for i, (p, _) in enumerate(patterns))
    matched, before = ("".join(f"${{{side}{i}}}" for i in range(len(patterns))) for side in "mb")
    # the match, a line's end and what stands before the match: a line's end alone if nothing matches
    told = F.regexp_replace(text, F.lit(f"(?s)^(?:{ordered}|.*)(?:.*)$"), F.lit(f"{matched}\n{before}"))
    found = F.transform(F.array(told), lambda x: F.struct((F.length(x) - F.instr(x, "\n")).alias("start"), (F.length(x) - 1).alias("end")))
    return F.get(F.filter(found, lambda x: x["end"] > x["start"]), F.lit(0))


def extract_umis(reads: DataFrame, forward: list[str] | None = None, reverse: list[str] | None = None, seq: str = "sequence", count: str = "readcount") -> DataFrame:
    """umi, full_NT (between the primers) and the count of reads that hold a forward and a reverse primer and a UMI of 13 to 15 bases.

    The reverse primers' complements are sought in the last TAIL bases, the forward ones in the first HEAD. The order of patterns
    decides, not the place.
    """
    spark = reads.sparkSession
    primers = REVERSE_PRIMERS if reverse is None else reverse
    turned = [r[0] for r in spark.createDataFrame([(p, i) for i, p in enumerate(primers)], "p string, i int").orderBy("i").select(reverse_complement("p")).collect()]
    s = F.col(seq)
    tail = F.substring(s, F.greatest(F.length(s) - (TAIL - 1), F.lit(1)), F.lit(TAIL))
    head = F.substring(s, 1, HEAD)
    # a generator's rows are made once, whatever is asked of them after it
    each = lambda match: F.explode(F.filter(F.array(match), lambda x: x.isNotNull()))
    found = reads.withColumn("_r", each(first_match(tail, primer_patterns(turned)))).withColumn("_f", each(first_match(head, primer_patterns(FORWARD_PRIMERS if forward is None else forward))))
    cut = found.select(umi_of(seq, F.col("_r.end"), TAIL).alias("umi"), insert_of(seq, F.col("_f.end"), F.col("_r.start"), TAIL).alias("full_NT"), F.col(count).alias(count))
    return cut.filter(F.length("umi").between(13, 15))


def one_edit_variants(seq: Column) -> Column:
    """The sequence with one base left out, or replaced by another base."""
    places = F.sequence(F.lit(1), F.length(seq))
    before, after = (lambda i: F.substring(seq, F.lit(1), i - 1)), (lambda i: F.substring(seq, i + 1, F.length(seq)))
    shorter = F.transform(places, lambda i: F.concat(before(i), after(i)))
    changed = F.flatten(F.transform(places, lambda i: F.transform(F.array(*map(F.lit, "ATGC")), lambda b: F.concat(before(i), b, after(i)))))
    return F.when(F.length(seq) > 0, F.array_distinct(F.concat(shorter, F.filter(changed, lambda x: x != seq)))).otherwise(F.array().cast("array<string>"))


def greedy_stars(nodes: DataFrame, reach: DataFrame, key: str, priority: list[str], scratch: Scratch) -> DataFrame:
    """What taking nodes by priority, each absorbing all free nodes that it reaches, comes to: (key, seed).

    nodes: key and priority columns (lowest first, together unique); reach: (from, to). Rounds instead of a loop over nodes: a node
    that no undecided node of higher priority reaches is a seed, and what seeds reach is absorbed. Once all seeds are known, each
    absorbed node goes to the first seed that reaches it. Rounds are as many as the longest chain of decisions, and each is a written table.
    """
    order = scratch.save(nodes.select(F.col(key).alias("k"), F.struct(*priority).alias("r")))
    down = reach.join(order.select(F.col("k").alias("from"), F.col("r").alias("fr")), "from").join(order.select(F.col("k").alias("to"), F.col("r").alias("tr")), "to")
    every = scratch.save(down.filter("fr < tr").select("from", "fr", "to"))
    undecided, open_edges, seeds = order.select("k"), every, None
    while True:
        new = scratch.save(undecided.join(open_edges.select(F.col("to").alias("k")).distinct(), "k", "left_anti"))
        absorbed = open_edges.join(new.select(F.col("k").alias("from")), "from", "left_semi").select(F.col("to").alias("k")).distinct()
        seeds = new if seeds is None else seeds.unionAll(new)
        undecided = scratch.save(undecided.join(new.unionAll(absorbed), "k", "left_anti"))
        if undecided.isEmpty():
            break
        open_edges = scratch.save(open_edges.join(undecided.select(F.col("k").alias("from")), "from", "left_semi").join(undecided.select(F.col("k").alias("to")), "to", "left_semi"))
    seeds = scratch.save(seeds)
    taken = every.join(seeds.select(F.col("k").alias("from")), "from", "left_semi").groupBy("to").agg(F.min_by("from", "fr").alias("seed"))
    own = seeds.select(F.col("k").alias(key), F.col("k").alias("seed"))
    return own.unionAll(taken.select(F.col("to").alias(key), "seed").join(own.select(key), key, "left_anti"))


def merge_umis(reads: DataFrame, order_col: str, umi: str = "umi", count: str = "readcount") -> DataFrame:
    """Adds merged_umi: UMIs with most reads first absorb those one edit away, of their length or one shorter.

    Of equal read counts, the UMI seen first in order_col goes first. What is absorbed absorbs nothing. A UMI with other letters than A, C, G, T
    takes part with the same edits.
    """
    scratch = Scratch(reads.sparkSession)
    nodes = scratch.save(reads.groupBy(umi).agg((-F.sum(count)).alias("neg"), F.min(order_col).alias("first")))
    reach = nodes.select(F.col(umi).alias("from"), F.explode(one_edit_variants(F.col(umi))).alias("to")).join(nodes.select(F.col(umi).alias("to")), "to", "left_semi")
    merged = greedy_stars(nodes, reach, umi, ["neg", "first"], scratch).withColumnRenamed("seed", "merged_umi")
    return reads.join(merged, umi)


def umi_summary(reads: DataFrame, umi: str = "merged_umi", count: str = "readcount") -> DataFrame:
    """Sequences and reads of each merged UMI."""
    return reads.groupBy(umi).agg(F.count("*").alias("n_seq"), F.sum(count).alias("rc_sum"))


def fold_clusters(items: Column, threshold: int) -> Column:
    """Of an array of (i, seq) in order of priority: the seeds, each farther than the threshold from all before it."""
    start = F.filter(F.slice(items, 1, 1), lambda _: F.lit(False))
    return F.aggregate(items, start, lambda seeds, x: F.when(F.exists(seeds, lambda s: F.levenshtein(s["seq"], x["seq"]) <= threshold), seeds).otherwise(F.concat(seeds, F.array(x))))


#: A UMI with more reads than this isn't folded in one array: its seeds come from edges, in rounds.
FOLD_ROWS = 5000


def sub_clusters(reads: DataFrame, order_col: str, umi: str = "merged_umi", seq: str = "full_NT", count: str = "readcount", threshold: int = 5) -> DataFrame:
    """Splits each UMI's reads by edit distance to a seed: the read with most copies first, then those left over.

    Adds seed and cluster (from 1 within the UMI; clusters of a single read are dropped and take no number), with their sums n_seq and rc_sum.
    """
    scratch = Scratch(reads.sparkSession)
    many = scratch.save(reads.groupBy(umi).count().filter(F.col("count") > FOLD_ROWS).select(umi))
    placed = _folded(reads.join(many, umi, "left_anti"), order_col, umi, seq, count, threshold)
    if not many.isEmpty():
        placed = placed.unionByName(_starred(reads.join(many, umi, "left_semi"), order_col, umi, seq, count, threshold, scratch))
    sums = placed.groupBy(umi, "seed").agg(F.sum(count).alias("rc_sum"), F.count("*").alias("n_seq"), F.min("_i").alias("_i")).filter("rc_sum > 1")
    numbered = sums.withColumn("cluster", F.row_number().over(Window.partitionBy(umi).orderBy("_i")))
    return placed.drop("_i").join(numbered.drop("_i"), [umi, "seed"])


def _priority(order_col: str, count: str):
    return F.struct((-F.col(count)).alias("neg"), F.col(order_col).alias("row"))


def _folded(reads: DataFrame, order_col: str, umi: str, seq: str, count: str, threshold: int) -> DataFrame:
    """reads with seed and its priority _i, by a fold over each UMI's reads."""
    items = F.array_sort(F.collect_list(F.struct(_priority(order_col, count).alias("i"), F.col(seq).alias("seq"))))
    seeds = reads.groupBy(umi).agg(items.alias("_items")).select(umi, fold_clusters(F.col("_items"), threshold).alias("_seeds"))
    near = F.get(F.filter("_seeds", lambda s: F.levenshtein(s["seq"], F.col(seq)) <= threshold), F.lit(0))
    return reads.join(seeds, umi).withColumn("_at", near).select(*reads.columns, F.col("_at.seq").alias("seed"), F.col("_at.i").alias("_i"))


def _starred(reads: DataFrame, order_col: str, umi: str, seq: str, count: str, threshold: int, scratch: Scratch) -> DataFrame:
    """The same from edges between a UMI's distinct sequences, each with the priority of its first read."""
    nodes = scratch.save(reads.groupBy(umi, seq).agg(F.min(_priority(order_col, count)).alias("i")).withColumn("k", F.struct(umi, seq)))
    edges = similarity_join(nodes.withColumn("id", F.struct(umi, "i")), "k", seq, threshold, order_col="id", block_by=[umi], cross_length="all", step=1)
    both = edges.select("from", "to").unionAll(edges.select(F.col("to").alias("from"), F.col("from").alias("to")))
    stars = greedy_stars(nodes, both, "k", ["i", "k"], scratch)
    seeds = stars.join(nodes.select(F.col("k").alias("seed"), "i"), "seed").select(F.col(f"k.{umi}").alias(umi), F.col(f"k.{seq}").alias(seq), F.col(f"seed.{seq}").alias("seed"), F.col("i").alias("_i"))
    return reads.join(seeds, [umi, seq]).select(*reads.columns, "seed", "_i")


def consensus(aligned: DataFrame, keys: list[str], seq: str = "sequence", count: str = "readcount", threshold: float = 0.6) -> DataFrame:
    """A sequence by vote for each cluster of aligned sequences: the symbol with most reads at each place, X if it has no more than the threshold.

    Ties go to A, G, T, C, - in this order. Gaps are removed at the end. Other symbols are an error.
    """
    letters = aligned.select(*keys, F.col(count).alias("n"), F.posexplode(F.split(F.col(seq), "")).alias("p", "b"))
    counted = letters.groupBy(*keys, "p", "b").agg(F.sum("n").alias("n"))
    checked = counted.withColumn("b", F.when(F.col("b").isin(list("AGTC-")), F.col("b")).otherwise(F.raise_error(F.concat(F.lit("not a base or gap: "), F.col("b")))))
    best = F.max_by("b", F.struct("n", F.expr("-instr('AGTC-', b)")))
    voted = checked.groupBy(*keys, "p").agg(best.alias("b"), F.max("n").alias("most"), F.sum("n").alias("all"))
    voted = voted.withColumn("v", F.when(F.col("most") / F.col("all") > threshold, F.col("b")).otherwise("X"))
    joined = voted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("s"))
    return joined.select(*keys, F.replace(F.array_join(F.transform("s", lambda x: x["v"]), ""), F.lit("-"), F.lit("")).alias("full_NT"))


def consensus_counts(found: DataFrame, seq: str = "full_NT") -> DataFrame:
    """How many clusters gave each consensus; those with an undecided place are left out."""
    return found.filter(~F.col(seq).contains("X")).groupBy(seq).agg(F.count("*").alias("readcount"))
