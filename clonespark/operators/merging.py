"""Merging of close components, by absorption in order over a sparse graph.

Only sequences closer than the threshold matter, so a bucket falls apart into the connected parts of the graph of components and their sequences. A part is a
task's work; one with many links goes in rounds of joins.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.operators.collapse import component_reads, size_rank
from clonespark.operators.components import components
from clonespark.operators.similarity import similarity_join
from clonespark.scratch import Scratch

#: Links (of components to their sequences, and between sequences) up to which a part is one task's work.
PART_LINKS = 5_000_000


class Profile:
    """Residues by place of a set of sequences of one length: the mean distance of two sets needs no pair of their members."""

    def __init__(self, seqs: list[str]) -> None:
        self.n, self.at = len(seqs), Counter((p, c) for s in seqs for p, c in enumerate(s))
        self.dots = {p: n for (p, c), n in self.at.items() if c == "."}
        self.length = max(map(len, seqs), default=0)

    def add(self, other: Profile) -> None:
        self.n += other.n
        self.at.update(other.at)
        for p, n in other.dots.items():
            self.dots[p] = self.dots.get(p, 0) + n

    def mean(self, other: Profile) -> float:
        """Mean Hamming distance of all pairs; a dot differs from nothing."""
        alike = sum(n * self.at.get(k, 0) for k, n in other.at.items() if k[1] != ".")
        for p in {*self.dots, *other.dots}:
            x, y = self.dots.get(p, 0), other.dots.get(p, 0)
            alike += x * other.n + y * self.n - x * y
        return self.length - alike / (self.n * other.n)


def absorb(order: list, held: dict, near: dict, threshold: float, linkage: str = "min", text: dict | None = None) -> dict:
    """The reference that each component goes to.

    order: components, by descending reads. The last that is left is the reference. One pass over the rest, in order, takes in each that lies closer than the threshold
    to what the reference has grown to; what was passed over isn't looked at again in this pass. held: each component's sequences;
    near: sequences closer than the threshold to a sequence, but itself; text: sequences' letters, for means.
    """
    place, owners, out = {c: i for i, c in enumerate(order)}, defaultdict(list), {}
    for c in order:
        for s in held[c]:
            owners[s].append(c)
    profiles = {c: Profile([text[s] for s in held[c]]) for c in order} if linkage == "mean" else None
    for ref in reversed(order):
        if ref in out:
            continue
        out[ref], seen, waiting, asked = ref, set(), [], {ref}
        grown = None
        if profiles:
            grown = Profile([])
            grown.length = profiles[ref].length
            grown.add(profiles[ref])

        def reach(c, after: int) -> None:
            """Components with a sequence near one of c's that come later in the pass."""
            for s in held[c]:
                for t in (s, *near.get(s, ())):
                    if t not in seen:
                        seen.add(t)
                        for other in owners[t]:
                            if place[other] > after and other not in out and other not in asked:
                                asked.add(other)
                                heapq.heappush(waiting, place[other])

        reach(ref, -1)
        while waiting:
            at = heapq.heappop(waiting)
            c = order[at]
            if grown is not None and not grown.mean(profiles[c]) < threshold:
                continue
            out[c] = ref
            if grown is not None:
                grown.add(profiles[c])
            reach(c, at)
    return out


def _in_rounds(parts: DataFrame, nodes: DataFrame, members: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, ref) of parts with too many links for a task, by rounds: the last component that each part has left is a reference, and takes in by joins what the pass would.

    A component is taken in once a sequence near one of its own belongs to the reference, or to one taken in that stands before it.
    """
    near = scratch.save(edges.unionAll(edges.select(F.col("t").alias("s"), F.col("s").alias("t"))).unionAll(members.select("s", F.col("s").alias("t"))).distinct())
    left = scratch.save(nodes.join(parts, "part", "left_semi"))
    out = None
    while not left.isEmpty():
        # a part's order: by descending reads, then by first row; the reference is the last
        refs = left.groupBy("part").agg(F.max_by("c", "pos").alias("ref"))
        taken = scratch.save(refs.select("part", "ref", F.col("ref").alias("c"), F.lit(True).alias("is_ref")))
        n = taken.count()
        while True:
            reached = taken.join(left.select("c", "pos"), "c").join(members, "c").join(near, "s").groupBy("part", "ref", "t").agg(F.max("is_ref").alias("any"), F.min("pos").alias("since"))
            more = left.join(members, "c").join(reached.withColumnRenamed("t", "s"), ["part", "s"]).filter(F.col("any") | (F.col("since") < F.col("pos"))).select("part", "ref", "c").distinct()
            new = scratch.save(more.join(refs.select(F.col("ref").alias("c")), "c", "left_anti").select("part", "ref", "c", F.lit(False).alias("is_ref")).unionByName(refs.select("part", "ref", F.col("ref").alias("c"), F.lit(True).alias("is_ref"))))
            before, n = n, new.count()
            taken = new
            if n == before:
                break
        done = taken.select("c", "ref")
        out = done if out is None else out.unionAll(done)
        left = scratch.save(left.join(done, "c", "left_anti"))
    return out


def merge_components(df: DataFrame, order_col: str, threshold: float, counts: list[str], sample: str = "sample", component: str = "component_ID", cdr3: str = "CDR3_AA", v: str = "V_gene", j: str = "J_gene", linkage: str = "min") -> DataFrame:
    """Adds component_ID_merged: components of samples with the same CDR3 length and gene families, merged if close.

    A component's length and genes are those of its first row, and its CDR3s of that length count. Merged components are numbered from 1 by their rows, largest
    first, of equal ones the one whose first row comes first. linkage: the least or the mean distance ("mean") to what a reference has grown to; a mean below the
    threshold needs a pair below it, so both follow the same edges. Edges come from a similarity join of distinct CDR3s. A connected part of them is one task's
    work up to PART_LINKS links; larger ones go in rounds for "min", while for "mean" a part is one task's work whatever its size, with profiles by place in place of its pairs.
    """
    scratch = Scratch(df.sparkSession)
    name = F.concat_ws("|", F.col(sample).cast("string"), F.col(component).cast("string"))
    rows = df.withColumn("_component", name)
    first = rows.groupBy("_component").agg(F.min_by(F.struct(F.length(cdr3).alias("len"), F.substring_index(v, "*", 1).alias("v"), F.substring_index(j, "*", 1).alias("j")), order_col).alias("b"), F.min(order_col).alias("first"))
    reads = component_reads(rows, "_component", counts)
    nodes = scratch.save(first.join(reads, "_component").select(F.col("_component").alias("c"), F.struct((-F.col("reads")).alias("reads"), "first").alias("pos"), F.to_json("b").alias("bucket"), F.coalesce("b.len", F.lit(0)).alias("len")))
    own = rows.select(F.col("_component").alias("c"), F.coalesce(cdr3, F.lit("")).alias("text")).distinct().join(nodes, "c").filter(F.length("text") == F.col("len"))
    members = scratch.save(own.select("c", F.concat_ws("#", "bucket", "text").alias("s"), "text", "bucket"))
    seqs = members.select("s", "text", "bucket").distinct()
    most = math.ceil(threshold) - 1  # distances are whole
    if most < 0:
        merged = nodes.select("c", F.col("c").alias("ref"))
    else:
        dotted = not members.filter(F.col("text").contains(".")).isEmpty()
        found = similarity_join(seqs, "s", "text", most, metric="hamming", block_by=["bucket"], method="tree" if dotted else "auto")
        edges = scratch.save(found.select(F.col("from").alias("s"), F.col("to").alias("t")))
        # components ("c" before their name) and sequences ("s") in one graph
        # a component ties its sequences together; its part is that of the first of them
        firsts = members.groupBy("c").agg(F.min("s").alias("lead"))
        ties = members.join(firsts, "c").filter("s != lead").select(F.col("lead").alias("a"), F.col("s").alias("b"))
        roots = scratch.save(components(ties.unionAll(edges.select(F.col("s").alias("a"), F.col("t").alias("b"))), scratch))
        part_of = lambda df, key: df.join(roots, F.col(key) == roots.node, "left").withColumn("part", F.coalesce("root", key)).drop("node", "root")
        placed = scratch.save(part_of(nodes.join(firsts, "c"), "lead").drop("lead"))
        tied, held = scratch.save(part_of(edges, "s")), scratch.save(part_of(members.select("c", "s", "text"), "s"))
        merged = _merged(placed, held, tied, threshold, linkage, scratch)
    return size_rank(rows.join(merged.select(F.col("c").alias("_component"), F.col("ref").alias("_merged")), "_component"), "_merged", order_col, "component_ID_merged").drop("_component", "_merged")


def _merged(nodes: DataFrame, members: DataFrame, edges: DataFrame, threshold: float, linkage: str, scratch: Scratch) -> DataFrame:
    """(c, ref) of all parts: nodes (c, pos, part), members (c, s, text, part), edges (s, t, part)."""
    alone = nodes.groupBy("part").agg(F.count("*").alias("n"), F.first("c").alias("c")).filter("n = 1")
    sizes = scratch.save(members.groupBy("part").count().unionAll(edges.groupBy("part").count()).groupBy("part").agg(F.sum("count").alias("links")))
    large = scratch.save(sizes.filter(F.col("links") > PART_LINKS).select("part")) if linkage == "min" else None
    apart = large is not None and not large.isEmpty()
    some = lambda df: df.join(alone.select("part"), "part", "left_anti").join(large, "part", "left_anti") if apart else df.join(alone.select("part"), "part", "left_anti")
    string = lambda c=None: (F.col(c) if c else F.lit(None)).cast("string")
    blank = [F.lit(None).cast(f.dataType) for f in nodes.schema["pos"].dataType]
    work = (
        some(nodes).select("part", F.lit(0).alias("kind"), string("c").alias("a"), string().alias("b"), string().alias("text"), "pos.reads", "pos.first")
        .unionAll(some(members).select("part", F.lit(1), "c", "s", "text" if linkage == "mean" else string(), *blank))
        .unionAll(some(edges).select("part", F.lit(2), "s", "t", string(), *blank))
    )

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at, held, near, text = group[group["kind"] == 0].sort_values(["reads", "first"], kind="stable"), defaultdict(list), defaultdict(list), {}
        for kind, a, b, t in zip(group["kind"], group["a"], group["b"], group["text"]):
            if kind == 1:
                held[a].append(b)
                text[b] = t
            elif kind == 2:
                near[a].append(b)
                near[b].append(a)
        out = absorb(at["a"].tolist(), held, near, threshold, linkage, text)
        return pd.DataFrame({"c": list(out), "ref": list(out.values())})

    found = work.groupBy("part").applyInPandas(one, "c string, ref string").unionAll(alone.select("c", F.col("c").alias("ref")))
    if apart:
        mine = lambda df: scratch.save(df.join(large, "part", "left_semi"))
        found = found.unionAll(_in_rounds(large, nodes, mine(members).select("c", "s"), mine(edges).select("s", "t"), scratch))
    return found
