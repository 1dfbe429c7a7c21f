"""Trees of aligned sequences, and networks' components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.operators.components import components
from clonespark.scratch import Scratch


def _matrix(seqs: list[str]) -> np.ndarray:
    return np.array([[ord(c) for c in s] for s in seqs], np.int32).reshape(len(seqs), -1)


def _hamming_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    dot = ord(".")
    return sum(((a[:, None, k] != b[None, :, k]) & (a[:, None, k] != dot) & (b[None, :, k] != dot)).astype(np.int32) for k in range(a.shape[1])) if a.shape[1] else np.zeros((len(a), len(b)), np.int32)


def upgma(names: list[str], distances: np.ndarray, unit: float = 1.0) -> list[tuple[str, str, float]]:
    """Edges (parent, child, length in units) of the tree that joins the two nearest clusters again and again, means of members' distances between them.

    Of equally near ones, those that come first. Sums of distances are kept, so that means of whole numbers are as exact as one division.
    """
    n = len(names)
    sums = distances.astype(float)
    d = np.where(np.arange(n)[:, None] < np.arange(n), sums, np.inf)  # rows have the distances to later ones
    label, height, size, edges = list(names), np.zeros(n), np.ones(n), []
    nearest = d.argmin(1) if n else np.zeros(0, int)
    least = d[np.arange(n), nearest]
    for k in range(n - 1):
        i = int(least.argmin())
        j = int(nearest[i])
        h, node = d[i, j] / 2, f"Inner{k + 1}"
        edges += [(node, label[i], float(h - height[i]) * unit), (node, label[j], float(h - height[j]) * unit)]
        sums[i] += sums[j]
        sums[:, i] = sums[i]
        label[i], height[i], size[i], size[j] = node, h, size[i] + size[j], np.inf
        d[j], d[:, j] = np.inf, np.inf
        mean = np.where(np.isfinite(size), sums[i] / (size[i] * size), np.inf)
        d[:i, i], d[i, i + 1 :] = mean[:i], mean[i + 1 :]
        # Rows whose nearest was one of the two are searched anew; for the others only the merged one may have come nearer.
        for r in {i, *np.flatnonzero((nearest == i) | (nearest == j)).tolist()}:
            nearest[r] = d[r].argmin()
        nearer = np.flatnonzero((d[:i, i] < least[:i]) | ((d[:i, i] == least[:i]) & (i < nearest[:i])))
        nearest[nearer] = i
        least = d[np.arange(n), nearest]
    return edges


#: Sequences of a group up to which all distances are held; of more, residues by place of each cluster.
MATRIX_ROWS = 2_000
#: Clusters that one is held against at once, and whole numbers up to which single precision is exact.
ABREAST, EXACT = 4_096, 1 << 24


class Profiles:
    """Residues by place of clusters of aligned sequences, from which the mean Hamming distances of one to all follow without any pair of members.

    Only places where rows differ are held: numbers grow with the clusters and these places, not with the pairs of clusters. A dot differs from nothing.
    """

    def __init__(self, m: np.ndarray) -> None:
        varied = (m != m[:1]).any(0) | (m == ord(".")).any(0)
        self.places, places = int(varied.sum()), m[:, varied]
        columns = [(places == c) & (places != ord(".")) for c in np.unique(places) if c != ord(".")]
        self.counts = np.concatenate([c[:, c.any(0)] for c in columns], axis=1).astype(np.float32) if columns else np.zeros((len(m), 0), np.float32)
        dots = places == ord(".")
        self.dots = dots[:, dots.any(0)].astype(np.float32)
        self.all_dots = self.dots.sum(1, dtype=np.float64)
        self.size = np.ones(len(m))

    def sums(self, i: int, to: slice) -> np.ndarray:
        """Sums of the distances between all members of cluster i and all of each of the others: whole numbers."""
        exact = self.places * self.size[i] * self.size[to].max(initial=0) < EXACT
        product = lambda x: x[to] @ x[i] if exact else x[to].astype(np.float64) @ x[i].astype(np.float64)
        alike = product(self.counts).astype(np.float64)
        if self.dots.shape[1]:
            alike += self.all_dots[i] * self.size[to] + self.size[i] * self.all_dots[to] - product(self.dots)
        return self.places * self.size[i] * self.size[to] - alike

    def nearest_later(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, before any are joined, the nearest later one (the first of equally near ones) and how near it is; the last has none."""
        n = len(self.size)
        nearest, least = np.zeros(n, np.int64), np.full(n, np.inf)
        for a in range(0, n - 1, 64):
            rows = slice(a, min(a + 64, n - 1))
            alike = self.counts[rows] @ self.counts[a:].T
            if self.dots.shape[1]:
                alike += (self.all_dots[rows, None] + self.all_dots[a:]).astype(np.float32) - self.dots[rows] @ self.dots[a:].T
            size = len(alike)
            alike[:, :size][np.tri(size, dtype=bool)] = -1
            at = alike.argmax(1)
            nearest[rows], least[rows] = at + a, self.places - alike[np.arange(size), at]
        return nearest, least

    def join(self, i: int, j: int) -> None:
        for x in (self.counts, self.dots, self.all_dots, self.size):
            x[i] += x[j]

    def keep(self, rows: np.ndarray) -> None:
        self.counts, self.dots, self.all_dots, self.size = (x[rows] for x in (self.counts, self.dots, self.all_dots, self.size))


def upgma_by_profiles(names: list[str], m: np.ndarray, unit: float = 1.0) -> list[tuple[str, str, float]]:
    """The tree that upgma makes of the Hamming distances of aligned rows, edge for edge, without their matrix.

    Each cluster keeps its nearest later one and how near. A mean lies between those that it is made of, so that a merged cluster comes nearer to none than its parts were: what a
    cluster keeps remains a bound if its nearest is merged, and a row of distances is made anew, up to the first that meets the bound, only when that bound is the least of all. Rows
    of clusters that are gone are dropped once they are a quarter of all.
    """
    n, held = len(names), Profiles(m)
    label, height, alive, edges = list(names), np.zeros(n), np.ones(n, bool), []
    nearest, least = held.nearest_later()
    bound = np.zeros(n, bool)  # whether least is no more than a bound
    left = n

    def search(r: int) -> None:
        low, near = np.inf, 0
        for a in range(r + 1, len(alive), ABREAST):
            to = slice(a, min(a + ABREAST, len(alive)))
            d = held.sums(r, to) / (held.size[r] * held.size[to])
            d[~alive[to]] = np.inf
            at = int(d.argmin())
            if d[at] < low:
                low, near = d[at], a + at
            if low <= least[r]:
                break
        nearest[r], least[r], bound[r] = near, low, False

    for k in range(n - 1):
        while bound[i := int(least.argmin())]:
            search(i)
        j = int(nearest[i])
        h, node = least[i] / 2, f"Inner{k + 1}"
        edges += [(node, label[i], float(h - height[i]) * unit), (node, label[j], float(h - height[j]) * unit)]
        held.join(i, j)
        label[i], height[i], alive[j], least[j] = node, h, False, np.inf
        bound |= (nearest == i) | (nearest == j)
        bound[i], left = True, left - 1
        if 4 * left < 3 * len(alive) and len(alive) > 64:
            rows = np.flatnonzero(alive)
            new = np.cumsum(alive) - 1
            held.keep(rows)
            nearest, least, bound, height, label = new[nearest[rows]], least[rows], bound[rows], height[rows], [label[r] for r in rows]
            alive = np.ones(len(rows), bool)
    return edges


# Scores of equal and unequal bases by model; those of transitions (A with G, C with T) may differ.
MODELS = {"blastn": (5, -4, -4), "trans": (6, -5, -1)}


def model_distances(seqs: list[str], model: str = "identity") -> np.ndarray:
    """Distances between aligned sequences: the share of places that differ, or what a pair's score lacks of the better one's own. Gaps and stops score nothing."""
    if model != "identity" and model not in MODELS:
        raise ValueError(f"no such model: {model}; there are identity, {', '.join(MODELS)}")
    m = _matrix(seqs)
    if not m.size:
        return np.zeros((len(m), len(m)))
    known = (m != ord("-")) & (m != ord("*"))
    total, own = np.zeros((len(m), len(m))), np.zeros(len(m))
    for place, there in zip(m.T, known.T):
        both, same = there[:, None] & there[None, :], place[:, None] == place[None, :]
        if model == "identity":
            total += both & same
            continue
        equal, unequal, transition = MODELS[model]
        purine, pyrimidine = np.isin(place, [ord("A"), ord("G")]), np.isin(place, [ord("C"), ord("T")])
        alike = (purine[:, None] & purine[None, :]) | (pyrimidine[:, None] & pyrimidine[None, :])
        total += both * np.where(same, equal, np.where(alike, transition, unequal))
        own += there * equal
    if model == "identity":
        return 1 - total / m.shape[1]
    best = np.maximum(own[:, None], own[None, :])
    return 1 - total / np.where(best > 0, best, 1)


def _tree(names: list[str], seqs: list[str], model: str | None) -> list[tuple[str, str, float]]:
    if model is not None:
        return upgma(names, model_distances(seqs, model))
    m, unit = _matrix(seqs), 1 / max(len(seqs[0]) if seqs else 0, 1)
    return upgma_by_profiles(names, m, unit) if len(names) > MATRIX_ROWS else upgma(names, _hamming_all(m, m), unit)


def _dealt(df: DataFrame, group: str) -> DataFrame:
    """Rows dealt by group to more tasks than run at once, which Spark doesn't join for their few bytes: their work is by the square."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism), group)


def trees(df: DataFrame, group: str, name: str = "name", seq: str = "sequence", model: str | None = None) -> DataFrame:
    """A UPGMA tree of each group's aligned sequences: group, from, to, length, root (1 for edges of the root).

    model: None for the share of mismatches (a dot matches all), or see model_distances. A group is one task's work: up to MATRIX_ROWS sequences with all their
    distances in memory, beyond it with its clusters' residues by place (for None; the other models' distances of means don't follow from residues).
    """

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(name)
        edges = _tree(rows[name].tolist(), rows[seq].tolist(), model)
        root = edges[-1][0] if edges else None
        return pd.DataFrame([(key[0], a, b, length, int(a == root)) for a, b, length in edges], columns=[group, "from", "to", "length", "root"])

    kind = df.schema[group].dataType.simpleString()
    return _dealt(df, group).groupBy(group).applyInPandas(one, f"`{group}` {kind}, `from` string, `to` string, length double, root int")


def leaf_order(edges: list[tuple[str, str, float]]) -> list[str]:
    """Leaves of a tree in the order of a walk from its root, children as given."""
    children: dict[str, list[str]] = {}
    for a, b, _ in edges:
        children.setdefault(a, []).append(b)
    below = {b for _, b, _ in edges}
    stack, out = [a for a in children if a not in below][:1], []
    while stack:
        node = stack.pop()
        if node in children:
            stack += reversed(children[node])
        else:
            out.append(node)
    return out


def cut_tree(edges: list[tuple[str, str, float]], threshold: float) -> list[list[str]]:
    """Leaves of the subtrees left when edges longer than the threshold are cut."""
    up = {b: b if length > threshold else a for a, b, length in edges}
    parents = {a for a, _, _ in edges}

    def top(n: str) -> str:
        while up.get(n, n) != n:
            n = up[n]
        return n

    out: dict[str, list[str]] = {}
    for leaf in leaf_order(edges):
        if leaf not in parents:
            out.setdefault(top(leaf), []).append(leaf)
    return list(out.values())


def tree_ranks(df: DataFrame, group: str, name: str = "name", seq: str = "sequence", threshold: float | None = None, model: str | None = None) -> DataFrame:
    """Each sequence's place in its group's tree, and with a threshold the subtree (from 1) that it is in."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(name)
        edges = _tree(rows[name].tolist(), rows[seq].tolist(), model)
        order = leaf_order(edges) or rows[name].tolist()
        part = {n: i + 1 for i, p in enumerate(cut_tree(edges, threshold) if threshold is not None and edges else [order]) for n in p}
        return pd.DataFrame([(key[0], n, i + 1, part[n]) for i, n in enumerate(order)], columns=[group, name, "leaf_rank", "subtree"])

    kind = df.schema[group].dataType.simpleString()
    return _dealt(df, group).groupBy(group).applyInPandas(one, f"`{group}` {kind}, `{name}` string, leaf_rank int, subtree int")


def connected_vertices(vertices: DataFrame, edges: DataFrame, id_col: str, name: str = "component_ID") -> DataFrame:
    """Adds the component of each vertex, named by its smallest id."""
    found = components(edges.select(F.col("from").alias("a"), F.col("to").alias("b")), Scratch(vertices.sparkSession))
    return vertices.join(found, vertices[id_col] == found.node, "left").select(*(vertices[c] for c in vertices.columns), F.coalesce("root", vertices[id_col]).alias(name))
