"""SimHash near-duplicates by a binary trie self-join.

Fingerprints that differ in at most k bits agree in at least one of k + 1 parts of their bits. So each distinct
fingerprint goes to k + 1 groups, one for each part and its value; a group is a subtrie whose remaining bits a
task joins with itself. The traversal goes down pairs of nodes together, adds up the bits in which they differ, and
drops a pair whose sum exceeds the budget. Groups that stay large are split the same way once more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from clonespark.llm.common import map_batches, sized, utf8
from clonespark.operators.components import components
from clonespark.scratch import Scratch

SEED = 42
#: Bytes of a long text whose words are held together.
PIECE_BYTES = 1 << 18
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: A group of more fingerprints than this is split by a further part of its bits.
LARGE_GROUP = 2_000
#: Node pairs handled at once, and the product of sizes under which a node pair's members are compared.
CHUNK, LEAF = 1 << 16, 16
#: Links kept before they are reduced to stars.
LINKS = 1 << 20
#: Pairs of a prefix join handled at once.
PAIRS = 1 << 18


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text cut at white space, in pieces of PIECE_BYTES and a word."""
    at = 0
    while at < len(raw):
        cut = SPACE.search(raw, at + PIECE_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def shingle_hashes(raw: bytes, k: int, seed: int = SEED) -> np.ndarray:
    """Unsigned XXH64 of each run of k words, joined by spaces; fewer words: of the whole run; none: nothing."""
    digest, out, words = xxhash.xxh64_intdigest, [], []
    for piece in _pieces(raw):
        words += piece.lower().split()  # of bytes: A-Z and ASCII white space only
        if len(words) < k:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
        out.append(np.fromiter((digest(line[s:e], seed) for s, e in spans), np.uint64, len(words) - k + 1))
        words = words[len(words) - k + 1 :]
    if not out:
        return np.array([digest(b" ".join(words), seed)] if words else [], np.uint64)
    return np.concatenate(out)


def shingle_set(raw: bytes, k: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending."""
    return np.unique(shingle_hashes(raw, k))


def _signature(h: np.ndarray, words64: int) -> np.ndarray:
    """64-bit words, each bit 1 if set in over half the hashes; further words come from remixed hashes."""
    out = []
    for w in range(words64):
        bits = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            x = h[at : at + (1 << 16)]
            bits += np.unpackbits((_remix(x, w) if w else x).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out.append(np.packbits(2 * bits > len(h)).view(">i8")[0])
    return np.array(out, np.int64)


def _remix(h: np.ndarray, w: int) -> np.ndarray:
    h = (h ^ np.uint64(w * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def fingerprints(docs: DataFrame, *, carry: str = "doc_id", text_col: str = "text", shingle: int = 3, words64: int = 1) -> DataFrame:
    """The column carry and fingerprint (array of words64 bigint) of every whole text. Null: as an empty text, all zero."""

    def run(batch: pa.RecordBatch):
        prints = [_signature(shingle_hashes(x.as_py(), shingle), words64) for x in batch.column(1)]
        offsets = np.arange(len(prints) + 1, dtype=np.int32) * words64
        return batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prints)))

    schema = StructType([docs.schema[carry], StructField("fingerprint", ArrayType(LongType()))])
    return map_batches(docs.select(carry, utf8(text_col)), run, schema)


def prefix_size(n: int, similarity: float) -> int:
    """Of n shingles in any fixed order, how many hold SHARED of any set's with that similarity to them, if its own prefix is cut alike.

    Sets that must have c in common share min(SHARED, c) at least.
    """
    least = math.ceil(similarity * n - 1e-9)
    return n - least + min(SHARED, least)


def parities(s: np.ndarray) -> np.ndarray:
    """64-bit words whose bits tell whether a set has an odd number of hashes that end in each of the bits' numbers.

    Two sets differ in at least as many elements as their words do in bits.
    """
    odd = np.bincount((s & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_fingerprints(docs: DataFrame, *, carry: str, text_col: str, shingle: int, words64: int, similarity: float) -> DataFrame:
    """Of every text the column carry, fingerprint (as in fingerprints, of the distinct shingles) and of the set of shingles: digest
    (16 bytes), size, prefix (the least hashes; see prefix_size) and parities."""

    def run(batch: pa.RecordBatch):
        sets = [shingle_set(x.as_py(), shingle) for x in batch.column(1)]
        prints = np.concatenate([_signature(s, words64) for s in sets])
        offsets = np.arange(len(sets) + 1, dtype=np.int32) * words64
        sizes = [len(s) for s in sets]
        heads = [s[: prefix_size(len(s), similarity)].astype(np.int64) for s in sets]
        ends = np.concatenate(([0], np.cumsum([len(h) for h in heads]))).astype(np.int32)
        prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(heads)))
        odd = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * PARITY_WORDS), pa.array(np.concatenate([parities(s) for s in sets])))
        return batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(prints)), [xxhash.xxh128_digest(s.tobytes()) for s in sets], sizes, prefix, odd

    longs = ArrayType(LongType())
    schema = StructType([docs.schema[carry], StructField("fingerprint", longs), StructField("digest", BinaryType()), StructField("size", LongType()), StructField("prefix", longs), StructField("parities", longs)])
    return map_batches(docs.select(carry, utf8(text_col)), run, schema)


def trie_pairs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values that differ in at most `budget` of their low `bits` bits, within each range.

    values: unsigned, in ascending order within each of the ranges starts to ends. Node pairs are handled in chunks,
    deepest first, so memory doesn't grow with their number.
    """
    ones: dict[int, np.ndarray] = {}

    def middle(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum(values >> np.uint64(bit) & np.uint64(1), dtype=np.int64)))
        return hi - (ones[bit][hi] - ones[bit][lo])

    zero = np.zeros(len(starts), np.int64)
    stack = [(bits - 1, starts, ends, starts, ends, zero)]
    while stack:
        bit, a0, a1, b0, b1, err = stack.pop()
        if len(a0) > CHUNK:
            stack += [(bit, *(x[i : i + CHUNK] for x in (a0, a1, b0, b1, err))) for i in range(0, len(a0), CHUNK)]
            continue
        leaf = ((a1 - a0) * (b1 - b0) <= LEAF) | (bit < 0)
        if leaf.any():
            n1, n2 = (a1 - a0)[leaf], (b1 - b0)[leaf]
            sizes = n1 * n2
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            width = np.repeat(n2, sizes)
            i, j = np.repeat(a0[leaf], sizes) + at // width, np.repeat(b0[leaf], sizes) + at % width
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            yield i[near], j[near]
            a0, a1, b0, b1, err = (x[~leaf] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        am, bm = middle(a0, a1, bit), middle(b0, b1, bit)
        own = a0 == b0
        parts = [(a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1), (am, a1, b0, bm, np.where(own, budget + 1, err + 1))]
        new = [np.concatenate(x) for x in zip(*parts)]
        keep = (new[4] <= budget) & (new[1] > new[0]) & (new[3] > new[2])
        keep &= (new[0] != new[2]) | (new[1] - new[0] > 1)  # a value alone has no pair
        stack.append((bit - 1, *(x[keep] for x in new)))


def stars(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components from fewer links: each node to the least one that it reaches."""
    nodes, flat = np.unique(np.concatenate((i, j)), return_inverse=True)
    a, b = flat[: len(i)], flat[len(i) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class Plan:
    """How fingerprints are compared.

    words64: length of a fingerprint; bands: its bits in so many equal bands, of up to 64 bits; budget: bits in which
    a pair may differ in some band. checks: 64-bit words that further tell a pair; limit: bits in which it may differ there, sure: bits
    up to which no exact check follows.
    """

    def __init__(self, words64: int = 1, bands: int = 1, budget: int = 3, checks: int = 1, limit: int = 3, sure: int = 3) -> None:
        self.words64, self.bands, self.budget, self.checks, self.limit, self.sure = words64, bands, budget, checks, limit, sure
        self.width = 64 * words64 // bands
        if self.width * bands != 64 * words64 or 64 % self.width:
            raise ValueError("bands must divide the fingerprint evenly, without crossing 64-bit words")

    def band(self, words: np.ndarray, b: int) -> np.ndarray:
        """Band b of fingerprints given as rows of 64-bit words."""
        at = b * self.width
        return words[:, at // 64] >> np.uint64(64 - at % 64 - self.width) & np.uint64((1 << self.width) - 1)

    def cut(self, part: int, width: int) -> tuple[int, int]:
        """Where a part of `width` bits lies: its lowest bit and its number of bits."""
        parts = self.budget + 1
        lo = width - (part + 1) * width // parts
        return lo, width - part * width // parts - lo


def rotated(x: np.ndarray, lo: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits lo to lo + size, and the others moved together."""
    value = x >> np.uint64(lo) & np.uint64((1 << size) - 1)
    above = x >> np.uint64(lo + size) if lo + size < 64 else np.zeros_like(x)
    return value, (above << np.uint64(lo)) | (x & np.uint64((1 << lo) - 1))


def _keyed(plan: Plan, batch: pa.RecordBatch):
    """A row for each fingerprint, band and part: slot (band and part), key (the part's bits), rest, node, known, checks."""
    words = batch.column(1).flatten().to_numpy().reshape(-1, plan.words64).astype(np.uint64)
    node, known = batch.column(0).to_numpy(), batch.column(2).to_numpy()
    checks = list(batch.column(3).flatten().to_numpy().reshape(-1, plan.checks).T)
    out = []
    for b in range(plan.bands):
        x = plan.band(words, b)
        for part in range(plan.budget + 1):
            lo, size = plan.cut(part, plan.width)
            key, rest = rotated(x, lo, size)
            out.append((np.full(len(x), b * (plan.budget + 1) + part, np.int32), key.astype(np.int64), rest.astype(np.int64), node, known, *checks))
    return [np.concatenate(x) for x in zip(*out)]


def _split(plan: Plan, batch: pa.RecordBatch):
    """Rows of large groups, each once for every part of the band's other bits; key2 has the part and its bits."""
    slot, key, rest, *others = (x.to_numpy() for x in batch.columns)
    out, parts = [], plan.budget + 1
    for part in range(parts):
        key2, rest2 = np.zeros_like(key), np.zeros_like(rest)
        for s in np.unique(slot):
            width = plan.width - plan.cut(int(s) % parts, plan.width)[1]
            lo, size = plan.cut(part, width)
            at = slot == s
            k, r = rotated(rest[at].astype(np.uint64), lo, size)
            key2[at], rest2[at] = k.astype(np.int64) + (part << 48), r.astype(np.int64)
        out.append((slot, key, key2, rest2, *others))
    return [np.concatenate(x) for x in zip(*out)]


def forest(i: np.ndarray, j: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Of links in order of preference, the places of a spanning forest between what root tells apart (minimal, by that order)."""
    chosen, at = [], np.arange(len(i))
    while True:
        a, b = root[i[at]], root[j[at]]
        apart = a != b
        at, a, b = at[apart], a[apart], b[apart]
        if not len(at):
            return np.sort(np.concatenate(chosen)) if chosen else at
        _, first = np.unique(np.concatenate((a, b)), return_index=True)  # the first link of each component
        picked = np.unique(first % len(at))
        chosen.append(at[picked])
        moved, to = stars(a[picked], b[picked])
        now = np.arange(len(root))
        now[moved] = to
        root = now[root]


class Links:
    """Links of a task: sure ones, reduced to stars, and doubtful ones, to a spanning forest of the closest; whenever there are many."""

    def __init__(self, n: int) -> None:
        self.n, self.held = n, 0
        self.sure: list[tuple[np.ndarray, ...]] = []
        self.doubts: list[tuple[np.ndarray, ...]] = []

    def add(self, i: np.ndarray, j: np.ndarray, differ: np.ndarray, sure: np.ndarray) -> None:
        for kept, which in ((self.sure, sure), (self.doubts, ~sure)):
            if which.any():
                kept.append((i[which], j[which], differ[which]))
        self.held += len(i)
        if self.held > LINKS:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, sure) of what is left."""
        none = (np.zeros(0, np.int64),) * 3
        i, j, _ = (np.concatenate(x) for x in zip(*self.sure)) if self.sure else none
        i, j = stars(i, j) if len(i) else none[:2]
        root = np.arange(self.n)
        root[i] = j
        x, y, d = (np.concatenate(v) for v in zip(*self.doubts)) if self.doubts else none
        order = np.argsort(d, kind="stable")
        order = order[forest(x[order], y[order], root)] if len(order) else order
        at = np.sort(order)
        x, y, d = x[at], y[at], d[at]
        self.sure, self.doubts, self.held = [(i, j, i)] if len(i) else [], [(x, y, d)] if len(x) else [], len(i) + len(x)
        return np.concatenate((i, x)), np.concatenate((j, y)), np.arange(len(i) + len(x)) < len(i)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups (rows alike in the first three columns), a batch or more at a time."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ident = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
        if kept and [kept[-1].column(i)[-1].as_py() for i in range(3)] != ident[0].tolist():
            yield pa.Table.from_batches(kept)
            kept = []
        change = np.flatnonzero((ident[1:] != ident[:-1]).any(1))
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def first_meeting(plan: Plan, xor: np.ndarray, slot: np.ndarray, key2: np.ndarray) -> np.ndarray:
    """Whether the group in which a pair meets is the first of all in which it does.

    xor: the differing bits of each pair's fingerprints, as rows of words; slot and key2: its group.
    """
    parts, keep = plan.budget + 1, np.ones(len(slot), bool)
    for s in np.unique(slot).tolist():
        at = np.flatnonzero(slot == s)
        b, part = divmod(s, parts)
        for earlier in range(b):
            at = at[np.bitwise_count(plan.band(xor[at], earlier)) > plan.budget]
        band = plan.band(xor[at], b)
        for earlier in range(part):
            apart = rotated(band, *plan.cut(earlier, plan.width))[0] != 0
            at, band = at[apart], band[apart]
        lo, size = plan.cut(part, plan.width)
        rest, part2 = rotated(band, lo, size)[1], key2[at] >> 48
        for earlier in range(plan.budget):
            apart = (part2 <= earlier) | (rotated(rest, *plan.cut(earlier, plan.width - size))[0] != 0)
            at, rest, part2 = at[apart], rest[apart], part2[apart]
        keep[slot == s] = False
        keep[at] = True
    return keep


def _join(plan: Plan, every: bool):
    """Over partitions sorted by group: links (a, b, sure) between the nodes of a group, which is held as numbers.

    every: all links between nodes that aren't known to be connected, each in the first group where it meets (the check words
    begin with the fingerprint); else stars and forests that connect the same nodes, of which the doubtful links aren't confirmed yet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            slot, key, key2, rest, node, known, *checks = (x.to_numpy() for x in t.columns)
            change = np.flatnonzero((slot[1:] != slot[:-1]) | (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])) + 1
            starts, ends = np.concatenate(([0], change)), np.concatenate((change, [len(slot)]))
            several = ends - starts > 1
            bits, links = [c.view(np.uint64) for c in checks], Links(len(node))
            order = np.argsort(node, kind="stable")  # stars are around the least node, so that a star is the same in all groups
            rank, ranked = np.empty(len(node), np.int64), node[order]
            rank[order] = np.arange(len(node))

            def batch(a: np.ndarray, b: np.ndarray, sure: np.ndarray, node: np.ndarray = node) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b])), pa.array(sure)], names=["a", "b", "sure"])

            for i, j in trie_pairs(rest.astype(np.uint64), starts[several], ends[several], plan.width, plan.budget):
                differ = sum(np.bitwise_count(c[i] ^ c[j]).astype(np.int64) for c in bits)
                near = (differ <= plan.limit) & (known[i] != known[j])
                i, j, differ = i[near], j[near], differ[near]
                if every and len(i):
                    xor = np.stack([c[i] ^ c[j] for c in bits[: plan.words64]], 1)
                    first = first_meeting(plan, xor, slot[i], key2[i])
                    if first.any():
                        yield batch(i[first], j[first], differ[first] <= plan.sure)
                elif len(i):
                    links.add(rank[i], rank[j], differ, differ <= plan.sure)
            a, b, sure = links.shrink()
            if len(a):
                yield batch(a, b, sure, ranked)

    return run


def trie_links(prints: DataFrame, plan: Plan, scratch: Scratch, every: bool = False) -> DataFrame:
    """Links (a, b, sure) among distinct fingerprints, given as node (bigint), fingerprint (array<bigint>), known (bigint) and check (array<bigint>).

    Pairs within the plan's bounds whose known differs: each of them, or without `every` as many as connect the same
    nodes, the closest first.
    """
    checks = [f"c{i}" for i in range(plan.checks)]
    columns = "slot int, key bigint, {}rest bigint, node bigint, known bigint, " + ", ".join(f"{c} bigint" for c in checks)
    keyed = map_batches(prints.select("node", "fingerprint", "known", "check"), lambda b: _keyed(plan, b), columns.format(""))
    large = keyed.groupBy("slot", "key").count().filter(F.col("count") > LARGE_GROUP).select("slot", "key", F.lit(True).alias("large"))
    marked = keyed.join(sized(large, scratch), ["slot", "key"], "left")
    few = marked.filter(F.col("large").isNull()).select("slot", "key", F.lit(-1).cast("long").alias("key2"), "rest", "node", "known", *checks)
    many = map_batches(marked.filter("large").select("slot", "key", "rest", "node", "known", *checks), lambda b: _split(plan, b), columns.format("key2 bigint, "))
    dealt = few.unionAll(many).repartition("slot", "key", "key2").sortWithinPartitions("slot", "key", "key2", "rest")
    return scratch.save(dealt.mapInArrow(_join(plan, every), "a bigint, b bigint, sure boolean"))


def labels(groups: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Of groups (node, least), the least of all that links (a, b) connect: node, lowest."""
    roots = components(links, scratch)
    roots = roots.unionAll(roots.select(F.col("root").alias("node"), "root")).distinct()
    tied = roots.join(groups, "node")
    lowest = tied.groupBy("root").agg(F.min("least").alias("low"))
    tied = tied.join(lowest, "root").select("node", "low")
    return groups.join(tied, "node", "left").select("node", F.coalesce("low", "least").alias("lowest"))


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate component of every document.

    Returns id_col, fingerprint (16 lowercase hex digits) and component_id: the least id that links reach, a link
    being fingerprints with at most `budget` differing bits. Exact: every link counts, however many
    copies there are, as copies share a fingerprint and are compared once. A null or empty text has fingerprint zero
    and is linked like any other. A row with a null id gets the least id of its component, if any has one. Repeated rows
    stay; other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.save(fingerprints(docs, carry=id_col, text_col=text_col, shingle=shingle).select(id_col, F.col("fingerprint")[0].alias("node")))
    groups = scratch.save(prints.groupBy("node").agg(F.min(id_col).alias("least"), F.count("*").alias("n")))
    links = trie_links(groups.select("node", F.array("node").alias("fingerprint"), F.col("node").alias("known"), F.array("node").alias("check")), Plan(1, 1, budget, 1, budget, budget), scratch)
    lowest = scratch.save(labels(groups.select("node", "least"), links.select("a", "b"), scratch))
    # Fingerprints that a thousandth of all documents share, so a thousand at most, aren't dealt by key.
    total = groups.agg(F.sum("n")).first()[0] or 0
    shared = F.broadcast(groups.filter(F.col("n") >= max(1000, total / 1000)).select("node").join(lowest, "node"))
    named = prints.join(shared, "node").unionByName(prints.join(shared, "node", "left_anti").join(lowest, "node"))
    return named.select(id_col, F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), F.col("lowest").alias("component_id"))


#: Near-duplicates that are found first, to leave less to the prefixes: a fingerprint of four 64-bit words in eight bands of 32 bits, compared
#: by the trie join with three differing bits. Up to `sure` bits links come as stars, up to `limit` as a forest. Neither decides what is found.
NEAR = Plan(words64=4, bands=8, budget=3, checks=4, limit=51, sure=13)
#: So many shingles of two prefixes must be equal: a few more in each prefix rule out pairs that have some by chance.
SHARED = 8
#: A shingle in more prefixes than this goes to the end of the order, so that it is in few.
COMMON = 64
#: Up to so many of them are sent to the tasks.
KNOWN_COMMON = 500_000
#: Prefixes with one shingle up to which they meet in one task.
CROWD = 4_096
#: Prefixes with one shingle up to which it is dealt by their least node.
GATHERED = 512
#: Words of a set's parities (see parities), which rule out most pairs that are too far apart. Sets of 400 shingles may differ in 88 of 800 at a similarity of 0.8: of four words half of
#: the bits at most differ by chance, and 140 differing shingles (a similarity of 0.7) show as 85; in sixteen they show as 122.
PARITY_WORDS = 16
#: Where shingles are in more than COMMON prefixes, so many forests of the closest pairs are told in a round, in so many rounds at most, before all pairs are.
FORESTS, ROUNDS = 4, 4


def _shingle_sets(shingle: int, ordered=None):
    """Sets of shingles of texts, ascending, or what `ordered` makes of each."""

    def run(batch: pa.RecordBatch):
        sets = [shingle_set(x.as_py(), shingle).astype(np.int64) for x in batch.column(0)]
        if ordered is not None:
            sets = [ordered(x) for x in sets]
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
        return batch.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))

    return run


def confirmed(links: DataFrame, texts_of, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """Of links (a, b) between nodes, those whose texts (texts_of gives node and _text of nodes) have shingle sets of that Jaccard similarity."""
    links = scratch.save(links.distinct())
    ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    wanted = texts_of(ends).select(utf8("_text"), "node")
    sets = scratch.save(map_batches(wanted, _shingle_sets(shingle), "node bigint, shingles array<bigint>"))
    both = links.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")


def _rare_first(nodes: DataFrame, texts_of, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """node, known, size and prefix with shingles that many prefixes share last in the order, then by hash, and parities. The
    order is one for all nodes."""
    tokens = nodes.select("node", F.explode("prefix").alias("shingle"))
    common = scratch.save(tokens.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON))
    changed = scratch.save(tokens.join(sized(common, scratch), "shingle", "left_semi").select("node").distinct())
    texts = texts_of(changed).select(utf8("_text"), "node")
    if common.count() <= KNOWN_COMMON:  # a few MB for each task: the sets needn't be dealt
        listed = sorted((r["shingle"], r["n"]) for r in common.collect())
        hashes, counts = (np.array(x, np.int64) for x in zip(*listed)) if listed else (np.zeros(0, np.int64),) * 2

        def head(own: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            n = np.where(hashes[at] == own, counts[at], 0) if len(hashes) else np.zeros(len(own), np.int64)
            return own[np.lexsort((own.view(np.uint64), n))][: prefix_size(len(own), similarity)]

        new = map_batches(texts, _shingle_sets(shingle, head), "node bigint, _prefix array<bigint>")
    else:
        sets = map_batches(texts, _shingle_sets(shingle), "node bigint, shingles array<bigint>")
        ranked = sets.select("node", F.explode("shingles").alias("shingle")).join(common, "shingle", "left").groupBy("node")
        # Hashes are compared as signed numbers here, as unsigned ones elsewhere: the sign bit is flipped.
        order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("shingle").bitwiseXOR(F.lit(-(1 << 63))).alias("place"), "shingle")
        ordered = ranked.agg(F.sort_array(F.collect_list(order))["shingle"].alias("ordered"))
        least = F.ceil(similarity * F.size("ordered") - 1e-9)
        length = (F.size("ordered") - least + F.least(least, F.lit(SHARED))).cast("int")
        new = ordered.select("node", F.slice("ordered", F.lit(1), length).alias("_prefix"))
    new = scratch.save(new)
    out = scratch.save(nodes.join(new, "node", "left").select("node", "known", "size", "parities", F.coalesce("_prefix", "prefix").alias("prefix")))
    scratch.drop(new)
    return out


def counted_pairs(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Of pairs (a, b, least, n) each once, with the sum of its n."""
    a, b, least, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return a[starts], b[starts], least[order][starts], np.add.reduceat(n[order], starts)


def close_pairs(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Of pairs (a, b, known of a, known of b, distance) FORESTS spanning forests between the known, of the closest, none with a pair of another."""
    a, b, x, y, distance = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((b, a))
    order = order[np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))]
    order = order[np.argsort(distance[order], kind="stable")]
    a, b, x, y, distance = (p[order] for p in (a, b, x, y, distance))
    left, chosen = np.arange(len(a)), []
    names, flat = np.unique(np.concatenate((x, y)), return_inverse=True)
    i, j = flat[: len(x)], flat[len(x) :]
    for _ in range(FORESTS):
        if len(left):
            picked = forest(i[left], j[left], np.arange(len(names)))
            chosen.append(left[picked])
            left = np.delete(left, picked)
    at = np.concatenate(chosen)
    return a[at], b[at], x[at], y[at], distance[at]


def _prefix_pairs(similarity: float, every: bool = True):
    """Over rows (unit, node, known, size, side, parities, and if known own: in how many units the node is) in order of unit and known: for each unit (a shingle, or two tiles of one) the pairs (a, b) that differ in known
    and whose sizes, parities and own may go together, with how many shingles of their prefixes must be equal, and in how many units that came one after another they met. Of two tiles a
    row of each makes a pair; side 0: all of one. Without every, a task tells of the closest pairs alone as many as close_pairs leaves."""
    columns = ["a", "b", "least", "n"] if every else ["a", "b"]
    fewer = counted_pairs if every else close_pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def told_pairs() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()[: len(columns)]], names=columns)

        for t in _blocks(batches):
            shingle, node, known, size, side = (x.to_numpy() for x in t.columns[:5])
            odd = np.ascontiguousarray(t.column(5).combine_chunks().flatten().to_numpy().reshape(-1, PARITY_WORDS).view(np.uint64).T)
            own = t.column(6).to_numpy() if t.num_columns > 6 else size
            least = np.ceil(similarity * size - 1e-9).astype(np.int64)
            beyond = np.minimum(least, SHARED) - least  # places of the prefix less those of the set
            change = np.flatnonzero(shingle[1:] != shingle[:-1]) + 1
            ends = np.concatenate((change, [len(shingle)]))
            end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
            runs = np.concatenate((np.flatnonzero((shingle[1:] != shingle[:-1]) | (known[1:] != known[:-1])) + 1, [len(shingle)]))
            begin = np.repeat(runs, np.diff(np.concatenate(([0], runs))))  # partners of a row: from the next known to the block's end
            widths = end - begin
            total = np.concatenate(([0], np.cumsum(widths)))
            row = 0
            while row < len(widths):
                last = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS, side="right")) - 1)
                w = widths[row:last]
                i = np.repeat(np.arange(row, last), w)
                j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(begin[row:last], w)
                row = last
                may = (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-6) & ((side[i] == 0) | (side[i] != side[j]))
                i, j = i[may], j[may]
                both = size[i] + size[j]
                common = np.ceil(similarity / (1 + similarity) * both - 1e-9).astype(np.int64)
                needed = np.maximum(common + np.minimum(beyond[i], beyond[j]), 1)  # the shorter prefix holds what is common but for as many as it leaves out of its set
                may = needed <= np.minimum(own[i], own[j])
                i, j, both, common, needed = (x[may] for x in (i, j, both, common, needed))
                differ = np.zeros(len(i), np.int64)
                for word in odd:  # word by word: a chunk's pairs with all words would take 16 times the memory
                    differ += np.bitwise_count(word[i] ^ word[j])
                may = differ <= both - 2 * common
                if may.any():
                    i, j = i[may], j[may]
                    flip = node[i] > node[j]
                    i, j = np.where(flip, j, i), np.where(flip, i, j)
                    if every:
                        held.append((node[i], node[j], needed[may], np.ones(len(i), np.int64)))
                    else:
                        held.append((node[i], node[j], known[i], known[j], differ[may] / both[may]))
                if sum(len(x[0]) for x in held) > 2 * PAIRS:
                    held = [fewer(held)]
                    if len(held[0][0]) > PAIRS:
                        yield told_pairs()
        if held:
            held = [fewer(held)]
            yield told_pairs()

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows alike in the first column, a batch or more at a time."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ident = batch.column(0).to_numpy()
        if kept and kept[-1].column(0)[-1].as_py() != ident[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        change = np.flatnonzero(ident[1:] != ident[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def prefix_links(nodes: DataFrame, texts_of, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """Of nodes (node, known, size, parities, prefix), a saved table that goes, links (a, b) of that similarity that bring together the same nodes as all such pairs whose known differs.

    Complete: of two sets that share so much, the prefixes in any one order of all shingles share elements (see prefix_size). Where many sets share shingles, the closest of them are linked in
    rounds first, so that what a round has brought together makes no pairs in the next; at last all pairs are looked at of what is still apart.
    """
    ordered = _rare_first(nodes, texts_of, shingle, similarity, scratch)
    scratch.drop(nodes)
    # Most shingles are in one prefix alone or in those of one known: nodes meet by number first, and bring what else is needed to shingles that they share. The one exchange serves count and rows.
    tokens = ordered.select(F.explode("prefix").alias("shingle"), "node", "known").repartition("shingle")
    counts = tokens.groupBy("shingle").agg(F.count("*").alias("_n"), F.min("node").alias("first"), F.min("known").alias("_low"), F.max("known").alias("_high")).filter("_low < _high").drop("_low", "_high")
    # A node with fewer shared shingles than it must have in common with the smallest set that is near has no pair.
    shared = tokens.drop("known").join(counts, "shingle").join(ordered.select("node", "size"), "node").withColumn("_own", F.count("*").over(Window.partitionBy("node")))
    smallest = F.ceil(similarity * F.ceil(similarity * F.col("size") - 1e-6) - 1e-9)
    shared = scratch.save(shared.filter(F.col("_own") >= F.least(smallest, F.lit(SHARED))).withColumn("own", F.col("_own").cast("int")).drop("_own", "size"))
    sets = scratch.save(ordered.drop("prefix"))
    scratch.drop(ordered)
    found = []
    crowded = scratch.save(shared.filter(F.col("_n") > COMMON))
    for _ in range(ROUNDS):
        if crowded.isEmpty():
            break
        links = confirmed(_meetings(crowded, sets).mapInArrow(_prefix_pairs(similarity, False), "a bigint, b bigint"), texts_of, shingle, similarity, scratch)
        found.append(scratch.save(links))
        if found[-1].isEmpty():
            break
        ends = found[-1].join(sets.select(F.col("node").alias("a"), F.col("known").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("known").alias("y")), "b")
        moved = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch).select(F.col("node").alias("known"), "root")
        old, sets = sets, scratch.save(sets.join(moved, "known", "left").select("node", F.coalesce("root", "known").alias("known"), "size", "parities"))
        scratch.drop(old)
    pairs = _meetings(shared, sets).mapInArrow(_prefix_pairs(similarity), "a bigint, b bigint, least bigint, n bigint")
    candidates = pairs.groupBy("a", "b", "least").agg(F.sum("n").alias("n")).filter("n >= least").select("a", "b")
    return reduce(DataFrame.unionAll, [*found, confirmed(candidates, texts_of, shingle, similarity, scratch)])


def _meetings(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of _prefix_pairs, in the tasks and the order that it needs: of shared (shingle, node, _n: prefixes that hold it, first: the least node of them, own) with sets' known, size and parities."""
    # A shingle that more than CROWD prefixes hold is cut into tiles, and each two of them are a unit of their own.
    tiles = F.ceil(F.col("_n") / CROWD).cast("int")
    cut = shared.join(sets, "node").withColumns({"tile": F.pmod(F.xxhash64("node"), tiles).cast("int"), "tiles": tiles}).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    unit = F.when(F.col("tiles") > 1, F.xxhash64("shingle", F.least("tile", "u"), F.greatest("tile", "u"))).otherwise(F.col("shingle"))
    side = F.when(F.col("tile") == F.col("u"), 0).when(F.col("tile") < F.col("u"), 1).otherwise(2)
    # Sets that share one shingle mostly share many: units go by their least node, so that a pair is told about once and not once for each shingle. Large ones are spread.
    spread = F.pow(F.ceil(F.col("_n") / GATHERED), F.lit(2)).cast("bigint")
    block = F.when(F.col("tiles") > 1, unit).otherwise(F.xxhash64("first", F.pmod("shingle", spread)))
    rows = cut.select(block.alias("block"), unit.alias("unit"), "node", "known", "size", side.alias("side"), "parities", "own")
    return rows.repartition("block").sortWithinPartitions("block", "unit", "known").drop("block")


def near_duplicate_firsts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, plan: Plan = NEAR) -> tuple[DataFrame, bool]:
    """_id and _hash (of the text) of the document to keep of each group of near-duplicates, and whether such pairs repeat in docs.

    Texts are linked by a Jaccard similarity of their word shingles of `similarity` or more. Exact and complete: a trie join over
    bands of longer fingerprints connects most of them, a join of prefixes of the shingle sets gives all pairs that it leaves apart, and every
    link's sets are compared. Texts with equal shingle sets are always one group. Texts without words are alike; fewer words than a shingle
    has are one shingle. Groups are connected components of links; the document with the least id stays, null ids last.
    """
    scratch, out = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    named = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    keys = named.select("_text", F.struct("_id", "_hash").alias("_key"))
    rows = scratch.save(set_fingerprints(keys, carry="_key", text_col="_text", shingle=shingle, words64=plan.words64, similarity=similarity))
    order = F.struct(F.col("_key._id").isNull().alias("no_id"), F.col("_key._id").alias("id"), F.col("_key._hash").alias("hash"))
    same = rows.groupBy("digest").agg(F.min(order).alias("least"), *(F.first(c).alias(c) for c in ("fingerprint", "size", "prefix", "parities"))).drop("digest")
    groups = scratch.save(same.withColumn("node", F.monotonically_increasing_id()))
    names = scratch.save(groups.select("node", "least"))
    repeats = not rows.groupBy("_key").count().filter("count > 1").isEmpty()
    scratch.drop(rows)

    def texts_of(nodes: DataFrame) -> DataFrame:
        wanted = sized(names.join(nodes, "node", "left_semi").select("node", F.col("least.id").alias("_own_id"), F.col("least.hash").alias("_own_hash")), scratch)
        found = named.join(wanted, named["_id"].eqNullSafe(wanted["_own_id"]) & (named["_hash"] == wanted["_own_hash"])).select("node", "_text")
        return found.dropDuplicates(["node"]) if repeats else found

    # First the links of a spanning forest, then all pairs between what those that hold leave apart.
    links = trie_links(groups.select("node", "fingerprint", F.col("node").alias("known"), F.col("fingerprint").alias("check")), plan, scratch)
    held = scratch.save(confirmed(links.select("a", "b"), texts_of, shingle, similarity, scratch))
    known = scratch.save(groups.join(components(held, scratch), "node", "left").select("node", "size", "prefix", "parities", F.coalesce("root", "node").alias("known")))
    scratch.drop(groups)
    held = scratch.save(held.unionAll(prefix_links(known, texts_of, shingle, similarity, scratch)))
    firsts = out.save(labels(names, held, scratch).select(F.col("lowest.id").alias("_id"), F.col("lowest.hash").alias("_hash")).distinct())
    scratch.clear()
    return firsts, repeats


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of docs for each group of near-duplicates, with its columns as they are; see near_duplicate_firsts.

    Rows that repeat both id and text stay once. An empty table gives an empty result.
    """
    firsts, repeats = near_duplicate_firsts(docs, id_col=id_col, text_col=text_col, **options)
    firsts = sized(firsts, Scratch(docs.sparkSession))
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), F.col(id_col).alias("_own_id"), F.xxhash64(text_col).alias("_own_hash"))
    kept = rows.join(firsts, rows["_own_id"].eqNullSafe(firsts["_id"]) & (rows["_own_hash"] == firsts["_hash"]), "left_semi")
    if repeats:
        kept = kept.dropDuplicates(["_own_id", "_own_hash"])
    return kept.select("_row.*")
