"""Masked pseudo-likelihood scores of documents.

A network sees the WINDOW words on both sides of a place and predicts the word that stands there, in two steps that both see the same
hidden layer: the word's class, and the word among those of its class. A document's score is the sum of the logarithms of these conditional
probabilities over all its words. The vocabulary comes from counts over all documents: the most frequent words are predicted as such, of the others
the group that their hash gives, and within its group each word by its own count, however rare. The network is trained in numpy on every place of all
documents, task by task, and the tasks' weights are averaged row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import bound_batches, fits, map_batches, release_memory, sized, utf8
from clonespark.llm.words import LOWER, Block, blocks, mix
from clonespark.scratch import Scratch

#: Kinds of words up to which their counts are broadcast.
BROADCAST_KINDS = 500_000

#: Words with an id of their own, groups of the others (together a square), hidden units, words seen on either side.
VOCABULARY, OTHERS, HIDDEN, WINDOW = 4096, 1088, 16, 2
#: Passes over all documents, each of which masks its share of the places, so that all are masked once; size of a step, places in a step.
ROUNDS, RATE, STEP = 2, 0.15, 16384
#: Slots of the table in which ids are looked up.
SLOTS = 1 << 18
#: Logits stay within this, far beyond what probabilities need.
MOST_LOGIT = np.float32(60)
ONES = np.ones(STEP, np.float32)
#: Places whose classes are predicted together: what fits a core's cache.
CHUNK = 1024
#: Bytes of text scored together.
SCORE_BYTES = 1 << 20


def word_hashes(block: Block) -> np.ndarray:
    """Hashes of the words of texts, A-Z lower-cased, as signed 64-bit numbers."""
    block.data = LOWER[block.data]
    block.split()
    return block.hashes().astype(np.int64)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """hash and count of every word of all texts."""

    def run(batch: pa.RecordBatch):
        hashes, counts = np.unique(np.concatenate([word_hashes(b) for b in blocks(batch.column(0))]), return_counts=True)
        return hashes, counts

    return map_batches(docs.select(utf8(text_col)), run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Ids of words, with the class of each and its cell, the place within the class. Ids from len(hashes) on stand for OTHERS groups, the last for no word."""

    hashes: np.ndarray  # ascending
    rank: np.ndarray  # of each id by its count
    log_mass: np.ndarray  # of the count of each id

    def __post_init__(self) -> None:
        self.width = max(1, int(np.ceil(np.sqrt(self.size))))
        self.class_of, self.cell_of = self.rank // self.width, self.rank % self.width
        # Two tables of ids by the words' hashes; the second has those whose slot in the first is taken, and what it has no room for is searched.
        self.slots, left = [], np.arange(len(self.hashes), dtype=np.int32)
        for shift in (0, 32):
            table = np.full(SLOTS, -1, np.int32)
            at = self._slot(self.hashes[left], shift)
            table[at[::-1]] = left[::-1]
            self.slots.append((shift, table))
            left = left[table[at] != left]
        self.crowded = left

    @property
    def size(self) -> int:
        return len(self.hashes) + OTHERS

    @staticmethod
    def _slot(hashes: np.ndarray, shift: int) -> np.ndarray:
        return (hashes.astype(np.uint64) >> np.uint64(shift)).astype(np.int64) & (SLOTS - 1)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = len(self.hashes) + (mix(hashes.astype(np.uint64)) % np.uint64(OTHERS)).astype(np.int64)
        if not len(self.hashes):
            return out
        left = np.arange(len(hashes))
        for shift, table in self.slots:
            found = table[self._slot(hashes[left], shift)]
            right = (found >= 0) & (self.hashes[found] == hashes[left])
            out[left[right]] = found[right]
            left = left[~right]
        for i in self.crowded.tolist():
            out[left[hashes[left] == self.hashes[i]]] = i
        return out


def lexicon(counts: DataFrame, size: int = VOCABULARY) -> Lexicon:
    """From the counts of all words. At most `size` words and OTHERS sums come to the driver."""
    top = counts.orderBy(F.desc("n"), "hash").limit(size).collect()
    hashes = np.array(sorted(r["hash"] for r in top), np.int64)
    n = {r["hash"]: r["n"] for r in top}
    own = np.array([n[h] for h in hashes.tolist()], np.float64)
    threshold = (min(n.values()), max(h for h in n if n[h] == min(n.values()))) if n else (0, 0)
    rest = counts.filter((F.col("n") < threshold[0]) | ((F.col("n") == threshold[0]) & (F.col("hash") > threshold[1])))
    spread = map_batches(rest, lambda b: ((mix(b.column(0).to_numpy().astype(np.uint64)) % np.uint64(OTHERS)).astype(np.int32), b.column(1)), "g int, n bigint")
    sums = {r["g"]: r["n"] for r in spread.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    mass = np.concatenate((own, [max(sums.get(g, 0), 0.5) for g in range(OTHERS)]))
    rank = np.empty(len(mass), np.int64)
    rank[np.lexsort((np.arange(len(mass)), -mass))] = np.arange(len(mass))
    return Lexicon(hashes, rank, np.log(mass))


def powers(hidden: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A softmax before its division: powers of e and their sums. hidden and weights end with a one and the bias."""
    out = hidden @ weights.T
    np.exp(out, out=out)
    return out, out @ ONES[: out.shape[1]]


class Network:
    """One hidden layer over the words at each of 2 * WINDOW places; a softmax over classes, and in each class one over its cells."""

    PLACES = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]

    def __init__(self, words: Lexicon, rows: np.ndarray | None = None) -> None:
        """rows: tables of the places (words.size + 1 rows each), then of classes, then of cells, then biases of both. Without them, weights
        are small and biases those of counts alone."""
        self.n, self.width = words.size, words.width
        w, tables = self.width, len(self.PLACES) * (self.n + 1)
        self.parts = np.cumsum([0, tables, w, w * w, -(-w // HIDDEN), -(-w * w // HIDDEN)])
        if rows is None:
            rng = np.random.default_rng(11)
            rows = np.zeros((self.parts[-1], HIDDEN), np.float32)
            rows[: self.parts[3]] = rng.normal(0, 0.1, (self.parts[3], HIDDEN))
        self.rows = np.ascontiguousarray(rows, np.float32)
        self.table, self.classes, cells, bias, biases = (self.rows[a:b] for a, b in zip(self.parts, self.parts[1:]))
        self.cells = cells.reshape(w, w, HIDDEN)
        self.bias, self.biases = bias.reshape(-1)[:w], biases.reshape(-1)[: w * w].reshape(w, w)
        # Counts alone make the first guess; cells without a word are out of reach.
        mass = np.zeros((w, w))
        mass[words.class_of, words.cell_of] = np.exp(words.log_mass)
        with np.errstate(divide="ignore"):
            self.log_class = np.log(mass.sum(1) / mass.sum()).clip(-50).astype(np.float32)
            self.log_cell = np.log(mass / np.maximum(mass.sum(1, keepdims=True), 1e-9)).clip(-50).astype(np.float32)
        self.squares, self.seen = np.full(len(self.rows), 1e-4, np.float32), np.zeros(len(self.rows))

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Of classes and of cells, each row with its bias. Where a logit could get out of hand, its row is drawn in."""
        classes = np.concatenate((self.classes, (self.bias + self.log_class)[:, None]), axis=1)
        cells = np.concatenate((self.cells, (self.biases + self.log_cell)[:, :, None]), axis=2)
        for x in (classes, cells):
            reach = np.abs(x).sum(-1, keepdims=True)
            if reach.max() > MOST_LOGIT:
                x *= np.minimum(1, MOST_LOGIT / reach)
        return classes, cells

    def context(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of the table for the words beside each place; n stands for none."""
        out = np.empty((len(self.PLACES), len(at)), np.int64)
        for k, d in enumerate(self.PLACES):
            near = at + d
            inside = (near >= 0) & (near < len(ids))
            near = np.where(inside, near, 0)
            inside &= owner[near] == owner[at]
            out[k] = np.where(inside, ids[near], self.n) + k * (self.n + 1)
        return out

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """The hidden layer, and a column of ones."""
        out = np.ones((context.shape[1], HIDDEN + 1), np.float32)
        held = self.table[context[0]]
        for row in context[1:]:
            held += self.table[row]
        np.tanh(held, out=out[:, :-1])
        return out

    def groups(self, classes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Of places in order of their class: each class and its range."""
        ends = np.cumsum(np.bincount(classes, minlength=self.width)).tolist()
        return ((c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if b > a)

    def log_probabilities(self, context: np.ndarray, classes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of the word with that class and cell, at each place."""
        order, n = np.argsort(classes.astype(np.uint16), kind="stable"), np.arange(len(classes))
        classes, cells, hidden = classes[order], cells[order], self.hidden(context[:, order])
        held, (of_class, of_cell) = np.empty(len(n), np.float32), self.weights()
        for a in range(0, len(n), CHUNK):
            up, total = powers(hidden[a : a + CHUNK], of_class)
            held[a : a + CHUNK] = up[n[: len(up)], classes[a : a + CHUNK]] / total
        for c, a, b in self.groups(classes):
            up, total = powers(hidden[a:b], of_cell[c])
            held[a:b] *= up[n[: b - a], cells[a:b]] / total
        out = np.empty(len(n))
        out[order] = np.log(np.maximum(held, np.float32(1e-37)))
        return out

    def learn(self, context: np.ndarray, classes: np.ndarray, cells: np.ndarray) -> None:
        """A step of gradient descent, scaled by row (as Adagrad does)."""
        order, n, w = np.argsort(classes.astype(np.uint16), kind="stable"), np.arange(len(classes)), self.width
        context, classes, cells = context[:, order], classes[order], cells[order]
        hidden, (of_class, of_cell) = self.hidden(context), self.weights()
        back, class_grad, cell_grad = np.empty((len(n), HIDDEN), np.float32), np.zeros((w, HIDDEN + 1), np.float32), np.zeros((w, w, HIDDEN + 1), np.float32)

        def error(a: int, b: int, weights: np.ndarray, truth: np.ndarray) -> np.ndarray:
            out, total = powers(hidden[a:b], weights)
            out *= (1 / total)[:, None]
            out[n[: b - a], truth[a:b]] -= 1
            return out

        for a in range(0, len(n), CHUNK):
            b = min(a + CHUNK, len(n))
            miss = error(a, b, of_class, classes)
            np.matmul(miss, self.classes, out=back[a:b])
            class_grad += miss.T @ hidden[a:b]
        for c, a, b in self.groups(classes):
            miss = error(a, b, of_cell[c], cells)
            back[a:b] += miss @ self.cells[c]
            np.matmul(miss.T, hidden[a:b], out=cell_grad[c])
        back *= 1 - hidden[:, :-1] * hidden[:, :-1]
        flat = context.astype(np.int32).ravel()
        by_row = np.argsort(flat)
        flat = flat[by_row]
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        self._step(flat[first], np.add.reduceat(back[by_row % len(n)], first, axis=0), np.diff(first, append=len(flat)))
        self._step(slice(self.parts[1], self.parts[2]), class_grad[:, :-1], len(n))
        self._step(slice(self.parts[2], self.parts[3]), cell_grad[:, :, :-1].reshape(-1, HIDDEN), np.repeat(np.bincount(classes, minlength=w), w))
        for part, grad in ((3, class_grad[:, -1]), (4, cell_grad[:, :, -1].ravel())):
            size = (self.parts[part + 1] - self.parts[part]) * HIDDEN
            self._step(slice(self.parts[part], self.parts[part + 1]), np.concatenate((grad, np.zeros(size - len(grad), np.float32))).reshape(-1, HIDDEN), len(n))

    def _step(self, rows: np.ndarray | slice, grad: np.ndarray, count) -> None:
        self.squares[rows] += np.einsum("ij,ij->i", grad, grad) / HIDDEN
        self.rows[rows] -= grad * (RATE / np.sqrt(self.squares[rows]))[:, None]
        self.seen[rows] += count


def _train(words: Lexicon, start: np.ndarray | None, turn: int, rounds: int = ROUNDS):
    """Over a partition: weights after its masked places, a row for each row that it saw, with how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(words, start)
        for batch in batches:
            for block in blocks(batch.column(0), SCORE_BYTES) if batch.num_rows else ():
                hashes = word_hashes(block)
                ids = words.ids(hashes)
                place = np.arange(len(ids)) - np.searchsorted(block.text, block.text)
                masked = np.flatnonzero(mix(hashes.astype(np.uint64) + place.astype(np.uint64)) % np.uint64(rounds) == turn)
                for at in range(0, len(masked), STEP):
                    chosen = masked[at : at + STEP]
                    truth = ids[chosen]
                    net.learn(net.context(ids, block.text, chosen), words.class_of[truth], words.cell_of[truth])
            release_memory()
        seen = np.flatnonzero(net.seen)
        for at in range(0, len(seen), 10_000):
            part = seen[at : at + 10_000]
            columns = [pa.array(part.astype(np.int32)), pa.array(net.seen[part]), *(pa.array(net.rows[part, h].astype(np.float64)) for h in range(HIDDEN))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "seen", *(f"w{h}" for h in range(HIDDEN))])

    return run


def train(docs: DataFrame, words: Lexicon, text_col: str = "text", rounds: int = ROUNDS) -> Network:
    """Rounds of training in all tasks at once, which mask every place once. The driver gets the mean weights, whose size doesn't depend on the input."""
    start = None
    bound_batches(docs.sparkSession)
    texts = docs.select(utf8(text_col))
    schema = "row int, seen double, " + ", ".join(f"w{h} double" for h in range(HIDDEN))
    for turn in range(rounds):
        made = texts.mapInArrow(_train(words, start, turn, rounds), schema).groupBy("row").agg(*((F.sum(F.col(f"w{h}") * F.col("seen")) / F.sum("seen")).alias(f"w{h}") for h in range(HIDDEN)))
        rows = Network(words, start).rows.copy()
        for r in made.collect():
            rows[r["row"]] = r[1:]
        start = rows
    return Network(words, start)


def score(net: Network, words: Lexicon, block: Block, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the sum of their conditional log-probabilities but for the logarithms of the own counts of words in groups; these words'
    texts and hashes."""
    hashes = word_hashes(block) if hashes is None else hashes
    ids = words.ids(hashes)
    logs = np.empty(len(ids))
    for at in range(0, len(ids), STEP):
        places = np.arange(at, min(len(ids), at + STEP))
        truth = ids[places]
        logs[places] = net.log_probabilities(net.context(ids, block.text, places), words.class_of[truth], words.cell_of[truth])
    rest = ids >= len(words.hashes)
    logs[rest] -= words.log_mass[ids[rest]]
    return block.counts, np.bincount(block.text, logs, block.n), block.text[rest], hashes[rest]


def pseudo_likelihood(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """Score every whole text by a network trained on all of them.

    Returns id_col, n_tokens, log_prob (the sum over all words) and mean_log_prob (null if there is no word). A null or
    empty text has no words and log_prob 0. Equal texts have equal scores, wherever they lie. Words are runs of anything but ASCII white space, A-Z lower-cased.
    Null and repeated ids are scored row by row; other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    counts = scratch.save(word_counts(docs, text_col))
    words = lexicon(counts, vocabulary)
    net = train(docs, words, text_col, rounds)

    def run(batch: pa.RecordBatch):
        made = []
        for block in blocks(batch.column(1), SCORE_BYTES):
            counts, sums, owner, rest = score(net, words, block)
            made.append((counts, sums, rest, np.bincount(owner, minlength=block.n)))
        n, sums, rest, sizes = (np.concatenate(x) for x in zip(*made))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return batch.column(0), n, sums, pa.ListArray.from_arrays(pa.array(offsets), pa.array(rest))

    # Each word of a group brings its own count.
    known = F.struct(F.xxhash64(text_col).alias("a"), F.crc32(utf8(text_col)).alias("b"), F.octet_length(utf8(text_col)).alias("n"))
    read = docs.select(F.struct(F.col(id_col).alias("id"), known.alias("text")).alias("_own"), utf8(text_col))
    made = map_batches(read, run, f"_own struct<id: {docs.schema[id_col].dataType.simpleString()}, text: struct<a: bigint, b: bigint, n: int>>, n_tokens bigint, log_prob double, rest array<bigint>").select("_own.*", "n_tokens", "log_prob", "rest").withColumnRenamed("id", "_id")
    made = scratch.save(made.withColumn("_row", F.monotonically_increasing_id()))
    several = counts.filter("n > 1")  # the logarithm of one adds nothing
    several = F.broadcast(several) if fits(counts) and counts.count() <= BROADCAST_KINDS else several
    own = made.select("_row", F.explode("rest").alias("hash")).join(several, "hash").groupBy("_row").agg(F.sum(F.log("n")).alias("own"))
    made = scratch.save(made.join(own, "_row", "left").select("_id", "text", "n_tokens", (F.col("log_prob") + F.coalesce("own", F.lit(0.0))).alias("log_prob")))
    # Sums in single precision depend on where a text lies among others: of equal texts that differ, the least counts for all.
    differ = made.groupBy("text").agg(F.min("log_prob").alias("least"), F.max("log_prob").alias("_most")).filter("least < _most").drop("_most")
    out = made.join(sized(differ, scratch), "text", "left").select(F.col("_id").alias(id_col), "n_tokens", F.coalesce("least", "log_prob").alias("log_prob"))
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
