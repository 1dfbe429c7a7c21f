"""Byte-level BPE with a hierarchical-bitmap rank queue.

The pre-tokens of a batch lie end to end in one linked list. A bucket for each merge rank holds the list
positions whose pair has that rank; a bitmap of three levels tells which buckets hold anything, and
find-first-set picks the lowest. An entry whose pair has changed meanwhile is stale and skipped. So the work
doesn't depend on how long a pre-token is: a text of a million letters costs what a thousand texts of
a thousand cost, where repeated scans for the lowest pair would be quadratic.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import map_batches, utf8

#: Encoded pre-tokens that a worker keeps, in bytes of keys and ids; when full, it starts anew.
CACHE_BYTES = 16 << 20
#: Bytes of text whose pre-tokens are encoded together.
GROUP_BYTES = 2 << 20
WORD = 64


class RankQueue:
    """Lists of positions by rank. A bitmap of three levels, 64 to one, finds the lowest rank in use."""

    def __init__(self, n_ranks: int) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * (-(-n_ranks // WORD))
        self.mid = [0] * (-(-len(self.low) // WORD))
        self.top = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            heads = ranks[np.concatenate(([0], cuts))].tolist()
            parts = np.split(positions, cuts) if len(cuts) else [positions]
        else:
            heads, parts = ranks.tolist(), [positions]
        for rank, part in zip(heads, parts):
            held = self.buckets.get(rank)
            if held is None:
                self.buckets[rank] = [part]
                self.mark(rank)
            else:
                held.append(part)

    def mark(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def lowest(self) -> int:
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | ((m := self.mid[a]) & -m).bit_length() - 1
        return b << 6 | ((m := self.low[b]) & -m).bit_length() - 1

    def clear(self, rank: int) -> None:
        a, b = rank >> 12, rank >> 6
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions in ascending order."""
        if not self.top:
            return None
        rank = self.lowest()
        self.clear(rank)
        parts = self.buckets.pop(rank)
        return rank, np.unique(np.concatenate(parts) if len(parts) > 1 else parts[0])


class SingleQueue(RankQueue):
    """The same queue for one position at a time: a bucket is a heap, so the others of a rank stay where they are."""

    def put(self, rank: int, position: int) -> None:
        held = self.buckets.get(rank)
        if held is None:
            self.buckets[rank] = [position]
            self.mark(rank)
        else:
            heapq.heappush(held, position)

    def take(self) -> tuple[int, int] | None:
        """The leftmost position of the lowest rank."""
        if not self.top:
            return None
        rank = self.lowest()
        held = self.buckets[rank]
        position = heapq.heappop(held)
        if not held:
            del self.buckets[rank]
            self.clear(rank)
        return rank, position


class BytePairs:
    """A rank file: bytes in base64 and rank on each line; a token's id is its rank."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.n = max(self.ranks.values()) + 1
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.n + right] = rank
        self.keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.key_ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.by_byte = np.full((256, 256), -1, np.int32)
        for a in range(256):
            self.by_byte[a] = self.pair_ranks(np.full(256, self.byte_ids[a]), self.byte_ids)
        tokens = [b""] * self.n
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_sizes = np.array([len(x) for x in tokens], np.int64)
        self.token_starts = np.concatenate(([0], np.cumsum(self.token_sizes)))[:-1]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.cache: dict[str, np.ndarray] = {}
        self.cached = 0

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what each pair merges to; -1: nothing."""
        wanted = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (a pre-token), all words in one queue."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if not sizes.sum():
            return [np.zeros(0, np.int64) for _ in words]
        data = np.frombuffer(b"".join(words), np.uint8)
        n, ends = len(data), np.cumsum(sizes)
        ids = np.append(self.byte_ids[data], -1).astype(np.int32)
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        live, pair = np.ones(n + 1, bool), np.full(n + 1, -1, np.int32)
        last = np.zeros(n + 1, bool)  # the last token of a word so far: nothing merges across words
        last[ends[sizes > 0] - 1] = True
        pair[: n - 1] = self.by_byte[data[:-1], data[1:]]
        pair[last] = -1
        live[n], last[n] = False, True
        word_of = None
        again: set[int] = set()
        queue = RankQueue(self.n)
        start = np.flatnonzero(pair >= 0).astype(np.int32)
        queue.push(pair[start], start)
        while found := queue.pop():
            rank, at = found
            at = at[(pair[at] == rank) & live[at]]  # the others are stale
            if not len(at):
                continue
            # of runs like a a a, where each pair overlaps the next, every other one merges, from the left
            if len(at) > 1 and (linked := after[at[:-1]] == at[1:]).any():
                heads = np.concatenate(([True], ~linked))
                order = np.arange(len(at))
                at = at[(order - np.maximum.accumulate(np.where(heads, order, 0))) % 2 == 0]
            gone = after[at]
            hasty = at[:0]
            if len(at) > 1 and (touch := after[gone[:-1]] == at[1:]).any():
                # merges side by side: between the first and the second, a pair of a lower rank could have come
                first = at[:-1][touch]
                between = self.pair_ranks(np.full(len(first), rank), ids[at[1:][touch]])
                hasty = first[(between >= 0) & (between < rank)]
            ids[at], live[gone], pair[gone] = rank, False, -1
            last[at] = last[gone]
            nxt = after[gone]
            after[at] = nxt
            before[nxt] = at
            # the merged token's pair with what follows, and that of what goes before with it
            end = last[at]
            new = np.full(len(at), -1, np.int32)
            go = ~end
            if go.any():
                new[go] = self.pair_ranks(ids[at[go]], ids[nxt[go]])
            pair[at] = new
            prev = before[at]
            ok = (prev >= 0) & ~last[prev]
            prev = prev[ok]
            new_prev = self.pair_ranks(ids[prev], ids[at[ok]])
            pair[prev] = new_prev
            push, ranks = np.concatenate((at, prev)), np.concatenate((new, new_prev))
            held = ranks >= 0
            push, ranks = push[held], ranks[held]
            if len(hasty) or (ranks < rank).any():
                # A merge that ought to have come before later ones of this very rank: take its word alone.
                if word_of is None:
                    word_of = np.repeat(np.arange(len(words)), sizes)
                again.update(word_of[np.concatenate((push[ranks < rank], hasty))].tolist())
            queue.push(ranks, push)
        kept = np.flatnonzero(live[:n])
        counts = np.add.reduceat(np.append(live[:n], False).astype(np.int64), np.concatenate(([0], ends[:-1])))
        counts[sizes == 0] = 0
        out = np.split(ids[kept], np.cumsum(counts)[:-1])
        for w in again:
            out[w] = np.array(self.encode_alone(words[w]), np.int64)
        return out

    def encode_alone(self, word: bytes) -> list[int]:
        """One word by the same queue, one merge at a time: the leftmost pair of the lowest rank first."""
        ids = [int(self.byte_ids[b]) for b in word]
        n = len(ids)
        after, before, live = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        rank_of = lambda i: int(self.pair_ranks(np.array([ids[i]]), np.array([ids[after[i]]]))[0]) if after[i] < n else -1
        pair = [rank_of(i) for i in range(n)]
        queue = SingleQueue(self.n)
        for i in range(n):
            if pair[i] >= 0:
                queue.put(pair[i], i)
        while found := queue.take():
            rank, i = found
            if not live[i] or pair[i] != rank:
                continue  # stale
            j = after[i]
            ids[i], live[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0:
                    pair[k] = rank_of(k)
                    if pair[k] >= 0:
                        queue.put(pair[k], k)
        return [ids[i] for i in range(n) if live[i]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        split = [self.pattern.findall(x) for x in texts]
        if self.cached > CACHE_BYTES:
            self.cache, self.cached = {}, 0
        cache = self.cache
        new = list(dict.fromkeys(w for w in chain.from_iterable(split) if w not in cache))
        raw = [w.encode() for w in new]
        for word, ids in zip(new, self.encode_words(raw)):
            cache[word] = ids.astype("<u4").tobytes()
            self.cached += len(word) + 4 * len(ids) + 100
        return [np.frombuffer(b"".join([cache[w] for w in words]), "<u4") for words in split]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, end to end."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.token_bytes[np.arange(ends[-1]) + np.repeat(self.token_starts[ids] - ends + sizes, sizes)].tobytes()


@lru_cache(4)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def _encoded(batch: pa.RecordBatch, path: str, pattern: str):
    """Texts' ids, in groups of bounded size."""
    pairs = byte_pairs(path, pattern)
    group, held = [], 0
    for x in batch.column("_bytes"):
        raw = x.as_py()
        group.append(raw.decode("utf-8", "replace"))
        held += len(raw)
        if held >= GROUP_BYTES:
            yield from pairs.encode(group)
            group, held = [], 0
    yield from pairs.encode(group)


def bpe_encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: id_col, n_tokens, ids (array<int>).

    path: a file of ranks, present on every executor; pattern: what splits texts into pre-tokens, each of
    which is encoded by itself; characters it doesn't match are left out, as its library does. No special
    tokens: their strings are ordinary text. A null text counts as empty (no ids). Rows with null or
    repeated ids are encoded one by one; other columns are ignored; an empty table gives an empty result.
    """

    def run(batch: pa.RecordBatch):
        ids = list(_encoded(batch, path, pattern))
        sizes = np.array([len(x) for x in ids], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if len(ids) else np.zeros(0, np.int32)
        return batch.column(0), sizes, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return map_batches(docs.select(F.col(id_col), utf8(text_col).alias("_bytes")), run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of each list of ids: id_col, decoded (binary). Null ids count as an empty list.

    Unknown ids are an error.
    """

    def run(batch: pa.RecordBatch):
        pairs = byte_pairs(path, pattern)
        return batch.column(0), pa.array([pairs.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()], pa.binary())

    return map_batches(encoded.select(id_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>"))), run, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, decoded binary")


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and give digests of both.

    Returns id_col, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (of the decoded bytes), in lowercase hex. Nulls and the rest as in bpe_encode; the
    digests of an empty text are those of no bytes.
    """

    def run(batch: pa.RecordBatch):
        pairs = byte_pairs(path, pattern)
        sizes, digests, decoded = [], [], []
        for ids in _encoded(batch, path, pattern):
            sizes.append(len(ids))
            digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
            decoded.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
        return batch.column(0), sizes, digests, decoded

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col), utf8(text_col).alias("_bytes")), run, f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
