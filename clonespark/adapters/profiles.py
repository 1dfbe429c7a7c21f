"""Multiple alignment of a cluster's sequences: distances from shared words, a guide tree, and alignment of profiles along it with weights for sequences much alike."""

from __future__ import annotations

from collections import Counter

import numpy as np

from clonespark.operators.graph import upgma

#: Letters of the words that are counted.
WORD = 4
#: Scores of equal and unequal letters, cost of opening a gap and of each place in it.
EQUAL, UNEQUAL, OPEN, EXTEND = 1.0, -1.0, 2.0, 0.5
LETTERS = "ACGTN"
GAP = len(LETTERS)
_CODE = np.full(256, LETTERS.index("N"), np.uint8)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i
_CODE[ord("-")] = GAP
_SCORES = np.where(np.eye(len(LETTERS), dtype=bool), EQUAL, UNEQUAL)


def word_distances(seqs: list[str], word: int = WORD) -> np.ndarray:
    """One less the share of words that two sequences have in common, of the shorter one's words."""
    counts = [Counter(s[i : i + word] for i in range(max(1, len(s) - word + 1))) for s in seqs]
    kinds = {w: k for k, w in enumerate(sorted(set().union(*counts)))}
    table = np.zeros((len(seqs), len(kinds)), np.int32)
    for row, c in zip(table, counts):
        row[[kinds[w] for w in c]] = list(c.values())
    sizes = table.sum(1)
    out = np.empty((len(seqs), len(seqs)))
    for i in range(len(seqs)):
        out[i] = 1 - np.minimum(table[i], table).sum(1) / np.minimum(sizes[i], sizes)
    return out


def tree_weights(edges: list[tuple[str, str, float]], leaves: list[str]) -> dict[str, float]:
    """Weights of leaves: each branch's length is shared by the leaves below it, so that those much alike count less each. All one if no branch has a length."""
    children: dict[str, list[tuple[str, float]]] = {}
    for a, b, length in edges:
        children.setdefault(a, []).append((b, length))
    below = {x: 1 for x in leaves}
    for a, b, _ in edges:  # children come before their parents' own edges
        below[a] = below.get(a, 0) + below[b]
    weight, stack = {}, [(edges[-1][0], 0.0)] if edges else [(leaves[0], 0.0)]
    while stack:
        node, held = stack.pop()
        if node not in children:
            weight[node] = held
        for child, length in children.get(node, ()):
            stack.append((child, held + length / below[child]))
    total = sum(weight.values())
    return {x: w * len(leaves) / total + 1e-3 for x, w in weight.items()} if total > 0 else dict.fromkeys(leaves, 1.0)


def profile(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted shares of letters and gaps (last) of each column."""
    out = np.stack([(weights[:, None] * (rows == k)).sum(0) for k in range(GAP + 1)], 1)
    return out / weights.sum()


def align_profiles(p: np.ndarray, q: np.ndarray) -> list[int]:
    """Steps of the best alignment of two profiles' columns: 0 both, 1 the first's alone, 2 the second's alone. A gap costs by how full the columns are that it faces."""
    m, n = len(p), len(q)
    pairs = p[:, :GAP] @ _SCORES @ q[:, :GAP].T
    full_p, full_q = 1 - p[:, GAP], 1 - q[:, GAP]
    reach = np.concatenate(([0.0], np.cumsum(EXTEND * full_q)))
    h, up = np.full((m + 1, n + 1), -np.inf), np.full(n + 1, -np.inf)
    rises, up_goes, lefts, left_from = *(np.zeros((m + 1, n + 1), bool) for _ in range(3)), np.zeros((m + 1, n + 1), np.int32)
    places = np.arange(n + 1)
    for i in range(m + 1):
        best = np.full(n + 1, -np.inf)
        if i == 0:
            best[0] = 0.0
        else:
            best[1:] = h[i - 1, :-1] + pairs[i - 1]
            opened = h[i - 1] - OPEN * full_p[i - 1]
            up_goes[i] = up > opened
            up = np.maximum(up, opened) - EXTEND * full_p[i - 1]
            rises[i] = up > best
            best = np.maximum(best, up)
        begins = best + reach - np.append(OPEN * full_q, 0.0)
        run = np.maximum.accumulate(begins)
        at = np.maximum.accumulate(np.where(begins == run, places, 0))
        left = np.full(n + 1, -np.inf)
        left[1:] = run[:-1] - reach[1:]
        left_from[i, 1:] = at[:-1]
        lefts[i] = left > best
        h[i] = np.maximum(best, left)
    steps, i, j, rising, begun = [], m, n, False, False
    while i or j:
        if lefts[i, j] and not rising and not begun:  # back to where the gap begins, in a pair or in a gap of the other
            steps += [2] * (j - int(left_from[i, j]))
            j, begun = int(left_from[i, j]), True
        elif rising or rises[i, j]:
            steps.append(1)
            rising, begun = bool(up_goes[i, j]), False
            i -= 1
        else:
            steps.append(0)
            i, j, begun = i - 1, j - 1, False
    return steps[::-1]


def _spread(rows: np.ndarray, steps: list[int], alone: int) -> np.ndarray:
    """Rows with gaps where the other side stands alone."""
    has = np.array([s in (0, alone) for s in steps])
    out = np.full((len(rows), len(steps)), GAP, np.uint8)
    out[:, has] = rows
    return out


def progressive(seqs: list[str]) -> list[str]:
    """Rows of one length for the sequences, aligned along their guide tree."""
    if len(seqs) == 1:
        return list(seqs)
    names = [str(i) for i in range(len(seqs))]
    edges = upgma(names, word_distances(seqs))
    weights = tree_weights(edges, names)
    held = {x: ([i], _CODE[np.frombuffer(s.encode("ascii", "replace"), np.uint8)][None, :]) for i, (x, s) in enumerate(zip(names, seqs))}
    own = np.array([weights[x] for x in names])
    for (node, a, _), (_, b, _) in zip(edges[::2], edges[1::2]):
        (left, x), (right, y) = held.pop(a), held.pop(b)
        steps = align_profiles(profile(x, own[left]), profile(y, own[right]))
        held[node] = (left + right, np.concatenate((_spread(x, steps, 1), _spread(y, steps, 2))))
    order, rows = held[edges[-1][0]]
    out = [""] * len(seqs)
    for i, row in zip(order, rows):
        letters = iter(seqs[i])
        out[i] = "".join("-" if c == GAP else next(letters) for c in row)
    return out


def pair_sum(rows: list[str]) -> float:
    """Sum over all pairs of rows: equal and unequal letters by their scores, a letter against a gap costs OPEN; from counts by column."""
    table = np.array([np.frombuffer(r.encode("ascii", "replace"), np.uint8) for r in rows])
    total = 0.0
    counts = np.stack([(table == c).sum(0) for c in np.unique(table) if c != ord("-")]) if table.size else np.zeros((0, 0))
    letters = counts.sum(0)
    same = (counts * (counts - 1) / 2).sum(0)
    total += EQUAL * same.sum() + UNEQUAL * (letters * (letters - 1) / 2 - same).sum() - OPEN * (letters * (len(rows) - letters)).sum()
    return float(total)


#: Passes in which each row is taken out and aligned anew with the others.
PASSES = 2


def refined(rows: list[str]) -> list[str]:
    """Rows after each was taken out and aligned anew with the profile of the others, where that raises the sum over pairs."""
    score = pair_sum(rows)
    for _ in range(PASSES):
        before = score
        for i in range(len(rows)):
            rest = np.array([_CODE[np.frombuffer(r.encode("ascii", "replace"), np.uint8)] for k, r in enumerate(rows) if k != i])
            held = ~(rest == GAP).all(0)
            one = rows[i].replace("-", "")
            row = _CODE[np.frombuffer(one.encode("ascii", "replace"), np.uint8)][None, :]
            steps = align_profiles(profile(row, np.ones(1)), profile(rest[:, held], np.ones(len(rest))))
            places, letters = iter(np.flatnonzero(held).tolist()), iter(one)
            columns = [next(places) if s != 1 else None for s in steps]
            new = ["".join("-" if c is None else r[c] for c in columns) for k, r in enumerate(rows) if k != i]
            new.insert(i, "".join(next(letters) if s != 2 else "-" for s in steps))
            if (better := pair_sum(new)) > score:
                rows, score = new, better
        if score == before:
            break
    return rows
