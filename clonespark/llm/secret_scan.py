"""Secret scans with corpus-wide ownership frequency.

Each text's candidates (assignments, access keys, long hexadecimal runs, known key forms, passwords in addresses, private keys, random-looking
strings) leave as spans with a hash of their value. Values are counted by distinct repositories and owners over all texts: what many
owners have is a copied example; what few have, and looks like a credential, is one that may be live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import map_batches, sized, utf8
from clonespark.llm.words import blocks
from clonespark.scratch import Scratch

#: Owners up to which a value counts as owner-specific.
MOST_OWNERS = 3
#: Characters of a random-looking string, and bits a character that its own letters tell at least.
LEAST_RANDOM, LEAST_BITS = 20, 3.0

#: Kinds in the order in which spans of one start are told. The first three are the base, the others are added.
KINDS = ["assign", "access", "hex", "key", "url", "pem", "random"]
ASSIGN, ACCESS, HEX, KEY, URL, PEM, RANDOM = range(len(KINDS))

# Patterns of the base kinds. Lengths are looked at afterwards.
ASSIGNED = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""")
ACCESS_KEY = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# Public forms of keys, addresses with a password, private keys.
KEY_FORM = re.compile(rb"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|AIza|[sr]k_live_|npm_|hf_)[A-Za-z0-9_-]{16,}")
SIGNED = re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
ADDRESS = re.compile(rb"://[^\s:/@]{1,64}:([^\s:/@]{6,256})@")
PRIVATE = re.compile(rb"-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----")
PRIVATE_END = re.compile(rb"-----END (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----")
# Words that mark a value as made up.
MADE_UP = re.compile(rb"(?i)example|changeme|change_me|placeholder|dummy|sample|your[_-]|xxxx|\*\*\*\*|123456|abcdef|<|\$\{")

_ANCHORS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
_STRING = np.zeros(256, bool)
_STRING[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True


def bits_a_character(value: bytes) -> float:
    """Entropy of a value's own letters."""
    return sum(n / len(value) * math.log2(len(value) / n) for n in Counter(value).values())


def live_looking(value: bytes) -> bool:
    """Whether a value looks drawn at random: letters and digits, many different ones, no word of made-up values."""
    mixed = re.search(rb"[0-9]", value) and re.search(rb"[A-Za-z]", value)
    return bool(mixed) and not MADE_UP.search(value) and bits_a_character(value[:4096]) >= LEAST_BITS


def base_spans(text: bytes, hex_runs: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) of the base kinds, in bytes. Whatever precedes a value is ASCII, so matches are those of the text's characters."""
    low = text.lower()
    if any(a in low for a in _ANCHORS):
        for m in ASSIGNED.finditer(text):
            if len(m[2]) >= LEAST_ASSIGNED:
                yield m.start(), ASSIGN, m.end(), m[2]
    if b"AKIA" in text:
        for m in ACCESS_KEY.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                yield m.start(), ACCESS, m.end(), m[0]
    for a, b in hex_runs:
        yield a, HEX, b, text[a:b]


def further_spans(text: bytes, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) of what else looks like a credential, in bytes."""
    for a, b in runs:
        if m := KEY_FORM.match(text, a, b):
            yield a, KEY, m.end(), m[0]
    if b"eyJ" in text:
        for m in SIGNED.finditer(text):
            yield m.start(), KEY, m.end(), m[0]
    if b"://" in text:
        for m in ADDRESS.finditer(text):
            yield m.start(1), URL, m.end(1), m[1]
    if b"PRIVATE KEY-----" in text:
        at = 0
        while m := PRIVATE.search(text, at):
            end = PRIVATE_END.search(text, m.end())
            at = end.end() if end else m.end()
            yield m.start(), PEM, at, text[m.start() : at]
    for a, b in runs:
        if live_looking(text[a:b]):
            yield a, RANDOM, b, text[a:b]


def spans(text: bytes, hex_runs: list[tuple[int, int]], runs: list[tuple[int, int]]) -> list[tuple[int, int, int, bytes, bool]]:
    """(start, kind, end, hash of the value, whether it looks live) by start and kind, in bytes.

    Base spans of different kinds may overlap; of the others none overlaps a base span or one that stands before it in KINDS.
    """
    found = sorted(base_spans(text, hex_runs))
    taken = [(a, b) for a, _, b, _ in found]
    more = [x for x in further_spans(text, runs)] if runs or b"://" in text or b"eyJ" in text or b"PRIVATE KEY-----" in text else []
    if more:
        # of overlapping ones the earlier kind: intervals held in order of kind, then looked up by bisection over merged ones
        held = merged(taken)
        for kind in range(KEY, len(KINDS)):
            own = [x for x in sorted(more) if x[1] == kind and not overlaps(held, x[0], x[2])]
            last = -1
            for x in own:
                if x[0] >= last:
                    found.append(x)
                    last = x[2]
                    taken.append((x[0], x[2]))
            held = merged(taken)
    return [(a, k, b, hashlib.sha256(v).digest()[:16], k in (KEY, PEM) or live_looking(v)) for a, k, b, v in sorted(found)]


def merged(intervals: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the union of intervals, in order."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return np.array([a for a, _ in out], np.int64), np.array([b for _, b in out], np.int64)


def overlaps(held: tuple[np.ndarray, np.ndarray], a: int, b: int) -> bool:
    begins, ends = held
    at = int(np.searchsorted(begins, b)) - 1  # the last that begins before b
    return at >= 0 and int(ends[at]) > a


def code_points(text: bytes, at: list[int]) -> dict[int, int]:
    """Code points before each of the bytes given."""
    data, out, last, n = np.frombuffer(text, np.uint8), {}, 0, 0
    for x in sorted(set(at)):
        n += int(np.count_nonzero((data[last:x] & 0xC0) != 0x80))
        out[x], last = n, x
    return out


SPAN = "struct<start: bigint, kind: int, end: bigint, hash: binary, live: boolean>"
JUDGED = "struct<start: bigint, kind: int, end: bigint, live: boolean, owners: bigint>"


def _runs(block, table: np.ndarray, least: int) -> dict[int, list[tuple[int, int]]]:
    """Runs of the bytes in the table of that length at least, by text."""
    block.split(table)
    out: dict[int, list[tuple[int, int]]] = {}
    for w in np.flatnonzero(block.ends - block.starts >= least).tolist():
        t = int(block.text[w])
        out.setdefault(t, []).append((int(block.starts[w] - block.offsets[t]), int(block.ends[w] - block.offsets[t])))
    return out


def _scan(batch: pa.RecordBatch) -> list:
    told = []
    for block in blocks(batch.column(3)):
        hex_runs, runs = _runs(block, _HEX, LEAST_HEX), _runs(block, _STRING, LEAST_RANDOM)
        for t in range(block.n):
            text = block.data[block.offsets[t] : block.offsets[t + 1]].tobytes()
            found = spans(text, hex_runs.get(t, []), runs.get(t, []))
            place = code_points(text, [x for s in found for x in (s[0], s[2])]) if found else {}
            told.append([{"start": place[a], "kind": k, "end": place[b], "hash": h, "live": live} for a, k, b, h, live in found])
    return [batch.column(0), batch.column(1), batch.column(2), told]


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, repos, owners: in how many distinct repositories and owners a value is. candidates: hash, repo, owner.

    Copies are dropped before the shuffle and each count is summed before it too, so a value that a third of all texts hold is many tasks' work.
    """
    pairs = candidates.select("hash", "owner", "repo").distinct()
    return pairs.groupBy("hash", "owner").agg(F.count("*").alias("repos")).groupBy("hash").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", most_owners: int = MOST_OWNERS) -> DataFrame:
    """Credentials in every whole text, told apart from copied examples by who else has them.

    Returns for each row id_col, n_assign, n_access, n_hex (base spans), base_sha256 (of kind:start:end of each, by start and kind, joined by commas),
    spans (base spans, and those that the method adds: further kinds whose value looks live and at most most_owners owners have), n_live (spans whose
    value looks live and is owner-specific) and n_example (spans whose value more owners have). Places are code points, ends exclusive. A repository is what repo_col says (here a document by itself), an owner what
    owner_col says; null is one of them. A null or empty text has no spans. Rows with null or repeated ids are scanned each;
    other columns are ignored; an empty table gives an empty result. A row's spans are one task's: as many as its own text holds.
    """
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    owner = F.struct(F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"))
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), owner.alias("who"), utf8(text_col))
    scanned = scratch.save(map_batches(read, _scan, f"row bigint, id {kind}, who struct<owner: string, repo: string>, found array<{SPAN}>"))
    candidates = scanned.select("row", "who.owner", "who.repo", F.inline("found"))
    counted = sized(ownership(candidates).filter(F.col("owners") > most_owners), scratch)
    # widely held values are few, what isn't among them is owner-specific; both counts come back to the text
    judged = candidates.join(counted, "hash", "left").groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end", "live", "owners")).alias("judged"))
    every = scanned.filter(F.size("found") > 0).join(judged, "row").select("row", "id", "judged").unionByName(scanned.filter(F.size("found") == 0).select("row", "id"), allowMissingColumns=True)
    names = F.array(*map(F.lit, KINDS))
    in_order = lambda keep: F.concat_ws(",", F.transform(F.sort_array(F.filter("judged", keep)), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))
    none, base = F.array().cast(f"array<{JUDGED}>"), lambda s: s["kind"] <= HEX
    specific = lambda s: s["owners"].isNull()
    of = lambda k: F.size(F.filter("judged", lambda s: s["kind"] == k)).cast("bigint")
    return every.withColumn("judged", F.coalesce("judged", none)).select(
        F.col("id").alias(id_col), of(ASSIGN).alias("n_assign"), of(ACCESS).alias("n_access"), of(HEX).alias("n_hex"), F.sha2(in_order(base).cast("binary"), 256).alias("base_sha256"),
        in_order(lambda s: base(s) | (specific(s) & s["live"])).alias("spans"), F.size(F.filter("judged", lambda s: specific(s) & s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("judged", lambda s: s["owners"].isNotNull())).cast("bigint").alias("n_example"),
    )

