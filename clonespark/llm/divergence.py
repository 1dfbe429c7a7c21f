"""Source divergence audit: how far the terms of each source of a language are from those of the others, and which terms it favours.

Terms are dealt to blocks. A block is a dense table of whole numbers, sources by terms; all pairs of its sources are compared at once
by broadcasting, and each source's terms go through a heap. Sums over blocks give the pairs, merged heaps the terms.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clonespark.llm.common import bound_batches, release_memory, sized, utf8
from clonespark.llm.words import LOWER
from clonespark.scratch import Scratch

#: Documents of its language that a term has to be in.
LEAST_DOCS = 30
#: Added to each count.
PRIOR = 5
#: Parts into which a probability is cut, in three steps of STEP, so that no product leaves a long up to 9e15 terms.
PARTS, STEP = 1_000_000_000, 1_000
#: Terms that are told of each source.
TOP = 50
#: Terms of a block, about, and sources of a tile of it.
TERMS, TILE = 2_048, 64
#: Distinct (group, term) that a task counts before it hands them on, and bytes of a text that are cut into words together.
HELD, PIECE = 1 << 18, 1 << 20

#: Letters of ASCII in lower case and bytes beyond; all else parts terms.
TERM_BYTES = bytes(b if b > 0x7F or 0x61 <= b <= 0x7A else 0x20 for b in LOWER.tolist())


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):  # to the end of the run that holds the boundary
            rest = text[end : end + PIECE].translate(TERM_BYTES).find(b" ")
            while rest < 0 and end < len(text):
                end += PIECE
                rest = text[end : end + PIECE].translate(TERM_BYTES).find(b" ")
            end += max(rest, 0)
        yield text[at:end].translate(TERM_BYTES).split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of each group; each group also has a row for the term ''."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in found.items():
            kinds = list(docs)
            for at in range(0, len(kinds), 1 << 16):
                part = kinds[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array([k.decode("utf-8", "replace") for k in part]), pa.array([times[k] for k in part], pa.int64()), pa.array([docs[k] for k in part], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
        found.clear()
        release_memory()

    for batch in batches:
        for group, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)):
            times, docs = found.setdefault(group, (Counter(), Counter()))
            own: set[bytes] = {b""}
            for words in term_pieces(text.as_py()):
                times.update(words)
                own.update(words)
            docs.update(own)
        if sum(len(d) for _, d in found.values()) > HELD:
            yield from told()
    yield from told()


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it)."""
    bound_batches(docs.sparkSession)
    read = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")), F.coalesce(F.col(source_col).cast("string"), F.lit("")), utf8(text_col))
    parts = read.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: np.ndarray, total: np.ndarray, kinds: int) -> np.ndarray:
    """1 + floor(PARTS * (count + PRIOR) / (total + PRIOR * kinds)), by long division."""
    whole = total + PRIOR * kinds
    out, rest = np.divmod(count + PRIOR, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * STEP, whole)
        out = out * STEP + digit
    return out + 1


def _tile(top: int, size: int):
    """Of a block of terms and two tiles of sources: sums for each pair, and (if it is one tile) each source's first terms."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, tile_a, tile_b = key[0].as_py(), key[2].as_py(), key[3].as_py()
        headed = pc.is_null(rows["term"])
        heads = rows.filter(headed).sort_by("idx")
        cells = rows.filter(pc.invert(headed))
        number = heads["idx"].to_numpy()
        names, totals, kinds = heads["source"].to_pylist(), heads["total"].to_numpy(), heads["kinds"][0].as_py()
        coded = cells["term"].combine_chunks().dictionary_encode()
        terms = coded.dictionary.to_pylist()
        term, source = coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(number, cells["idx"].to_numpy())
        counts = np.zeros((len(names), len(terms)), np.int64)
        counts[source, term] = cells["n"].to_numpy()
        p = probability(counts, totals[:, None], kinds) if kinds else counts
        out: list[tuple[str, str, str, int]] = []
        a, b = np.flatnonzero(number // size == tile_a), np.flatnonzero(number // size == tile_b)
        unseen = probability(np.zeros(len(names), np.int64), totals, kinds) if kinds else totals  # of a term that none of these sources has
        absent = heads["block_kinds"][0].as_py() - len(terms)
        for i in a.tolist():
            sums = (np.abs(p[i] - p[b]).sum(1) + absent * np.abs(unseen[i] - unseen[b])).tolist()
            for j, f in zip(b.tolist(), sums):
                if i != j:
                    out.append((names[i], "pair", names[j], f))
                    if tile_a != tile_b:
                        out.append((names[j], "pair", names[i], f))
        if tile_a == tile_b and kinds:
            everywhere = np.zeros(len(terms), np.int64)
            everywhere[term] = cells["total"].to_numpy()
            q = probability(everywhere, heads["lang_total"].to_numpy()[:1], kinds)
            for i in a.tolist():
                over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                best = heapq.nsmallest(top, ((-f, terms[t]) for t, f in zip(over.tolist(), (p[i] - q)[over].tolist())))
                out += [(names[i], "term", t, -f) for f, t in best]
        columns = list(zip(*out)) or [[], [], [], []]
        kinds_of = [pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.table([pa.array([lang] * len(out), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds_of))], names=["lang", "source", "part", "item", "value"])

    return run


def divergence(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, terms: int = TERMS, tile: int = TILE) -> DataFrame:
    """For each source of each language: its distance from every other (part `pair`), and the terms that it has more often than the language (part `term`).

    Returns lang, source, part, item (the other source, or the term), value, rank (from 1 in each group and part, by falling value, then by item).
    Terms are runs of ASCII letters (A-Z lower-cased) and characters beyond ASCII; a language keeps those of at least
    least_docs of its documents. All numbers are whole and exact. Null text, language and source count as empty; a source without any kept term has a
    row for each pair all the same; a language with one source has no pairs. Repeated rows are documents each. Other
    columns are ignored; an empty table gives an empty result. Sources of a language are numbered in one window: as many rows as it has sources.
    """
    scratch = Scratch(docs.sparkSession)
    counts = scratch.save(term_counts(docs, text_col, lang_col, source_col))
    kept = sized(counts.filter("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).filter(F.col("docs") >= least_docs).drop("docs"), scratch)
    cells = counts.drop("docs").join(kept, ["lang", "term"])
    langs = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = counts.filter("term = ''").select("lang", "source").withColumns({"idx": F.row_number().over(by_lang.orderBy("source")) - 1, "sources": F.count("*").over(by_lang)})
    heads = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kinds", "lang_total"])
    heads = sized(heads.withColumns({"blocks": F.greatest(F.ceil(F.col("kinds") / terms), F.lit(1)).cast("int"), "tiles": F.ceil(F.col("sources") / tile).cast("int"), "tile": (F.col("idx") / tile).cast("int")}), scratch)

    def to_tiles(rows: DataFrame) -> DataFrame:
        with_tile = rows.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return with_tile.withColumns({"a": F.least("tile", "u"), "b": F.greatest("tile", "u")})

    in_block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    filled = kept.join(heads.select("lang", "blocks").distinct(), "lang").groupBy("lang", in_block).agg(F.count("*").alias("block_kinds"))
    own = to_tiles(cells.join(heads.drop("total"), ["lang", "source"])).select("lang", in_block, "a", "b", "idx", "source", "term", "n", "total", "kinds", "lang_total", F.lit(None).cast("bigint").alias("block_kinds"))
    spread = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(filled, ["lang", "block"], "left").na.fill(0, ["block_kinds"])
    head = to_tiles(spread).select("lang", "block", "a", "b", "idx", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"), "total", "kinds", "lang_total", "block_kinds")
    parts = scratch.save(own.unionAll(head).groupBy("lang", "block", "a", "b").applyInArrow(_tile(top, tile), "lang string, source string, part string, item string, value bigint"))
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(parts.filter("part = 'term'")).filter(F.col("rank") <= top))
