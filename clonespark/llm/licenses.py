"""License scans by diagonal voting.

Spark joins the rolling word k-gram hashes of all texts to the positions of the same k-grams in license templates.
Matches of one template on one diagonal (position in the text less position in the template) vote together;
neighbouring diagonals, as words left out or put in between make them, merge into one span; a span is verified
against the template's words before it counts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark.llm.common import map_batches, utf8
from clonespark.llm.license_texts import TEXTS
from clonespark.llm.words import ALNUM, LOWER, Block, blocks

K = 3
#: A span merges diagonals that differ by this many words at most.
MAX_SHIFT = 4
#: Words between two matches of one span, at most.
MAX_GAP = 12
#: Share of a template's words that a span has to cover in order.
MIN_COVER = 0.8

#: Phrases that count wherever their words stand in a row, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Texts of well-known notices, in part, and their labels (whole texts are in license_texts.py). A span may differ from them by some words.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the terms of the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "this work is licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@lru_cache(1 << 10)
def _words(text: str) -> tuple[str, ...]:
    return tuple(WORDS.findall(text.lower()))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    exact: bool  # a phrase that counts only whole, word for word


def templates(phrases: dict[str, str] | None = None, notices: list[tuple[str, str]] | None = None) -> list[Template]:
    base = [Template(label, tuple(text.split()), True) for text, label in (PHRASES if phrases is None else phrases).items()]
    more = [Template(label, _words(text), False) for label, text in (TEXTS + NOTICES if notices is None else notices)]
    if short := [t for t in base + more if len(t.words) < K]:
        raise ValueError(f"templates need {K} words at least: {short}")
    return base + more


def _block_grams(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    block.data = LOWER[block.data]
    block.split(ALNUM)
    return *block.grams(block.hashes(), K), np.concatenate(([0], np.cumsum(block.counts)))[:-1]


def template_positions(spark: SparkSession, found: list[Template]) -> DataFrame:
    """A row for each k-gram of each template: hash, its words, template, position. As large as the templates, no more."""
    rows = []
    for i, t in enumerate(found):
        (block,) = blocks(pa.array([" ".join(t.words)]))
        hashes, first, _ = _block_grams(block)
        rows += [(int(np.int64(h.astype(np.int64))), " ".join(t.words[p : p + K]), i, int(p)) for h, p in zip(hashes, first)]
    return spark.createDataFrame(rows, "hash long, gram string, template int, position int")


#: Rows that leave a task together.
ROWS = 1 << 17
#: The hash under which a text's own row, with its number of words, passes the join.
MARK = -1


def _rolling(known: np.ndarray):
    """All k-gram hashes of a text with their places, and one row with MARK for the text itself.

    A gram's words come along where its hash is one of the templates', so that equal hashes can be verified.
    """

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(1)):
            hashes, first, begin = _block_grams(block)
            hashes = hashes.astype(np.int64)
            hashes[hashes == MARK] = MARK - 1
            yield batch.column(0).slice(block.first, block.n), np.full(block.n, MARK), block.counts.astype(np.int32), pa.nulls(block.n, pa.string())
            for low in range(0, len(hashes), ROWS):
                part, at = hashes[low : low + ROWS], first[low : low + ROWS]
                owner, grams = block.text[at], np.full(len(part), None, object)
                for p in np.flatnonzero(np.isin(part, known)).tolist():
                    words = range(at[p], at[p] + K)
                    grams[p] = b" ".join(block.data[block.starts[q] : block.ends[q]].tobytes() for q in words).decode("utf-8", "replace")
                yield batch.column(0).take(pa.array(owner + block.first)), part, (at - begin[owner]).astype(np.int32), pa.array(grams, pa.string())

    return run


def _many(df: DataFrame, function, schema: str) -> DataFrame:
    """As map_batches, for a function that gives several batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    from clonespark.llm.common import _as, release_memory

    kinds = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in function(batch) if batch.num_rows else ():
                yield pa.RecordBatch.from_arrays([_as(x, f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)
            release_memory()

    return df.mapInArrow(run, kinds)


def merged(diagonals: list[dict]) -> Iterator[list[tuple[int, int]]]:
    """Spans of one template in one text, as (place, position in the template) of each matching gram.

    diagonals: each with its offset and the template positions that match on it. Diagonals within MAX_SHIFT of each other
    merge where their matches follow each other in both the text and the template, at most MAX_GAP apart.
    """
    hits = sorted((d["diagonal"] + p, p) for d in diagonals for p in d["positions"])
    open_: list[list[tuple[int, int]]] = []
    for place, p in hits:
        fits = [s for s in open_ if s[-1][0] < place <= s[-1][0] + MAX_GAP and s[-1][1] < p and abs((place - p) - (s[-1][0] - s[-1][1])) <= MAX_SHIFT]
        done = [s for s in open_ if s[-1][0] + MAX_GAP < place]
        yield from done
        open_ = [s for s in open_ if s[-1][0] + MAX_GAP >= place]
        if fits:
            # the nearest diagonal goes on
            min(fits, key=lambda s: (abs((place - p) - (s[-1][0] - s[-1][1])), -s[-1][0])).append((place, p))
        else:
            open_.append([(place, p)])
    yield from open_


def spans(found: list[Template], matches: list[dict]) -> list[tuple[int, int, int, float]]:
    """Verified spans of a text: template, first word, last start of a matching gram, share of the template covered.

    Phrases count wherever they stand. Notices that overlap say the same words in different ways: the best stays.
    """
    by: dict[int, list[dict]] = {}
    for m in matches:
        by.setdefault(m["template"], []).append(m)
    out, notices = [], []
    for i in sorted(by):
        t, need = found[i], len(found[i].words) - K + 1
        if t.exact:
            for d in by[i]:
                if d["votes"] >= need:
                    held = sorted(d["positions"])
                    if held == list(range(need)):
                        out.append((i, d["diagonal"], d["diagonal"], 1.0))
            continue
        for s in merged(by[i]):
            covered = {p + j for _, p in s for j in range(K)}
            if len(covered) >= MIN_COVER * len(t.words):
                notices.append((-len(covered), i, s[0][0], s[-1][0], len(covered) / len(t.words)))
    begins, ends = [], []  # of notices taken, which lie apart, in order
    for _, i, first, last, cover in sorted(notices):  # of notices that overlap, the one that covers most words
        at = bisect_right(begins, first)
        if (not at or ends[at - 1] <= first) and (at == len(begins) or last + K <= begins[at]):
            begins.insert(at, first)
            ends.insert(at, last + K)
            out.append((i, first, last, cover))
    return out


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """License phrases and notices in every whole text.

    Returns id_col, n_words, n_base (places of all phrases), first_word and last_word (the least and greatest word at which
    one starts; null if none), base_labels, labels (also of the notices; distinct, sorted, joined by commas),
    score (the largest share of a template that a span covers, 0 to 1) and spans (label, first_word, cover). Words are runs of ASCII letters, digits
    and characters beyond ASCII, A-Z lower-cased. A null or empty text has no words and no license: zeros, nulls and empty strings. Rows
    are scanned one by one, also those with null or repeated ids; other columns are ignored; an empty table gives an empty result.
    """
    spark, found = docs.sparkSession, templates(phrases, notices)
    positions = template_positions(spark, found)
    known = np.array(sorted({r["hash"] for r in positions.collect()}), np.int64)
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id")).alias("key"), utf8(text_col))
    grams = _many(keyed, _rolling(known), f"key struct<row: bigint, id: {kind}>, hash bigint, place int, gram string")
    marks = positions.unionAll(spark.createDataFrame([(MARK, None, MARK, 0)], positions.schema)).withColumnRenamed("gram", "template_gram")
    hits = grams.join(F.broadcast(marks), "hash").filter((F.col("template") == MARK) | (F.col("gram") == F.col("template_gram")))
    diagonal = F.when(F.col("template") == MARK, 0).otherwise(F.col("place") - F.col("position"))
    votes = hits.groupBy("key", "template", diagonal.alias("diagonal")).agg(
        F.count("*").alias("votes"), F.collect_list("position").alias("positions"), F.max("place").alias("n_words")
    )
    texts = votes.groupBy("key").agg(
        F.max(F.when(F.col("template") == MARK, F.col("n_words"))).cast("bigint").alias("n_words"),
        F.collect_list(F.when(F.col("template") != MARK, F.struct("template", "diagonal", "votes", "positions"))).alias("matches"),
    )

    def run(batch: pa.RecordBatch):
        out = []
        for matches in batch.column(2).to_pylist():
            verified = spans(found, matches)
            base = [s[1] for s in verified if found[s[0]].exact]
            out.append(
                (
                    len(base), min(base, default=None), max(base, default=None),
                    ",".join(sorted({found[s[0]].label for s in verified if found[s[0]].exact})),
                    ",".join(sorted({found[s[0]].label for s in verified})),
                    max((s[3] for s in verified), default=0.0),
                    [{"label": found[s[0]].label, "first_word": s[1], "cover": s[3]} for s in verified],
                )
            )
        return [batch.column(0), batch.column(1), *zip(*out)]

    flat = texts.select(F.col("key.id").alias(id_col), "n_words", "matches")
    return map_batches(flat, run, f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label: string, first_word: bigint, cover: double>>")
