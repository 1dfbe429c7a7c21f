"""Token counts: batches of texts are encoded in Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import map_batches, utf8

#: A text of more characters than this is cut at safe boundaries.
PIECE_CHARS = 32_768
#: Texts and pieces are encoded together until they hold so many bytes.
BATCH_BYTES = 1 << 20
#: Places where no byte-level token spans: before ASCII white space that follows no white space, and
#: between an ASCII letter and a digit. The pattern never looks behind, and special strings hold
#: neither white space nor digits (see byte_level), so a cut there leaves the count as it is.
SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@lru_cache(4)
def tokenizer(path: str):
    """The counting function of a tokenizer file: list of texts to list of lengths."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return lambda texts: [len(x.ids) for x in found.encode_batch_fast(texts, add_special_tokens=False)]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text where no token can span; what has no such place stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut or cut.start() >= len(text):
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def lengths(texts: list[str], path: str, split: bool) -> np.ndarray:
    """Tokens of each text. Pieces are encoded in order of length, so that a batch holds like sizes."""
    count = tokenizer(path)
    out, owner, parts = np.zeros(len(texts), np.int64), [], []
    for i, text in enumerate(texts):
        for part in pieces(text) if split else [text]:
            owner.append(i)
            parts.append(part)
    sizes = [len(p) if p.isascii() else len(p.encode()) for p in parts]
    order = sorted(range(len(parts)), key=sizes.__getitem__)
    at = 0
    while at < len(order):
        end, held = at, 0
        while end < len(order) and (end == at or held + sizes[order[end]] <= BATCH_BYTES):
            held += sizes[order[end]]
            end += 1
        chosen = order[at:end]
        np.add.at(out, [owner[k] for k in chosen], count([parts[k] for k in chosen]))
        at = end
    return out


def byte_level(path: str) -> bool:
    """True if the tokenizer splits texts by the byte-level pattern, for which SAFE holds."""
    if not path.endswith(".json"):
        return False
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    specials = [x["content"] for x in spec.get("added_tokens", [])]
    plain = all(not re.search(r"[\s0-9]", x) for x in specials) and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens", []))
    return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and plain


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text.

    path: a tokenizers .json or a sentencepiece .model file, present on every executor. Returns id_col,
    n_bytes, n_tokens, over_limit (n_tokens > limit). A null text counts as empty (0, 0, false); rows
    with null or repeated ids are counted one by one; other columns are ignored; an empty table gives
    an empty result. Texts over PIECE_CHARS are cut where no token can span, which leaves counts as
    they are; only tokenizers for which that is known (byte_level) are cut.
    """
    split = bool(byte_level(path))

    def run(batch: pa.RecordBatch):
        texts = [x.decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
        n = lengths(texts, path, split)
        sizes = pa.compute.binary_length(batch.column(1))
        return batch.column(0), sizes, n, n > limit

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col), utf8(text_col)), run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
