"""Token counts of whole texts with a public tokenizer, without keeping any token."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import add_columns, text_bytes, words_of

#: Bytes per call of the encoder.
CALL_BYTES = 256 << 10

#: Pieces whose token count a Python worker remembers between slices, at most.
REMEMBERED = 1_000_000

_loaded: dict[str, object] = {}
_known: dict[str, dict[bytes, int]] = {}


def _encoder(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _loaded[path] = made
    return _loaded[path]


def _lengths(encoder, texts: list[str]) -> np.ndarray:
    """Lengths of the encodings, in calls of about ``CALL_BYTES`` each."""
    out, start, size = [], 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= CALL_BYTES or at + 1 == len(texts):
            out += map(len, encoder.encode_batch_fast(texts[start : at + 1], add_special_tokens=False))
            start, size = at + 1, 0
    return np.array(out, np.int64)


def _piece_lengths(path: str, pieces: list[bytes]) -> np.ndarray:
    """Token counts of pieces; only pieces not met lately are encoded."""
    known = _known.setdefault(path, {})
    out = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
    new = np.flatnonzero(out < 0)
    if len(new):
        out[new] = _lengths(_encoder(path), [pieces[i].decode("utf-8", "replace") for i in new])
        if len(known) + len(new) > REMEMBERED:
            known.clear()
        for i, n in zip(new.tolist()[:REMEMBERED], out[new].tolist()):
            known[pieces[i]] = n
    return out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the path of a tokenizers file, readable on every executor, whose pre-tokenizer
    never lets a token reach over ASCII white space and whose added tokens hold none. There every
    text may be cut at white space without changing its tokens, so texts of any length are cut into
    pieces there; equal pieces are encoded once, and pieces go to the encoder in batches of
    equal bytes. Begin, end or other special tokens are not added; special strings inside a text
    count as the library takes them. Null and empty texts have 0 tokens; rows that repeat are counted
    each; other columns are not read; an empty table gives an empty table.
    """

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_bytes(piece.column(1))
        words = words_of(data, offsets)
        tokens = words.sums(_piece_lengths(tokenizer, words.distinct.to_pylist())).astype(np.int64)
        return [pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    return add_columns(rows, "__text", fields, work, keep=[key])
