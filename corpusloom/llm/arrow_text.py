"""Texts of an Arrow batch as byte arrays, and their words as dictionary codes.

Everything here works on one batch inside a task. Batches are cut by bytes before they get here, so
the temporary arrays stay a small multiple of ``SLICE_BYTES``; a longer single text is one slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that are worked on at once.
SLICE_BYTES = 4 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def white_bytes(data: np.ndarray) -> np.ndarray:
    """Whether each byte is white space."""
    return _WHITE[data]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, end to end, and the ``n + 1`` offsets; null counts as empty."""
    texts = column.fill_null("" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have ``most`` bytes, or one text if that is longer."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


@dataclass
class Words:
    """Words of a slice in order: their dictionary code and document, and the distinct words."""

    code: np.ndarray
    doc: np.ndarray
    distinct: pa.LargeBinaryArray
    n_docs: int

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def sums(self, value_of_distinct: np.ndarray) -> np.ndarray:
        """Sum over each document's words of a value that belongs to the distinct word."""
        return np.bincount(self.doc, value_of_distinct[self.code], minlength=self.n_docs)

    def counts(self) -> np.ndarray:
        return np.bincount(self.code, minlength=len(self.distinct))


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Maximal runs of bytes flagged ``inside`` that stay within a document, and each run's document."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    at = np.flatnonzero(starts)
    kept = np.cumsum(inside)
    begins = np.concatenate([kept[at] - 1, kept[-1:] if len(kept) else [0]]).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(begins), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    )
    return found, np.searchsorted(offsets, at, "right") - 1


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text."""
    found, doc = runs(data, offsets, ~_WHITE[data])
    code, distinct = coded(found)
    return Words(code, doc, distinct, len(offsets) - 1)


def sums_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a value per byte between the offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def hash_bytes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash per binary value that is the same in every task."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.to_pylist()), np.uint64, len(values))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def add_columns(
    df: DataFrame, text: str, fields: list[T.StructField], work: Callable[[pa.RecordBatch], list[pa.Array]], keep: list[str] | None = None,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``fields`` computed slice by slice in one pass, without a shuffle.

    A new field replaces a column of its name. Slices have ``most`` bytes of text.
    """
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, most):
                new = work(piece)
                yield pa.RecordBatch.from_arrays([piece.column(piece.schema.get_field_index(c)) for c in kept] + new, kept + names)

    return df.mapInArrow(run, schema)
