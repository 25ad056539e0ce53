"""Unigram encoding with the pieces and scores of a SentencePiece model, and decoding back to bytes.

The best segmentation of a text is the one with the largest sum of piece scores. Pieces are found with a
double-array trie over bytes, the path with Viterbi's algorithm. The mark of a space only stands at the
front of pieces, so no piece reaches over the start of a run of spaces, and each run with the word after
it is segmented on its own; equal ones of a slice are segmented once.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import add_columns, coded, text_bytes

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_SPACE = 0x20


def _fields(data: bytes):
    """Field number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        elif tag & 7 == 2:
            size = number()
            yield tag >> 3, data[at : at + size]
            at += size
        elif tag & 7 == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        else:
            yield tag >> 3, data[at : at + 8]
            at += 8


class DoubleArray:
    """A trie over byte strings in two arrays: from state ``s``, byte ``c`` leads to ``base[s] + c + 1`` if ``check`` there is ``s``."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for word, value in words.items():
            node = 0
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = value
        size = len(children) * 2 + 1024
        self.base, self.check, self.value = (np.full(size, fill, np.int64) for fill in (0, -1, -1))
        used = np.zeros(size, bool)
        used[0] = True
        spot, free, scan, todo = {0: 0}, 257, 1, [0]
        while todo:
            node = todo.pop()
            state = spot[node]
            self.value[state] = ends[node]
            codes = np.array(sorted(children[node]), np.int64) + 1
            if not len(codes):
                continue
            if len(codes) == 1:  # any free cell will do
                while used[free]:
                    free += 1
                base = free - int(codes[0])
            else:
                base, tries = scan, 0
                while used[base + codes].any():
                    base, tries = base + 1, tries + 1
                if tries > 20:
                    scan = base
            if base + 600 > len(used):
                grow = len(used)
                self.base, self.check, self.value = (np.append(x, np.full(grow, fill)) for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))
                used = np.append(used, np.zeros(grow, bool))
            self.base[state] = base
            self.check[base + codes] = state
            used[base + codes] = True
            for c in codes.tolist():
                spot[children[node][c - 1]] = base + c
                todo.append(children[node][c - 1])
        last = int(np.flatnonzero(used)[-1]) + 258
        self.base, self.check, self.value = (np.append(a, np.full(258, fill))[:last] for a, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and value of every word in ``data``; a match from ``i`` stays below ``ends[i]``."""
        at, state = np.arange(len(data)), np.zeros(len(data), np.int64)
        out = []
        depth = 0
        while len(at):
            inside = at + depth < ends[at]
            at, state = at[inside], state[inside]
            step = self.base[state] + data[at + depth] + 1
            known = self.check[step] == state
            at, state = at[known], step[known]
            depth += 1
            hit = self.value[state] >= 0
            out.append((at[hit], np.full(int(hit.sum()), depth), self.value[state[hit]]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


#: Bytes of text that are worked on at once, and of distinct segments within them (ids, in decoding).
SLICE_BYTES = 2 << 20
PART_BYTES = 1 << 18


@dataclass
class PieceModel:
    """Pieces, their scores and kinds, and the trie of those that text can match."""

    pieces: list[bytes]
    kinds: np.ndarray
    scores: np.ndarray
    trie: DoubleArray
    unknown: int
    byte_ids: np.ndarray | None
    unknown_score: float
    prefix: bool
    splits: bool
    surface: np.ndarray
    surface_ends: np.ndarray

    def segment_ids(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, end to end, and the number for each."""
        data, offsets = text_bytes(segments)
        length = np.diff(offsets)
        n = len(length)
        owner = np.repeat(np.arange(n), length)
        start, size, piece = self.trie.matches(data, offsets[owner + 1])
        lead = (data & 0xC0) != 0x80
        lead[offsets[:-1][length > 0]] = True
        chars = np.flatnonzero(lead)
        char_size = np.minimum(np.append(chars[1:], len(data)), offsets[owner[chars] + 1]) - chars
        # A character that no piece spells is unknown, which costs more than any piece.
        spelled = np.zeros(len(data), np.int64)
        char_of = np.zeros(len(data), np.int64)
        char_of[chars] = char_size
        single = size == char_of[start]
        spelled[start[single]] = 1
        lost = spelled[chars] == 0
        begins = lead[start]
        start = np.concatenate([start[begins], chars[lost]])
        size = np.concatenate([size[begins], char_size[lost]])
        piece = np.concatenate([piece[begins], np.full(int(lost.sum()), self.unknown)])
        gain = np.where(piece == self.unknown, self.unknown_score, self.scores[piece])
        return self._paths(data, offsets, owner, start, size, piece, gain)

    def _paths(self, data, offsets, owner, start, size, piece, gain) -> tuple[np.ndarray, np.ndarray]:
        """Best paths, all segments together: positions in order of their distance from the segment's start."""
        n = len(offsets) - 1
        best = np.full(len(data) + n + 1, -np.inf)
        back = np.full(len(data) + n + 1, -1)
        slot = owner[start] + start  # every segment has a slot before its first byte
        best[offsets[:-1] + np.arange(n)] = 0.0
        end = slot + size
        reach = end - (offsets[:-1] + np.arange(n))[owner[start]]
        order = np.lexsort((slot, end, reach))
        slot, end, reach, gain, piece = slot[order], end[order], reach[order], gain[order], piece[order]
        cuts = np.searchsorted(reach, np.arange(1, (reach[-1] if len(reach) else 0) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            total = best[slot[a:b]] + gain[a:b]
            first = np.flatnonzero(np.diff(end[a:b], prepend=-1))
            top = np.maximum.reduceat(total, first)
            groups = np.repeat(top, np.diff(np.append(first, b - a)))
            win = np.flatnonzero(total == groups)
            win = win[np.diff(end[a:b][win], prepend=-1) != 0]  # of equal paths the one with the longest last piece
            best[end[a:b][win]] = total[win]
            back[end[a:b][win]] = a + win
        at = offsets[1:] + np.arange(n)
        live = np.flatnonzero(back[at] >= 0)
        steps_owner, steps = [], []
        at = at[live]
        while len(live):
            chosen = back[at]
            steps_owner.append(live)
            steps.append(chosen)
            at = slot[chosen]
            more = back[at] >= 0
            at, live = at[more], live[more]
        if not steps:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        depth = np.repeat(np.arange(len(steps)), [len(x) for x in steps])
        of, chosen = np.concatenate(steps_owner), np.concatenate(steps)
        order = np.lexsort((-depth, of))
        of, chosen = of[order], chosen[order]
        ids = piece[chosen]
        if self.byte_ids is None:
            return ids, np.bincount(of, minlength=n)
        lost = ids == self.unknown
        times = np.where(lost, end[chosen] - slot[chosen], 1)
        row = np.repeat(np.arange(len(ids)), times)
        step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        out = ids[row]
        broken = lost[row]
        out[broken] = self.byte_ids[data[(slot[chosen] - of)[row][broken] + step[broken]]]
        return out, np.bincount(of[row], minlength=n)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the number for each text."""
        body, ends = self._prepared(data, offsets)
        n = len(ends) - 1
        first = np.zeros(len(body) + 1, bool)
        first[ends[:-1][np.diff(ends) > 0]] = True
        if self.splits:
            space = body == _SPACE
            first[1:-1] |= space[1:] & ~space[:-1]
        first = np.flatnonzero(first[: len(body)])
        doc = np.searchsorted(ends, first, "right") - 1
        segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(np.append(first, len(body)).astype(np.int64)), pa.py_buffer(body)])
        code, distinct = coded(segments)
        ids, count = self._in_parts(distinct)
        begin = np.cumsum(count) - count
        times = count[code]
        at = np.repeat(begin[code] - (np.cumsum(times) - times), times)
        at += np.arange(len(at))
        return ids[at].astype(np.int32), np.bincount(doc, times, minlength=n).astype(np.int64)

    def _in_parts(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``segment_ids`` of ``PART_BYTES`` at a time, since a byte takes over a hundred of working memory."""
        _, offsets = text_bytes(segments)
        found, start = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        while start < len(segments):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PART_BYTES, "right")) - 1)
            ids, count = self.segment_ids(segments.slice(start, stop - start))
            found.append((ids.astype(np.int32), count))
            start = stop
        return tuple(np.concatenate(x) for x in zip(*found))

    def _prepared(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes with a space before each text that has any, and marks in a text as spaces."""
        whole = data.tobytes()
        if MARK.encode() in whole:
            texts = [whole[a:b].replace(MARK.encode(), b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
        if not self.prefix:
            return np.ascontiguousarray(data), offsets
        some = np.diff(offsets) > 0
        return np.insert(data, offsets[:-1][some], _SPACE), offsets + np.concatenate([[0], np.cumsum(some)])

    def _shown(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        size = sizes[ids]
        at = np.repeat(self.surface_ends[:-1][ids] - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.surface[at]

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of id lists that lie end to end, and their offsets."""
        sizes = np.diff(self.surface_ends)
        parts = [self._shown(ids[i : i + PART_BYTES], sizes) for i in range(0, len(ids), PART_BYTES)]
        body = np.concatenate([np.zeros(0, np.uint8), *parts])
        ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(count)])]
        if self.prefix and len(body):
            lead = ends[:-1][np.diff(ends) > 0]
            drop = lead[body[lead] == _SPACE]
            kept = np.ones(len(body), bool)
            kept[drop] = False
            ends = np.concatenate([[0], np.cumsum(kept)])[ends]
            body = body[kept]
        return body, ends


def load_model(data: bytes) -> PieceModel:
    """A model file's pieces as they are; only models that leave the text unnormalised are accepted."""
    pieces, kinds, scores = [], [], []
    prefix = True
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b""))
            scores.append(own.get(2, 0.0))
            kinds.append(own.get(3, NORMAL))
        elif number == 3:
            own = dict(_fields(value))
            prefix = bool(own.get(3, 1))
            if own.get(2) or own.get(4, 1):
                raise ValueError("only models without normalisation are supported")
    kind, score = np.array(kinds), np.array(scores, np.float64)
    mark = MARK.encode()
    text = [p.replace(mark, b" ") if k in (NORMAL, USER_DEFINED) else p for p, k in zip(pieces, kinds)]
    usable = {text[i]: i for i in range(len(text)) if kinds[i] in (NORMAL, USER_DEFINED)}
    if (kind == USER_DEFINED).any():
        raise ValueError("models with pieces of the user are not supported")
    of_byte = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if kinds[i] == BYTE}
    shown = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else t for p, k, t in zip(pieces, kinds, text)]
    return PieceModel(
        pieces, kind, score, DoubleArray(usable), kinds.index(UNKNOWN),
        np.array([of_byte[b] for b in range(256)]) if len(of_byte) == 256 else None,
        float(score[kind == NORMAL].min()) - 10.0, prefix,
        not any(b" " in t.lstrip(b" ") for t in usable),
        np.frombuffer(b"".join(shown), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in shown])]),
    )


def read_model(spark: SparkSession, path: str) -> PieceModel:
    """The model file, read by Spark from any storage it knows, or from this machine for a plain path."""
    where = path if "://" in path or path.startswith("file:") else f"file://{path}"
    if where.startswith("file:"):
        with open(where.removeprefix("file://").removeprefix("file:"), "rb") as file:
            return load_model(file.read())
    return load_model(bytes(spark.read.format("binaryFile").load(where).first().content))


def encode_documents(docs: DataFrame, model: PieceModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``pieces``, ``n_pieces``, ``n_bytes_spelled`` and ``exact``.

    ``pieces`` are the ids of the best segmentation; of equal sums the path whose last pieces are longest.
    A character that no piece spells becomes its bytes (``n_bytes_spelled`` counts those ids), or the
    unknown piece in a model without byte pieces. ``exact`` tells whether decoding gives the text back,
    byte for byte; it does but for texts that hold the mark itself. Null counts as empty, which has no
    pieces; repeated rows are encoded each; new columns replace columns of their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
        T.StructField("n_bytes_spelled", T.LongType()), T.StructField("exact", T.BooleanType()),
    ]
    shown = list(docs.columns if keep is None else keep)
    # A text that is kept travels once.
    read = text if text in shown else "__text"

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        model = sent.value
        data, offsets = text_bytes(piece.column(piece.schema.get_field_index(read)))
        ids, count = model.encode(data, offsets)
        ends = np.concatenate([[0], np.cumsum(count)])
        spelled = np.concatenate([[0], np.cumsum(model.kinds[ids] == BYTE)])
        body, back = model.decode(ids, count)
        same = np.diff(back) == np.diff(offsets)
        if len(body) == len(data) and same.all():
            wrong = np.concatenate([[0], np.cumsum(body != data)])
            same &= wrong[offsets[1:]] == wrong[offsets[:-1]]
        else:
            one, two = data.tobytes(), body.tobytes()
            same = np.array([one[offsets[i] : offsets[i + 1]] == two[back[i] : back[i + 1]] for i in range(len(count))], bool)
        return [
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(count),
            pa.array(spelled[ends[1:]] - spelled[ends[:-1]]), pa.array(same),
        ]

    extra = [] if read == text else [F.col(text).alias(read)]
    rows = docs.select(*[F.col(c) for c in shown], *extra)
    return add_columns(rows, read, fields, work, keep=shown, most=SLICE_BYTES)


def decode_documents(rows: DataFrame, model: PieceModel, pieces: str = "pieces", text: str = "text") -> DataFrame:
    """``rows`` with the ``text`` of their ids: marks become spaces, byte pieces bytes; null ids give an empty text."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    shown = [c for c in rows.columns if c != text]
    schema = T.StructType([rows.schema[c] for c in shown] + [T.StructField(text, T.StringType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(pieces))
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            body, ends = sent.value.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), count)
            whole = body.tobytes()
            texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in shown] + [pa.array(texts, pa.string())], shown + [text])

    return rows.mapInArrow(run, schema)
