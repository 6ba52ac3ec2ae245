"""Byte-level BPE encoding and decoding.

Texts are cut by the tokenizer's pattern; equal pieces of a slice are merged once. A piece is a row
of a matrix: its byte positions are the leaves of a segment tree that keeps the leftmost minimum pair
rank. A merge takes the root, joins two live neighbours and updates at most three leaves, each along
one path to the root; all pieces of one size class take their next merge together.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import byte_column, ranges, text_slices

NONE = np.int64(1) << np.int64(62)
CACHED_PIECES = 100_000
#: Bytes of text or ids that a task works on at a time.
SLICE_BYTES = 2 << 20
#: First bytes of the code points above ASCII that can be white space.
WIDE_SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)

_codecs: dict[bytes, "Codec"] = {}


def codec_of(vocabulary: bytes, pattern: str) -> "Codec":
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(vocabulary + pattern.encode()).digest()
    if key not in _codecs:
        _codecs[key] = Codec(vocabulary, pattern)
    return _codecs[key]


class Codec:
    """Ranks of a vocabulary file, with one base64 token and its rank on each line."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.split = regex.compile(pattern).findall
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.token_starts, self.token_lengths = np.cumsum(lengths) - lengths, lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.size = size
        self.cache: dict[bytes, bytes] = {}

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(left token and right token as one key, ascending; rank of the token they make); decoding needs none of it."""
        keys, ranks = array("q"), array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    ranks.append(rank)
        order = np.argsort(np.array(keys))
        return np.array(keys)[order], np.array(ranks)[order]

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        known, ranks = self.pairs
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, ranks[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece; pieces are grouped by the power of two that holds their bytes."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        classes = np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64)
        for c in np.unique(classes):
            rows = np.flatnonzero(classes == c)
            step = max(1, (1 << 18) >> int(c))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                for row, ids in zip(part.tolist(), self._merge_class([pieces[r] for r in part], 1 << int(c))):
                    out[row] = ids
        return out

    def _merge_class(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        m = len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((m, width + 1), -1, np.int64)  # the last column stands for "no position"
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.of_byte[flat]
        following = np.tile(np.arange(1, width + 2), (m, 1))
        following[:, width] = width
        following[np.arange(m), lengths - 1] = width
        previous = np.tile(np.arange(-1, width), (m, 1))
        previous[:, 0] = width
        tree = np.full((m, 2 * width), NONE, np.int64)
        rank = self.pair_rank(ids[:, :-1], ids[:, 1:])
        rank[~inside[:, 1:]] = NONE
        places = np.arange(width)
        tree[:, width:] = np.where(rank < NONE, rank * width + places, NONE)
        level = width >> 1
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level >>= 1
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            top = tree[live, 1]
            at = top % width
            gone = following[live, at]
            ids[live, at] = top // width
            ids[live, gone] = -1
            after = following[live, gone]
            following[live, at] = after
            previous[live, after] = at
            previous[:, width] = width
            before = previous[live, at]
            for leaf, left, right in ((gone, None, None), (at, at, after), (before, before, at)):
                if left is None:
                    value = np.full(len(live), NONE)
                else:
                    found = self.pair_rank(ids[live, left], ids[live, right])
                    value = np.where((found < NONE) & (left < width) & (right < width), found * width + left, NONE)
                rows, leaf, value = (live, leaf, value) if leaf is not before else (live[before < width], before[before < width], value[before < width])
                node = leaf + width
                tree[rows, node] = value
                node >>= 1
                while len(node) and node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] < NONE]
        kept = ids[:, :width] >= 0
        values, counts = ids[:, :width][kept], kept.sum(axis=1)
        return np.split(values, np.cumsum(counts)[:-1])

    def encode_pieces(self, chunks: list[bytes]) -> list[bytes]:
        """Ids (unsigned 32-bit) of chunks of text, each cut by the pattern; a match that is a token is that token."""
        out: list[bytes | None] = [self.cache.get(c) for c in chunks]
        todo = [i for i, ids in enumerate(out) if ids is None]
        parts, wanted = [], {}
        for i in todo:
            matches = [m.encode() for m in self.split(chunks[i].decode())]
            parts.append(matches)
            for m in matches:
                if m not in self.ranks:
                    wanted.setdefault(m, len(wanted))
        merged = self.merge(list(wanted)) if wanted else []
        for i, matches in zip(todo, parts):
            found = [merged[wanted[m]] if m in wanted else np.array([self.ranks[m]], np.int64) for m in matches]
            ids = (np.concatenate(found) if len(found) > 1 else found[0] if found else np.zeros(0, np.int64)).astype("<u4").tobytes()
            out[i] = ids
            if len(self.cache) < CACHED_PIECES:
                self.cache[chunks[i]] = ids
        return out

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, tokens per text).

        Texts are first cut before each blank that stands between two characters that are not white
        space: a match always starts there, so the chunks can be encoded apart and equal ones once.
        """
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets) - 1, np.int64)
        starts = chunk_starts(data, offsets)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        codes = chunks.dictionary_encode()
        encoded = self.encode_pieces(codes.dictionary.to_pylist())
        sizes = np.array([len(e) for e in encoded], np.int64) // 4
        flat, firsts = np.frombuffer(b"".join(encoded), "<u4"), np.cumsum(sizes) - sizes
        index = np.asarray(codes.indices)
        counts = sizes[index]
        ids = flat[ranges(firsts[index], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all sequences, bytes per sequence); offsets count ids."""
        lengths = self.token_lengths[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.token_bytes[ranges(self.token_starts[ids], lengths)], np.diff(total[offsets])


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
    wide = np.zeros(256, bool)
    wide[list(WIDE_SPACE_LEADS)] = True
    n = len(data)
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < n - 1)]
    near = ~space[data[at - 1]] & ~space[data[at + 1]] & ~wide[data[at + 1]]
    near &= ~wide[data[np.maximum(at - 2, 0)]] & ~wide[data[np.maximum(at - 3, 0)]]
    return np.unique(np.concatenate([at[near], offsets[:-1][np.diff(offsets) > 0]]))


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array of consecutive runs of ``values``."""
    offsets = np.concatenate([[0], np.cumsum(counts * values.itemsize)])
    kind, width = (pa.large_binary(), np.int64) if offsets[-1] > 2**31 - 1 else (pa.binary(), np.int32)
    out = pa.Array.from_buffers(kind, len(counts), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(np.ascontiguousarray(values))])
    return out.cast(pa.binary()) if kind == pa.large_binary() else out


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the id), ids and n_tokens of every row: ids are the token ids as little-endian unsigned 32-bit integers.

    A null text is an empty one and gives no ids. Row order, repeated rows, null ids and other columns
    don't matter: each row is encoded by itself, so nothing is shuffled. ``ranks_path`` is read by the
    driver and sent with the task (a vocabulary file is small and doesn't grow with the data).
    """
    with open(ranks_path, "rb") as f:
        vocabulary = f.read()
    own = keep or [id_col]
    schema = T.StructType([*[docs.schema[c] for c in own], T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary, pattern)
        for part in text_slices(batches, "_text", SLICE_BYTES):
            ids, counts = codec.encode_texts(*byte_column(part.column(len(own))))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(own)], _binary(ids, counts), pa.array(counts)], names=[*own, "ids", "n_tokens"])

    return docs.select(*own, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with a binary column of the decoded bytes; null ids decode to no bytes."""
    with open(ranks_path, "rb") as f:
        vocabulary = f.read()
    schema = T.StructType([*[f for f in encoded.schema if f.name != to], T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary, pattern)
        for part in text_slices(batches, ids_col, SLICE_BYTES):
            raw, offsets = byte_column(part.column(part.schema.get_field_index(ids_col)))
            decoded, counts = codec.decode(raw.view("<u4").astype(np.int64), offsets // 4)
            yield pa.RecordBatch.from_arrays([*part.columns, _binary(decoded, counts)], names=[*part.schema.names, to])

    return encoded.drop(to).mapInArrow(run, schema)
