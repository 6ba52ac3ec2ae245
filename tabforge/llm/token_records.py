"""Token ids in length-delimited binary files, with a separate offset index.

A file is a sequence of frames: the length of the payload (unsigned 64 bits), its masked checksum
(32 bits), the payload, and the payload's masked checksum; all little-endian. The payload is one
document: a flag byte (1: the document has an id), the bytes per token id (2 or 4), the document id
(64 bits) and the ids. Spark's text writer puts each file, one row, where every executor can read it,
under its own commit protocol; it ends a file with a line feed, which is no frame.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import byte_column, id_column, ranges, release, span_hashes, text_slices

#: Bytes of frames after which a new file begins.
SHARD_BYTES = 4 << 20
#: Bytes of text that are cut into pieces at a time.
SLICE_BYTES = 4 << 20
#: Bytes of pieces and their ids that a worker remembers from task to task, and what an entry of the arrays adds to them.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 28
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<BBq")
#: Added to a rotated checksum, as record files do, so that a checksum of checksums isn't zero (fixed value).
MASK_DELTA = 0xA282EAD8

#: Lower-cases A-Z.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Classes of bytes: white space, small ASCII letters, ASCII punctuation but the apostrophe, both bytes of a Latin letter.
_OTHER, _SPACE, _LETTER, _POINT, _LEAD, _TAIL = range(6)
_kind = np.zeros(256, np.uint8)
_kind[[9, 10, 11, 12, 13, 32]] = _SPACE
_kind[0x61:0x7B] = _LETTER
for _a, _b in ((0x21, 0x27), (0x28, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _kind[_a:_b] = _POINT
_KIND = _kind.tobytes()
#: Whether a piece begins between two classes, at 8 * the former + the latter.
_begin = np.zeros(256, np.uint8)
for _a, _b in [(_SPACE, k) for k in range(6)] + [(_LETTER, _POINT), (_TAIL, _POINT), (_POINT, _LETTER), (_POINT, _LEAD)]:
    _begin[8 * _a + _b] = _b != _SPACE
_BEGIN = _begin.tobytes()
#: Pieces that NFC and lower-casing leave as they are and that are one word of the tokenizer's own split.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: The tokenizer steps of which that holds.
_STEPS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)

_tokenizers: dict[int, tuple] = {}


class DamagedRecord(ValueError):
    """A frame whose checksum or length doesn't hold."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = BODY.pack(doc_id is not None, width, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def frames(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, bytes of the frame, document id, ids as unsigned 32-bit integers) of each frame; checksums are verified."""
    at, view = 0, memoryview(content)
    end = len(content) - 1
    if end < 0 or view[end] != 10:
        raise DamagedRecord("the file doesn't end with a line feed")
    while at < end:
        if at + HEAD.size > end:
            raise DamagedRecord(f"cut short at byte {at}")
        size, check = HEAD.unpack_from(view, at)
        if masked(view[at : at + 8]) != check:
            raise DamagedRecord(f"wrong length checksum at byte {at}")
        first, last = at + HEAD.size, at + HEAD.size + size
        if last + 4 > end:
            raise DamagedRecord(f"cut short at byte {at}")
        if masked(view[first:last]) != struct.unpack_from("<I", view, last)[0]:
            raise DamagedRecord(f"wrong checksum at byte {at}")
        known, width, doc_id = BODY.unpack_from(view, first)
        ids = np.frombuffer(view[first + BODY.size : last], f"<u{width}").astype("<u4")
        yield at, last + 4 - at, doc_id if known else None, ids
        at = last + 4


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (of lower-cased bytes) whose tokens don't depend on their neighbours: their starts, their bytes one after the other, and the bounds there.

    Pieces end at white space and between a Latin letter and ASCII punctuation other than the
    apostrophe: the tokenizer's own split has a border at each of these places and drops white space.
    """
    kind = np.frombuffer(bytearray(data.tobytes().translate(_KIND)), np.uint8)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead], kind[lead + 1] = _LEAD, _TAIL
    pairs = kind.copy()
    pairs[1:] += kind[:-1] << 3
    begin = np.frombuffer(bytearray(pairs.tobytes().translate(_BEGIN)), bool)
    solid = kind != _SPACE
    first = offsets[:-1][np.diff(offsets) > 0]
    begin[first] = solid[first]
    joined = data[solid]
    return np.flatnonzero(begin), joined, np.append(np.flatnonzero(begin[solid]), len(joined))


class PieceEncoder:
    """Ids of texts: equal pieces of a slice go to the tokenizer once, and not again while they are remembered.

    What is remembered lies in arrays: hashes in order with the place of each, bytes and ids by place.
    Bytes are compared, so pieces of one hash are told apart (the later one is encoded each time).
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core; a thread pool would hold memory in each of its threads
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder()
        self.tokenizer.encode_special_tokens = True  # for pieces; added tokens are found before texts are cut
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("an added token is normalized, stripped or a single word")
        self.added = {t.content.encode(): i for i, t in added.items()}
        self.any_added = re.compile(b"|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))) if added else None
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        steps = json.loads(vocabulary)
        self.plain = self.tokenizer  # for plain pieces the same model without the steps that leave them as they are
        if (steps.get("normalizer"), steps.get("pre_tokenizer")) == _STEPS:
            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encoded(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids per piece) from the tokenizer."""
        out: list[list[int]] = [[]] * len(values)
        plain = [_PLAIN.fullmatch(v) is not None for v in values]
        for tokenizer, kind in ((self.plain, True), (self.tokenizer, False)):
            todo = [i for i, p in enumerate(plain) if p is kind]
            for at in range(0, len(todo), 20_000):
                part = todo[at : at + 20_000]
                for i, found in zip(part, tokenizer.encode_batch_fast([values[j] for j in part], add_special_tokens=False)):
                    out[i] = found.ids
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(counts.sum())), counts

    def remembered(self, keys: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Place of each piece among those remembered, -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        which = np.flatnonzero(self.keys[at] == keys)
        place = self.place[at[which]].astype(np.int64)
        sizes = bounds[which + 1] - bounds[which]
        same = sizes == self.text_at[place + 1] - self.text_at[place]
        which, place, sizes = which[same], place[same], sizes[same]
        if len(which):
            differ = data[ranges(bounds[which], sizes)] != self.text[ranges(self.text_at[place], sizes)]
            same = ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)
            out[which[same]] = place[same]
        return out

    def remember(self, keys: np.ndarray, data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Add pieces with their ids, as many as there is room for."""
        room = CACHE_BYTES - ENTRY_BYTES * len(self.keys) - len(self.text) - 4 * len(self.ids)
        n = int(np.searchsorted(bounds[1:] + 4 * np.cumsum(counts) + ENTRY_BYTES * np.arange(1, len(keys) + 1), room, side="right"))
        if not n:
            return
        first, begin = len(self.text_at) - 1, int(counts[:n].sum())
        self.text, self.text_at = np.concatenate([self.text, data[: bounds[n]]]), np.concatenate([self.text_at, self.text_at[-1] + bounds[1 : n + 1]])
        self.ids, self.ids_at = np.concatenate([self.ids, ids[:begin]]), np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(counts[:n])])
        fresh, own = np.unique(keys[:n], return_index=True)
        at = np.searchsorted(self.keys, fresh)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != fresh
            fresh, own, at = fresh[new], own[new], at[new]
        self.keys, self.place = np.insert(self.keys, at, fresh), np.insert(self.place, at, (first + own).astype(np.int32))

    def pieces(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, number) of the ids of each of these distinct pieces."""
        data, bounds = byte_column(found)
        keys = span_hashes(data, bounds[:-1], bounds[1:])
        place = self.remembered(keys, data, bounds)
        new = np.flatnonzero(place < 0)
        starts, counts = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        known = place >= 0
        starts[known], counts[known] = self.ids_at[place[known]], self.ids_at[place[known] + 1] - self.ids_at[place[known]]
        ids = self.ids
        if len(new):
            values = found.take(pa.array(new))
            more, counts[new] = self.encoded(values.cast(pa.string()).to_pylist())
            starts[new] = len(ids) + np.cumsum(counts[new]) - counts[new]
            ids = np.concatenate([ids, more])
            self.remember(keys[new], *byte_column(values), more, counts[new])
        return ids, starts, counts

    def added_places(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the vocabulary's added tokens in the texts as they stand."""
        raw = data.tobytes()
        if self.any_added is None or not any(c in raw for c in self.added):
            return []
        bounds = offsets.tolist()
        return [(*m.span(), self.added[m[0]]) for a, b in zip(bounds, bounds[1:]) for m in self.any_added.finditer(raw, a, b)]

    def texts(self, data: np.ndarray, offsets: np.ndarray, special: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text); with ``special`` added tokens of the vocabulary have their own ids."""
        added = self.added_places(data, offsets) if special else []
        data = np.frombuffer(bytearray(data.tobytes().translate(_LOWER)), np.uint8)
        for a, b, _ in added:
            data[a:b] = 32  # a border on both sides, as white space is
        starts, joined, bounds = cut_pieces(data, offsets)
        if not len(starts) and not added:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        codes = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(joined)]).dictionary_encode()
        found, begins, sizes = self.pieces(codes.dictionary)
        index = np.asarray(codes.indices)
        if added:
            index = np.concatenate([index, len(sizes) + np.arange(len(added))])
            begins, sizes = np.concatenate([begins, len(found) + np.arange(len(added))]), np.concatenate([sizes, np.ones(len(added), np.int64)])
            found = np.concatenate([found, np.array([i for _, _, i in added], np.uint32)])
            starts = np.concatenate([starts, np.array([a for a, _, _ in added], np.int64)])
            order = np.argsort(starts)
            starts, index = starts[order], index[order]
        counts = sizes[index]
        ids = found[ranges(begins[index], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])


def encoder_of(vocabulary: str) -> PieceEncoder:
    """One per worker process."""
    key = hash(vocabulary)
    if key not in _tokenizers:
        _tokenizers[key] = (vocabulary, PieceEncoder(vocabulary))
    return _tokenizers[key][1]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 1, id_col: str = "doc_id",
                  text_col: str = "text", shard_bytes: int = SHARD_BYTES, special: bool = False) -> None:
    """Encode every text and write the ids to record files under ``path``, in ascending order of the id.

    Null and empty texts give a record with the end id alone. Null ids come first; rows with one id
    stay side by side in no set order. Strings of special tokens are ordinary text, or with ``special``
    one id each, as the vocabulary file has them. Rows are dealt out by ranges of the id; file names carry the order. An empty table writes no record.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        held: list[bytes] = []
        size = 0
        for part in text_slices(batches, "text", SLICE_BYTES):
            ids, counts = encoder.texts(*byte_column(part.column(1)), special)
            ids = ids.astype(f"<u{encoder.width}")
            end = b"" if end_id is None else np.array([end_id], ids.dtype).tobytes()
            last = np.cumsum(counts)
            for doc, known, a, b in zip(*(x.tolist() for x in id_column(part.column(0))), (last - counts).tolist(), last.tolist()):
                held.append(frame(doc if known else None, ids[a:b].tobytes() + end, encoder.width))
                size += len(held[-1])
                if size >= shard_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], names=["value"])
        release()

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id")
    rows = ordered.mapInArrow(run, T.StructType([T.StructField("value", T.BinaryType())]))
    rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """(file, shard number, content); part files are numbered by task, then by file of the task."""
    name = F.element_at(F.split("path", "/"), -1)
    number = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long") * 1_000_000 + F.regexp_extract(name, r"c(\d+)\.txt$", 1).cast("long")
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 1").select(name.alias("file"), number.alias("shard"), "content")


INDEX = T.StructType([T.StructField("shard", T.LongType()), T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("file", T.StringType()),
                      T.StructField("offset", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
RECORD = T.StructType([*INDEX.fields, T.StructField("ids", T.BinaryType())])


def read_records(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every record with its place and its ids (little-endian unsigned 32-bit); a damaged frame raises."""
    schema = RECORD if with_ids else INDEX

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, shard = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = [(shard, k, doc, file, at, size, len(ids), *([ids.tobytes()] if with_ids else [])) for k, (at, size, doc, ids) in enumerate(frames(batch.column(2)[i].as_py()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=schema.names)
        release()

    return _shards(spark, path).mapInArrow(run, schema)


_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def write_index(spark: SparkSession, path: str, index_path: str) -> None:
    """The offset index of the record files: where each document's frame lies, for reads in any order.

    One row a record; a null id stays null, rows with one id have a row each, no record gives no row.
    """
    read_records(spark, path, with_ids=False).write.parquet(index_path)


def shard_starts(index: DataFrame) -> DataFrame:
    """(shard, before): ids in all shards before it; summed in two levels, so no task sees every shard.

    Shards are numbered by the writer, so there are no ties; a shard without records isn't there.
    """
    from pyspark.sql import Window as W

    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("task", F.floor(F.col("shard") / 1_000_000))
    within = F.sum("n").over(W.partitionBy("task").orderBy("shard")) - F.col("n")
    tasks = totals.groupBy("task").agg(F.sum("n").alias("m")).withColumn("super", F.floor(F.col("task") / 1000))
    inner = F.sum("m").over(W.partitionBy("super").orderBy("task")) - F.col("m")
    supers = tasks.groupBy("super").agg(F.sum("m").alias("s"))
    outer = F.sum("s").over(W.orderBy("super")) - F.col("s")  # one row for each thousand writing tasks
    before = tasks.select("task", "super", inner.alias("inner")).join(supers.select("super", outer.alias("outer")), "super")
    return totals.withColumn("within", within).join(before, "task").select("shard", (F.col("within") + F.col("inner") + F.col("outer")).alias("before"))


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``records`` with ``start``: ids of all documents before it, in the order of the files.

    Records are known by their place, so null and repeated ids don't matter.
    """
    from pyspark.sql import Window as W

    inside = F.sum("n_tokens").over(W.partitionBy("shard").orderBy("row")) - F.col("n_tokens")
    starts = index.select("shard", "row", inside.alias("inside")).join(shard_starts(index), "shard")
    return records.join(starts, ["shard", "row"]).withColumn("start", F.col("inside") + F.col("before"))
