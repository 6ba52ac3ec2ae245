"""Facts of a whole corpus about many small keys, without a row per key.

Documents are dealt into blocks by a hash of their id. A block reduces what it knows about its keys to
packed arrays, one for each bucket of the key space; a bucket combines what all blocks sent and answers
each block by positions in what it sent. A key that every document holds thus reaches its bucket once a
block, and a block's answer is as long as the part of its keys that has one.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import byte_column, release, text_slices

#: Bytes of text in a block, on average; a longer text is a block's alone or shares it.
BLOCK_BYTES = 3 << 20
#: A bucket holds about the keys of so many blocks.
BLOCKS_PER_BUCKET = 4
#: Stands for a null id: after all others. Equal ids are one document.
NO_ID = (1 << 63) - 1

PACKED = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])


class Deal(NamedTuple):
    """Documents by block, and how they and their keys are dealt out.

    Blocks and buckets grow with the text and bound what a task holds at a time; the partitions, each of
    which works through its blocks or buckets one after the other, are those of the session.
    """

    rows: DataFrame
    n_blocks: int
    n_buckets: int
    partitions: int


def dealt(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, total: int | None = None, more: tuple[Column, ...] = (), dense: bool = False) -> Deal:
    """(block, id, text, more) of every row, dealt out by block; the number of blocks follows from the ``total`` bytes of text.

    ``dense``: texts travel compressed, each by itself.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"), *more)
    if total is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("id"), F.lit(n))
    if dense:
        rows = rows.mapInArrow(_compressed, T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in rows.schema]))
    return Deal(rows.select(block.alias("block"), *rows.columns).repartition(partitions, "block"), n, max(-(-n // BLOCKS_PER_BUCKET), min(n, 32)), partitions)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        at = part.schema.get_field_index("text")
        texts = [x and struct.pack("<Q", len(x)) + pa.compress(x, "zstd", asbytes=True) for x in part.column(at).cast(pa.binary()).to_pylist()]
        yield part.set_column(at, "text", pa.array(texts, pa.binary()))


def _restored(texts: pa.ChunkedArray) -> pa.Array:
    restore, size = pa.Codec("zstd").decompress, struct.Struct("<Q").unpack_from
    return pa.array([x and restore(memoryview(x)[8:], size(x)[0], asbytes=True) for x in texts.to_pylist()], pa.large_binary())


#: In place of the number of arrays: what follows is compressed.
DENSE = (1 << 32) - 1


def pack(*arrays: np.ndarray, dense: bool = False) -> bytes:
    """``dense``: entropy-coded, for columns whose bytes are far from uniform."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        parts += [struct.pack("<4sQ", a.dtype.str.encode(), a.nbytes), np.ascontiguousarray(a).tobytes()]
    whole = b"".join(parts)
    return struct.pack("<IQ", DENSE, len(whole)) + pa.compress(whole, "zstd", asbytes=True) if dense else whole


def unpack(payload: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", payload), 4, []
    if n == DENSE:
        payload = pa.decompress(memoryview(payload)[12:], struct.unpack_from("<Q", payload, 4)[0], "zstd", asbytes=True)
        (n,) = struct.unpack_from("<I", payload)
    for _ in range(n):
        kind, size = struct.unpack_from("<4sQ", payload, at)
        at += 12
        out.append(np.frombuffer(payload, np.dtype(kind.rstrip(b"\0").decode()), size // np.dtype(kind.rstrip(b"\0").decode()).itemsize, at))
        at += size
    return out


def smallest(values: np.ndarray) -> np.ndarray:
    """Unsigned values in the narrowest type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def planes(values: np.ndarray) -> np.ndarray:
    """Unsigned values as bytes, all lowest ones first, as many of each as the largest value needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 0
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).ravel()


def of_planes(data: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : len(data) // n] = data.reshape(-1, n).T
    return out.ravel().view("<u8").astype(np.uint64, copy=False)


def gaps(ascending: np.ndarray) -> np.ndarray:
    """Ascending unsigned values as the planes of their differences."""
    return planes(np.diff(ascending.astype(np.uint64), prepend=np.uint64(0)))


def of_gaps(data: np.ndarray, n: int) -> np.ndarray:
    return np.cumsum(of_planes(data, n), dtype=np.uint64)


def narrow(ids: np.ndarray) -> np.ndarray:
    """Ids in a narrow type where none is negative."""
    return smallest(ids) if not len(ids) or ids.min() >= 0 else ids


class Block:
    """The rows of a block: ids ascending, and the bytes of their texts one after the other."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        ids = np.asarray(table.column("id"), np.int64)
        order = np.argsort(ids, kind="stable")
        table = table.take(pa.array(order))
        self.ids = ids[order]
        texts = table.column("text")
        self.data, self.offsets = byte_column(_restored(texts) if pa.types.is_binary(texts.type) else texts)
        self.table = table.drop_columns(["text"])
        self.number = int(table.column("block")[0].as_py()) if table.num_rows else -1


def to_buckets(bucket: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): records by bucket, in their own order within each."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def packed_rows(block: int, bucket: np.ndarray, n_buckets: int, columns: list[np.ndarray]) -> pa.Table:
    """Records as one row for each bucket that gets any."""
    order, bounds = to_buckets(bucket, n_buckets)
    full = np.flatnonzero(np.diff(bounds))
    payloads = [pack(*[c[order[bounds[b] : bounds[b + 1]]] for c in columns]) for b in full.tolist()]
    return pa.table([pa.array(full, pa.int64()), pa.array(np.full(len(full), block), pa.int64()), pa.array(payloads, pa.binary())], names=PACKED.names)


def by_bucket(sent: DataFrame, deal: Deal) -> DataFrame:
    return sent.repartition(deal.partitions, "bucket")


def reduced(sent: DataFrame, deal: Deal, answer: Callable[[list[list[np.ndarray]]], list[bytes | None]]) -> DataFrame:
    """(bucket, block, payload) answers: ``answer`` sees the payloads of one bucket and replies to each, or not."""

    def run(table: pa.Table) -> pa.Table:
        replies = answer([unpack(p.as_py()) for p in table.column("payload")])
        keep = [i for i, r in enumerate(replies) if r is not None]
        kept = table.take(pa.array(keep, pa.int64()))
        release()
        return pa.table([kept.column("bucket"), kept.column("block"), pa.array([replies[i] for i in keep], pa.binary())], names=PACKED.names)

    return by_bucket(sent, deal).groupBy("bucket").applyInArrow(run, PACKED)


def joined(records: list[list[np.ndarray]], column: int, kind=None) -> np.ndarray:
    """One column of all payloads; ``kind`` where their types differ."""
    return np.concatenate([r[column] if kind is None else r[column].astype(kind) for r in records])


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, number of the group at each place of the order) of equal keys, sorted by the keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def replies_by_bucket(table: pa.Table) -> dict[int, list[np.ndarray]]:
    return {b: unpack(p) for b, p in zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist())}


def each_block(deal: Deal, fn: Callable[[Block], pa.Table], schema: T.StructType) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        out = fn(Block(table))
        release()
        return out

    return deal.rows.groupBy("block").applyInArrow(run, schema)


def with_replies(deal: Deal, replies: DataFrame, fn: Callable[[Block, pa.Table], Iterator[pa.Table] | pa.Table], schema: T.StructType) -> DataFrame:
    """``fn`` sees each block with the answers to it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = fn(Block(left), right)
        release()
        return out

    return deal.rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
