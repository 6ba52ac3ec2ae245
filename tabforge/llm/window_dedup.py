"""Substring deduplication of words: Rabin-Karp hashes of every window of ``length`` words.

A block hashes each of its windows from prefix sums. Two rounds keep the shuffle small and whole:

1. Of the half-length windows inside a window, the one with the smallest hash is its core. Blocks send
   their distinct cores; only a core that stands in two documents lets its windows repeat.
2. Blocks send every distinct window with such a core and its first document (128-bit hashes). A bucket
   counts who holds a window and answers the blocks whose documents all come later.

Repeated windows then merge into maximal runs of removed words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import BASES, U64, Rolling, cut_words, mixed, ranges
from tabforge.llm.blocks import BLOCK_BYTES, NO_ID, PACKED, Block, dealt, each_block, groups, joined, narrow, pack, packed_rows, reduced, replies_by_bucket, smallest, to_buckets, with_replies
from tabforge.llm.suffix_dedup import sliding_min

#: Bytes of words `[^\x20\x09-\x0D]+`.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False


class Windows:
    """Windows of a block's texts: word positions, documents, hashes of the windows and of their cores."""

    def __init__(self, block: Block, length: int):
        self.block, self.length = block, length
        self.starts, self.ends, self.words = cut_words(block.data, block.offsets, WORD_BYTES)
        words = Rolling(block.data, BASES[0]).spans(self.starts, self.ends)
        firsts = np.cumsum(self.words) - self.words
        count = np.maximum(self.words - length + 1, 0)
        self.at, self.doc = ranges(firsts, count), np.repeat(np.arange(len(count)), count)
        self.symbols = words
        half = length // 2
        if len(self.at):
            cores = Rolling(words, BASES[1]).every(half)
            self.core = sliding_min(cores, length - half + 1)[self.at]
        else:
            self.core = np.zeros(0, U64)

    def hashes(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[chosen]
        return Rolling(self.symbols, BASES[0]).spans(at, at + self.length), Rolling(mixed(self.symbols), BASES[1]).spans(at, at + self.length)


def _heads(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first occurrence of each distinct key, in order of occurrence; the place in it of every key)."""
    order, number = groups(*keys)
    head = np.concatenate([[True], number[1:] != number[:-1]]) if len(order) else np.zeros(0, bool)
    one = order[head]
    rank = np.argsort(one)
    place = np.empty(len(one), np.int64)
    place[rank] = np.arange(len(one))
    back = np.empty(len(order), np.int64)
    back[order] = place[number] if len(order) else number
    return one[rank], back


def _cores(windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window of each distinct core, its place for every window, whether two documents of the block hold it)."""
    one, place = _heads(windows.core)
    several = np.zeros(len(one), bool)
    ids = windows.block.ids[windows.doc]
    several[place[ids != ids[one[place]]]] = True
    return one, place, several


def _send_cores(n_buckets: int, length: int):
    def run(block: Block) -> pa.Table:
        windows = Windows(block, length)
        one, _, several = _cores(windows)
        core = windows.core[one]
        return packed_rows(block.number, (core % U64(n_buckets)).astype(np.int64), n_buckets, [core, several])

    return run


def _judge_cores(payloads: list[list[np.ndarray]]) -> list[bytes | None]:
    """Places of the cores that two documents hold."""
    core, several = joined(payloads, 0), joined(payloads, 1)
    order, number = groups(core)
    holders = np.bincount(number, weights=1 + several[order]) if len(number) else np.zeros(0)
    shared = np.empty(len(core), bool)
    shared[order] = holders[number] > 1
    out, at = [], 0
    for p in payloads:
        found = np.flatnonzero(shared[at : at + len(p[0])])
        out.append(pack(smallest(found)) if len(found) else None)
        at += len(p[0])
    return out


def _candidates(windows: Windows, replies: dict[int, list[np.ndarray]], n_buckets: int) -> np.ndarray:
    """Windows whose core stands in two documents."""
    one, place, _ = _cores(windows)
    order, bounds = to_buckets((windows.core[one] % U64(n_buckets)).astype(np.int64), n_buckets)
    shared = np.zeros(len(one), bool)
    for b, (places,) in replies.items():
        shared[order[bounds[b] + places.astype(np.int64)]] = True
    return np.flatnonzero(shared[place]) if len(one) else np.zeros(0, np.int64)


def _send_windows(n_buckets: int, length: int):
    def run(block: Block, replies: pa.Table) -> pa.Table:
        windows = Windows(block, length)
        chosen = _candidates(windows, replies_by_bucket(replies), n_buckets)
        a, b = windows.hashes(chosen)
        one, _ = _heads(a, b)
        owner = block.ids[windows.doc[chosen[one]]]
        return packed_rows(block.number, (a[one] % U64(n_buckets)).astype(np.int64), n_buckets, [a[one], (b[one] >> U64(32)).astype(np.uint32), narrow(owner)])

    return run


def _judge_windows(payloads: list[list[np.ndarray]]) -> list[bytes | None]:
    """Places of the windows whose first document isn't the block's."""
    a, b, owner = joined(payloads, 0), joined(payloads, 1), joined(payloads, 2, np.int64)
    order, number = groups(a, b)
    first = np.full(int(number[-1]) + 1 if len(number) else 0, NO_ID, np.int64)
    np.minimum.at(first, number, owner[order])
    later = np.empty(len(a), bool)
    later[order] = owner[order] > first[number]
    out, at = [], 0
    for p in payloads:
        found = np.flatnonzero(later[at : at + len(p[0])])
        out.append(pack(smallest(found)) if len(found) else None)
        at += len(p[0])
    return out


RESULT = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("removed", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())])


def _finish(n_buckets: int, length: int):
    def run(block: Block, replies: pa.Table) -> pa.Table:
        windows = Windows(block, length)
        second = np.asarray(replies.column("bucket")) >= n_buckets
        chosen = _candidates(windows, replies_by_bucket(replies.filter(pa.array(~second))), n_buckets)
        a, b = windows.hashes(chosen)
        one, place = _heads(a, b)
        order, bounds = to_buckets((a[one] % U64(n_buckets)).astype(np.int64), n_buckets)
        later = np.zeros(len(one), bool)
        for bucket, (places,) in replies_by_bucket(replies.filter(pa.array(second))).items():
            later[order[bounds[bucket - n_buckets] + places.astype(np.int64)]] = True
        ids = block.ids[windows.doc[chosen]]
        repeat = later[place] | (ids > ids[one[place]]) if len(one) else np.zeros(0, bool)
        at = windows.at[chosen[repeat]]
        n = len(windows.starts)
        removed = np.cumsum(np.bincount(at, minlength=n + length) - np.bincount(at + length, minlength=n + length))[:n] > 0
        return _result(windows, removed)

    return run


def _result(windows: Windows, removed: np.ndarray) -> pa.Table:
    """Counts, removed runs as [start, end, start, end, ...] in words, and the kept words joined by blanks."""
    block, words = windows.block, windows.words
    bounds = np.concatenate([[0], np.cumsum(words)])
    sums = np.concatenate([[0], np.cumsum(removed)])
    edge = np.zeros(len(removed) + 1, bool)
    edge[bounds[:-1]] = True
    first = np.flatnonzero(removed & (edge[:-1] | ~np.concatenate([[False], removed[:-1]]))) if len(removed) else np.zeros(0, np.int64)
    last = np.flatnonzero(removed & (np.append(edge[1:-1], True) | ~np.append(removed[1:], False))) + 1 if len(removed) else first
    row = np.searchsorted(bounds, first, side="right") - 1
    runs = np.stack([first - bounds[row], last - bounds[row]], axis=1).reshape(-1)
    run_offsets = (2 * np.searchsorted(row, np.arange(len(words) + 1))).astype(np.int32)
    kept = np.flatnonzero(~removed)
    sizes = windows.ends[kept] - windows.starts[kept]
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    raw = np.full(int((sizes + 1).sum()), 32, np.uint8)
    raw[ranges(begins, sizes)] = block.data[ranges(windows.starts[kept], sizes)]
    raw = raw.tobytes()
    ends = np.append(begins, len(raw))
    share = np.searchsorted(kept, bounds)
    texts = [raw[ends[a] : ends[b] - 1] if b > a else b"" for a, b in zip(share[:-1].tolist(), share[1:].tolist())]
    ids = pa.array(block.ids, mask=block.ids == NO_ID)
    return pa.table([ids, pa.array(words), pa.array(np.diff(sums[bounds])), pa.ListArray.from_arrays(pa.array(run_offsets), pa.array(runs)), pa.array(texts, pa.binary())], names=RESULT.names)


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_removed, removed, kept) of every row: ``removed`` holds the maximal runs of removed words
    as start, end, start, end, ...; ``kept`` the other words, joined by one blank, as UTF-8.

    Removed is each word in a window of ``length`` words whose word sequence also starts in a document
    with a smaller id; windows are judged on the input. Null and empty texts have no words; a text of
    fewer words has no window. Rows with one id are one document, each with its own result; a row with a
    null id comes after all others and never makes another lose words.
    """
    deal = dealt(docs, id_col, text_col, block_bytes)
    n = deal.n_buckets
    first = reduced(each_block(deal, _send_cores(n, length), PACKED), deal, _judge_cores)
    second = reduced(with_replies(deal, first, _send_windows(n, length), PACKED), deal, _judge_windows)
    replies = first.unionByName(second.withColumn("bucket", F.col("bucket") + n))
    return with_replies(deal, replies, _finish(n, length), RESULT)
