"""Benchmark decontamination with suffix arrays.

Every slice of documents is a shard with a suffix array over its words; every suffix of every
benchmark item is binary-searched in it, which gives the longest verbatim match of an item in a
document, its place and the words it covers. The benchmark is the query set: it reaches the tasks in
blocks of bounded size, each block one pass in the same stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import Rolling, byte_column, cut_words, lowered, ranges, text_slices

#: Bytes of benchmark text that one block may hold.
BLOCK_BYTES = 8 << 20

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, small letters and all of non-ASCII text.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()), T.StructField("n_words", T.LongType())])
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text)."""
    data = lowered(data)
    starts, ends, counts = cut_words(data, offsets, WORD_BYTES)
    return Rolling(data).spans(starts, ends), counts


class TestSet:
    """Suffixes of one block of items that begin a window: ``window`` words, or all words of a shorter item."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        hashes, counts = words_of(*byte_column(texts))
        self.vocabulary = np.unique(hashes)
        firsts = np.cumsum(counts) - counts
        self.lengths = np.minimum(counts, window)
        n = np.where(counts > 0, counts - self.lengths + 1, 0)
        self.suffixes = ranges(firsts, n)
        self.item = np.repeat(np.arange(len(ids)), n)
        self.at = self.suffixes - firsts[self.item]
        self.length = self.lengths[self.item]
        self.words = np.concatenate([np.searchsorted(self.vocabulary, hashes) + 1, np.zeros(window, np.int64)])
        self.names = np.array(ids, object)
        self.window = window
        self.least = int(self.length.min()) if len(self.length) else window


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` words from each on, by rank doubling."""
    rank, reach = words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while reach < depth and len(words):
        second = np.concatenate([rank[reach:], np.zeros(min(reach, len(rank)), np.int64)])[: len(rank)]
        key = rank * (int(second.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(words), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) + 1
        reach *= 2
    return order


def _bound(words: np.ndarray, order: np.ndarray, tests: TestSet, upper: bool) -> np.ndarray:
    """For each test suffix, the first place in ``order`` whose prefix isn't below it (upper: is above it)."""
    low, high = np.zeros(len(tests.suffixes), np.int64), np.full(len(tests.suffixes), len(order), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        at = order[np.minimum(mid, len(order) - 1)]
        state = np.zeros(len(low), np.int8)  # -1: the shard's suffix is smaller, 1: larger
        for k in range(tests.window):
            a, b = words[at + k], tests.words[tests.suffixes + k]
            live = (state == 0) & (k < tests.length)
            state[live & (a < b)] = -1
            state[live & (a > b)] = 1
        right = (state < 0) | ((state == 0) & upper)
        low = np.where(open_ & right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    return low


def occurrences(hashes: np.ndarray, counts: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """(word position in the slice, test suffix) of every occurrence of a window.

    The shard's suffix array holds the suffixes that begin with enough known words to hold a window.
    """
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(hashes) or not len(tests.suffixes):
        return empty
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    known = tests.vocabulary[at] == hashes
    text = np.repeat(np.arange(len(counts)), counts)
    change = np.flatnonzero(np.diff(known.astype(np.int8)) | np.diff(text)) + 1
    starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(hashes)]])
    keep = known[starts] & (ends - starts >= tests.least)
    starts, sizes = starts[keep], (ends - starts)[keep]
    if not len(starts):
        return empty
    place = ranges(starts, sizes)
    words = np.zeros(len(place) + len(sizes) + tests.window, np.int64)  # a 0 ends each run
    inside = np.arange(len(place)) + np.repeat(np.arange(len(sizes)), sizes)
    words[inside] = at[place] + 1
    source = np.zeros(len(words), np.int64)
    source[inside] = place
    order = suffix_array(words[: len(words) - tests.window], tests.window)
    low, high = _bound(words, order, tests, False), _bound(words, order, tests, True)
    return source[order[ranges(low, high - low)]], np.repeat(np.arange(len(low)), high - low)


def _longest(position: np.ndarray, suffix: np.ndarray, text: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, position, words) of the longest match of each item in each text; ties go to the first."""
    item, diagonal = tests.item[suffix], position - tests.at[suffix]
    order = np.lexsort([position, diagonal, item, text])
    text, item, diagonal, position, length = text[order], item[order], diagonal[order], position[order], tests.length[suffix[order]]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (position[1:] != position[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(text))) - 1 + length[first]
    text, item, position = text[first], item[first], position[first]
    best = np.lexsort([position, -size, item, text])
    text, item, position, size = text[best], item[best], position[best], size[best]
    head = np.ones(len(text), bool)
    head[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
    return text[head], item[head], position[head], size[head]


def _blocks(tests: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The items, block by block; each reaches the driver alone and holds about ``block_bytes`` of text."""
    items = tests.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).filter("i is not null and t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        yield items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).toArrow()


def find_matches(docs: DataFrame, tests: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns (default: the id) of every row of ``docs`` with n_words, hits and matches.

    ``hits``: maximal spans of word positions that lie in an occurrence of a window (``window`` words
    of an item, or all words of a shorter one). ``matches``: for each item with an occurrence, its
    longest verbatim match in the text and where it starts, by item_id. Null and empty texts have no
    words; items without words or with a null id or text are left out; rows with one item_id are one
    item with several texts. A window that occurs in many items or texts is found in all of them.
    """
    own = keep or [id_col]
    names = [f"_k{i}" for i in range(len(own))]
    frame = docs.select(*[F.col(c).alias(n) for c, n in zip(own, names)], F.col(text_col).cast("string").alias("_text"),
                        F.lit(0).cast("long").alias("n_words"), F.array().cast(T.ArrayType(SPAN)).alias("hits"), F.array().cast(T.ArrayType(MATCH)).alias("matches"))
    for block in _blocks(tests, item_col, item_text_col, block_bytes):
        frame = frame.mapInArrow(_searcher(block, window, names), frame.schema)
    return frame.select(*[F.col(n).alias(c) for c, n in zip(own, names)], "n_words", "hits", "matches")


def covered_runs(starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans over words whose text is given per word, as maximal runs within a text."""
    step = np.bincount(starts, minlength=len(text) + 1) - np.bincount(ends, minlength=len(text) + 1)
    hit = np.cumsum(step)[: len(text)] > 0
    edge = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
    first = hit & (edge | ~np.concatenate([[False], hit[:-1]]))
    last = hit & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([hit[1:], [False]]))
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _searcher(block: pa.Table, window: int, names: list[str]):
    ids, texts = block.column("i").to_pylist(), block.column("t").combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSet(ids, texts, window)
        for part in text_slices(batches, "_text"):
            n = part.num_rows
            column = dict(zip(part.schema.names, part.columns))
            hashes, counts = words_of(*byte_column(column["_text"]))
            text, firsts = np.repeat(np.arange(n), counts), np.cumsum(counts) - counts
            position, suffix = occurrences(hashes, counts, tests)
            hits, matches = column["hits"].to_pylist(), column["matches"].to_pylist()
            starts, ends = covered_runs(position, position + tests.length[suffix], text)
            for row, a, b in zip(text[starts].tolist(), (starts - firsts[text[starts]]).tolist(), (ends - firsts[text[starts]]).tolist()):
                hits[row].append({"start": a, "end": b})
            for row, item, at, size in zip(*(x.tolist() for x in _longest(position, suffix, text[position], tests))):
                matches[row].append({"item_id": tests.names[item], "start": at - int(firsts[row]), "n_words": size})
            for row in np.unique(text[starts]).tolist():
                hits[row], matches[row] = _united(hits[row]), _best(matches[row])
            arrays = [pa.array(hits, column["hits"].type), pa.array(matches, column["matches"].type)]
            yield pa.RecordBatch.from_arrays([*[column[c] for c in names], column["_text"], pa.array(counts), *arrays], names=[*names, "_text", "n_words", "hits", "matches"])

    return run


def _united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def _best(matches: list[dict]) -> list[dict]:
    out: dict[str, dict] = {}
    for m in sorted(matches, key=lambda m: (m["item_id"], -m["n_words"], m["start"])):
        out.setdefault(m["item_id"], m)
    return list(out.values())


def remove_contaminated(docs: DataFrame, tests: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, in which no window of an item occurs.

    Null and empty texts have no words and stay; copies of a row stay or go together; without items all
    rows stay. Columns travel in a struct, so none of their names can clash.
    """
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("text"))
    return find_matches(packed, tests, text_col="text", keep=["row"], **options).filter(F.size("hits") == 0).select(*[F.col("row").getField(c).alias(c) for c in own])
