"""Exact substring deduplication of bytes by prefix-free parsing.

Triggers: a position whose rolling hash over ``TRIGGER`` bytes is the smallest among the trigger
windows of some string of ``length`` bytes. Every string of that length thus holds a trigger, and equal
strings hold it at the same place. The parse cuts a text at its triggers; the phrase of a trigger is the
bytes of all strings that take it as their own. The dictionary has each phrase once, with the first
document that holds it.

1. Blocks send (trigger hash, phrase hash, first document) of their distinct phrases. A bucket tells a
   block which phrases stand whole in an earlier document: all their strings are repeats. Where a trigger
   has several phrases, the block of each phrase's first document is asked for the phrase itself.
2. Those phrases form the dictionary of a bucket; its suffix array (the suffixes of at least ``length``
   bytes) puts equal strings side by side, which gives the first document of every string in question.
   A trigger with very many phrases sends them as strings, dealt out by their own hash.

A phrase reaches past its next triggers by construction, so no string of ``length`` bytes needs the order
of the parse beyond one phrase; the parse's own suffix array, which orders longer strings, isn't built.
Memory and shuffles are bounded by a block or bucket, and repeats cost one phrase each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import BASES, U64, Rolling, mixed, ranges
from tabforge.llm.blocks import BLOCK_BYTES, NO_ID, PACKED, Block, dealt, each_block, groups, joined, pack, narrow, packed_rows, reduced, replies_by_bucket, smallest, to_buckets, with_replies

TRIGGER = 24
#: Phrases of one trigger above which they travel as single strings, so that no bucket holds them all.
MANY_PHRASES = 2048
SEEN, OPEN, SPLIT = 1, 2, 4


class Parse:
    """Phrases of a block: for each, its trigger hash, phrase hash, owner and the strings [first, last] it covers."""

    def __init__(self, block: Block, length: int):
        self.block, self.length = block, length
        trigger = min(TRIGGER, length)
        self.size = np.diff(block.offsets)
        doc = np.repeat(np.arange(len(self.size)), np.maximum(self.size - length + 1, 0))
        starts = ranges(block.offsets[:-1], np.maximum(self.size - length + 1, 0))
        if not len(starts):
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            self.trigger = self.phrase = np.zeros(0, U64)
            return
        rolling = Rolling(block.data, BASES[0])
        grams = rolling.every(trigger)
        least = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
        least = sliding_min(least, length - trigger + 1)
        at = (least[starts] & U64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        self.first, self.last, self.doc = starts[head], starts[tail], doc[head]
        self.trigger = grams[at[head]]
        del least, starts, doc, grams
        spans = Rolling(block.data, BASES[1]).spans(self.first, self.last + length)
        self.phrase = mixed(spans ^ mixed((at[head] - self.first).astype(U64) + (self.last - self.first).astype(U64) * U64(1 << 32)))

    def dictionary(self) -> tuple[np.ndarray, np.ndarray]:
        """(first occurrence of each distinct phrase, in text order; the place in it of every phrase)."""
        order, number = groups(self.trigger, self.phrase)
        heads = np.concatenate([[True], number[1:] != number[:-1]]) if len(order) else np.zeros(0, bool)
        one = order[heads]
        rank = np.argsort(one)
        place = np.empty(len(one), np.int64)
        place[rank] = np.arange(len(one))
        back = np.empty(len(order), np.int64)
        back[order] = place[number] if len(order) else number
        return one[rank], back


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _trigger_bucket(trigger: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mixed(trigger) % U64(n_buckets)).astype(np.int64)


def _phrases_sent(parse: Parse, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first occurrence of each distinct phrase in order of sending, its bucket, distinct number of every phrase)."""
    one, number = parse.dictionary()
    return one, _trigger_bucket(parse.trigger[one], n_buckets), number


def _send_phrases(n_buckets: int, length: int):
    def run(block: Block) -> pa.Table:
        parse = Parse(block, length)
        one, bucket, _ = _phrases_sent(parse, n_buckets)
        trigger = parse.trigger[one]
        columns = [(trigger >> U64(32)).astype(np.uint32), (trigger >> U64(16)).astype(np.uint16), parse.phrase[one], narrow(block.ids[parse.doc[one]])]
        return packed_rows(block.number, bucket, n_buckets, columns)

    return run


def _judge_phrases(many_phrases: int):
    def run(payloads: list[list[np.ndarray]]) -> list[bytes | None]:
        """Flags for each phrase sent: SEEN, or OPEN (with SPLIT) where the trigger has other phrases."""
        counts = [len(p[0]) for p in payloads]
        trigger = (joined(payloads, 0).astype(U64) << U64(16)) | joined(payloads, 1)
        phrase, owner = joined(payloads, 2), joined(payloads, 3, np.int64)
        order, number = groups(trigger, phrase, owner)
        t, p = trigger[order], phrase[order]
        new_trigger = np.concatenate([[True], t[1:] != t[:-1]])
        new_phrase = new_trigger | np.concatenate([[True], p[1:] != p[:-1]])
        of_trigger = np.cumsum(new_trigger) - 1
        variants = np.bincount(of_trigger, weights=new_phrase).astype(np.int64)[of_trigger]
        holders = np.zeros(len(order), np.uint8)
        holders[new_phrase & (variants > 1)] = OPEN
        holders[new_phrase & (variants > many_phrases)] = OPEN | SPLIT
        holders[~new_phrase] = SEEN
        flags = np.empty(len(order), np.uint8)
        flags[order] = holders
        out, at = [], 0
        for n in counts:
            mine = flags[at : at + n]
            found = np.flatnonzero(mine)
            out.append(pack(smallest(found), mine[found]) if len(found) else None)
            at += n
        return out

    return run


def _flags(parse: Parse, replies: dict[int, list[np.ndarray]], n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first occurrences, flags of the distinct phrases, distinct number of every phrase)."""
    one, bucket, number = _phrases_sent(parse, n_buckets)
    order, bounds = to_buckets(bucket, n_buckets)
    flags = np.zeros(len(one), np.uint8)
    for b, (place, flag) in replies.items():
        flags[order[bounds[b] + place.astype(np.int64)]] = flag
    return one, flags, number


def _questions(parse: Parse, one: np.ndarray, flags: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, owner, bucket) of the byte strings whose suffixes are in question, in order of sending.

    An open phrase is asked whole, in its trigger's bucket; a split one string by string.
    """
    whole, split = one[flags == OPEN], one[flags == OPEN | SPLIT]
    starts, ends, owners, bucket = parse.first[whole], parse.last[whole] + parse.length, parse.doc[whole], _trigger_bucket(parse.trigger[whole], n_buckets)
    if len(split):
        counts = parse.last[split] - parse.first[split] + 1
        s = ranges(parse.first[split], counts)
        hashes = Rolling(parse.block.data, BASES[0]).spans(s, s + parse.length)
        doc = np.repeat(parse.doc[split], counts)
        order, number = groups(hashes, doc)
        head = order[np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])]
        # equal strings of a block are asked once, for the first document; _verdicts spreads the answer
        starts, ends = np.concatenate([starts, s[head]]), np.concatenate([ends, s[head] + parse.length])
        owners, bucket = np.concatenate([owners, doc[head]]), np.concatenate([bucket, (hashes[head] % U64(n_buckets)).astype(np.int64)])
    return starts, ends, owners, bucket


def _send_questions(n_buckets: int, length: int):
    def run(block: Block, replies: pa.Table) -> pa.Table:
        parse = Parse(block, length)
        one, flags, _ = _flags(parse, replies_by_bucket(replies), n_buckets)
        starts, ends, owners, bucket = _questions(parse, one, flags, n_buckets)
        order, bounds = to_buckets(bucket, n_buckets)
        full = np.flatnonzero(np.diff(bounds))
        payloads = []
        for b in full.tolist():
            mine = order[bounds[b] : bounds[b + 1]]
            payloads.append(pack(smallest(ends[mine] - starts[mine]), narrow(block.ids[owners[mine]]), block.data[ranges(starts[mine], ends[mine] - starts[mine])]))
        return pa.table([pa.array(full, pa.int64()), pa.array(np.full(len(full), block.number), pa.int64()), pa.array(payloads, pa.binary())], names=PACKED.names)

    return run


def dictionary_order(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, number of the run of equal strings at each place of it) of the suffixes at ``places``, by their first ``length`` bytes.

    Suffixes are compared by big-endian words of eight bytes, the first word first.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    eight = np.zeros(len(data) + 1, U64)
    for j in range(8):
        eight = (eight << U64(8)) | padded[j : j + len(eight)]
    if length < 8:
        return groups(eight[places] >> U64(8 * (8 - length)))
    return groups(*[eight[places + min(k, length - 8)] for k in range(0, length, 8)])


def _answer_questions(length: int):
    def run(payloads: list[list[np.ndarray]]) -> list[bytes | None]:
        """For each payload, the places (among the suffixes it sent) of strings that an earlier document holds."""
        sizes, owners, data = joined(payloads, 0, np.int64), joined(payloads, 1, np.int64), joined(payloads, 2)
        counts = sizes - length + 1
        places = ranges(np.cumsum(sizes) - sizes, counts)
        owner = np.repeat(owners, counts)
        order, number = dictionary_order(data, places, length)
        first = np.full(int(number[-1]) + 1 if len(number) else 0, NO_ID, np.int64)
        np.minimum.at(first, number, owner[order])
        repeat = np.zeros(len(places), bool)
        repeat[order] = owner[order] > first[number]
        out, at, doc = [], 0, 0
        for p in payloads:
            n = int(counts[doc : doc + len(p[0])].sum())
            found = np.flatnonzero(repeat[at : at + n])
            out.append(pack(smallest(found)) if len(found) else None)
            at, doc = at + n, doc + len(p[0])
        return out

    return run


def _repeats(parse: Parse, first_replies: dict, second_replies: dict, n_buckets: int) -> np.ndarray:
    """Marks the first byte of every string that starts in an earlier document too."""
    block, length = parse.block, parse.length
    marked = np.zeros(len(block.data) + 1, bool)
    if not len(parse.first):
        return marked
    one, flags, number = _flags(parse, first_replies, n_buckets)
    owner = block.ids[parse.doc[one]]
    # a phrase seen in an earlier document, or here in a smaller id
    whole = (flags[number] == SEEN) | (block.ids[parse.doc] > owner[number])
    marked[ranges(parse.first[whole], (parse.last - parse.first + 1)[whole])] = True
    starts, ends, _, bucket = _questions(parse, one, flags, n_buckets)
    order, bounds = to_buckets(bucket, n_buckets)
    asked = ends - starts - length + 1
    for b, (places,) in second_replies.items():
        mine = order[bounds[b] : bounds[b + 1]]
        at = ranges(starts[mine], asked[mine])[places.astype(np.int64)]
        marked[at] = True
    split = one[flags == OPEN | SPLIT]
    if len(split):
        _spread_split(parse, split, marked)
    # an open phrase's other occurrences in the same document repeat what holds for the first
    again = (flags[number] & OPEN > 0) & (block.ids[parse.doc] == owner[number])
    again[one] = False
    if again.any():
        source, target = one[number[again]], np.flatnonzero(again)
        counts = (parse.last - parse.first + 1)[target]
        marked[ranges(parse.first[target], counts)] |= marked[ranges(parse.first[source], counts)]
    return marked


def _spread_split(parse: Parse, split: np.ndarray, marked: np.ndarray) -> None:
    """Strings of split phrases: what was asked once for a block's first owner holds for all with that string."""
    counts = parse.last[split] - parse.first[split] + 1
    s = ranges(parse.first[split], counts)
    hashes = Rolling(parse.block.data, BASES[0]).spans(s, s + parse.length)
    ids = parse.block.ids[np.repeat(parse.doc[split], counts)]
    order, _ = groups(hashes, ids)
    run = np.cumsum(np.concatenate([[False], hashes[order][1:] != hashes[order][:-1]]))
    head = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    repeat = marked[s[order[head]]][run] | (ids[order] > ids[order[head]][run])
    marked[s[order[repeat]]] = True


RESULT = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def _whole_characters(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """``removed`` widened to every byte of a UTF-8 character that loses one."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first):
        return removed
    broken = np.logical_or.reduceat(removed, first)
    out = removed.copy()
    out[first[0] :] = np.repeat(broken, np.diff(np.append(first, len(data))))
    return out


def _finish(n_buckets: int, length: int, whole: bool):
    def run(block: Block, replies: pa.Table) -> pa.Table:
        parse = Parse(block, length)
        second = np.asarray(replies.column("bucket")) >= n_buckets
        first_replies = replies_by_bucket(replies.filter(pa.array(~second)))
        second_replies = {b - n_buckets: r for b, r in replies_by_bucket(replies.filter(pa.array(second))).items()}
        marked = _repeats(parse, first_replies, second_replies, n_buckets)
        at = np.flatnonzero(marked)
        step = np.bincount(at, minlength=len(marked) + length) - np.bincount(at + length, minlength=len(marked) + length)
        removed = np.cumsum(step)[: len(block.data)] > 0
        if whole:
            removed = _whole_characters(block.data, removed)
        sums = np.concatenate([[0], np.cumsum(removed)])
        edge = np.zeros(len(removed) + 1, bool)
        edge[block.offsets[:-1]] = True
        begins = removed & (edge[:-1] | ~np.concatenate([[False], removed[:-1]])) if len(removed) else removed
        spans = np.concatenate([[0], np.cumsum(begins)])
        kept = block.data[~removed]
        bounds = block.offsets - sums[block.offsets]
        raw = kept.tobytes()
        pieces = [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        return pa.table([ids, pa.array(np.diff(block.offsets)), pa.array(np.diff(sums[block.offsets])), pa.array(np.diff(spans[block.offsets])), pa.array(pieces, pa.binary()), *([block.table.column("row")] if whole else [])],
                        names=[*RESULT.names, *(["row"] if whole else [])])

    return run


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                   many_phrases: int = MANY_PHRASES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row, texts taken as UTF-8 bytes.

    Removed is each byte that lies in a string of ``length`` bytes which also starts in a document with a
    smaller id; strings are judged on the input. ``kept`` is the rest. Null and empty texts have no bytes. Rows with one id are one document for this purpose, each with its
    own result; a row with a null id comes after all others and never makes another lose bytes.
    """
    return _removed(docs, length, id_col, text_col, block_bytes, many_phrases, ())


def strip_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, many_phrases: int = MANY_PHRASES) -> DataFrame:
    """``docs``, every row and column, with the texts that ``remove_repeats`` leaves.

    A character that loses a byte goes whole, so texts stay valid; a text that loses all is empty, a null
    text stays null.
    """
    own = F.struct(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col(c) for c in docs.columns])
    row = F.struct(own.alias("own"), F.col(text_col).isNull().alias("empty")).alias("row")
    left = _removed(docs, length, id_col, text_col, block_bytes, many_phrases, (row,))
    text = F.when(~F.col("row.empty"), F.col("kept").cast("string"))
    return left.select(*[text.alias(c) if c == text_col else F.col("row.own").getField(c).alias(c) for c in docs.columns])


def _removed(docs: DataFrame, length: int, id_col: str, text_col: str, block_bytes: int, many_phrases: int, more: tuple) -> DataFrame:
    deal = dealt(docs, id_col, text_col, block_bytes, more=more)
    n = deal.n_buckets
    first = reduced(each_block(deal, _send_phrases(n, length), PACKED), deal, _judge_phrases(many_phrases))
    second = reduced(with_replies(deal, first, _send_questions(n, length), PACKED), deal, _answer_questions(length))
    replies = first.unionByName(second.withColumn("bucket", F.col("bucket") + n))
    result = T.StructType([*RESULT.fields, *[f for f in deal.rows.schema if f.name == "row"]])
    return with_replies(deal, replies, _finish(n, length, bool(more)), result)
