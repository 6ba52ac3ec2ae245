"""Near-duplicate documents by one-permutation MinHash.

Each distinct set of five-word shingles gets one signature: one hash throws its shingles into bins, the
smallest of each bin stands for it, and empty bins borrow from bins that a second hash names (optimal
densification). Bands of the signature are bucket keys.

1. Star: the centre of a bucket is its smallest member; each document is paired with the two centres it
   shares most buckets with, so there are at most two pairs a document, whatever the size of a bucket.
   Pairs are confirmed on the full sets, and components formed.
2. The rest: members of a bucket that still lie in different components are compared by signature, and
   where that says likely, on the full sets, inside one task for each pair of chunks of the bucket. Pairs
   within a component can't change the result; no pair travels.

A link is only ever made by exact intersection and union sizes of full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.arrays import BASES, U64, Rolling, byte_column, cut_words, lowered, mixed, ranges, release, text_slices
from tabforge.llm.window_dedup import WORD_BYTES
from tabforge.operators.components import connected_components
from tabforge.session import files_for, materialize

SHINGLE_WORDS = 5
#: Bands times rows is the number of bins. At similarity 0.75 all bands miss a pair with probability 3e-7.
BANDS, BAND_ROWS = 40, 4
BINS = BANDS * BAND_ROWS
#: A pair is likely when its signatures agree on this share of the bins, five deviations below 0.75.
LIKELY = 0.58
#: Signatures of smaller sets say little: such pairs are always compared.
SMALL_SET = 64
#: Centres that a member is first compared with.
STAR_CENTRES = 2
#: Members of one bucket, and of one side of a star, that meet in one place.
CHUNK_ROWS = 512
STAR_ROWS = 256
#: Ids up to which the texts to be confirmed are picked by a broadcast; beyond, by a shuffled join.
BROADCAST_IDS = 400_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of every text, ascending; a shorter text has its whole word sequence as one."""
    data = lowered(data)
    starts, ends, counts = cut_words(data, offsets, WORD_BYTES)
    symbols = Rolling(data, BASES[0]).spans(starts, ends)
    length = np.minimum(counts, words)
    n = np.where(counts > 0, counts - length + 1, 0)
    doc = np.repeat(np.arange(len(counts)), n)
    at = ranges(np.cumsum(counts) - counts, n)
    hashes = Rolling(symbols, BASES[1]).spans(at, at + length[doc])
    order = np.argsort(hashes)
    order = order[np.argsort(doc[order].astype(np.uint16) if len(counts) < 1 << 16 else doc[order], kind="stable")]
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(counts) + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` 32-bit values per non-empty set."""
    sizes = np.diff(bounds)
    m = len(sizes)
    doc = np.repeat(np.arange(m), sizes)
    thrown = mixed(hashes ^ U64(0x51ED270B0F4F6E3D))
    bin_ = ((thrown >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(m * bins, empty, U64)
    np.minimum.at(least, doc * bins + bin_, thrown & U64(0xFFFFFFFF))
    filled = least != empty
    out = least.copy()
    hole = np.flatnonzero(~filled)
    attempt = 0
    while len(hole):
        attempt += 1
        own = (hole % bins).astype(U64)
        other = (mixed(own * U64(0x9E3779B9) + U64(attempt << 20)) % U64(bins)).astype(np.int64)
        source = hole - hole % bins + other
        found = filled[source]
        out[hole[found]] = least[source[found]]
        hole = hole[~found]
    return out.astype(np.uint32).reshape(m, bins)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per set and band."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(U64)
    key = np.broadcast_to(mixed(np.arange(BANDS, dtype=U64)), parts.shape[:2]).copy()
    for r in range(BAND_ROWS):
        key = mixed(key ^ (parts[:, :, r] + U64(1 + r) * U64(1 << 33)))
    return key


SKETCH = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("signature", T.BinaryType())])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        hashes, bounds = shingle_sets(*byte_column(part.column(1)))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        rows = signatures(hashes, np.append(bounds[:-1][full], bounds[-1])) if len(full) else np.zeros((0, BINS), np.uint32)
        sums = [np.zeros(len(sizes), U64), np.zeros(len(sizes), U64)]
        if len(full):
            for s, salt in zip(sums, (0x1234567, 0xABCDEF01)):
                s[full] = np.add.reduceat(mixed(hashes + U64(salt)), bounds[:-1][full])
        raw = rows.tobytes()
        width = BINS * 4
        signature: list[bytes | None] = [None] * len(sizes)
        for i, row in enumerate(full.tolist()):
            signature[row] = raw[i * width : (i + 1) * width]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(signature, pa.binary())], names=SKETCH.names)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(np.asarray(batch.column(0)), BANDS))], names=["key", "id"])


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = byte_column(column)
    return data.view(np.uint32).reshape(-1, BINS)


def _may_link(n_a: np.ndarray, n_b: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Sizes allow similarity 0.75, and signatures make it likely or the sets are small."""
    small = np.minimum(n_a, n_b)
    return (4 * small >= 3 * np.maximum(n_a, n_b)) & ((small < SMALL_SET) | (agree >= LIKELY))


def _likely_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs, given with both sizes and signatures, that may link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, n_a, n_b = (np.asarray(batch.column(i)) for i in range(4))
        keep = _may_link(n_a, n_b, (_matrix(batch.column(4)) == _matrix(batch.column(5))).mean(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _texts_of(ids: DataFrame, docs: DataFrame, n: int | None) -> DataFrame:
    """The documents with these ids, ``n`` at most where that is known; the ids are broadcast up to ``BROADCAST_IDS`` and joined by a shuffle beyond."""
    ids = materialize(ids, "ids", None if n is None else files_for(n, 8))
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _confirmed(pairs: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= 75 * union; ``docs`` has id and text, and ``n`` rows.

    ``a`` is a star's centre. Its text goes once to each group of up to about ``STAR_ROWS`` of its partners.
    """
    files = files_for(STAR_CENTRES * n, 16)
    pairs = materialize(pairs.distinct(), "pairs", files)
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, n)
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_ROWS).alias("parts"))
    members = pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    centres = groups.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    sent = members.join(texts, members.b == texts.id).select("a", "part", F.lit(1).alias("kind"), "b", "text")
    first = centres.join(texts, centres.a == texts.id).select("a", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("b"), "text")
    met = first.unionByName(sent).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
    return met.mapInArrow(_compare, PAIR).repartition(files)  # a comparison each task, a file for all of them


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a centre, then its partners."""
    own, sets = None, []
    for part in text_slices(batches, "text"):
        hashes, bounds = shingle_sets(*byte_column(part.column(4)))
        a, group, kind, b = (np.asarray(part.column(i)) for i in range(4))
        found = []
        for i in range(len(a)):
            mine = hashes[bounds[i] : bounds[i + 1]]
            if own != (a[i], group[i]):
                own, sets = (a[i], group[i]), []
            if kind[i] == 0:
                sets.append(mine.copy())  # more than one where rows share the id
            elif any(_similar(s, mine) for s in sets):
                found.append((int(a[i]), int(b[i])))
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])


def _similar(one: np.ndarray, other: np.ndarray) -> bool:
    if not len(one) or not len(other):
        return False
    both = int((one[np.minimum(np.searchsorted(one, other), len(one) - 1)] == other).sum())
    return 100 * both >= 75 * (len(one) + len(other) - both)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows that come sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(i)) for i in range(keys)])
        starts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            if held and last != key[:, start].tolist():
                yield _one(held)
                held = []
            last = key[:, start].tolist()
            held.append(batch.slice(start, end - start))
    if held:
        yield _one(held)
    release()


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _group_pairs(key: int, other: np.ndarray, ids: np.ndarray, root: np.ndarray, n: np.ndarray, signature: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row of an other, rows of the members it has to be compared with) in a bucket's pair of chunks.

    A pair that shares several buckets is compared in the one of its first common band.
    """
    bands = band_keys(signature).view(np.int64)
    members = np.flatnonzero(other == 0)
    for i in np.flatnonzero(other == 1).tolist():
        rest = members[(root[members] != root[i]) & (ids[members] != ids[i])]
        if len(rest):
            common = bands[rest] == bands[i]
            here = bands[i][common.argmax(axis=1)] == key
            rest = rest[here]
            rest = rest[_may_link(n[rest], np.full(len(rest), n[i]), (signature[rest] == signature[i]).mean(axis=1))]
        if len(rest):
            yield i, rest


OPEN = T.StructType([*[T.StructField(c, T.LongType()) for c in ("key", "left", "right")], T.StructField("other", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("root", T.LongType())])


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a bucket's pair of chunks that take part in a comparison."""
    out: list[pa.RecordBatch] = []
    size = 0
    for group in _grouped(batches, 3):
        other, ids, root, n = (np.asarray(group.column(i)) for i in (3, 4, 5, 6))
        used = np.zeros(group.num_rows, bool)
        if other.any() and not other.all():
            for i, rest in _group_pairs(int(group.column(0)[0].as_py()), other, ids, root, n, _matrix(group.column(7))):
                used[i] = True
                used[rest] = True
        if used.any():
            out.append(group.select(OPEN.names).filter(pa.array(used)))
            size += out[-1].num_rows
        if size > 10_000:
            yield _one(out)
            out, size = [], 0
    if out:
        yield _one(out)


def _open_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the rows of a bucket's pair of chunks, now with their texts."""
    for group in _grouped(batches, 3):
        hashes, bounds = shingle_sets(*byte_column(group.column(6)))
        full = np.flatnonzero(np.diff(bounds))  # an id of several texts may bring an empty one
        group = group.take(pa.array(full))
        sets = [hashes[bounds[i] : bounds[i + 1]] for i in full.tolist()]
        other, ids, root = (np.asarray(group.column(i)) for i in (3, 4, 5))
        found: list[tuple[int, int]] = []
        if len(full):
            signature = signatures(hashes, np.append(bounds[:-1][full], bounds[-1]))
            for i, rest in _group_pairs(int(group.column(0)[0].as_py()), other, ids, root, np.array([len(s) for s in sets]), signature):
                found += [(min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))) for j in rest.tolist() if _similar(sets[i], sets[j])]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])


def _roots(nodes: DataFrame, links: DataFrame, n: int, most_links: int | None = None) -> DataFrame:
    """(id, root) of every node, ``n`` at most: the smallest id that links lead to."""
    found = connected_components(links.select(F.lit(0).alias("g"), "a", "b"), most_edges=most_links).select(F.col("node").alias("id"), "root")
    return materialize(nodes.join(found, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "roots", files_for(n, 16))


def _star_pairs(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """Likely pairs of a bucket's smallest member (a) and another member (b).

    A member takes the centres it shares most buckets with, ``STAR_CENTRES`` of them (ties: the smaller
    id); what they don't connect, ``_rest_pairs`` compares.
    """
    centres = keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z").select("key", "a")
    shared = keys.join(centres, "key").filter("id <> a").groupBy(F.col("id").alias("b"), "a").agg(F.count("*").alias("n"))
    ranked = shared.groupBy("b").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "a"))), 1, STAR_CENTRES).alias("top"))
    pairs = ranked.select("b", F.explode("top").alias("t")).select(F.col("t.a").alias("a"), "b")
    return _with_sketches(pairs, nodes).mapInArrow(_likely_pairs, PAIR)


def _with_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    left = nodes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    right = nodes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "s_a", "s_b")


def _rest_links(keys: DataFrame, nodes: DataFrame, roots: DataFrame, docs: DataFrame, n: int | None = None) -> DataFrame:
    """Links between a bucket's members that lie in different components.

    Members outside the bucket's largest component (the others) meet all members; both sides are cut
    into chunks, so a task sees one pair of chunks of a bucket of any size. Signatures tell who may link
    with whom; the texts of those rows, and no pairs, are then sent to be compared.
    """
    placed = keys.join(roots, "id")
    counts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mains = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("m")).select(
        "key", F.col("top.root").alias("main"), F.ceil((F.col("m") - F.col("top.n")) / CHUNK_ROWS).alias("lefts"), F.ceil(F.col("m") / CHUNK_ROWS).alias("rights")).filter("lefts > 0")
    rows = placed.join(mains, "key")

    def spread(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    members = rows.select("key", spread("lefts").alias("left"), F.pmod(F.xxhash64("id"), F.col("rights")).alias("right"), F.lit(0).alias("other"), "id", "root")
    others = rows.filter("root <> main").select("key", F.pmod(F.xxhash64("id"), F.col("lefts")).alias("left"), spread("rights").alias("right"), F.lit(1).alias("other"), "id", "root")
    met = members.unionByName(others).join(nodes, "id").select("key", "left", "right", "other", "id", "root", "n", "signature")
    met = met.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    rows = materialize(met.mapInArrow(_open_rows, OPEN), "open")
    texts = _texts_of(rows.select("id").distinct(), docs, n)
    return rows.join(texts, "id").select(*OPEN.names, "text").repartition("key", "left", "right").sortWithinPartitions("key", "left", "right").mapInArrow(_open_links, PAIR)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Documents with 100 * intersection >= 75 * union of their sets of five-word shingles (words
    `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) are linked; ``component_id`` is the smallest id that can be
    reached, and ``kept`` marks the row that has it. Texts without words link with nothing. Equal sets
    are one class, however many copies it has; only its smallest id is compared. Rows with one id are
    one document, linked by any of its texts. A null id links with nothing, has no component and is kept.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketches = materialize(rows.mapInArrow(_sketches, SKETCH), "sketches")
    count = sketches.count()
    full = sketches.filter("id is not null and n > 0")
    classes = full.groupBy("a", "b", "n").agg(F.min("id").alias("rep"))
    members = materialize(full.select("id", "a", "b", "n").distinct().join(classes, ["a", "b", "n"]).select("id", "rep", "a", "b", "n"), "members", files_for(count, 40))
    own = members.filter("id = rep").select("id", "a", "b", "n")
    nodes = materialize(sketches.join(own, ["id", "a", "b", "n"]).dropDuplicates(["id", "a", "b", "n"]).select("id", "n", "signature"), "classes", files_for(count, 16 + 4 * BINS))
    keys = materialize(nodes.select("id", "signature").mapInArrow(_key_rows, T.StructType([T.StructField("key", T.LongType()), T.StructField("id", T.LongType())])).distinct(), "keys", files_for(count, 16 * BANDS))
    texts = rows.filter("id is not null")
    star = materialize(_confirmed(_star_pairs(keys, nodes), texts, count), "links")
    # an id that stands in several classes joins them
    least = members.groupBy("id").agg(F.min("rep").alias("a"))
    several = members.select("id", "rep").join(least, "id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    roots = _roots(nodes.select("id").distinct(), star.unionByName(several), count, (STAR_CENTRES + 1) * count)
    rest = _rest_links(keys, nodes, roots, texts, count)
    ends = rest.join(roots.select(F.col("id").alias("a"), F.col("root").alias("r")), "a").join(roots.select(F.col("id").alias("b"), F.col("root").alias("s")), "b")
    joined = ends.filter("r <> s").select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b"))
    merged = _roots(roots.select(F.col("root").alias("id")).distinct(), joined, count)
    final = roots.join(merged.select(F.col("root").alias("top"), F.col("id").alias("root")), "root").select("id", "top")
    component = members.groupBy("id").agg(F.min("rep").alias("rep")).join(final.withColumnRenamed("id", "rep"), "rep").select("id", F.col("top").alias("component"))
    found = sketches.select("id", F.col("n").alias("n_shingles")).join(component, "id", "left")
    return found.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group, columns as they are.

    Rows with one id are one document and stay or go together; rows with a null id, an empty or a null text stay.
    """
    gone = near_duplicates(docs, id_col, text_col).filter(~F.col("kept")).select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
