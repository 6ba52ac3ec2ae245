"""Hard negatives by Fagin's threshold algorithm, in integer arithmetic.

Rows are dealt into blocks, anchors into chunks, and every block meets every chunk once. A block sorts
its rows by each component. An anchor reads these lists at one depth in all of them, from the top where
its own component is positive and from the bottom where it is negative, scores every row it has not
seen, and stops once the threshold, the score of a row that had the last value read in each list, falls
strictly below the k-th score it holds. A first pass finds the positives, a second the negatives of
every positive's window of scores; the best of a block are merged over the blocks in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import materialize

#: Components of a block of rows and of a chunk of anchors: 16,384 vectors of 64.
BLOCK_CELLS, CHUNK_CELLS = 1 << 20, 1 << 20
#: Blocks are cut down to this many rows to occupy the session's partitions.
LEAST_BLOCK_ROWS = 4096
#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Depth of the first round of sorted access; each further round reads so many times as deep.
FIRST_DEPTH, DEEPER = 16, 4
#: Integers below this are exact in double precision.
EXACT = 1 << 53
LONGEST = (1 << 63) - 1

_PAIR = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "other", "score")])
_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "positive", "positive_score", "negative", "negative_score")])


def floored(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as doubles; as Python integers where a double could overflow."""
    if np.abs(vectors).max(initial=0.0) < 2.0**960:
        return np.floor(SCALE * vectors)
    return np.array([[int(x) * SCALE if abs(x) >= EXACT else int(np.floor(SCALE * x)) for x in row] for row in vectors.tolist()], object).reshape(vectors.shape)


def exact_pair(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type in which every inner product of theirs is exact."""
    most = max(1, int(np.abs(rows).max(initial=0))) * max(1, int(np.abs(anchors).max(initial=0))) * max(1, rows.shape[1])
    if most < EXACT:
        return rows.astype(np.float64), anchors.astype(np.float64)
    return tuple(np.array([[int(x) for x in v] for v in m.tolist()], object).reshape(m.shape) for m in (rows, anchors))


def as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; what lies outside counts as the nearest of them."""
    if scores.dtype == object:
        scores = np.array([min(max(int(s), -LONGEST - 1), LONGEST) for s in scores], np.int64)
    return scores.astype(np.int64)


class Lists:
    """Rows of a block by every component, falling."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(-rows, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(rows.T, self.order, axis=1)

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Per round: rows seen for the first time, their scores, and the threshold (None: no row is left)."""
        n = len(self.rows)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, depth = np.zeros(n, bool), 0
        while depth < n:
            last, depth = depth, min(n, max(FIRST_DEPTH, depth * DEEPER)) if len(up) + len(down) else n
            now = np.zeros(n, bool)
            now[self.order[up, last:depth]] = True
            now[self.order[down, n - depth : n - last]] = True
            if depth == n:
                now[:] = True
            new = np.flatnonzero(now & ~seen)
            seen[new] = True
            # Gathering most rows costs more than the whole product.
            scores = (self.rows @ anchor)[new] if 4 * len(new) > n else self.rows[new] @ anchor
            if depth == n or seen.all():
                yield new, as_long(scores), None
                return
            bound = (self.values[up, depth - 1] * anchor[up]).sum() + (self.values[down, n - depth] * anchor[down]).sum()
            yield new, as_long(scores), int(as_long(np.array([bound], scores.dtype))[0])


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores, ties by smaller id."""
    if len(scores) > 4 * top:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - top)[len(scores) - top])
        return near[np.lexsort([ids[near], ~scores[near]])[:top]]
    return np.lexsort([ids, ~scores])[:top]


def top_positives(lists: Lists, ids: np.ndarray, labels: np.ndarray, anchor: np.ndarray, own: int, label: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the anchor's best other rows of its label in a block."""
    held, held_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for new, scores, bound in lists.walk(anchor):
        fit = (labels[new] == label) & (ids[new] != own)
        held, held_ids = np.concatenate([held, scores[fit]]), np.concatenate([held_ids, ids[new[fit]]])
        keep = best(held, held_ids, top)
        held, held_ids = held[keep], held_ids[keep]
        if bound is None or (len(held) == top and bound < held[-1]):
            break
    return held_ids, held


def window_negatives(lists: Lists, ids: np.ndarray, labels: np.ndarray, anchor: np.ndarray, label: int, positives: Sequence[int], least: int, most: int,
                     top: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per positive score p: (ids, scores) of the best rows of other labels with least * p <= 100 * score <= most * p."""
    # Whole-number ends of each window, so that nothing overflows.
    ends = {p: (-(-least * p // 100), most * p // 100) for p in set(positives)}
    held = {p: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for p, (low, high) in ends.items() if low <= high}
    open_windows = set(held)
    if not open_windows:
        return held
    for new, scores, bound in lists.walk(anchor):
        other = labels[new] != label
        scores, new_ids = scores[other], ids[new[other]]
        for p in list(open_windows):
            low, high = ends[p]
            fit = (scores >= low) & (scores <= high)
            found_ids, found = np.concatenate([held[p][0], new_ids[fit]]), np.concatenate([held[p][1], scores[fit]])
            keep = best(found, found_ids, top)
            held[p] = (found_ids[keep], found[keep])
            if bound is not None and (bound < low or (len(keep) == top and bound < held[p][1][-1])):
                open_windows.discard(p)
        if not open_windows:
            break
    return held


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vector) of the rows that take part, one an id.

    Left out: a null id, label or vector, a null or non-finite component. Of several rows with one id the
    smallest by label and vector counts. Vectors of different length have no inner product: they are no
    partners of each other.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    one = whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("id", "row.label", "row.vector")


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = np.asarray(table.column(name).combine_chunks().flatten(), np.float64)
    return floored(flat.reshape(table.num_rows, len(flat) // max(1, table.num_rows)))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name).combine_chunks(), np.int64)


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _meetings(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int, each, schema: T.StructType) -> DataFrame:
    """``each(lists, ids, labels, anchor vectors, anchors)`` of every block and chunk of one vector length."""
    dim = F.size("vector").alias("dim")
    blocks = rows.select(dim, F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("block"), _each(n_chunks).alias("chunk"), "*")
    chunks = anchors.select(dim, _each(n_blocks).alias("block"), F.pmod(F.xxhash64("id", F.lit("chunk")), F.lit(n_chunks)).alias("chunk"),
                            *[F.col(c).alias(f"anchor_{c}") for c in anchors.columns])  # both sides stem from one table
    names = [f.name for f in schema.fields]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            matrix, anchor_matrix = exact_pair(_matrix(left, "vector"), _matrix(right, "anchor_vector"))
            found = each(Lists(matrix), _numbers(left, "id"), _numbers(left, "label"), anchor_matrix, right)
        columns = zip(*found) if found else [[]] * len(names)
        return pa.table([pa.array(np.concatenate(c) if len(c) else [], pa.int64()) for c in columns], names=names)

    key = ["dim", "block", "chunk"]
    return blocks.groupBy(*key).cogroup(chunks.groupBy(*key)).applyInArrow(meet, schema)


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", block_cells: int = BLOCK_CELLS, chunk_cells: int = CHUNK_CELLS, least_block_rows: int = LEAST_BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row for which ``is_anchor`` (a column of ``id``) holds.

    Scores are integer inner products of floor(256 * x). An anchor's positives are its best ``positives``
    rows of its label and another id; for each, the best ``negatives`` rows of another label whose score
    is between ``least`` and ``most`` percent of the positive's (none where that is negative). Ties go to
    the smaller id. See ``usable`` for the rows that take part; fewer come where there are fewer.
    """
    rows = materialize(usable(vectors, id_col, vector_col, label_col), "hard-negatives")
    anchors = rows.filter(is_anchor)
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, cells = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("vector").cast("long")), F.lit(0))).first()
    n_blocks = max(1, -(-cells // block_cells), min(partitions, n // least_block_rows))
    n_chunks = max(1, -(-(anchors.agg(F.sum(F.size("vector").cast("long"))).first()[0] or 0) // chunk_cells))

    def positives_of(lists, ids, labels, matrix, right):
        for anchor, own, label in zip(matrix, _numbers(right, "anchor_id").tolist(), _numbers(right, "anchor_label").tolist()):
            found, scores = top_positives(lists, ids, labels, anchor, own, label, positives)
            yield np.full(len(found), own), found, scores

    pairs = _meetings(rows, anchors, n_blocks, n_chunks, lambda *a: list(positives_of(*a)), _PAIR)
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "other"))
    chosen = pairs.withColumn("place", first).filter(F.col("place") <= positives)
    windows = chosen.groupBy("anchor").agg(F.collect_list("other").alias("others"), F.collect_list("score").alias("scores"))
    searched = anchors.join(windows, F.col("id") == F.col("anchor")).drop("anchor")

    def negatives_of(lists, ids, labels, matrix, right):
        others, wanted = right.column("anchor_others").to_pylist(), right.column("anchor_scores").to_pylist()
        for anchor, own, label, near, scores in zip(matrix, _numbers(right, "anchor_id").tolist(), _numbers(right, "anchor_label").tolist(), others, wanted):
            held = window_negatives(lists, ids, labels, anchor, label, scores, least, most, negatives)
            for positive, score in zip(near, scores):
                found, values = held.get(score, ((), ()))
                yield tuple(np.full(len(found), x, np.int64) for x in (own, positive, score)) + (np.asarray(found, np.int64), np.asarray(values, np.int64))

    found = _meetings(rows, searched, n_blocks, n_chunks, lambda *a: list(negatives_of(*a)), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return ranked.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", "negative_score")
