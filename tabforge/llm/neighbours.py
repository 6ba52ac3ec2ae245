"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree.

The tree is fitted on a sample of at most ``most_rows`` vectors, then every vector is put into a leaf.
A coordinate sqrt(M**2 - |x|**2), M the largest norm, makes the largest inner product the smallest
distance. A query walks the tree best bin first: a priority queue holds nodes by their centre's distance,
the nearest is opened, and leaves are visited in the order they come out. How many are visited is widened
until queries with exact answers show the wanted recall. Leaves are packed into groups of bounded size
(a large leaf lies in several); a query meets a group once, with the list of the leaves it visits there,
and takes away one list of neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import materialize

#: Vectors of the sample that the tree is fitted on, at most.
SAMPLE_ROWS = 60_000
#: Vectors a leaf should hold; the sample holds at least ``LEAST_SAMPLE`` of each leaf.
LEAF_ROWS, LEAST_SAMPLE = 256, 6
BRANCHES = 8
#: Vectors of a group and queries that meet them at a time.
CHUNK_ROWS, QUERY_ROWS = 4096, 512
#: Candidates beyond the wanted ones that a matrix product preselects, for what rounding can't tell apart.
SPARE = 8
#: Queries with exact answers, at most, and the recall they must show.
CALIBRATION_QUERIES, WANTED_RECALL = 96, 0.94


def kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Assignment of points to at most k centres, from k-means++ starts."""
    centres = [points[rng.integers(len(points))]]
    gap = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and gap.sum() > 0:
        centres.append(points[rng.choice(len(points), p=gap / gap.sum())])
        gap = np.minimum(gap, ((points - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(rounds):
        near = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Tree:
    """Inner nodes hold the centres of their children; ``leaf`` is a leaf's number, -1 for an inner node."""

    def __init__(self, points: np.ndarray, leaf_points: int, largest: float, seed: int = 5):
        self.largest = largest
        self.children: list[np.ndarray] = []
        self.centres: list[np.ndarray] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        todo = [(self._node(), self.raised(points))]
        while todo:
            node, own = todo.pop()
            parts = self._split(own, leaf_points, rng)
            if len(parts) < 2:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            numbers = [self._node() for _ in parts]
            self.children[node] = np.array(numbers)
            self.centres[node] = np.array([p.mean(axis=0) for p in parts])
            todo += zip(numbers, parts)

    def _node(self) -> int:
        self.children.append(np.zeros(0, np.int64))
        self.centres.append(np.zeros((0, 0)))
        self.leaf.append(-1)
        return len(self.leaf) - 1

    @staticmethod
    def _split(points: np.ndarray, leaf_points: int, rng: np.random.Generator) -> list[np.ndarray]:
        if len(points) <= leaf_points:
            return [points]
        near = kmeans(points, min(BRANCHES, -(-len(points) // leaf_points) + 1), rng)
        return [points[near == c] for c in np.unique(near)]

    def raised(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that evens out their norms."""
        rest = np.sqrt(np.maximum(self.largest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at each node."""
        points, out = self.raised(vectors), np.empty(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            c = self.centres[node]
            near = ((c**2).sum(axis=1) - 2 * points[rows] @ c.T).argmin(axis=1)
            todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node].tolist()) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        point, queue, out = np.append(query, 0.0), [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                continue
            for gap, child in zip(((self.centres[node] - point) ** 2).sum(axis=1).tolist(), self.children[node].tolist()):
                heapq.heappush(queue, (gap, child))
        return out


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def best(scores: np.ndarray, queries: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, top: int) -> tuple[list, list]:
    """Per query the ``top`` candidates as (ids, scores), by falling score and rising id.

    ``scores`` (a matrix product) only preselects; what it can't tell from the last place is kept, and
    the final score is a sum in fixed order, so equal vectors score equal.
    """
    found_ids, found_scores = [], []
    slack = 1e-9 * (1.0 + np.abs(scores).max(initial=0.0))
    for row, own, q in zip(scores, query_ids, queries):
        row = np.where(ids == own, -np.inf, row)
        near = np.flatnonzero(row > -np.inf)
        if len(near) > top:
            last = np.partition(row[near], len(near) - top)[len(near) - top]
            near = near[row[near] >= last - slack]
        exact = (vectors[near] * q).sum(axis=1)
        order = np.lexsort([ids[near], -exact])
        _, first = np.unique(ids[near][order], return_index=True)
        order = order[np.sort(first)][:top]
        found_ids.append(ids[near][order])
        found_scores.append(exact[order])
    return found_ids, found_scores


FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("found", T.ArrayType(T.StructType([T.StructField("away", T.DoubleType()), T.StructField("id", T.LongType()), T.StructField("leaf", T.LongType())])))])
_FOUND_ITEM = pa.struct([("away", pa.float64()), ("id", pa.int64()), ("leaf", pa.int64())])


def _found_table(query_ids: np.ndarray, ids: list[np.ndarray], scores: list[np.ndarray], leaves: list[np.ndarray] | None = None) -> pa.Table:
    sizes = np.array([len(i) for i in ids], np.int64)
    flat_ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    flat = [-np.concatenate(scores) if scores else np.zeros(0), flat_ids, np.concatenate(leaves) if leaves else np.full(len(flat_ids), -1)]
    items = pa.StructArray.from_arrays([pa.array(flat[0], pa.float64()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.int64())], fields=list(_FOUND_ITEM))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.table([pa.array(query_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items)], names=FOUND.names)


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` items of each query over all its parts; an id found twice counts with its best score."""
    items = F.array_sort(F.flatten(F.collect_list("found")))
    return found.groupBy("query_id").agg(items.alias("found")).select("query_id", F.slice(_distinct_ids("found"), 1, top).alias("found"))


def _distinct_ids(column: str):
    ids = F.transform(column, lambda x: x["id"])
    return F.when(F.size(F.array_distinct(ids)) == F.size(ids), F.col(column)).otherwise(F.filter(column, lambda x, i: F.array_position(ids, x["id"]) == i + 1))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and their dimension.

    Left out: null ids; vectors that are null, empty or zero, or hold null or non-finite components; and
    vectors of another length than the most frequent one (ties: the longer).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimension = size["n"] if size else 0
    return rows.filter(F.size("vector") == dimension), dimension


def search(vectors: DataFrame, is_query, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", most_rows: int = SAMPLE_ROWS,
           leaf_rows: int = LEAF_ROWS, recall: float = WANTED_RECALL, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``top`` neighbours found of each row for which ``is_query`` (a column of ``id``) holds.

    Candidates are all usable rows but the query's own id (see ``usable``); nearness is the inner product
    in double precision, ties go to the smaller id. Rows with one id are one item, scored by its best
    pair. Equal vectors, however many, are all candidates. With fewer candidates than ``top`` all come.
    """
    rows, dimension = usable(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    count, largest = rows.agg(F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).first()
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if not count:
        return spark.createDataFrame([], schema)
    share = min(1.0, most_rows / count)
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("vector").toArrow() if share < 1 else rows.select("vector").toArrow()
    points = _matrix(sample.column(0).combine_chunks(), dimension) if sample.num_rows else np.zeros((0, dimension))
    # Leaves grow with the root of the rows: fewer, larger meetings.
    leaf_rows = max(leaf_rows, int(2 * np.sqrt(count)))
    tree = Tree(points, max(LEAST_SAMPLE, int(leaf_rows * share)), float(np.sqrt(largest)))
    queries = rows.filter(is_query)
    visited = _calibrated(rows, queries, tree, dimension, top, recall)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaf_of(_matrix(batch.column(1), dimension))), *batch.columns], names=["leaf", "id", "vector"])

    placed = materialize(rows.mapInArrow(leaves, T.StructType([T.StructField("leaf", T.LongType()), *rows.schema.fields])), "leaves")
    sizes = np.zeros(tree.n_leaves, np.int64)
    for leaf, n in placed.groupBy("leaf").count().collect():  # one number a leaf
        sizes[leaf] = n
    packing = Packing(sizes, chunk_rows)
    group_of = F.element_at(F.lit(packing.first.tolist()), (F.col("leaf") + 1).cast("int")) + F.pmod(F.xxhash64("id"), F.element_at(F.lit(packing.parts.tolist()), (F.col("leaf") + 1).cast("int")))
    grouped = placed.withColumn("group", group_of)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS)
                groups, row, wanted = [], [], []
                for i, q in enumerate(_matrix(part.column(1), dimension)):
                    for group, found in packing.groups(tree.visits(q, visited)):
                        groups.append(group)
                        row.append(i)
                        wanted.append(found)
                taken = [c.take(pa.array(row, pa.int64())) for c in part.columns]
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(wanted, pa.list_(pa.int64())), *taken], names=["group", "leaves", "id", "vector"])

    walks = queries.mapInArrow(walk, T.StructType([T.StructField("group", T.LongType()), T.StructField("leaves", T.ArrayType(T.LongType())), *rows.schema.fields]))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found_table(np.zeros(0, np.int64), [], [])
        return _group_best(left, right, dimension, top)

    found = grouped.groupBy("group").cogroup(walks.groupBy("group")).applyInArrow(meet, FOUND)
    items = found.select("query_id", F.inline("found")).groupBy("query_id", "id").agg(F.min("away").alias("away"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("away", "id"))
    return items.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias("vec_id"), (-F.col("away")).alias("score"))


class Packing:
    """Leaves in groups of about ``rows`` vectors: small leaves share one, the parts of a large leaf have one each."""

    def __init__(self, sizes: np.ndarray, rows: int):
        self.parts = np.maximum(1, -(-sizes // rows))
        self.first = np.zeros(len(sizes), np.int64)
        group = held = 0
        for leaf, (size, parts) in enumerate(zip(sizes.tolist(), self.parts.tolist())):
            if parts > 1 or held + size > rows:
                group, held = group + bool(held), 0
            self.first[leaf] = group
            if parts > 1:
                group += parts
            else:
                held += size

    def groups(self, leaves: list[int]) -> list[tuple[int, list[int]]]:
        """The groups that hold some leaves, and which."""
        out: dict[int, list[int]] = {}
        for leaf in leaves:
            for group in range(self.first[leaf], self.first[leaf] + self.parts[leaf]):
                out.setdefault(int(group), []).append(leaf)
        return list(out.items())


def _exact_scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products summed in one order, so equal vectors score equal."""
    return (vectors * queries).sum(axis=-1)


def _leaf_best(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of at least the ``top`` candidates of each query in a leaf, -inf where there are fewer.

    A matrix product preselects; where rounding leaves more than ``SPARE`` candidates level with the last
    place, as among copies, the query's scores are all summed exactly.
    """
    width = top + SPARE
    if len(ids) <= width:
        scores = _exact_scores(vectors[None], queries[:, None])
        return np.broadcast_to(ids, scores.shape), np.where(ids[None, :] == own[:, None], -np.inf, scores)
    rough = np.where(ids[None, :] == own[:, None], -np.inf, queries @ vectors.T)
    near = np.argpartition(rough, len(ids) - width, axis=1)[:, -width:]
    chosen = np.take_along_axis(rough, near, axis=1)
    last = np.partition(chosen, width - top, axis=1)[:, width - top]
    scores = np.where(chosen == -np.inf, -np.inf, _exact_scores(vectors[near], queries[:, None]))
    near_ids = ids[near]
    slack = 1e-9 * (1.0 + np.abs(chosen, where=np.isfinite(chosen), out=np.zeros_like(chosen)).max(initial=0.0))
    for i in np.flatnonzero(chosen.min(axis=1) >= last - slack):
        exact = np.where(ids == own[i], -np.inf, _exact_scores(vectors, queries[i]))
        order = np.lexsort([ids, -exact])[:width]
        near_ids[i], scores[i] = ids[order], exact[order]
    return near_ids, scores


def _sorted_best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` of each row by falling score and rising id; an id found twice keeps its best score."""
    by_id = np.lexsort([-scores, ids])
    ids, scores = np.take_along_axis(ids, by_id, axis=1), np.take_along_axis(scores, by_id, axis=1)
    scores[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
    order = np.argsort(-scores, axis=1, kind="stable")[:, :top]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _group_best(left: pa.Table, right: pa.Table, dimension: int, top: int) -> pa.Table:
    left, right = left.combine_chunks(), right.combine_chunks()
    leaf = np.asarray(left.column("leaf"))
    order = np.argsort(leaf, kind="stable")
    names, starts = np.unique(leaf[order], return_index=True)
    bounds = np.append(starts, len(order))
    ids, vectors = np.asarray(left.column("id"))[order], _matrix(left.column("vector").combine_chunks(), dimension)[order]
    query_ids, queries = np.asarray(right.column("id")), _matrix(right.column("vector").combine_chunks(), dimension)
    wanted = right.column("leaves").combine_chunks()
    visits = np.zeros((len(query_ids), len(names)), bool)
    flat, row = np.asarray(wanted.flatten()), np.repeat(np.arange(len(query_ids)), np.diff(np.asarray(wanted.offsets)))
    place = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    here = names[place] == flat
    visits[row[here], place[here]] = True
    found_ids, found_scores = [], []
    for at in range(0, len(query_ids), QUERY_ROWS):
        part = slice(at, at + QUERY_ROWS)
        own, q = query_ids[part], queries[part]
        best_ids, best_scores = np.zeros((len(own), top), np.int64), np.full((len(own), top), -np.inf)
        for k in range(len(names)):
            chosen = np.flatnonzero(visits[part, k])
            if len(chosen):
                rows = slice(bounds[k], bounds[k + 1])
                more_ids, more_scores = _leaf_best(vectors[rows], ids[rows], q[chosen], own[chosen], top)
                both = np.concatenate([best_ids[chosen], more_ids], axis=1), np.concatenate([best_scores[chosen], more_scores], axis=1)
                best_ids[chosen], best_scores[chosen] = _sorted_best(*both, top)
        for i in range(len(own)):
            kept = best_scores[i] > -np.inf
            found_ids.append(best_ids[i][kept])
            found_scores.append(best_scores[i][kept])
    return _found_table(query_ids, found_ids, found_scores)


def _calibrated(rows: DataFrame, queries: DataFrame, tree: Tree, dimension: int, top: int, recall: float) -> int:
    """Leaves to visit so that some queries (at most about ``CALIBRATION_QUERIES``, chosen by hash) reach ``recall`` against all rows."""
    n = queries.count()
    if n > CALIBRATION_QUERIES:
        queries = queries.filter(F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1_000_000)) < int(1_000_000 * CALIBRATION_QUERIES / n))
    chosen = queries.toArrow()
    if not chosen.num_rows:
        return tree.n_leaves
    query_ids, matrix = np.asarray(chosen.column("id").combine_chunks()), _matrix(chosen.column("vector").combine_chunks(), dimension)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            vectors, ids = _matrix(batch.column(1), dimension), np.asarray(batch.column(0))
            for at in range(0, len(ids), CHUNK_ROWS):
                part = slice(at, at + CHUNK_ROWS)
                a, b = best(matrix @ vectors[part].T, matrix, vectors[part], query_ids, ids[part], top)
                leaf, order = tree.leaf_of(vectors[part]), np.argsort(ids[part], kind="stable")
                places = [leaf[order[np.searchsorted(ids[part][order], x)]] for x in a]
                held.append(_found_table(query_ids, a, b, places))
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    truth = _merged(rows.mapInArrow(exact, FOUND), top).collect()
    by_id = dict(zip(query_ids.tolist(), matrix))
    places = []
    for query_id, found in truth:
        rank = {leaf: i for i, leaf in enumerate(tree.visits(by_id[query_id], tree.n_leaves))}
        places += [rank[item["leaf"]] for item in found]
    if not places:
        return tree.n_leaves
    places = np.sort(places)
    visited = 1
    while visited < tree.n_leaves and np.searchsorted(places, visited) < recall * len(places):
        visited += max(1, visited // 8)
    return min(visited, tree.n_leaves)
