"""Agglomerative clustering of all rows along their neighbour graph.

Clusters start as the different vectors and may merge where the k-nearest-neighbour graph of all rows
joins them. Every round merges all pairs that are each other's nearest cluster, whatever their number,
and folds the edges onto the merged clusters. All linkages share the rounds. What a merge leaves is
never nearer to a third cluster than the nearer of its two parts was, so pairs that are each other's
nearest stay so, and the merges, sorted by height, are those of the one-at-a-time procedure:

* ``complete``: the greatest distance among the graph's edges between two clusters;
* ``average``: their mean;
* ``ward``: the growth of the squared deviations, n m / (n + m) times the squared distance of the
  centres, or the least cost among the edges folded into this one if that is more. With an edge between
  every two clusters the second never applies; with fewer it keeps later merges from costing less.

Parts that no edge joins get edges before the first merge, along the neighbour graph of their centres:
one edge between two near vectors for two neighbouring parts. So a far row's own edges don't come before
nearer parts. Once a linkage has few clusters left (``TOP_CLUSTERS``), the same rounds go on in the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import square_distance
from tabforge.operators.components import connected_components
from tabforge.operators.neighbors import knn_join
from tabforge.operators.ordering import range_rank
from tabforge.session import materialize

LINKAGES = ("ward", "complete", "average")
#: Clusters of a linkage, at most, whose remaining merges the driver does: about 60 MB of arrays.
TOP_CLUSTERS = 100_000
#: Neighbours of a row, or of the centre of a part, in the graph.
NEIGHBORS = 10

MERGE = "linkage string, a long, b long, height double, round int"


# --- the graph ---------------------------------------------------------------------------------------

def different_vectors(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, vec, n) of every different vector under the smallest id that has it, and (id, node) of all rows."""
    nodes = materialize(points.groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("n")), "nodes")
    return nodes, materialize(points.join(nodes, "vec").select("id", "node"), "node-of")


def neighbour_edges(points: DataFrame, node_of: DataFrame, k: int) -> DataFrame:
    """(a, b, dist, links) between nodes, a < b: the graph of all rows, folded onto their vectors."""
    near = knn_join(points, points, "id", "id", "vec", k, exclude_self=True)
    pairs = near.select(F.least("id", "neighbor").alias("x"), F.greatest("id", "neighbor").alias("y"), "dist").distinct()
    of_x, of_y = (node_of.select(F.col("id").alias(c), F.col("node").alias(f"n{c}")) for c in "xy")
    folded = pairs.join(of_x, "x").join(of_y, "y").filter("nx <> ny")
    return folded.groupBy(F.least("nx", "ny").alias("a"), F.greatest("nx", "ny").alias("b")).agg(F.min("dist").alias("dist"), F.count("*").alias("links"))


def joined_parts(nodes: DataFrame, edges: DataFrame, k: int, dims: int) -> DataFrame:
    """``edges`` and, where they leave the nodes in several parts, edges that make them one.

    Each part gets one to each of the ``k`` parts whose centres are nearest: from the vector nearest to the other's
    centre to the vector of that part nearest to it; ties by the smaller ids. Repeated until one part is left.
    """
    while True:
        roots = connected_components(edges.select(F.lit(0).alias("g"), "a", "b")).select("node", "root")
        placed = materialize(nodes.join(roots, "node", "left").select("node", "vec", "n", F.coalesce("root", "node").alias("part")), "parts")
        if placed.select("part").distinct().limit(2).count() < 2:
            return edges
        centres = materialize(placed.groupBy(F.col("part").alias("id")).agg(F.array(*[F.sum(F.col("vec")[i] * F.col("n")) / F.sum("n") for i in range(dims)]).alias("vec")), "part-centres")
        near = knn_join(centres, centres, "id", "id", "vec", k, exclude_self=True)
        pairs = near.select(F.least("id", "neighbor").alias("p"), F.greatest("id", "neighbor").alias("q")).distinct()
        aims = pairs.join(centres.select(F.col("id").alias("q"), F.col("vec").alias("aim")), "q")
        for part, name in (("p", "a"), ("q", "b")):  # the second end aims at the first
            found = F.min(F.struct(square_distance(F.col("vec"), F.col("aim")).alias("squared"), F.col("node").alias(name), F.col("vec").alias("aim"))).alias("found")
            ends = aims.join(placed.select(F.col("part").alias(part), "node", "vec"), part)
            aims = ends.groupBy("p", "q", *(["a"] if name == "b" else [])).agg(found).select("p", "q", *(["a"] if name == "b" else []), "found.*")
        more = aims.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.sqrt("squared").alias("dist"), F.lit(1).cast("long").alias("links"))
        edges = materialize(edges.unionByName(more), "joined-edges")


def _growth(n: Column, m: Column, squared: Column) -> Column:
    return n * m / (n + m) * squared


def _by_linkage(linkages: Sequence[str], ward: Column, other: Column) -> Column:
    return F.when(F.col("linkage") == "ward", ward).otherwise(other) if "ward" in linkages else other


def _start(nodes: DataFrame, edges: DataFrame, linkages: Sequence[str], dims: int) -> tuple[DataFrame, DataFrame]:
    """Clusters (linkage, id, n, total) and edges (linkage, a, b, cost, links) before the first merge."""
    each = F.explode(F.array(*[F.lit(x) for x in linkages])).alias("linkage")
    clusters = nodes.select(each, F.col("node").alias("id"), F.col("n").cast("double").alias("n"),
                            F.array(*[F.col("vec")[i] * F.col("n") for i in range(dims)]).alias("total"))
    sizes = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab"]
    sized = edges.join(sizes[0], "a").join(sizes[1], "b").select(each, "*")
    cost = _by_linkage(linkages, _growth(F.col("n_a"), F.col("n_b"), F.col("dist") * F.col("dist")), F.col("dist"))
    return clusters, sized.select("linkage", "a", "b", cost.alias("cost"), F.col("links").cast("double").alias("links"))


# --- rounds in Spark ---------------------------------------------------------------------------------

def nearest_pairs(edges: DataFrame) -> DataFrame:
    """(linkage, a, b, cost) of clusters that are each other's nearest; ties by the smaller ids."""
    edge = F.struct("cost", "a", "b").alias("edge")
    ends = edges.select("linkage", F.col("a").alias("id"), edge).unionByName(edges.select("linkage", F.col("b").alias("id"), edge))
    nearest = ends.groupBy("linkage", "id").agg(F.min("edge").alias("edge"))
    return nearest.groupBy("linkage", "edge").count().filter("count = 2").select("linkage", "edge.a", "edge.b", "edge.cost")


def _merged_clusters(clusters: DataFrame, merges: DataFrame, dims: int) -> DataFrame:
    moved = merges.select("linkage", F.col("b").alias("id"), F.col("a").alias("into"))
    grown = merges.select("linkage", F.col("a").alias("id"), F.col("a").alias("into"))
    joined = clusters.join(moved.unionByName(grown), ["linkage", "id"], "left")
    return joined.groupBy("linkage", F.coalesce("into", "id").alias("id")).agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dims)]).alias("total"))


def _with_ends(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    for c in "ab":
        edges = edges.join(clusters.select("linkage", F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.transform("total", lambda x: x / F.col("n")).alias(f"center_{c}")), ["linkage", c])
    return edges


def _folded_edges(edges: DataFrame, merges: DataFrame, clusters: DataFrame, linkages: Sequence[str]) -> DataFrame:
    for c in "ab":
        moved = merges.select("linkage", F.col("b").alias(c), F.col("a").alias(f"into_{c}"))
        edges = edges.join(moved, ["linkage", c], "left").withColumn(f"new_{c}", F.coalesce(f"into_{c}", c))
    alive = edges.filter("new_a <> new_b").groupBy("linkage", F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
    name = F.col("linkage")
    cost = F.when(name == "ward", F.min("cost")).when(name == "complete", F.max("cost")).otherwise(F.sum(F.col("cost") * F.col("links")) / F.sum("links"))
    folded = alive.agg(cost.alias("cost"), F.sum("links").alias("links"))
    if "ward" not in linkages:
        return folded
    ward = _with_ends(folded.filter(name == "ward"), clusters.filter(name == "ward"))
    growth = _growth(F.col("n_a"), F.col("n_b"), square_distance(F.col("center_a"), F.col("center_b")))
    return folded.filter(name != "ward").unionByName(ward.select("linkage", "a", "b", F.greatest("cost", growth).alias("cost"), "links"))


# --- the last rounds ---------------------------------------------------------------------------------

class Top:
    """The last clusters of one linkage: the same rounds, on arrays and without Spark. Places follow the order of the ids."""

    def __init__(self, linkage: str, clusters: pa.Table, edges: pa.Table, round_no: int):
        self.linkage, self.round_no = linkage, round_no
        clusters = clusters.sort_by("id")
        self.ids = clusters.column("id").to_numpy()
        self.n = clusters.column("n").to_numpy().copy()
        self.total = clusters.column("total").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(self.n), -1).copy()
        self.a, self.b = (np.searchsorted(self.ids, edges.column(c).to_numpy()) for c in "ab")
        self.cost, self.links = (edges.column(c).to_numpy() for c in ("cost", "links"))
        self.merges: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []

    def fold(self, key: np.ndarray, cost: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, ...]:
        """(a, b, cost, links) of the edges with one key each, the place of a times the clusters plus that of b."""
        order = np.lexsort((links, cost, key))
        key, cost, links = key[order], cost[order], links[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        (a, b), weight = np.divmod(key[first], len(self.n)), np.add.reduceat(links, first)
        if self.linkage == "ward":
            gap = self.total[a] / self.n[a][:, None] - self.total[b] / self.n[b][:, None]
            new = np.maximum(cost[first], self.n[a] * self.n[b] / (self.n[a] + self.n[b]) * (gap * gap).sum(axis=1))
        else:
            new = np.maximum.reduceat(cost, first) if self.linkage == "complete" else np.add.reduceat(cost * links, first) / weight
        return a, b, new, weight

    def run(self) -> pa.Table:
        while len(self.a):
            self.merge()
        parts = [np.concatenate(p) if self.merges else np.zeros(0) for p in zip(*[(self.ids[a], self.ids[b], cost, np.full(len(a), no)) for a, b, cost, no in self.merges])] or [np.zeros(0)] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
        return pa.table([pa.array([self.linkage] * len(parts[0]), pa.string()), *[pa.array(p).cast(k) for p, k in zip(parts, kinds)]], names=["linkage", "a", "b", "height", "round"])

    def merge(self) -> None:
        """One round: all clusters that are each other's nearest, ties by the smaller ids."""
        self.round_no += 1
        order = np.lexsort((self.b, self.a, self.cost))
        nearest = np.full(len(self.n), -1)
        ends = np.stack([self.a[order], self.b[order]], axis=1).ravel()[::-1]
        nearest[ends] = np.repeat(order, 2)[::-1]  # the last to be written is the nearest
        edge = np.arange(len(self.a))
        chosen = np.sort(edge[(nearest[self.a] == edge) & (nearest[self.b] == edge)])
        a, b = self.a[chosen], self.b[chosen]
        self.merges.append((a, b, self.cost[chosen], self.round_no))
        into, touched = np.arange(len(self.n)), np.zeros(len(self.n), bool)
        into[b] = a
        touched[a] = touched[b] = True
        self.n[a] += self.n[b]
        self.total[a] += self.total[b]
        change = touched[self.a] | touched[self.b]
        x, y = into[self.a[change]], into[self.b[change]]
        alive = x != y
        x, y, cost, links = x[alive], y[alive], self.cost[change][alive], self.links[change][alive]
        kept = [self.a[~change], self.b[~change], self.cost[~change], self.links[~change]]
        if len(x):
            kept = [np.concatenate(p) for p in zip(kept, self.fold(np.minimum(x, y) * len(self.n) + np.maximum(x, y), cost, links))]
        self.a, self.b, self.cost, self.links = kept


# --- the tree ----------------------------------------------------------------------------------------

def merge_tree(points: DataFrame, linkages: Sequence[str] = LINKAGES, neighbors: int = NEIGHBORS, top: int = TOP_CLUSTERS) -> DataFrame:
    """(linkage, a, b, height, round) of all merges of (id, vec) rows: one fewer than there are rows, for each linkage.

    ``a`` and ``b`` are the smallest ids of the two clusters, a < b. Copies of a vector merge first, at
    height 0 in round 0. A merge comes in a later round than those of its parts and is at least as high.
    """
    points = materialize(points.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")), "points")
    spark = points.sparkSession
    first = points.select(F.size("vec").alias("dims")).first()
    if first is None:
        return spark.createDataFrame([], MERGE)
    nodes, node_of = different_vectors(points)
    each = F.explode(F.array(*[F.lit(x) for x in linkages])).alias("linkage")
    done = [node_of.filter("id <> node").select(each, F.col("node").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("height"), F.lit(0).alias("round"))]
    graph = materialize(neighbour_edges(points, node_of, neighbors), "graph")
    clusters, edges = _start(nodes, joined_parts(nodes, graph, neighbors, first["dims"]), linkages, first["dims"])
    clusters, edges = materialize(clusters, "clusters"), materialize(edges, "edges")
    active, last, round_no = list(linkages), [], 0
    while active:
        n_clusters = {r["linkage"]: r["count"] for r in clusters.groupBy("linkage").count().collect()}
        small = [x for x in active if n_clusters.get(x, 0) <= top]
        for linkage in small:  # at most `top` clusters and the edges between them
            of = F.col("linkage") == linkage
            last.append(Top(linkage, clusters.filter(of).select("id", "n", "total").toArrow(), edges.filter(of).select("a", "b", "cost", "links").toArrow(), round_no).run())
        active = [x for x in active if x not in small]
        if not active:
            break
        if small:
            clusters, edges = (t.filter(F.col("linkage").isin(active)) for t in (clusters, edges))
        round_no += 1
        merges = materialize(nearest_pairs(edges), "merges")
        done.append(merges.select("linkage", "a", "b", F.col("cost").alias("height"), F.lit(round_no).alias("round")))
        merged = materialize(_merged_clusters(clusters, merges, first["dims"]), "clusters")
        edges = materialize(_folded_edges(edges, merges, merged, active), "edges")
        clusters = merged
    tree = done[0]
    for part in [spark.createDataFrame(table, MERGE) for table in last if table.num_rows] + done[1:]:
        tree = tree.unionByName(part)
    return materialize(tree, "tree")


def merge_steps(tree: DataFrame) -> DataFrame:
    """(linkage, step, a, b, height): the merges of each linkage from the lowest to the highest."""
    return range_rank(tree, ["height", "round", "a", "b"], ["linkage"], "step").select("linkage", F.col("step").cast("int").alias("step"), "a", "b", "height")


def cut_labels(ids: DataFrame, tree: DataFrame, linkages: Sequence[str], ks: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """``ids`` with a column ``<linkage>_k<k>`` per setting, 0.. in the order of the clusters' smallest ids, and those names.

    The highest merges are left out; what the others connect are the clusters of the finest cut, and the
    left-out merges join those for the coarser ones. With fewer rows than k, each is a cluster.
    """
    spark, finest = ids.sparkSession, max(ks)
    order = [F.desc("height"), F.desc("round"), F.desc("a"), F.desc("b")]
    left_out = {x: tree.filter(F.col("linkage") == x).orderBy(*order).limit(finest - 1).collect() for x in linkages}  # k - 1 merges a linkage
    out = spark.createDataFrame([(r["linkage"], r["a"], r["b"], True) for rows in left_out.values() for r in rows], "linkage string, a long, b long, gone boolean")
    kept = tree.join(F.broadcast(out), ["linkage", "a", "b"], "left").filter("gone is null")
    number = F.coalesce(*[F.when(F.col("linkage") == x, F.lit(i)) for i, x in enumerate(linkages)])
    roots = connected_components(kept.select(number.alias("g"), "a", "b"))
    columns, names = ids.select("id"), []
    for g, linkage in enumerate(linkages):
        own = roots.filter(F.col("g") == g).select(F.col("node").alias("id"), "root")
        rooted = materialize(ids.select("id").join(own, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "roots")
        ends = {i for r in left_out[linkage] for i in (r["a"], r["b"])}
        of = {r["id"]: r["root"] for r in rooted.filter(F.col("id").isin(list(ends))).collect()} if ends else {}
        parts = sorted({r["root"] for r in rooted.select("root").distinct().limit(finest + 1).collect()})
        owner = {root: root for root in parts}
        cuts = {len(parts): dict(owner)}
        for r in reversed(left_out[linkage]):  # the lowest first
            a, b = (owner[of[i]] for i in (r["a"], r["b"]))
            owner = {root: min(a, b) if o in (a, b) else o for root, o in owner.items()}
            cuts[len(set(owner.values()))] = dict(owner)
        for k in ks:
            cut = cuts[min(k, len(parts))] if parts else {}
            label = {o: i for i, o in enumerate(sorted(set(cut.values())))}
            names.append(f"{linkage}_k{k}")
            rooted = rooted.join(F.broadcast(spark.createDataFrame([(r, label[o]) for r, o in cut.items()], f"root long, {linkage}_k{k} int")), "root")
        columns = columns.join(rooted.drop("root"), "id")
    return columns, names
