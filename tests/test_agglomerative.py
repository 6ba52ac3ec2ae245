"""Merge trees of all rows against one-at-a-time merging by brute force."""

import numpy as np
import pytest

from tabforge.operators import agglomerative as A


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")


def neighbour_pairs(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    pairs = set()
    for i in range(len(x)):
        order = [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:k]
        pairs |= {(min(i, j), max(i, j)) for j in order}
    return d, pairs


def one_at_a_time(x, k, linkage):
    """Always the cheapest edge of the graph; Ward costs never fall below the least edge that was folded in."""
    d, pairs = neighbour_pairs(x, k)
    size, total = np.ones(len(x)), x.copy()

    def growth(a, b):
        return size[a] * size[b] / (size[a] + size[b]) * ((total[a] / size[a] - total[b] / size[b]) ** 2).sum()

    edges = {p: ((d[p] ** 2 / 2) if linkage == "ward" else d[p], 1) for p in pairs}
    merges = []
    while edges:
        (a, b), (cost, _) = min(edges.items(), key=lambda e: (e[1][0], e[0]))
        merges.append((a, b, cost))
        size[a], total[a] = size[a] + size[b], total[a] + total[b]
        folded = {}
        for (i, j), edge in edges.items():
            i, j = (a if i == b else i), (a if j == b else j)
            if i != j:
                folded.setdefault((min(i, j), max(i, j)), []).append(edge)
        edges = {}
        for (i, j), old in folded.items():
            w = sum(n for _, n in old)
            if linkage == "ward":
                c = max(min(c for c, _ in old), growth(i, j)) if a in (i, j) else old[0][0]
            else:
                c = max(c for c, _ in old) if linkage == "complete" else sum(c * n for c, n in old) / w
            edges[i, j] = (c, w)
    return merges


def compare(got, want):
    assert [(r.a, r.b) for r in got] == [(a, b) for a, b, _ in want]
    assert [r.height for r in got] == pytest.approx([h for *_, h in want])


@pytest.mark.parametrize("top", [1000, 60])
def test_trees_of_a_neighbour_graph(spark, top):
    x = np.random.default_rng(7).normal(size=(300, 2))
    steps = A.merge_steps(A.merge_tree(frame(spark, x), ["complete", "average"], 9, top)).orderBy("step").collect()
    for linkage in ("complete", "average"):
        compare([r for r in steps if r.linkage == linkage], one_at_a_time(x, 9, linkage))


@pytest.mark.parametrize("top", [1000, 20])
def test_trees_of_all_pairs(spark, top):
    x = np.random.default_rng(8).normal(size=(70, 3))
    steps = A.merge_steps(A.merge_tree(frame(spark, x), A.LINKAGES, 69, top)).orderBy("step").collect()
    for linkage in A.LINKAGES:
        compare([r for r in steps if r.linkage == linkage], one_at_a_time(x, 69, linkage))


def plain_rounds(x, k):
    """Ward by rounds: all pairs that are each other's nearest at once."""
    d, pairs = neighbour_pairs(x, k)
    clusters, edges, out = {i: [i] for i in range(len(x))}, {p: d[p] ** 2 / 2 for p in pairs}, []
    while edges:
        near = {}
        for (i, j), c in edges.items():
            for end in (i, j):
                near[end] = min(near.get(end, (np.inf, 0, 0)), (c, i, j))
        chosen = [(c, i, j) for c, i, j in set(near.values()) if near[i] == near[j] == (c, i, j)]
        into = {j: i for _, i, j in chosen}
        for c, i, j in chosen:
            out.append((i, j, c))
            clusters[i] += clusters.pop(j)
        folded = {}
        for (i, j), c in edges.items():
            i, j = into.get(i, i), into.get(j, j)
            if i != j:
                key = (min(i, j), max(i, j))
                folded[key] = min(folded.get(key, np.inf), c)
        edges = {}
        for (i, j), least in folded.items():
            a, b = x[clusters[i]], x[clusters[j]]
            edges[i, j] = max(least, len(a) * len(b) / (len(a) + len(b)) * ((a.mean(axis=0) - b.mean(axis=0)) ** 2).sum())
    return sorted(out, key=lambda m: m[2])


@pytest.mark.parametrize("top", [1000, 60])
def test_ward_along_a_graph(spark, top):
    x = np.random.default_rng(9).normal(size=(300, 2))
    steps = A.merge_steps(A.merge_tree(frame(spark, x), ["ward"], 9, top)).orderBy("step").collect()
    compare(steps, plain_rounds(x, 9))
    # The cheapest edge at a time gives the same clusters near the top.
    def parts(merges, k):
        owner = list(range(300))
        for a, b, *_ in merges[: 300 - k]:
            owner = [owner[a] if o == owner[b] else o for o in owner]
        return sorted(map(tuple, ([i for i in range(300) if owner[i] == o] for o in set(owner))))
    greedy = one_at_a_time(x, 9, "ward")
    assert parts([(r.a, r.b) for r in steps], 2) == parts(greedy, 2)


def test_copies_parts_and_cuts(spark):
    """A third of all rows are copies of one vector; three far parts that no edge joins; one row alone."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 0.1, (30, 2)), rng.normal(9, 0.1, (30, 2)), np.tile([[50.0, 0.0]], (40, 1)), [[50.0, 0.5]], [[-90.0, 3.0]]])
    for top in (1000, 5):
        tree = A.merge_tree(frame(spark, x), A.LINKAGES, 4, top).cache()
        assert {r["linkage"]: r["count"] for r in tree.groupBy("linkage").count().collect()} == dict.fromkeys(A.LINKAGES, len(x) - 1)
        labels, names = A.cut_labels(frame(spark, x).select("id"), tree, A.LINKAGES, [1, 3, 4])
        rows = labels.collect()
        for n in names:
            parts = {}
            for r in rows:
                parts.setdefault(r[n], set()).add(r.id)
            sizes = sorted(map(len, parts.values()))
            if n != "ward_k3":  # which here puts the row alone to its nearest part
                assert sizes == ([102] if n.endswith("k1") else [1, 30, 30, 41] if n.endswith("k4") else [1, 41, 60]), n


def test_few_rows(spark):
    assert A.merge_tree(frame(spark, np.zeros((0, 2)))).count() == 0
    one = A.merge_tree(frame(spark, np.ones((1, 2))))
    assert one.count() == 0
    labels, _ = A.cut_labels(frame(spark, np.ones((1, 2))).select("id"), one, ["ward"], [2])
    assert [tuple(r) for r in labels.collect()] == [(0, 0)]
    two = A.merge_tree(frame(spark, np.array([[0.0], [0.0], [3.0]])), ["ward"])
    assert sorted((r.a, r.b, r.height) for r in two.collect()) == [(0, 1, 0.0), (0, 2, pytest.approx(6.0))]


@pytest.mark.parametrize("top", [1000, 3])
def test_near_parts_come_before_a_far_row(spark, top):
    """Three parts that no edge joins, and a row whose only edges lead far: the parts, which are nearer, merge first."""
    x = np.array([[v] for v in (0, 1, 2, 10, 11, 12, 30, 31, 32, -50)], float)
    steps = A.merge_steps(A.merge_tree(frame(spark, x), ["complete", "average"], 2, top)).orderBy("step").collect()
    last = {n: [(r.a, r.b, r.height) for r in steps if r.linkage == n][-3:] for n in ("complete", "average")}
    assert last["complete"] == [(0, 3, 8.0), (0, 6, 28.0), (0, 9, 51.0)]
    assert last["average"] == [(0, 3, 8.0), (0, 6, 23.0), (0, 9, 50.5)]
