"""Exact and near deduplication against brute force, on small tables with copies, nulls, empty and repeated rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tabforge.llm import near_dedup, suffix_dedup, window_dedup
from tabforge.llm.arrays import byte_column
from tabforge.operators import components

LAST = (1 << 63) - 1
EXTRA = "doc_id long, text string, id string, block int, payload string"


def frame(spark, rows):
    """Columns whose names clash with those that operators use."""
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], EXTRA).repartition(4)


def order(d):
    return LAST if d is None else d


def covered(rows, units, length):
    """Per row: its units and the flags of those in a window that starts in an earlier document."""
    first = {}
    for d, t in rows:
        u = units(t)
        for i in range(len(u) - length + 1):
            w = tuple(u[i : i + length])
            first[w] = min(first.get(w, LAST), order(d))
    for d, t in rows:
        u = units(t)
        flags = bytearray(len(u))
        for i in range(len(u) - length + 1):
            if first[tuple(u[i : i + length])] < order(d):
                flags[i : i + length] = b"\1" * length
        yield d, u, flags


def byte_rows(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(4000))
    rows = []
    for i in range(150):
        t = ""
        for _ in range(rng.randint(0, 4)):
            k = rng.random()
            if k < 0.5:
                a = rng.randint(0, 3900)
                t += base[a : a + rng.randint(20, 160)]
            elif k < 0.7:
                t += rng.choice(["z", "ab"]) * rng.randint(1, 90)
            else:
                t += "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 90)))
        rows.append((rng.choice([i, i, i, rng.randint(0, 149)]), t))
    return rows + [(None, base[:300]), (None, base[:300]), (5, None), (6, ""), (-7, base[100:400]), (8, base[100:400])]


@pytest.mark.parametrize(("length", "many", "block_bytes"), [(50, 2048, 3000), (50, 1, 3000), (30, 3, 1 << 20)])
def test_suffix_dedup(spark, length, many, block_bytes):
    rows = byte_rows(length + many)
    got = suffix_dedup.remove_repeats(frame(spark, rows), length, block_bytes=block_bytes, many_phrases=many).collect()
    want = []
    for d, u, flags in covered(rows, lambda t: (t or "").encode(), length):
        spans = sum(1 for i, c in enumerate(flags) if c and (i == 0 or not flags[i - 1]))
        want.append((d, len(u), sum(flags), spans, bytes(x for x, c in zip(u, flags) if not c)))
    assert sorted([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got], key=str) == sorted(want, key=str)


def test_dictionary_order_is_a_suffix_array():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 400).astype(np.uint8)
    places = np.arange(400 - 20 + 1)
    got, number = suffix_dedup.dictionary_order(data, places, 20)
    raw = data.tobytes()
    assert [raw[p : p + 20] for p in got] == sorted(raw[p : p + 20] for p in places)
    assert len(np.unique(number)) == len({raw[p : p + 20] for p in places})


def test_dedup_of_empty_tables(spark):
    empty = frame(spark, [(1, "x")]).filter("doc_id = 2")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert window_dedup.remove_repeats(empty).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("length", "block_bytes"), [(50, 2500), (7, 1 << 20)])
def test_window_dedup(spark, length, block_bytes):
    rng = random.Random(length)
    base = [rng.choice("a bb ccc dd é".split()) for _ in range(2000)]
    rows = []
    for i in range(150):
        t = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 1900)
            t += rng.choice([base[a : a + rng.randint(20, 160)], ["z"] * rng.randint(1, 130), [rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))]])
        rows.append((rng.choice([i, i, rng.randint(0, 149)]), "".join(w + rng.choice([" ", "\n", "  "]) for w in t)))
    rows += [(None, " ".join(base[:300])), (None, " ".join(base[:300])), (5, None), (6, ""), (-7, " ".join(base[100:400]))]
    got = window_dedup.remove_repeats(frame(spark, rows), length, block_bytes=block_bytes).collect()
    want = []
    for d, u, flags in covered(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), length):
        runs = [i for i in range(len(u) + 1) if (flags[i - 1] if i else 0) != (flags[i] if i < len(u) else 0)]
        want.append((d, len(u), sum(flags), runs, " ".join(x for x, c in zip(u, flags) if not c)))
    assert sorted([(r.id, r.n_words, r.n_removed, list(r.removed), bytes(r.kept).decode()) for r in got], key=str) == sorted(want, key=str)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, s) in enumerate(sets):
        for e, t in sets[:i]:
            if d is not None and e is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(d), find(e)
                parent[max(x, y)] = min(x, y)
    return sorted([(d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets], key=str)


def test_near_dedup(spark):
    rng = random.Random(8)
    words = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    rows = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 12, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 3, 6, 15])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows), " ".join(t)))
    rows += [(None, rows[3][1]), (None, None), (7, rows[3][1]), (8, rows[50][1]), (1000, ""), (1001, None), (1002, "  "), (1003, rows[5][1].upper()), (-4, rows[9][1])]
    got = sorted([(r.id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()], key=str)
    assert got == brute_components(rows)


def test_near_dedup_star_without_its_centre(spark):
    """Copies of one text, each changed elsewhere, link with the text and not with each other; the smallest id is a copy."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(100, " ".join(base))]
    for i in range(12):
        t = list(base)
        for p in (7 + 9 * i, 3 + 9 * i):  # about ten of 116 shingles: 0.84 with the text, 0.70 with another copy
            t[p % 120] = f"x{i}{p}"
        rows.append((i, " ".join(t)))
    got = sorted([(r.id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()], key=str)
    assert got == brute_components(rows) and {r[2] for r in got} == {0}


def test_bucket_chunks_meet_whole(spark, monkeypatch):
    """A bucket cut into many chunks still shows every link across components."""
    monkeypatch.setattr(near_dedup, "CHUNK_ROWS", 3)
    text = " ".join(f"w{i}" for i in range(30))
    hashes, bounds = near_dedup.shingle_sets(*byte_column(pa.array([text])))
    signature = near_dedup.signatures(hashes, bounds)
    keys = [(k, i) for k in near_dedup.band_keys(signature)[0].view(np.int64).tolist() for i in range(20)]
    nodes = spark.createDataFrame([(i, len(hashes), signature.tobytes()) for i in range(20)], "id long, n long, signature binary")
    roots = spark.createDataFrame([(i, 0 if i < 12 else i) for i in range(20)], "id long, root long")
    docs = spark.createDataFrame([(i, text) for i in range(20)], "id long, text string")
    got = [(r.a, r.b) for r in near_dedup._rest_links(spark.createDataFrame(keys, "key long, id long"), nodes, roots, docs).collect()]
    assert set(got) == {(a, b) for a in range(20) for b in range(a + 1, 20) if b >= 12}
    assert len(got) <= 2 * len(set(got))  # in one band; two others meet from either side


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = np.sort(rng.integers(0, 1 << 63, 700).astype(np.uint64))
    one, other = pool[:600], pool[100:]
    rows = near_dedup.signatures(np.concatenate([one, other]), np.array([0, 600, 1200]))
    assert abs((rows[0] == rows[1]).mean() - 500 / 700) < 0.15
    assert (near_dedup.signatures(one, np.array([0, 1, 600])) >= 0).all()  # one shingle fills every bin


def test_small_tables_are_few_files(spark, monkeypatch):
    """However many partitions a session has, tables of a known size get the files that their rows need."""
    texts = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6)]
    rows = [(i, texts[i % 6] + f" tail{i}") for i in range(30)]
    written = []
    write = near_dedup.materialize

    def counted(df, stem="stage", most_files=None):
        table = write(df, stem, most_files)
        written.append((stem, len(table.inputFiles())))
        return table

    monkeypatch.setattr(near_dedup, "materialize", counted)
    monkeypatch.setattr(components, "materialize", counted)
    kept = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in kept}
    try:
        for k, v in kept.items():
            spark.conf.set(k, v)
        got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i % 6 for i in range(30)}
    for stem in ("members", "classes", "keys", "pairs", "links", "roots"):
        assert {n for s, n in written if s == stem} == {1}, stem
    assert [n for s, n in written if s == "edges"][:2] == [1, 1]
