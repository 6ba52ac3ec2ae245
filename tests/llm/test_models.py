"""Quality rules, language model and neighbour search."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import arrays, blocks, neighbours, quality, suffix_tree_lm


def test_rules_of_a_printed_tree():
    debug = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 1.5)
   If (feature 1 <= 0.25)
    Predict: 0.0
   Else (feature 1 > 0.25)
    Predict: 1.0
  Else (feature 0 > 1.5)
   If (feature 0 <= 2.0)
    Predict: 0.0
   Else (feature 0 > 2.0)
    Predict: 1.0
"""
    inf = math.inf
    rules = {r.bounds for r in quality.rules_of(debug, ["a", "b"])}
    assert rules == {(("a", -inf, 1.5),), (("a", -inf, 1.5), ("b", -inf, 0.25)), (("a", -inf, 1.5), ("b", 0.25, inf)), (("a", 1.5, inf),), (("a", 1.5, 2.0),), (("a", 2.0, inf),)}


def test_quality_separates_junk(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        junk = i % 4 == 0
        rows.append((i, " ".join(w + "###" for w in words) if junk else " ".join(words) + ".", 0.0))
        labels.append((i, int(not junk)))
    labels += [(None, 1), (3, None)]
    rows += [(None, "some words", 0.0), (900, None, 0.0), (901, "", 0.0), (5, rows[5][1], 0.0), (902, "long " * 50_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    model = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"), held_out=F.pmod(F.col("_id"), F.lit(5)) == 0)
    found = quality.score_documents(docs, model, keep=["doc_id", "text"]).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in found if r.doc_id is not None and r.doc_id < 300)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.keep_good(docs, model).count() == sum(r.predicted for r in found)


def test_rules_are_evaluated_in_the_tasks(spark, monkeypatch):
    """The flags are those of the rules' columns, and no pass of the lasso plans an expression for each rule."""
    rng = random.Random(6)
    rows = [(float(rng.random() < 0.5), *[round(rng.random(), 2) for _ in quality.STATISTICS]) for _ in range(600)]
    points = spark.createDataFrame(rows, "label double, " + ", ".join(f"{s} double" for s in quality.STATISTICS))
    seen = []

    class Lasso(quality.LogisticRegression):
        def fit(self, data):
            seen.append(data)
            return super().fit(data)

    monkeypatch.setattr(quality, "LogisticRegression", Lasso)
    quality.fit(points, trees=12)
    assert seen[0].first().r.size > 100
    assert len(seen[0]._jdf.queryExecution().optimizedPlan().toJSON()) < 20_000

    rules = [quality.Rule((("digits", -math.inf, 0.5),)), quality.Rule((("digits", 0.5, math.inf), ("lines", 0.25, 0.75)))]
    named = points.withColumnRenamed("label", "y")
    want = [(r[0], [int(r[1]), int(r[2])]) for r in named.select("y", *[r.column() for r in rules]).collect()]
    assert [(r.y, list(r.r)) for r in quality.fired(named, rules, slice_rows=7).collect()] == want


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.score_documents(docs, quality.learn(docs, none)).first().score == 0.5
    assert quality.score_documents(docs, quality.learn(docs, one)).first().score == pytest.approx(0.75)
    assert quality.score_documents(docs.filter("false"), quality.learn(docs, none)).count() == 0


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()) + [None]


def held(d):
    return None if d is None else zlib.crc32(str(d).encode()) % 10 == 0


def expected_scores(rows, share, least_gain):
    train = [tokens(t) for d, t in rows if held(d) is False]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    followers = [None, defaultdict(Counter), defaultdict(Counter)]
    for t in train:
        for depth in (1, 2):
            for i in range(depth, len(t)):
                followers[depth][tuple(t[i - depth : i])][t[i]] += 1
    states = {}

    def p(past, w):
        if not past:
            return max(c[w], 1) / (n + 1)
        lower = p(past[1:], w)
        if past not in states:
            return lower
        total, kinds = states[past]
        return (followers[len(past)][past][w] + kinds * lower) / (total + kinds)

    for depth in (1, 2):
        for s, d in followers[depth].items():
            total = sum(d.values())
            if total >= max(2.0, share * n):
                surprise = {w: min(255, max(0, round(-8 * math.log2(p(s[1:], w))))) / 8 * math.log(2) for w in d}
                gain = sum(k * (math.log(k / total) + surprise[w]) for w, k in d.items())
                if gain > len(d) and gain >= least_gain * total:
                    states[s] = total, len(d)
    assert {len(s) for s in states} == {1, 2}
    out = []
    for d, t in rows:
        x = tokens(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        out.append((d, held(d), len(x), sum(c[w] > 0 for w in x), n, base, sum(math.log10(p(tuple(x[max(0, i - 2) : i]), w)) for i, w in enumerate(x))))
    return out


@pytest.mark.parametrize("spread", [0.5, 0.01])
def test_suffix_tree_lm(spark, spread):
    rng = random.Random(1)
    rows = []
    for i in range(250):
        t = []
        for _ in range(rng.randint(0, 60)):
            if len(t) > 1 and rng.random() < 0.6:
                t.append(f"w{(int(t[-1][1:]) * 7 + int(t[-2][1:])) % 30}")
            else:
                t.append(f"w{rng.randrange(30)}" if rng.random() < 0.95 else f"W{rng.randrange(5000)}")
        rows.append((i, " ".join(t)))
    rows += [(None, "w1 w2"), (5000, None), (5001, ""), (7, rows[7][1])]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, block string").repartition(3)
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    got = suffix_tree_lm.score_documents(df, remainder == 0, least_share=2e-3, spread_share=spread, block_bytes=4000).collect()
    want = expected_scores(rows, 2e-3, suffix_tree_lm.LEAST_GAIN)
    key = lambda r: (str(r[0]), r[2], r[5])
    for g, w in zip(sorted((tuple(r) for r in got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-6)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_lm_learns_rare_contexts(spark, depth):
    """Contexts of a few occurrences among 160,000 tokens, at every depth, by the same counts as a small corpus has."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(200))) for i in range(800)]
    phrase = "r0 r1 r2 r3 r0 r1 r4 r5"
    rows += [(i, f"w{i % 7} {phrase}") for i in range(900, 940) if not held(i)][:4] + [(i, phrase) for i in range(1000, 1100) if held(i)][:2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    found = suffix_tree_lm.score_documents(df, remainder == 0, block_bytes=100_000, depth=depth).collect()
    train = [tokens(t) for d, t in rows if not held(d)]
    n, c, after = sum(map(len, train)), Counter(w for t in train for w in t), defaultdict(Counter)
    for t in train:
        for k in range(1, depth + 1):
            for i in range(k, len(t)):
                after[tuple(t[i - k : i])][t[i]] += 1
    kept = {}

    def p(past, w):
        if not past:
            return max(c[w], 1) / (n + 1)
        lower, mine = p(past[1:], w), after.get(past, {})
        total, kinds = sum(mine.values()), len(mine)
        if past not in kept:
            gain = sum(x * (math.log(x / total) + round(-8 * math.log2(p(past[1:], y))) / 8 * math.log(2)) for y, x in mine.items())
            kept[past] = total >= 2 and gain > kinds and gain >= suffix_tree_lm.LEAST_GAIN * total
        return (mine.get(w, 0) + kinds * lower) / (total + kinds) if kept[past] else lower

    got = {r.id: r.score for r in found}
    assert len(got) == len(rows)
    for d, t in rows[::40] + rows[800:]:
        x = tokens(t)
        assert got[d] == pytest.approx(sum(math.log10(p(tuple(x[max(0, i - depth) : i]), w)) for i, w in enumerate(x)), abs=1e-6)
    assert any(kept[k] for k in kept if len(k) == depth and k[0].startswith("r"))


def test_contexts_that_share_upper_bits_stay_apart():
    contexts = np.array([1 << 32 | 5, 1 << 32 | 9, 1 << 32 | 5, 1 << 32 | 9], np.uint64)
    key = suffix_tree_lm._pair_key(*np.unique(contexts, return_inverse=True), np.array([1, 2, 3, 1], np.uint64))
    assert np.argsort(key).tolist() == [0, 2, 3, 1]


def test_lm_sends_few_bytes(spark):
    """Texts of mostly rare pairs: all that two levels, their words and the texts themselves send, against the bytes of text."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = [" ".join(words[int(3000 * rng.random() ** 3)] for _ in range(400)) for _ in range(300)]
    table = pa.table([pa.array([0] * 300), pa.array(range(300)), pa.array(rows), pa.array([True] * 300)], names=["block", "id", "text", "learn"])
    n = 300 * 401
    model = suffix_tree_lm.Model(n, 4, 2, 0.0, 5e-4, 0.02, 2)
    steps, size = [], 0
    sent = suffix_tree_lm.Words(suffix_tree_lm.Tokens(blocks.Block(table)), 4).sent()
    for level in range(3):
        payloads = [blocks.unpack(p) for p in sent.column("payload").to_pylist()]
        add = suffix_tree_lm._add_pairs(model, wide=False, last=level == 2) if level else suffix_tree_lm._add_words
        answers = [add([p])[0] for p in payloads]
        size += sum(len(x) for x in (*sent.column("payload").to_pylist(), *answers) if x is not None)
        kept = [(b + level * 4, 0, a) for b, a in zip(sent.column("bucket").to_pylist(), answers) if a is not None]
        steps += kept
        told = pa.table([pa.array(list(c), t) for c, t in zip(zip(*steps), (pa.int64(), pa.int64(), pa.binary()))], names=["bucket", "block", "payload"])
        if level < 2:
            sent = suffix_tree_lm._walk(blocks.Block(table), suffix_tree_lm.Answers(told, 4, 2), model, level + 1).sent()
    assert size < 1.0 * sum(map(len, rows)), size / sum(map(len, rows))


def test_packed_columns_come_back():
    ascending = np.array([0, 3, 3, 1 << 40, (1 << 63) + 5], np.uint64)
    assert (blocks.of_gaps(blocks.gaps(ascending), 5) == ascending).all() and not len(blocks.of_gaps(blocks.gaps(ascending[:0]), 0))
    assert (blocks.of_planes(blocks.planes(ascending[::-1]), 5) == ascending[::-1]).all()
    for dense in (False, True):
        back = blocks.unpack(blocks.pack(ascending, np.zeros(0, np.uint8), dense=dense))
        assert (back[0] == ascending).all() and not len(back[1])
    texts = ["", None, "\u00e9" * 9000, "a b"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(texts)], names=["id", "text"])
    found = pa.Table.from_batches(list(blocks._compressed(iter([batch])))).append_column("block", pa.array([0] * 4))
    block = blocks.Block(found)
    assert [block.data[a:b].tobytes().decode() for a, b in zip(block.offsets, block.offsets[1:])] == [t or "" for t in texts]


def test_lm_of_an_empty_table(spark):
    assert suffix_tree_lm.score_documents(spark.createDataFrame([], "doc_id long, text string"), F.lit(False)).count() == 0


def nearest(rows, top):
    out = {}
    for q, x in rows:
        if q % 3 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)
            out[q] = [(i, -s) for s, i in scores[:top]]
    return out


def test_neighbours_of_few_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(30)]
    rows += [(i, rows[0][1]) for i in range(30, 45)]  # copies tie by id
    bad = [(50, None), (51, [0.0] * 6), (52, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (53, [float("nan")] * 6), (54, [float("inf")] * 6), (55, []), (56, [1.0]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, leaf string")
    got = neighbours.search(df, F.pmod(F.col("id"), F.lit(3)) == 0, top=60, recall=1.0, chunk_rows=8).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    exact = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    want = nearest(exact, 60)
    assert found.keys() == want.keys()
    for q, items in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in items] and len(items) == 44
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in items], abs=1e-12)


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    got = {}
    for r in neighbours.search(df, F.pmod(F.col("id"), F.lit(20)) == 0, leaf_rows=24).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        hits.append(len(got[q] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.search(df, F.col("id") == 0).count() == 0


@pytest.mark.parametrize("bits", [1, 20, 48, 60, 64])
def test_sort_order_is_stable(bits):
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 1 << bits, 70_000, dtype=np.uint64)
    keys[::3] = keys[0]
    keys[1::7] ^= np.uint64(1)  # many keys that differ in the lowest bit only
    assert (arrays.sort_order(keys) == np.argsort(keys, kind="stable")).all()
    assert arrays.sort_order(keys[:0]).tolist() == [] and arrays.sort_order(keys[:1]).tolist() == [0]


def test_span_hashes_of_slices_and_long_spans():
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    cuts = np.unique(np.random.default_rng(2).integers(0, 5000, 400))
    starts, ends = cuts[:-1], np.maximum(cuts[:-1] + 1, cuts[1:] - 1)
    whole = arrays.Rolling(data).spans(starts, ends)
    for most in (1, 16, 700, 1 << 17):
        assert (arrays.span_hashes(data, starts, ends, most=most) == whole).all()
    assert len(arrays.span_hashes(data, starts[:0], ends[:0])) == 0


def test_context_ranks_follow_the_contexts():
    tokens = object.__new__(suffix_tree_lm.Tokens)
    rng = np.random.default_rng(3)
    number = rng.choice(np.unique(rng.integers(0, 1 << 32, 50, dtype=np.uint64)), 3000)
    tokens.word, tokens.number, tokens.place = number, number, np.arange(len(number))
    tokens.rank, tokens.rank_bits = np.unique(number, return_inverse=True)[1].astype(np.uint64), 6
    for depth in (1, 2, 3):
        context, there = tokens.context(depth)
        at = np.flatnonzero(there)
        got = tokens.context_rank(depth, context[at], at)
        assert (np.unique(got, return_inverse=True)[1] == np.unique(context[at], return_inverse=True)[1]).all()
