"""Line deduplication against brute force: shared lines, blanks, nulls, repeated rows, crowded ranges."""

import random
from collections import defaultdict

import pytest

from tabforge.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"
EXTRA = "doc_id long, text string, id string, row int, pos string, hash string"


def frame(spark, rows):
    """Columns whose names clash with those that the operator uses."""
    return spark.createDataFrame([(d, t, "x", 1, "y", "z") for d, t in rows], EXTRA).repartition(4)


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(BLANKS)


def brute(rows, least_docs, least_length=1):
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    common = {k for k, ids in holders.items() if len(k) >= least_length and len(ids) >= least_docs}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        yield d, len(lines), len(lines) - len(kept), "\n".join(kept)


def corpus(seed):
    rng = random.Random(seed)
    pool = ["Share this", " share THIS\t", "Ärger", "ärger", "\xa0edge", "a", "", "  ", "\x0b", "end.", "日本 語", "x" * 3000, "tab\tinside"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"line {rng.randint(0, 400)}" for _ in range(rng.randint(0, 9))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), "The one line that a third of all documents hold")
        rows.append((rng.choice([i, i, i, 7]), "\n".join(lines)))
    rows += [(None, "Share this\nonly here"), (None, "Share this\nonly here"), (None, None), (3, None), (4, ""), (-5, "a\n\na\n"), (-5, "a\n\na\n"), (900, "\n" * 50),
             (901, "\n".join(f"long {i % 3000}" for i in range(20_000)) + "\nend.")]
    return rows


def rows_of(frame):
    return sorted([(r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in frame.collect()], key=str)


@pytest.mark.parametrize(("least_docs", "least_length", "slice_lines"), [(3, 1, 10**9), (10, 1, 40), (2, 5, 3), (1, 1, 1)])
def test_common_lines_go(spark, least_docs, least_length, slice_lines):
    rows = corpus(least_docs)
    docs = frame(spark, rows)
    got = line_dedup.remove_common_lines(docs, least_docs, least_length, slice_lines=slice_lines)
    assert rows_of(got) == sorted(brute(rows, least_docs, least_length), key=str)
    assert got.select("doc.*").columns == docs.columns


def test_small_ranges_are_cut_too(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "RANGE_BITS", 2)
    rows = corpus(8)[:-1]
    lines = line_dedup.line_keys(frame(spark, rows))
    assert len(line_dedup.crowded_spans(lines, 10)) == 0  # four average ranges are more than all there are
    monkeypatch.setattr(line_dedup, "RANGE_BITS", 5)
    assert line_dedup.crowded_spans(line_dedup.line_keys(frame(spark, rows)), 10)
    assert rows_of(line_dedup.remove_common_lines(frame(spark, rows), 4, slice_lines=10)) == sorted(brute(rows, 4), key=str)


@pytest.mark.parametrize("slice_lines", [10**9, 2])
def test_first_line_of_a_key_stays(spark, slice_lines):
    rows = [(1, "A\nb\nA"), (2, "a\nc"), (5, "c \nd"), (None, "c\nd"), (7, "D\ne")]
    got = line_dedup.remove_common_lines(frame(spark, rows), 2, keep_first=True, slice_lines=slice_lines)
    assert rows_of(got) == sorted([(1, 3, 1, "A\nb"), (2, 2, 1, "c"), (5, 2, 1, "d"), (None, 2, 2, ""), (7, 2, 1, "e")], key=str)


def test_bitmaps_are_run_lengths(spark):
    rows = [(1, "x\na\na\ny\na"), (2, "a\nz"), (3, "q")]
    found = {r.id: (r.n_dropped, r.flips) for r in line_dedup.keep_bitmaps(frame(spark, rows), 2).collect()}
    assert found == {1: (3, [1, 3, 4, 5]), 2: (1, [0, 1])}


def test_no_rows_and_no_python(spark):
    got = line_dedup.remove_common_lines(frame(spark, []))
    assert got.count() == 0
    plan = line_dedup.remove_common_lines(frame(spark, corpus(1)), 3, slice_lines=5)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))
