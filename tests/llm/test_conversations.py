"""Conversation repair against an exhaustive search on short ones and a left-to-right search on long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tabforge.llm import conversation_repair as repair

PATTERN = re.compile(r"(s?(ua)+)?")
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
EXTRA = "conv_id long, turn long, role string, text string, conv string, kind int, audit string"


def frame(spark, rows):
    """Columns whose names clash with those that the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], EXTRA).repartition(4)


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def options(role, fault):
    """(audit letter, initial of what results, cost, resulting role)."""
    yield "D", "", 4, None
    if fault not in ("blank", "duplicate"):
        extra = 3 * (fault == "truncated")
        yield "K", role[:1] or "?", extra, role
        for c in "ua":
            yield "R", c, 3 + extra, NAMES[c]


def search(rows, faults):
    """Least (cost, audit) and lines, state by state."""
    def insertions(states):
        for _ in range(3):
            for (p, c), q in MOVES.items():
                if c != "s" and p in states:
                    cost, audit, lines = states[p]
                    new = (cost + 3, audit + "I", [*lines, f"{NAMES[c]}:"])
                    if q not in states or new[:2] < states[q][:2]:
                        states[q] = new
        return states

    states = {0: (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        states, new = insertions(states), {}
        for p, (cost, audit, lines) in states.items():
            for letter, c, more, name in options(role, fault):
                q = p if letter == "D" else MOVES.get((p, c))
                found = (cost + more, audit + letter, lines if name is None else [*lines, f"{name}:{text}"])
                if q is not None and (q not in new or found[:2] < new[q][:2]):
                    new[q] = found
        states = new
    return min((v for q, v in insertions(states).items() if q in (0, 3)), key=lambda v: v[:2])


def exhaustive(rows, faults):
    best = None
    fill = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    for chosen in itertools.product(*[list(options(*x)) for x in zip([r for r, _ in rows], faults)]):
        for gaps in itertools.product(fill, repeat=len(rows) + 1):
            initials, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 3 * sum(map(len, gaps))
            for (letter, c, more, _), gap in zip(chosen, gaps[1:]):
                initials, audit, cost = initials + c + "".join(gap), audit + letter + "I" * len(gap), cost + more
            if (best is None or (cost, audit) < best) and PATTERN.fullmatch(initials):
                best = (cost, audit)
    return best


def plain(rows):
    """What ``repair`` returns, by conversation."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        said = [r[1:] for r in own]
        faults = faults_of(said)
        turns = [t for t, *_ in own if t is not None]
        cost, audit, lines = search(said, faults)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
               hashlib.sha256("\n".join(lines).encode()).hexdigest())


def result(frame):
    return sorted([(r.conv, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()], key=str)


def test_cells_equal_an_exhaustive_search():
    rng = random.Random(2)
    for n in (0, 1, 2, 3):
        for _ in range(1 if not n else 30):
            rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b", "", "c!"])) for _ in range(n)]
            faults = faults_of(rows)
            kinds = "".join(chr(97 + 4 * ("sua".find(r[:1]) if r[:1] in tuple("sua") else 3) + repair.FAULTS.index(f)) for (r, _), f in zip(rows, faults))
            assert repair.cheapest(repair.parse(kinds)) == exhaustive(rows, faults) == search(rows, faults)[:2]


def test_any_cut_gives_the_same_cell():
    rng = random.Random(4)
    for n in (5, 17, 60):
        kinds = "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
        whole = repair.parse(kinds)
        for at in (1, n // 3, n - 1):
            assert repair.combine(repair.parse(kinds[:at]), repair.parse(kinds[at:])) == whole


def conversations(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ok! ", "", " \t", "Why?\x0b", "é.", "\xa0", "Longer text here.", None, "x" * 5000 + "."]
    rows = []
    for conv in [None, -3, *range(40)]:
        for i in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([i, i, i + 2, i, None, 3]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts)))
        rows += rng.sample(rows, 1) if rng.random() < 0.3 else []
    # One long conversation, with a text that a third of its rows repeat.
    rows += [(77, i if i % 5 else None, ["user", "assistant", "system"][i % 7 % 3], "Again." if i % 3 == 0 else f"text {i}" + "."[: i % 4]) for i in range(3000)]
    return rows


@pytest.mark.parametrize("segment", [4096, 7])
def test_repair(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rows = conversations(segment)
    assert result(repair.repair(frame(spark, rows))) == sorted(plain(rows), key=str)


def test_damage(spark):
    rows = [(c, t, r, x) for c, t, r, x in conversations(1) if c != 77]
    want = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want += [(conv, turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    got = repair.damaged(frame(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_no_rows(spark):
    assert repair.repair(frame(spark, [])).count() == 0
    assert repair.damaged(frame(spark, []).filter(F.lit(False))).count() == 0
