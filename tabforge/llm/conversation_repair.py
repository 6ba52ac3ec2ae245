"""Repair of the turn structure of conversations at least cost: weighted interval parsing.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows are kept, given another
role, deleted, or rows inserted, each at a cost. The repair grammar is in Chomsky normal form: its
nonterminals X_pq derive the edits that lead from state p of that pattern to state q, with binary rules
X_pq -> X_pr X_rq, one set of terminal rules for each kind of row, and insertions closed into them. A
cell of a span holds the least (cost, audit) of every nonterminal; cells are combined bottom-up by span
length. As every derivation of a span can be cut at any place, one cut of each span is enough, so a
conversation of n rows needs about 2 n spans, and spans can be parsed in different tasks.

The cost follows from the audit, so of two audits of equal cost neither begins the other: the least of
them stays the least with anything written before or after both.

Rows are dealt out by ranges of (conversation, turn), so that a long conversation lies in several tasks;
each sends one cell a conversation. The repaired text is hashed in a second pass that streams the rows
of a conversation past its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import materialize

#: What separates words, and what ends a sentence, as classes of a regular expression (fixed values).
BLANK, ENDS = r"\x20\x09-\x0D", ".!?"
#: Costs of the edits; a row that is cut off and stays adds ``CUT_COST`` (fixed values).
RETYPE_COST, DELETE_COST, INSERT_COST, CUT_COST = 3, 4, 3, 3
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
FAULTS = ("", "blank", "duplicate", "truncated")
#: A row's kind is one character: its initial (``?`` for any that is no part of the pattern) and its fault.
INITIALS = "sua?"

Cell = dict[tuple[int, int], tuple[int, str]]


def _least(*cells: Cell) -> Cell:
    out: Cell = {}
    for cell in cells:
        for where, found in cell.items():
            if where not in out or found < out[where]:
                out[where] = found
    return out


def combine(left: Cell, right: Cell) -> Cell:
    """X_pq -> X_pr X_rq: the cell of two spans side by side."""
    by_start: dict[int, list[tuple[int, int, str]]] = {}
    for (r, q), (cost, audit) in right.items():
        by_start.setdefault(r, []).append((q, cost, audit))
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q, more, rest in by_start.get(r, ()):
            known = out.get((p, q))
            if known is None or cost + more < known[0] or (cost + more == known[0] and audit + rest < known[1]):
                out[p, q] = (cost + more, audit + rest)
    return out


_STAY: Cell = {(p, p): (0, "") for p in range(4)}
_INSERT: Cell = {(p, q): (INSERT_COST, "I") for (p, role), q in MOVES.items() if role in "ua"}


def _closed() -> Cell:
    """Any number of insertions."""
    out = _STAY
    while (more := _least(out, combine(out, _INSERT))) != out:
        out = more
    return out


CLOSURE = _closed()


@lru_cache(maxsize=None)
def terminal(kind: str) -> Cell:
    """Insertions and then one row of a kind: kept, given a role, or deleted."""
    initial, fault = INITIALS[(ord(kind) - 97) // 4], FAULTS[(ord(kind) - 97) % 4]
    cells: list[Cell] = [{(p, p): (DELETE_COST, "D") for p in range(4)}]
    if fault not in ("blank", "duplicate"):
        extra = CUT_COST * (fault == "truncated")
        cells.append({(p, q): (extra, "K") for (p, role), q in MOVES.items() if role == initial})
        cells.append({(p, q): (RETYPE_COST + extra, "R") for (p, role), q in MOVES.items() if role in "ua"})
    return combine(CLOSURE, _least(*cells))


@lru_cache(maxsize=1 << 14)
def _short(kinds: str) -> Cell:
    return parse_cells([terminal(k) for k in kinds])


def parse_cells(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans together, bottom-up by span length: pairs, pairs of pairs, and so on."""
    while len(cells) > 1:
        cells = [combine(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else _STAY


def parse(kinds: str) -> Cell:
    """The cell of rows of the given kinds, but for insertions after the last."""
    return parse_cells([_short(kinds[i : i + 8]) for i in range(0, len(kinds), 8)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the least derivation of a whole conversation; audits of equal cost compare by their letters."""
    whole = combine(cell, CLOSURE)
    return min(whole[START, q] for q in ACCEPTED if (START, q) in whole)


# --- rows ------------------------------------------------------------------------------------------------

def row_order() -> list[Column]:
    """A conversation's rows by turn (null first), role and digest of the text: equal rows are neighbours."""
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def with_kinds(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, kind, again, copies) of rows (conv, turn, role, text, digest); texts stay behind.

    Equal rows are folded: the first of ``copies`` is of ``kind`` (initial and first fault), the others of
    ``again``. The earliest turn of each (role, text) comes from a pre-aggregated join; blank rows, which
    need none, are spread by their turn.
    """
    blank = ~F.col("text").rlike(f"[^{BLANK}]")
    last = F.regexp_extract("text", rf"([^{BLANK}])[{BLANK}]*\z", 1)
    light = rows.select("conv", "turn", "role", "digest", blank.alias("blank"), (~last.isin(*ENDS)).alias("cut"))
    folded = light.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("copies"))
    said = F.when(F.col("blank"), F.xxhash64(F.lit("blank"), "turn").cast("string").cast("binary")).otherwise(F.col("digest"))
    turn = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    keyed = folded.withColumn("said", said)
    firsts = keyed.groupBy("conv", "role", "said").agg(F.min(turn).alias("first")).select(F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("said").alias("f_said"), "first")
    joined = keyed.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("said") == F.col("f_said")))
    fault = F.when(F.col("blank"), F.lit(FAULTS.index("blank"))).when(F.col("first") < turn, FAULTS.index("duplicate")).when(F.col("cut"), FAULTS.index("truncated")).otherwise(0)
    initial = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, F.lit(i)) for i, c in enumerate(INITIALS[:3])], F.lit(3))
    again = F.when(F.col("blank"), F.lit(FAULTS.index("blank"))).otherwise(FAULTS.index("duplicate"))
    return joined.select("conv", "turn", "role", "digest", F.chr(97 + initial * 4 + fault).alias("kind"), F.chr(97 + initial * 4 + again).alias("again"), "copies")


class Piece(NamedTuple):
    """What a run of a conversation's rows says about it; pieces side by side make the piece of both."""

    cell: Cell
    faults: tuple[int, int, int]
    illegal: int
    first: str
    last: str
    low: int | None
    high: int | None
    n_turns: int

    def __add__(self, other: Piece) -> Piece:
        turns = [p for p in (self, other) if p.low is not None]
        shared = len(turns) == 2 and self.high == other.low
        return Piece(combine(self.cell, other.cell), tuple(a + b for a, b in zip(self.faults, other.faults)),
                     self.illegal + other.illegal + (self.last + other.first not in LEGAL), self.first, other.last,
                     turns[0].low if turns else None, turns[-1].high if turns else None, self.n_turns + other.n_turns - shared)


def piece_of(kinds: str, turns: list[int | None]) -> Piece:
    initials = "".join(INITIALS[(ord(k) - 97) // 4] for k in kinds)
    faults = [(ord(k) - 97) % 4 for k in kinds]
    known = [t for t in turns if t is not None]
    return Piece(parse(kinds), (faults.count(1), faults.count(2), faults.count(3)), sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
                 initials[0], initials[-1], known[0] if known else None, known[-1] if known else None, len(set(known)))


def together(pieces: list[Piece]) -> Piece:
    """Neighbouring pieces as one, bottom-up like the cells."""
    while len(pieces) > 1:
        pieces = [pieces[i] + pieces[i + 1] if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


#: Rows of a conversation that are parsed at a time.
SEGMENT_ROWS = 4096

_CELL = T.ArrayType(T.StructType([T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
_PIECES = T.StructType([T.StructField("conv", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("cell", _CELL), T.StructField("faults", T.ArrayType(T.LongType())),
                        T.StructField("illegal", T.LongType()), T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
                        T.StructField("low", T.LongType()), T.StructField("high", T.LongType()), T.StructField("n_turns", T.LongType())])
_ARROW_CELL = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_ARROW_PIECES = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("cell", _ARROW_CELL), ("faults", pa.list_(pa.int64())), ("illegal", pa.int64()), ("first", pa.string()),
                           ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("n_turns", pa.int64())])
_FOUND = T.StructType([T.StructField("conv", T.LongType())] + [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                      + [T.StructField("audit", T.StringType())])


def _piece_batch(found: list[tuple[int | None, int, Piece]]) -> pa.RecordBatch:
    rows = []
    for conv, part, piece in found:
        cell = [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in piece.cell.items()]
        rows.append({"conv": conv, "part": part, **piece._asdict(), "cell": cell, "faults": list(piece.faults)})
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW_PIECES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece for each conversation of a partition, whose rows come in order."""
    part = TaskContext.get().partitionId()
    now: int | None = None
    done: list[tuple[int | None, int, Piece]] = []
    pieces: list[Piece] = []
    kinds: list[str] = []
    turns: list[int | None] = []

    def flush() -> None:
        if kinds:
            pieces.append(piece_of("".join(kinds), turns))
            kinds.clear()
            turns.clear()

    def close() -> None:
        flush()
        if pieces:
            done.append((now, part, together(pieces)))
            pieces.clear()

    for batch in batches:
        for conv, turn, kind, again, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if conv != now:
                close()
                now = conv
            for i in range(copies):
                kinds.append(again if i else kind)
                turns.append(turn)
                if len(kinds) == SEGMENT_ROWS:
                    flush()
        if len(done) >= 1024:
            yield _piece_batch(done)
            done = []
    close()
    if done:
        yield _piece_batch(done)


def _finish(table: pa.Table) -> pa.Table:
    """The verdict on one conversation from its pieces."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    pieces = [Piece({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in r["cell"]}, tuple(r["faults"]), *(r[n] for n in Piece._fields[2:])) for r in rows]
    whole = together(pieces)
    cost, audit = cheapest(whole.cell)
    gaps = 0 if whole.low is None else whole.high - whole.low + 1 - whole.n_turns
    values = [rows[0]["conv"], gaps, *whole.faults, whole.illegal, cost]
    return pa.table([pa.array([v], pa.int64()) for v in values] + [pa.array([audit], pa.string())], names=_FOUND.names)


def audited(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of rows with kinds."""
    sorted_rows = rows.repartitionByRange(*row_order()).sortWithinPartitions(*row_order())
    pieces = sorted_rows.select("conv", "turn", "kind", "again", "copies").mapInArrow(_pieces, _PIECES)
    return pieces.groupBy("conv").applyInArrow(_finish, _FOUND)


def edits_of(audit: str) -> Iterator[tuple[str, str | None]]:
    """(edit, role of the row that results), in order; None where the row keeps its role, or goes."""
    state = START
    for at, edit in enumerate(audit):
        if edit == "D":
            yield edit, None
            continue
        if edit == "K" and state == START:
            # The first row is the system's if whole pairs follow it.
            state = USER if sum(e != "D" for e in audit[at + 1 :]) % 2 else SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        yield edit, None if edit == "K" else "assistant" if state == ASSISTANT else "user"


_HASHED = T.StructType([T.StructField("conv", T.LongType()), T.StructField("repaired_sha256", T.StringType())])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams each conversation's rows past its audit, which comes first; keeps one hash and no texts."""
    now, edits, digest, empty = None, iter(()), None, True
    ids: list[int | None] = []
    hexes: list[str] = []

    def write(role: str, text: str) -> None:
        nonlocal empty
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        empty = False

    def close() -> None:
        if digest is not None:
            for _, role in edits:  # insertions after the last row
                write(role, "")
            ids.append(now)
            hexes.append(digest.hexdigest())

    for batch in batches:
        for conv, audit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if audit is not None:
                close()
                now, edits, digest, empty = conv, edits_of(audit), hashlib.sha256(), True
                continue
            for edit, new_role in edits:
                if edit == "I":
                    write(new_role, "")
                    continue
                if edit != "D":
                    write(role if edit == "K" else new_role, text)
                break
        if len(ids) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes, pa.string())], names=_HASHED.names)
            ids, hexes = [], []
    close()
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes, pa.string())], names=_HASHED.names)


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    A null role or text is one space; rows with a null id are one conversation. Rows are taken by turn
    (null first), then role and md5 of the text, so ties and repeated rows have one order. A row's first fault
    counts: blank, duplicate (role and text seen before), truncated. Roles that begin with none of s, u
    and a, empty ones among them, can't stay as they are. ``gaps`` is the number of turns missing between
    the first and the last.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    found = materialize(audited(with_kinds(rows)), "conversation-audits")
    audits = found.select("conv", F.lit(0).alias("at"), "audit")
    streamed = audits.unionByName(rows.withColumn("at", F.lit(1)), allowMissingColumns=True).repartition("conv")
    conv, *rest = row_order()
    hashed = streamed.sortWithinPartitions(conv, "at", *rest).select("conv", "audit", "role", "text").mapInArrow(_hashes, _HASHED)
    marks = hashed.select(F.col("conv").alias("h_conv"), "repaired_sha256")
    return found.join(marks, F.col("conv").eqNullSafe(F.col("h_conv"))).drop("h_conv")


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 gives it the
    role user. In the hashed text, roles and texts a null is one space.
    """
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    name = F.concat_ws(":", F.coalesce(conv.cast("string"), F.lit(" ")), F.coalesce(turn.cast("string"), F.lit(" ")))
    case = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    rows = conversations.select(conv.alias("conv_id"), turn.alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), case.alias("case"))
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    return rows.filter("case <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
