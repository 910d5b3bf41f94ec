"""Conversation structure repair by a run-length dynamic program.

A conversation is right if its roles read ``(system? (user assistant)+)?``.
Rows may be kept (0), given the role user or assistant (1) or deleted (2);
rows without text may be put in anywhere (5). Blank and repeated rows have to
go, and a row that breaks off costs 5 if it stays. The cheapest edits are
found; among equally cheap ones the least string of their initials.

The program has four states (nothing yet, after system, after user, after
assistant), so a row is a 4 by 4 matrix over (min, +) that depends on its
symbol only: the role's initial and the fault. Equal neighbours are one run,
and a run is passed by cached binary powers of its matrix. Products of
matrices may be taken in pieces, so a conversation of any length is dealt out
by ranges of its rows: every piece gives its product, products from the end
back give each piece the costs that follow it, and pieces choose their edits
side by side for each state they may begin in. Only the sweep that writes
or hashes the repaired text passes a conversation in order in one task, as its
hash demands; it is streamed and holds no more than a batch and the edits.

Order: by turn (nulls first), then role, then the text's digest; equal rows are
adjacent. Edge cases: null roles and texts are one space; a role without an
initial of s, u or a (also an empty one) can be kept nowhere; a null id is a
conversation like any other; conversations without rows have zeros and empty
results; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import discard, materialize

REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
ROLES = {2: "user", 3: "assistant"}
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_INSERTED = (2, 2, 3, 2)
#: From a state by an initial (s, u, a) to the next.
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_INITIALS = "sua-"
#: Symbols: initial + 4 if the row breaks off; or a row that has to go.
GONE = 8
_END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 40

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    columns = list(zip(*b))
    return tuple(tuple(min(x + y for x, y in zip(row, col)) for col in columns) for row in a)


def before(a: Matrix, v: Vector) -> Vector:
    """Costs from each state on, given those after ``a``."""
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


_SAME: Matrix = tuple(tuple(0 if s == t else _FAR for t in range(4)) for s in range(4))


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row, in the order of the initials: (initial, cost, next state)."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        stays = BROKEN if symbol >= 4 else 0
        kept = _KEPT.get((state, _INITIALS[symbol % 4]))
        out += [("K", stays, kept)] if kept is not None else []
        out += [("R", stays + REROLE, _INSERTED[state])]
    return out


@lru_cache(None)
def step(symbol: int) -> Matrix:
    """A row's transition: inserts before it, then its own edit."""
    insert = [[_FAR] * 4 for _ in range(4)]
    for s in range(4):
        t = s
        for k in range(3):
            insert[s][t] = min(insert[s][t], k * INSERT)
            t = _INSERTED[t]
    own = [[_FAR] * 4 for _ in range(4)]
    for s in range(4):
        for _, cost, t in edits(symbol, s):
            own[s][t] = min(own[s][t], cost)
    return product(tuple(map(tuple, insert)), tuple(map(tuple, own)))


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2**k equal rows."""
    return step(symbol) if k == 0 else product(power(symbol, k - 1), power(symbol, k - 1))


@lru_cache(1 << 16)
def run(symbol: int, n: int) -> Matrix:
    out = _SAME
    for k in range(n.bit_length()):
        if n >> k & 1:
            out = product(out, power(symbol, k))
    return out


def piece(runs: bytes) -> Matrix:
    """The transition of a piece's runs."""
    out = _SAME
    for symbol, n in unpacked(runs):
        out = product(out, run(symbol, n))
    return out


_piece = lru_cache(1 << 12)(piece)


_RUN = np.dtype([("symbol", "u1"), ("n", "<u8")])


def packed(symbol: np.ndarray, n: np.ndarray) -> bytes:
    """Runs as bytes; equal neighbours become one, empty ones go."""
    symbol, n = symbol[n > 0], n[n > 0]
    if not len(symbol):
        return b""
    first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    out = np.empty(len(first), _RUN)
    out["symbol"], out["n"] = symbol[first], np.add.reduceat(n, first)
    return out.tobytes()


def unpacked(runs: bytes) -> list[tuple[int, int]]:
    return np.frombuffer(runs, _RUN).tolist()


@lru_cache(1 << 16)
def _back(symbol: int, v: Vector) -> Vector:
    """Costs before one row, less their least."""
    w = before(step(symbol), v)
    return tuple(x - min(w) for x in w)


@lru_cache(1 << 16)
def _choice(symbol: int, state: int, v: Vector) -> tuple[str, int]:
    """The least initials, and the state after the row, given the costs ``v`` after it."""
    now, out = before(step(symbol), v), ""
    while True:
        cost = now[state]
        ways = edits(symbol, state)
        if ways[0][1] + v[state] == cost:
            return out + "D", state
        t = _INSERTED[state]
        if INSERT + now[t] == cost:
            out, state = out + "I", t
            continue
        for initial, own, t in ways[1:]:
            if own + v[t] == cost:
                return out + initial, t
        raise AssertionError("no edit has the least cost")


def unroll(runs: bytes, state: int, after: Vector, last: bool) -> tuple[str, int]:
    """The edits of a piece that begins in ``state``, and the state it ends in."""
    v, behind, found = tuple(x - min(after) for x in after), [], unpacked(runs)
    for symbol, n in reversed(found):
        for _ in range(n):
            behind.append(v)
            v = _back(symbol, v)
    out: list[str] = []
    for symbol, n in found:
        for _ in range(n):
            letters, state = _choice(symbol, state, behind.pop())
            out.append(letters)
    if last:
        out.append("I" * (_END[state] // INSERT))
    return "".join(out), state


# On Spark.


def rows_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | Column = "1") -> DataFrame:
    """Rows (conv, turn, role, text, n, digest): ``n`` copies of a row, none for a row that only names its conversation."""
    copies = F.expr(copies) if isinstance(copies, str) else copies
    cols = {"conv": F.col(conv), "turn": F.col(turn), "role": F.coalesce(F.col(role), F.lit(" ")), "text": F.coalesce(F.col(text), F.lit(" "))}
    rows = df.select(*[c.alias(name) for name, c in cols.items()], copies.cast("long").alias("n"))
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv, turn, role, digest, n, blank, broken, first): ``first`` if its role and text did not occur before."""
    ending = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    each = rows.select("conv", "turn", "role", "digest", "n", ending.alias("ending")).groupBy("conv", "turn", "role", "digest")
    once = each.agg(F.sum("n").alias("n"), F.first("ending").alias("ending"))
    once = once.withColumns({"blank": F.col("ending") == "", "broken": ~F.col("ending").isin(".", "!", "?")}).drop("ending")
    once = materialize(once, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    earliest = once.filter("n > 0").groupBy("conv", "role", "digest").agg(F.min(place).alias("least"))
    least = earliest.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("least.turn").alias("at"))
    joined = once.join(least, (F.col("digest") == F.col("d")) & (F.col("role") == F.col("r")) & F.col("conv").eqNullSafe(F.col("c")), "left")
    return joined.select("conv", "turn", "role", "digest", "n", "blank", "broken", F.col("turn").eqNullSafe(F.col("at")).alias("first"))


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_PIECE = (
    "part int, blank long, duplicate long, truncated long, illegal long, turns long, first_initial int, last_initial int, first_turn long, "
    "last_turn long, runs binary, matrix array<long>"
)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


class _Piece:
    """What a task knows of one conversation's rows."""

    def __init__(self):
        self.count = dict.fromkeys(_COUNTS, 0)
        self.runs: list[bytes] = []
        self.initials: tuple[int, int] | None = None
        self.ends: tuple[int, int] | None = None

    def add(self, turn: pa.Array, initial: np.ndarray, n: np.ndarray, blank: np.ndarray, broken: np.ndarray, first: np.ndarray) -> None:
        there = n > 0
        if not there.all():
            turn = turn.filter(pa.array(there))
            initial, n, blank, broken, first = (x[there] for x in (initial, n, blank, broken, first))
        if not len(n):
            return
        stays, c = first & ~blank, self.count
        c["blank"] += int(n[blank].sum())
        c["duplicate"] += int((n - stays)[~blank].sum())
        c["truncated"] += int((stays & broken).sum())
        pairs = ~_LEGAL[initial[:-1], initial[1:]]
        c["illegal"] += int(pairs.sum() + (n - 1).sum())
        if self.initials:
            c["illegal"] += int(not _LEGAL[self.initials[1], initial[0]])
        self.initials = (self.initials or (int(initial[0]),))[0], int(initial[-1])
        known = turn.drop_null().to_numpy(zero_copy_only=False)
        if len(known):
            c["turns"] += 1 + int((known[1:] != known[:-1]).sum()) - int(self.ends is not None and self.ends[1] == known[0])
            self.ends = (self.ends or (int(known[0]),))[0], int(known[-1])
        symbol = np.full(2 * len(n), GONE)
        symbol[::2] = np.where(stays, initial + 4 * broken, GONE)
        times = np.ones(2 * len(n), np.int64)
        times[1::2] = n - 1
        self.runs.append(packed(symbol, times))

    def row(self) -> tuple:
        if len(self.runs) > 1:
            every = np.concatenate([np.frombuffer(r, _RUN) for r in self.runs])
            self.runs = [packed(every["symbol"], every["n"].astype(np.int64))]
        runs = b"".join(self.runs)
        return *self.count.values(), *(self.initials or (None, None)), *(self.ends or (None, None)), runs, [x for r in (_piece(runs) if len(runs) < 512 else piece(runs)) for x in r]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.RecordBatch, bool]]:
    """(key, rows, new) for each stretch of equal first columns of sorted batches; ``new`` where the key differs from the one before."""
    last: object = object()
    for b in batches:
        if b.num_rows:
            found = pc.run_end_encode(b.column(0))
            start = 0
            for key, end in zip(found.values.to_pylist(), found.run_ends.to_pylist()):
                yield key, b.slice(start, end - start), key != last
                start, last = end, key


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _typed(conv: T.DataType, rest: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv", conv)] + T._parse_datatype_string(rest).fields)
    return schema, to_arrow_schema(schema)


#: Rows that a task collects before it hands them on.
_OUT = 4096


def pieces(found: DataFrame) -> DataFrame:
    """One row per conversation and task: counts, runs and the product of its rows' transitions."""
    schema, arrow = _typed(found.schema["conv"].dataType, _PIECE)
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    dealt = found.repartitionByRange(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "digest")
    dealt = dealt.sortWithinPartitions(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "digest")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, at, now = TaskContext.get().partitionId(), [], None, None
        for key, b, new in _groups(batches):
            if new:
                if now:
                    out.append((at, part, *now.row()))
                at, now = key, _Piece()
            if len(out) >= _OUT:
                yield _table(out, arrow)
                out = []
            now.add(b.column(1), *(b.column(k).to_numpy(zero_copy_only=False) for k in range(2, 7)))
        if now:
            yield _table([*out, (at, part, *now.row())], arrow)

    return dealt.select("conv", "turn", initial.alias("initial"), "n", "blank", "broken", "first").mapInArrow(cut, schema)


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", "part")


def costs_behind(cut: DataFrame) -> DataFrame:
    """Pieces (conv, part, begins, ends, runs, after, report): ``after`` are the costs from a piece's end on.

    ``report`` is of the conversation, at its first piece: the counts, gaps and
    the least cost. A task holds one conversation's pieces without their runs
    being unpacked; there are no more of them than tasks before.
    """
    kind = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long>"
    schema, arrow = _typed(cut.schema["conv"].dataType, f"part int, begins boolean, ends boolean, runs binary, after array<long>, report {kind}")

    def solve(key: object, own: list[dict]) -> list[tuple]:
        v, after = _END, []
        for p in reversed(own):
            after.append(list(v))
            m = p["matrix"]
            v = before(tuple(tuple(m[k : k + 4]) for k in range(0, 16, 4)), v)
        total = {c: sum(p[c] for p in own) for c in _COUNTS}
        turn = initial = least = None
        for p in own:
            if p["first_initial"] is not None:
                total["illegal"] += initial is not None and not _LEGAL[initial, p["first_initial"]]
                initial = p["last_initial"]
            if p["first_turn"] is not None:
                total["turns"] -= turn == p["first_turn"]
                least = p["first_turn"] if least is None else least
                turn = p["last_turn"]
        gaps = 0 if least is None else turn - least + 1 - total.pop("turns")
        total.pop("turns", None)
        report = {"gaps": gaps, **{c: int(n) for c, n in total.items()}, "cost": v[0]}
        last = len(own) - 1
        return [(key, p["part"], k == 0, k == last, p["runs"], a, report if k == 0 else None) for k, (p, a) in enumerate(zip(own, reversed(after)))]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, at = [], [], None
        for key, b, new in _groups(batches):
            if new and own:
                out += solve(at, own)
                own = []
            if len(out) >= _OUT:
                yield _table(out, arrow)
                out = []
            at = key
            own += b.to_pylist()
        if own:
            yield _table(out + solve(at, own), arrow)

    return _by_conversation(cut).mapInArrow(chain, schema)


def choices(solved: DataFrame) -> DataFrame:
    """Each piece with its edits and end by the state it begins in; the first begins in state 0."""
    own = "part int, report {}, ends array<int>, edits array<string>".format(solved.schema["report"].dataType.simpleString())
    schema, arrow = _typed(solved.schema["conv"].dataType, own)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                each = [unroll(r["runs"], s, tuple(r["after"]), r["ends"]) for s in range(1 if r["begins"] else 4)]
                out.append((r["conv"], r["part"], r["report"], [t for _, t in each], [e for e, _ in each]))
            if out:
                yield _table(out, arrow)

    return solved.repartition("conv", "part").mapInArrow(choose, schema)


def audits(rows: DataFrame) -> DataFrame:
    """Rows (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one per conversation of ``rows_of``."""
    cut = materialize(pieces(faults(rows)), "pieces")
    chosen = materialize(choices(costs_behind(cut)), "edits")
    discard(cut)
    schema, arrow = _typed(rows.schema["conv"].dataType, f"report {chosen.schema['report'].dataType.simpleString()}, audit string")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, report, state, text = [], None, None, 0, []
        for key, b, new in _groups(batches):
            if new:
                if report:
                    out.append((at, report, "".join(text)))
                at, report, state, text = key, None, 0, []
            if len(out) >= _OUT:
                yield _table(out, arrow)
                out = []
            for r in b.to_pylist():
                report = report or r["report"]
                text.append(r["edits"][state])
                state = r["ends"][state]
        if report:
            yield _table([*out, (at, report, "".join(text))], arrow)

    return _by_conversation(chosen).mapInArrow(link, schema).select("conv", "report.*", "audit")


class _Editor:
    """Applies an audit to a conversation's rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            self.state = _INSERTED[self.state]
            yield ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEPT[self.state, role[0]]
            yield role, text
        elif edit == "R":
            self.state = _INSERTED[self.state]
            yield ROLES[self.state], text


def _sweep(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one task's stream."""
    head = audit.select("conv", F.lit(0).alias("phase"), "audit")
    body = rows.select("conv", F.lit(1).alias("phase"), "turn", "role", "digest", "text", "n").filter("n > 0")
    both = head.unionByName(body, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions(F.col("conv"), "phase", F.col("turn").asc_nulls_first(), "role", "digest")
    return both.select("conv", "phase", "audit", "role", "text", "n")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str] | tuple[object, None, None]]:
    """(conv, role, text) of the repaired rows; (conv, None, None) after the last of a conversation."""
    now: _Editor | None = None
    at = None
    for key, b, new in _groups(batches):
        if new:
            if now:
                yield from ((at, *x) for x in now.inserts())
                yield at, None, None
            at = key
        for phase, audit, role, text, n in zip(*(b.column(k).to_pylist() for k in range(1, 6))):
            if phase == 0:
                now = _Editor(audit)
                continue
            for _ in range(n):
                yield from ((key, *x) for x in now.row(role, text))
    if now:
        yield from ((at, *x) for x in now.inserts())
        yield at, None, None


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """The repaired conversations: rows (conv, place, role, text), places from 0."""
    schema, arrow = _typed(rows.schema["conv"].dataType, "place long, role string, text string")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, size = [], 0, 0
        for key, role, text in _edited(batches):
            if role is None:
                place = 0
                continue
            out.append((key, place, role, text))
            place, size = place + 1, size + len(text)
            if len(out) >= _OUT or size > 16 << 20:
                yield _table(out, arrow)
                out, size = [], 0
        if out:
            yield _table(out, arrow)

    return _sweep(rows, audit).mapInArrow(write, schema)


def digests(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows (conv, sha256) of the repaired ``role:text`` lines."""
    schema, arrow = _typed(rows.schema["conv"].dataType, "sha256 string")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, found, mark = [], hashlib.sha256(), ""
        for key, role, text in _edited(batches):
            if role is None:
                out.append((key, found.hexdigest()))
                found, mark = hashlib.sha256(), ""
            else:
                found.update(f"{mark}{role}:{text}".encode("utf-8", "surrogatepass"))
                mark = "\n"
            if len(out) >= _OUT:
                yield _table(out, arrow)
                out = []
        if out:
            yield _table(out, arrow)

    return _sweep(rows, audit).mapInArrow(write, schema)


def damaged(df: DataFrame) -> DataFrame:
    """``rows_of`` a table with a fixed share of rows dropped, emptied, cut, repeated or given the role user, by a checksum of id and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    rows = df.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    )
    return rows_of(rows, copies=F.col("n"))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = materialize(audits(rows), "audits")
    hashed = digests(rows, found).select(F.col("conv").alias("c"), F.col("sha256").alias("repaired_sha256"))
    return found.join(hashed, F.col("conv").eqNullSafe(F.col("c"))).drop("c").withColumnRenamed("conv", "conv_id")


_INSERTS = """(VALUES (0, '', 0, 0, ''), (1, '', 1, 0, ''), (2, '', 2, 0, ''), (3, '', 3, 0, ''), (0, 'I', 2, 5, 'user:'), (1, 'I', 2, 5, 'user:'),
    (3, 'I', 2, 5, 'user:'), (2, 'I', 3, 5, 'assistant:'), (0, 'II', 3, 10, 'user:' || chr(10) || 'assistant:'), (1, 'II', 3, 10, 'user:' || chr(10) || 'assistant:'),
    (3, 'II', 3, 10, 'user:' || chr(10) || 'assistant:'), (2, 'II', 2, 10, 'assistant:' || chr(10) || 'user:')) AS inserts(s, letters, t, price, line)"""
_EDITS = """(VALUES (0, 'D', '', 0, 2), (1, 'D', '', 1, 2), (2, 'D', '', 2, 2), (3, 'D', '', 3, 2), (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0),
    (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (0, 'R', '', 2, 1), (1, 'R', '', 2, 1), (3, 'R', '', 2, 1), (2, 'R', '', 3, 1)) AS edits(s, letter, initial, t, price)"""
#: The plain recursion over rows and states, each with its cheapest edits and lines so far.
ORACLE_SQL = rf"""WITH RECURSIVE bytes AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
      ORDER BY b) AS crc FROM (SELECT unnest(range(256)) AS b)),
    convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    rows AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      list_transform(string_split(coalesce(CAST(m.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS shown
      FROM conversations m JOIN convs ON m.conv_id IS NOT DISTINCT FROM convs.conv_id),
    kinds AS (SELECT * EXCLUDE (shown, crc), xor(list_reduce(list_prepend(4294967295, shown), lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS kind
      FROM rows, bytes),
    damaged AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
    placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
      regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS ending FROM damaged),
    judged AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(role[1]) OVER (PARTITION BY c ORDER BY i) || role[1] AS pair FROM placed),
    counted AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY c),
    dp AS (SELECT c, CAST(0 AS BIGINT) AS i, 0 AS s, 0 AS cost, '' AS audit, '' AS body FROM convs
      UNION ALL SELECT c, i, s, cost, audit, body FROM (SELECT *, row_number() OVER (PARTITION BY c, s ORDER BY cost, audit) AS best FROM (
        SELECT dp.c, judged.i, edits.t AS s, dp.cost + inserts.price + edits.price + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 5 ELSE 0 END AS cost,
          audit || letters || letter AS audit, body || CASE WHEN body <> '' AND line <> '' THEN chr(10) ELSE '' END || line
            || CASE WHEN letter = 'D' THEN '' ELSE CASE WHEN body <> '' OR line <> '' THEN chr(10) ELSE '' END
              || CASE WHEN letter = 'K' THEN role WHEN edits.t = 2 THEN 'user' ELSE 'assistant' END || ':' || text END AS body
        FROM dp JOIN judged ON judged.c = dp.c AND judged.i = dp.i + 1 JOIN {_INSERTS} ON inserts.s = dp.s JOIN {_EDITS} ON edits.s = inserts.t
          AND (letter <> 'K' OR edits.initial = role[1]) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate')))) WHERE best = 1),
    ends AS (SELECT dp.c, cost + price AS cost, audit || letters AS audit, body || CASE WHEN body <> '' AND line <> '' THEN chr(10) ELSE '' END || line AS body
      FROM dp LEFT JOIN counted ON counted.c = dp.c JOIN {_INSERTS} ON inserts.s = dp.s WHERE dp.i = coalesce(n, 0) AND inserts.t IN (0, 3)),
    chosen AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost, audit) = 1)
    SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(body) AS repaired_sha256
    FROM convs JOIN chosen USING (c) LEFT JOIN counted USING (c)"""
