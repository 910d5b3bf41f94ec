"""Secret scans: base patterns, and formats inferred from what those find.

The base patterns find assignments, access keys and long hex strings. Their
values are labelled credentials. Per kind, a prefix tree of the values is
folded into a probabilistic automaton by merging states whose outgoing
frequencies are compatible (ALERGIA, Carrasco and Oncina 1994). A symbol is a
character itself where many labelled values agree on it after the same start
(so ``AKIA`` stays literal), else the character's class. Ordinary strings give
a background automaton in the same way.

A candidate is a maximal run of at least ``CANDIDATE`` credential characters
with a letter and a digit, outside the base spans. All candidates of all texts
are scored: the log-likelihood of the best format over the background, each
class spread evenly over its characters. A run becomes a span of kind
``format`` where that gain outweighs the odds against it, which are counted
over all distinct candidates and labelled values, at ``ACCEPT``.

The automata are fitted on at most ``SAMPLE`` distinct values per kind, those
of least hash, of at most ``LEARNED`` characters. The background starts from
long runs without a letter or without a digit, so unlabelled credentials are
no part of it; candidates that gain under a quarter of what labelled values
do, or under half a character, then join it.

Edge cases: null and empty texts have no spans; long texts and long runs are
scanned whole, in linear time; repeated rows are scanned each; kinds of
fewer than ``LEAST_VALUES`` labelled values infer no format; an empty table gives an empty table;
only the id and text columns are read unless rows are redacted, which keeps
every column.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spans import SPANS, SpanIndex, count_of, joined, replace
from .storage import materialize

KINDS = ("assign", "access", "hex")
#: Least length of a candidate, as of an assigned value, and of a string that starts the background.
CANDIDATE, ORDINARY = 6, 16
SAMPLE, LEARNED = 400, 256
#: Distinct labelled values that a kind needs before a format is inferred from them.
LEAST_VALUES = 20
ALPHA = 0.05
#: Rounds in which candidates may join the background.
ROUNDS = 4
#: Probability from which a candidate becomes a span, and the least gain for it.
ACCEPT, LEAST_GAIN = 0.99, 8.0
#: Values that a literal edge needs before it, and the share of them that take it.
LITERAL_MASS, LITERAL_SHARE = 20, 0.2
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_FROM_DIGIT = re.compile(r"[0-9][A-Za-z0-9+/_=-]*+")
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % ORDINARY)
_RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def value_of(kind: str, match: str) -> str:
    return _ASSIGN.match(match)[2] if kind == "assign" else match


def candidates(text: str, base: SpanIndex) -> list[tuple[int, int]]:
    """Runs with a letter and a digit outside the base spans, by start."""
    out, last = [], 0
    for m in _FROM_DIGIT.finditer(text):
        start, end = m.span()
        while start > last and text[start - 1] in _RUN_CHARS:
            start -= 1
        last = end
        if end - start >= CANDIDATE and _LETTER.search(text, start, end) and base.free(start, end):
            out.append((start, end))
    return out


def ordinary(text: str, base: SpanIndex) -> list[str]:
    """Long runs that cannot be candidates."""
    runs = (m for m in _LONG.finditer(text) if m.end() - m.start() <= LEARNED and base.free(*m.span()))
    return [m[0] for m in runs if not (_LETTER.search(m[0]) and _DIGIT.search(m[0]))]


#: Classes of characters: hex and other letters by case, digits, the rest as is.
_MEMBERS = {"h": "abcdef", "a": "ghijklmnopqrstuvwxyz", "H": "ABCDEF", "A": "GHIJKLMNOPQRSTUVWXYZ", "0": "0123456789",
            **{c: c for c in "+/_=.-"}}
_CLASS = {c: k for k, members in _MEMBERS.items() for c in members}
#: Log-probability of one character within its class; a literal symbol is its character.
_WITHIN = {k: -math.log(len(members)) for k, members in _MEMBERS.items()}


def literal_tree(values: dict[str, int]) -> dict:
    """The starts on which labelled values agree, as nested edges."""

    def node(part: list[tuple[str, int]], depth: int) -> dict:
        mass, by = sum(n for _, n in part), defaultdict(list)
        for v, n in part:
            if len(v) > depth:
                by[v[depth]].append((v, n))
        often = {c: x for c, x in by.items() if sum(n for _, n in x) >= max(LITERAL_MASS, LITERAL_SHARE * mass)}
        return {c: node(x, depth + 1) for c, x in sorted(often.items())} if mass >= LITERAL_MASS else {}

    return node([(v[:LEARNED], n) for v, n in values.items()], 0)


def symbols(value: str, tree: dict | None = None) -> tuple[str, ...]:
    """``=c`` for characters on a literal start, then character classes."""
    out, at = [], 0
    while tree and at < len(value) and value[at] in tree:
        out.append("=" + value[at])
        tree, at = tree[value[at]], at + 1
    return (*out, *map(_CLASS.__getitem__, value[at:]))


@dataclass
class Automaton:
    """Transition counts and targets per state; state 0 starts."""

    count: list[dict[str, float]] = field(default_factory=list)
    target: list[dict[str, int]] = field(default_factory=list)
    end: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._logs: list[dict[str, float]] = []

    def log_likelihood(self, word: Sequence[str]) -> float:
        """Of the characters that spell these symbols, and of ending there."""
        if not self._logs:
            for have, end in zip(self.count, self.end):
                mass = math.log(end + sum(have.values()) + 0.5 * (len(_MEMBERS) + 1))
                logs = {c: math.log(have.get(c, 0) + 0.5) - mass + _WITHIN[c] for c in _MEMBERS}
                logs |= {c: math.log(n + 0.5) - mass for c, n in have.items() if c not in _MEMBERS}
                self._logs.append(logs | {"": math.log(end + 0.5) - mass})
        state, total = 0, 0.0
        for c in word:
            logs = self._logs[state]
            total += logs[c] if c in logs else logs[""]  # a literal that this state never saw
            state = self.target[state].get(c, state)
        return total + self._logs[state][""]


def infer(values: dict[Sequence[str], int], alpha: float = ALPHA) -> Automaton:
    """Merge compatible prefix-tree states of weighted symbol strings."""
    count: list[dict[str, float]] = [{}]
    target: list[dict[str, int]] = [{}]
    end = [0.0]
    for value, weight in sorted(values.items()):
        state = 0
        for c in value:
            if c not in target[state]:
                target[state][c] = len(count)
                count.append({})
                target.append({})
                end.append(0.0)
            count[state][c] = count[state].get(c, 0) + weight
            state = target[state][c]
        end[state] += weight
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    mass = lambda s: end[s] + sum(count[s].values())

    def differ(f1: float, n1: float, f2: float, n2: float) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = mass(a), mass(b)
            if differ(end[a], n1, end[b], n2):
                return False
            for c in count[a].keys() | count[b].keys():
                if differ(count[a].get(c, 0), n1, count[b].get(c, 0), n2):
                    return False
                if c in target[a] and c in target[b]:
                    todo.append((target[a][c], target[b][c]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the subtree at b to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            end[a] += end[b]
            for c, n in count[b].items():
                count[a][c] = count[a].get(c, 0) + n
                if c in target[a]:
                    todo.append((target[a][c], target[b][c]))
                else:
                    target[a][c] = target[b][c]

    red, parent = [0], {t: (0, c) for c, t in sorted(target[0].items())}
    while parent:
        blue = max(parent, key=lambda s: (mass(s), -s))
        p, c = parent.pop(blue)
        for r in red:
            if compatible(r, blue):
                target[p][c] = r
                fold(r, blue)
                break
        else:
            red.append(blue)
        known = set(red)
        parent = {t: (r, c) for r in red for c, t in sorted(target[r].items()) if t not in known}
    at = {r: k for k, r in enumerate(red)}
    return Automaton(
        [count[r] for r in red], [{c: at[t] for c, t in target[r].items()} for r in red], [end[r] for r in red]
    )


@dataclass
class Formats:
    """Format automata with their literal starts by kind, the background, and the gain a span needs."""

    kinds: dict[str, tuple[dict, Automaton]]
    background: Automaton
    threshold: float

    def gains(self, value: str) -> dict[str, float]:
        base = self.background.log_likelihood(symbols(value))
        return {k: a.log_likelihood(symbols(value, tree)) - base for k, (tree, a) in self.kinds.items()}

    def found(self, text: str, base: SpanIndex) -> list[tuple[str, int, int]]:
        return [("format", s, e) for s, e in candidates(text, base) if max(self.gains(text[s:e]).values()) > self.threshold]


_RUN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_BASE = pa.struct([*_SPAN, ("text", pa.string())])
_SCANNED = (
    "base array<struct<kind:string,start:int,end:int,text:string>>, candidates array<struct<start:int,end:int,text:string>>, "
    "ordinary array<string>"
)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, candidates, ordinary): base spans, runs outside of them, and background strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, runs, other = [], [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                found = base_spans(text)
                index = SpanIndex(found)
                base.append([{"kind": k, "start": s, "end": e, "text": text[s:e]} for k, s, e in found])
                runs.append([{"start": s, "end": e, "text": text[s:e]} for s, e in candidates(text, index)])
                other.append(ordinary(text, index))
            cols = [pa.array(base, pa.list_(_BASE)), pa.array(runs, pa.list_(_RUN)), pa.array(other, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "base", "candidates", "ordinary"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *T._parse_datatype_string(_SCANNED)])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def learn(scanned: DataFrame, sample: int = SAMPLE) -> Formats | None:
    """Fit the automata; None if no base span labels a credential.

    Distinct values are counted once; per kind the ``sample`` of least hash
    and the number of all of them reach the driver.
    """
    one = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))
    each = F.concat(
        F.transform("base", lambda s: one(s["kind"], s["text"])),
        F.transform("candidates", lambda s: one(F.lit("mixed"), s["text"])),
        F.transform("ordinary", lambda s: one(F.lit(""), s)),
    )
    values = scanned.select(F.explode(each).alias("v")).select("v.kind", "v.text").distinct()
    values = materialize(values.withColumn("hash", F.xxhash64("text")), "values")
    number = {r.kind: r.n for r in values.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # five kinds
    if not any(number.get(k) for k in KINDS):
        return None
    # Hashes are uniform: this many least ones hold the sample, so the window sees a few thousand rows however many tasks there are.
    bound = {k: -(2**63) + min(2**64 - 1, 4 * sample * 2**64 // n) for k, n in number.items()}
    least = reduce(lambda a, b: a | b, ((F.col("kind") == k) & (F.col("hash") <= h) for k, h in bound.items()))
    short = values.filter((F.length("text") <= LEARNED) & least)
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("hash", "text"))
    drawn: dict[str, Counter] = defaultdict(Counter)
    for r in short.withColumn("k", rank).filter(F.col("k") <= sample).collect():  # ``sample`` rows per kind
        drawn[r.kind][value_of(r.kind, r.text) if r.kind in KINDS else r.text] += 1
    return fit(drawn, number)


def fit(drawn: dict[str, dict[str, int]], number: dict[str, int]) -> Formats | None:
    """Formats from drawn values by kind, and how many distinct ones there are of each kind."""
    kinds = {}
    for k in KINDS:
        if len(drawn.get(k) or ()) >= LEAST_VALUES:
            tree = literal_tree(drawn[k])
            kinds[k] = tree, infer(_spelled(drawn[k], tree))
    if not kinds:
        return None
    start, mixed, joined = drawn.get("") or {"g" * ORDINARY: 1}, drawn.get("mixed") or {}, {}
    for _ in range(ROUNDS):
        formats = Formats(kinds, infer(_spelled({**start, **joined})), 0.0)
        whole, each = {}, {}
        for k in kinds:
            gains = {v: formats.gains(v)[k] for v in drawn[k]}
            whole[k], each[k] = median(gains.values()), median(g / len(v) for v, g in gains.items())
        plain = lambda v, k, g: g <= max(LEAST_GAIN, whole[k] / 4) or g <= len(v) * each[k] / 2
        explained = {v: n for v, n in mixed.items() if all(plain(v, k, g) for k, g in formats.gains(v).items())}
        if explained == joined:
            break
        joined = explained
    against = number.get("mixed", 0) / sum(number.get(k, 0) for k in kinds)
    formats.threshold = max(LEAST_GAIN, math.log(max(against, 1.0)) + math.log(ACCEPT / (1 - ACCEPT)))
    return formats


def _spelled(values: dict[str, int], tree: dict | None = None) -> dict[tuple[str, ...], int]:
    out: Counter = Counter()
    for v, n in values.items():
        out[symbols(v, tree)] += n
    return out


def with_formats(scanned: DataFrame, formats: Formats | None) -> DataFrame:
    """Rows (id, base, spans): base spans and those that a format adds."""
    shared = scanned.sparkSession.sparkContext.broadcast(formats)  # a few automata of bounded samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, order = shared.value, (*KINDS, "format").index
        for b in batches:
            out, bare = [], []
            for base, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                base = [{k: s[k] for k in ("kind", "start", "end")} for s in base]
                new = [r for r in runs if f and max(f.gains(r["text"]).values()) > f.threshold]
                more = [{"kind": "format", "start": r["start"], "end": r["end"]} for r in new]
                bare.append(base)
                out.append(sorted(base + more, key=lambda s: (s["start"], order(s["kind"]))))
            cols = [pa.array(x, pa.list_(_SPAN)) for x in (bare, out)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "base", "spans"])

    schema = T.StructType([scanned.schema["id"]]).add("base", T._parse_datatype_string(SPANS))
    return scanned.select("id", "base", "candidates").mapInArrow(run, schema.add("spans", T._parse_datatype_string(SPANS)))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, spans), one per row of ``df``; spans by start, then kind."""
    scanned = materialize(scan(df, id_col, text_col), "scanned")
    return with_formats(scanned, learn(scanned))


def redact_secrets(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with every secret span of its text replaced by ``[kind]``.

    The columns stay; ``length_col``, if there, follows the new text. The
    texts are scanned once to learn the formats and once to apply them.
    """
    scanned = materialize(scan(df.select(F.lit(0).alias("id"), text_col), "id", text_col), "scanned")
    shared = df.sparkSession.sparkContext.broadcast(learn(scanned))

    text_at = df.columns.index(text_col)
    length_at = df.columns.index(length_col) if length_col in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for b in batches:
            at = text_at
            texts = []
            for text in b.column(at).to_pylist():
                spans = base_spans(text or "")
                if f:
                    spans = spans + f.found(text or "", SpanIndex(spans))
                texts.append(replace(text, spans) if spans else text)
            b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
            n = length_at
            if n is not None:
                old = b.column(n).to_pylist()
                new = [len(x) if x is not None and y is not None else y for x, y in zip(texts, old)]
                b = b.set_column(n, b.schema.field(n), pa.array(new, b.schema.field(n).type))
            yield b

    # Columns go by place, so that any name will do.
    names, places = df.columns, [f"c{k}" for k in range(len(df.columns))]
    return df.toDF(*places).mapInArrow(run, T.StructType([T.StructField(p, f.dataType) for p, f in zip(places, df.schema)])).toDF(*names)


def op7_inferred_secret_formats(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count_of("base", k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
