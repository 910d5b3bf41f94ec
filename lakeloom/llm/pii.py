"""Personal data by weak supervision: labelers vote, EM weighs them.

Base patterns find e-mail and IP addresses, card and phone numbers. Wider
candidate patterns find what may be such data in other shapes. On every
candidate, labelers of three sorts vote for, against, or not at all: regex
labelers (strict form, checksum, grouping), gazetteer labelers (top-level
domains, country codes, issuer digits, words that name other numbers) and
context labelers (words before it, other personal data near it).
Expectation-maximisation over the counted vote patterns estimates each
labeler's reliability and each pattern's odds (Dawid and Skene 1979), and a
logistic classifier over votes and span shape is trained on these odds. It
decides the candidates outside the base spans; base spans always stay.

Vote patterns and shapes are counted over all candidates of all texts; the
classifier is fitted on at most ``TRAIN`` distinct (pattern, shape) rows, by
least hash, with their counts as weights.

Edge cases: null and empty texts have no spans; long texts are scanned whole;
repeated rows are scanned each; without candidates no classifier is trained;
an empty table gives an empty table; only the id and text columns are read,
so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spans import SPANS, SpanIndex, count_of, joined
from .storage import materialize

KINDS = ("email", "ip", "card", "phone")
TRAIN = 20_000
#: Odds from which a candidate becomes a span.
ACCEPT = 0.9
_NEAR = 48

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The lookbehinds keep long digit runs linear; a run's first digit decides.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_WIDE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]++\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[\w-]++(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,}+)+"),
    "ip": re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])"),
    "card": _CARD,
    "phone": re.compile(r"(?<![0-9A-Za-z.+-])\(?0?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9A-Za-z-])"),
}
# Gazetteers.
_DOMAINS = frozenset("com org net edu gov info io co de fr es uk eu at ch us ca".split())
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 91".split())
_ISSUERS = frozenset("3456")
_OTHER_NUMBERS = frozenset("version isbn issn doi page pages seite página order invoice no nr id build rev serial sku".split())
_NAMING = {
    "email": frozenset("email e-mail mail contact contacto kontakt courriel correo write".split()),
    "ip": frozenset("ip host server address adresse dirección login client".split()),
    "card": frozenset("card visa mastercard amex credit debit karte carte tarjeta cc payment".split()),
    "phone": frozenset("phone tel telephone téléphone teléfono telefon call mobile cell fax handy".split()),
}
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        after = at
        if at > last:
            local = _local(text, last, at)
            domain = _DOMAIN.match(text, at + 1) if local < at else None
            if domain:
                yield local, domain.end()
                last, after = domain.end(), domain.end() - 1
            else:
                last = at + 1  # the run before ends at this @, whatever its start
        at = text.find("@", after + 1)


_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def _local(text: str, low: int, at: int) -> int:
    """Start of the run of local characters that ends at ``at``."""
    step, start = 64, at
    while start > low:
        begin = max(low, start - step)
        stops = [m.end() for m in _NOT_LOCAL.finditer(text, begin, start)]
        if stops:
            return stops[-1]
        start, step = begin, step * 2
    return start


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0]))
        if len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The base spans, and wider matches outside of them."""
    out = list(base)
    for kind in KINDS:
        if kind == "email" and not ("at)" in text or "at]" in text or "at}" in text or " at " in text):
            continue
        found = [m.span() for m in _WIDE[kind].finditer(text)]
        if found:
            taken = SpanIndex(out)
            out += [(kind, *span) for span in found if taken.free(*span)]
    return out


def votes(text: str, kind: str, start: int, end: int, base: SpanIndex) -> str:
    """One character per labeler: + for, - against, . no vote."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    sign = lambda yes, no: "+" if yes else "-" if no else "."
    own = (kind, start, end) in base
    strict = sign(own, kind in ("email", "phone"))
    if kind == "card":
        check = sign(luhn(digits), True)
        form = sign(re.fullmatch(r"[0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}", span), True)
        listed = sign(digits[0] in _ISSUERS and 15 <= len(digits) <= 16, True)
    elif kind == "phone":
        check = sign(9 <= len(digits) <= 15, True)
        form = sign(re.search(r"[0-9]{3}[ .)-]+[0-9]{3}[ .-][0-9]{2,4}", span), False)
        listed = sign(span[0] == "+" and any(digits.startswith(c) for c in _CALLING), False)
    elif kind == "ip":
        check = sign("." in span or span.count(":") >= 5 or "::" in span, True)
        form = sign("." in span or len(span) >= 12, True)
        listed = sign(span.split(".")[0] not in ("0", "127", "255") and "." in span, False)
    else:
        tail = re.split(r"[^A-Za-z]+", span.lower())
        check = sign("@" in span, False)
        form = sign(re.search(r"[A-Za-z0-9]", span[:1]), True)
        listed = sign((tail[-1] or tail[-2] if len(tail) > 1 else tail[-1]) in _DOMAINS, True)
    before = [w.lower() for w in _WORD.findall(text[max(0, start - _NEAR) : start])][-4:]
    named = sign(any(w in _NAMING[kind] for w in before), False)
    other = sign(False, any(w in _OTHER_NUMBERS for w in before) or text[max(0, start - 2) : start].strip() in ("$", "€", "£"))
    beside = sign(base.near(start, end, _NEAR) > own, False)
    return strict + check + form + listed + named + other + beside


def shape(span: str) -> str:
    """Coarse form of a span; takes at most 7 * 8 * 16 values."""
    seps = (" " in span) + 2 * ("-" in span) + 4 * ("." in span) + 8 * ("(" in span or ":" in span)
    return f"{min(len(span) // 4, 6)}:{min(len(_DIGIT.findall(span)) // 3, 7)}:{seps}"


_CAND = "array<struct<kind:string,start:int,end:int,votes:string,shape:string>>"
_CAND_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.string()), ("shape", pa.string())])
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, candidates with their votes and shapes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, wide = [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                found = base_spans(text)
                index = SpanIndex(found)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                wide.append(
                    [
                        {"kind": k, "start": s, "end": e, "votes": votes(text, k, s, e, index), "shape": shape(text[s:e])}
                        for k, s, e in candidates(text, found)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(base, _SPANS), pa.array(wide, _CAND_ARROW)], ["id", "base", "candidates"]
            )

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)]).add("base", T._parse_datatype_string(SPANS))
    schema = schema.add("candidates", T._parse_datatype_string(_CAND))
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def em(patterns: dict[str, float], rounds: int = 60) -> tuple[dict[str, float], np.ndarray]:
    """Odds of each vote pattern, and each labeler's rates.

    ``rates[c, l, v]`` is how often labeler l votes v (for, against, none)
    on true (c = 1) or false candidates. Starts from the majority.
    """
    keys, weight = list(patterns), np.array(list(patterns.values()), float)
    onehot = np.array([[[x == v for v in "+-."] for x in k] for k in keys], float)
    lead = onehot[:, :, 0].sum(1) - onehot[:, :, 1].sum(1)
    odds = np.clip(0.5 + 0.15 * lead, 0.02, 0.98)
    for _ in range(rounds):
        both = np.stack([1 - odds, odds]) * weight
        rates = np.einsum("cn,nlv->clv", both, onehot) + 1.0
        # A labeler is taken to be better than chance: votes for are likelier if true.
        rates[1, :, 0] += 1.0
        rates[0, :, 1] += 1.0
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (both.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("nlv,clv->cn", onehot, np.log(rates))
        odds = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return dict(zip(keys, odds.tolist())), rates


def _features(kind: str, pattern: str, form: str) -> list[str]:
    n, d, seps = form.split(":")
    return [kind, *(f"{kind}{i}{v}" for i, v in enumerate(pattern)), f"{kind}n{n}", f"{kind}d{d}", f"{kind}s{seps}"]


def train(rows: list[tuple[str, str, str, int]], odds: dict[str, dict[str, float]], rounds: int = 300) -> dict[str, float]:
    """Logistic weights from (kind, votes, shape, count) and the EM's odds."""
    names = sorted({f for k, v, s, _ in rows for f in _features(k, v, s)})
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (k, v, s, _) in enumerate(rows):
        x[i, [at[f] for f in _features(k, v, s)]] = 1
    y = np.array([odds[k][v] for k, v, _, _ in rows])
    w = np.sqrt([n for *_, n in rows])
    w, beta, step = w / w.sum(), np.zeros(len(names)), 4.0
    for _ in range(rounds):
        beta -= step * (x.T @ (w * (1 / (1 + np.exp(-x @ beta)) - y)) + 1e-4 * beta)
    return dict(zip(names, beta.tolist()))


def learn(scanned: DataFrame, most: int = TRAIN) -> dict[str, float] | None:
    """Classifier weights; None without candidates."""
    each = scanned.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").alias("n"))
    each = materialize(each, "votes")
    counted = each.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()  # at most 4 * 3**7 rows
    if not counted:
        return None
    odds = {}
    for kind in {r.kind for r in counted}:
        odds[kind], _ = em({r.votes: r.n for r in counted if r.kind == kind})
    rows = each.orderBy(F.xxhash64("kind", "votes", "shape"), "kind", "votes", "shape").limit(most).collect()
    return train([tuple(r) for r in rows], odds)


def with_classifier(scanned: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """Rows (id, base, spans): base spans and the accepted candidates."""
    shared = scanned.sparkSession.sparkContext.broadcast(weights)  # one number per feature

    def accepted(kind: str, pattern: str, form: str) -> bool:
        total = sum(shared.value.get(f, 0.0) for f in _features(kind, pattern, form))
        return total > np.log(ACCEPT / (1 - ACCEPT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for base, wide in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                have = {(s["kind"], s["start"], s["end"]) for s in base}
                have |= {(c["kind"], c["start"], c["end"]) for c in wide if accepted(c["kind"], c["votes"], c["shape"])}
                out.append([dict(zip(("kind", "start", "end"), s)) for s in sorted(have, key=lambda s: (KINDS.index(s[0]), *s[1:]))])
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, _SPANS)], ["id", "base", "spans"])

    schema = T.StructType(scanned.schema.fields[:2]).add("spans", T._parse_datatype_string(SPANS))
    return scanned.mapInArrow(run, schema)


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, spans), one per row of ``df``; spans by kind, then start."""
    scanned = materialize(scan(df, id_col, text_col), "scanned")
    return with_classifier(scanned, learn(scanned))


def op4_weakly_supervised_pii(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count_of("base", k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
