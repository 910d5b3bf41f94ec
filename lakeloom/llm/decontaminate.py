"""Benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised to lower-cased words between single spaces. Every ten
consecutive words of a test item (or all of a shorter one) are a pattern; one
automaton over all of them scans each document once. A match is a run of
words, and its place in the original text is found from the words' places
there.

The patterns of a benchmark are broadcast in blocks of at most about
``BLOCK_BYTES``. A larger benchmark has several blocks, and documents pass
through one after the other; a row carries the runs and items found so far.

Edge cases: a null text or one of separators only has no words, as an item it
has no pattern; repeated rows are judged one by one, rows of one item id count
as one item; a null item id is shown as an empty string; an empty benchmark
hits nothing; only the id and text columns are read, so other columns may
have any name. A text is held as a whole in the task that scans it.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import discard, materialize

#: Words of a window.
WORDS = 10
#: Bytes of patterns that are broadcast at a time, about.
BLOCK_BYTES = 16 << 20

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
#: A-Z lower-cased and every separator made a space, byte by byte of UTF-8.
_FOLD = bytes(0x20 if c in _SEPARATORS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_RUNS = "array<struct<first:long,last:long>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(text: str | None, n: int = WORDS) -> set[bytes]:
    """The distinct patterns of one item, each between spaces."""
    w = words(text)
    return {b" %s " % b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def automaton(patterns: list[tuple[bytes, str]]) -> ahocorasick.Automaton | None:
    """From rows (pattern, item); a pattern's value is (its words, its items)."""
    items: dict[bytes, list[str]] = {}
    for pattern, item in patterns:
        items.setdefault(pattern, []).append(item)
    if not items:
        return None
    found = ahocorasick.Automaton()
    for pattern, own in items.items():
        found.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, own))
    found.make_automaton()
    return found


_kept: dict[str, ahocorasick.Automaton | None] = {}


def kept_automaton(key: str, patterns: list[tuple[bytes, str]]) -> ahocorasick.Automaton | None:
    """The automaton of a block, built once in a worker that runs several tasks; one block is kept."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = automaton(patterns)
    return _kept[key]


def scan(found: ahocorasick.Automaton | None, w: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs of hit words (first, last), in order, and the items that hit."""
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    if found is None or not w:
        return runs, items
    text = (b" %s " % b" ".join(w)).decode("latin-1")
    at = spaces = 0
    for end, (n, own) in found.iter(text):
        spaces += text.count(" ", at, end)  # in all, one pass over the text
        at = end
        runs.append((spaces - n, spaces - 1))
        items.update(own)
    return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjacent runs as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs as code points [start, end) of the original text."""
    starts, ends = [r[0] for r in runs], [r[1] for r in runs]
    at, to = [0] * len(runs), [0] * len(runs)
    for k, m in enumerate(_WORD.finditer(text)):
        i = bisect_left(ends, k)
        if i == len(runs):
            break
        if k == starts[i]:
            at[i] = m.start()
        if k == ends[i]:
            to[i] = m.end()
    return list(zip(at, to))


def benchmark_patterns(items: DataFrame, n: int = WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct rows (pattern, item) of a benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = list(windows(text, n))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([item] * len(own), pa.string())], ["pattern", "item"])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "pattern binary, item string").distinct()


def _scan_block(rows: DataFrame, block: list[tuple[bytes, str]]) -> DataFrame:
    """Rows (id, text, n_words, runs, items) with what one more block of patterns hits."""
    shared, key = rows.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex  # BLOCK_BYTES, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = kept_automaton(key, shared.value)
        for b in batches:
            cols: tuple[list, list, list] = ([], [], [])
            for text, runs, items in zip(*(b.column(k).to_pylist() for k in (1, 3, 4))):
                w = words(text)
                new, own = scan(found, w)
                if new and runs:
                    new = merged(new + [(r["first"], r["last"]) for r in runs])
                elif runs:
                    new = [(r["first"], r["last"]) for r in runs]
                for col, x in zip(cols, (len(w), [{"first": a, "last": z} for a, z in new], sorted(own.union(items)))):
                    col.append(x)
            own = [pa.array(x, b.schema.field(k).type) for k, x in enumerate(cols, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *own], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def hit_words(
    docs: DataFrame, items: DataFrame, n: int = WORDS, block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows (id, text, n_words, runs, items), one per row of ``docs``.

    ``runs`` are hit words (first, last) counted from 0, in order and apart;
    ``items`` the sorted ids of the items of which a window occurs.
    """
    patterns = materialize(benchmark_patterns(items, n, item_col, item_text_col), "patterns")
    size = patterns.agg(F.coalesce(F.sum(F.octet_length("pattern") + F.octet_length("item")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_RUNS).alias("runs"), F.array().cast("array<string>").alias("items"),
    )
    part = patterns.withColumn("block", F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)))
    for k in range(blocks):
        block = [(bytes(r.pattern), r.item) for r in part.filter(F.col("block") == k).select("pattern", "item").collect()]
        before, rows = rows, _scan_block(rows, block)
        if k < blocks - 1:
            rows = materialize(rows, "scanned")
            discard(before)
    return rows


def contaminated_spans(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Rows (id, n_words, n_hit, items, spans): ``spans`` are the hit stretches of the original text, in code points."""
    rows = hit_words(docs, items, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            out = []
            for text, runs in zip(b.column(1).to_pylist(), b.column(3).to_pylist()):
                places = spans(text or "", [(r["first"], r["last"]) for r in runs]) if runs else []
                out.append([{"start": s, "end": e} for s, e in places])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), b.column(4), pa.array(out, kind)], names)

    names = ["id", "n_words", "runs", "items", "spans"]
    schema = T.StructType([rows.schema[c] for c in names[:4]]).add("spans", T._parse_datatype_string("array<struct<start:long,end:long>>"))
    return rows.mapInArrow(run, schema).select("id", "n_words", _hit().alias("n_hit"), "items", "spans")


def _hit():
    return F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)


def op13_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    n_hit = _hit()
    return hit_words(docs, items).select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: Windows of items joined with windows of documents of the same length, by their words.
ORACLE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark WHERE len({_WORDS_SQL}) > 0),
    p AS (SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS win FROM
        (SELECT item, w, least(len(w), {WORDS}) AS size, unnest(range(1, greatest(len(w) - {WORDS} + 1, 1) + 1)) AS s FROM i)),
    dw AS (SELECT k, size, s, array_to_string(w[s:s + size - 1], ' ') AS win FROM
        (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size)),
    hits AS (SELECT dw.k, item, dw.size, dw.s FROM dw JOIN p ON dw.win = p.win AND dw.size = p.size),
    hit AS (SELECT k, count(DISTINCT x) AS n_hit FROM (SELECT k, unnest(range(s, s + size)) AS x FROM hits) GROUP BY k),
    own AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (k) LEFT JOIN own USING (k)"""
