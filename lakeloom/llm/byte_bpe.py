"""Byte-level BPE encoding and decoding by merge replay over the corpus' words.

The words of all documents are counted in one pass. The most frequent ones of
the corpus, at most ``HOT``, are dealt out as a table, and every task replays the merges
over its share of it at once, in rank order, from an inverted index of pairs
to word positions (see ``merge_replay``); their ids, a bounded table, are sent
to the tasks that encode the documents. Words beyond it are collected from a
block of documents and replayed there in the same way: to join their ids back
would shuffle every word occurrence. Such words keep their ids within a task,
up to a bound. Special tokens are ordinary text.

A space takes part in no match but the one that it opens, unless it touches
other white space. So a text is cut at spaces first, and the pattern only
runs on distinct pieces; texts where white space touches a space run whole.

Edge cases: null and empty texts have no ids; long texts are whole; repeated
rows each get their row; null ids are kept as they are; an empty table gives
an empty table; only the id and text columns are read, so other columns may
have any name.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge_replay import Lexicon, Merges, join_lens
from .storage import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Most words of the corpus that are replayed once for all tasks.
HOT = 32_768
#: Bytes of the longest of them; longer words are replayed in the blocks that hold them.
HOT_BYTES = 256
#: Bins that a doubling of a word's count takes.
_BINS = 16
#: Distinct other words, and distinct matches, that a task remembers between blocks.
REMEMBERED = 100_000
#: Their bytes.
REMEMBERED_BYTES = 32 << 20
#: Bytes of text after which a block ends.
BLOCK_BYTES = 2 << 20


def _blank(word: str) -> bool:
    return not word or word[0].isspace() or word[-1].isspace()


@lru_cache(maxsize=1)
def _tables(data: bytes) -> tuple[dict[bytes, int], Merges, np.ndarray]:
    """Ranks, merges and the ids of single bytes of a rank file; a worker keeps them between tasks."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
    get = ranks.get
    pairs = (
        x
        for t, r in ranks.items()
        for k in range(1, len(t))
        if (a := get(t[:k])) is not None and (b := get(t[k:])) is not None
        for x in (a, b, r)
    )
    a, b, r = np.fromiter(pairs, np.int64).reshape(-1, 3).T
    size = max(ranks.values()) + 1
    return ranks, Merges(a, b, r, np.arange(size), size), np.array([ranks[bytes([x])] for x in range(256)], np.int32)


class ByteBpe:
    """Encoder from the bytes of a rank file, and the ids of hot words if there are any."""

    def __init__(self, data: bytes, hot: tuple[pa.Array, np.ndarray, np.ndarray] | None = None, pattern: str = public_tokenizers.PATTERN):
        self.ranks, self.merges, self.byte = _tables(data)
        self.matches = regex.compile(pattern).findall
        self.hot = hot and (hot[0].to_pylist(), *hot[1:])
        self._forget()

    def _forget(self) -> None:
        self.words = Lexicon(self._encode_words)
        self.heads = Lexicon(self._encode_texts)
        self.pieces = Lexicon(self.encode_pieces)
        if self.hot:
            self.pieces.seed(*self.hot)
        # Which words open or end with white space, and which heads end with it.
        self.touching = np.array([_blank(x) for x in self.pieces], bool)
        self.ends_blank = np.zeros(0, bool)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, end to end, and counts of words that stand behind a space each."""
        return self._encode_texts([" " + x for x in pieces])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [w.encode() for w in words]
        raw, lens = join_lens(data)
        ids, counts = self.merges.replay(self.byte[raw], lens)
        whole = np.array([self.ranks.get(w, -1) for w in data], np.int32)
        odd = np.flatnonzero((whole >= 0) & (counts != 1))
        if len(odd):  # a match that is a token stays whole, though no merges lead to it
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in odd.tolist():
                parts[w], counts[w] = whole[w : w + 1], 1
            ids = np.concatenate(parts)
        return ids, counts

    def _encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        matches = [self.matches(t) for t in texts]
        code = self.words.__getitem__
        counts = np.fromiter(map(len, matches), np.int64, len(matches))
        codes = np.fromiter((code(w) for m in matches for w in m), np.int64, counts.sum())
        self.words.settle()
        ids, lens = self.words.of(codes)
        ends = np.append(0, np.cumsum(lens))[np.append(0, np.cumsum(counts))]
        return ids, np.diff(ends)

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        own = len(self.pieces) - (len(self.hot[0]) if self.hot else 0)
        size = self.words.size + self.pieces.size + self.heads.size
        if max(len(self.words), own, len(self.heads)) > REMEMBERED or size > REMEMBERED_BYTES:
            self._forget()
        code = self.pieces.__getitem__
        cut, heads = [], []
        for text in texts:
            head, *rest = text.split(" ")
            heads.append(self.heads[head])
            cut.append(np.fromiter(map(code, rest), np.int64, len(rest)))
        self.touching = np.append(self.touching, [_blank(x) for x in self.pieces.fresh]).astype(bool)
        self.ends_blank = np.append(self.ends_blank, [not x or x[-1].isspace() for x in self.heads.fresh]).astype(bool)
        self.heads.settle()
        self.pieces.settle()
        out = []
        for text, head, codes in zip(texts, heads, cut):
            if len(codes) and (self.ends_blank[head] or self.touching[codes].any()):
                out.append(self._encode_texts([text])[0])
            else:
                first = self.heads.of(np.array([head]))[0]
                out.append(np.concatenate([first, self.pieces.of(codes)[0]]))
        return out


def blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose second column holds about ``limit`` bytes."""
    sizes = np.array(pc.binary_length(batch.column(1)).fill_null(0)).cumsum()
    start = 0
    while start < len(sizes):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + limit)) + 1
        yield batch.slice(start, min(end, len(sizes)) - start)
        start = end


def count_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (word, n): how often each word stands behind a space, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch):
                cut = pc.list_slice(pc.split_pattern(b.column(1).drop_null(), " "), 1)
                seen = pc.value_counts(cut.flatten())
                yield pa.RecordBatch.from_arrays([seen.field("values").cast(pa.string()), seen.field("counts")], ["word", "n"])

    each = df.select(F.lit(0).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(df: DataFrame, shared: Broadcast[bytes], text_col: str = "text", most: int = HOT) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Frequent words of the corpus, their ids end to end, and how many each has.

    They are those found at least so often that there are no more than
    ``most``, by bins of counts; words found once, and words of more than
    ``HOT_BYTES``, are never among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for b in batches:
            bpe = bpe or ByteBpe(shared.value)
            ids, lens = bpe.encode_pieces(b.column(0).to_pylist())
            parts = np.split(ids.astype("<u4"), np.cumsum(lens)[:-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in parts], pa.binary())], ["word", "ids"])

    # Words that open or end with white space meet other rules; texts that hold one are encoded whole.
    plain = F.col("word").rlike(r"^\S(?s:.*\S)?$") & ~F.col("word").rlike(r"^\p{Z}|\p{Z}$")
    counts = count_words(df, text_col).filter((F.col("n") > 1) & (F.octet_length("word") <= HOT_BYTES) & plain)
    counts = materialize(counts.select("word", F.floor(F.log2("n") * _BINS).cast("int").alias("bin")), "words")
    cut, room = None, most
    for r in sorted(counts.groupBy("bin").agg(F.count("*").alias("n")).collect(), reverse=True):  # at most 64 * _BINS
        room -= r.n
        if room < 0:
            break
        cut = r.bin
    top = counts.filter(F.col("bin") >= cut if cut is not None else F.lit(False)).repartition(16)
    table = top.select("word").mapInArrow(run, "word string, ids binary").toArrow()  # at most ``most`` rows
    raw = b"".join(table.column("ids").to_pylist())
    lens = np.array(pc.binary_length(table.column("ids")), np.int64) // 4
    return table.column("word").combine_chunks(), np.frombuffer(raw, "<u4").astype(np.int32), lens


_Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(df: DataFrame, vocabulary: str | None, text_col: str, hot: int) -> _Run:
    """(id, text) batches to (id, ids) batches; counts the words of ``df`` first."""
    sc = df.sparkSession.sparkContext
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        shared = sc.broadcast(f.read())  # a vocabulary file, under 1 MB
    known = sc.broadcast(hot_words(df, shared, text_col, hot) if hot else None)  # ``hot`` words and ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(shared.value, known.value)
        for batch in batches:
            for b in blocks(batch):
                ids = bpe.encode_block([t or "" for t in b.column(1).to_pylist()])
                packed = pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), packed], ["id", "ids"])

    return run


def _decoder(df: DataFrame, vocabulary: str | None) -> _Run:
    """(id, ids) batches to (id, ids, text) batches."""
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line.split() for line in shared.value.splitlines() if line)
        token = {int(b): base64.b64decode(a) for a, b in lines}.__getitem__
        for b in batches:
            texts = [b"".join(map(token, np.frombuffer(x.as_buffer(), "<u4").tolist())) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(texts, pa.binary())], ["id", "ids", "text"])

    return run


def _picked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def _schema(df: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("ids", T.BinaryType())])


def encode(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Rows (id, ids): each text's token ids as little-endian 32-bit words.

    Counts the words of ``df`` first; ``hot`` bounds the table of frequent
    words that tasks are given, and 0 counts nothing.
    """
    return _picked(df, id_col, text_col).mapInArrow(_encoder(df, vocabulary, text_col, hot), _schema(df, id_col))


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Rows (id, ids, text): the bytes that each row's ids stand for."""
    schema = T.StructType(encoded.schema.fields).add("text", T.BinaryType())
    return encoded.select("id", "ids").mapInArrow(_decoder(encoded, vocabulary), schema)


def round_trip(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``decode(encode(df))`` in one worker a task instead of two."""
    to_ids, to_text = _encoder(df, vocabulary, text_col, hot), _decoder(df, vocabulary)
    schema = _schema(df, id_col).add("text", T.BinaryType())
    return _picked(df, id_col, text_col).mapInArrow(lambda batches: to_text(to_ids(batches)), schema)


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs).select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids").cast("long") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
