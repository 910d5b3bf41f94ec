"""Cost-balanced packing of tokenized documents into fixed-length sequences.

Attention costs a sequence ``LINEAR * n + QUADRATIC * n**2`` for each piece of
n tokens (pieces do not attend to each other). Within a block of about
``BLOCK_TOKENS`` tokens, documents are taken in descending cost and each goes
to the sequence of lowest cost so far that still has room for it; one that
fits nowhere is cut over the cheapest sequences with room. Documents longer
than a sequence are first cut into full ones. A block's sequences have
``SEQUENCE`` places each, and its last tokens fill sequences of descending
powers of two, which need no padding, so no place is padded.

Blocks are runs of documents within a partition: nothing is shuffled, a
task's memory is bounded by one block, and a lost task packs its blocks alike.
``sequence_id`` holds the partition in its high and the number in its low
bits.

The tokenizer lower-cases and drops white space, so a text's ids are those of
its distinct pieces between white space; these are encoded once per block by
merge replay, and those with characters beyond U+00FF are prepared by the
tokenizer's own normalizer and splitter. As the library does, a text is cut at
the strings of the file's special tokens first, which become one id each.

Edge cases: null and empty texts are the end token alone; ties go by order;
repeated rows are packed each; null ids are kept; an empty table gives an
empty table; only the id and text columns are read, so other columns may have
any name. A piece's ids are those of its document from ``start`` on.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .byte_bpe import blocks
from .merge_replay import Lexicon, Merges, join_lens

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SEQUENCE = 4096
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Tokens packed together; about 500 sequences.
BLOCK_TOKENS = 2 << 20
#: Distinct pieces, and distinct words, that a task remembers between blocks.
REMEMBERED = 300_000
#: Their bytes.
REMEMBERED_BYTES = 64 << 20
#: Bytes of text that are encoded at once.
BLOCK_BYTES = 8 << 20


class WordBpe:
    """The ids of a tokenizer file whose words are split at white space."""

    def __init__(self, data: str):
        file = json.loads(data)
        model = file["model"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        own = Tokenizer.from_str(data)
        self.normalize, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        a, b, new = (np.array(x, np.int64) for x in zip(*((vocab[x], vocab[y], vocab[x + y]) for x, y in pairs)))
        self.merges = Merges(a, b, np.arange(len(a)), new, max(vocab.values()) + 1)
        # Byte-level vocabularies spell printable bytes as themselves, others from U+0100 on.
        plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255]
        spelled = {x: chr(x) for x in plain}
        spelled |= {x: chr(256 + k) for k, x in enumerate(x for x in range(256) if x not in spelled)}
        self.byte = {c: x for x, c in spelled.items()}
        self.inner = np.array([vocab[spelled[x]] for x in range(256)], np.int32)
        self.last = np.array([vocab[spelled[x] + suffix] for x in range(256)], np.int32)
        # The tokenizer's own pattern over the characters up to U+00FF, all of which its normalizer only lower-cases.
        letter, number, blank = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", " \t-\r\x85\xa0"
        self.latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{blank}{letter}{number}]+").findall
        self._forget()

    def _forget(self) -> None:
        self.words = Lexicon(self._encode_words)
        self.pieces = Lexicon(self._encode_pieces)

    def _encode_words(self, words: list[bytes | str]) -> tuple[np.ndarray, np.ndarray]:
        whole = {k: self.special[w] for k, w in enumerate(words) if isinstance(w, str)}
        raw, lens = join_lens([b"\0" if k in whole else w for k, w in enumerate(words)] if whole else words)
        ids, ends = self.inner[raw], np.cumsum(lens) - 1
        ids[ends] = self.last[raw[ends]]
        ids[[ends[k] for k in whole]] = list(whole.values())  # the id of a special token is part of no merge
        return self.merges.replay(ids, lens)

    def _words(self, piece: str) -> list[bytes]:
        if piece.isascii() or max(piece) <= "\xff":
            return [w.encode() for w in self.latin(piece.lower())]
        return [bytes(map(self.byte.__getitem__, w)) for w, _ in self.split(self.normalize(piece))]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [[x] if x in self.special else self._words(x) for x in pieces]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        code = self.words.__getitem__
        codes = np.fromiter((code(w) for ws in words for w in ws), np.int64, counts.sum())
        self.words.settle()
        ids, lens = self.words.of(codes)
        return ids, np.diff(np.append(0, np.cumsum(lens))[np.append(0, np.cumsum(counts))])

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, end to end, and how many each has."""
        if max(len(self.words), len(self.pieces)) > REMEMBERED or self.words.size + self.pieces.size > REMEMBERED_BYTES:
            self._forget()
        texts = texts.fill_null("")
        if self.specials and pc.any(pc.match_substring_regex(texts, self.specials.pattern)).as_py():
            # White space parts words and is dropped, so a special token between blanks is a piece of its own.
            texts = pa.array([self.specials.sub(r" \g<0> ", t) for t in texts.to_pylist()], texts.type)
        cut = pc.ascii_split_whitespace(texts)
        flat = cut.flatten().dictionary_encode()
        code = self.pieces.__getitem__
        known = np.fromiter(map(code, flat.dictionary.to_pylist()), np.int64, len(flat.dictionary))
        self.pieces.settle()
        ids, lens = self.pieces.of(known[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64))
        return ids, np.diff(np.append(0, np.cumsum(lens))[np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))])


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def room(total: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Sequence lengths that hold ``total`` tokens without any padding."""
    tail = [1 << k for k in range(sequence.bit_length() - 1, -1, -1) if total % sequence >> k & 1]
    return np.array([sequence] * (total // sequence) + tail, np.int64)


def pack(lens: np.ndarray, sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a block.

    ``lens`` are the documents' token counts. Every token lies in one piece.
    """
    full = [(d, k) for d, n in enumerate(lens.tolist()) for k in range(n // sequence)]
    pieces = [(d, k * sequence, sequence, s, 0) for s, (d, k) in enumerate(full)]
    rest = lens % sequence
    left = room(int(rest.sum()), sequence)
    spent, used = np.zeros(len(left)), np.zeros(len(left), np.int64)
    for d in np.argsort(-rest, kind="stable").tolist():
        n, start = int(rest[d]), int(lens[d] - rest[d])
        while n:
            fits = np.flatnonzero(left >= n)
            open_ = fits if len(fits) else np.flatnonzero(left)
            s = int(open_[spent[open_].argmin()])
            take = min(n, int(left[s]))
            pieces.append((d, start, take, len(full) + s, int(used[s])))
            left[s] -= take
            used[s] += take
            spent[s] += cost(take)
            n, start = n - take, start + take
    return pieces


def pack_documents(
    df: DataFrame,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are the piece's token ids as little-endian 32-bit words.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, under 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(shared.value)
        first = TaskContext.get().partitionId() << 36
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal first
            keys = pa.concat_arrays([k for k, *_ in held])
            tokens = np.concatenate([t for _, t, _ in held]).astype("<u4")
            lens = np.concatenate([n for *_, n in held])
            held.clear()
            d, start, length, seq, offset = np.array(pack(lens, sequence), np.int64).reshape(-1, 5).T
            at = (np.cumsum(lens) - lens)[d] + start
            raw = memoryview(tokens.tobytes())
            ids = pa.array([bytes(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())], pa.binary())
            cols = [keys.take(pa.array(d)), start, length, ids, lens[d], first + seq, offset]
            first += int(seq.max()) + 1
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)

        for batch in batches:
            for b in blocks(batch, BLOCK_BYTES):
                ids, lens = bpe.encode_block(b.column(1))
                ends = np.cumsum(lens)
                ids = np.insert(ids, ends, END_ID)
                held.append((b.column(0), ids, lens + 1))
                if sum(len(t) for _, t, _ in held) >= block_tokens:
                    yield flush()
        if held:
            yield flush()

    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)])
    for name in names[1:]:
        schema = schema.add(name, "binary" if name == "ids" else "long")
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_cost_balanced_packing(spark, sf_dir: str) -> DataFrame:
    return digests(pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")))
