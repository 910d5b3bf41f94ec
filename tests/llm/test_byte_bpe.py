import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from lakeloom.llm import byte_bpe

ODD = [None, "", " ", "  a", "a  b", "x \n y", " lead", "tail ", "\n\n\n z", "it's 'll 42²½", "日本語 テスト", "<|endoftext|>",
       "a" * 60_000, "ab" * 5_000 + " é", " x  y", "\x1c \x85", "same", "same", "é 🇫🇷😀"]


def library():
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests_equal_the_library_on_documents(spark, sf_dir):
    lib, docs = library(), spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.op9_byte_bpe(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        ids = np.array(lib.encode_ordinary(r.text or ""), "<u4")
        sha = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (r.text or "").encode())]
        assert got[r.doc_id] == (len(ids), *sha)


def test_odd_texts_round_trip(spark):
    lib = library()
    df = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = byte_bpe.decode(byte_bpe.encode(df.selectExpr("*", "1 as ids", "2 as id"))).collect()
    assert len(rows) == len(ODD)
    for r, t in zip(sorted(rows, key=lambda r: 3 if r.id is None else r.id), ODD):
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode_ordinary(t or "") and bytes(r.text).decode() == (t or "")
    both = byte_bpe.round_trip(df.selectExpr("*", "1 as ids", "2 as id"))
    assert sorted(map(str, both.collect())) == sorted(map(str, rows)) and byte_bpe.round_trip(df.limit(0)).count() == 0
    assert byte_bpe.encode(df.limit(0)).count() == 0


def test_word_by_word_merging_equals_the_sweep():
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        bpe = byte_bpe.ByteBpe(f.read())
    words = [bytes(np.random.default_rng(k).integers(97, 103, 1 + k % 40, dtype=np.uint8)) for k in range(400)]
    raw, lens = byte_bpe.join_lens(words)
    ids, counts = bpe.merges.replay(bpe.byte[raw], lens)
    one = [bpe.merges.one(bpe.byte[list(w)].tolist()) for w in words]
    assert ids.tolist() == [i for w in one for i in w] and counts.tolist() == list(map(len, one))


def test_hot_words_are_those_of_the_corpus_and_change_no_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text or "" for r in docs.select("text").collect()]
    seen = Counter(w for t in texts for w in t.split(" ")[1:])
    assert {r.word: r.n for r in byte_bpe.count_words(docs).collect()} == seen
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    words, ids, lens = byte_bpe.hot_words(docs, shared, most=50)
    plain = {w: n for w, n in seen.items() if w and w == w.strip() and n > 1}
    least = min(plain[w] for w in words.to_pylist())
    assert 20 < len(words) <= 50 and set(words.to_pylist()) == {w for w, n in plain.items() if n >= least}
    lib = library()
    assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == [lib.encode_ordinary(" " + w) for w in words.to_pylist()]
    few, none = (sorted(map(tuple, byte_bpe.encode(docs, hot=n).collect())) for n in (50, 0))
    assert few == none == sorted(map(tuple, byte_bpe.encode(docs).collect()))


def test_forgetting_keeps_the_hot_words(monkeypatch):
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        data = f.read()
    lib, bpe = library(), byte_bpe.ByteBpe(data)
    words = ["the", "of", "straße"]
    ids, lens = bpe.encode_pieces(words)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    bpe = byte_bpe.ByteBpe(data, (pa.array(words), ids, lens))
    for k in range(6):
        texts = [f"a the {k} of w{j} straße the" for j in range(k + 1)]
        assert [x.tolist() for x in bpe.encode_block(texts)] == [lib.encode_ordinary(t) for t in texts]


def test_long_repeated_words_are_neither_hot_nor_remembered(spark, monkeypatch):
    lib, long = library(), [base64.b64encode(np.random.default_rng(k).bytes(75_000)).decode() for k in range(6)]
    texts = [f"an image {w} and the text" for w in long * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        data = f.read()
    words = byte_bpe.hot_words(docs, spark.sparkContext.broadcast(data))[0].to_pylist()
    assert "image" in words and max(map(len, words)) <= byte_bpe.HOT_BYTES
    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 1_000_000)
    bpe = byte_bpe.ByteBpe(data)
    for t in texts:
        assert bpe.encode_block([t])[0].tolist() == lib.encode_ordinary(t)
        assert bpe.words.size + bpe.pieces.size + bpe.heads.size < 3_000_000
