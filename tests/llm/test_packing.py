import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from lakeloom.llm import packing
from tokenizers import Tokenizer

ODD = [None, "", " \n ", "İstanbul ΣΑΣ ΟΔΟΣ ﬁ ½²", "a b c\x1cd\x85e", "<|endoftext|> x", "I'LL don't'S 's", "日本語 한국어",
       "é ́a", "w" * 3000 + "1" * 50, "😀 🇫🇷", "dup", "dup", "many words " * 9000]


def library():
    lib = Tokenizer.from_file(P.path(packing.VOCABULARY))
    return lambda t: [*lib.encode(t or "", add_special_tokens=False).ids, packing.END_ID]


def check(rows, ids):
    """Pieces cover their documents once, sequences are gapless and need no padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = np.array(ids[d][r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids[d])) and r.length > 0
            at += r.length
        assert at == len(ids[d])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


def test_documents(spark, sf_dir):
    encode = library()
    ids = {r.doc_id: encode(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(packing.op3_cost_balanced_packing(spark, sf_dir).collect(), ids)


def test_odd_texts(spark):
    encode = library()
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").selectExpr("*", "1 as start", "2 as ids")
    check(packing.digests(packing.pack_documents(df, block_tokens=100)).collect(), {i: encode(t) for i, t in enumerate(ODD)})
    assert packing.pack_documents(df.limit(0)).count() == 0
    nameless = packing.pack_documents(df.selectExpr("cast(null as long) as doc_id", "text"))
    assert {r.id for r in nameless.collect()} == {None}


def test_every_character_up_to_ff_is_split_as_the_library_does():
    with open(P.path(packing.VOCABULARY), encoding="utf-8") as f:
        bpe = packing.WordBpe(f.read())
    encode = library()
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}É '{chr(c)}" for c in range(1, 256)]
    ids, lens = bpe.encode_block(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == [encode(t)[:-1] for t in texts]


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lens = np.minimum(rng.lognormal(6, 1, 4000).astype(np.int64) + 1, 20_000)
    spent, whole = {}, {}
    for d, _, n, s, _ in packing.pack(lens):
        spent[s] = spent.get(s, 0) + packing.cost(n)
        whole.setdefault(d, []).append(n)
    assert sum(len(p) > -(-lens[d] // 4096) for d, p in whole.items()) < 0.1 * len(lens)
    full = np.array([c for s, c in spent.items()])
    assert np.std(full) / full.mean() < 0.5
    assert packing.room(3 * 4096 + 100).tolist() == [4096] * 3 + [64, 32, 4]
