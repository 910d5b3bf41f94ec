import corpus_pipeline as c
from test_packing import check, library
from test_quality import slow_base
from test_secret_scan import slow_base as slow_secrets
from test_simhash import slow_components, slow_fingerprint

from lakeloom.llm.quality import assess
from lakeloom.llm.spans import replace
from lakeloom.llm.storage import materialize


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [f for _, f in c.STAGES] == [c.quality, c.near_dedup, c.mask_secrets, c.packed]
    one = c.quality(spark, docs, sf_dir)
    far = {r.row.doc_id for r in assess(docs).filter("not kept and not base_failed").collect()}
    want = [r for r in docs.collect() if not slow_base(r.text)[-1] and r.doc_id not in far]
    rows = sorted(one.collect())
    assert one.columns == docs.columns and rows == sorted(want)
    two = c.near_dedup(spark, one, sf_dir)
    groups = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in rows])
    keep = {i for i, _, least in groups if i == least}
    rows2 = sorted(two.collect())
    assert two.columns == docs.columns and rows2 == [r for r in rows if r.doc_id in keep]
    three = c.mask_secrets(spark, two, sf_dir)
    rows3 = sorted(three.collect())
    assert three.columns == docs.columns and len(rows3) == len(rows2)
    for a, b in zip(rows2, rows3):
        text = replace(a.text, slow_secrets(a.text))
        assert (b.doc_id, b.text, b.lang, b.source, b.n_chars) == (a.doc_id, text, a.lang, a.source, len(text) if text != a.text else b.n_chars)
    encode = library()
    check(c.packed(spark, three, sf_dir).collect(), {r.doc_id: encode(r.text) for r in rows3})


def test_run_equals_the_stages(spark, sf_dir):
    """The run's pieces hold exactly the tokens of the documents that the stages, called one by one, hand to packing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "test")
    encode, left = library(), docs.collect()
    assert 0 < len(left) < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = c.run(spark, sf_dir).collect()
    check(rows, {r.doc_id: encode(r.text) for r in left})
    last = c.STAGES[-1][1](spark, docs, sf_dir)
    assert last.columns == list(rows[0].asDict()) and last.agg({"length": "sum"}).first()[0] == sum(r.length for r in rows)


def test_stages_take_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_stages_take_columns_of_any_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "doc_id + 7 as `a.b`", "'x' as row", "1 as id")
    for _, stage in c.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "named")
        rows = docs.collect()
        assert docs.columns[-3:] == ["a.b", "row", "id"] and rows and all(r["a.b"] == r.doc_id + 7 and r.row == "x" and r.id == 1 for r in rows)
    assert {r.doc_id for r in c.packed(spark, docs, sf_dir).collect()} == {r.doc_id for r in rows}
