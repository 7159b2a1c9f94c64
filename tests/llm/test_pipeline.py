from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from mercato.llm import mixing
from mercato.llm.common import materialize, tokenizer_path
from mercato.llm.pii import base_spans

from test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF), f"test-stage-{i}")
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_and_columns(spark, outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "PII", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for df in outputs[:-1]:
        assert df.dtypes == documents.dtypes


def test_quality_keeps_the_good(spark, outputs):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    documents = dict(rows(spark.read.parquet(f"{SF}/documents.parquet")))
    kept = dict(rows(outputs[0]))
    assert all(documents[i] == t for i, t in kept.items())
    good = [i in kept for i in documents if i in labels and labels[i].quality == 1 and labels[i].toxic == 0]
    assert sum(good) >= 0.95 * len(good)  # test_resampling.py judges the bad ones, on a table large enough to learn from


def test_near_duplicates_leave_one_of_each_group(outputs):
    before = sorted(rows(outputs[0]))
    after = dict(rows(outputs[1]))
    components = [c for _, c in brute(before, 5, 80)]
    want = {i: t for (i, t), c, n in zip(before, components, brute(before, 5, 80), strict=True)
            if c == i or n[0] == 0}
    assert after == want


def test_personal_data_is_replaced_and_other_text_left(outputs):
    before, after = dict(rows(outputs[1])), {r.doc_id: r for r in outputs[2].collect()}
    assert set(before) == set(after)
    changed = 0
    for i, text in before.items():
        found = base_spans(text)
        changed += bool(found)
        assert not base_spans(after[i].text)
        assert after[i].n_chars == len(after[i].text)
        if not found and "[SECRET]" not in after[i].text:
            assert after[i].text == text
    assert changed


def test_mix_repeats_whole_documents_as_planned(outputs):
    before, after = outputs[2], outputs[3]
    plan = {r.doc_id: r.copies for r in mixing.mix(before).select("doc.doc_id", "copies").collect()}
    assert Counter(i for i, _ in rows(after)) == Counter({i: n for i, n in plan.items() if n})
    assert set(rows(after)) <= set(rows(before))


def test_ids_decode_to_the_mixed_texts(outputs):
    model = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = dict(rows(outputs[3]))
    encoded = outputs[4].collect()
    assert len(encoded) >= 2 * outputs[3].count() - outputs[3].filter("n_chars < 2").count()
    assert all(r.decodes for r in encoded)
    for r in encoded[:200]:
        assert model.decode(list(r.ids)) == texts[r.doc_id]


def test_run_gives_the_last_stage(spark, outputs):
    got = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "sample", "ids"]
    as_tuples = lambda df: sorted((r[0], r[1], tuple(r[2])) for r in df.select(columns).collect())
    assert as_tuples(got) == as_tuples(outputs[4])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_nulls_repeats_blank_and_long_texts_pass_all_stages(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    plain = "one text of plain words that nobody else has written down yet number"
    rows = [(None, None, None, None, None), (None, plain, None, None, None), (1, "", "en", "a", 0),
            (2, " \n\t", "en", "a", None), (3, "long words here " * 20_000, "en", "b", 1), (4, plain + " four", "en", None, 1),
            (4, plain + " four", "en", None, 1), (5, "mail me.at@host.example.org now", None, "b", 1), (5, None, "en", "c", 2)]
    docs = spark.createDataFrame(rows, schema)
    found = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF), f"test-edges-{i}")
        found.append(docs)
    near = [(r.doc_id, r.text) for r in found[1].collect()]
    assert near.count((4, plain + " four")) == 1 and (None, None) in near and (1, "") in near and (5, None) in near
    redacted = {(r.doc_id, r.text) for r in found[2].collect()}
    assert (5, "mail [EMAIL] now") in redacted and (None, None) in redacted
    assert all(r.decodes for r in found[4].collect())
