import re

import numpy as np
import pyarrow as pa

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm import resampling as rs
from mercato.llm.common import text_bytes
from mercato.llm.queries import op1_importance_resampling

SF01 = "/root/testdata/sf0.1"


def test_ngrams_equal_a_plain_cut():
    texts = ["a b  b!! c", "", None, "a b", "é-ü\n\tx1 ...", "b!! c"]
    buckets, rows = rs.ngram_buckets(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+", (t or "").encode())
        assert (rows == i).sum() == max(0, 2 * len(tokens) - 1)
    own = lambda i: sorted(buckets[rows == i])
    assert set(own(3)) <= set(own(0)) and set(own(5)) <= set(own(0))


def test_held_out_labels_are_told_apart(spark):
    """Labels that neither the model nor the level has seen."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    split = labels.selectExpr("*", "xxhash64(doc_id, 99) % 2 = 0 AS seen")
    seen = split.filter("seen").drop("seen")
    kept = {r.doc_id for r in rs.resample_scores(docs, seen).collect()}
    rest = split.filter("NOT seen").collect()
    good = [r.doc_id in kept for r in rest if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id in kept for r in rest if r.quality == 0]
    print("good kept", np.mean(good), "bad kept", np.mean(bad))
    assert len(good) > 500 and np.mean(good) > 0.99
    assert len(bad) > 50 and np.mean(bad) < 0.3


def test_op1_held_out_short_bad_and_toxic_documents_are_dropped(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    split = labels.selectExpr("*", "xxhash64(doc_id, 99) % 2 = 0 AS seen")
    kept = {r.doc_id for r in rs.resample_scores(docs, split.filter("seen").drop("seen")).collect()}
    rest = (split.filter("NOT seen").join(docs, "doc_id").selectExpr(
        "doc_id", "quality", "toxic", "size(split(text, ' ')) AS words").collect())
    share = lambda own: np.mean([r.doc_id in kept for r in own])
    short = [r for r in rest if r.quality == 0 and r.words < 150]
    toxic = [r for r in rest if r.quality == 1 and r.toxic == 1]
    good = [r for r in rest if r.quality == 1 and r.toxic == 0]
    print("op1 kept: good", share(good), "bad", share([r for r in rest if r.quality == 0]), "short bad", share(short),
          len(short), "toxic of quality 1", share(toxic), len(toxic), "all", len(kept))
    assert len(short) > 20 and share(short) < 0.1
    assert len(toxic) > 100 and share(toxic) < 0.35  # a quarter of them holds no toxic word
    assert share(good) > 0.99


def test_kth_largest_and_layout(spark):
    rng = np.random.default_rng(2)
    keys = [int(k) for k in np.concatenate([rng.integers(-10**12, 10**12, 500), np.full(300, 7), [5, -(10**15)]])]
    df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    for k in (1, 2, 100, 250, 400, 600, len(keys)):
        assert rs.kth_largest(df, k) == sorted(keys, reverse=True)[k - 1]


def test_rows_scores_and_filter_agree(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a = sorted(r.doc_id for r in rs.resample_scores(docs, labels).collect())
    kept = rs.resample(docs.repartition(7), labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == a
    assert 0.5 * docs.count() < len(a) < docs.count()


def test_nulls_ties_blank_long_and_missing_labels(spark, as_docs):
    good = [(i, "the plain word of a good text and the next plain word " * 5) for i in range(60)]
    rows = good + [(None, None), (None, ""), (70, " \n"), (71, "!! ZZ !! QX " * 30_000), (5, good[5][1]), (5, good[5][1])]
    df = as_docs(rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(71, 0, 0), (None, 1, None), (70, None, None)],
                                   "doc_id long, quality int, toxic int")
    kept = rs.resample(df, labels)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 71 not in ids and sum(i == 5 for i in ids) == 3 and set(range(60)) <= set(ids)
    assert rs.resample(df, labels.limit(0)).count() == len(rows)
    assert rs.resample(df.limit(0), labels).count() == 0
    assert rs.resample_scores(df, labels.limit(0)).count() == len(rows)
