import math

import numpy as np
import pytest

from mercato.llm import cross_polytope as cp
from mercato.llm.queries import op2_cross_polytope
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def exact(ids, x, queries, k=20):
    out = {}
    for q in queries:
        scores = (x * x[ids.index(q)]).sum(axis=1)
        order = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)
        out[q] = [(i, -s) for s, i in order[:k]]
    return out


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(20, 50))
    y = cp.rotate(x, 3)
    assert y.shape == (20, 64) and np.allclose(x @ x.T, y @ y.T)
    axes = cp.nearest_axes(x, 3)[:, 0]
    assert (np.abs(y).argmax(1) == axes // 2).all()
    assert (axes[:, None] == cp.nearest_axes(x, 3, probes=5)).any(1).all()


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = exact(ids, x, [i for i in ids if i % 20 == 0])
    got = {}
    for r in op2_cross_polytope(spark, SF).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    hits = []
    for q, places in got.items():
        mine = [places[i] for i in range(1, 21)]
        assert mine == sorted(mine, key=lambda h: (-h[1], h[0])) and all(i != q for i, _ in mine)
        for i, s in mine[:3]:
            assert s == pytest.approx(math.fsum(x[ids.index(q)] * x[ids.index(i)]), abs=1e-12)
        hits.append(len({i for i, _ in mine} & {i for i, _ in want[q]}) / 20)
    assert np.mean(hits) >= 0.9


def test_copies_ties_lengths_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(cp, "CHUNK", 50)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 10)) * np.exp(rng.normal(size=(300, 1)))
    x[100:200] = x[0]  # a third of all rows are one vector
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)]
    bad = [(1000, None), (1020, []), (1040, [0.0] * 10), (1060, [1.0] * 9 + [None]), (1080, [float("nan")] * 10),
           (1100, [float("inf")] * 10), (None, rows[0][1]), (1120, [1.0, 2.0])]
    df = spark.createDataFrame(rows + rows[:40] + bad, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("clash"))
    got = {}
    for r in cp.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(list(range(300)), x, range(0, 300, 20))
    assert set(got) == set(want)
    hits = 0
    for q, w in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        hits += len({m[1] for m in mine} & {i for i, _ in w})
    assert hits >= 0.9 * 20 * len(want)
    assert [m[1] for m in sorted(got[100])] == [i for i, _ in want[100]]


def test_few_rows_return_all_and_empty_table(spark):
    x = np.random.default_rng(2).normal(size=(8, 3))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(8)], "vec_id long, embedding array<float>")
    got = cp.nearest(df, F.col("vec_id") < 2).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(q, i) for q in (0, 1) for i in range(8) if i != q}
    assert cp.nearest(df.limit(0), F.lit(True)).count() == 0


def test_a_bucket_that_a_third_of_all_queries_visit_is_cut_on_both_sides(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[:300] = np.eye(8)[0] * 5 + rng.normal(size=(300, 8)) * 0.05  # one direction: one bucket in every table
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(900)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, cp.nearest(df, F.col("vec_id") < 450).collect()))
    monkeypatch.setattr(cp, "CHUNK", 64)
    monkeypatch.setattr(cp, "QUERY_BLOCK", 32)
    assert sorted(map(tuple, cp.nearest(df, F.col("vec_id") < 450).collect())) == whole
    assert len(whole) == 450 * 20
