import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF
from mercato.llm.hard_negatives import bit_planes, from_planes, mine, scores
from mercato.llm.oracle import ORACLE_SQL
from mercato.llm.queries import op12_hard_negatives


@pytest.fixture
def as_vectors(spark):
    def make(rows, kind="double"):
        return spark.createDataFrame([(i, v, label, "x", 7) for i, v, label in rows],
                                     f"vec_id long, embedding array<{kind}>, label int, score string, rank int")
    return make


def plain(rows, every=5, n_pos=5, n_neg=3):
    """All scores one by one, in Python integers."""
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        mine_ = (label, list(v))
        kept[i] = min(kept.get(i, mine_), mine_)
    ints = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in ints.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in ints.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if ints[i][0] == label][:n_pos]:
            hits = [i for i in order if ints[i][0] != label
                    and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:n_neg]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(hits)]
    return sorted(out)


def got(frame, **options):
    found = mine(frame, F.col("vec_id") % 5 == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                 "negative_score").collect())


def test_planes_and_scores_are_exact():
    rng = np.random.default_rng(1)
    for dims, low, high in ((1, -1, 1), (7, -300, 300), (64, -256, 257), (70, 0, 3), (9, -(1 << 27), 1 << 27),
                            (8, -5, 0), (3, 0, 1)):
        values, anchors = rng.integers(low, high, (300, dims)), rng.integers(low, high, (270, dims))
        assert (from_planes(bit_planes(values), dims) == values).all()
        assert (scores(anchors, bit_planes(values)) == values @ anchors.T).all()


@pytest.mark.parametrize("options", [{}, {"chunk": 20, "block": 3}, {"chunk": 50, "block": 7, "most_broadcast": 0}])
def test_equals_plain_version(spark, as_vectors, options):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).round(2).tolist(), int(rng.integers(4))) for i in range(200)]
    rows += [(200 + i, rows[i % 7][1], i % 4) for i in range(40)]  # equal vectors: ties
    assert got(as_vectors(rows), **options) == plain(rows)


def test_nulls_repeats_lengths_and_one_label_for_a_third(spark, as_vectors):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=int(rng.integers(1, 20))).round(3).tolist(), 1 if i % 3 == 0 else i) for i in range(120)]
    rows += [(None, [1.0], 1), (300, None, 1), (305, [1.0, None], 1), (310, [math.nan], 1), (315, [math.inf, 0.0], 2),
             (320, [1.0, 2.0], None), (325, [0.0] * 20, 1), (330, [], 1), (335, [-1.0] * 9, 1)]
    rows += [rows[5], rows[5], (10, [9.0] * 4, 0)]  # a repeated row, and two rows of one id
    assert got(as_vectors(rows)) == plain(rows)


def test_hot_vector(spark, as_vectors):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=6).tolist()
    rows = [(i, hot if i % 3 else rng.normal(size=6).tolist(), i % 2) for i in range(300)]
    rows += [(1000 + i, [x * 0.8 for x in hot], i % 2) for i in range(20)]
    assert got(as_vectors(rows), chunk=32, block=16) == plain(rows)


def test_empty_and_no_anchor(spark, as_vectors):
    assert got(as_vectors([(5, [1.0], 1)]).limit(0)) == []
    assert got(as_vectors([(1, [1.0], 1), (2, [1.0], 1)])) == []
    assert got(as_vectors([(5, [1.0], 1), (2, [1.0], 2)])) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    frame = op12_hard_negatives(spark, SF)
    want = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLE_SQL['op12_hard_negatives']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want)
    assert want
