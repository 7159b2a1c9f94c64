import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm.common import uniform
from mercato.llm.mixing import SEED, SIZE_POWER, WEIGHTS, mix, repeated
from mercato.llm.queries import op10_source_mix

SF = "/root/testdata/sf0.001"


def targets_by_hand(sizes):
    """sizes: source -> words.  Reshare the excess by weight until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= above


def check(rows, words_of):
    sizes = {}
    for i, t, s in words_of:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
    want = targets_by_hand(sizes)
    for s in sizes:
        mine = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == sizes[s] for r in mine)
        assert all(r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for r in mine)
        assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in mine)
        biggest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= max(1, biggest / 2)


def test_targets_sizes_and_closeness(spark, docs):
    rows = [r.asDict() for r in mix(docs).select("doc.doc_id", "size", "source", "source_size", "target", "copies",
                                                 "taken").collect()]
    check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_same_result_whatever_the_layout(spark, docs):
    a = sorted(map(tuple, mix(docs).select("doc.doc_id", "copies").collect()))
    b = sorted(map(tuple, mix(docs.repartition(13, "n_chars")).select("doc.doc_id", "copies").collect()))
    assert a == b
    assert len(a) == op10_source_mix(spark, SF).count()


def test_capped_sources_nulls_blank_and_clashes(spark, as_docs):
    rows = [(i, "w " * 10, "big") for i in range(200)] + [(1000, "w " * 3, "a"), (1001, None, "a"), (None, " \t", None),
            (None, "x", None), (None, "x", None), (1002, "", "zero"), (1003, "y " * 5000, "big")]
    got = mix(as_docs(rows))
    data = [r.asDict() for r in got.select("size", "source", "source_size", "target", "copies", "taken").collect()]
    assert len(data) == len(rows)
    check(data, rows)
    out = repeated(got)
    assert out.columns == as_docs(rows).columns
    assert out.count() == sum(r["copies"] for r in data)


def test_empty_table(spark, as_docs):
    assert mix(as_docs([(1, "a")]).limit(0)).count() == 0


def probabilities(sizes, room):
    """Inclusion probabilities of a source's documents: certain ones are taken out until none passes 1."""
    weight = np.round(np.power(np.array(sizes, float), SIZE_POWER) * 1e6)
    certain = np.zeros(len(sizes), bool)
    sizes = np.array(sizes)
    while True:
        left = room - sizes[certain].sum()
        mass = float((sizes * weight)[~certain].sum())
        p = np.where(certain, 1.0, weight * (left / mass if mass and left > 0 else 0.0))
        over = (p >= 1) & ~certain
        if not over.any():
            return p
        certain |= over


def selected(sizes, p, u, room):
    """Pareto order: by random odds over inclusion odds while words are left, then the one document that fits best."""
    q = [0.0 if x >= 1 else v / (1 - v) * (1 - x) / x if x > 0 else np.inf for x, v in zip(p, u)]
    taken, words = set(), 0
    for i in sorted((i for i in range(len(q)) if p[i] > 0), key=lambda i: q[i]):
        if words + sizes[i] > room:
            break
        taken.add(i)
        words += sizes[i]
    missing = room - words
    rest = [i for i in range(len(q)) if i not in taken and abs(sizes[i] - missing) < missing]
    if rest:
        taken.add(min(rest, key=lambda i: (abs(sizes[i] - missing), q[i])))
    return taken


def sources(seed):
    rng = random.Random(seed)
    rows = []
    for k, (name, n) in enumerate((("a", 40), ("b", 150), ("c", 25), (None, 60))):
        rows += [(1000 * k + i, " ".join([f"{name}{i}"] * rng.choice([0, 1, 3, rng.randrange(1, 60), 200])), name)
                 for i in range(n)]
    return rows


@pytest.mark.parametrize("seed", [SEED, 1, 2])
def test_selection_equals_the_plain_version(spark, as_docs, seed):
    frame = as_docs(sources(seed))
    rows = [r.asDict() for r in mix(frame, seed=seed).select(
        "doc.doc_id", "size", "source", "source_size", "target", "copies", "expected_copies").collect()]
    hashed = frame.withColumn("h", F.xxhash64(F.lit(seed), "text")).withColumn("u", uniform(seed, "doc_id", "h"))
    u = {r.doc_id: r.u for r in hashed.collect()}
    several = 0
    for name in ("a", "b", "c", None):
        own = [r for r in rows if r["source"] == name]
        whole = int(own[0]["target"] // own[0]["source_size"])
        room = own[0]["target"] - whole * own[0]["source_size"]
        sizes = [r["size"] for r in own]
        p = probabilities(sizes, room)
        assert [r["expected_copies"] for r in own] == pytest.approx(list(whole + p), abs=1e-9)
        taken = selected(sizes, p, [u[r["doc_id"]] for r in own], room)
        assert [r["copies"] for r in own] == [whole + (i in taken) for i in range(len(own))]
        assert np.dot(p, sizes) == pytest.approx(room, rel=1e-9, abs=1e-6)
        several += len(set(np.round(p, 6))) > 3
    assert several >= 2


def test_inclusion_rates_over_many_seeds():
    """How often the plain version (equal to the operator's, see above) takes each document."""
    rng = np.random.default_rng(8)
    sizes = [int(x) for x in rng.integers(1, 80, 120)] + [900]
    room = 2200.0
    p = probabilities(sizes, room)
    runs = 4000
    rate = np.zeros(len(sizes))
    for _ in range(runs):
        for i in selected(sizes, p, rng.random(len(sizes)), room):
            rate[i] += 1 / runs
    assert p[-1] == 1 and rate[-1] == pytest.approx(1)
    assert np.abs(rate - p).max() < 0.06  # sampling error 0.024 and the document that fills the end
    assert np.corrcoef(rate, p)[0, 1] > 0.97
    small, large = np.array(sizes[:-1]) < 15, np.array(sizes[:-1]) > 60
    assert rate[:-1][large].mean() > 1.8 * rate[:-1][small].mean()


def test_no_cut_range_holds_the_certain_documents(spark, as_docs):
    """One huge document among small ones of a hot source is certain, and the words still come near the target."""
    rows = [(i, "w " * 5, "a") for i in range(400)] + [(900, "w " * 600, "a"), (901, "v " * 50_000, "b")]
    data = {r["doc_id"]: r.asDict() for r in mix(as_docs(rows)).select(
        "doc.doc_id", "size", "source", "source_size", "target", "copies", "taken", "expected_copies").collect()}
    check(list(data.values()), rows)
