import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm import jaccard_join as jj
from mercato.llm.common import text_bytes
from mercato.llm.queries import op7_jaccard_join
from mercato.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"


def plain_set(text, words):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))


def brute(rows, words, similarity):
    """(n, component id) of each row by all pairs that share a shingle."""
    sets = [plain_set(t, words) for _, t in rows]
    holders, up = defaultdict(list), list(range(len(rows)))

    def root(u):
        while up[u] != u:
            u = up[u]
        return u

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                up[max(root(i), root(j))] = min(root(i), root(j))
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        ids = [k for k in (least.get(root(i)), key) if k is not None]
        least[root(i)] = min(ids, default=None)
    return [(len(s), least[root(i)]) for i, s in enumerate(sets)]


def families(rng, n):
    """Chains of edited copies around the threshold, shared passages, exact copies, short texts."""
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    passage, out = [word() for _ in range(60)], []
    while len(out) < n:
        base = [word() for _ in range(rng.choice([3, 4, 5, 30, 100, 200]))]
        if rng.random() < 0.3:
            base[5:5] = passage
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            out.append(" ".join(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                base[rng.randrange(len(base))] = word()
    return out[:n]


def test_sets_equal_the_plain_ones():
    texts = ["A b  c\td", "a b c", "", None, " \n", "a b c d a b c d a", "É é x Y z", "x" * 50]
    for words in (4, 5):
        sets = shingle_sets(*text_bytes(pa.array(texts)), words)
        assert [len(s) for s in sets] == [len(plain_set(t, words)) for t in texts]
    a, b = shingle_sets(*text_bytes(pa.array(["A b c d", "q a b C D"])), 4)
    assert set(a) <= set(b)


def test_query_equals_all_pairs(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard_join(spark, SF).collect()}
    assert got == {k: w for (k, _), w in zip(rows, brute(rows, 4, 85), strict=True)}


@pytest.mark.parametrize("words, similarity, region", [(4, 85, 4096), (5, 80, 7)])
def test_families_equal_all_pairs_whole_and_in_blocks(spark, as_docs, monkeypatch, words, similarity, region):
    monkeypatch.setattr(jj, "REGION", region)
    monkeypatch.setattr(jj.units, "__defaults__", (region,))
    rng = random.Random(words)
    rows = [(i, t) for i, t in enumerate(families(rng, 400))]
    rows += [(900, None), (901, ""), (901, ""), (902, " \n\t"), (None, rows[0][1]), (903, rows[5][1].upper())]
    want = sorted(zip([k or -1 for k, _ in rows], brute(rows, words, similarity), strict=True), key=str)
    got = jj.jaccard_components(as_docs(rows), words, similarity).collect()
    assert sorted(((r.doc_id or -1, (r.n_shingles, r.component_id)) for r in got), key=str) == want


def test_metric_join_in_cells_equals_all_pairs():
    rng = np.random.default_rng(3)
    bases = [rng.integers(0, 1 << 40, 60, dtype=np.uint64) for _ in range(12)]
    sets = []
    for _ in range(500):
        own = bases[rng.integers(12)].copy()
        own[rng.integers(0, 60, rng.integers(0, 9))] = rng.integers(0, 1 << 40)
        sets.append(np.unique(own))
    ends = np.cumsum([0] + [len(s) for s in sets])
    work = jj.MetricJoin(jj.Index(np.concatenate(sets), ends), 85, np.zeros(500, np.int64), 0, 0)
    work.join(np.arange(500))
    brute_force = jj.Forest(500)
    plain = [set(s.tolist()) for s in sets]
    for u in range(500):
        for v in range(u):
            shared = len(plain[u] & plain[v])
            if 100 * shared >= 85 * (len(plain[u]) + len(plain[v]) - shared):
                brute_force.link(u, v)
    assert [work.forest.root(u) for u in range(500)] == [brute_force.root(u) for u in range(500)]


def test_one_document_of_each_group_stays(spark, as_docs):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(5, base), (3, base + " tail"), (9, base), (9, base), (7, "other text of some words here"),
            (8, ""), (8, ""), (None, None), (3, "unrelated words that stand under the same id"), (11, "once more"),
            (11, "once more")]
    kept = jj.keep_one_per_component(as_docs(rows))
    assert kept.columns == as_docs(rows).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(3, base + " tail"), (7, rows[4][1]), (8, ""), (8, ""), (None, None), rows[8], (11, "once more")],
                         key=str)
    assert jj.jaccard_components(as_docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("region", [4096, 7])
def test_op7_n_links_counts_every_linked_row(spark, as_docs, monkeypatch, region):
    monkeypatch.setattr(jj.units, "__defaults__", (region,))
    rows = [(i, t) for i, t in enumerate(families(random.Random(9), 300))]
    base = [f"w{i}" for i in range(100)]
    rows += [(1000 + i, " ".join([*base, f"end{i}"])) for i in range(40)]  # all linked with each other
    rows += [(1100, rows[-1][1]), (1101, ""), (1102, None)]
    sets = [plain_set(t, 4) for _, t in rows]
    want = {}
    for i, (key, _) in enumerate(rows):
        want[key] = sum(i != j and bool(sets[i]) and 100 * len(sets[i] & s) >= 85 * len(sets[i] | s)
                        for j, s in enumerate(sets))
    got = {r.doc_id: r.n_links for r in jj.jaccard_components(as_docs(rows)).collect()}
    assert got == want and got[1000] == 40
