import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm import suffix_dedup as sd
from mercato.llm.deep_shallow import BlindTrie, common_prefix, deep_shallow_order
from mercato.llm.queries import op6_suffix_dedup
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(texts, length=sd.LENGTH):
    """(bytes, removed, spans, digest of the rest) of each text, window by window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes() if r else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_runs(texts, n):
    """Whether a text holds a run of n words that stands elsewhere too."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    seen = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    return [any(seen[tuple(w[i:i + n])] > 1 for i in range(len(w) - n + 1)) for w in words]


def result(df):
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.sha)) for r in sd.remove_repeats(df).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).collect()]


def test_common_prefix():
    rng = random.Random(0)
    for _ in range(300):
        a = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 40)))
        b = a[:rng.randint(0, len(a))] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 5)))
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common_prefix(a, b) == want


@pytest.mark.parametrize("shallow", [0, 8, 32])
def test_order_is_the_sorted_order(shallow):
    rng = random.Random(shallow)
    long = bytes(rng.randrange(256) for _ in range(500))
    strings = [long[:rng.choice([0, 3, 9, 40, 200])] + bytes(rng.choice(b"\0ab") for _ in range(rng.randint(0, 6)))
               for _ in range(400)] + [b"", b"", long, long]
    order = deep_shallow_order(strings, 0, shallow)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[p] for p in order] == sorted(strings)
    trie = BlindTrie(strings)
    for p in range(len(strings)):
        trie.insert(p)
    assert [strings[p] for p in trie.ordered()] == sorted(strings)


def test_query_equals_all_windows(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(map(tuple, op6_suffix_dedup(spark, SF).collect()))
    assert [g[0] for g in got] == [i for i, _ in rows]
    assert [tuple(g[1:5]) for g in got] == brute([t for _, t in rows])
    shared = word_runs([t for _, t in rows], sd.MARK_RUN)
    assert sum(shared) > 5
    for g, long, short in zip(got, shared, word_runs([t for _, t in rows], sd.MARK), strict=True):
        assert (g[5] > 0) >= long and (g[5] > 0) <= short


def repeats(rng):
    """Shared passages around the length of a window, at all offsets, within and across texts."""
    prose = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [prose(n) for n in (150, 300, 360, 365, 380, 420, 700)]
    texts = [prose(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 20):] + prose(rng.randint(0, 300))
             + (rng.choice(passages) if rng.random() < 0.4 else "") for _ in range(150)]
    return texts + ["x" * 1000, "ab" * 450, texts[0] * 2, passages[-1], passages[-1][:-1]]


@pytest.mark.parametrize("group", [8192, 5])
def test_passages_copies_runs_nulls_and_ties_whole_and_in_blocks(spark, as_docs, monkeypatch, group):
    monkeypatch.setattr(sd, "GROUP", group)
    rng = random.Random(group)
    texts = repeats(rng)
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (None, texts[3]), (1002, "z" * 500), (1002, "z" * 500),
                                     (1003, "q" * 399), (1004, "short")]
    want = sorted(zip([k if k is not None else -1 for k, _ in rows], brute([t for _, t in rows]), strict=True))
    assert sorted((k if k is not None else -1, v) for k, v in result(as_docs(rows))) == want


def test_long_text_and_empty_table(spark, as_docs):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    got = dict(result(as_docs([(1, text), (2, text[100_000:100_399]), (3, "-" + text[200_000:200_400] + "-")])))
    assert got[1][1] == 400 and got[2][1] == 0 and got[3][:3] == (402, 400, 1)
    assert sd.remove_repeats(as_docs([(1, "a")]).limit(0)).count() == 0


def test_marks_tell_shared_passages_of_words(spark, as_docs):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [prose(n) for n in (20, 31, 45, 51, 52, 80)]
    texts = [prose(rng.randrange(90)) + " " + (rng.choice(passages) if k % 3 else "") + "\n" + prose(rng.randrange(90))
             for k in range(120)]
    texts += [None, "", passages[3].upper(), passages[3], "same " * 60, prose(3000) + " " + passages[5] + " end"]
    got = {r.doc_id: r.n_repeated_marks for r in sd.remove_repeats(as_docs(list(enumerate(texts)))).collect()}
    for k, (long, short) in enumerate(zip(word_runs(texts, sd.MARK_RUN), word_runs(texts, sd.MARK), strict=True)):
        assert (got[k] > 0) >= long and (got[k] > 0) <= short
    assert got[122] == got[123] > 0 and got[120] == got[121] == 0
    assert 0 < sum(v > 0 for v in got.values()) < len(texts)


def test_a_passage_in_every_text_and_repeated_rows(spark, as_docs):
    rng = random.Random(13)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(70))
    rows = [(k, f"t{k} " * 30 + passage + f" u{k}" * 30) for k in range(800)]
    rows += [(900, " ".join(f"q{i}" for i in range(60)))] * 2 + [(901, " ".join(f"z{i}" for i in range(60)))]
    got = sd.remove_repeats(as_docs(rows)).select("doc_id", "n_repeated_marks").collect()
    assert len(got) == len(rows)
    assert all((n > 0) == (i != 901) for i, n in got)


def test_op6_texts_are_shuffled_once_for_both_joins(spark, as_docs):
    frame = as_docs([(i, f"{i % 3} " + "some words that stand in more than one text " * 20) for i in range(30)])
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = sd.remove_repeats(frame)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "ReusedExchange [doc_id" in plan
