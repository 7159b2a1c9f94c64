import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from llm_fixtures import SF
from mercato.llm import collocations
from mercato.llm.collocations import mine_collocations
from mercato.llm.oracle import ORACLE_SQL
from mercato.llm.queries import op13_collocations


@pytest.fixture
def as_texts(spark):
    def make(rows):
        return spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, phrase string")
    return make


def plain(rows, least, top=2000, percent=100):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(words[i:i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        inside = {}
        for p in found:
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside.get(p[i:j], 0), f[p])
        kept = []
        for p in found:
            a = f[p]
            if 100 * inside.get(p, 0) >= percent * a:
                continue
            score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            kept.append((lang, " ".join(p), a, l, r, total[lang], score))
        kept.sort(key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], i + 1, *x[1:]) for i, x in enumerate(kept[:top])]
    return sorted(out)


def got(frame, **options):
    return sorted(map(tuple, mine_collocations(frame, **options).collect()))


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß", "The", "the", "en", "de", "und"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            words.append(rng.choice(("new york city hall", "in the end of", "x", "A b")) if rng.random() < 0.2
                         else rng.choice(vocabulary))
        text = "".join(w + rng.choice((" ", " ", " ", "\t", ", ", ". ", "\n", " - ")) for w in words)
        rows.append((text, rng.choice(("en", "en", "de", None, "und", ""))))
    return rows


@pytest.mark.parametrize("options", [{}, {"most_broadcast": 3}, {"percent": 60, "top": 7}])
def test_equals_plain_version(spark, as_texts, options):
    rows = corpus(1)
    want = plain(rows, 6, options.get("top", 2000), options.get("percent", 100))
    assert got(as_texts(rows), least=6, **options) == want
    assert len({w[0] for w in want}) == 4


def test_nulls_blanks_repeats_and_long_texts(spark, as_texts):
    rows = [(None, "en"), ("", None), (" \t.;", "en"), ("a b c", "en"), ("a b c", "en"), ("a b c", "en"), ("a a a a a a", "fr"),
            ("q r " * 300_000, "xx"), ("nul\x00word s t nul\x00word s t", "zz")]
    assert got(as_texts(rows), least=2) == plain(rows, 2)


def test_hot_pair_and_hot_line_with_salts(spark, as_texts, monkeypatch):
    rng = random.Random(7)
    rows = [("of the " + " ".join(rng.choice("abcdefgh") for _ in range(4)), "en") for _ in range(900)]
    rows += [("one line that stands in every text", "en")] * 900
    assert got(as_texts(rows), least=10) == plain(rows, 10)


def test_packing_keeps_ids_of_31_bits(spark):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 1 << 31, 50) for _ in range(5)]
    pair, rest, more = collocations._packed(ids)
    frame = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(pair, rest, more, strict=True)],
                                  "pair long, rest long, more long")
    back = frame.select(*[collocations._unpacked(k).alias(f"w{k}") for k in range(1, 6)])
    assert [tuple(r) for r in back.collect()] == [tuple(map(int, x)) for x in zip(*ids, strict=True)]
    again = back.select(*collocations._packed_columns([back[f"w{k}"] for k in range(1, 6)]))
    assert [tuple(r) for r in again.collect()] == [tuple(map(int, x)) for x in zip(pair, rest, more, strict=True)]


def test_scores_past_64_bits(spark, as_texts):
    rows = [("p q " * 20_000, "en"), ("z " * 900_000, "en")]
    want = plain(rows, 10_000)
    assert 1000 * want[0][3] * want[0][6] > 1 << 44
    assert got(as_texts(rows), least=10_000) == want


def test_empty_table(spark, as_texts):
    assert got(as_texts([("a b", "en")]).limit(0)) == []
    assert got(as_texts([("a b", "en")])) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    frame = op13_collocations(spark, SF)
    want = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLE_SQL['op13_collocations']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want)
    assert want
