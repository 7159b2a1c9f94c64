import random
import re

import duckdb
import pytest

from llm_fixtures import SF, as_docs  # noqa: F401
from mercato.llm.licenses import NOTICES, PHRASES, TEMPLATES, Template, need_of, scan_licenses, width_of, words_of
from mercato.llm.oracle import ORACLE_SQL
from mercato.llm.queries import op11_license_scan


def plain(text, templates):
    """Every block of every template, without filters."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for number, t in enumerate(templates):
        phrase, width = words_of(t.text), width_of(t)
        if t.consecutive:
            for i in range(len(words)):
                if words[i:i + len(phrase)] == phrase:
                    found.append((i, i + len(phrase) - 1, t.label, number, 1.0))
        else:
            for i in range(0, len(words), width // 2):
                shared = len(set(words[i:i + width]) & set(phrase))
                if 100 * shared >= t.percent * len(set(phrase)):
                    found.append((i, min(i + width, len(words)) - 1, t.label, number, shared / len(set(phrase))))
    base = [f for f in found if templates[f[3]].base]
    return (len(words), len(base), min((f[0] for f in base), default=None), max((f[0] for f in base), default=None),
            sorted({f[2] for f in base}), sorted({f[2] for f in found}), max((f[4] for f in found), default=0.0),
            sorted(found))


def got(frame, templates=None):
    rows = scan_licenses(frame, templates).select(
        "doc.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "findings")
    return [(r[0], (*r[1:8], sorted(map(tuple, r.findings or [])))) for r in rows.collect()]


def same(frame, rows, templates=None):
    want = [(r[0], plain(r[1], templates or TEMPLATES)) for r in rows]
    assert sorted(map(repr, got(frame, templates))) == sorted(map(repr, want))


def test_notices_references_places_and_edges(spark, as_docs):
    rng = random.Random(4)
    filler = ["wort", "the", "of", "to", "license", "version", "2", "software", "é", "and", "use", "10"]
    rows = [(1, None), (2, ""), (3, " \t\n-- "), (4, "Under the MIT license!"), (4, "Under the MIT license!"),
            (None, "CC BY-NC, cc-by NC cc by nc"), (5, "apache license version 2 apache license version 2.0"),
            (6, "apache license version"), (7, "under\x00the_mit.LICENSE"), (8, "Épache license version 2"),
            (9, "GNU General Public License as published, version 3")]
    i = 100
    for notice in NOTICES.values():
        for gone in (0, 3, 8, 30):  # words replaced in the notice
            words = notice.split()
            for k in rng.sample(range(len(words)), min(gone, len(words))):
                words[k] = "zzz"
            lead = [rng.choice(filler) for _ in range(rng.randrange(300))]
            rows.append((i, " ".join([*lead, *words, *(rng.choice(filler) for _ in range(rng.randrange(40)))])))
            i += 1
    for phrase in PHRASES:  # at every offset from the edges of blocks
        rows += [(i + k, "x " * k + phrase + " y") for k in range(20)]
        i += 20
    rows.append((i, ("The MIT license, under the mit license. " + "word " * 50) * 2000))
    same(as_docs(rows), rows)


def test_phrases_with_repeated_words_and_wide_templates(spark, as_docs):
    rng = random.Random(5)
    wide = " ".join(f"w{rng.randrange(60)}" for _ in range(100))
    templates = [Template("aba", "a b a", 100, True, True), Template("aa", "a a", 100, True, True),
                 Template("half", "c d e f", 50), Template("wide", wide, 70), Template("one", "q", 100, True)]
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for k in range(60)]
    rows += [(100 + k, "z " * rng.randrange(300) + " ".join(rng.sample(wide.split(), 60 + 2 * k))) for k in range(20)]
    assert width_of(templates[3]) == 256 and need_of(templates[2]) == 2
    same(as_docs(rows), rows, templates)


def test_a_line_in_every_document_and_clashing_columns(spark, as_docs):
    rows = [(k, f"text {k}. Licensed under the Apache License, Version 2.0.") for k in range(3000)]
    frame = as_docs(rows).withColumnRenamed("size", "n_words").withColumnRenamed("id", "labels")
    same(frame, rows)
    assert scan_licenses(frame).select("doc.*").columns == [c for c in frame.columns if c != "text"]


def test_empty_table_and_bounds(spark, as_docs):
    assert scan_licenses(as_docs([(1, "a")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(as_docs([(1, "a")]), [Template("none", "--")])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    frame = op11_license_scan(spark, SF)
    want = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLE_SQL['op11_license_scan']})").fetchall()
    assert sorted(map(repr, map(tuple, frame.collect()))) == sorted(map(repr, want))
    assert sum(r[2] > 0 for r in want) > 0
