import math
from itertools import product

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm import sampled_segmentation as ss
from mercato.llm.common import tokenizer_path
from mercato.llm.lattice import Lattices, Pieces, unit_starts, written
from mercato.llm.queries import op3_sampled_segmentation

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def segmentations(pieces, text):
    """Every segmentation of a text as ids, with its probability, by plain recursion over the whole text."""
    model = SentencePieceProcessor(model_file=PATH)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i)
                                                               or model.is_byte(i))]
    ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
    weight = {model.id_to_piece(i): (i, 1 / (1 + r)) for r, i in enumerate(ranked)}
    spelled = "▁" + text.replace("▁", "\0").replace(" ", "▁")

    def ways(at):
        if at == len(spelled):
            yield (), 1.0
            return
        options = [((weight[spelled[at:e]][0],), weight[spelled[at:e]][1], e)
                   for e in range(at + 1, min(len(spelled), at + 16) + 1) if spelled[at:e] in weight]
        if spelled[at] not in weight:
            raw = spelled[at].replace("\0", "▁").encode()
            options.append((tuple(int(pieces.byte_ids[b]) for b in raw), math.exp(pieces.byte_weight) ** len(raw), at + 1))
        for ids, w, e in options:
            for rest, p in ways(e):
                yield ids + rest, w * p

    found = dict(ways(0))
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


@pytest.mark.parametrize("text", ["ab", "the", "a  b", "x▁y", "é\U0001f600", " \n"])
def test_probabilities_are_those_of_all_segmentations(pieces, text):
    want = segmentations(pieces, text)
    keys = np.arange(3000)
    search = ss.Search(pieces, [text] * len(keys), keys, 7)
    counts = dict.fromkeys(want, 0)
    for rows in search.run(1):
        (edges, log_p, _, _), = rows
        ids = tuple(search.lattice.ids_of(edges).tolist())
        assert math.exp(log_p) == pytest.approx(want[ids])
        counts[ids] += 1
    for ids, p in want.items():
        assert abs(counts[ids] / len(keys) - p) < 5 * math.sqrt(p * (1 - p) / len(keys)) + 1e-9


def test_sampling_without_replacement_has_the_right_pairs(pieces):
    """Ordered pairs occur as often as drawing twice without replacement says."""
    want = segmentations(pieces, "the")
    keys = np.arange(6000)
    search = ss.Search(pieces, ["the"] * len(keys), keys, 1)
    seen = {}
    for rows in search.run(2):
        assert rows[0][2] >= rows[1][2]
        pair = tuple(tuple(search.lattice.ids_of(e).tolist()) for e, *_ in rows)
        assert pair[0] != pair[1]
        seen[pair] = seen.get(pair, 0) + 1
    for a, b in product(want, want):
        if a != b:
            p = want[a] * want[b] / (1 - want[a])
            assert abs(seen.get((a, b), 0) / len(keys) - p) < 5 * math.sqrt(p / len(keys)) + 1e-9


def test_inclusion_scores_estimate_sums_without_bias(pieces):
    """Horvitz-Thompson: the sum of p / inclusion over a sample is 1 on average."""
    keys = np.arange(4000)
    search = ss.Search(pieces, ["then a"] * len(keys), keys, 5)
    sums = [sum(math.exp(log_p - inclusion) for _, log_p, _, inclusion in rows) for rows in search.run(3)]
    assert np.mean(sums) == pytest.approx(1, abs=5 * np.std(sums) / math.sqrt(len(sums)))


def test_all_segmentations_of_a_short_text_in_order_of_value(pieces):
    want = segmentations(pieces, "it")
    rows, = ss.Search(pieces, ["it"], np.array([9]), 0).run(100)
    assert len(rows) == len(want) and sum(math.exp(r[1]) for r in rows) == pytest.approx(1)
    assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
    assert all(r[3] == 0.0 for r in rows)


def test_units_and_batches_do_not_change_samples(pieces):
    texts = ["some words of a text", "", "other words", "漢字 and ▁ mark  twice", "x" * 3000]
    cps, starts = written(texts)
    assert len(Lattices(pieces, cps, unit_starts(cps, starts)).unit_of) == len(unit_starts(cps, starts))

    def ids(chosen):
        search = ss.Search(pieces, [texts[i] for i in chosen], np.array(chosen), 2)
        return {i: [(search.lattice.ids_of(e).tolist() if len(e) else [], round(p, 9)) for e, p, *_ in rows]
                for i, rows in zip(chosen, search.run(3), strict=True)}

    together = ids([0, 1, 2, 3, 4])
    assert together == ids([4, 3, 2, 1, 0]) and together[2] == ids([2])[2]
    assert together[1] == [([], 0.0)]


def test_query_decodes_and_samples_are_distinct(spark, docs):
    rows = op3_sampled_segmentation(spark, SF).collect()
    assert len(rows) == 2 * docs.count() and all(r.decodes for r in rows)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for own in by_doc.values():
        assert own[0].ids != own[1].ids and all(r.log_inclusion <= 0 and r.n_ids == len(r.ids) for r in own)


def test_nulls_ties_long_texts_and_decoding(spark, as_docs):
    rows = [(1, None), (2, ""), (3, "a b" * 100_000), (4, "tie"), (4, "tie"), (None, "▁ \x00\t\n"), (5, "  ")]
    encoded = ss.sample_segmentations(as_docs(rows), PATH, samples=3)
    got = {}
    for r in ss.decode_texts(encoded, PATH).collect():
        got.setdefault(r.doc_id, set()).add(r.text)
    assert got == {1: {""}, 2: {""}, 3: {"a b" * 100_000}, 4: {"tie"}, None: {rows[5][1]}, 5: {"  "}}
    ties = [tuple(r.ids) for r in encoded.filter("doc_id = 4").collect()]
    assert len(ties) == 6 and len(set(ties)) == 3
    plain = SentencePieceProcessor(model_file=PATH)
    assert all(plain.decode(list(t)) == "tie" for t in ties)
    assert ss.sample_segmentations(as_docs(rows).limit(0), PATH).count() == 0
