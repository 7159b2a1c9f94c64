import base64
import hashlib
import math
import random

import numpy as np

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm import fingerprint as fp
from mercato.llm.queries import op4_fingerprints

SF = "/root/testdata/sf0.001"


def entropy_level(window):
    counts = np.unique(window, return_counts=True)[1] / fp.WINDOW
    return -(counts * np.log2(counts)).sum() / 6 * 1000


def test_ranks_equal_the_entropy_of_each_window():
    rng = np.random.default_rng(0)
    text = "In the beginning there was prose. " * 20
    data = np.frombuffer(text.encode() + bytes(100) + rng.integers(0, 256, 400, dtype=np.uint8).tobytes(), np.uint8)
    want = [fp._RANKS[min(1000, int(entropy_level(data[i:i + fp.WINDOW]) + 1e-9))] for i in range(len(data) - 63)]
    assert np.abs(fp.window_ranks(data) - want).max() <= 40  # rounding at the edge of a level
    assert (fp.window_ranks(data) == want).mean() > 0.95


def plain_features(text):
    """Popular windows by their definition."""
    data = np.frombuffer(text, np.uint8)
    n = len(data) - fp.WINDOW + 1
    ranks, points = fp.window_ranks(data), np.zeros(len(data), int)
    for a in range(max(1, n - fp.RUN + 1)):
        points[a + int(np.argmin(ranks[a:min(n, a + fp.RUN)]))] += 1
    chosen = np.flatnonzero(points >= fp.POPULAR)
    return chosen if len(chosen) else [int(points.argmax())]


def test_selection_equals_its_definition_and_ignores_neighbouring_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh \n,.") for _ in range(n)).encode() for n in (64, 65, 100, 127, 128, 700, 3000)]
    texts += [b"a" * 500, bytes(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    stops = np.cumsum([len(t) for t in texts])
    starts = stops - [len(t) for t in texts]
    got = fp._popular(data, starts, stops)
    want = np.concatenate([a + np.asarray(plain_features(t)) for a, t in zip(starts, texts, strict=True)])
    assert got.tolist() == want.tolist()
    assert fp.digests(texts) == [fp.digests([t])[0] for t in texts]


def test_likeness():
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("etaoin shrdlu") for _ in range(n)).encode()
    a, b = make(40_000), make(40_000)
    da, db, dc, short = fp.digests([a, b, a[:30_000] + b[:10_000], a[5_000:9_000]])
    assert fp.likeness(da, da) == 1.0
    assert fp.likeness(da, db) < 0.05
    assert 0.4 < fp.likeness(da, dc) < 1.0
    assert fp.likeness(da, short) == fp.likeness(short, da) > 0.1
    assert fp.likeness("", "") == 1.0 and fp.likeness("", da) == 0.0
    assert fp.digests([b"", b"x", b"x"])[1] == fp.digests([b"x"])[0] != ""


def by_hand(rows):
    out = {}
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        prints = fp.digests([text.encode(), changed.encode(), following.encode()])
        out[key] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
                    fp.likeness(prints[0], prints[1]), fp.likeness(prints[0], prints[2]))
    return out


def test_query_equals_a_walk_by_hand(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = op4_fingerprints(spark, SF).collect()
    assert len(got) == len(rows)
    assert {r[0]: tuple(r[1:]) for r in got} == by_hand(rows)


def test_null_empty_tied_long_and_lone_texts(spark, as_docs):
    rows = [(None, None), (2, ""), (2, ""), (5, "é漢😀" * 40_000), (7, "short"), (9, "z" * 70)]
    got = fp.fingerprint(as_docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].n_chars == 0 and by_id[None].fingerprint == "" and by_id[None].near_next == 1.0
    want = by_hand([(None, ""), (2, ""), (2, ""), (5, "é漢😀" * 40_000), (7, "short"), (9, "z" * 70)])
    assert tuple(by_id[5])[1:] == want[5] and tuple(by_id[9])[1:] == want[9]
    lone = fp.fingerprint(as_docs([(1, "only one text here")])).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0
    assert fp.fingerprint(as_docs(rows).limit(0)).count() == 0


def plain_digest(text):
    """Features by their definition, and Bloom filters as sets of bits."""
    if len(text) < fp.WINDOW:
        hashes = [int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")] if text else []
    else:
        data = np.frombuffer(text, np.uint8)
        short = len(text) < fp.SHORT
        run, popular = (fp.SHORT_RUN, fp.SHORT_POPULAR) if short else (fp.RUN, fp.POPULAR)
        n = len(data) - fp.WINDOW + 1
        ranks, points = fp.window_ranks(data), np.zeros(len(data), int)
        for a in range(max(1, n - run + 1)):
            points[a + int(np.argmin(ranks[a:min(n, a + run)]))] += 1
        at = np.flatnonzero(points >= popular)
        at = at if len(at) else np.array([int(points.argmax())])
        hashes = list(dict.fromkeys(map(int, fp.Rolling(data).of(at, at + fp.WINDOW))))
    filters = [{h >> 11 * k & fp.BITS - 1 for h in hashes[i:i + fp.PER_FILTER] for k in range(fp.HASHES)}
               for i in range(0, len(hashes), fp.PER_FILTER)]
    return hashes, filters


def read_digest(digest):
    n, _, body = digest.partition(":")
    raw = base64.b64decode(body)
    size = fp.BITS // 8
    return int(n), [{8 * i + j for i, byte in enumerate(raw[f:f + size]) for j in range(8) if byte >> 7 - j & 1}
                    for f in range(0, len(raw), size)]


def plain_likeness(one, other):
    if one == other:
        return 1.0
    if not one[0] or not other[0]:
        return 0.0
    sides = []
    for hashes, filters in (one, other):
        sides.append((filters, [len(hashes[i:i + fp.PER_FILTER]) for i in range(0, len(hashes), fp.PER_FILTER)]))
    (a, na), (b, nb) = sorted(sides, key=lambda s: (len(s[0]), sum(s[1])))
    total = 0.0
    for f, n in zip(a, na):
        best = -math.inf  # less than chance counts against the others
        for g, m in zip(b, nb):
            most = min(len(f), len(g))
            e = 1 - 1 / fp.BITS
            chance = fp.BITS * (1 - e ** (fp.HASHES * n)) * (1 - e ** (fp.HASHES * m))
            floor = chance + fp.MARGIN * (most - chance)
            best = max(best, (len(f & g) - floor) / (most - floor) if most > floor else 0.0)
        total += best * n
    return min(1.0, max(0.0, total / sum(na)))


def test_filters_and_likeness_equal_their_plain_version():
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("etaoin shrdlu.,") for _ in range(n)).encode()
    texts = [make(n) for n in (0, 5, 63, 64, 90, 200, 300, 1023, 1024, 5000, 60_000)]
    texts += [texts[-1][:30_000] + make(20_000), texts[6][:150] + make(150), texts[9][1000:3000]]
    found, plain = fp.digests(texts), [plain_digest(t) for t in texts]
    for digest, (hashes, filters) in zip(found, plain, strict=True):
        assert read_digest(digest or "0:") == (len(hashes), filters)
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert abs(fp.likeness(found[i], found[j]) - plain_likeness(plain[i], plain[j])) < 1e-9


def test_half_edited_short_texts_are_told(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy("doc_id")
             .select("text").collect()]
    chosen = [i for i in range(len(texts) - 1) if 200 <= len(texts[i] or "") < 800]
    ones = fp.digests([texts[i].encode() for i in chosen])
    changed = fp.digests([fp.edited(texts[i], texts[i + 1] or "").encode() for i in chosen])
    likes = np.array([fp.likeness(a, b) for a, b in zip(ones, changed, strict=True)])
    sizes = np.array([len(texts[i]) for i in chosen])
    assert (likes[sizes < 400] == 0).mean() < 0.11 and (likes[sizes >= 400] == 0).mean() < 0.02
