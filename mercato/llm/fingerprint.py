"""Operator 4, document fingerprints: improbable-feature digests.

Every window of ``WINDOW`` bytes gets the empirical entropy of its bytes, and
from it a precedence rank: the density of that entropy under a fixed reference
distribution of prose, so improbable windows come first; windows of next to no
entropy come last.  In every run of ``RUN`` neighbouring windows the leftmost
window of the lowest rank scores a point, and windows with at least ``POPULAR``
points are the text's features.  Texts under ``SHORT`` bytes have few windows: theirs are scored in runs of
``SHORT_RUN`` and need ``SHORT_POPULAR`` points, a rule of the length alone.  Distinct features, in order, go into Bloom
filters of ``BITS`` bits with five hash functions; after ``PER_FILTER``
features the next filter begins.

Likeness: each filter of the digest with fewer filters is compared with all of
the other; a pair's overlap in bits is set between what chance would give
(plus a margin) and the most possible, the best pair counts, and filters weigh
by their features.

The ranks are fixed, so fingerprints do not depend on the corpus and equal
texts have equal fingerprints.  A fingerprint is ``features:base64 of filters``.

Neighbours in id order: one range shuffle on the id orders the texts, tasks
walk their range as a stream, and only the first and last text of each range
meet in a second, tiny step.

Edge cases: a null text is empty; an empty text has the empty fingerprint, like
(1.0) only to itself; a text shorter than a window has one feature, itself; a
text with no popular window keeps its most popular one; null ids come first,
equal ids are ordered by a hash of the text; a lone document is its own next;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Rolling, bound_batches, materialize, pieces

WINDOW = 64
RUN = 64
POPULAR = 16
SHORT, SHORT_RUN, SHORT_POPULAR = 1024, 8, 2
BITS = 2048
PER_FILTER = 160
HASHES = 5
MARGIN = 0.3
# The reference distribution of a prose window's entropy, in thousandths of the 6 bits
# that 64 different bytes have; below LEAST_ENTROPY a window says next to nothing.
USUAL_ENTROPY, SPREAD, LEAST_ENTROPY = 650, 45, 150

_BLOCK = 1 << 17
_UNIT = 1 << 16
_STEP = np.zeros(WINDOW + 2, np.int64)
_STEP[1:] = np.diff(np.round(np.arange(WINDOW + 2) * np.log2(np.maximum(np.arange(WINDOW + 2), 1)) * _UNIT)
                    .astype(np.int64))
_MOST = int(WINDOW * np.log2(WINDOW) * _UNIT)
_LEVELS = np.arange(1001)
_RANKS = np.round(1000 * np.exp(-((_LEVELS - USUAL_ENTROPY) / SPREAD) ** 2 / 2)).astype(np.int64)
_RANKS[:LEAST_ENTROPY] = 1001
_PLACE = (1 << 40) - 1


def window_ranks(data: np.ndarray) -> np.ndarray:
    """The precedence rank of every window of the array."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    # how often a byte occurs in the window that starts, and in the window that ends, with it
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for a in range(0, n, _BLOCK):
        block = data[a:a + _BLOCK + WINDOW - 1]
        own = min(_BLOCK, n - a)
        for d in range(1, min(WINDOW, len(block))):
            m = min(own, len(block) - d)
            same = (block[:m] == block[d:d + m]).view(np.uint8)
            ahead[a:a + m] += same
            behind[a + d:a + d + m] += same
    # sum of c * log2(c) over a window's byte counts, from window to window
    sums = np.zeros(n - WINDOW + 1, np.int64)
    sums[0] = np.cumsum(_STEP)[np.bincount(data[:WINDOW])].sum()
    if len(sums) > 1:
        np.cumsum(_STEP[behind[WINDOW:]] - _STEP[ahead[:n - WINDOW]], out=sums[1:])
        sums[1:] += sums[0]
    level = (_MOST - sums) * 1000 // _MOST
    return _RANKS[np.clip(level, 0, 1000)]


def _popular(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, run: int = RUN,
             popular: int = POPULAR) -> np.ndarray:
    """Places of the selected windows of all texts (each at least a window long); ``run`` is a power of two."""
    n = len(data)
    key = window_ranks(data) * (_PLACE + 1) + np.arange(max(0, n - WINDOW + 1))
    low, width = key, 1
    while width < run:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    points = np.zeros(n + 1, np.int64)
    windows = stops - starts - WINDOW + 1
    first_run = np.zeros(n + 1, np.int64)
    whole = windows >= run
    np.add.at(first_run, starts[whole], 1)
    np.add.at(first_run, starts[whole] + windows[whole] - run + 1, -1)
    runs = np.flatnonzero(np.cumsum(first_run[:n]))
    if len(runs):
        points[:n] += np.bincount(low[runs] & _PLACE, minlength=n)[:n]
    for a, w in zip(starts[~whole], windows[~whole], strict=True):  # one run over all its windows
        points[int(key[a:a + w].min()) & _PLACE] += 1
    chosen = points >= popular
    counts = np.concatenate([[0], np.cumsum(chosen)])
    bare = counts[stops] == counts[starts]
    for a, b in zip(starts[bare], stops[bare], strict=True):
        chosen[a + int(np.argmax(points[a:b]))] = True
    return np.flatnonzero(chosen)


def digests(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text."""
    out = [""] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner, hashes = [], []
    for i in np.flatnonzero((sizes > 0) & (sizes < WINDOW)):
        owner.append(np.array([i]))
        hashes.append(np.frombuffer(hashlib.blake2b(texts[i], digest_size=8).digest(), np.uint64))
    for which, run, popular in (((sizes >= WINDOW) & (sizes < SHORT), SHORT_RUN, SHORT_POPULAR),
                                (sizes >= max(WINDOW, SHORT), RUN, POPULAR)):
        own = np.flatnonzero(which)
        if len(own):
            data = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
            stops = np.cumsum(sizes[own])
            at = _popular(data, stops - sizes[own], stops, run, popular)
            owner.append(own[np.searchsorted(stops, at, "right")])
            hashes.append(Rolling(data).of(at, at + WINDOW))
    if not owner:
        return out
    owner, hashes = np.concatenate(owner), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    owner, hashes = owner[order], hashes[order]
    both = np.stack([owner.astype(np.uint64), hashes], axis=1)
    _, first = np.unique(both, axis=0, return_index=True)
    first.sort()
    owner, hashes = owner[first], hashes[first]
    rows, begin, count = np.unique(owner, return_index=True, return_counts=True)
    filters = -(-count // PER_FILTER)
    base = np.cumsum(filters) - filters
    nth = np.arange(len(owner)) - np.repeat(begin, count)
    place = (np.repeat(base, count) + nth // PER_FILTER) * BITS
    bits = np.zeros(int(filters.sum()) * BITS, bool)
    for k in range(HASHES):
        bits[place + ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits).tobytes()
    size = BITS // 8
    for r, b, f, c in zip(rows, base, filters, count, strict=True):
        out[r] = f"{c}:{base64.b64encode(packed[b * size:(b + f) * size]).decode()}"
    return out


def _filters(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    n, _, body = fingerprint.partition(":")
    bits = np.frombuffer(base64.b64decode(body), np.uint64).reshape(-1, BITS // 64)
    held = np.full(len(bits), PER_FILTER, np.int64)
    held[-1] = int(n) - PER_FILTER * (len(bits) - 1)
    return bits, held


def likeness(one: str, other: str) -> float:
    """From 0 (nothing beyond chance in common) to 1."""
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    (a, na), (b, nb) = sorted((_filters(one), _filters(other)), key=lambda f: (len(f[0]), f[1].sum()))
    size_a, size_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    best = np.zeros(len(a))
    empty = 1 - 1 / BITS
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(1, dtype=np.int64)
        most = np.minimum(size_a[i], size_b)
        chance = BITS * (1 - empty ** (HASHES * na[i]) - empty ** (HASHES * nb) + empty ** (HASHES * (na[i] + nb)))
        floor = chance + MARGIN * (most - chance)
        room = most - floor
        best[i] = np.where(room > 0, (common - floor) / np.where(room > 0, room, 1), 0).max()
    return float(np.clip((best * na).sum() / na.sum(), 0, 1))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _rows(ids: list, texts: list[str], prints: list[str], next_texts: list[str], next_prints: list[str]) -> list[list]:
    changed = [edited(a, b).encode() for a, b in zip(texts, next_texts, strict=True)]
    changed_prints = digests(changed)
    return [ids, [len(t) for t in texts], [hashlib.sha256(c).hexdigest() for c in changed], prints, changed_prints,
            [likeness(a, b) for a, b in zip(prints, changed_prints, strict=True)],
            [likeness(a, b) for a, b in zip(prints, next_prints, strict=True)]]


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_DONE, _FIRST, _LAST = range(3)


def _batch(columns: list[list], part: int | None = None, kind: int = _DONE, text: str | None = None) -> pa.RecordBatch:
    arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
    if part is None:
        return pa.RecordBatch.from_arrays(arrays, _NAMES)
    n = len(columns[0])
    arrays += [pa.array([part] * n, pa.int64()), pa.array([kind] * n, pa.int64()), pa.array([text] * n, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, [*_NAMES, "part", "kind", "text"])


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses: one row per input row."""
    bound_batches(docs)
    ordered = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        alone = lambda i, t, p: [[i], [len(t)], [None], [p], [None], [None], [None]]
        for batch in pieces(batches, "text", 2 << 20):
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = digests([t.encode() for t in texts])
            if held is None:
                yield _batch(alone(ids[0], texts[0], prints[0]), part, _FIRST, texts[0])
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            if len(ids) > 1:
                yield _batch(_rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:]), part)
            held = ids[-1], texts[-1], prints[-1]
        if held:
            yield _batch(alone(*held), part, _LAST, held[1])

    walked = materialize(ordered.mapInArrow(walk, _OUT + ", part long, kind long, text string"), "fingerprints")
    # the last text of each range and the first of the next one; one row per range
    firsts = walked.filter(F.col("kind") == _FIRST).select(
        F.col("part").alias("first_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    parts = walked.filter(F.col("kind") == _FIRST).select("part")
    everything = Window.partitionBy()
    follows = parts.select(F.col("part").alias("of"), F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(everything)).alias("first_part"))
    lasts = walked.filter(F.col("kind") == _LAST).select("part", "doc_id", "text", "fingerprint")
    seams = lasts.join(follows, lasts["part"] == follows["of"]).join(firsts, "first_part").select(
        "doc_id", "text", "fingerprint", "next_text", "next_print")

    def join_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(_rows(*(c.to_pylist() for c in batch.columns)))

    done = walked.filter(F.col("kind") == _DONE).select(*_NAMES)
    return done.unionByName(seams.mapInArrow(join_seams, _OUT))
