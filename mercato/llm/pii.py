"""Operator 8, personal data: proposed spans, boosted trees, calibrated thresholds.

1. *Base spans*: email, ip, card and phone by fixed patterns and validators;
   they are always redacted.
2. *Proposals*: generators of high recall propose overlapping spans around every
   digit and ``@``: number chains with or without ``+``, addresses without a
   dotted host or spelt with *at* and *dot*, colon-separated ips, tokens of any
   length that mix letters and digits, and values of letters assigned to a secret's name.
3. *Classifier*: gradient-boosted trees on format and context features, fitted
   on all proposals of one half of the documents: a proposal that its kind's validator confirms
   (check digit and groups of a card, a phone's format after a cue), or a token assigned
   to a secret's name, is positive; one that the validator
   rejects, or a token with no such context, is negative; others are in neither.  Features fall into bins with
   fixed edges (``EDGES``), so equal proposals are one *cell* with a count.  No group (kind, label, with or
   without a base span) weighs more than ``TRAIN_EACH``, so that rare kinds are heard.
4. *Calibration*: on all those of the other half of the documents that touch no base
   span, as only these can be added, each kind gets the
   lowest threshold (0.5 at least, a multiple of 1 / ``LEVELS``) that reaches ``PRECISION``;
   for a kind with fewer than ``LEAST_CONFIRMED`` positive ones the validator alone decides; a kind that reaches it nowhere
   adds nothing.  Accepted proposals that touch no base span are added.

Two passes over the texts, one to fit; only counts are shuffled.  Each level of a tree is one pass over the cells,
whose tasks return sums by node, feature and bin.  The model (a few hundred numbers) is all that tasks receive.

Edge cases: a null text is empty and has no spans; texts of any length are
searched whole, in time linear in their length; repeated rows and null ids each
keep their row; an empty table fits no model and gives no rows; columns beside
the named ones stay inside the struct ``doc``, so names cannot clash.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, materialize, mix64, pieces, spread

KINDS = ("email", "ip", "card", "phone", "secret")
TRAIN_EACH = 2000
PRECISION = 0.99
LEAST_CONFIRMED = 20
ROUNDS, RATE, DEPTH = 24, 0.3, 3
LEVELS = 1 << 16
_UNIT = 2.0**32  # weights and gradients are sums of whole parts of it, exact below 2**53 in any order
_HELD_CELLS = 1 << 16

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# An inner start of a digit run matches if and only if its first digit does, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            floor = host.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", floor)


def _small_parts(ip: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in ip.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four base kinds, ordered by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if _small_parts(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NOT_DIGIT.sub("", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


# Proposals --------------------------------------------------------------------

_CHAIN = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+")
_TOKEN = re.compile(r"[A-Za-z0-9_/+.=-]+")
_CUES = {"password": 1, "passwd": 1, "pwd": 1, "secret": 1, "token": 1, "key": 1, "apikey": 1, "api_key": 1,
         "tel": 2, "phone": 2, "call": 2, "fax": 2, "mail": 3, "email": 3, "card": 4, "visa": 4, "ip": 5, "host": 5}
_CUE = re.compile(r"([A-Za-z_]+)[\x20\t]{0,2}([=:]?)[\x20\t\"']{0,3}$")
_TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/+.-")
N_FEATURES = 14
_DATE = re.compile(r"(?:[12][0-9]{3}[.-][01]?[0-9][.-][0-3]?[0-9]|[0-3]?[0-9][.-][01]?[0-9][.-][12][0-9]{3})(?![0-9])")
_BARE_HOST = re.compile(r"[A-Za-z0-9](?:-*[A-Za-z0-9])*+")
_DOT = re.compile(r"dot", re.I)
_SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[\x20\t]{1,3}[(\[]?at[)\]]?[\x20\t]{1,3}[A-Za-z0-9-]++"
                    r"(?:[\x20\t]{1,3}[(\[]?dot[)\]]?[\x20\t]{1,3}[A-Za-z0-9-]++)++", re.I)
_TOP_DOMAINS = frozenset("com org net edu gov info io dev de fr es it uk eu ch at nl us".split())
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_CUED = re.compile(r"(?<![A-Za-z_])(password|passwd|pwd|secret|token|api_?key|key)[\x20\t]{0,2}([=:])[\x20\t\"']{0,3}"
                   r"([A-Za-z_/+.-]{8,}+)(?![0-9])", re.I)

_SIXTEENTHS = [i / 16 for i in range(16)]
# Upper edges of the bins of each feature; what lies above the last one is a bin too.
EDGES = [np.array(e, float) for e in (
    range(4), [*range(1, 33), 40, 48, 64, 96, 128, 256], _SIXTEENTHS, _SIXTEENTHS, _SIXTEENTHS,
    [i / 4 for i in range(25)], [*range(13), 16, 24, 32], [*range(25), 32, 64], [0], range(5), [0], [0], [0], [0])]
BINS = 1 + max(map(len, EDGES))


class _Held:
    """Spans by kind; spans of one kind do not overlap."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans: dict[int, list[tuple[int, int]]] = {}
        for k, a, b in spans:
            self.spans.setdefault(k, []).append((a, b))

    def touched(self, a: int, b: int) -> set[int]:
        """The kinds that have a span which overlaps ``a`` to ``b``."""
        out = set()
        for k, own in self.spans.items():
            i = bisect.bisect_left(own, (b, -1)) - 1
            if i >= 0 and own[i][1] > a:
                out.add(k)
        return out

    def add(self, k: int, a: int, b: int) -> None:
        bisect.insort(self.spans.setdefault(k, []), (a, b))


def _features(text: str, kind: int, a: int, b: int) -> list[float]:
    """Format of the span without a leading plus, and the context before and after it."""
    s = text[a:b].lstrip("+")
    n = max(1, len(s))
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    counts = np.bincount(np.frombuffer(s.encode("utf-32-le"), np.uint32) % 256)
    p = counts[counts > 0] / n
    cue = _CUE.search(text, max(0, a - 32), a)
    number = "".join(c for c in s if "0" <= c <= "9")
    before, after = text[a - 1:a], text[b:b + 1]
    return [float(kind), float(n), digits / n, letters / n, sum(c.isupper() for c in s) / n,
            float(-(p * np.log2(p)).sum()), float(n - digits - letters), float(digits),
            float(13 <= digits <= 19 and luhn(number)), float(_CUES.get(cue.group(1).lower(), 0) if cue else 0),
            float(bool(cue and cue.group(2))), float(bool(before) and not before.isspace()),
            float(bool(after) and after.isalnum()),
            float(digits and all(c in "0123456789abcdefABCDEF" for c in s))]


def _other_emails(text: str, held: _Held) -> Iterator[tuple[int, int, int]]:
    """(start, end, weak label) of addresses that the base pattern does not take."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        host = _BARE_HOST.match(text, at + 1) if start < at else None
        floor = at + 1
        if host and not held.touched(start, host.end()):
            cue = _CUE.search(text, max(0, start - 32), start)
            sure = host.group().lower() == "localhost" or (cue and _CUES.get(cue.group(1).lower()) == 3)
            yield start, host.end(), 1 if sure else -1
        at = text.find("@", floor)
    if _DOT.search(text):
        for m in _SPELT.finditer(text):
            yield *m.span(), int(re.split(r"[\x20\t]", m.group())[-1].lower() in _TOP_DOMAINS)


def _is_ip6(s: str) -> bool:
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return sum(c != ":" for c in s) >= 4


def _chain_label(text: str, kind: int, a: int, b: int, f: list[float], touched: set[int]) -> int:
    """What the validator of a number chain says of it, whether or not a base pattern takes it too."""
    if kind in touched:
        return 1
    groups = _NOT_DIGIT.split(text[a:b].strip("+("))
    if f[11] and text[a - 1].isalnum() or f[12] or 1 in touched:  # a piece of a token, or an address
        return 0
    if kind == 2:
        return int(f[8] == 1 and (len(groups) == 1 or all(3 <= len(g) <= 6 for g in groups)))
    if _DATE.match(text, a, b):
        return 0
    return 1 if f[9] == 2 and 7 <= f[7] <= 12 and len(groups) <= 6 else -1


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[float]]]:
    """(kind, start, end, weak label, features); label 1, 0, or -1 where no rule decides."""
    held = _Held(base)
    out = [(0, a, b, label, _features(text, 0, a, b)) for a, b, label in _other_emails(text, held)]
    if text.count(":") > 1:
        out += [(1, *m.span(), int(_is_ip6(m.group())), _features(text, 1, *m.span())) for m in _IP6.finditer(text)]
    for m in _CUED.finditer(text):
        a = m.start(3)
        b = a + len(m.group(3).rstrip(".=-"))
        if b - a >= 8:
            # words may follow "key:" in prose, so only names of nothing else decide
            sure = m.group(2) == "=" and m.group(1).lower() not in ("key", "token")
            out.append((4, a, b, 1 if sure else -1, _features(text, 4, a, b)))
    if not _DIGIT.search(text):
        return out
    for m in _CHAIN.finditer(text):
        a, b = m.span()
        digits = len(_NOT_DIGIT.sub("", m.group()))
        kind = 2 if digits >= 13 else 3
        f = _features(text, kind, a, b)
        out.append((kind, a, b, _chain_label(text, kind, a, b, f, held.touched(a, b)), f))
    last = 0
    for m in _DIGIT.finditer(text):
        if m.start() < last:
            continue
        a = m.start()
        while a > last and text[a - 1] in _TOKEN_CHARS:
            a -= 1
        b = _TOKEN.match(text, a).end()
        last = b
        b = a + len(text[a:b].rstrip(".=-"))
        if b - a < 8 or not any(c.isalpha() for c in text[a:b]):
            continue
        f = _features(text, 4, a, b)
        assigned = f[9] == 1 and f[10] == 1
        out.append((4, a, b, 1 if assigned else 0, f))
    return out


# Boosted trees ----------------------------------------------------------------

def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, float]:
    best = (1e-6, -1, 0.0)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1], method="nearest"))
        for c in cuts:
            left = x[:, j] <= c
            gl, hl = g[left].sum(), h[left].sum()
            gr, hr = g.sum() - gl, h.sum() - hl
            gain = gl * gl / (hl + 1.0) + gr * gr / (hr + 1.0) - whole
            if gain > best[0]:
                best = (float(gain), j, float(c))
    return best


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    _, j, c = _best_split(x, g, h) if depth and len(x) > 8 else (0, -1, 0)
    if j < 0:
        return float(g.sum() / (h.sum() + 1.0)) if len(x) else 0.0
    left = x[:, j] <= c
    return j, c, _grow(x[left], g[left], h[left], depth - 1), _grow(x[~left], g[~left], h[~left], depth - 1)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, c, low, high = tree
    return np.where(x[:, j] <= c, _apply(low, x), _apply(high, x))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = 3) -> list:
    """Newton boosting of the logistic loss; trees are nested (feature, cut, low, high).

    The plain version, on rows in memory; ``fit`` boosts on counts that stay on the executors.
    """
    score, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, y - p, p * (1 - p), depth)
        trees.append(tree)
        score += RATE * _apply(tree, x)
    return trees


def predict(trees: list, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-sum(RATE * _apply(t, x) for t in trees)))


def calibrate(p: np.ndarray, y: np.ndarray, kind: np.ndarray, n: np.ndarray) -> tuple[list[float], list[bool]]:
    """For each kind the lowest threshold whose held-out precision reaches ``PRECISION`` (infinity if none does),
    and whether it has so few positive cases that its validator decides instead; a row stands for ``n`` cases."""
    out, few = [], []
    for k in range(len(KINDS)):
        own = kind == k
        order = np.argsort(-p[own], kind="stable")
        pk, nk, right = p[own][order], n[own][order], (y * n)[own][order]
        few.append(bool(right.sum() < LEAST_CONFIRMED))
        last = np.append(pk[1:] != pk[:-1], True) if len(pk) else np.zeros(0, bool)
        ok = last & (np.cumsum(right) >= PRECISION * np.cumsum(nk)) & (np.cumsum(right) >= LEAST_CONFIRMED)
        ok &= pk >= 0.5
        out.append(0.5 if few[-1] else float(pk[np.flatnonzero(ok)[-1]]) if ok.any() else math.inf)
    return out, few


def _least(rows: list[tuple], each: int) -> list[tuple]:
    """Of rows (kind, label, addable, hash, ...) the ``each`` smallest of every kind, label and addable."""
    out, n, last = [], 0, None
    for r in sorted(rows):
        n = n + 1 if r[:3] == last else 1
        last = r[:3]
        if n <= each:
            out.append(r)
    return out


def training_rows(docs: DataFrame, id_col: str, text_col: str, each: int) -> list[tuple]:
    """(kind, label, addable, hash, held out, features): the ``each`` smallest hashes of every kind, label and addable.

    Proposals to look at or to label by hand; ``fit`` counts them all.
    """
    rank = F.xxhash64(F.lit(8), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    ranked = docs.select(rank.alias("rank"), F.col(f"`{text_col}`").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, fresh = [], 0
        for batch in pieces(batches, "text"):
            for rank_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base = base_spans(text or "")
                held = _Held(base)
                found = [x for x in proposals(text or "", base) if x[3] >= 0]
                if not found:
                    continue
                at = np.array([x[1] * len(KINDS) + x[0] for x in found], np.int64).view(np.uint64)
                hashes = mix64(mix64(at) ^ np.array([rank_], np.int64).view(np.uint64)) >> np.uint64(1)
                kept += [(k, label, not held.touched(a, b), int(h), bool(rank_ & 1), f)
                         for (k, a, b, label, f), h in zip(found, hashes, strict=True)]
                fresh += len(found)
                if fresh > 16 * each:  # what no task needs is dropped, so memory is bounded
                    kept, fresh = _least(kept, each), 0
        cols = list(zip(*_least(kept, each), strict=True)) if kept else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         ["kind", "label", "addable", "hash", "held_out", "features"])

    found = materialize(ranked.mapInArrow(rows, "kind long, label long, addable boolean, hash long, held_out boolean, "
                                                "features array<double>"), "pii-proposals")
    group = ["kind", "label", "addable"]
    part = F.shiftright("hash", 63 - 12).alias("part")
    counts = found.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 20 groups x 4096 parts
    ends: dict[tuple, int] = {}
    so_far: dict[tuple, int] = {}
    for *of, part_, n in sorted(tuple(r) for r in counts):
        if so_far.get(tuple(of), 0) < each:
            ends[tuple(of)] = part_
        so_far[tuple(of)] = so_far.get(tuple(of), 0) + n
    wanted = F.lit(False)
    for (k, label, addable), end in ends.items():
        wanted = wanted | ((F.col("kind") == k) & (F.col("label") == label) & (F.col("addable") == addable) & (part <= end))
    return _least([tuple(r) for r in found.filter(wanted).collect()], each)


def binned(x: np.ndarray) -> np.ndarray:
    """The bin of every feature: ``x <= EDGES[j][b]`` if and only if the bin is at most ``b``."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(EDGES)], 1).astype(np.uint8)


def unbinned(bins: np.ndarray) -> np.ndarray:
    """The upper edges of the bins, which a tree that cuts at edges sends where it sends the features themselves."""
    return np.stack([np.append(e, np.inf)[bins[:, j]] for j, e in enumerate(EDGES)], 1)


def cells(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``bins, label, addable, held_out, n``: all decided proposals of the table, counted by their bins."""
    rank = F.xxhash64(F.lit(8), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    ranked = docs.select(rank.alias("rank"), F.col(f"`{text_col}`").alias("text"))
    keys = ["bins", "label", "addable", "held_out"]

    def as_batch(counts: Counter) -> pa.RecordBatch:
        cols = list(zip(*counts, strict=True))
        kinds = [pa.binary(), pa.int64(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)),
                                           pa.array(counts.values(), pa.int64())], [*keys, "n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in pieces(batches, "text"):
            found, x = [], []
            for rank_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base = base_spans(text or "")
                held = _Held(base)
                for _, a, b, label, f in proposals(text or "", base):
                    if label >= 0:
                        found.append((label, not held.touched(a, b), bool(rank_ & 1)))
                        x.append(f)
            if found:
                counts.update((b.tobytes(), *rest) for b, rest in zip(binned(np.array(x)), found, strict=True))
            if len(counts) > _HELD_CELLS:
                yield as_batch(counts)
                counts.clear()
        if counts:
            yield as_batch(counts)

    found = ranked.mapInArrow(rows, "bins binary, label long, addable boolean, held_out boolean, n long")
    return found.groupBy(*keys).agg(F.sum("n").alias("n"))


def _group(kind: np.ndarray, label: np.ndarray, addable: np.ndarray) -> np.ndarray:
    return (kind.astype(int) * 2 + label) * 2 + addable


def _cell_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(bins, label, addable, n) of many batches at once."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[np.ndarray, ...]:
        t = pa.Table.from_batches(held)
        bins = np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, N_FEATURES)
        return bins, *(t.column(c).to_numpy() for c in ("label", "addable", "n"))

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= _HELD_CELLS:
            yield joined()
            held = []
    if sum(map(len, held)):
        yield joined()


def level_sums(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: list, growing, nodes: int) -> np.ndarray:
    """Weight, gradient and curvature by node of the ``growing`` tree, feature and bin, in whole ``1 / _UNIT``."""
    x = unbinned(bins)
    p = predict(trees, x) if trees else np.full(len(x), 0.5)
    node = _apply(growing, x).astype(int)
    own = node >= 0
    out = np.zeros((nodes, N_FEATURES, BINS, 3))
    for i, v in enumerate((weight, weight * (y - p), weight * p * (1 - p))):
        v = np.rint(v * _UNIT)[own]
        for j in range(N_FEATURES):
            out[:, j, :, i] = np.bincount(node[own] * BINS + bins[own, j], v, nodes * BINS).reshape(nodes, BINS)
    return out


def _cut(sums: np.ndarray) -> tuple[int, int] | None:
    """(feature, bin) of the best cut of a node by its sums, if it has one."""
    mass, g, h = sums[0].sum(0) / _UNIT
    best = (1e-6, None)
    if mass <= 8:
        return None
    for j, edges in enumerate(EDGES):
        _, gl, hl = np.cumsum(sums[j, :len(edges)], 0).T / _UNIT
        gain = gl * gl / (hl + 1.0) + (g - gl) ** 2 / (h - hl + 1.0) - g * g / (h + 1.0)
        b = int(np.argmax(gain))
        if gain[b] > best[0]:
            best = (float(gain[b]), (j, b))
    return best[1]


def _leaf(sums: np.ndarray) -> float:
    _, g, h = sums.sum(0) / _UNIT
    return float(g / (h + 1.0))


def grow(sums_of: Callable, depth: int = DEPTH):
    """A tree, level by level; ``sums_of(tree, nodes)`` gives the sums at the nodes under way, whose leaves hold their
    numbers (others -1)."""
    done: dict[int, object] = {}  # by number in a heap: (feature, bin) of a cut, or a leaf's value

    def shaped(i: int, leaf: Callable):
        if isinstance(done.get(i), tuple):
            j, b = done[i]
            return j, float(EDGES[j][b]), shaped(2 * i, leaf), shaped(2 * i + 1, leaf)
        return leaf(i)

    under_way = [1]
    for level in range(depth):
        at = {i: float(k) for k, i in enumerate(under_way)}
        if not at:
            break
        following = []
        sums = sums_of(shaped(1, lambda i: at.get(i, -1.0)), len(at))
        for i, own in zip(under_way, sums, strict=True):
            cut = _cut(own)
            done[i] = cut or _leaf(own[0])
            if cut:
                j, b = cut
                done[2 * i], done[2 * i + 1] = _leaf(own[j, :b + 1]), _leaf(own[j, b + 1:])
                following += [2 * i, 2 * i + 1]
        under_way = following
    return shaped(1, done.__getitem__)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = TRAIN_EACH) -> dict:
    """Fit and calibrate on all proposals; no kind, label and addable weighs more than ``each``."""
    bound_batches(docs)
    found = materialize(cells(docs, id_col, text_col), "pii-cells")
    kind = F.conv(F.hex(F.substring("bins", 1, 1)), 16, 10).cast("int").alias("kind")
    groups = found.groupBy(kind, "label", "addable", "held_out").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells")).collect()  # at most 40
    train = [g for g in groups if not g["held_out"]]
    if len({g["label"] for g in train}) < 2:
        return {"trees": [], "thresholds": [0.5] * len(KINDS), "few": [True] * len(KINDS)}
    size = np.zeros(4 * len(KINDS))
    for g in groups:
        size[_group(np.array(g["kind"]), g["label"], g["addable"])] += g["n"]
    share = np.minimum(1.0, each / np.maximum(size, 1))
    # read once for every level of a tree, so in few files, however many partitions dealt the cells
    parts = spread(sum(g["cells"] for g in groups), 4 * _HELD_CELLS)
    fitted = materialize(found.filter("NOT held_out").coalesce(parts), "pii-fitted")
    trees: list = []

    def sums_of(growing, nodes: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((nodes, N_FEATURES, BINS, 3))
            for bins, label, addable, n in _cell_arrays(batches):
                weight = n * share[_group(bins[:, 0], label, addable)]
                total += level_sums(bins, label, weight, trees, growing, nodes)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        parts_ = fitted.mapInArrow(run, "sums binary").collect()  # one of fixed size from each task
        return sum(np.frombuffer(r["sums"]) for r in parts_).reshape(nodes, N_FEATURES, BINS, 3)

    for _ in range(ROUNDS):
        trees.append(grow(sums_of))

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, label, _, n in _cell_arrays(batches):
            level = np.floor(predict(trees, unbinned(bins)) * LEVELS).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins[:, 0].astype(np.int64)), pa.array(label), pa.array(np.maximum(level, LEVELS // 2 - 1)),
                 pa.array(n)], ["kind", "label", "level", "n"])

    own = found.filter("held_out AND addable").coalesce(parts)
    scored = own.mapInArrow(levels, "kind long, label long, level long, n long").groupBy("kind", "label", "level").agg(
        F.sum("n").alias("n")).collect()  # at most two for each kind and level
    k, y, level, n = np.array([tuple(r) for r in scored], np.int64).reshape(-1, 4).T
    thresholds, few = calibrate(level / LEVELS, y, k, n)
    return {"trees": trees, "thresholds": thresholds, "few": few}


def all_spans(texts: list[str], model: dict) -> list[tuple[list, list]]:
    """For each text its base spans and all spans, each ordered by kind, then start."""
    bases = [base_spans(t) for t in texts]
    found = [(i, k, a, b, f, label) for i, t in enumerate(texts) for k, a, b, label, f in proposals(t, bases[i])
             if math.isfinite(model["thresholds"][k])]
    spans, held = [list(b) for b in bases], {}
    if found:
        p = predict(model["trees"], np.array([x[4] for x in found])) if model["trees"] else np.zeros(len(found))
        few = np.array(model["few"])[[x[1] for x in found]]
        p = np.where(few, [float(x[5] == 1) for x in found], p)
        for (i, k, a, b, *_), score in sorted(zip(found, p, strict=True), key=lambda x: (-x[1], x[0][:4])):
            if i not in held:
                held[i] = _Held(bases[i])
            own = held[i]
            if score >= model["thresholds"][k] and not own.touched(a, b):
                own.add(k, a, b)
                spans[i].append((k, a, b))
    return [(b, sorted(s)) for b, s in zip(bases, spans, strict=True)]


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each run of overlapping spans becomes ``[KIND]`` of its first span."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_JOINED = "{}:{}:{}".format


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """``doc, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted``: one row per input row.

    ``doc`` is the input row without its text.
    """
    bound_batches(docs)
    model = fit(docs, id_col, text_col) if model is None else model
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("doc") if others else F.lit(None).alias("doc"),
                       F.col(f"`{text_col}`").alias("text"))
    out = T.StructType([T.StructField("doc", rows.schema["doc"].dataType),
                        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:4]),
                        *(T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted"))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = batch.column(1).to_pylist()
            found = all_spans([t or "" for t in texts], model)
            counts = [[sum(k == i for k, _, _ in b) for b, _ in found] for i in range(4)]
            joined = [",".join(_JOINED(KINDS[k], x, y) for k, x, y in b) for b, _ in found]
            everything = [",".join(_JOINED(KINDS[k], x, y) for k, x, y in s) for _, s in found]
            clean = [t if not s else redact(t, s) for t, (_, s) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(j.encode()).hexdigest() for j in joined], pa.string()),
                 pa.array(everything, pa.string()), pa.array(clean, pa.string())],
                ["doc", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"])

    return rows.mapInArrow(scan, out)


def redacted_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  chars_col: str | None = "n_chars") -> DataFrame:
    """The input's columns with every span of the text replaced, and the number of characters set anew."""
    found = find(docs, id_col, text_col)

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("redacted").alias(c)
        if c == chars_col:
            return F.length("redacted").cast(docs.schema[c].dataType).alias(c)
        return F.col("doc").getField(c).alias(c)

    return found.select(*[column(c) for c in docs.columns])
