"""Operator 3, SentencePiece encoding and decoding: segmentations sampled without replacement.

Gumbel top-k over the segmentation lattice, found by a perturbed A-star search.
Probabilities are exact: each edge's given its node, from the summed weights of
all ways to the end (the search's heuristic, which is exact).  A search node is
a prefix, with a perturbed value: the largest Gumbel-perturbed log
probability of any segmentation behind it.  The best node is expanded along one
whole segmentation, which inherits its value; at every node on the way the
alternatives not taken form one new search node, whose value is a Gumbel variable truncated
at the parent's.  The k best values are k distinct segmentations, sampled
without replacement, and the (k + 1)-th, kappa, gives their inclusion
scores: log(1 - exp(-exp(log p - kappa))).

Random numbers depend on the row's key and on places in the text only, so batches,
partitions and retries do not change a sample.  No shuffle; texts are processed
whole, a bounded number of bytes at a time.

Decoding turns ids back into the text exactly, also where the model has no
piece for a character.

Edge cases: a null or empty text has one segmentation, the empty one, with
inclusion 1; a text with fewer than k segmentations yields all it has, each with
inclusion 1; rows with equal id and text have equal samples; null ids are a key
like any other; a text of any length is one row and processed whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .common import pieces as byte_pieces
from .common import spans_to_index
from .lattice import KnownUnits, Pieces, load_pieces, streams, uniforms, unit_starts, written

SAMPLES = 2
SEED = 3
BATCH_BYTES = 1 << 19  # of text searched at a time
MOST_NODES = 1 << 19  # of unit lattices that a task keeps
_WALK, _ROOT, _REST, _TURN, _LEFT = range(5)


def _truncated(location, bound, u):
    """A Gumbel variable of the given location that stays below ``bound``."""
    with np.errstate(divide="ignore"):
        return location - np.log(np.exp(np.minimum(location - bound, 700.0)) - np.log(u))


class Search:
    """The searches of all texts of a batch, one segmentation of every text at a time."""

    def __init__(self, pieces: Pieces | KnownUnits, texts: list[str], keys: np.ndarray, seed: int):
        known = pieces if isinstance(pieces, KnownUnits) else KnownUnits(pieces, 0)
        self.keys = keys.astype(np.int64) ^ np.int64(seed)
        cps, starts = written(texts)
        units = unit_starts(cps, starts) if len(cps) else np.zeros(0, np.int64)
        if len(units):
            known.meet(cps, units)
        self.lattice = known if len(units) else None
        self.units, self.text_starts = units, starts
        self.first_unit = np.searchsorted(units, starts)  # of each text, among all occurrences
        n = len(texts)
        self.nodes: list[list[tuple]] = [[] for _ in range(n)]  # (value, path, place in it, edges excluded)
        self.paths: list[list[tuple]] = [[] for _ in range(n)]  # (edges, units, log p before each, value, log p)

    def _walk(self, units: np.ndarray, texts: np.ndarray, nodes: np.ndarray, sample: int):
        """Edges from each node to the end of its unit, flat, with their number per unit."""
        lat, n = self.lattice, len(units)
        last = lat.last_node[lat.unit_of[units]]
        stream = streams(self.keys, _WALK, sample)[texts]
        # a node's place in its text
        shift = self.units[units] - self.text_starts[texts] - lat.first_node[lat.unit_of[units]]
        counts, steps = np.zeros(n, np.int64), []
        active = np.flatnonzero(nodes != last)
        now = nodes[active]
        while len(active):
            edge = lat.draw(now, uniforms(stream[active], now + shift[active]))
            steps.append((active, edge))
            counts[active] += 1
            now = lat.end[edge]
            keep = now != last[active]
            active, now = active[keep], now[keep]
        offset = np.cumsum(counts) - counts
        edges = np.empty(int(counts.sum()), np.int64)
        for step, (active, edge) in enumerate(steps):
            edges[offset[active] + step] = edge
        return edges, counts

    def _extend(self, sample: int, texts: np.ndarray, units: list[np.ndarray], first: np.ndarray, value: np.ndarray,
                heads: list[tuple], keep: int) -> None:
        """Walk on from ``first`` through the units of each text; store the paths and the best new search nodes."""
        lat = self.lattice
        sizes = np.array([len(u) for u in units], np.int64)
        flat_units = np.concatenate(units) if len(units) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        nodes = lat.first_node[lat.unit_of[flat_units]]
        begin = (np.cumsum(sizes) - sizes)[sizes > 0]
        nodes[begin] = first[sizes > 0]
        edges, counts = self._walk(flat_units, texts[owner], nodes, sample)
        unit_of_edge = np.repeat(flat_units, counts)
        owner = np.repeat(owner, counts)
        log_p = lat.log_p[edges]
        total = np.concatenate([[0.0], np.cumsum(log_p)])
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        done = np.array([h[2] for h in heads])
        before = total[:-1] - total[bounds[owner]] + done[owner]
        with np.errstate(divide="ignore"):
            location = before + np.log(-np.expm1(log_p))
        place = np.arange(len(edges)) - bounds[owner] + np.array([len(h[0]) for h in heads], np.int64)[owner]
        rest = _truncated(location, value[owner], uniforms(streams(self.keys, _REST, sample)[texts][owner], place))
        best = self._best(rest, bounds, keep)
        for i, t in enumerate(texts.tolist()):
            a, b = int(bounds[i]), int(bounds[i + 1])
            head_edges, head_units, log_before, head_before = heads[i]
            path = (np.concatenate([head_edges, edges[a:b]]), np.concatenate([head_units, unit_of_edge[a:b]]),
                    np.concatenate([head_before, before[a:b]]), float(value[i]),
                    float(log_before + (total[b] - total[a])))
            j, offset = len(self.paths[t]), len(head_edges)
            self.paths[t].append(path)
            for at in best[i]:
                where = at - a + offset
                self.nodes[t].append((float(rest[at]), j, where, (int(path[0][where]),)))

    @staticmethod
    def _best(values: np.ndarray, bounds: np.ndarray, keep: int) -> list[list[int]]:
        """Places of the ``keep`` largest values of each run, those of no value left out."""
        out: list[list[int]] = [[] for _ in range(len(bounds) - 1)]
        rows = np.flatnonzero(np.diff(bounds) > 0)
        values = values.copy()
        for _ in range(keep if len(rows) else 0):
            most = np.maximum.reduceat(values, bounds[rows])
            hit = np.flatnonzero(values == np.repeat(most, np.diff(bounds)[rows]))
            first = hit[np.searchsorted(hit, bounds[rows])]
            for r, at, value in zip(rows.tolist(), first.tolist(), most.tolist(), strict=True):
                if value > -np.inf:
                    out[r].append(at)
            values[first] = -np.inf
        return out

    def run(self, samples: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text its segmentations: (edges, log p, perturbed value, log inclusion)."""
        n = len(self.nodes)
        filled = np.flatnonzero(np.diff(self.first_unit) > 0)
        empty = np.zeros(0, np.int64)
        none = empty, empty, 0.0, np.zeros(0)
        if len(filled):
            root = -np.log(-np.log(uniforms(streams(self.keys, _ROOT, 0)[filled], filled * 0)))
            units = [np.arange(self.first_unit[t], self.first_unit[t + 1]) for t in filled]
            first = self.lattice.first_node[self.lattice.unit_of[self.first_unit[filled]]]
            self._extend(0, filled, units, first, root, [none] * len(filled), samples + 1)
        for sample in range(1, samples):
            self._expand(sample, [int(t) for t in filled if self.nodes[t]], samples + 1 - sample)
        out = []
        for t in range(n):
            if not self.paths[t]:
                out.append([(empty, 0.0, 0.0, 0.0)])
                continue
            kappa = max((x[0] for x in self.nodes[t]), default=-np.inf)
            rows = []
            for edges, _, _, value, log_p in self.paths[t]:
                # log(1 - exp(-exp(x))) is x where exp(x) is next to nothing
                x = log_p - kappa if kappa > -np.inf else np.inf
                inclusion = x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))
                rows.append((edges, log_p, value, inclusion))
            out.append(rows)
        return out

    def _expand(self, sample: int, texts: list[int], keep: int) -> None:
        """Take the best search node of each text, turn at it, and walk to the end."""
        lat = self.lattice
        heads, units, first, values = [], [], [], []
        zero = np.zeros(len(self.keys), np.int64)
        turns, lefts = (uniforms(streams(self.keys, purpose, sample), zero) for purpose in (_TURN, _LEFT))
        for t in texts:
            own = self.nodes[t]
            at = max(range(len(own)), key=lambda i: own[i][0])
            value, j, place, excluded = own.pop(at)
            edges, path_units, before, _, _ = self.paths[t][j]
            node = int(lat.begin[edges[place]])
            options = [e for e in range(int(lat.first_edge[node]), int(lat.first_edge[node + 1])) if e not in excluded]
            p = np.exp(lat.log_p[options])
            u, u_left = turns[t], lefts[t]
            turn = options[min(int(np.searchsorted(np.cumsum(p), u * p.sum(), "right")), len(options) - 1)]
            left = float(p.sum() - np.exp(lat.log_p[turn])) if len(options) > 1 else 0.0
            if left > 0:
                again = _truncated(before[place] + np.log(left), value, u_left)
                own.append((float(again), j, place, (*excluded, turn)))
            unit = int(path_units[place])
            heads.append((np.append(edges[:place], turn), np.append(path_units[:place], unit),
                          float(before[place] + lat.log_p[turn]), before[:place + 1]))
            units.append(np.arange(unit, self.first_unit[t + 1]))
            first.append(int(lat.end[turn]))
            values.append(value)
        if texts:
            self._extend(sample, np.array(texts), units, np.array(first), np.array(values), heads, keep)


_OUT = ("doc_id long, sample int, ids array<int>, n_ids long, log_p double, value double, log_inclusion double, "
        "decodes boolean")


def sample_segmentations(docs: DataFrame, model: str, samples: int = SAMPLES, id_col: str = "doc_id",
                         text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per document and sample: ``ids``, the largest perturbed value first.

    ``decodes`` says whether the ids give the text back.
    """
    bound_batches(docs)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text).alias("key"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model)
        known = KnownUnits(pieces, MOST_NODES)
        for batch in byte_pieces(batches, "text", BATCH_BYTES):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            search = Search(known, texts, batch.column(1).to_numpy(), seed)
            found = search.run(samples)
            each = [len(f) for f in found]
            flat = [s for f in found for s in f]
            edges = np.concatenate([s[0] for s in flat])
            lat = search.lattice
            ids = lat.ids_of(edges) if lat else np.zeros(0, np.int64)
            per_edge = np.concatenate([[0], np.cumsum(lat.id_counts[edges])]) if lat else np.zeros(1, np.int64)
            ends = per_edge[np.cumsum([0] + [len(s[0]) for s in flat])]
            counts = np.diff(ends)
            which = np.repeat(np.arange(len(texts)), each)
            raw = [t.encode() for t in texts]
            decoded = pieces.decode(ids, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)),
                 pa.array(spans_to_index(np.zeros(len(each), np.int64), np.array(each)), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                 pa.array(counts, pa.int64()), *(pa.array([s[c] for s in flat], pa.float64()) for c in (1, 2, 3)),
                 pa.array([d == raw[w] for d, w in zip(decoded, which, strict=True)], pa.bool_())],
                [c.split()[0] for c in _OUT.split(", ")])

    return rows.mapInArrow(run, _OUT)


def decode_texts(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, sample, text``: the texts of encoded rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model)
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            ids = lists.values.to_numpy()[ends[0]:ends[-1]].astype(np.int64)
            texts = [d.decode() for d in pieces.decode(ids, np.diff(ends))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["doc_id", "sample", "text"])

    return encoded.select("doc_id", "sample", "ids").mapInArrow(run, "doc_id long, sample int, text string")
