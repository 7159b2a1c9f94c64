"""Segmentation lattices of a SentencePiece model, for many words at once.

A text is written the way the model sees it: a blank before it, blanks as the
model's space mark.  No piece has a space mark after another character, so a text falls apart into
*units* (space marks and what follows up to the next), and the lattice of a
text is the chain of its units' lattices.  Each distinct unit of a batch is
analysed once, with array operations over all of them.

Piece weights: a model trained by merges has ranks, not probabilities, so the
piece of rank r weighs 1 / (1 + r).  A character without a piece of its own is written as
the byte pieces of its UTF-8 form; so is a space mark that stands in the text itself.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd

from .common import Rolling, mix64, spans_to_index

MARK = 0x2581
LITERAL_MARK = 0x110000  # a space mark of the text itself
_FILTER_BITS = 22


class Pieces:
    """The model's pieces: lookup by content, weights, bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        kinds = [(model.is_control(i) or model.is_unknown(i) or model.is_unused(i), model.is_byte(i)) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        normal = np.array([i for i, (off, byte) in enumerate(kinds) if not off and not byte])
        self.byte_ids = np.zeros(256, np.int64)
        for i, (_, byte) in enumerate(kinds):
            if byte:
                self.byte_ids[int(names[i][3:5], 16)] = i
        score = np.array([model.get_score(int(i)) for i in normal])
        rank = np.empty(len(normal))
        rank[np.lexsort((normal, -score))] = np.arange(len(normal))
        weight = -np.log1p(rank)
        self.byte_weight = -np.log1p(len(normal) + 1.0)
        cps = np.frombuffer("".join(names[i] for i in normal).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(names[i]) for i in normal])
        ends = np.cumsum(sizes)
        hashes = Rolling(cps).of(ends - sizes, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.weights = hashes[order], normal[order], weight[order]
        self.longest = int(sizes.max())
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        raw = [bytes([int(x[3:5], 16)]) if byte else b"" if off else x.replace(chr(MARK), " ").encode()
               for x, (off, byte) in zip(names, kinds, strict=True)]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.byte_counts = np.array([len(r) for r in raw])
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the pieces with these hashes, -1 where there is none."""
        out = np.full(len(hashes), -1)
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        out[some[hit]] = at[hit]
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids, without the blank before it."""
        sizes = self.byte_counts[ids]
        data = self.bytes[spans_to_index(self.byte_starts[ids], sizes)].tobytes()
        so_far = np.concatenate([[0], np.cumsum(sizes)])
        ends = so_far[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a + 1:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


@functools.cache
def load_pieces(path: str) -> Pieces:
    """The pieces of a model, read once in the life of a Python worker."""
    return Pieces(path)


def written(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as the model sees them, one after another, and where each begins (an empty text stays empty)."""
    lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    cps = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), np.uint32).copy()
    cps[cps == MARK] = LITERAL_MARK
    cps[cps == 0x20] = MARK
    return cps, np.concatenate([[0], np.cumsum(lengths)])


def unit_starts(cps: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    cut = cps == MARK
    cut[1:] &= cps[:-1] != MARK
    cut[text_starts[:-1][np.diff(text_starts) > 0]] = True
    return np.flatnonzero(cut)


class Lattices:
    """The lattices of all units of a batch; ``unit_of`` gives the place of each occurrence's unit.

    Nodes are numbered through all distinct units, from ``first_node`` to
    ``last_node`` of each.  Edges are sorted by their first node, long ones
    first; ``log_p`` is an edge's log probability given its node, ``so_far``
    the sum of the probabilities up to and with it.
    """

    def __init__(self, pieces: Pieces, cps: np.ndarray, starts: np.ndarray):
        stops = np.append(starts[1:], len(cps))
        self.unit_of, hashes = pd.factorize(Rolling(cps).of(starts, stops))
        sample = np.zeros(len(hashes), np.int64)
        sample[self.unit_of] = np.arange(len(starts))
        sizes = (stops - starts)[sample]
        own = cps[spans_to_index(starts[sample], sizes)]
        ends = np.cumsum(sizes)
        units = np.arange(len(sizes))
        self.first_node = ends - sizes + units
        self.last_node = ends + units
        unit = np.repeat(units, sizes)
        self._edges(pieces, own, ends[unit], unit)
        self._probabilities(int(self.last_node[-1]) + 1 if len(units) else 0, sizes)

    def _edges(self, pieces: Pieces, own: np.ndarray, stop: np.ndarray, unit: np.ndarray) -> None:
        rolling, n = Rolling(own), len(own)
        room = stop - np.arange(n)
        begin, sizes, piece = [], [], []
        bare = np.zeros(0, np.int64)
        for size in range(min(pieces.longest, int(room.max(initial=1))), 0, -1):
            at = np.flatnonzero(room >= size)
            found = pieces.find(rolling.of(at, at + size))
            hit = found >= 0
            if size == 1:
                bare = at[~hit]
            begin.append(at[hit].astype(np.int32))
            sizes.append(np.full(int(hit.sum()), size, np.int32))
            piece.append(found[hit].astype(np.int32))
        raw = [(chr(MARK) if c == LITERAL_MARK else chr(c)).encode() for c in own[bare].tolist()]
        begin = np.concatenate([*begin, bare.astype(np.int32)])
        sizes = np.concatenate([*sizes, np.ones(len(bare), np.int32)])
        piece = np.concatenate([*piece, -1 - np.arange(len(bare), dtype=np.int32)])
        order = np.argsort(begin, kind="stable")  # a node's longest edge, the likeliest by and large, comes first
        begin, sizes, piece = begin[order], sizes[order], piece[order]
        # a character without a piece: the ids of its bytes, kept behind those of the pieces
        spelled = np.array([len(r) for r in raw], np.int64)
        self.ids = np.concatenate([pieces.ids, pieces.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]])
        lone = piece < 0
        which = -1 - piece[lone]
        self.id_counts = np.ones(len(piece), np.int32)
        self.id_counts[lone] = spelled[which]
        self.id_starts = piece.copy()
        self.id_starts[lone] = len(pieces.ids) + (np.cumsum(spelled) - spelled)[which]
        self.weight = pieces.weights[piece]
        self.weight[lone] = pieces.byte_weight * spelled[which]
        self.begin = begin + unit[begin].astype(np.int32)
        self.end = self.begin + sizes

    def _probabilities(self, nodes: int, sizes: np.ndarray) -> None:
        # log of the summed weights of all ways from a node to the end of its unit, from the ends on
        each = np.bincount(self.begin, minlength=nodes)
        self.first_edge = np.concatenate([[0], np.cumsum(each)])
        rest = np.zeros(nodes)
        ends = self.last_node[np.argsort(-sizes, kind="stable")]
        longer = len(sizes) - np.cumsum(np.bincount(sizes))  # units of more than so many characters
        for k in range(1, len(longer)):
            level = ends[:longer[k - 1]] - k
            count = each[level]
            own = spans_to_index(self.first_edge[level], count)
            value = self.weight[own] + rest[self.end[own]]
            cut = np.cumsum(count) - count
            most = np.maximum.reduceat(value, cut)
            rest[level] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, count)), cut))
        self.log_p = np.minimum(self.weight + rest[self.end] - rest[self.begin], 0.0)
        del self.weight
        total = np.concatenate([[0.0], np.cumsum(np.exp(self.log_p))])
        self.so_far = total[1:] - total[self.first_edge[self.begin]]
        # rounding never leaves a node without an edge
        self.so_far[self.first_edge[1:][each > 0] - 1] = np.inf

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node, by its uniform number."""
        edge = self.first_edge[nodes]
        left = np.flatnonzero(u >= self.so_far[edge])
        while len(left):
            edge[left] += 1
            left = left[u[left] >= self.so_far[edge[left]]]
        return edge

    def ids_of(self, edges: np.ndarray) -> np.ndarray:
        return self.ids[spans_to_index(self.id_starts[edges], self.id_counts[edges])]


class KnownUnits(Lattices):
    """The lattices of all units met so far, so that a unit is analysed once and not once per batch.

    ``meet`` adds the units of further texts and sets ``unit_of`` for them.  Once there are
    ``most_nodes`` nodes it starts anew with the units of the texts at hand, so what it
    holds is bounded by that and by one batch.
    """

    def __init__(self, pieces: Pieces, most_nodes: int):
        self.pieces, self.most_nodes = pieces, most_nodes
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.n_nodes = 0

    def meet(self, cps: np.ndarray, starts: np.ndarray) -> None:
        if self.n_nodes >= self.most_nodes:
            self._clear()
        stops = np.append(starts[1:], len(cps))
        codes, hashes = pd.factorize(Rolling(cps).of(starts, stops))
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        place = np.zeros(len(hashes), np.int64)
        place[known] = self.places[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            sample = np.zeros(len(hashes), np.int64)
            sample[codes] = np.arange(len(starts))
            sizes = (stops - starts)[sample[fresh]]
            own = cps[spans_to_index(starts[sample[fresh]], sizes)]
            new = Lattices(self.pieces, own, np.cumsum(sizes) - sizes)
            place[fresh[new.unit_of]] = self._append(new)[new.unit_of]
            self.hashes, self.places = np.append(self.hashes, hashes[fresh]), np.append(self.places, place[fresh])
            order = np.argsort(self.hashes)
            self.hashes, self.places = self.hashes[order], self.places[order]
        self.unit_of = place[codes]

    def _append(self, new: Lattices) -> np.ndarray:
        """Put further lattices behind those at hand; the places of their units."""
        n_units = len(new.first_node)
        if not self.n_nodes:
            for name in ("first_node", "last_node", "begin", "end", "first_edge", "id_counts", "id_starts", "log_p",
                         "so_far", "ids"):
                setattr(self, name, getattr(new, name))
            before = 0
        else:
            before, edges = len(self.first_node), len(self.begin)
            spelled = len(self.ids) - len(self.pieces.ids)
            moved = np.where(new.id_starts < len(self.pieces.ids), new.id_starts, new.id_starts + spelled)
            joined = {"first_node": new.first_node + self.n_nodes, "last_node": new.last_node + self.n_nodes,
                      "begin": new.begin + np.int32(self.n_nodes), "end": new.end + np.int32(self.n_nodes),
                      "id_counts": new.id_counts, "id_starts": moved, "log_p": new.log_p, "so_far": new.so_far,
                      "ids": new.ids[len(self.pieces.ids):]}
            for name, values in joined.items():
                setattr(self, name, np.concatenate([getattr(self, name), values]))
            self.first_edge = np.concatenate([self.first_edge[:-1], new.first_edge + edges])
        self.n_nodes = int(self.last_node[-1]) + 1
        return np.arange(before, before + n_units)


def streams(keys: np.ndarray, purpose: int, sample: int) -> np.ndarray:
    """One stream of random numbers for each key, purpose and sample."""
    return mix64(mix64(keys.view(np.uint64)) + np.uint64(purpose * 1_000_003 + sample))


def uniforms(stream: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The numbers of streams at the given places, in (0, 1)."""
    state = mix64(stream + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((state >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
