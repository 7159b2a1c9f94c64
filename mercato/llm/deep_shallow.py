"""Deep-shallow string sorting.

Strings are split by multikey quicksort, one 8-byte word at a time, down to a
shallow depth.  Strings that still agree there, which usually agree far longer, are
ordered by a blind trie: an insertion compares a string with one leaf only and
needs no byte of any other.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32
_SMALL = 3


def common_prefix(a: bytes, b: bytes) -> int:
    """The number of leading bytes that two strings share."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth = depth
        self.children: dict[int, object] = {}  # next byte, or -1 where a string ends, to a node or a list of places


class BlindTrie:
    """Orders strings by their branching bytes alone; equal strings share a leaf."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: object | None = None

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def insert(self, place: int) -> None:
        s = self.strings[place]
        if self.root is None:
            self.root = [place]
            return
        node = self.root
        while isinstance(node, _Node):  # blindly, to any leaf
            node = node.children.get(self._byte(s, node.depth)) or next(iter(node.children.values()))
        other = self.strings[node[0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node.append(place)
            return
        above, node = None, self.root
        while isinstance(node, _Node) and node.depth < depth:
            above, node = node, node.children[self._byte(s, node.depth)]
        if isinstance(node, _Node) and node.depth == depth:
            node.children[self._byte(s, depth)] = [place]
            return
        branch = _Node(depth)
        branch.children[self._byte(other, depth)] = node
        branch.children[self._byte(s, depth)] = [place]
        if above is None:
            self.root = branch
        else:
            above.children[self._byte(s, above.depth)] = branch

    def ordered(self) -> list[int]:
        out: list[int] = []
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, _Node):
                stack += [node.children[b] for b in sorted(node.children, reverse=True)]
            else:
                out += node
        return out


def _words(strings: list[bytes], places: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes at ``depth`` as one number each (zeros after the end)."""
    return np.frombuffer(b"".join(strings[p][depth:depth + 8].ljust(8, b"\0") for p in places), ">u8")


def deep_shallow_order(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Places of the strings in order; all share their first ``depth`` bytes."""
    out: list[int] = []
    # a stack of (places, depth), the first part on top
    stack = [(np.arange(len(strings)), depth)]
    stop = depth + shallow
    while stack:
        places, at = stack.pop()
        if len(places) <= _SMALL or at >= stop or min(len(strings[p]) for p in places) < at + 8:
            trie = BlindTrie(strings)
            for p in places.tolist():
                trie.insert(p)
            out += trie.ordered()
            continue
        words = _words(strings, places, at)
        pivot = np.partition(words, len(words) // 2)[len(words) // 2]
        less, more = words < pivot, words > pivot
        for part, d in ((more, at), (~(less | more), at + 8), (less, at)):
            if part.any():
                stack.append((places[part], d))
    return out
