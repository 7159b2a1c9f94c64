"""Whole-text encoding with a byte-level BPE file of the tokenizers library, word by word.

The library cuts a text into words (a fixed pattern) and encodes each word on
its own.  Here the cut is made with array operations over many texts, every
distinct word goes through the library once per worker, and its ids are copied
to all places where it occurs.  Texts for which the cut might differ from the
library's (characters beyond Unicode 3.2, or a special token's string) go
through the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pandas as pd

from .common import Rolling, spans_to_index

OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
# Unicode White_Space.
_SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
           0x205F, 0x3000)
# Endings that the word pattern cuts off after an apostrophe.
_SHORT_ENDINGS = "stmd"
_LONG_ENDINGS = ("re", "ve", "ll")

_MOST_WORDS = 3_000_000  # kept by a worker; beyond, it starts anew


def _char_classes() -> np.ndarray:
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    kind = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, UNSURE, np.uint8)
    for cp in range(0x30000):  # planes beyond are left to the library
        c = chr(cp)
        a, b = old(c), new(c)
        if a != "Cn" and a[0] != "C" or cp < 0x80:
            x, y = kind.get(a[0], OTHER), kind.get(b[0], OTHER)
            if x == y:
                out[cp] = x
    out[list(_SPACES)] = SPACE
    return out


class WordEncoder:
    """``encode(texts)`` gives the flat ids of all texts and their counts."""

    _classes: np.ndarray | None = None

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if WordEncoder._classes is None:
            WordEncoder._classes = _char_classes()
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = np.array([any(s in t for s in self.special) for t in texts], bool)
        whole = "".join(texts)
        cps = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kinds = WordEncoder._classes[cps]
        lengths = np.array([len(t) for t in texts], np.int64)
        if (kinds == UNSURE).any():
            rows = np.repeat(np.arange(len(texts)), lengths)
            odd[np.unique(rows[kinds == UNSURE])] = True
        if not odd.any():
            return self._encode_plain(whole, cps, kinds, lengths)
        plain = [t for t, o in zip(texts, odd, strict=True) if not o]
        flat, counts = self.encode(plain) if plain else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        parts, all_counts = [], np.zeros(len(texts), np.int64)
        ends, k = np.concatenate([[0], np.cumsum(counts)]), 0
        for i, o in enumerate(odd):
            if o:
                ids = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            else:
                ids, k = flat[ends[k]:ends[k + 1]], k + 1
            parts.append(ids)
            all_counts[i] = len(ids)
        return np.concatenate(parts), all_counts

    def _encode_plain(self, whole, cps, kinds, lengths):
        starts = word_starts(cps, kinds, lengths)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(lengths), np.int64)
        stops = np.append(starts[1:], len(cps))
        inverse, words = pd.factorize(Rolling(cps).of(starts, stops))
        first = np.zeros(len(words), np.int64)
        first[inverse[::-1]] = np.arange(len(starts) - 1, -1, -1)
        order = np.argsort(words)
        place = np.zeros(len(words), np.int64)
        place[order] = self._places(words[order], starts[first[order]], stops[first[order]], whole)
        place = place[inverse]
        counts = self.count[place]
        flat = self.ids[spans_to_index(self.at[place], counts)]
        so_far = np.concatenate([[0], np.cumsum(counts)])
        text_end = np.cumsum(lengths)
        cut = so_far[np.searchsorted(starts, np.concatenate([[0], text_end]))]
        return flat, np.diff(cut)

    def _places(self, words, starts, stops, whole) -> np.ndarray:
        if len(self.known) > _MOST_WORDS:
            self._forget()
        at = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != words[inside]
        if new.any():
            flat, counts = self._encode_words([whole[a:b] for a, b in zip(starts[new], stops[new], strict=True)])
            ends = len(self.ids) + np.cumsum(counts)
            self.ids = np.concatenate([self.ids, flat])
            spot = at[new]
            self.known = np.insert(self.known, spot, words[new])
            self.at = np.insert(self.at, spot, ends - counts)
            self.count = np.insert(self.count, spot, counts)
            at = np.searchsorted(self.known, words)
        return at

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single words, straight from the library's BPE model over the byte alphabet."""
        lines = "\n".join(words).encode().decode("latin-1").translate(_BYTE_CHARS).split(_LINE_BREAK)
        if len(lines) != len(words):  # a word of white space with a line break in it
            lines = [w.encode().decode("latin-1").translate(_BYTE_CHARS) for w in words]
        split = self.tokenizer.model.tokenize
        ids = [[t.id for t in split(w)] for w in lines]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()
_LINE_BREAK = _BYTE_CHARS[0x0A]


def word_starts(cps: np.ndarray, kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where the words of the library's pattern begin in texts that follow one another."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    text_start = np.zeros(n + 1, bool)
    text_start[np.concatenate([[0], np.cumsum(lengths)])] = True
    run = text_start[:n].copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    at = np.flatnonzero(run)
    size = np.diff(np.append(at, n))
    kind = kinds[at]
    end = at + size
    last_of_text = text_start[end]
    start = run
    # a blank before a word belongs to it; of longer white space the last character stands apart
    space = kind == SPACE
    inner = space & ~last_of_text
    start[end[inner] - 1] = True
    attach = inner & (cps[end - 1] == 0x20)
    start[end[attach]] = False
    # an apostrophe, not after a blank, takes one of a few endings with it
    quote = (kind == OTHER) & (size == 1) & (cps[at] == 0x27) & ~last_of_text
    quote[1:] &= ~attach[:-1]
    quote[:-1] &= kind[1:] == LETTER
    quote[-1:] = False
    q = np.flatnonzero(quote)
    if len(q):
        p = at[q]
        one = cps[p + 1]
        two = cps[np.minimum(p + 2, n - 1)]
        has_two = size[q + 1] >= 2
        taken = np.where(np.isin(one, [ord(c) for c in _SHORT_ENDINGS]), 1, 0)
        for a, b in _LONG_ENDINGS:
            taken = np.where(has_two & (one == ord(a)) & (two == ord(b)), 2, taken)
        hit = taken > 0
        p, taken, room = p[hit], taken[hit], size[q + 1][hit]
        start[p + 1] = False
        longer = room > taken
        start[(p + 1 + taken)[longer]] = True
    return np.flatnonzero(start)
