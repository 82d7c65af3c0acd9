"""Token ids of whole texts, by the tokenizers library, with every distinct word encoded once per worker.

A byte-level BPE encodes each pre-token on its own, so a text's ids are its pre-tokens' ids end to end.  The
pre-tokens are found in numpy for texts of the first Unicode blocks; texts with other characters, odd white
space or an added token's string go to the library whole.  The result equals the library's in all cases.
"""

from __future__ import annotations

import itertools
import os

import numpy as np

from netsift.llm import kernel

LATIN = 0x250
WORDS_KEPT = 400_000
_CONTRACTIONS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")
LETTER, NUMBER, OTHER, WHITE, HARD = range(5)


def _classes() -> np.ndarray:
    """Class of each of the first code points; control characters and rare white space are HARD."""
    import unicodedata

    kind = np.full(LATIN, OTHER, np.uint8)
    for c in range(LATIN):
        group = unicodedata.category(chr(c))
        if group[0] == "L":
            kind[c] = LETTER
        elif group[0] == "N":
            kind[c] = NUMBER
        elif group[0] in "CZ":
            kind[c] = HARD
    kind[[0x20, 0x09, 0x0A, 0x0D]] = WHITE
    return kind


def _alphabet() -> np.ndarray:
    """The character that stands for each byte in the model's alphabet: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.zeros(256, "<u2")
    out[visible] = visible
    rest = np.setdiff1d(np.arange(256), visible)
    out[rest] = 256 + np.arange(len(rest))
    return out


class WordEncoder:
    """Ids per word with a bounded memory of words; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.alphabet = _alphabet()
        self.kind = _classes()
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of the words in memory, ascending, and their slots
        self.slot = np.zeros(0, np.int64)
        self.begin = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Ids of new words, given in the model's alphabet, by the library's model; ``hashes`` are ascending."""
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(w)] for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        total, n = int(size.sum()), len(self.known)
        while n + len(found) > len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
        if self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat) + total)
        self.flat[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, total)
        self.begin[n:n + len(found)] = self.used + np.cumsum(size) - size
        self.size[n:n + len(found)] = size
        self.used += total
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.slot = np.insert(self.slot, place, np.arange(n, n + len(found)))

    def slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and whether it is known."""
        if not len(self.known):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return self.slot[at], self.known[at] == keys

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts end to end, and bounds per text."""
        n = len(off) - 1
        hard = np.zeros(n, bool)
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        first = data[at]
        wide = first >= 0x80
        code = first.astype(np.int64)
        pair = wide & (first < 0xE0)
        code[pair] = ((first[pair] & 0x1F).astype(np.int64) << 6) | (data[np.minimum(at[pair] + 1, len(data) - 1)] & 0x3F)
        code[first >= 0xE0] = LATIN
        kind = np.where(code < LATIN, self.kind[np.minimum(code, LATIN - 1)], HARD)
        bounds = np.searchsorted(at, off)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        hard[owner[kind == HARD]] = True
        joined = data.tobytes()
        for word in self.added:
            spot = joined.find(word)
            while spot >= 0:
                hard[np.searchsorted(off, spot, "right") - 1] = True
                spot = joined.find(word, spot + 1)

        start = self._starts(kind, code, bounds)
        begin = at[start]
        text = owner[start]
        end = np.append(begin[1:], len(data))
        easy = ~hard[text]
        begin, end, text = begin[easy], end[easy], text[easy]
        end = np.minimum(end, off[text + 1])
        h, index, inverse = np.unique(kernel.span_hash(kernel.prefix(data), begin, end), return_index=True, return_inverse=True)
        if len(self.known) + len(h) > WORDS_KEPT:
            self.clear()
        new = np.flatnonzero(~self.slots(h)[1])
        if len(new):
            letters = self.alphabet[data].tobytes().decode("utf-16-le")
            first, last = begin[index[new]].tolist(), end[index[new]].tolist()
            self.learn(h[new], [letters[a:b] for a, b in zip(first, last)])
        slot = self.slots(h)[0][inverse]
        size = self.size[slot]
        total = int(size.sum())
        ids = self.flat[np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.begin[slot], size)]
        per_text = np.bincount(text, size, n).astype(np.int64)
        if hard.any():
            pieces, cut = [], np.concatenate([[0], np.cumsum(per_text)])
            for k in range(n):
                own = self.whole(joined[off[k]:off[k + 1]].decode()) if hard[k] else ids[cut[k]:cut[k + 1]]
                per_text[k] = len(own)
                pieces.append(own)
            ids = np.concatenate(pieces)
        return ids, np.concatenate([[0], np.cumsum(per_text)])

    @staticmethod
    def _starts(kind: np.ndarray, code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Positions (in characters) where pre-tokens begin."""
        n = len(kind)
        if not n:
            return np.zeros(0, np.int64)
        new_text = np.zeros(n + 1, bool)
        new_text[bounds] = True
        start = new_text[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # white space before other characters: its last character stands apart, and a blank joins what follows
        joint = np.flatnonzero((kind[1:] != WHITE) & (kind[:-1] == WHITE) & ~new_text[1:n])
        start[joint] = True
        start[joint[code[joint] == 32] + 1] = False
        # an apostrophe that begins a pre-token takes certain letters with it
        q = np.flatnonzero((code == 39) & start)
        for letters in _CONTRACTIONS:
            end = q + 1 + len(letters)
            ok = end <= n
            for k, c in enumerate(letters):
                ok &= (code[np.minimum(q + 1 + k, n - 1)] == c) & ~new_text[np.minimum(q + 1 + k, n)]
            start[q[ok] + 1] = False
            inside = end[ok & (end < n)]
            start[inside] = True
        return np.flatnonzero(start)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file; it lives across tasks."""
    store = kernel.worker_store()
    have = getattr(store, "encoders", None)
    if have is None:
        have = store.encoders = {}
    if path not in have:
        have[path] = WordEncoder(path)
    return have[path]
