"""Pre-tokens of byte-level BPE, found for many texts at once in numpy.

The split is that of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
written as rules on runs of one character class, so that cost is a few passes over the code points and Python touches
only pre-tokens that it has not seen before.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache
from itertools import chain

import numpy as np

LETTER, NUMBER, SPACE, OTHER, BREAK = 1, 2, 3, 4, 0
#: Code points that \s matches (the Unicode White_Space property).
WHITE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_MULT = 0x9E3779B97F4A7C15 | 1
_STEP = 1 << 19


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            kinds[i] = LETTER
        elif c == "N":
            kinds[i] = NUMBER
    kinds[list(WHITE)] = SPACE
    return kinds


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    up, down = np.full(n, _MULT, np.uint64), np.full(n, pow(_MULT, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined by one separator each, their code points, and where each text begins (and one past the last)."""
    joined = "\0".join(texts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return joined, cp, starts


def pretokens(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """joined, and for each pre-token in order: its text's number, start and end in joined, and a 64-bit hash of it."""
    joined, cp, starts = points(texts)
    n = len(cp)
    kind = classes()[cp]
    kind[starts[1:] - 1] = BREAK
    begin = np.empty(n + 1, bool)
    begin[0] = begin[n] = True
    begin[1:n] = kind[1:] != kind[:-1]
    after = starts[1:]  # an empty text makes two separators in a row
    begin[after] = begin[after - 1] = True
    # the last of a run of white space before something else goes alone, or with it if it is a blank
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BREAK))
    begin[last] = True
    begin[last[cp[last] == 32] + 1] = False
    # contractions
    for p in np.flatnonzero((cp == 39) & begin[:n]):
        if p + 1 < n and kind[p + 1] == LETTER:
            two = joined[p + 1 : p + 3]
            size = 2 if two[:1] in ("s", "t", "m", "d") else 3 if two in ("re", "ve", "ll") else 0
            if size:
                begin[p + 1] = False
                if kind[p + size] == LETTER:
                    begin[p + size] = True
    edge = np.flatnonzero(begin)
    s, e = edge[:-1], edge[1:]
    real = kind[s] != BREAK
    s, e = s[real], e[real]
    up, down = powers(1 << max(16, int(n).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * up[:n], out=sums[1:])
    h = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
    return joined, np.searchsorted(starts, s, "right") - 1, s, e, h


def parcels(texts: list[str], size: int = _STEP):
    """Slices of texts of about `size` characters; a longer text goes alone."""
    at = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield slice(at, i)
            at, total = i, 0
        total += len(t) + 1
    if at < len(texts):
        yield slice(at, len(texts))


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable bytes as they are, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(c): b for b, c in [*((b, b) for b in shown), *((b, 256 + i) for i, b in enumerate(hidden))]}


class ByteBpe:
    """Ids of whole texts by a byte-level BPE given as a tokenizers file, with the pre-tokens met so far kept.

    A merge's rank is its product's id in such vocabularies, so tiktoken's merge loop gives the same ids; only
    pre-tokens not kept reach it. When `keep` pre-tokens are kept, all are forgotten.
    """

    def __init__(self, path: str, keep: int = 200_000):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        added = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letter[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in added}
        self.core = tiktoken.Encoding("ids", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.keep = keep
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.at, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def learn(self, hashes: list[int], pieces: list[str]) -> None:
        core, k, used = self.core.encode_single_piece, len(self.known), self.used
        got = [core(piece.encode("utf-8", "surrogatepass")) for piece in pieces]
        upto = used + np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
        while k + len(got) >= len(self.at):
            self.at = np.resize(self.at, 2 * len(self.at))
        while upto[-1] > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.at[k], self.at[k + 1 : k + 1 + len(got)], self.used = used, upto, int(upto[-1])
        self.ids[used : self.used] = np.fromiter(chain.from_iterable(got), np.uint32, self.used - used)
        self.known.update(zip(hashes, range(k, k + len(got)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and len(texts) + 1 bounds."""
        joined, doc, s, e, h = pretokens(texts)
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if len(self.known) + len(keys) > self.keep:
            self.forget()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            self.learn([keys[i] for i in new], [joined[a:b] for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(), strict=True)])
        row = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[which]
        at, size = self.at[row], self.at[row + 1] - self.at[row]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.ids[np.arange(total) + np.repeat(at - (upto - size), size)]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.add.at(bounds, doc + 1, size)
        return ids, np.cumsum(bounds)
