"""Sets of hashed word shingles, and signatures that any two similar sets share."""

from __future__ import annotations

import numpy as np
import xxhash

from skyloom.llm.pretoken import mixed


class Words:
    """64-bit hashes of words, kept for those met so far."""

    def __init__(self, keep: int = 200_000):
        self.keep, self.known = keep, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.keep:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, hashes: Words, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of n words; fewer words make one shingle, none the empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes(words)
    m = min(n, len(h))
    out = np.full(len(h) - m + 1, m, np.uint64)
    for i in range(m):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - m + 1 + i])
    return np.unique(out)


class Classes:
    """Size classes for sets that link at intersection * 100 >= union * percent.

    Linked sets x <= y have |y| <= |x| * 100 / percent and differ in at most |x| * (100 - percent) / percent elements
    (the union is at most |x| * 100 / percent, and what is outside the intersection a (100 - percent)th of it). So when
    elements are dealt by hash to more blocks than that, some blocks are equal in both. Class c deals sets of up to
    top[c] elements; a set is also dealt as each class below whose linked sets may be as large.
    """

    def __init__(self, percent: int = 90, most: int = 1 << 40):
        self.percent = percent
        self.top = [1]
        while self.top[-1] < most:
            self.top.append(max(self.top[-1] + 1, int(self.top[-1] * 1.4)))
        self.tops = np.array(self.top)

    def differ(self, c: int) -> int:
        return self.top[c] * (100 - self.percent) // self.percent

    def of(self, size: int) -> list[int]:
        c = int(np.searchsorted(self.tops, size))
        found = [c]
        while c and size * self.percent <= self.top[c - 1] * 100:
            c -= 1
            found.append(c)
        return found

    def blocks(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Signatures, and for each its class, the least number of that class's that s shares with a linked set, and a side.

        There is one for each block with elements. Where so many blocks are empty that the equal ones could all be,
        the empty ones have signatures, too. Side 0 is a set that has none of those; of a set that has them, 1 is a block
        with elements and 2 an empty one. The number holds with linked sets that do alike; where only one of the two has
        signatures of empty blocks, that of the other holds for both, since they share none of these.
        """
        found, classes, needs, sides = [], [], [], []
        for c in self.of(len(s)) if len(s) else []:
            d = self.differ(c)
            if d == 0:
                continue  # only equal sets link
            p = d + 3 + d * (100 - self.percent) // 70
            block = ((s >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)  # s is sorted, so block is
            edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            total = np.add.reduceat(mixed(s), edge)
            own = [mixed(mixed(total + block[edge] * np.uint64(0xD6E8FEB86659FD93)) + np.uint64(c))]
            side = np.zeros(len(edge), np.int32)
            need = len(edge) - d  # p - d are equal, of which p - len(edge) may be empty
            if need < 1:
                none = np.setdiff1d(np.arange(p, dtype=np.uint64), block[edge])
                own.append(mixed(mixed(none + np.uint64(0x1234567)) + np.uint64(c)))
                need = p - d
                side = np.r_[side + 1, np.full(len(none), 2, np.int32)]
            found += own
            sides.append(side)
            n = sum(map(len, own))
            classes.append(np.full(n, c, np.int32))
            needs.append(np.full(n, need, np.int32))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        return np.concatenate(found), np.concatenate(classes), np.concatenate(needs), np.concatenate(sides)

    def signatures(self, s: np.ndarray) -> np.ndarray:
        return self.blocks(s)[0]


def product_links(sets: list[np.ndarray], percent: int, columns: int = 4096) -> list[tuple[int, int]]:
    """Links of the documents in one block, as a spanning forest: the product of the incidence matrix with its transpose.

    The matrix is taken by blocks of columns, commonest shingles first, and overlaps add up. A pair is discarded once
    its overlap so far and the most that its sizes leave for the other columns cannot make the bound; when no pair is
    left that the forest does not join already, the rest is not multiplied.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    tokens, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    rank = np.empty(len(tokens), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(tokens))
    shared = int((count > 1).sum())
    column = rank[column]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    need = -(-percent * (size[:, None] + size[None, :]) // (100 + percent))  # intersection >= percent/(100+percent) of the sum
    alive = np.triu((np.minimum(size[:, None], size[None, :]) >= need) & (size[:, None] > 0) & (size[None, :] > 0), 1)
    overlap = np.zeros((n, n), np.float32)
    left = size.copy()
    for a in range(0, shared, columns):
        if not alive.any():
            break
        lo, hi = np.searchsorted(column, (a, min(a + columns, shared)))
        block = np.zeros((n, min(columns, shared - a)), np.float32)
        block[row[lo:hi], column[lo:hi] - a] = 1
        overlap += block @ block.T
        left -= block.sum(1).astype(np.int64)
        alive &= overlap + np.minimum(left[:, None], left[None, :]) >= need
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    forest = []
    for i, j in np.argwhere(alive & (overlap >= need)).tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            forest.append((i, j))
    return forest
