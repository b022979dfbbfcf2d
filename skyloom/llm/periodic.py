"""Periodic runs of words: blocks of words searched across their document, repeats at fitting distances extended exactly.

A run is a stretch of consecutive words whose smallest period q (words q apart are identical) fits `times` times or more
into its length, which is at least `least`, and that no neighbouring word extends. Words are numbered by their first
occurrence in the document, and for each block size B = FIRST, 2 * FIRST, ... the blocks that start at multiples of B
become integer-sequence keys of an Aho-Corasick automaton (pyahocorasick), which finds all their occurrences in one pass.
An occurrence counts at a distance from its block of B to 2B - 1 words (of 1 to 2B - 1 at the first size), and then seeds
an extension in both directions, word by word, for as long as words at that distance are equal.

No run is missed. A run of period q and length L holds a block at a multiple of B with its copy q words on whenever
2B - 1 + q <= L, since one of its first B words is such a multiple. For B <= q this follows from L >= 3q, and for
q < B = FIRST = 8 from L >= 24 and q <= 8: 15 + 7 <= 24. Hence least >= 3 * FIRST - 2 and times >= 3 are asked for.

A stretch found at a multiple of its smallest period is found at that period, too, with the same ends, and the smaller
distance is kept; seeds inside a run at a multiple of its period are passed over, so a long run is extended once. Sizes end where 3B exceeds the document. The automaton holds the blocks of SEGMENT words (or of one
block, where that is longer) at a time, so that memory grows with the words of a document by a small factor only.
Nothing is shuffled; a document is one row's work. The automaton follows failure links at every word, so a text that is one
run of a short period costs time that grows with the square of its words (8.5 s at 100,000; 0.3 s at 20,000).

Defined results: null, empty and white texts have no words and no runs. Every row is taken by itself, so repeated rows give
equal rows. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from skyloom.llm.common import table

LEAST, TIMES = 24, 3
FIRST = 8
#: Words whose blocks are in an automaton at a time.
SEGMENT = 1 << 15


def words_of(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words of a text in UTF-8: white space is blank and \\t \\n \\v \\f \\r, as bytes.split() takes it."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, looking ahead in pieces that double."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        to = min(n, at + step)
        differ = np.flatnonzero(a[at:to] != b[at:to])
        if len(differ):
            return at + int(differ[0])
        at, step = to, step * 2
    return n


def seeds(ids: np.ndarray, size: int, segment: int = SEGMENT):
    """(position, distance) of blocks of `size` that start at multiples of it, and of their occurrences at fitting distances, ascending."""
    import ahocorasick

    n, low = len(ids), 1 if size == FIRST else size
    span = max(size, segment // size * size)
    for begin in range(0, n - size + 1, span):
        part = tuple(ids[begin : begin + span + 3 * size].tolist())
        machine, block = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE), {}
        for x in range(0, min(span, len(part) - size + 1), size):
            key = part[x : x + size]
            block[x] = machine.get(key, x)  # equal blocks share the first one's name
            if block[x] == x:
                machine.add_word(key, x)
        machine.make_automaton()
        for end, name in machine.iter(part):
            y = end - size + 1
            x = (y - low) // size * size
            while x >= 0 and y - x < 2 * size:
                if block.get(x) == name:
                    yield begin + x, y - x
                x -= size


def runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES, segment: int = SEGMENT) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), in order of start, then period."""
    if least < 3 * FIRST - 2 or times < 3:
        raise ValueError(f"least must be {3 * FIRST - 2} or more, and times 3 or more")
    n, found, size = len(ids), {}, FIRST
    until, every = np.zeros(n, np.int64), np.ones(n, np.int64)  # of each word, where the run over it that reaches farthest ends, and its period
    while n >= least and 3 * size <= max(n, 3 * FIRST):  # at the first size, periods are shorter, too
        reached: dict[int, int] = {}  # of each distance, where the last stretch ends
        for x, d in seeds(ids, size, segment):
            if x + size + d <= reached.get(d, 0):  # inside a stretch that is known
                continue
            if x + size + d <= until[x] and d % every[x] == 0:  # a multiple of a known run's period: the same ends
                continue
            right = x + size + _equal(ids[x + size :], ids[x + size + d :])
            left = x - _equal(ids[:x][::-1], ids[d : x + d][::-1])
            reached[d] = right + d
            length = right + d - left
            if length >= max(least, times * d):
                found[left, length] = min(d, found.get((left, length), d))
                farther = np.flatnonzero(until[left : left + length] < left + length) + left
                until[farther], every[farther] = left + length, d
        size *= 2
    return sorted((start, length, d) for (start, length), d in found.items())


def numbered(words: list[bytes]) -> np.ndarray:
    names: dict[bytes, int] = {}
    return np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))


def told(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of a document's runs."""
    best = None
    for run in found:  # in order, so the first of equal ones stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        drop[start + q] += 1
        drop[start + length] -= 1
    kept = words
    if found:
        kept = [w for w, gone in zip(words, (np.cumsum(drop)[:-1] > 0).tolist(), strict=True) if not gone]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    start, length, q = best or (None, None, None)
    return len(found), start, length, q, 1000 * length // q if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SPANS = ", runs array<struct<start:long,length:long,period:long>>, collapsed string"


def detect(docs: DataFrame, least: int = LEAST, times: int = TIMES, words: Callable = words_of, spans: bool = True) -> DataFrame:
    """docs(doc_id, text) -> SCHEMA, and with `spans` the runs themselves and the text without the words that repeat.

    words: the words of a doc_id and text, in UTF-8. A word is dropped if a run holds it after the run's first period.
    """

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 7 + [pa.string()] * 2 + ([pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), pa.string()] if spans else [])
        names = [x.split(" ")[0] for x in (SCHEMA + (", runs array, collapsed string" if spans else "")).split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words(doc_id, text)
                found = runs(numbered(own), least, times)
                row = (doc_id, len(own), *told(own, found))
                if spans:
                    gone = {i for s, n, q in found for i in range(s + q, s + n)}
                    row += ([{"start": s, "length": n, "period": q} for s, n, q in found], b" ".join(w for i, w in enumerate(own) if i not in gone).decode("utf-8", "surrogatepass"))
                rows.append(row)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, SCHEMA + (SPANS if spans else ""))


def folded(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words of a document, of which one in ten by its id repeats a stretch of its words to the end. A null id repeats nothing."""
    own = words_of(doc_id, text)
    if doc_id is None or not own:
        return own
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return own
    a = g % len(own)
    p = 1 + (len(own) - a) // (3 + g % 8)
    return [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]


def op12_periodic(spark, sf_dir):
    return detect(table(spark, sf_dir, "documents"), words=folded, spans=False)
