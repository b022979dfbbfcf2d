"""Which of many 64-bit names occur in more than one bundle of documents, without a row for each name.

Documents are dealt by a hash of doc_id into bundles of about BUNDLE bytes of text. `ask` makes, of each bundle, the
sorted distinct names; they travel by ranges of the name space ("parts") as compressed differences, a few bytes each.
Every part is sorted on its own, and answers each bundle with one bit a name. `answered` brings a bundle's documents
and its bits together; both uses of the dealt documents are the same exchange, so the text is shuffled once.

Since a name travels once for each bundle that has it, one that a third of all documents share costs a few bytes a
bundle, and no task holds more than a part or a bundle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import give_back

BUNDLE = 12 << 20
#: Bytes of text for each part of the name space.
PART = 16 << 20
MOST_BOUNDS = 4096


@cache
def _zstd():
    """A worker's compressor and decompressor: to make them takes longer than most blobs do."""
    import zstandard

    return zstandard.ZstdCompressor(1), zstandard.ZstdDecompressor()


def squeeze(sorted_names: np.ndarray) -> bytes:
    """Differences of sorted names that share low zero bits, as byte planes; only the top one is worth deflating."""
    low = np.uint64(0) if not len(sorted_names) else np.bitwise_or.reduce(sorted_names)
    shift = int(low & (~low + np.uint64(1))).bit_length() - 1 if low else 0
    short = sorted_names >> np.uint64(shift)
    first, d = int(short[0]) if len(short) else 0, short[1:] - short[:-1]
    width = max(1, (int(d.max()) if len(d) else 0).bit_length() + 7 >> 3)
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :width].T) if len(d) else np.zeros((width, 0), np.uint8)
    return bytes([shift, width]) + first.to_bytes(8, "little") + len(short).to_bytes(8, "little") + planes[:-1].tobytes() + _zstd()[0].compress(planes[-1].tobytes())


def unsqueeze(blob: bytes) -> np.ndarray:
    shift, width, first, n = blob[0], blob[1], int.from_bytes(blob[2:10], "little"), int.from_bytes(blob[10:18], "little")
    if not n:
        return np.zeros(0, np.uint64)
    raw = (width - 1) * (n - 1)
    bytes_ = np.zeros((n, 8), np.uint8)
    if n > 1:
        bytes_[1:, : width - 1] = np.frombuffer(blob, np.uint8, raw, 18).reshape(width - 1, n - 1).T
        bytes_[1:, width - 1] = np.frombuffer(_zstd()[1].decompress(blob[18 + raw :], max_output_size=n), np.uint8)
    d = bytes_.view(np.uint64).ravel()
    d[0] = first
    return np.cumsum(d, dtype=np.uint64) << np.uint64(shift)


def narrowed(names: np.ndarray, total: int, spare: int = 11) -> np.ndarray:
    """Names with only as many leading bits as keep a chance meeting of one with any other below 2**-spare or so."""
    bits = min(64, max(40, int(total).bit_length() + spare))
    return names >> np.uint64(64 - bits) << np.uint64(64 - bits)


def packed(yes: np.ndarray) -> bytes:
    return _zstd()[0].compress(np.packbits(yes).tobytes())


def distinct(names: np.ndarray) -> np.ndarray:
    """np.unique, which hashes before it sorts: on millions of names many times slower than a sort alone."""
    names = np.sort(names)
    return names[np.r_[True, names[1:] != names[:-1]]] if len(names) else names


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    return (((names >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def volume(docs: DataFrame) -> int:
    """Bytes of text."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def dealt(docs: DataFrame, total: int, bundle: int = BUNDLE) -> DataFrame:
    """docs with the bundle of each, by a hash of doc_id."""
    n = max(1, -(-total // bundle))
    return docs.withColumn("bundle", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(n)))


def ranged(docs: DataFrame, total: int, bundle: int = BUNDLE, most: int = MOST_BOUNDS) -> DataFrame:
    """docs with the bundle of each, bundles being ascending ranges of doc_id, null last.

    The driver gets at most `most` quantiles of doc_id, whatever the size; a row finds its own in two steps of as many
    comparisons as the root of that. Beyond so many bundles, the ranges between quantiles are cut evenly.
    """
    n = max(1, -(-total // bundle))
    coarse = min(n, most)
    parts = -(-n // coarse)
    found = docs.agg(F.percentile_approx("doc_id", [i / coarse for i in range(coarse + 1)], 100_000)).first()[0] if n > 1 else None
    bounds = sorted({b for b in found or [] if b is not None})
    if len(bounds) < 2:
        return docs.withColumn("bundle", F.lit(0).cast("long"))
    low, high = bounds[:-1], bounds[1:]
    step = max(1, int(len(low) ** 0.5))
    groups = [low[i : i + step] for i in range(0, len(low), step)]
    lit = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    key = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    below = lambda xs: F.size(F.filter(xs, lambda x: x < key))
    g = F.greatest(below(lit([x[0] for x in groups])), F.lit(1))
    out = docs.withColumn("bundle", F.greatest(F.lit(0), (g - 1) * step + below(F.element_at(F.array(*[lit(x) for x in groups]), g)) - 1).cast("long"))
    if parts == 1:
        return out
    ends = lambda xs: F.element_at(F.flatten(F.array(*[lit(xs[i : i + step]) for i in range(0, len(xs), step)])), (F.col("bundle") + 1).cast("int")).cast("double")
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (key.cast("double") - ends(low)) / (ends(high) - ends(low))))
    return out.withColumn("bundle", F.col("bundle") * parts + F.least(F.lit(parts - 1), F.floor(share * parts)))


def ask(bundles: DataFrame, names: Callable, total: int, part: int = PART, spare: int = 11, before: bool = False, beside: DataFrame | None = None) -> DataFrame:
    """bundles(bundle, ...) -> bundle, part, bits: bits of the bundle's sorted distinct names, part by part, packed.

    names: of a table of a bundle's rows (and one of its rows of `beside`, if given), any number of names, told apart by
    the bits that `narrowed` keeps. A bit tells whether another bundle has the name or, with before, one of a smaller number.
    """
    parts = max(1, -(-total // part))

    def collect(t, extra=None):
        import pyarrow as pa

        none = pa.table({"part": pa.array([], pa.int64()), "bundle": pa.array([], pa.int64()), "names": pa.array([], pa.binary())})
        if not t.num_rows:
            return none
        got = distinct(narrowed(names(t) if extra is None else names(t, extra), total, spare))
        owner = part_of(got, parts)
        edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, np.int64)
        which = [int(owner[a]) for a in edge[:-1]]
        blobs = [squeeze(got[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        del got, owner
        give_back()
        return pa.table({"part": pa.array(which, pa.int64()), "bundle": pa.array([t.column("bundle")[0].as_py()] * len(which), pa.int64()), "names": pa.array(blobs, pa.binary())})

    def answer(t):
        import pyarrow as pa

        give_back()
        order, blobs = np.argsort(t.column("bundle").to_numpy()), t.column("names")
        lists = [unsqueeze(memoryview(blobs[n].as_buffer())) for n in order.tolist()]
        every = np.concatenate(lists)
        every.sort()
        twice = every[1:][every[1:] == every[:-1]]
        del every
        twice = twice[np.r_[True, twice[1:] != twice[:-1]]] if len(twice) else twice
        met, bits = np.zeros(len(twice), bool), []
        for names in lists:  # bundles ascend
            if not len(twice):
                bits.append(packed(np.zeros(len(names), bool)))
                continue
            at = np.searchsorted(twice, names)
            at[at == len(twice)] = 0
            yes = twice[at] == names
            if before:
                own = at[yes]
                yes[yes] = met[own]
                met[own] = True
            bits.append(packed(yes))
        return pa.table({"bundle": t.column("bundle").take(pa.array(order)).cast(pa.int64()), "part": t.column("part").cast(pa.int64()), "bits": pa.array(bits, pa.binary())})

    schema = "part long, bundle long, names binary"
    if beside is None:
        asked = bundles.groupBy("bundle").applyInArrow(lambda t: collect(t), schema)
    else:
        asked = bundles.groupBy("bundle").cogroup(beside.groupBy("bundle")).applyInArrow(lambda t, extra: collect(t, extra), schema)
    return asked.groupBy("part").applyInArrow(answer, "bundle long, part long, bits binary")


class Answers:
    """A bundle's answers, in one sort of its names.

    yes: for each name, the answer. `least` gives a minimum over the bundle's equal names, `often` whether there are any.
    """

    def __init__(self, names: np.ndarray, table, total: int, part: int = PART, spare: int = 11):
        short = narrowed(names, total, spare)
        self.order = np.argsort(short).astype(np.int32)  # a bundle has far fewer than 2**31 names
        short = short[self.order]
        self.edge = np.flatnonzero(np.r_[True, short[1:] != short[:-1]]).astype(np.int32) if len(short) else np.zeros(0, np.int32)
        self.times = np.diff(np.r_[self.edge, np.int32(len(short))])
        owner = part_of(short[self.edge], max(1, -(-total // part))).astype(np.int32)
        del short
        yes = np.zeros(len(self.edge), bool)
        unpack = _zstd()[1].decompress
        which = table.column("part").to_numpy().astype(np.int32)  # of owner's kind: else each search would copy owner
        low, high = np.searchsorted(owner, which).tolist(), np.searchsorted(owner, which, "right").tolist()
        for lo, hi, bits in zip(low, high, table.column("bits").to_pylist(), strict=True):
            yes[lo:hi] = np.unpackbits(np.frombuffer(unpack(bits), np.uint8), count=hi - lo).astype(bool)
        self.yes = self._back(yes)

    def _back(self, of_group: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), of_group.dtype)
        out[self.order] = np.repeat(of_group, self.times)
        return out

    def often(self) -> np.ndarray:
        return self._back(self.times > 1)

    def least(self, of_name: np.ndarray) -> np.ndarray:
        return self._back(np.minimum.reduceat(of_name[self.order], self.edge)) if len(self.order) else of_name


def answered(bundles: DataFrame, answers: DataFrame, use: Callable, schema: str) -> DataFrame:
    """use(table of the bundle's documents, table of its answers) -> table, for each bundle."""

    def run(left, right):
        give_back()
        out = use(left, right)
        give_back()  # a worker that waits for its next task keeps what it does not give back
        return out

    return bundles.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(run, schema)
