"""Removal of repeated byte passages by difference-cover blockwise suffix sorting to a fixed depth.

A byte goes if some string of LENGTH bytes over it also starts in a document with a smaller doc_id. Suffixes only have to
be told apart to that depth, so the blockwise construction becomes:

1. Cover sample. Positions of each document that fall into a difference cover modulo PERIOD are named by their next
   DEPTH bytes. For any two positions there is a shift below PERIOD at which both are in the sample, so two equal
   strings of LENGTH >= PERIOD - 1 + DEPTH bytes have a sampled position in common, whatever their alignment.
2. The name space is cut into parts, and each is sorted on its own. A name's rank tells whether it is tied with one of
   another document. A suffix none of whose sampled names in reach is tied cannot be tied to full depth and is dropped.
3. The suffixes left, those with long ties, are dealt by their LENGTH-byte name into buckets; buckets are sorted one at a
   time, each suffix against the documents before its own. Documents are cut into ranges of doc_id, so that all a bucket
   needs to know is the first range that has a name.

Texts travel deflated and once: all four uses of them are the same exchange. No suffix travels with its text: a name takes a few bytes, and each once for each bundle of documents, so neither a
passage that a third of all documents share nor a large group of copies gathers in one task. Whole copies of a
document with a smaller doc_id are found first by digest and need no third step. Memory is bounded by a bundle or a
part of fixed size, except that rows of one doc_id, and rows without one, are one bundle however many they are.

Exact but for chance meetings of names, which have the bits that `repeats.narrowed` keeps, 64 at most; bytes are not
compared. Defined results: a null text is the empty text. Texts below LENGTH bytes are kept
whole. Rows with the same doc_id never remove each other's bytes; null doc_ids count as greater than all others and
never remove anything. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import repeats
from skyloom.llm.common import cut, give_back, table
from skyloom.llm.pretoken import mixed

LENGTH = 50
#: A perfect difference set: every difference modulo PERIOD occurs once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
LAST = (1 << 63) - 1
#: Bits by which suffix names exceed what their number takes; the chance of one false meeting stays below a percent.
SPARE = 30
#: Bytes of text for a bundle and for a part of the name space: a task may have a name for every byte of a bundle. There is a
#: blob for each pair of them, so that parts, which are sorted in place, are larger.
BUNDLE, PART = 4 << 20, 16 << 20
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def names_at(data: bytes, at: np.ndarray, depth: int, step: int = 1 << 18) -> np.ndarray:
    """A 64-bit name of the depth >= 8 bytes at each position."""
    words = np.ndarray(len(data) - 7, np.uint64, data, strides=(1,))
    names = np.empty(len(at), np.uint64)
    for a in range(0, len(at), step):  # bounds what is held besides
        some, out = at[a : a + step], np.uint64(0)
        for k, off in enumerate([*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]):
            out = (out ^ words[some + off]) * _K[k % 8]
            out ^= out >> np.uint64(29)
        names[a : a + step] = mixed(out)
    return names


class Joined:
    """Documents of at least `length` bytes, joined, with what concerns positions in them."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        self.length, self.depth = length, length - PERIOD + 1
        self.size = np.array([len(t) for t in texts], np.int64)
        self.data = b"".join(texts)
        self.start = np.cumsum(self.size) - self.size

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the cover sample, and their names."""
        each = [s + p for s, n in zip(self.start.tolist(), self.size.tolist(), strict=True) if n >= self.length for p in [cover_upto(n - self.depth)]]
        at = np.concatenate(each) if each else np.zeros(0, np.int64)
        return at, names_at(self.data, at, self.depth) if len(at) else np.zeros(0, np.uint64)

    def reach(self, tied: np.ndarray) -> np.ndarray:
        """Suffixes, long enough, that have one of the sampled positions `tied` less than PERIOD ahead."""
        n = len(self.data) + 1
        first = np.maximum(tied - PERIOD + 1, self.start[np.searchsorted(self.start, tied, "right") - 1])
        found = np.flatnonzero(np.cumsum(np.bincount(first, minlength=n) - np.bincount(tied + 1, minlength=n)) > 0)
        doc = np.searchsorted(self.start, found, "right") - 1
        return found[found + self.length <= self.start[doc] + self.size[doc]]


_COVERS: dict[int, np.ndarray] = {}


def cover_upto(last: int) -> np.ndarray:
    """Positions of the cover from 0 to last."""
    size = 1 << max(12, int(last + 1).bit_length())
    if size not in _COVERS:
        p = np.arange(size, dtype=np.int64)
        _COVERS[size] = p[np.isin(p % PERIOD, COVER)]
    whole = _COVERS[size]
    return whole[: np.searchsorted(whole, last, "right")]


def _runs(at: np.ndarray) -> np.ndarray:
    """Sorted positions as rows (first, past the last)."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    gap = np.flatnonzero(at[1:] - at[:-1] > 1)
    out = np.empty((len(gap) + 1, 2), np.int64)
    out[0, 0], out[-1, 1] = at[0], at[-1] + 1
    out[1:, 0], out[:-1, 1] = at[gap + 1], at[gap] + 1
    return out


def _positions(runs: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b) for a, b in runs.tolist())])


def _bytes(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _parcels(texts: list[bytes], size: int = 2 << 20):
    at = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield slice(at, i)
            at, total = i, 0
        total += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


def _slices(batch, size: int = 2 << 20):
    """A batch of Arrow in parts of about `size` bytes of text: what is made of a part is many times its size for a moment."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def copies(docs: DataFrame) -> DataFrame:
    """bundle, part (-1), bits: doc_id and digest of whole copies of documents with smaller doc_ids, in the form of answers."""
    digest = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "bundle", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    least = digest.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    found = digest.join(least, "digest").filter("doc_id > low").select("bundle", "doc_id", "digest").distinct()
    return found.select("bundle", F.lit(-1).cast("long").alias("part"), F.concat(F.hex("doc_id"), F.lit(" "), "digest").cast("binary").alias("bits"))


def packed(docs: DataFrame) -> DataFrame:
    """docs(bundle, doc_id, text, text_key) with text deflated, so that exchanges and what waits for them are small."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("bundle"), b.column("doc_id").cast(pa.int64()), b.column("text_key"), pa.array([pack.compress(t) for t in _bytes(b.column("text").to_pylist())], pa.binary())], names=["bundle", "doc_id", "text_key", "packed"])

    return docs.select("bundle", "doc_id", "text_key", "text").mapInArrow(run, "bundle long, doc_id long, text_key long, packed binary")


def _unpacked(t) -> list[bytes]:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(p) for p in t.column("packed").to_pylist()]


def _are_copies(ids: list, raw: list[bytes], answers, length: int) -> list[bool]:
    own = {b for p, b in zip(answers.column("part").to_pylist(), answers.column("bits").to_pylist(), strict=True) if p == -1}
    return [bool(own) and len(b) >= length and i is not None and f"{i & (1 << 64) - 1:X} {hashlib.md5(b).hexdigest()}".encode() in own for i, b in zip(ids, raw, strict=True)]


OUT = "doc_id long, text_key long, bundle long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, runs binary"


def _out(ids, keys, bundles, rows):
    """Rows of (n_bytes, n_removed, spans, kept_sha256, runs) as a table."""
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.table([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(bundles, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[x.split()[0] for x in OUT.split(", ")])


def first_pass(bundles: DataFrame, whole: DataFrame, length: int, total: int) -> DataFrame:
    """A row for each document: final, or with the runs of its suffixes that have long ties."""

    def sampled(t, answers):
        ids, raw = t.column("doc_id").to_pylist(), _unpacked(t)
        gone = _are_copies(ids, raw, answers, length)
        parts = [(s, Joined([b"" if c else b for b, c in zip(raw[s], gone[s], strict=True)], length)) for s in _parcels(raw)]
        return ids, raw, gone, parts, [j.sample() for _, j in parts]

    def names(t, answers):
        return np.concatenate([np.zeros(0, np.uint64), *(x for _, x in sampled(t, answers)[-1])])

    def use(t, answers):
        import pyarrow.compute as pc

        if not t.num_rows:
            return _out([], [], [], [])
        ids, raw, gone, parts, samples = sampled(t, answers)
        every = np.concatenate([np.zeros(0, np.uint64), *(x for _, x in samples)])
        got = repeats.Answers(every, answers.filter(pc.not_equal(answers.column("part"), -1)), total, PART)
        tied = got.yes | got.often()
        out, at = [], 0
        for (s, j), (where, x) in zip(parts, samples, strict=True):
            reach = j.reach(where[tied[at : at + len(x)]])
            at += len(x)
            edge = np.searchsorted(np.searchsorted(j.start, reach, "right") - 1, np.arange(len(j.size) + 1))
            for k in range(len(j.size)):
                b, here = raw[s.start + k], reach[edge[k] : edge[k + 1]] - j.start[k]
                if gone[s.start + k]:
                    out.append((len(b), len(b), [{"start": 0, "end": len(b)}], hashlib.sha256(b"").hexdigest(), None))
                elif len(here):
                    out.append((len(b), 0, None, None, _runs(here).astype("<i8").tobytes()))
                else:
                    out.append((len(b), 0, [], hashlib.sha256(b).hexdigest(), None))
        return _out(ids, t.column("text_key").to_pylist(), t.column("bundle").to_pylist(), out)

    asked = repeats.ask(bundles, names, total, PART, beside=whole)
    return repeats.answered(bundles, asked.unionByName(whole), use, OUT)


def second_pass(bundles: DataFrame, found: DataFrame, length: int, total: int) -> DataFrame:
    """Documents and their rows of the first pass, bundles being ascending ranges of doc_id -> final rows."""

    def keyed(t, rows):
        """Of documents with runs, in ascending order: row numbers, texts, and their suffixes' keys, documents and positions."""
        runs = {(i, k): r for i, k, r in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text_key", "runs")), strict=True) if r is not None}
        ids, keys = t.column("doc_id").to_pylist(), t.column("text_key").to_pylist()
        at = sorted((n for n, key in enumerate(zip(ids, keys, strict=True)) if key in runs), key=lambda n: (ids[n] is None, ids[n]) if ids[n] is not None else (True, 0))
        own = [runs[ids[n], keys[n]] for n in at]
        texts = _unpacked(t.take(at)) if at else []
        got = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for s in _parcels(texts):
            j = Joined(texts[s], length)
            each = [_positions(np.frombuffer(r, "<i8").reshape(-1, 2)) for r in own[s]]
            where = np.concatenate(each)
            doc = np.repeat(np.arange(s.start, s.stop), [len(x) for x in each])
            got.append((names_at(j.data, where + j.start[doc - s.start], length) if len(where) else got[0][0], doc.astype(np.int32), where.astype(np.int32)))
            del j, each, where, doc
        return at, texts, *(np.concatenate(x) for x in zip(*got, strict=True))

    def use(t, beside):
        import pyarrow.compute as pc

        if not t.num_rows:
            return _out([], [], [], [])
        rows = beside.filter(pc.is_null(beside.column("part")))
        at, texts, key, doc, where = keyed(t, rows)
        final = {}
        if at:
            ids = t.column("doc_id").to_pylist()
            got = repeats.Answers(key, beside.filter(pc.is_valid(beside.column("part"))), total, PART, SPARE)
            number = np.array([LAST if ids[n] is None else ids[n] for n in at], np.int64)
            gone = got.yes | (number[doc] > number[got.least(doc)])  # documents ascend, so the least row has the least doc_id
            edge = np.searchsorted(doc, np.arange(len(texts) + 1))
            for k, b in enumerate(texts):
                starts = where[edge[k] : edge[k + 1]][gone[edge[k] : edge[k + 1]]]
                spans = []
                for a, z in _runs(starts).tolist():
                    z += length - 1
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = z
                    else:
                        spans.append([a, z])
                kept = b"".join(b[a:z] for a, z in zip([0, *(z for _, z in spans)], [*(a for a, _ in spans), len(b)], strict=True))
                final[at[k]] = (len(b), len(b) - len(kept), [{"start": a, "end": z} for a, z in spans], hashlib.sha256(kept).hexdigest(), None)
        done = {(r["doc_id"], r["text_key"]): tuple(r[c] for c in ("n_bytes", "n_removed", "spans", "kept_sha256", "runs")) for r in rows.filter(pc.is_null(rows.column("runs"))).to_pylist()}
        ids, keys = t.column("doc_id").to_pylist(), t.column("text_key").to_pylist()
        return _out(ids, keys, t.column("bundle").to_pylist(), [final[n] if n in final else done[ids[n], keys[n]] for n in range(len(ids))])

    asked = repeats.ask(bundles, lambda t, rows: keyed(t, rows)[2], total, PART, SPARE, before=True, beside=found)
    return repeats.answered(bundles, found.unionByName(asked, allowMissingColumns=True), use, OUT)


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text_key (xxhash64 of text), n_bytes, n_removed, spans (removed, maximal), kept_sha256."""
    if length < PERIOD + 7:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    total = repeats.volume(docs)
    bundles = repeats.ranged(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), total, BUNDLE)
    dealt = packed(bundles)
    found = first_pass(dealt, cut(copies(bundles)), length, total).repartition("bundle")
    return cut(second_pass(dealt, found, length, total).select("doc_id", "text_key", "n_bytes", "n_removed", "spans", "kept_sha256"))


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes taken out of text; characters cut through go whole. Rows left without any text go."""
    spans = cut(find(docs, length).filter("n_removed > 0").select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "spans").distinct())
    marked = docs.join(spans.withColumnRenamed("spans", "__spans"), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__k")), "left")

    columns = docs.columns

    def cut_out(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        give_back()
        for whole in batches:
            for batch in _slices(whole):
                texts, spans = batch.column("text"), batch.column("__spans")
                at = np.flatnonzero(pc.is_valid(spans).to_numpy(zero_copy_only=False))
                if len(at):
                    kept, some = texts.to_pylist(), spans.take(pa.array(at))
                    for n, each in zip(at.tolist(), some.to_pylist(), strict=True):
                        b = kept[n].encode("utf-8", "surrogatepass")
                        kept[n] = b"".join(b[a:z] for a, z in zip([0, *(s["end"] for s in each)], [*(s["start"] for s in each), len(b)], strict=True)).decode("utf-8", "ignore")
                    gone = np.zeros(len(kept), bool)
                    gone[[n for n in at.tolist() if not kept[n]]] = True
                    batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(kept, pa.string())).filter(pa.array(~gone))
                yield batch.select(columns)
        give_back()

    return marked.select(*columns, "__spans").mapInArrow(cut_out, docs.schema)


def op7_suffix_dedup(spark, sf_dir):
    return find(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
