"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

1. A document is the set of its distinct shingles, hashed to 64 bits. Documents with equal sets are one row.
2. Rows that can link agree on at least one block of columns whose number follows from the sizes (shingles.Classes).
   Each row's blocks are hashed; only hashes that another bundle has, too, leave the bundle (repeats), so almost all of
   the matrix is never multiplied. A common line spreads over many blocks and makes none of them alike by itself.
3. Pairs that share too few block hashes for their sizes are discarded (near_pairs); what still hangs together is a
   cluster. A cluster's rows are cut into row blocks of ROWS documents, or fewer long ones, and every pair of row blocks
   is multiplied in one task, overlaps accumulating over column blocks and pairs being discarded below the bounds of
   their sizes. The task returns a spanning forest of its links, never all pairs.
4. Components of the forests' edges are those of all links, since a pair left out is joined through others.

Everything is exact but for 64-bit hash collisions. Defined results: null and empty texts, and texts of white space, have
the empty set, link with nothing and are their own component. Repeated rows are equal documents. A null doc_id gets the
component of its links, or null. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import repeats
from skyloom.llm.common import cut, parts_for, table
from skyloom.llm.components import components
from skyloom.llm.shingles import Classes, Words, product_links, shingle_set

WORDS, PERCENT = 3, 90
ROWS = 384
#: Shingles that a row block is meant to hold at most.
SHINGLES = 400_000
#: Keys up to which a signature's pairs are counted one by one.
COMMON = 16


def key_of(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    import xxhash

    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0])


def features(docs: DataFrame, words: int, percent: int, total: int) -> DataFrame:
    """doc_id, text_key, n, key for each document; sigs (with class, bound and side) and text for the first of each set in a bundle if others share a block of it."""
    bundles = repeats.dealt(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), total)

    def rows(texts):
        hashes, kinds, met = Words(), Classes(percent), set()
        for t in texts:
            s = shingle_set(t, hashes, words)
            key = key_of(s)
            first = len(s) > 0 and key not in met
            met.add(key)
            yield len(s), key, kinds.blocks(s if first else s[:0])

    def names(t):
        return np.concatenate([np.zeros(0, np.uint64), *(b[0] for _, _, b in rows(t.column("text").to_pylist()))])

    def use(t, answers):
        import pyarrow as pa

        texts = t.column("text").to_pylist()
        got = list(rows(texts))
        every = np.concatenate([np.zeros(0, np.uint64), *(b[0] for _, _, b in got)])
        found = repeats.Answers(every, answers, total)
        keep = found.yes | found.often()  # or the bundle itself has it twice
        at, kept = 0, []
        for _, _, (sig, kind, need, side) in got:
            own = keep[at : at + len(sig)]
            at += len(sig)
            kept.append((sig[own].view(np.int64), kind[own], need[own], side[own]))
        return pa.table({
            "doc_id": t.column("doc_id").cast(pa.int64()),
            "text_key": t.column("text_key"),
            "n": pa.array([n for n, _, _ in got], pa.int64()),
            "key": pa.array([k for _, k, _ in got], pa.int64()),
            "sigs": pa.array([x[0] for x in kept], pa.list_(pa.int64())),
            "kinds": pa.array([x[1] for x in kept], pa.list_(pa.int32())),
            "needs": pa.array([x[2] for x in kept], pa.list_(pa.int32())),
            "sides": pa.array([x[3] for x in kept], pa.list_(pa.int32())),
            "text": pa.array([x if len(s[0]) else None for x, s in zip(texts, kept, strict=True)], pa.string()),
        })

    return repeats.answered(bundles, repeats.ask(bundles, names, total), use, "doc_id long, text_key long, n long, key long, sigs array<long>, kinds array<int>, needs array<int>, sides array<int>, text string")


def near_pairs(shared: DataFrame, common: int = COMMON, parts: int | None = None) -> DataFrame:
    """a, b: pairs of keys whose components hold those of all links, with few that do not link.

    Linked sets share at least `need` signatures of a class: the larger one's if both or neither have signatures of empty
    blocks (side > 0), else that of the set which has none (Classes.blocks). A signature that at most `common` keys have
    gives pairs, which are counted. With h commoner ones at a key (f of blocks with elements, all that count where only
    one set has the others), a pair stays if its count and the smaller h or f reach the bound. A pair that shares none but
    common signatures has as many as the bound at both keys; among such keys each hangs on the least one. The bound of a
    key with side > 0 may be its partner's, so it hangs by any common block with elements.
    """
    sig = shared.select("key", F.explode(F.arrays_zip("sigs", "kinds", "needs", "sides")).alias("s")).select(F.col("s.sigs").alias("sig"), "key", F.col("s.kinds").alias("kind"), F.col("s.needs").alias("need"), F.col("s.sides").alias("side")).distinct()
    sizes = sig.groupBy("sig").agg(F.count("*").alias("m")).filter("m > 1")
    met = cut(sig.join(sizes, "sig"), parts)
    often = met.filter(F.col("m") > common).groupBy("key", "kind").agg(F.count("*").alias("h"), F.count(F.when(F.col("side") < 2, 1)).alias("f"))
    rows = met.join(often, ["key", "kind"], "left").withColumns({"h": F.coalesce("h", F.lit(0)), "f": F.coalesce("f", F.lit(0))})
    few = rows.filter(F.col("m") <= common).groupBy("sig", "kind").agg(F.array_sort(F.collect_list(F.struct("key", "need", "h", "f", "side"))).alias("ks"))
    alike = "(x.side > 0) = (y.side > 0)"
    need, h = f"if({alike}, greatest(x.need, y.need), if(x.side > 0, y.need, x.need))", f"if({alike}, least(x.h, y.h), least(x.f, y.f))"
    pairs = few.select("kind", F.explode(F.expr(f"flatten(transform(ks, (x, i) -> transform(slice(ks, i + 2, size(ks)), y -> struct(x.key as a, y.key as b, {need} as need, {h} as h))))")).alias("p")).select("kind", "p.*")
    counted = pairs.groupBy("a", "b", "kind").agg(F.count("*").alias("n"), F.first("need").alias("need"), F.first("h").alias("h")).filter("n + h >= need").select("a", "b")
    many = rows.filter((F.col("m") > common) & ((F.col("h") >= F.col("need")) | (F.col("side") == 1))).select("sig", "key")
    least = many.groupBy("sig").agg(F.min("key").alias("a"))
    hung = many.join(least, "sig").filter("a < key").select("a", F.col("key").alias("b"))
    return counted.unionByName(hung).distinct()


def links(found: DataFrame, words: int, percent: int, rows: int = ROWS, parts: int | None = None) -> DataFrame:
    """a, b: keys of linked sets; their components are those of all links."""
    shared = found.filter(F.size("sigs") > 0)
    near = near_pairs(shared, parts=parts)
    clusters = cut(components(near), parts)
    lengths = shared.groupBy("key").agg(F.first("n").alias("n"))
    sizes = clusters.join(lengths, F.col("key") == F.col("node")).groupBy("component").agg(F.greatest(F.ceil(F.count("*") / rows), F.ceil(F.sum("n") / SHINGLES)).cast("long").alias("blocks"))
    members = clusters.join(sizes, "component").select(F.col("node").alias("key"), "component", "blocks", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).alias("own"))
    texts = shared.groupBy("key").agg(F.first("text").alias("text"))
    sent = members.join(texts, "key").withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "key", "text")

    def multiply(t):
        import pyarrow as pa

        hashes, keys = Words(), t.column("key").to_pylist()
        found = product_links([shingle_set(x, hashes, words) for x in t.column("text").to_pylist()], percent)
        return pa.table({"a": pa.array([keys[i] for i, _ in found], pa.int64()), "b": pa.array([keys[j] for _, j in found], pa.int64())})

    return sent.groupBy("component", "i", "j").applyInArrow(multiply, "a long, b long")


def grouped(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_key (xxhash64 of text), n, key (of the set) for every row of docs; and node, component of keys with links."""
    total = repeats.volume(docs)
    parts = parts_for(total, 8 << 20, 8)
    found = cut(features(docs, words, percent, total), parts)
    return found, cut(components(links(found, words, percent, rows, parts)), parts)


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links reach) for every row of docs(doc_id, text)."""
    found, groups = grouped(docs, words, percent, rows)
    whole = found.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("low")).join(groups, F.col("key") == F.col("node"), "left").select("key", "low", F.coalesce("component", "key").alias("component"))
    least = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    by_key = whole.join(least, "component").select("key", "component_id")
    return found.select("doc_id", "n", "key").join(by_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_jaccard(spark, sf_dir):
    return join(table(spark, sf_dir, "documents"))
