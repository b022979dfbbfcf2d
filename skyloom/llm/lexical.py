"""Ranked lexical search over documents in an order made by recursive graph bisection.

1. Bisection. A bounded sample of documents (SAMPLE rows by hash, sets of hashed terms of BUCKETS kinds) is halved again
   and again; in each node documents change sides in pairs, by descending gain, for as long as that lowers the cost of the
   gaps of each term's postings (Dhulipala et al., 2016). What is kept of a node is the gain of each hashed term and the
   median of the sample's sums, and with these *every* document finds its leaf, as the sample's did.
2. Clustered index. Documents of a leaf and of like length make blocks of about BLOCK rows. A block has, of each term that
   a query asks for, the documents and impacts, and the greatest impact.
3. Search. A query's bound for a block is the sum of its terms' weights by their greatest impacts there. Blocks are visited
   by descending bound, WIDTHS[0] at first and more each round, until no block that is left has a bound as high as the
   query's k-th score. Blocks with an equal bound are visited, too, since equal scores go by doc_id: a block's rows carry
   their doc_ids, so that the new order decides nothing. The result is exact, whatever the clusters are worth.

Terms are what `terms_of` takes; df, N and L are counted over all documents. Queries are taken in groups of about QUERIES
bytes of text: a group's terms and weights go to all tasks, and the index of a group has its terms only. What else the
driver gets is the sample's sets (SAMPLE * BUCKETS * 2 bytes at most) and a count for each leaf and class of lengths.

Defined results: a null or empty text has no terms, neither in documents (not counted in N) nor in queries (no rows). Every
row of documents is one document; null doc_ids come after all others of equal score. Rows of queries that are alike are
one query, and texts that share an item_id are ranked apart. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import cut, parts_for, shared_folder, table

#: Each byte as it stands in a term: ASCII letters in lower case, digits and bytes of other characters; others are blanks.
FOLD = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))
K = 10
SAMPLE, BUCKETS, DEPTH, ROUNDS = 4096, 1 << 14, 6, 10
#: Sampled documents that a leaf is meant to have at least.
LEAF = 32
BLOCK, QUERIES = 2048, 16 << 20
WIDTHS = (2, 8)
FORWARD = "doc_id long, n long, leaf int, terms array<int>, tfs array<int>"
INDEX = "block long, docs array<long>, terms array<int>, counts array<int>, tops array<long>, at binary, impacts binary"


def terms_of(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters and digits and of characters beyond ASCII, only A-Z folded."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _ln(n: int | float, d: np.ndarray) -> np.ndarray:
    """Cost in bits of a term's gaps, of d documents among n."""
    return d * np.log2(max(n, 1) / (d + 1.0))


class Tree:
    """Leaves of a recursive bisection, and how a document finds its own. Node i has children 2i + 1 and 2i + 2."""

    def __init__(self, depth: int, buckets: int):
        self.depth, self.buckets = depth, buckets
        self.gain = np.zeros(((1 << depth) - 1, buckets), np.float32)
        self.middle = np.zeros((1 << depth) - 1)

    def leaves(self, sets: list[np.ndarray]) -> np.ndarray:
        """The leaf of each set of buckets, 0 to 2**depth - 1."""
        node = np.zeros(len(sets), np.int64)
        if not len(sets) or not self.depth:
            return node
        size = np.array([len(s) for s in sets])
        flat, row = np.concatenate(sets).astype(np.int64), np.repeat(np.arange(len(sets)), size)
        for _ in range(self.depth):
            sums = np.bincount(row, self.gain[node[row], flat], len(sets))
            node = 2 * node + 1 + (sums < self.middle[node])
        return node - len(self.middle)


def bucket_of(term: bytes, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term) % buckets


def bisected(sets: list[np.ndarray], buckets: int = BUCKETS, depth: int = DEPTH, rounds: int = ROUNDS, leaf: int = LEAF) -> Tree:
    """The tree of a sample's sets of buckets."""
    while depth and len(sets) < leaf << depth:
        depth -= 1
    tree = Tree(depth, buckets)

    def sums(weights, docs):
        size = np.array([len(sets[d]) for d in docs])
        flat = np.concatenate([sets[d] for d in docs]).astype(np.int64)
        return np.bincount(np.repeat(np.arange(len(docs)), size), weights[flat], len(docs))

    def degrees(docs):
        return np.bincount(np.concatenate([sets[d] for d in docs]).astype(np.int64), minlength=buckets).astype(np.float64)

    todo = [(0, np.arange(len(sets)))] if depth else []
    for node, docs in todo:
        half = len(docs) // 2
        left, right = docs[:half], docs[half:]
        for _ in range(rounds):
            dl, dr, nl, nr = degrees(left), degrees(right), len(left), len(right)
            now = _ln(nl, dl) + _ln(nr, dr)
            go = now - _ln(nl, np.maximum(dl - 1, 0)) - _ln(nr, dr + 1)  # what a document's move to the right saves
            come = now - _ln(nl, dl + 1) - _ln(nr, np.maximum(dr - 1, 0))
            a, b = sums(go, left), sums(come, right)
            x, y = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
            n = min(len(x), len(y))
            swap = a[x[:n]] + b[y[:n]] > 1e-9
            n = n if swap.all() else int(np.argmin(swap))
            if not n:
                break
            left, right = np.r_[left[x[n:]], right[y[:n]]], np.r_[right[y[n:]], left[x[:n]]]
        dl, dr, nl, nr = degrees(left), degrees(right), len(left), len(right)
        tree.gain[node] = (_ln(nr, dr + 1) - _ln(nr, dr)) - (_ln(nl, dl + 1) - _ln(nl, dl))  # what a document costs more on the right
        own = np.bincount(np.repeat(np.arange(len(docs)), [len(sets[d]) for d in docs]), tree.gain[node][np.concatenate([sets[d] for d in docs]).astype(np.int64)], len(docs))
        tree.middle[node] = float(np.median(own))
        if 2 * node + 1 < len(tree.middle):
            todo += [(2 * node + 1, docs[own >= tree.middle[node]]), (2 * node + 2, docs[own < tree.middle[node]])]
            todo[-2:] = [(i, d) for i, d in todo[-2:] if len(d) > 1]
    return tree


def fit(docs: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, depth: int = DEPTH) -> Tree:
    """The tree of a sample of docs(doc_id, text): rows of the least hashes, equal sets once."""
    total, kinds = docs.count(), 1 << 20
    order = F.xxhash64(F.lit(17), "doc_id", "text")
    some = docs.select(order.alias("h"), "text").filter(F.pmod("h", F.lit(kinds)) <= min(kinds, 2 * sample * kinds // max(1, total)))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [np.unique(np.array([bucket_of(t, buckets) for t in set(terms_of(x))], np.uint16)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["h", "found"])

    rows = some.mapInArrow(run, "h long, found binary").orderBy("h", "found").limit(sample).collect()
    return bisected([np.frombuffer(b, np.uint16) for b in dict.fromkeys(bytes(r["found"]) for r in rows) if b], buckets, depth)


def forward(docs: DataFrame, tree: Tree, terms: list[bytes]) -> DataFrame:
    """FORWARD of every document with terms: its number of terms, its leaf, and those of the given terms that it has."""
    seed = docs.sparkSession.sparkContext.broadcast((tree, terms))  # fixed size; a group of queries

    def run(batches):
        import pyarrow as pa

        own, names = seed.value
        number, known = {t: i for i, t in enumerate(names)}, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                ids, counts = [], []
                for i, t in zip(batch.column(0).slice(at, 512).to_pylist(), batch.column(1).slice(at, 512).to_pylist(), strict=True):
                    if found := Counter(terms_of(t)):
                        ids.append(i)
                        counts.append(found)
                if len(known) > 1 << 18:
                    known.clear()
                sets = []
                for c in counts:
                    for t in c:
                        if t not in known:
                            known[t] = bucket_of(t, own.buckets)
                    sets.append(np.unique(np.fromiter(map(known.__getitem__, c), np.int64, len(c))))
                asked = [[(number[t], n) for t, n in c.items() if t in number] for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([c.total() for c in counts], pa.int64()), pa.array(own.leaves(sets), pa.int32()), pa.array([[t for t, _ in a] for a in asked], pa.list_(pa.int32())), pa.array([[n for _, n in a] for a in asked], pa.list_(pa.int32()))],
                    names=["doc_id", "n", "leaf", "terms", "tfs"],
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, FORWARD)


def blocked(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of `forward` that have asked-for terms, with the block of each: a leaf's documents of like length, cut by hash of the row."""
    kept = rows.filter(F.size("terms") > 0).withColumn("length", F.floor(F.log2("n")).cast("int"))
    sizes = kept.groupBy("leaf", "length").agg(F.count("*").alias("m")).orderBy("leaf", "length").collect()  # leaves by classes
    table_, at = [], 0
    for r in sizes:
        table_.append((r["leaf"], r["length"], at, parts_for(r["m"], block)))
        at += table_[-1][-1]
    where = F.broadcast(rows.sparkSession.createDataFrame(table_, "leaf int, length int, first long, parts long"))
    return kept.join(where, ["leaf", "length"]).select((F.col("first") + F.pmod(F.xxhash64(F.lit(23), "row"), F.col("parts"))).alias("block"), "doc_id", "n", "terms", "tfs")


def inverted(n_docs: int, n_terms: int):
    """A block's documents to its INDEX row, for a corpus of n_docs documents with n_terms terms."""

    def run(t):
        import pyarrow as pa

        t = t.sort_by([("n", "ascending"), ("doc_id", "ascending")])
        terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
        size = np.diff(terms.offsets.to_numpy())
        term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        m = 25 + np.array([75 * n * n_docs // n_terms for n in t.column("n").to_pylist()], np.int64)
        row = np.repeat(np.arange(t.num_rows), size)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
        order = np.argsort(term, kind="stable")
        names, first, counts = np.unique(term[order], return_index=True, return_counts=True)
        tops = np.maximum.reduceat(impact[order], first)
        cells = [t.column("block")[0].as_py(), t.column("doc_id").to_pylist(), names, counts, tops, row[order].astype("<i4").tobytes(), impact[order].astype("<i4").tobytes()]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.table([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

    return run


def searched(k: int, wanted_terms):
    """Of INDEX rows with `items` to score there: the k best rows of each item in that block: item, doc_id, score."""

    def run(batches):
        import pyarrow as pa

        weights = wanted_terms.value
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids, null = np.array([0 if d is None else d for d in r["docs"]], np.int64), np.array([d is None for d in r["docs"]])
                at, impact = np.frombuffer(r["at"], "<i4"), np.frombuffer(r["impacts"], "<i4").astype(np.int64)
                ends = np.cumsum(r["counts"])
                place = {t: (e - c, e) for t, c, e in zip(r["terms"], r["counts"], ends.tolist(), strict=True)}
                out = [], [], []
                for item in r["items"]:
                    score = np.zeros(len(ids), np.int64)
                    for t, w in weights[item]:
                        if w and t in place:
                            a, b = place[t]
                            score[at[a:b]] += w * impact[a:b]
                    found = np.flatnonzero(score)
                    if len(found) > k:
                        found = found[score[found] >= np.partition(score[found], -k)[-k]]
                    best = found[np.lexsort((ids[found], null[found], -score[found]))[:k]]
                    out[0].extend([item] * len(best))
                    out[1].extend(r["docs"][i] for i in best.tolist())
                    out[2].extend(score[best].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=["item", "doc_id", "score"])

    return run


def ordered(rows: DataFrame, k: int) -> DataFrame:
    """The k first rows of each item, with their rank."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def visits(index: DataFrame, bounds: DataFrame, weights: dict, k: int, widths: tuple[int, int]) -> tuple[DataFrame, list[int]]:
    """The k best rows of each item, from blocks by descending bound; and how many visits each round made."""
    spark = index.sparkSession
    seed = spark.sparkContext.broadcast(weights)
    best, open_, width, made = spark.createDataFrame([], "item long, doc_id long, score long, rank int"), bounds, widths[0], []
    while True:
        turn = Window.partitionBy("item").orderBy(F.col("bound").desc(), "block")
        now = cut(open_.withColumn("__n", F.row_number().over(turn)).filter(F.col("__n") <= width).select("item", "block"), 16)
        made.append(now.count())
        if not made[-1]:
            return best, made
        asked = now.groupBy("block").agg(F.collect_list("item").alias("items"))  # at most a group's queries
        hits = index.join(asked, "block").select("docs", "terms", "counts", "at", "impacts", "items").mapInArrow(searched(k, seed), "item long, doc_id long, score long")
        best = cut(ordered(best.select("item", "doc_id", "score").unionByName(hits), k), 16)
        least = best.filter(F.col("rank") == k).select("item", F.col("score").alias("least"))
        open_ = cut(open_.join(now, ["item", "block"], "left_anti").join(least, "item", "left").filter(F.col("bound") >= F.coalesce("least", F.lit(1))).drop("least"), 64)
        width *= widths[1]


def grouped(queries: DataFrame, size: int = QUERIES) -> list[DataFrame]:
    """Distinct rows of queries(item_id, text), with `item` numbers, in groups of about `size` bytes of text."""
    own = queries.selectExpr("CAST(item_id AS BIGINT) AS item_id", "text").filter("text is not null").distinct()
    n = parts_for(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0, size)
    return [own.filter(F.pmod(F.xxhash64(F.lit(29), "item_id", "text"), F.lit(n)) == i) for i in range(n)]


def rank(docs: DataFrame, queries: DataFrame, k: int = K, sample: int = SAMPLE, block: int = BLOCK, size: int = QUERIES, widths: tuple[int, int] = WIDTHS, told: list | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of docs(doc_id, text) that score highest for each row of queries(item_id, text).

    told: gets, of each group of queries, the number of blocks, of bounds, and of visits by round.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", "text")
    home, out = f"{shared_folder(spark)}/lexical-{uuid.uuid4()}", spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    tree = fit(docs, sample)
    for g, group in enumerate(grouped(queries, size)):
        items = [(r["item_id"], Counter(terms_of(r["text"]))) for r in group.collect()]
        terms = sorted({t for _, c in items for t in c})
        number = {t: i for i, t in enumerate(terms)}
        if not terms:
            continue
        forward(docs, tree, terms).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{home}/{g}/forward")
        rows = spark.read.parquet(f"{home}/{g}/forward")
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        blocked(rows, block).groupBy("block").applyInArrow(inverted(n_docs, n_terms), INDEX).write.parquet(f"{home}/{g}/index")
        index = spark.read.parquet(f"{home}/{g}/index")
        lists = index.select("block", F.explode(F.arrays_zip("terms", "counts", "tops")).alias("x")).select("block", F.col("x.terms").alias("term"), F.col("x.counts").alias("n"), F.col("x.tops").alias("top"))
        weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.sum("n") + 1)))
        w = dict(lists.groupBy("term").agg(weight.cast("long").alias("w")).collect())  # a group's terms
        weights = {i: [(number[t], w.get(number[t], 0) * n) for t, n in c.items()] for i, (_, c) in enumerate(items)}
        asked = spark.createDataFrame([(t, i, x) for i, ts in weights.items() for t, x in ts if x], "term int, item long, w long")
        bounds = cut(lists.join(F.broadcast(asked), "term").groupBy("item", "block").agg(F.sum(F.col("w") * F.col("top")).alias("bound")).filter("bound > 0"), 64)
        best, made = visits(index, bounds, weights, k, widths)
        if told is not None:
            told.append((index.count(), bounds.count(), made))
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item long, item_id long")
        out = out.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op11_lexical(spark, sf_dir):
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
 tf AS (SELECT doc_id, len(t) AS n, UNNEST(t) AS term FROM d),
 p AS (SELECT doc_id, n, term, COUNT(*) AS tf FROM tf GROUP BY ALL),
 c AS (SELECT COUNT(*) AS docs, CAST(SUM(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
 w AS (SELECT term, CAST(FLOOR(1000 * LN(CAST(2 * docs + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
 q AS (SELECT item_id, UNNEST({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
 s AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY ALL),
 r AS (SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
 SELECT * FROM r WHERE rank <= {K}"""
