"""Embedding near-duplicates through an inverted multi-index.

The halves of the unit vectors get a codebook each, fitted by k-means on a bounded sample (`sample` rows, the first by a
hash of the vector, equal ones once); the pairs of their centroids are the cells of a product grid, and every vector is filed under its own.
A vector's query visits cells by ascending sum of its two distances to the cell's centroids (multi-sequence order) and
is compared in double precision with all that is filed there. How many cells are visited is measured: QUERIES of the
sample's vectors, or all of the sample if fewer than LINKED of those have links, are compared with all distinct vectors.
It is the least number by which `recall` of a query's links are reached, as a mean over the queries that have links.
Where MOST_CELLS do not reach that, or too few queries have links to tell, every vector is compared with all others.

Equal vectors are one entry with a multiplicity. A cell's entries and visitors are cut into blocks of ROWS; each pair of
blocks is one task's work, which returns a count for each visitor and a spanning forest of the links, never the pairs.
So a group of near copies of any size is spread over as many tasks as it has pairs of blocks. A link that only one of
its ends finds counts for both. What the driver gets is the sample; what is sent to all tasks is the codebooks, 2 * books * dimension / 2 numbers.

Defined results: vectors that are null or zero, or hold null or non-finite components, link with nothing. Vectors whose
dimension is not the sample's commonest are compared with all of their own dimension. Odd dimensions split unevenly.
Repeated rows link with each other. Rows with a null vec_id take part, too; their own component_id is that of their
links or null. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, parts_for, table
from skyloom.llm.components import components

COSINE = 0.9
SAMPLE = 16384
RECALL = 0.995
#: Least and most centroids of a half, and the entries a cell is meant to have.
BOOKS, PER_CELL = (4, 512), 16
ROWS = 1024
MOST_CELLS = 256
#: Vectors whose links are all found to set the number of cells, and the least number of them that must have some.
QUERIES, LINKED = 2048, 100


def unit(values) -> np.ndarray | None:
    """The vector at length 1, or None where it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    top = np.abs(x).max() if np.isfinite(x).all() else 0.0
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    book = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ book.T - (book**2).sum(1) / 2, 1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=len(book))
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


class Index:
    def __init__(self, first: np.ndarray, second: np.ndarray, cells: int):
        self.first, self.second, self.cells, self.recall = first, second, cells, None
        self.half, self.dim = first.shape[1], first.shape[1] + second.shape[1]

    def order(self, x: np.ndarray, cells: int) -> np.ndarray:
        """Each row's first `cells` cells in multi-sequence order. Only ranks with (a+1)(b+1) <= cells can be among them."""
        parts = []
        for y, book in ((x[:, : self.half], self.first), (x[:, self.half :], self.second)):
            d = (y**2).sum(1)[:, None] - 2 * y @ book.T + (book**2).sum(1)
            o = np.argsort(d, 1, kind="stable")[:, : min(cells, len(book))]
            parts.append((o, np.take_along_axis(d, o, 1)))
        (o1, d1), (o2, d2) = parts
        a, b = np.array([(a, b) for a in range(o1.shape[1]) for b in range(o2.shape[1]) if (a + 1) * (b + 1) <= cells]).T
        total = d1[:, a] + d2[:, b]
        pick = np.argsort(total, 1, kind="stable")[:, :cells]
        return o1[:, a].astype(np.int64)[np.arange(len(x))[:, None], pick] * len(self.second) + o2[:, b].astype(np.int64)[np.arange(len(x))[:, None], pick]

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.order(x, 1)[:, 0]


def keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, key (of the vector's value; null if it links with nothing), vec."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw = [None if u is None else u.tobytes() for u in map(unit, batch.column(1).to_pylist())]
            keys = [None if r is None else hashlib.md5(r).hexdigest() for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(keys, pa.string()), pa.array(raw, pa.binary())], names=["vec_id", "key", "vec"])

    return vectors.mapInArrow(run, "vec_id long, key string, vec binary")


def reached(entries: DataFrame, index: Index, queries: np.ndarray, cosine: float, most: int) -> tuple[int, np.ndarray]:
    """How many of the queries have links among all entries, and the mean share of a query's links by 1, 2, ... `most` cells."""
    seed = entries.sparkSession.sparkContext.broadcast((index, queries, np.concatenate([index.order(queries[a : a + 512], most) for a in range(0, len(queries), 512)]).astype(np.int32)))

    def run(batches):
        import pyarrow as pa

        own, q, order = seed.value
        for batch in batches:
            vecs = [np.frombuffer(v, np.float64) for v in batch.column(0).to_pylist()]
            vecs = [v for v in vecs if len(v) == own.dim]
            for at in range(0, len(vecs), 512):
                y = np.stack(vecs[at : at + 512])
                home = own.home(y).astype(np.int32)
                ranks = {}
                for lo in range(0, len(q), 512):
                    i, j = np.nonzero(q[lo : lo + 512] @ y.T >= cosine)
                    other = (q[lo + i] != y[j]).any(1)
                    i, j = i[other] + lo, j[other]
                    for c in range(0, len(i), 4096):
                        seen = order[i[c : c + 4096]] == home[j[c : c + 4096]][:, None]
                        pairs = i[c : c + 4096].astype(np.int64) * (most + 1) + np.where(seen.any(1), seen.argmax(1), most)
                        for p, n in zip(*(x.tolist() for x in np.unique(pairs, return_counts=True)), strict=True):
                            ranks[p] = ranks.get(p, 0) + n
                yield pa.RecordBatch.from_arrays([pa.array([p // (most + 1) for p in ranks], pa.int64()), pa.array([p % (most + 1) for p in ranks], pa.int64()), pa.array(list(ranks.values()), pa.int64())], names=["q", "rank", "n"])

    met = cut(entries.select("vec").mapInArrow(run, "q long, rank long, n long").groupBy("q", "rank").agg(F.sum("n").alias("n")))
    totals = met.groupBy("q").agg(F.sum("n").alias("all"))
    found = met.join(totals, "q").groupBy("rank").agg(F.sum(F.col("n") / F.col("all")).alias("share")).collect()
    share = np.zeros(most + 1)
    for r in found:
        share[r["rank"]] = r["share"]
    return round(share.sum()), np.cumsum(share)[:most] / max(share.sum(), 1e-9)


def fit(entries: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, recall: float = RECALL, queries: int = QUERIES) -> Index | None:
    """The index of distinct vectors entries(key, vec); None where all are to be compared with all."""
    n = entries.count()
    rows = entries.orderBy(F.xxhash64(F.lit(11), "key"), "key").limit(sample).select("vec").collect()
    got = [np.frombuffer(r[0], np.float64) for r in rows]
    if not got:
        return None
    dims, counts = np.unique([len(u) for u in got], return_counts=True)
    x = np.stack([u for u in got if len(u) == dims[counts.argmax()]])
    if x.shape[1] < 2:
        return None
    k = int(min(max(BOOKS[0], np.sqrt(n / PER_CELL)), BOOKS[1]))
    half = x.shape[1] // 2
    index = Index(kmeans(x[:, :half], k), kmeans(x[:, half:], k), 1)
    most = min(MOST_CELLS, len(index.first) * len(index.second))
    linked, shares = reached(entries, index, x[:queries], cosine, most)
    if linked < LINKED and len(x) > queries:
        linked, shares = reached(entries, index, x, cosine, most)
    enough = np.flatnonzero(shares >= recall)
    if not len(enough) or (linked < LINKED and len(got) < n):
        return None
    index.cells = min(most, max(8, int(enough[0]) + 1))
    index.recall = float(shares[index.cells - 1])
    return index


def filed(entries: DataFrame, index: Index | None) -> DataFrame:
    """entries with cell, visits."""
    seed = entries.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        import pyarrow as pa

        own = seed.value
        for batch in batches:
            units = [np.frombuffer(v, np.float64) for v in batch.column("vec").to_pylist()]
            usual = [i for i, u in enumerate(units) if own is not None and len(u) == own.dim]
            cells = [-len(u) for u in units]
            visits = [[c] for c in cells]
            for at in range(0, len(usual), 512):
                some = usual[at : at + 512]
                for i, v in zip(some, own.order(np.stack([units[i] for i in some]), own.cells).tolist(), strict=True):
                    cells[i], visits[i] = v[0], v
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64()), pa.array(visits, pa.list_(pa.int64()))], names=[*batch.schema.names, "cell", "visits"])

    return entries.mapInArrow(run, "key string, low long, times long, vec binary, cell long, visits array<long>")


def compare(cosine: float):
    """For one block of a cell's entries and one of its visitors: a row for each vector with links, and forest edges.

    A visitor counts each link that it finds. Its partner counts the link here, too, unless it visits the visitor's own
    cell and so finds it itself; both ends of a link count it once.
    """

    def run(t):
        import pyarrow as pa

        sides = np.array(t.column("visitor").to_pylist())
        ids = np.array(t.column("id").to_pylist(), np.int64)
        times = np.array(t.column("times").to_pylist(), np.int64)
        home = np.array(t.column("home").to_pylist(), np.int64)
        vecs = np.stack([np.frombuffer(v, np.float64) for v in t.column("vec").to_pylist()])
        q, m = np.flatnonzero(sides), np.flatnonzero(~sides)
        near = vecs[q] @ vecs[m].T >= cosine
        near &= ids[q][:, None] != ids[m][None, :]
        links = near @ times[m]
        hit = np.flatnonzero(links)
        met = np.flatnonzero(near.any(0))
        visits = [set(v) for v in t.column("visits").take(m[met]).to_pylist()]
        cells, own = np.unique(home[q[hit]], return_inverse=True)
        back = np.zeros(len(m), np.int64)
        for k, c in enumerate(cells.tolist()):
            unseen = met[[c not in v for v in visits]]
            if len(unseen):
                some = hit[own == k]
                back[unseen] += times[q[some]] @ near[np.ix_(some, unseen)]
        out = [(int(ids[q[i]]), None, int(links[i])) for i in hit]
        out += [(int(ids[m[i]]), None, int(back[i])) for i in np.flatnonzero(back)]
        place = {int(v): i for i, v in enumerate(np.unique(ids))}
        root = np.arange(len(place))
        mine, theirs = np.array([place[int(v)] for v in ids[q]], np.int64), np.array([place[int(v)] for v in ids[m]], np.int64)
        for i in hit.tolist():
            ys = np.flatnonzero(near[i])
            _, first = np.unique(root[theirs[ys]], return_index=True)
            for y in ys[first].tolist():
                a, b = root[mine[i]], root[theirs[y]]
                if a != b:
                    root[root == max(a, b)] = min(a, b)
                    out.append((int(ids[q[i]]), int(ids[m[y]]), 0))
        cols = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table({"id": pa.array(cols[0], pa.int64()), "other": pa.array(cols[1], pa.int64()), "links": pa.array(cols[2], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors(vec_id, embedding)."""
    vectors = vectors.select("vec_id", "embedding")
    all_ = cut(keyed(vectors))
    parts = parts_for(all_.count(), 20_000, 8)
    distinct = cut(all_.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("vec_id").alias("low"), F.count("*").alias("times"), F.first("vec").alias("vec")), parts)
    entries = cut(filed(distinct, fit(distinct, cosine, sample, recall)).withColumn("id", F.xxhash64("key")), parts)
    blocks = lambda n: F.ceil(F.col(n) / rows).cast("long")
    visits = entries.select("id", "times", "vec", F.col("cell").alias("home"), F.explode("visits").alias("cell"))
    filed_ = entries.select("id", "times", "vec", F.col("cell").alias("home"), "visits", "cell")
    sizes = entries.groupBy("cell").agg(F.count("*").alias("m")).join(visits.groupBy("cell").agg(F.count("*").alias("v")), "cell").select("cell", blocks("m").alias("ms"), blocks("v").alias("vs"))
    sizes = cut(sizes, parts)
    spread = lambda df, own, other, i, j, who: df.join(sizes, "cell").select("cell", F.pmod(F.xxhash64(F.lit(5), "id"), F.col(own)).alias(i), F.explode(F.expr(f"sequence(0L, {other} - 1)")).alias(j), F.lit(who).alias("visitor"), "id", "times", "vec", "home", "visits")
    both = spread(filed_, "ms", "vs", "i", "j", False).unionByName(spread(visits.withColumn("visits", F.lit(None).cast("array<bigint>")), "vs", "ms", "j", "i", True))
    found = cut(both.groupBy("cell", "i", "j").applyInArrow(compare(cosine), "id long, other long, links long"), parts)
    links = found.filter("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    groups = cut(components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))), parts)
    whole = entries.select("id", "key", "low", "times").join(groups, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
    least = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    by_key = whole.join(links, "id", "left").join(least, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"), "component_id")
    return (
        all_.select("vec_id", "key")
        .join(by_key, "key", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def op9_multi_index(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
