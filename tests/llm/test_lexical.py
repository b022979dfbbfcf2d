import math
import random
import re

import numpy as np
import pytest

from skyloom.llm import lexical

duckdb = pytest.importorskip("duckdb")
COLUMNS = ["item_id", "rank", "doc_id", "score"]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    own = [(i, split(t)) for i, t in docs]
    own = [(i, t) for i, t in own if t]
    n, total = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, t in own:
            m = 25 + 75 * len(t) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in split(text) if x in df)
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, rank int")


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "item_id long, text string, doc_id int")


def test_terms():
    text = "Ab-c9_É\x00Ünï İK [x]{y}`z@A/B:C;\x7f日本　語   \x85q\x1cr"
    assert [t.decode() for t in lexical.terms_of(text)] == split(text) and lexical.terms_of(None) == []


@pytest.mark.parametrize(("block", "size", "widths"), [(lexical.BLOCK, lexical.QUERIES, lexical.WIDTHS), (8, 60, (1, 2))])
def test_same_rows_as_brute_force(spark, block, size, widths):
    rng = random.Random(block)
    words = [f"{'abcé'[i % 4]}{i}" for i in range(60)]
    text = lambda n, top: " ".join(words[min(int(rng.expovariate(1 / top)), 59)] for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]), rng.choice([3, 20, 50]))) for i in range(160)]
    docs += [(None, docs[3][1]), (None, None), (900, ""), (901, " .,- "), (902, "A1 a1 A1"), (3, docs[3][1]), (3, docs[3][1]), (-5, docs[3][1]), (903, "long " * 50_000 + " a0 ")] + [(1000 + i, docs[7][1]) for i in range(60)]
    items = [(i, text(rng.choice([1, 4, 25]), 30)) for i in range(12)] + [(50, docs[7][1]), (51, docs[3][1].upper()), (52, None), (53, ""), (54, "nowhere"), (55, "a0 " * 40), (0, "a1 a1"), (0, "a1 a1"), (None, "b1")]
    told = []
    got = lexical.rank(docs_of(spark, docs), items_of(spark, items), block=block, size=size, widths=widths, sample=64, told=told)
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=str) == brute(docs, [x for x in items if x[1] is not None])
    assert all(made[-1] == 0 and sum(made) <= bounds for _, bounds, made in told) and (len(told) > 1) == (size == 60)


def test_empty_tables(spark):
    some = [(1, "a b"), (2, "b c")]
    for docs, items in (([], some), (some, []), ([], []), ([(1, None)], some), (some, [(1, None)])):
        assert lexical.rank(docs_of(spark, docs), items_of(spark, items)).count() == 0


def test_bisection_finds_planted_clusters():
    """Documents of four vocabularies end in leaves that hold one vocabulary each."""
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 4, 800)
    sets = [np.unique(rng.integers(0, 200, 40) + 200 * k).astype(np.uint16) for k in kind]
    tree = lexical.bisected(sets[:512], 800, 4)
    leaf = tree.leaves(sets)
    assert tree.depth == 4 and len(np.unique(leaf)) == 16
    pure = sum(np.bincount(kind[leaf == x]).max() for x in np.unique(leaf))
    assert pure >= 0.95 * len(sets)


def test_blocks_are_left_out_when_bounds_allow(spark):
    """Clusters of words of their own: a query's blocks are a small share of all."""
    rng = random.Random(5)
    docs = [(i, " ".join(f"t{i % 8}x{rng.randrange(80)}" for _ in range(30))) for i in range(1600)]
    items = [(i, f"t{i}x1 t{i}x2 t{i}x3") for i in range(8)]
    told = []
    got = lexical.rank(docs_of(spark, docs), items_of(spark, items), block=32, widths=(1, 2), sample=512, told=told)
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=str) == brute(docs, items)
    blocks, bounds, made = told[0]
    assert bounds < 0.5 * blocks * len(items) and sum(made) < bounds


def test_query_equals_its_sql(spark):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    got = lexical.op11_lexical(spark, "/root/testdata/sf0.01").select(COLUMNS)
    want = c.sql(f"SELECT {', '.join(COLUMNS)} FROM ({lexical.ORACLE_SQL})").fetchall()
    assert len(want) == 400 and sorted(map(tuple, got.collect())) == sorted(want)
