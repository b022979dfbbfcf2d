import hashlib
import random
import zlib

import numpy as np
import pytest

from skyloom.llm import periodic


def brute(words, least=24, times=3):
    """Every maximal stretch at every distance, the smallest distance for equal ends."""
    ids, found = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if len(words) else np.zeros(0, np.int64), {}
    for d in range(1, len(ids)):
        equal = np.r_[False, ids[d:] == ids[:-d], False]
        ends = np.flatnonzero(equal[1:] != equal[:-1])
        for i, j in zip(ends[::2].tolist(), ends[1::2].tolist(), strict=True):
            if j - i + d >= max(least, times * d):
                found.setdefault((i, j - i + d), d)
    return sorted((s, n, d) for (s, n), d in found.items())


def planted(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(max(1, n)), rng.randrange(1, max(2, n // 3))
        for i in range(a + p, min(n, a + rng.randrange(p, 6 * p + 30))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("segment", [8, 40, periodic.SEGMENT])
def test_runs_match_brute_force(segment):
    rng = random.Random(segment)
    for _ in range(400):
        words = planted(rng, rng.choice([0, 1, 23, 24, 25, 40, 90, 200, 333]), rng.choice([1, 2, 3, 50]))
        assert periodic.runs(np.array(words, np.int64), segment=segment) == brute(words), words


def test_every_period_and_place():
    """The least run of each period, at every place against the blocks."""
    for q in [*range(1, 36), 63, 64, 65, 127, 128]:
        for start in range(0, 2 * q + 20, 1 if q < 12 else 7):
            length = max(24, 3 * q)
            words = [1000 + i for i in range(start)] + [i % q for i in range(length)] + [5000 + i for i in range(20)]
            assert (start, length, q) in periodic.runs(np.array(words, np.int64)), (q, start)
            assert not periodic.runs(np.array(words[: start + length - 1] + words[start + length :], np.int64))


def test_bounds_of_the_method():
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(9, np.int64), least=21)
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(9, np.int64), times=2)


def expected(doc_id, text):
    words = (text or "").encode().split()
    if words and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    tail = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tail, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_documents(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "one", "same " * 100, "a b c " * 40, "long " + "x y " * 3_000, "  ".join(f"w{x}" for x in planted(rng, 300, 30)), "é ü é ü " * 30]
    texts += [" ".join(f"w{x}" for x in planted(rng, 150, 60)) for _ in range(150)]
    rows = [(i * 7, t, i, "x") for i, t in enumerate(texts) if t is None or len(t) < 5_000] + [(None, "z z " * 20, 1, "x"), (7, "twice " * 30, 1, "x"), (7, "twice " * 30, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long, runs string")
    got = periodic.detect(df, words=periodic.folded, spans=False).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(i, t) for i, t, *_ in rows), key=str)
    assert periodic.detect(df.limit(0)).count() == 0


def test_long_text_of_few_runs(spark):
    df = spark.createDataFrame([(1, "long " + "x y " * 10_000 + "end"), (2, " ".join(f"w{i % 7_000}" for i in range(21_000)))], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.detect(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 20_000, 2)] and got[1].collapsed == "long x y end"
    assert [tuple(x) for x in got[2].runs] == [(0, 21_000, 7_000)] and got[2].exponent_milli == 3000


def test_query_on_real_documents(spark):
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 4000]
    got = {r.doc_id: tuple(r) for r in periodic.op12_periodic(spark, "/root/testdata/sf0.01").select(COLUMNS).collect()}
    assert len(got) == 1000
    for r in rows[::3]:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
