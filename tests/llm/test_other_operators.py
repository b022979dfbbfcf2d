import numpy as np
import pytest

from skyloom.llm import mixing, multi_index, url_graph
from skyloom.llm.components import components

# -- url graph ---------------------------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string, rank int")


def test_rules_and_parts_of_urls(spark):
    rows = [("HTTP://A.Com/x?q#f", None), (None, None), ("no scheme", None), ("http://b.net/es/", None), ("https://www.example.com/en/a#x", None), ("https://x.example.com/en/a", None), ("http://b.net/es/a://b", None), ("http://COM", None), ("x://example.com?en", None), ("http://É.net/fr/1", None), ("http://badexample.com/en/", None)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_graph.judge(pages(spark, rows)).collect()}
    assert got[0] == ("a.com", "/x", "com/", "allow")
    assert got[1][:3] == ("", "", None) and got[2][:3] == ("", "", None)
    assert got[3] == ("b.net", "/es/", "net/es/", "block") and got[6][1] == "/es/a://b"
    assert got[4][2:] == ("www.example.com/en/", "allow") and got[5][2:] == ("example.com/en/", "block")
    assert got[7][:3] == ("com", "", None) and got[8][:3] == ("example.com", "", None)
    assert got[9][:3] == ("É.net", "/fr/1", "net/fr/") and got[10][2] == "com/"


def test_propagation_matches_power_iteration(spark):
    rng = np.random.default_rng(4)
    n = 12
    m = rng.integers(0, 3, (n, n)) * (rng.random((n, n)) < 0.3)
    np.fill_diagonal(m, 0)
    t, d = rng.random(n), rng.random(n)
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(m[i, j])) for i in range(n) for j in range(n) if m[i, j]], "from string, to string, n long")
    seeds = spark.createDataFrame([(f"h{i}", float(t[i]), float(d[i])) for i in range(n)], "host string, trust double, distrust double")

    def walk(w, e):
        p = np.where(w.sum(1, keepdims=True) > 0, w / np.maximum(1, w.sum(1, keepdims=True)), np.eye(n))
        r = e
        for _ in range(12):
            r = 0.15 * e + 0.85 * p.T @ r
        return r

    want_t, want_d = walk(m.astype(float), t), walk(m.T.astype(float), d)
    got = {r.host: r for r in url_graph.propagate(edges, seeds).collect()}
    for i in range(n):
        assert got[f"h{i}"].trust == pytest.approx(want_t[i]) and got[f"h{i}"].distrust == pytest.approx(want_d[i])


def test_who_links_to_blocked_hosts_is_blocked(spark):
    rows = [("http://b.net/es/1", None)] * 3 + [("http://spam.org/x", '<a href="http://b.net/">x</a>'), ("http://ok.org/", "<a href=/local>x</a>"), ("http://b.net/other", "")]
    got = {r.page_id: r.verdict for r in url_graph.judge(pages(spark, rows), threshold=0.3).collect()}
    assert got[3] == "block" and got[4] == "allow" and url_graph.judge(pages(spark, [])).count() == 0


# -- multi-index -------------------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cell string")


def test_links_and_components_match_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([c + rng.normal(scale=0.25, size=(15, 16)) for c in centres] + [rng.normal(size=(100, 16))]).astype("f4")
    x[7] = x[3]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [None] + [1.0] * 15), (9003, [float("nan")] * 16), (9004, []), (9005, [float("inf")] * 16), (9006, [1.0, 2.0]), (9007, [2.0, 4.0])]
    got = {r.vec_id: r for r in multi_index.near_duplicates(vectors(spark, rows + odd), rows=16).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.95 * near.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (9000, 9001, 9002, 9003, 9004, 9005))
    assert got[9006].n_links == 1 and got[9007].component_id == 9006 and not got[9007].kept
    assert got[7].n_links == got[3].n_links >= 1


def test_multi_sequence_order():
    rng = np.random.default_rng(1)
    index = multi_index.Index(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)), 9)
    x = rng.normal(size=(20, 6))
    total = ((x[:, None, :3] - index.first) ** 2).sum(2)[:, :, None] + ((x[:, None, 3:] - index.second) ** 2).sum(2)[:, None, :]
    want = np.sort(total.reshape(20, -1), 1)[:, :9]
    assert np.allclose(np.take_along_axis(total.reshape(20, -1), index.order(x, 9), 1), want)


def test_one_large_group_does_not_set_the_cells(spark):
    """A third of the rows are near copies of one vector; the pairs of others need many more cells."""
    rng = np.random.default_rng(6)
    group = rng.normal(size=64) + 1e-4 * rng.normal(size=(1200, 64))
    ones = rng.normal(size=(1200, 64))
    twins = ones + 0.46 * rng.normal(size=ones.shape)
    x = np.concatenate([group, ones, twins])
    got = {r.vec_id: r.n_links for r in multi_index.near_duplicates(vectors(spark, [(i, r.tolist()) for i, r in enumerate(x)])).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = near.sum(1)[1200:]
    assert sum(got[1200 + i] for i in range(len(want))) >= 0.985 * want.sum() > 0


def test_both_ends_count_a_link(spark, monkeypatch):
    """However few cells are visited, links are those of an undirected graph: each found pair counts at both ends."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(150, 16))
    x = np.concatenate([c + 0.3 * rng.normal(size=(8, 16)) for c in centres]).astype("f4")
    index = multi_index.Index(multi_index.kmeans(x[:, :8].astype(float), 24), multi_index.kmeans(x[:, 8:].astype(float), 24), 2)
    monkeypatch.setattr(multi_index, "fit", lambda *a: index)
    got = {r.vec_id: r.n_links for r in multi_index.near_duplicates(vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)]), rows=64).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    visits = index.order(u, 2)
    sees = (visits[:, :, None] == visits[:, 0][None, None, :]).any(1)
    near = (u @ u.T >= 0.9) & (sees | sees.T)
    np.fill_diagonal(near, False)
    assert [got[i] for i in range(len(x))] == near.sum(1).tolist() and (near & ~sees).any()


def test_no_vectors(spark):
    assert multi_index.near_duplicates(vectors(spark, [])).count() == 0
    one = multi_index.near_duplicates(vectors(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert [r.n_links for r in one] == [2, 2, 2] and {r.component_id for r in one} == {1}


def test_components_of_a_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.component for r in components(path).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


# -- mixing -----------------------------------------------------------------------------------------------------------------


def documents(spark, sizes):
    """sizes: source -> words of its documents."""
    rows = [(i, " ".join(["w"] * n), s, 7) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long")


def reshared(words, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in words if s is not None)) + [s for s in words if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, left = share * sum(words.values()), {}, set(names)
    while left:
        level = (total - sum(out.values())) / sum(w[s] for s in left)
        over = {s for s in left if level * w[s] > most * words[s]}
        if not over:
            return out | {s: level * w[s] for s in left}
        out |= {s: most * words[s] for s in over}
        left -= over
    return out


def test_targets_are_the_fixed_point_of_resharing(spark):
    words = {"a": 100, "b": 5000, "c": 0, "d": 700, None: 60, "É": 300, "zz": 9}
    rows = spark.createDataFrame([(s, n, 1) for s, n in words.items()], "source string, words long, docs long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(reshared(words))


def test_mix_takes_what_targets_ask(spark):
    rng = np.random.default_rng(3)
    sizes = {"a": rng.integers(1, 60, 900), "b": rng.integers(1, 60, 300), None: rng.integers(1, 60, 80), "c": [0, 0]}
    docs = documents(spark, {s: [int(n) for n in ns] for s, ns in sizes.items()})
    rows = mixing.plan(docs, block_docs=32, shard_words=3000).collect()
    again = mixing.plan(docs.repartition(7), block_docs=32, shard_words=3000).collect()
    key = lambda r: (r.doc_id, r["__mix_taken"], str(r["__mix_draws"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    want = reshared({s: int(np.sum(n)) for s, n in sizes.items()})
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert len(own) == len(sizes[s]) and abs(sum(r["__mix_taken"] for r in own) - want[s]) <= 60
        assert all(r["__mix_taken"] <= 2 * r["__mix_size"] for r in own)
    mixed = mixing.mix(docs, block_docs=32, shard_words=3000)
    assert mixed.columns == docs.columns and mixed.count() == sum(len(r["__mix_draws"]) for r in rows)


def test_left_half_follows_the_hypergeometric_law(spark, monkeypatch):
    """Draws over several chunks: mean and variance of many nodes, and the same result for any chunk."""
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rows = spark.range(3000).selectExpr("id as lo", "id + 2 as hi", "id + 1 as mid", "array(40L, 100L, 60L) as q", "200L as total", "100L as room")
    from pyspark.sql import functions as F

    got = np.array([r[0] for r in rows.select(F.expr(mixing._left_half(20))).collect()])
    assert (got.sum(1) == 100).all() and (got >= 0).all() and (got <= [40, 100, 60]).all()
    for i, k in enumerate((40, 100, 60)):
        var = 100 * k / 200 * (1 - k / 200) * 100 / 199
        assert abs(got[:, i].mean() - k / 2) < 4 * (var / 3000) ** 0.5 and abs(got[:, i].var() / var - 1) < 0.12
    monkeypatch.setattr(mixing, "CHUNK", 7)
    assert (np.array([r[0] for r in rows.select(F.expr(mixing._left_half(20))).collect()]) == got).all()


def test_rows_without_ids_are_mixed_one_by_one(spark):
    docs = spark.createDataFrame([(None, f"w{i} " * 10, "s") for i in range(600)] + [(i, "x " * 10, "t") for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.plan(docs, block_docs=32).collect()
    want = {r.source: r["__mix_target"] for r in rows}
    for s in want:
        assert abs(sum(r["__mix_taken"] for r in rows if r.source == s) - want[s]) <= 10


def test_splitting_tree_is_exact_and_even(spark):
    q = [5, 0, 1000, 37, 20000]
    rows = mixing.split(spark.createDataFrame([(q,)], "q array<bigint>"), 7).collect()
    assert sorted(r.shard for r in rows) == list(range(7))
    assert [sum(r.q[i] for r in rows) for i in range(5)] == q and all(x >= 0 for r in rows for x in r.q)
    totals = [sum(r.q) for r in rows]
    assert max(totals) - min(totals) <= 7


def test_mix_edges(spark):
    empty = documents(spark, {})
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    odd = spark.createDataFrame([(1, None, None), (1, "a b", None), (None, "c", "s"), (2, "", "s")], "doc_id long, text string, source string")
    assert mixing.plan(odd).count() == 4
    words = spark.createDataFrame([(1, "a\u00a0b c\x0bd\x1ce", "s")], "doc_id long, text string, source string")
    assert mixing.plan(words).first()["__mix_size"] == 3
