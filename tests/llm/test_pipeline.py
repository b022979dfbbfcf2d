import random
from collections import Counter

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in docs.schema], name
        docs = after
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert last.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, docs, SF).count() == 0


def test_stages_and_run_match_brute_force(spark, tmp_path):
    """Near duplicates, repeated passages and the packed ids of a small corpus, from plain loops; labels teach nothing here."""
    from test_text_operators import brute_components, ids_of

    from skyloom.llm import mixing

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = text(40)
    rows = [(i, text(rng.randint(5, 60))) for i in range(40)]
    rows += [(40, rows[3][1] + " more"), (41, rows[5][1]), (42, shared + " " + text(20)), (43, text(20) + " " + shared), (44, None), (45, ""), (46, None), (3, text(9)), (47, "\u00e9" * 60), (48, "x" + "\u00e9" * 60), (2, rows[2][1]), (None, rows[1][1]), (None, text(12)), (49, text(6000))]
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 3}" if n % 7 else None, 1, "a") for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, bundle string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = {n: f for n, f in corpus_pipeline.STAGES}
    assert stage["toxicity"](spark, docs, str(tmp_path)).count() == len(rows)

    distinct = list(dict.fromkeys(rows))
    order = lambda i, t: (i is None, i or 0, 0 if t is None else spark.sql(f"SELECT xxhash64('{t}')").first()[0])
    groups = {}
    for n, (size, c) in brute_components([t for _, t in distinct], 5, 80).items():
        groups.setdefault((c, 0) if size else (n, 1), []).append(distinct[n])
    kept = [min(g, key=lambda r: order(*r)) if len(g) > 1 else g[0] for g in groups.values()]
    key = lambda rs: sorted(map(repr, rs))
    after = stage["near duplicates"](spark, docs, str(tmp_path))
    assert key((r.doc_id, r.text) for r in after.collect()) == key(kept) and len(kept) < len(distinct)

    raw = [(i, t, (t or "").encode()) for i, t in kept]
    first = {}
    for i, _, b in sorted((r for r in raw if r[0] is not None), key=lambda r: r[0]):
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    want = []
    for i, t, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if b[p : p + 50] in first and (i is None or first[b[p : p + 50]] < i):
                gone[p : p + 50] = b"\1" * 50
        left = bytes(x for x, y in zip(b, gone, strict=True) if not y).decode("utf-8", "ignore") if any(gone) else t
        if left or not any(gone):
            want.append((i, left))
    out = stage["repeated passages"](spark, after, str(tmp_path))
    assert key((r.doc_id, r.text) for r in out.collect()) == key(want) and out.columns == docs.columns

    source = {(r.doc_id, r.text): r.source for r in out.collect()}
    taken = {}
    for r in mixing.plan(spark.createDataFrame([(i, t, source[i, t]) for i, t in want], "doc_id long, text string, source string")).collect():
        taken[r.doc_id, r.text] = len(r["__mix_draws"])
    expect = Counter()
    for (i, t), n in taken.items():
        expect[i] += n * len(ids_of(t))
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == Counter({i: n for i, n in expect.items() if n})


def test_cutting_holds_a_part_of_a_batch(spark, monkeypatch):
    """What Python makes of one large batch stays below the batch's own size; rows come whole and in order."""
    import tracemalloc

    import pyarrow as pa

    from skyloom.llm import suffix_dedup

    docs, made = spark.createDataFrame([(1, "a" * 60), (2, "a" * 60)], "doc_id long, text string"), []
    whole = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **k: (made.append(f), whole(self, f, *a, **k))[1])
    suffix_dedup.remove(docs)
    texts = [chr(97 + n % 26) * 8000 for n in range(3000)] + [None, "", "gone"]
    spans = [[{"start": 10, "end": 7990}] if n % 2 else None for n in range(3000)] + [None, None, [{"start": 0, "end": 4}]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3003), pa.int64()), pa.array(texts), pa.array(spans)], names=["doc_id", "text", "__spans"])
    tracemalloc.start()
    out = []
    for b in made[-1](iter([batch])):
        out += [(i, t if t is None else (t[:1], len(t))) for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out == [(n, (chr(97 + n % 26), 20 if n % 2 else 8000)) for n in range(3000)] + [(3000, None), (3001, ("", 0))]
    assert peak < 12 << 20, peak
