import hashlib
import math
import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

from skyloom.llm import jaccard, media, near_copies, packing, quality, repeats, suffix_dedup, token_counts, toxicity
from skyloom.llm.shingles import Classes, Words, product_links, shingle_set

SCHEMA = "doc_id long, text string, source string, size string, bundle int, part string"


def table(spark, texts, ids=None):
    """documents with extra columns of names that operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, f"s{n % 2}", "x", 1, "p") for n, (i, t) in enumerate(zip(ids, texts, strict=True))], SCHEMA)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = text(60)
    docs = [text(rng.randint(5, 120)) for _ in range(40)]
    docs += [docs[0], docs[0], docs[3] + " tail", docs[5].upper(), shared + " " + text(30), text(20) + "\n" + shared, None, "", "  \n", "one", "one two", "one two", "é" * 70, "é" * 70 + "x", text(20000)]
    docs += [" ".join(w if k != i else "changed" for k, w in enumerate(docs[-1].split()[:400])) for i in range(12)]
    return docs


# -- n-gram Jaccard join ------------------------------------------------------------------------------------------------


def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_is_exact(spark, corpus, words, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(table(spark, corpus), words, percent, rows=5).collect()}
    assert got == brute_components(corpus, words, percent)


def test_jaccard_join_of_tiny_sets_is_exact(spark):
    """Of two linked tiny sets, only one may have signatures of empty blocks."""
    rng = random.Random(7)
    texts, common = [], [f"c{i}" for i in range(40)]
    for _ in range(250):
        words = [f"w{rng.randrange(1 << 40)}" for _ in range(rng.randint(8, 16))]
        if rng.random() < 0.3:  # some shingles that many sets have
            words[:6] = common[(at := rng.randrange(3)) : at + 6]
        texts += [" ".join(words), " ".join([*words, "more"])]
        if rng.random() < 0.3:
            texts.append(" ".join([*words, "yet", "others"]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(table(spark, texts), 5, 80).collect()}
    assert got == brute_components(texts, 5, 80)


def test_jaccard_join_of_nothing_and_of_repeated_rows(spark):
    assert jaccard.join(table(spark, [])).count() == 0
    rows = jaccard.join(table(spark, ["a b c d", "a b c d", None, None], [7, 7, 9, None])).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id) == [(7, 7), (7, 7), (9, 9)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_signatures_of_similar_sets_meet():
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        kinds = Classes(percent)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
            gone = int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1))
            b = np.unique(np.r_[a[gone:], rng.integers(0, 1 << 64, int(rng.integers(0, 3)), np.uint64, endpoint=False)])
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(kinds.signatures(a), kinds.signatures(b)))


def test_product_links_span_the_links():
    w = Words()
    sets = [shingle_set(t, w) for t in ["a b c d e f g h i j k l", "a b c d e f g h i j k l", "x y z", ""]]
    assert product_links(sets, 90, columns=2) == [(0, 1)]


def test_one_of_each(spark, corpus):
    kept = {r.doc_id for r in near_copies.one_of_each(table(spark, corpus)).collect()}
    assert kept == {i for i, (_, c) in brute_components(corpus, 5, 80).items() if i == c}
    assert near_copies.one_of_each(table(spark, ["a b", "a b"], [1, 1])).count() == 1


def test_one_of_each_where_ids_repeat_or_are_missing(spark):
    """A text goes, not its namesakes; null ids come last; texts without words stay."""
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "some other words of a third text"
    rows = [(1, a), (5, a), (5, b), (None, b), (None, c), (7, c), (8, None), (8, ""), (None, None), (9, " "), (5, b)]
    kept = near_copies.one_of_each(table(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, [(1, a), (5, b), (7, c), (8, None), (8, ""), (None, None), (9, " ")]))
    assert near_copies.one_of_each(table(spark, [])).count() == 0


# -- suffix-array dedup ---------------------------------------------------------------------------------------------------


def brute_removed(rows, length=50):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for i, t in order:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    for i, t in rows:
        b = (t or "").encode()
        m = bytearray(len(b))
        for p in range(len(b) - length + 1):
            least = first[b[p : p + length]]
            if least is not None and (i is None or least < i):
                m[p : p + length] = b"\1" * length
        out.append((i, len(b), sum(m), sum(1 for p in range(len(m)) if m[p] and not (p and m[p - 1])), hashlib.sha256(bytes(x for x, y in zip(b, m, strict=True) if not y)).hexdigest()))
    return out


def found(df):
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect()), key=key), key


def test_suffix_dedup_is_exact(spark, corpus, monkeypatch):
    monkeypatch.setattr("skyloom.llm.suffix_dedup.BUNDLE", 1 << 13)
    monkeypatch.setattr("skyloom.llm.suffix_dedup.PART", 1 << 14)
    rows = list(enumerate(corpus)) + [(0, corpus[0]), (None, corpus[1]), (2, corpus[9])]
    got, key = found(suffix_dedup.find(table(spark, [t for _, t in rows], [i for i, _ in rows])))
    assert got == sorted(brute_removed(rows), key=key)


@pytest.mark.parametrize("most", [4096, 3, 1])
def test_ranges_ascend(spark, most):
    ids = [*range(0, 300, 3), 10**12, 10**12, -5, None]
    rows = repeats.ranged(table(spark, ["x" * 10] * len(ids), ids), 1000, 100, most).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.bundle) for r in rows)
    assert [b for *_, b in got] == sorted(b for *_, b in got) and len({b for *_, b in got}) > (1 if most == 1 else 3)
    assert len({r.bundle for r in rows if r.doc_id == 10**12}) == 1


def test_names_survive_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        x = np.unique(repeats.narrowed(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False), 1 << 20))
        assert (repeats.unsqueeze(repeats.squeeze(x)) == x).all()


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.find(table(spark, [])).count() == 0
    assert suffix_dedup.remove(table(spark, [])).count() == 0


def test_difference_cover():
    d = suffix_dedup.COVER
    assert sorted((a - b) % suffix_dedup.PERIOD for a in d for b in d if a != b) == list(range(1, suffix_dedup.PERIOD))


def test_remove_keeps_columns_and_whole_characters(spark):
    out = {r.doc_id: r for r in suffix_dedup.remove(table(spark, ["é" * 40 + "abc", "x" + "é" * 40 + "tail", "é" * 40 + "abc", ""])).collect()}
    assert set(out) == {0, 1, 3} and out[1].text == "xtail" and out[1].size == "x" and out[3].text == ""


# -- packing --------------------------------------------------------------------------------------------------------------


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_packing_round_trip(spark, corpus):
    texts = [*corpus, "it's 12 o'clock!!  \n\n don't\tstop <|endoftext|> 中文 \u2003 x ", "'ll 've're 's"]
    rows = packing.pack(table(spark, texts)).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        own = sorted(pieces[i], key=lambda r: r.start)
        whole = b"".join(bytes(r.ids) for r in own)
        assert whole == ids_of(t).tobytes() and [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert {r.doc_tokens for r in own} == {len(whole) // 4}
    for own in sequences.values():
        own = sorted(own, key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert total <= 1024 and (total == 1024 or total & (total - 1) == 0)


def test_packing_digests_and_empty_table(spark):
    r = packing.digested(packing.pack(table(spark, ["a b"]))).collect()
    assert {x.doc_id for x in r} == {0} and sum(x.length for x in r) == len(ids_of("a b"))
    assert packing.pack(table(spark, [])).count() == 0


def test_sum_of_squares_rule():
    p = packing.Packer(10)
    for n, size in enumerate((6, 4, 3, 3)):
        p.add(n, np.arange(size, dtype="<u4"))
    assert p.levels[10] == 0 and len(p.done) == 2  # 6 + 4 closed a window
    p.finish()
    assert sum(r[2] for r in p.done) == 16 and not p.levels.any()


def test_packing_places_by_brute_force_sums_of_squares():
    """Every placement is one of those after which the sum of squares is least; leftovers are powers of two."""
    rng = random.Random(1)
    p = packing.Packer(32)
    for n in range(400):
        size = rng.choice([1, 2, 3, 5, 8, 13, 21, 30])
        before, closed = p.levels.copy(), p.next
        p.add(n, np.arange(size, dtype="<u4"))
        ways = []
        for level in range(33 - size):
            if level == 0 or before[level]:
                after = before.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 32
                ways.append((int((after**2).sum()), after.tolist()))
        least = min(w for w, _ in ways)
        assert p.levels.tolist() in [a for w, a in ways if w == least] and p.next - closed <= 1
    at = len(p.done)
    p.finish()
    sizes = {}
    for r in p.done[at:]:
        sizes[r[5]] = sizes.get(r[5], 0) + r[2]
    assert all(n & (n - 1) == 0 for n in sizes.values())
    assert sum(r[2] for r in p.done) == sum(len(range(r[1], r[1] + r[2])) for r in p.done) and len({(r[0], i) for r in p.done for i in range(r[1], r[1] + r[2])}) == sum(r[2] for r in p.done)


# -- toxicity, quality ------------------------------------------------------------------------------------------------------


def labelled(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    bad = ["grumblefoot", "zanklewit", "wrattlebag"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(base) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((i, int(i % 7 > 0), int(toxic)))
    return table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_documents(spark):
    docs, labels, truth = labelled(spark)
    scored = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    held = [(i, t) for i, _, t in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((scored[i] >= 0.7) == bool(t) for i, t in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in scored.values())


def test_toxicity_edges(spark):
    docs, labels, _ = labelled(spark)
    model = toxicity.fit(docs, labels)
    odd = table(spark, [None, "", "grumblefoot zanklewit " * 9000, "x" * 100000])
    out = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert out[0].score == out[1].score == out[3].score < 0.7 <= out[2].score and out[2].size == "x"
    assert toxicity.score(table(spark, []), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, none).filter("score >= 0.7").count() == 0


def test_labelled_rows_one_for_each_doc_id(spark):
    """However many rows share a labelled doc_id, the driver gets one, and no text."""
    from pyspark.sql.types import ArrayType, BinaryType, DoubleType

    docs = spark.createDataFrame([(1, f"w{i}") for i in range(300)] + [(2, None), (3, "b a b"), (4, "not chosen"), (None, "x")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (9, 1)], "__id long, __y int")
    got = toxicity.labelled(docs, chosen, toxicity.padded, ArrayType(BinaryType()))
    assert [(r["__id"], r["__y"], r["x"]) for r in got] == [(1, 1, [b" w99 "]), (2, 0, []), (3, 0, [b" a ", b" b "])]
    shapes = toxicity.labelled(docs, chosen, quality.shape, ArrayType(DoubleType()))
    assert [r["__id"] for r in shapes] == [1, 2, 3] and shapes[1]["x"] == quality.shape(None)
    assert toxicity.labelled(docs.limit(0), chosen, quality.shape, ArrayType(DoubleType())) == []


def test_toxicity_matches_plain_dictionaries_distances_and_threshold(spark):
    """A second implementation without counters, caches or early exits."""
    import zstandard as z

    docs, labels, truth = labelled(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    learn = {i: t for i, _, t in truth if zlib.crc32(str(i).encode()) % 3 != 1}
    model = toxicity.fit(docs, labels)
    split = {y: toxicity.apart([texts[i] for i in sorted(learn) if learn[i] == y]) for y in (1, 0)}

    def plain_dictionary(own, other):
        n = 6
        has = lambda group, g: sum(any(g in w for w in d) for d in group)
        least, every = max(3, len(own) // 80, int(len(own) ** 0.5 / 3)), {w[i : i + n] for d in own for w in d for i in range(len(w) - n + 1)}
        typical = {g for g in every if (k := has(own, g)) >= least and k * len(other) >= 20 * (has(other, g) + 0.5) * len(own)}
        parts = Counter()
        for d in own:
            mine = set()
            for w in d:
                i = 0
                while i + n <= len(w):
                    if w[i : i + n] in typical:
                        j = i
                        while w[j + 1 : j + 1 + n] in typical:
                            j += 1
                        mine.add(w[i : j + n])
                        i = j
                    i += 1
            parts.update(mine)
        out = b""
        for p in sorted(parts, key=lambda p: (-parts[p], p)):
            if p not in out and len(out) + len(p) < 32768:
                out = p + b"\xff" + out
        return out

    toxic, plain = plain_dictionary(split[1], split[0]), plain_dictionary(split[0], split[1])
    assert toxic and (model.toxic, model.plain) == (toxic, plain)

    def size(raw, data):
        p = z.ZstdCompressionParameters.from_level(1, strategy=z.STRATEGY_FAST, min_match=6, window_log=17, hash_log=16, write_checksum=0, write_content_size=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        return len(z.ZstdCompressor(compression_params=p, dict_data=z.ZstdCompressionDict(raw.rjust(8, b"\0"), dict_type=z.DICT_TYPE_RAWCONTENT)).compress(data))

    def distance(t, a, b):
        each = sorted(size(b, b" " + w + b" " + bytes(64)) - size(a, b" " + w + b" " + bytes(64)) for w in t.lower().encode().split())
        return sum(d for d in each[-2:] if d > 0)

    first = plain_dictionary(split[1][::2], split[0][::2]), plain_dictionary(split[0][::2], split[1][::2])
    seen = [[distance(b"".join(d).decode(), *first) for d in split[y][1::2]] for y in (1, 0)]
    cost = lambda t: sum(d < t for d in seen[0]) / len(seen[0]) + 10 * sum(d >= t for d in seen[1]) / len(seen[1])
    ways = [t for t in range(1, max(seen[0] + seen[1]) + 2) if cost(t) == min(map(cost, range(1, max(seen[0] + seen[1]) + 2)))]
    assert model.limit == ways[len(ways) // 2]
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i in range(0, 400, 3):
        d = distance(texts[i], toxic, plain)
        assert scored[i] == pytest.approx(1 / (1 + math.exp(-(math.log(0.7 / 0.3) + d - (model.limit - 0.5)))), abs=1e-12)


def test_toxicity_keeps_columns_of_its_own_names(spark):
    docs, labels, _ = labelled(spark)
    odd = docs.limit(5).selectExpr("doc_id", "text", "source", "1 as __score", "2 as label")
    kept = toxicity.reject(odd, labels, source=docs)
    assert kept.columns == odd.columns and all(r["__score"] == 1 for r in kept.collect())
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumnRenamed("size", "score"), toxicity.fit(docs, labels))


def test_quality_posteriors_match_plain_sums(spark):
    """Strengths, rates and posteriors from loops over rows."""
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", "z", None]), rng.random() ** 2) for i in range(300)] + [(900, "lone", "x", 0.9), (900, "lone", "x", 0.9)]
    got = sorted((r.doc_id, r.host_rate, r.path_rate, r.posterior) for r in quality.posteriors(spark.createDataFrame(rows, "doc_id long, host string, path string, p double")).collect())
    rate = sum(r[3] for r in rows) / len(rows)

    def weight(groups):  # (n, s, above)
        some = [g for g in groups if g[0] >= 2]
        spread = sum(n * (s / n - a) ** 2 for n, s, a in some)
        between = (spread - sum(a * (1 - a) for _, _, a in some)) / sum(n for n, _, _ in some)
        whole = sum(n * a * (1 - a) for n, _, a in some) / sum(n for n, _, _ in some)
        return min(1e6, max(1.0, whole / between - 1)) if between > 0 else 1e6

    of = lambda key: {k: (sum(1 for r in rows if key(r) == k), sum(r[3] for r in rows if key(r) == k)) for k in map(key, rows)}
    hosts, paths = of(lambda r: r[1]), of(lambda r: (r[1], r[2]))
    k = weight([(n, s, rate) for n, s in hosts.values()])
    above = {h: (k * rate + s) / (k + n) for h, (n, s) in hosts.items()}
    m = weight([(n, s, above[h]) for (h, _), (n, s) in paths.items()])
    want = []
    for i, h, q, p in rows:
        n, s = paths[h, q]
        path = (m * above[h] + s - p) / (m + n - 1)
        odds = sum(math.log(max(x, 1e-6) / max(1 - x, 1e-6)) for x in (p, path)) - math.log(rate / (1 - rate))
        want.append((i, above[h], path, 1 / (1 + math.exp(-odds))))
    for a, b in zip(got, sorted(want), strict=True):
        assert a == pytest.approx(b, rel=1e-9)


def test_quality_shrinks_sparse_sites(spark):
    p = spark.createDataFrame([(i, "big", "a", 0.9 if i % 10 else 0.1) for i in range(200)] + [(900, "tiny", None, 0.1), (901, None, "a", 0.5)], "doc_id long, host string, path string, p double")
    out = {r.doc_id: r for r in quality.posteriors(p).collect()}
    assert len(out) == 202 and all(0 < r.posterior < 1 for r in out.values())
    assert 0.1 < out[900].host_rate < 0.82  # between its own evidence and the global rate


def test_quality_of_whole_tables(spark):
    docs, labels, _ = labelled(spark)
    sites = docs.selectExpr("doc_id", "text", "source as host", "size as path")
    assert quality.posteriors(quality.evidence(sites, quality.fit(docs, labels))).count() == 400
    assert quality.posteriors(quality.evidence(sites.limit(0), None)).count() == 0
    odd = table(spark, [None, "", "!!! " * 50000]).selectExpr("doc_id", "text", "source as host", "size as path")
    assert quality.posteriors(quality.evidence(odd, quality.fit(docs, labels))).count() == 3
    assert quality.shape(None) == [0.0] * len(quality.SHAPE)


# -- token counts, media ------------------------------------------------------------------------------------------------------


def plain_segmentation(word, names, taken):
    """Pieces of the best segmentation, by trying every last piece; fewer tokens, then the latest start, win ties."""
    total = math.log(sum(taken.values()) + len(names))
    score = {p: math.log(taken.get(p, 0) + 1) - total for p in names}
    unknown = min(score.values()) - 10
    best = [(0.0, 0, [])]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + unknown * n, -best[end - 1][1] - n, end - 1, [*best[end - 1][2], word[end - 1]])]
        ways += [(best[s][0] + score[word[s:end]], -best[s][1] - 1, s, [*best[s][2], word[s:end]]) for s in range(end - 1, max(0, end - 20) - 1, -1) if word[s:end] in score]
        w = max(ways, key=lambda w: w[:2])
        best.append((w[0], -w[1], w[3]))
    return best[-1][1], best[-1][2]


def test_token_counts_match_plain_training_and_dynamic_programming(spark, corpus):
    import public_tokenizers

    names = token_counts.vocabulary(public_tokenizers.path(token_counts.MODEL))
    texts = [t if t is None or len(t) < 5000 else t[:5000] for t in corpus] + ["a\u00a0b \ud55c\uae00 x" + "y" * 40]
    words = Counter(w.decode() for t in texts for w in (t or "").encode().split())
    taken = {}
    for _ in range(2):
        now = Counter()
        for w, n in words.items():
            for p in plain_segmentation("▁" + w, names, taken)[1]:
                if p in names_set(names):
                    now[p] += n
        taken = now
    docs = table(spark, texts)
    trained = token_counts.train(docs, names, 2)
    assert trained == dict(taken)
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.count_tokens(docs, keep=50, taken=trained).collect()}
    cache = {w: plain_segmentation("▁" + w, names, taken)[0] for w in words}
    for i, t in enumerate(texts):
        own = [w.decode() for w in (t or "").encode().split()]
        assert got[i] == (len(own), sum(cache[w] for w in own))
    assert token_counts.count_tokens(table(spark, [])).count() == 0


@cache
def _names_set(names):
    return set(names)


def names_set(names):
    return _names_set(tuple(names))


def test_media_round_trip(spark, corpus, tmp_path):
    """op2_media itself, over documents written as a table."""
    table(spark, corpus).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in media.op2_media(spark, str(tmp_path)).collect()}
    assert len(rows) == len(corpus)
    for i, t in enumerate(corpus):
        b = (t or "").encode()
        p = b + b" " * (-len(b) % 192 if b else 192)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        lines = (t or "").split("\n")
        assert r.position == (1 if lines[0].split() else 0) and r.n_parts == 1 + sum(1 for x in lines if x.split()) and r.caption == f"{len(b)} bytes as samples"
    assert rows[46].media_sha256 == rows[47].media_sha256
    assert media.store_of(table(spark, [])).count() == 0 and media.interleave(media.pages_of(table(spark, []))).count() == 0


def test_parts_stay_in_order():
    html = "<script>no</script><p>one &amp; two<figure><img src='sha256:ab' alt=x><figcaption>cap <b>t</b></figcaption></figure>three<img src='http://x'><img src=sha256:cd alt='y' data-bytes=5>"
    parts = media.parts_of(html)
    assert [(p["position"], p["kind"]) for p in parts] == [(0, "text"), (1, "media"), (2, "text"), (3, "media"), (4, "media")]
    assert parts[0]["text"] == "one & two" and parts[1]["caption"] == "cap t" and parts[3]["src"] == "http://x" and parts[3]["digest"] is None
    assert parts[4]["digest"] == "cd" and parts[4]["caption"] == "y" and parts[4]["bytes"] == 5 and media.parts_of(None) == []


@pytest.mark.parametrize(("html", "want"), [
    ("<figure><img src=a><figcaption>cap</figure>tail text", ["m:cap", "tail text"]),
    ("<figure><img src=a><figcaption>cap", ["m:cap"]),
    ("before<figcaption>lone caption</figcaption>after", ["before", "lone caption", "after"]),
    ("<figcaption>open caption<p>more", ["open caption more"]),
    ("<figure><img src=a><img src=b><figcaption>both</figcaption></figure>x", ["m:both", "m:both", "x"]),
    ("<figure><img src=a alt=A></figure><figure><figcaption>none</figcaption></figure>", ["m:A", "none"]),
    ("<figure><img src=a><figcaption>one<figure><img src=b></figure>", ["m:one", "m:None"]),
    ("<style>p{}</style><title>t</title>a<img>b<br>c<video src=v></video>", ["ab", "c", "m:None"]),
    ('a<template><img src="x.png" alt="t"><figcaption>c</figcaption>z</template>b', ["ab"]),
    ("<title>never closed<p>text <img src=a alt=A>", ["text", "m:A"]),
    ("<template>open<p>all gone", []),
    ("</template>a<title>t</title>b", ["ab"]),
    ("<p>a<p>b</p>  </p>\n<div> </div>c&nbsp;d", ["a", "b", "c d"]),
])
def test_unclosed_and_lone_tags(html, want):
    assert [p["text"] if p["kind"] == "text" else f"m:{p['caption']}" for p in media.parts_of(html)] == want


def test_parts_of_real_pages_match_a_plain_split(spark):
    """Every page of the table: text between block tags, by cutting out what is skipped and splitting at tags."""
    import html as h
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("page_id as doc_id", "html")
    got = {r.doc_id: [p.text for p in r.parts] for r in media.interleave(pages).collect()}
    blocks = "|".join(sorted(media.BLOCK, key=len, reverse=True))
    for r in pages.collect():
        t = re.sub(r"(?is)<(script|style|title|template)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "", r.html or "")
        pieces = re.split(rf"(?i)</?(?:{blocks})\b[^>]*>", t)
        assert got[r.doc_id] == [x for x in (" ".join(h.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in pieces) if x]


def test_unresolved_reference(spark):
    seq = media.interleave(spark.createDataFrame([(1, "<img src='sha256:zz'>"), (2, None)], "doc_id long, html string"))
    rows = media.resolve(seq, media.read_back(media.store_of(table(spark, ["a"])))).collect()
    assert [(r.doc_id, r.payload_sha256) for r in rows] == [(1, None)]


def test_png_rejects_damage():
    p = media.to_png(bytes(range(192)) * 3)
    assert media.from_png(p) == bytes(range(192)) * 3
    with pytest.raises(ValueError):
        media.from_png(p[:45] + bytes([p[45] ^ 1]) + p[46:])


def test_distinct_names_are_sorted_and_never_hashed(monkeypatch):
    names = np.random.default_rng(3).integers(0, 1 << 64, 5000, np.uint64) >> np.uint64(52)
    want = np.unique(names).tolist()
    monkeypatch.setattr(np, "unique", lambda *a, **k: pytest.fail("hashes millions of names"))
    assert repeats.distinct(names).tolist() == want and repeats.distinct(names[:0]).tolist() == []


def test_answers_of_many_parts_take_one_search(monkeypatch):
    """A search a part copied all of a bundle's names each time, so that time grew with the square of the text."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    names, total, part = rng.integers(0, 1 << 64, 20_000, np.uint64, endpoint=False), 1 << 20, 1 << 12
    short = repeats.distinct(repeats.narrowed(names, total))
    wanted, owner = rng.random(len(short)) < 0.3, repeats.part_of(short, 256)
    which = rng.permutation(256)
    table_ = pa.table({"part": pa.array(which, pa.int64()), "bits": pa.array([repeats.packed(wanted[owner == p]) for p in which], pa.binary())})
    calls, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: calls.append(1) or search(*a, **k))
    got = repeats.Answers(names, table_, total, part)
    assert len(calls) < 10
    assert (got.yes == wanted[search(short, repeats.narrowed(names, total))]).all()


def test_a_worker_collects_only_what_is_new():
    import gc

    from skyloom.llm.common import give_back

    try:
        give_back()
        assert gc.get_freeze_count() > 10_000
    finally:
        gc.unfreeze()
