"""Mixing sources to target weights, in DataFrame and SQL functions only.

1. Targets. Sources in code-point order (null last) take the weights in turn and share `share` times all words. No
   target exceeds `most` times its source's words: with the sources ordered by cap over weight, those that reach their
   cap are a prefix, so the common level of the rest follows from two running sums (the fixed point of resharing).
2. Blocks. A hash permutes each source's documents into blocks. A target is so many whole passes over the source and a
   part of one more: whole blocks while they fit, then documents of one cut block in hashed order, to the nearest word
   total that whole documents allow. This makes an exact quota of block draws for each source.
3. Splitting tree. The root holds the vector of quotas. A node that covers several output shards gives its left half a
   multivariate-hypergeometric sample of its vector, as large as the half's share, and the rest to the right half.
4. Draw. Each leaf takes disjoint ranges of each source's permuted blocks; a shard's rows are shuffled locally.

Only block-level tables are joined and sorted: a source with a third of all rows is as many blocks as its rows make,
and running sums over blocks are taken in two levels, so that no task holds a source. Random choices are hashes of the
seed, so reruns agree.

Defined results: a null text has 0 words. A document with 0 words is taken as its block is, which adds nothing. Rows
that share a doc_id are taken together; rows without one are told apart by their texts. An empty table gives no rows.
Columns of the input are kept as they are; working columns begin with `__mix_`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import cut, parts_for, table, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_DOCS = 256
SHARD_WORDS = 2_000_000
#: Draws that are made from one array.
CHUNK = 4096
SUPER = 1024
SEED = 20


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, words -> also n (rank from 0), weight, target. A row for each source; both sorts are over sources only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "n")
    everything = Window.partitionBy()
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (
        sources.withColumn("n", (F.row_number().over(by_name) - 1).cast("long"))
        .withColumn("weight", F.element_at(w, (F.col("n") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("words") * float(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("below", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("words").over(everything) * share - F.col("below")) / F.col("left"))
        .withColumn("place", F.row_number().over(by_ratio))
    )
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(everything)
    return s.withColumn("level", level).withColumn("target", F.least("cap", F.coalesce(F.col("level"), F.lit(math.inf)) * F.col("weight"))).select("source", "words", "docs", "n", "weight", "target")


def _left_half(seed: int) -> str:
    """SQL for the left child's vector of a node (lo, mid, hi, q, room, total): hypergeometric given what is left of both.

    A source's k blocks are drawn one after the other, each left with the chance that is left; CHUNK of them at a time,
    so that no array grows with k.
    """
    u = f"(pmod(xxhash64({seed}, lo, hi, a.i, i), 9007199254740992) + 0.5) / 9007199254740992D"
    one = f"x + if({u} * (a.t - i + 1) < a.c - x, 1L, 0L)"
    drawn = f"aggregate(sequence(0L, (k - 1) div {CHUNK}), 0L, (y, j) -> aggregate(sequence(j * {CHUNK} + 1, least(k, (j + 1) * {CHUNK})), y, (x, i) -> {one}))"
    x = f"case when k = 0 or a.c = 0 then 0L when k = a.t then a.c else {drawn} end"
    step = f"transform(array({x}), x -> named_struct('c', a.c - x, 't', a.t - k, 'i', a.i + 1L, 'o', array_append(a.o, x)))[0]"
    return f"aggregate(q, named_struct('c', room, 't', total, 'i', 0L, 'o', cast(array() as array<bigint>)), (a, k) -> {step}, a -> a.o)"


def split(root: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """root: one row with q array<bigint>. Returns shard, q: vectors that sum to the root's, of equal totals but for rounding."""
    nodes = root.select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "q")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        nodes = (
            nodes.withColumn("mid", F.expr("(lo + hi) div 2"))
            .withColumn("total", F.expr("aggregate(q, 0L, (s, x) -> s + x)"))
            .withColumn("room", F.expr("(total * (mid - lo)) div (hi - lo)"))
            .withColumn("l", F.when(F.col("mid") > F.col("lo"), F.expr(_left_half(seed))))
            .select(F.explode(F.expr("if(mid = lo, array(named_struct('lo', lo, 'hi', hi, 'q', q)), array(named_struct('lo', lo, 'hi', mid, 'q', l), named_struct('lo', mid, 'hi', hi, 'q', zip_with(q, l, (x, y) -> x - y))))")).alias("x"))
            .select("x.*")
        )
        if level % 4 == 3:
            nodes = nodes.repartition("lo")
    return nodes.select(F.col("lo").alias("shard"), "q")


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block_docs: int = BLOCK_DOCS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """docs(doc_id, text, source, ...) with __mix_size, __mix_source_size, __mix_target, __mix_taken and __mix_draws, an array of (pass, shard), one for each time the document is taken."""
    unit = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    sized = docs.withColumns({"__mix_size": word_count(F.col("text")), "__mix_unit": unit})
    units = cut(sized.select(F.col("__mix_unit").alias("unit"), "source", F.col("__mix_size").alias("size")))
    parts = parts_for(units.count(), 1_000_000, 8)
    sources = cut(targets(units.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")), weights, share, most)
        .withColumn("nb", F.ceil(F.col("docs") / block_docs).cast("long"))
        .withColumn("base", F.when(F.col("words") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.greatest("words", F.lit(1))))).otherwise(0).cast("long"))
        .withColumn("extra", F.when(F.col("words") > 0, F.col("target") - F.col("base") * F.col("words")).otherwise(0.0)), parts)
    block = F.pmod("unit", F.col("nb"))

    dealt = units.join(sources.select(F.col("source").alias("s"), "n", "nb"), F.col("source").eqNullSafe(F.col("s"))).withColumn("block", block)
    blocks = dealt.groupBy("n", "block").agg(F.sum("size").alias("words")).withColumn("super", F.expr(f"block div {SUPER}"))
    supers = blocks.groupBy("n", "super").agg(F.sum("words").alias("w")).withColumn("start", F.coalesce(F.sum("w").over(Window.partitionBy("n").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("w")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("n", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("start")
    blocks = (
        blocks.join(supers, ["n", "super"])
        .withColumn("before", before)
        .join(sources.select("n", "nb", "base", "extra"), "n")
        .withColumn("full", F.col("before") + F.col("words") <= F.col("extra"))
        .withColumn("cut", ~F.col("full") & (F.col("before") < F.col("extra")))
        .select("n", "block", "nb", "base", "full", "cut", (F.col("extra") - F.col("before")).alias("rest"))
    )
    blocks = cut(blocks, parts)
    extra_draws = blocks.filter(F.col("full") | F.col("cut")).groupBy("n").agg((F.max("block") + 1).alias("more"))
    quotas = cut(sources.join(extra_draws, "n", "left").select("n", "nb", "target", (F.col("base") * F.col("nb") + F.coalesce("more", F.lit(0))).alias("k")), parts)
    words = quotas.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, math.ceil(words / shard_words))

    root = quotas.agg(F.expr("transform(array_sort(collect_list(struct(n, k))), x -> x.k)").alias("q"))
    leaves = split(root, shards, seed).select("shard", F.posexplode("q").alias("n", "k")).filter("k > 0").withColumn("n", F.col("n").cast("long"))
    start = F.coalesce(F.sum("k").over(Window.partitionBy("n").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = (
        leaves.withColumn("start", start)
        .select("n", "shard", F.explode(F.expr("sequence(start, start + k - 1)")).alias("draw"))
        .join(quotas.select("n", "nb"), "n")
        .groupBy("n", F.expr("draw % nb").alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct(F.expr("draw div nb").alias("pass"), "shard"))).alias("draws"))
    )
    # documents of the cut blocks: at most one block for each source
    cuts = blocks.filter("cut").select("n", "block", "rest")
    order = Window.partitionBy("n", "block").orderBy(F.xxhash64(F.lit(seed + 1), "unit"), "unit")
    chosen = (
        dealt.join(cuts, ["n", "block"])
        .groupBy("n", "block", "unit")
        .agg(F.sum("size").alias("w"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("w").over(order))
        .filter((F.col("upto") <= F.col("rest")) | ((F.col("upto") - F.col("w") < F.col("rest")) & (F.col("rest") - (F.col("upto") - F.col("w")) > F.col("upto") - F.col("rest"))))
        .select(F.col("n").alias("__mix_cn"), F.col("unit").alias("__mix_cd"), F.lit(True).alias("__mix_chosen"))
    )
    decided = cut(blocks.join(drawn, ["n", "block"], "left").select(F.col("n").alias("__mix_bn"), F.col("block").alias("__mix_block"), F.col("base").alias("__mix_base"), F.col("cut").alias("__mix_cut"), F.col("draws").alias("__mix_all")), parts)
    by_source = sources.select(F.col("source").alias("__mix_source"), F.col("n").alias("__mix_n"), F.col("nb").alias("__mix_nb"), F.col("words").alias("__mix_source_size"), F.col("target").alias("__mix_target"))
    out = (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("__mix_source")))
        .withColumn("__mix_b", F.pmod("__mix_unit", F.col("__mix_nb")))
        .join(decided, (F.col("__mix_n") == F.col("__mix_bn")) & (F.col("__mix_b") == F.col("__mix_block")))
        .join(cut(chosen, parts), (F.col("__mix_n") == F.col("__mix_cn")) & (F.col("__mix_unit") == F.col("__mix_cd")), "left")
        .withColumn("__mix_draws", F.coalesce(F.expr("filter(__mix_all, x -> x.pass < __mix_base or not __mix_cut or __mix_chosen is not null)"), F.expr("cast(array() as array<struct<pass:bigint,shard:bigint>>)")))
        .withColumn("__mix_taken", F.col("__mix_size") * F.size("__mix_draws"))
    )
    return out.select(*docs.columns, "__mix_size", "__mix_source_size", "__mix_target", "__mix_taken", "__mix_draws")


def mix(docs: DataFrame, seed: int = SEED, **params) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, dealt to its shards and shuffled within each. Columns as given."""
    drawn = plan(docs, seed=seed, **params).withColumn("__mix_draw", F.explode("__mix_draws"))
    return drawn.repartition(F.col("__mix_draw.shard")).sortWithinPartitions("__mix_draw.shard", F.xxhash64(F.lit(seed + 2), "doc_id", "__mix_draw.pass")).select(*docs.columns)


def op10_mixing(spark, sf_dir):
    p = plan(table(spark, sf_dir, "documents"))
    return p.select("doc_id", F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"), F.col("__mix_taken").alias("taken"))
