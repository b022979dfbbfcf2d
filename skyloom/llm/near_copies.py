"""A corpus without near copies, by the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut
from skyloom.llm.jaccard import grouped

WORDS, PERCENT = 5, 80


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs(doc_id, text, ...) with the first document, by (doc_id, hash of text), of each component of similar ones.

    Null doc_ids count as greater than all others. Documents without words (null, empty, white) are no copies of each
    other and stay. A row is named by doc_id and text: rows that repeat both count as one, whatever their other columns
    hold, and a doc_id with another text besides loses only the text that is a copy. An empty table gives no rows.
    """
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    if repeated:
        docs = docs.dropDuplicates(["doc_id", "text"])
    found, groups = grouped(docs, words, percent)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    keys = found.filter("n > 0").groupBy("key").agg(F.min(place).alias("low"), F.count("*").alias("rows"))
    whole = keys.join(groups, F.col("key") == F.col("node"), "left").select("key", "low", "rows", F.coalesce("component", "key").alias("component"))
    first = whole.groupBy("component").agg(F.min("low").alias("first"), F.sum("rows").alias("all")).filter("all > 1")
    copies = cut(found.select("doc_id", "text_key", "key").join(whole.join(first, "component").select("key", "first"), "key").filter(place != F.col("first")).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")))
    same = F.col("doc_id").eqNullSafe(F.col("__d"))
    if repeated:  # else the doc_id alone names a row, and texts need not be hashed again
        same = same & (F.xxhash64("text") == F.col("__k"))
    return docs.join(copies, same, "left_anti").select(docs.columns)
