"""The corpus pipeline: stages over the documents table, each working on all that the one before kept.

For all stages: columns beside doc_id, text and source pass as they are, whatever their names; working columns take names
that the input does not have or begin with `__`. An empty table gives an empty table. Texts are taken whole, however long.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import common, mixing, near_copies, packing, suffix_dedup, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression distance predicts to be toxic go. Null and empty texts stay; repeated rows share their fate."""
    return toxicity.reject(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity of 0.8 or more stays, the first by doc_id and hash of text.

    Null doc_ids come last. Documents without words stay. Rows that repeat doc_id and text count as one; a doc_id with
    another text besides loses only the copy.
    """
    return near_copies.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that start in a document of a smaller doc_id go, and documents of which nothing is left.

    Null and empty texts stay. Rows of one doc_id take nothing from each other; null doc_ids take from nobody.
    """
    return suffix_dedup.remove(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their weights; a document comes as often as it is taken, in shuffled shards.

    A null source is a source. Texts without words add nothing to a target and are taken as their block is.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens. A null or empty text is its end id alone."""
    return packing.digested(packing.pack(docs))


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("mixing", mixed), ("packing", packed)]

#: SQL cannot express the compression distance, tokenizers or hashed choices; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    home = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{home}/{i}")
            docs = spark.read.parquet(f"{home}/{i}")
    return docs
