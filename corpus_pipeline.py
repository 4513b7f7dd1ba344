"""Preparing a training corpus: filter, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; results are written as Parquet and read again between stages.

Defined results of every stage: null texts count as empty, null ids are ids of their own kind (smaller than all others where an order is asked for, null last
where the smallest id stays), columns beside those of ``documents`` pass through under any name except in the last stage, and an empty table gives an empty one.
What a stage does beyond that is stated with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import lines, mixing, packing, simhash_tree, toxicity
from loomline.llm.common import importable, table
from loomline.sources.tables import store_stage

#: The stages cannot be written in SQL; tests hold them against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on all labelled documents, does not reject.

    Empty texts have no evidence and stay; repeated rows share their fate.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.classify(docs, model).where(F.col("predicted") == 0).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that five or more documents hold; the largest doc_id keeps them.

    Rows of one doc_id are one document for the counts. Null texts stay null; a text that loses all its lines is empty. No row is dropped.
    """
    importable(spark)
    done = lines.dedup_lines(docs)
    size = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", size).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8).

    The smallest doc_id stays, with one row; null and empty texts are one group, of which one stays.
    """
    importable(spark)
    return simhash_tree.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or stretches of them, as often as the sources' target weights ask for.

    Texts without words give no row; a null source is a source, the last one. Rows that repeat are laid out each.
    """
    importable(spark)
    return mixing.mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset; a document without words is the one id of its end."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_two_fit", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store_stage(docs, name)
    return docs
