"""From documents to packed training sequences, in five stages.

Toxic documents go; of equal texts one row stays, then one document of each
near-duplicate group; the sources are mixed to their target weights, rows in
training order and as often as they are taken; the mix is packed.  Each stage
takes (spark, docs, sf_dir) and works on all that the stage before it kept.
All but the last return the columns of ``documents``; the last returns the
packed pieces.

Every stage is written as Parquet to the shared folder and read again.

Defined cases, stage by stage (the operators' docstrings say more): null and
empty texts pass the first stage by the score of a text without words, are copies
of one another in the second, and are kept by all others; rows with a null
doc_id are documents like any other; repeated rows are one document from the
second stage on; ties go to the largest doc_id among copies and to the smallest
among near copies; very long texts are read whole; columns beyond those of
``documents`` pass through all stages but the last, whatever their names; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazrank.llm import exact_dedup, mixing, packing, simhash, toxicity
from hazrank.llm.common import documents, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go.  It learns from the
    labelled documents of ``sf_dir``."""
    return toxicity.clean(docs, toxicity.fit(documents(spark, sf_dir), table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in training order, each as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier, SimHash and a tokenizer are beyond SQL; the tests hold
#: every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
