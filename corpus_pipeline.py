"""Corpus pipeline: quality filter, exact and near de-duplication, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``; the last returns the packed pieces, one row each.

Every stage works on all rows its predecessor kept.  Null texts count as empty; an empty table gives
an empty result.  ``labels`` (doc_id, quality) of ``sf_dir`` teach the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import exactdedup, mixing, packing, quality, simhash
from starmart.llm.common import stored, table
from starmart.llm.queries import vocabulary


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts (score 0.7 and more)."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z, the row with the largest doc_id stays."""
    return exactdedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of SimHash fingerprints (3 words, 2 bits) the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's repetition rate says."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences of at most 4096 tokens; repeated documents are packed each."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality", quality_filter), ("exact dedup", exact_copies), ("near dedup", near_copies),
          ("source mix", source_mix), ("packing", packed)]

#: the quality classifier, the SimHash components and the tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
