"""A corpus pipeline of the training-data operators: filter, clean, deduplicate, mix, pack.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's docs, so a lost executor never reaches behind the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketry.llm.common import Scratch, table
from docketry.llm.line_dedup import dedup_lines
from docketry.llm.mixing import mix_sources
from docketry.llm.packing import pack_documents
from docketry.llm.quality_rules import filter_documents
from docketry.llm.queries import TOKENIZER
from docketry.llm.simhash import drop_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass; the others go."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks that an earlier document has; n_chars follows."""
    return dedup_lines(docs, count_col=None)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight."""
    return mix_sources(docs, details=False)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and their places in sequences."""
    return pack_documents(docs, TOKENIZER)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup), ("mixing", mixing), ("packing", packing)]

#: The stages hold a tokenizer and an alignment that SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        before = len(Scratch.opened)
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        Scratch.release(spark, before)  # written, so what the stage itself kept is free
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
