"""Corpus pipeline: quality rules, exact dedup, near-dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the
stages run one after the other, each on a Parquet copy of all its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table
from tidewater.llm.exact_dedup import drop_copies
from tidewater.llm.graph import stored
from tidewater.llm.near_dedup import near_dedup
from tidewater.llm.packing import ORDERED_IDS, packed_pieces
from tidewater.llm.quality_rules import clean_documents
from tidewater.llm.queries import tokenizer_path
from tidewater.llm.source_mix import mix_sources


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones go on without their failing lines. n_chars stays that of the source."""
    return clean_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences by number follow the mix.

    Rows lose their order when they are written and read again, so they are put in
    it anew; the mix drops nothing, so its positions come out the same.
    """
    return packed_pieces(mix_sources(docs), tokenizer_path(), pool_ids=ORDERED_IDS)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("source mix", mix),
          ("packing", packing)]

# Signatures, components and tokenisation have no SQL form; the tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
