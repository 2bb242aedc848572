"""Registered queries of the training-data operators: ``name -> fn(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import chat_digest
from .common import table
from .conversation_repair import repair_conversations
from .exact_dedup import exact_dedup
from .html_text import page_digest
from .language_id import language_digest
from .near_dedup import near_classes
from .packing import packed_pieces
from .pattern_packing import pack_patterns
from .quality_rules import quality_rules
from .repeats import repeat_digest
from .secret_scan import secret_digest
from .source_divergence import source_divergence
from .source_mix import mix_places


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Vocabulary file of the installed public tokenizers; every executor has it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, out_col="q")
    return judged.select("doc_id", *(f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                        "n_repeat_words", "base_failed", "kept", "n_lines",
                                                        "lost_lines", "lost_words")))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_digest(table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_places(table(spark, sf_dir, "documents"))


# One more conversation that op9 formats beside the table's.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(EXTRA_TEXT).alias("text"))
    return chat_digest(rows.unionByName(extra))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_patterns(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), ids=False)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"), damage=True)


LLM_QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_html_text, op3_substring_dedup, op4_exact_dedup, op5_packing,
                                       op6_language_id, op7_near_dedup, op8_source_mix, op9_chat_format, op10_secret_scan,
                                       op11_pattern_packing, op12_source_divergence, op13_conversation_repair)}
