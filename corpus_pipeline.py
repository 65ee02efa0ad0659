"""The corpus pipeline: language ID, near-dedup, passage removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns of
``documents``.  A stage works on what the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import langid, mixing, packing, shingles, spans
from seqloom.llm.queries import tokenizer
from seqloom.plans.recovery import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null texts and texts without letters go."""
    return langid.accepted(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies (5-word shingles, similarity 0.8 or more).

    SimHash fingerprints and min-hash bands propose, whole shingle sets decide.

    Null and empty texts and those without words are one class.  Rows with null or repeated ids are documents of their
    own: those with an id come first, rows of one id in an order that their texts decide.  An empty table stays empty.
    """
    return shingles.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier; n_chars follows the text.

    No row goes: a text of which nothing is left stays as an empty one, a null text stays null.  Rows with null or
    repeated ids are documents of their own, in the order of ids and then texts.
    """
    kept = spans.removed(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null texts have size 0, a null source is a source, repeated rows are mixed as documents of their own, and an empty
    table stays empty.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a window of 2048 tokens.

    Null texts count as empty and give their end token; copies of a row are packed as often as they come.
    """
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), remember=250_000)  # workers also serve the other stages


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mix_sources", mix_sources), ("pack", pack)]

#: Fingerprints, iterative balancing and tokenizers are beyond SQL; the tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order over ``documents``; what each keeps is written once and read by the next.

    Null values, ties, repeated rows and columns beyond those of ``documents`` are as each stage tells; an empty table
    gives no pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
