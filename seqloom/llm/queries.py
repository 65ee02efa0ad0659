"""The registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from seqloom.llm import classifier, divergence, langid, lexical, mixing, packing, pages, quality, sharding, simhash, spans, tokenfile, topk
from seqloom.llm.common import documents
from seqloom.plans.recovery import fresh_path


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {
    "op1_simhash": lambda spark, d: simhash.query(documents(spark, d)),
    "op2_quality_rules": lambda spark, d: quality.query(documents(spark, d)),
    "op3_token_file": lambda spark, d: tokenfile.query(documents(spark, d), fresh_path(spark, "tokens"), tokenizer("byte_bpe_50k.json")),
    "op4_sharding": lambda spark, d: sharding.query(documents(spark, d)),
    "op5_quality_classifier": lambda spark, d: classifier.query(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
    "op6_suffix_array": lambda spark, d: spans.query(documents(spark, d)),
    "op7_language_id": lambda spark, d: langid.query(documents(spark, d)),
    "op8_mixing": lambda spark, d: mixing.query(documents(spark, d)),
    "op9_top_k": topk.query,
    "op10_packing": lambda spark, d: packing.query(documents(spark, d), tokenizer("word_bpe_49k.json")),
    "op11_html_text": lambda spark, d: pages.query(spark.read.parquet(f"{d}/pages.parquet")),
    "op12_divergence": lambda spark, d: divergence.query(documents(spark, d)),
    "op13_lexical_search": lambda spark, d: lexical.query(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")),
}
ORACLES: dict[str, str] = {
    "op2_quality_rules": quality.ORACLE,
    "op9_top_k": topk.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
