"""The queries of the operators in this subpackage, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import (
    decontaminate, dominance_packing, hard_negatives, html_text, langid, packing, prefix_trie, quality, simhash, substring_dedup,
    suffix_dedup, toxicity, urls,
)
from ledgerlens.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = urls.judge(pages.select("page_id", "url"), urls.fit(urls.labelled_by_rules(pages)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    columns = ("doc_id", langid.held_out(), "lang_pred", "score", "cross_entropy", "rejected")
    return langid.predict(docs, model).select(*columns)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.main_text(pages, html_text.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = dominance_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.drop("ids")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th row is an anchor; every 7th row counts under the label that follows its own."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_openings(turns))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_simhash_near_dedup, op3_substring_dedup, op4_quality_rules, op5_toxicity,
        op6_benchmark_decontamination, op7_url_filters, op8_packing, op9_language_id, op10_html_extraction,
        op11_best_fit_packing, op12_hard_negatives, op13_prefix_trie,
    )
}
ORACLES: dict[str, str] = {
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
