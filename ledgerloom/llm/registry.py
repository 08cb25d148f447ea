"""The queries of this package, each over its whole table, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (collocations, conversations, decontamination, language_id, line_dedup, lm_scoring, mixing, ngram_join, quality_classifier,
                            quality_rules, simhash, token_counts, toxicity)
from ledgerloom.llm.common import remainder, ship, table

Query = Callable[[SparkSession, str], DataFrame]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(table(spark, sf_dir, "documents"))

    return run


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

    return run


def _with_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair(turns, present=F.col("present"))


def _token_counts(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def queries() -> dict[str, Query]:
    return {
        "op1_mixed_sources": _on_documents(mixing.mixed_sources),
        "op2_ngram_join": _on_documents(ngram_join.join),
        "op3_toxicity": _with_labels(toxicity.toxicity),
        "op4_quality_classifier": _with_labels(quality_classifier.quality),
        "op5_contaminated": _with_benchmark,
        "op6_lm_scores": _on_documents(lm_scoring.lm_scores),
        "op7_token_counts": _on_documents(_token_counts),
        "op8_quality_rules": _on_documents(quality_rules.quality_rules),
        "op9_language_id": _on_documents(language_id.language_id),
        "op10_line_dedup": _on_documents(line_dedup.line_report),
        "op11_simhash": _on_documents(simhash.near_duplicates),
        "op12_collocations": _on_documents(collocations.collocations),
        "op13_repaired": _repaired,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mixed_sources": mixing.SQL, "op8_quality_rules": quality_rules.SQL, "op12_collocations": collocations.SQL}


def _identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    learn = remainder(F.col("doc_id"), 3) != 1
    return language_id.keep_identified(docs, language_id.train(docs, learn))


def _dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.dedup_lines(docs)


def _one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mix(docs)


def stages() -> list[tuple[str, Stage]]:
    """The pipeline: each takes (spark, docs, sf_dir); all but the last return the columns of docs."""
    return [
        ("language_id", _identify),
        ("line_dedup", _dedup_lines),
        ("ngram_join", _one_of_each_group),
        ("decontamination", _decontaminate),
        ("mixing", _mix),
    ]
