"""The registered queries of this folder: each dealt operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sorigil.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op6_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    from sorigil.llm.secret_lexer import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@register
def op9_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    from sorigil.llm.quality_divergence import judge

    return judge(table(spark, sf_dir, "documents"))


@register
def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    from sorigil.llm.superminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op3_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    from sorigil.llm.fm_decontamination import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op8_best_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token windows packed from all documents."""
    from sorigil.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


@register
def op4_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive of every page, written and read back."""
    from sorigil.llm.warc_store import archive_and_read

    return archive_and_read(table(spark, sf_dir, "pages"))


@register
def op10_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from sorigil.llm.toxicity_fm import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from sorigil.llm.host_suffix_array import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


@register
def op1_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    from sorigil.llm.license_rules import scan

    return scan(table(spark, sf_dir, "documents"))


@register
def op5_bayesian_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    from sorigil.llm.language_fusion import identify

    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@register
def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from sorigil.llm.pair_maxscore import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op12_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted with its loss mask, and read back."""
    from sorigil.llm.relational_chat import format_conversations, read_back, with_probe

    return read_back(format_conversations(with_probe(spark, table(spark, sf_dir, "conversations"))))


@register
def op13_debruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    from sorigil.llm.debruijn_collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))
