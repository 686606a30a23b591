"""Documents to training tokens: stages over the operators of ``marginalia.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm.common import stored, table
from marginalia.llm.decontamination import clean
from marginalia.llm.language_id import accepted
from marginalia.llm.mixing import mixed
from marginalia.llm.near_dedup import one_of_each
from marginalia.llm.token_blocks import encoded

#: Hundredths of similarity at which documents of the pipeline are copies.
SIMILARITY = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: without text, without a letter, or undecided.

    Repeated rows are judged alike, null ids stay, an empty table gives no row.
    """
    return accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, copies being at a similarity of 0.8 or more on five-word shingles.

    The smallest id stays, once where its row is repeated; documents without
    text stay, and those without id unless they link with one that has an id;
    an empty table gives no row.
    """
    return one_of_each(docs, similarity_pct=SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go.

    Null and empty texts stay, repeated rows are judged alike, all stay
    without items, an empty table gives no row.
    """
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay as often as the mix of sources takes them.

    Null and empty texts are never taken, null is a source of its own,
    identical rows share one decision, an empty table gives no row.
    """
    return mixed(docs)


def write_token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ascending order of id, as written and read back.

    Null text gives the end id alone, rows without id come first, repeated
    rows are each written, an empty table gives no row.
    """
    return encoded(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_blocks", write_token_blocks),
]

#: No SQL for trained language models, signatures and tokenizers; ``tests/llm`` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
