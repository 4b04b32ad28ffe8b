"""The corpus pipeline: stages that each take the documents their predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm.decontamination import decontaminate
from subtide.llm.line_dedup import remove_boilerplate
from subtide.llm.mixing import mixture
from subtide.llm.ngram_join import deduplicated
from subtide.llm.queries import TOXIC_FOLDS, fold, table
from subtide.llm.store import stored
from subtide.llm.toxicity import toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.7; null, empty and repeated ones are scored like any other."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"), fold(TOXIC_FOLDS) != 1)
    return scored.where("predicted = 0").select("row.*")


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten sources have, or three quarters of all if that is less. Texts with no
    other line stay whole, as do null and empty ones."""
    return remove_boilerplate(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that with the smallest doc_id; those without a doc_id or
    without words stay, of repeated rows one."""
    return deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows do not cover by a twentieth or more; null and empty ones stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the calibrated probability of their source, language and topic, half of all tokens on average,
    and that probability; those without words stay. Its name gets a dash if the documents have a column of that name."""
    name = "mix_probability"
    while name in docs.columns:
        name += "_"
    return mixture(docs).where("kept").select("row.*", F.col("probability").alias(name))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_boilerplate),
    ("ngram_jaccard_join", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", sample_mixture),
]

#: Learning a lexicon and the components of near duplicates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
