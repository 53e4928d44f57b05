"""A training corpus from raw documents: toxicity, near-duplicates, decontamination, personal data, source mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.llm import decontaminate, mixing, pii, simhash, toxicity
from cartorio.llm.common import Scratch, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the classifier learns from the labelled documents of this input.

    NULL and empty texts score as the intercept alone; repeated rows stay or go together.
    """
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, a Jaccard similarity of 0.8.

    Fingerprints propose, shingles decide and find the rest. NULL and wordless texts are copies of each other; of a
    group the smallest id stays, NULL ids last; rows of one id and text count as one.
    """
    return simhash.keep_one(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; NULL and empty texts hold none, repeated rows go alike."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; all documents stay, NULL texts as NULL."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("source_mixing", mix_sources),
]
#: A trained classifier and components of similar texts have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet in the shared folder."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
