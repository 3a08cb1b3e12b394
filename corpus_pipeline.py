"""A corpus pipeline: five stages over documents, each written as Parquet and read by the next.

All stages keep the columns of documents, whatever else they are named, but the last one, which adds (or replaces) `rate`. An empty table goes through as an empty one.
Texts are read whole, whatever their length. Rows that repeat are rows of their own; where an id repeats, its rows are one document, which stays or goes as a whole.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import decontam, mixing, neardup, pii, toxicity
from harvestry.llm.common import written

log = logging.getLogger(__name__)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go, row by row.

    Null and empty texts have no hit and stay, as do rows with a null id. Without labels the lexicon's prior weights decide.
    """
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id: five-word shingles, similarity of 0.8 or more.

    Null, empty and wordless texts are like no other and stay; rows with a null id stay.
    """
    return neardup.keep_one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; an empty benchmark takes none.

    Null and empty texts and rows with a null id stay.
    """
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates in every row; n_chars follows the text where it is a column.

    A null text stays null, with a null n_chars, and an empty one empty.
    """
    out = pii.pseudonymise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document gets its rate for equal token totals of the languages; those whose rate is zero go. How far each language's total is off its target is logged.

    Null and empty texts have no tokens; their rate follows from the classifier's prior. Null languages are no domain. Without labels every rate is one.
    """
    found = mixing.mixed(docs, mixing.labelled_languages(docs, _table(spark, sf_dir, "labels")))
    log.info("shares of all tokens that domains are off their targets: %s", found.gap)
    return found.rows.where("rate > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", replace_personal_data),
    ("mixing", mix),
]

#: Trained scores, sketches and surrogates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
