"""The corpus pipeline: toxicity filter, language filter, near-dedup, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes
as Parquet and reads again as the next stage's documents. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import langid, packing, simhash, toxicity
from pricelens.llm.common import table, unused, written
from pricelens.llm.queries import VOCABULARY


#: A document whose language is less certain than this is rejected, as is one without letters.
LEAST_CERTAIN = 0.51


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    score = unused(docs, "_toxicity")
    scored = toxicity.learned(docs, table(spark, sf_dir, "labels"), score)
    return scored.filter(toxicity.predicted(score) == 0).select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    language = unused(docs, "_language")
    found = langid.identify(docs, language)
    certain = (F.col(language)["lang_pred"] != langid.UNDETERMINED) & (
        F.col(language)["score"] >= LEAST_CERTAIN)
    return found.filter(certain).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", keep_civil),
    ("language", keep_identified),
    ("near-dedup", keep_one_of_each),
    ("packing", pack),
]

#: The stages learn models and pack; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
