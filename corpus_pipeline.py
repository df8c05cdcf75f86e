"""The corpus pipeline: from documents to packed sequences, stage by stage.

Every stage takes the whole table that its predecessor kept, and its decisions take
effect: rejected documents and all but one of a group of near-duplicates go, repeated
passages are cut, personal data become surrogates. All stages but the last return the
columns of ``documents``; the last returns the pieces with their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import free_name, kept_table
from marinelake.llm.language import UNDETERMINED, learn_languages, predict_languages
from marinelake.llm.minhash import drop_near_duplicates
from marinelake.llm.packing import pack_documents
from marinelake.llm.passages import cut_passages
from marinelake.llm.surrogates import replace_personal_data
from marinelake.session import configure

#: A document whose likeliest language is less likely than this is rejected.
LEAST_SCORE = 0.5
#: Consistent weighted sampling, window grouping and packing have no form in SQL.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter or no clear language. Where no document is
    labelled, no language can be unclear, and those with a letter stay."""
    model = learn_languages(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    language, score = free_name(docs, "language"), free_name(docs, "score")
    found = predict_languages(docs, model, lang_pred=language, score=score)
    return found.where((F.col(language) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_passages(docs)


def replace_entities(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return replace_personal_data(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("minhash_near_dedup", keep_one_of_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("pii_surrogates", replace_entities),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
