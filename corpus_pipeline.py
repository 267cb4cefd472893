"""The corpus pipeline: quality, language, near duplicates, packing.

Each stage takes (spark, docs, folder) and returns a DataFrame; its result is written
as Parquet in the shared folder and read again as the next stage's documents. All
stages but the last return the columns of ``documents``.

Defined results of every stage: an empty table stays one; other columns, whatever their names, are left out; repeated rows
are judged each for itself until ``near_duplicates`` keeps one of them; texts are read whole. Null, empty and
blank texts go in ``quality``, and texts without a letter in ``language``. A null id is judged like any other, but cannot be
trusted; it stays in a group of near duplicates only if no row there has an id (then one row of each fingerprint does).
Null labels call nothing good.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayflow.llm import language_id, packing, quality, simhash
from assayflow.llm.queries import word_bpe_path
from assayflow.llm.shared import staged

#: The share of a language's labelled documents that fit its trigrams worst; a text that fits worse than all others goes.
LEAST_FIT = 0.001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose perplexity is within their language's limits; texts without a word go."""
    return quality.filter_documents(docs.select(*COLUMNS), spark.read.parquet(f"{folder}/labels.parquet"))


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fit the language mixture found for them, by the labelled documents of their main language.

    The main language fills a null ``lang``; texts without a letter go. If no language can be learned
    (``lang`` is always null), all texts with a letter stay as they are."""
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = language_id.least_fits(docs, model, LEAST_FIT)
    limits = F.create_map(*[F.lit(x) for item in sorted(least.items()) for x in item]) if least else F.create_map().cast("map<string,double>")
    limit = F.try_element_at(limits, F.col("lang_pred"))
    found = language_id.mixtures(docs, model).where(F.col("lang_pred") != language_id.UNDETERMINED)
    found = found.where(limit.isNull() | (F.col("lang_fit") >= limit))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences."""
    return packing.pack_documents(docs, word_bpe_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The stages learn models and iterate; SQL does not express them. See tests/llm/.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table: the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
