"""From raw documents to packed training bins: the stages, in order, each on all that the one before it has kept.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of documents: the quality rules with the text that is left
of a document after its bad lines are gone, the mix with a row for each time that a document is taken. A stage's result is written
before the next reads it, to the shared folder in `run`.

Defined cases: a null or empty text has no words and goes with the quality rules; rows without doc_id are judged, compared and packed like any other; a text of
any length is taken whole; repeated rows are judged one by one, of equal or near texts the row of the smallest doc_id stays, and ties between rows of
one doc_id go to the smaller text hash; an empty table gives no rows at any stage; columns beside those of documents pass through all stages but the
last, whose columns are its own, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saldus.llm import mixing, ngram_join, packing, quality, scratch, toxicity


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.filtered(docs, toxicity.fitted(docs, labels))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicated(docs, ngram_join.Join(words=5, num=80, den=100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

#: Neither the classifier nor the hash order of the mix can be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.drop(before)  # nothing for the first: the documents themselves aren't ours
    return STAGES[-1][1](spark, docs, sf_dir)
