"""The opN_<name> queries and the pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldus.llm import alignment, anisotropic, audit, compaction, languages, licenses, mixing, ngram_join, packing, quality, token_counts, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allotted(table(spark, sf_dir, "documents")).drop("source")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = ngram_join.members(table(spark, sf_dir, "documents"), ngram_join.Join(words=5, num=80, den=100), ("source",))
    return packing.pack_items(near.withColumnsRenamed({"keep_source": "source", "n_words": "size"}))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anisotropic.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"), ngram_join.Join(words=3, num=90, den=100))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.compacted(table(spark, sf_dir, "documents"), compaction.Setup())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    one, two = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), lambda: alignment.byte_level(one), lambda: alignment.pieces(two))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    own = (op1_quality_rules, op2_mixing, op3_license_scan, op4_packing, op5_nearest, op6_toxicity, op7_language_id, op8_ngram_join, op9_token_counts, op10_sharding, op11_filter_audit, op12_warc, op13_alignment)
    return {f.__name__: f for f in own} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": licenses.oracle(), "op11_filter_audit": audit.oracle(), "op12_warc": warc.oracle()}
