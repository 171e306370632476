"""Look-ups by code: rows that share a code, and which of them counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_last(records: DataFrame, order: str = "_ord") -> DataFrame:
    """One row for each code, the last one's fields; _pos is the code's first place. Rows without a code go; '' is a code.

    A grouped aggregation of whole rows: partial results are combined before the shuffle, so a frequent code isn't gathered in one task.
    """
    rest = [c for c in records.columns if c != "nex_codigo"]
    kept = records.where(F.col("nex_codigo").isNotNull()).groupBy("nex_codigo").agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"), F.min(order).alias("_pos"))
    return kept.select(*(F.col("nex_codigo") if c == "nex_codigo" else F.col(f"_row.`{c}`").alias(c) for c in records.columns), "_pos")


def repeated_codes(codes: DataFrame) -> DataFrame:
    """The codes (nex_codigo) that stand in more than one row, and 'null' where rows without a code, or of that very code, do. Counts are combined before they are sent."""
    return codes.groupBy(F.coalesce("nex_codigo", F.lit("null")).alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key")


def _shared(rows: DataFrame, found: DataFrame, value: str) -> DataFrame:
    """rows with the column `value` of their code from found (_key, value); null for rows whose code isn't there.

    Rows without a code share what the text 'null' has, as that is a code here: one row, which goes to all of them, so they aren't sent to one task. In the join they stand under keys of
    their own that match nothing; a frequent code's rows can be split, as found has one row of it.
    """
    without = F.coalesce(F.col("nex_codigo") == "null", F.lit(True))
    spread = F.concat(F.lit("\0"), F.pmod(F.col("_ord"), F.lit(4096)).cast("string"))
    joined = rows.withColumn("_key", F.when(without, spread).otherwise(F.col("nex_codigo"))).join(found.where("_key <> 'null'"), "_key", "left").drop("_key")
    common = F.broadcast(found.where("_key = 'null'").select(F.col(value).alias("_common")))
    return joined.join(common, without, "left").withColumn(value, F.when(without, F.col("_common")).otherwise(F.col(value))).drop("_common")


def with_details_of_code(validated: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Each row with the validation of the last row of its code; rows without a code share one, as the text 'null' is a code here.

    repeated: validated rows of the codes that stand in more than one row (more rows do no harm), or None if none does: then rows have their own.
    """
    if repeated is None:
        return validated
    parts = ("validacao_status", "erros", "avisos")
    last = repeated.groupBy(F.coalesce("nex_codigo", F.lit("null")).alias("_key")).agg(F.max_by(F.struct(*parts), F.col("_ord")).alias("_last"))
    return _shared(validated, last, "_last").withColumns({c: F.when(F.col("_last").isNull(), F.col(c)).otherwise(F.col(f"_last.{c}")) for c in parts}).drop("_last")


def with_first_of_code(rows: DataFrame, repeated: DataFrame | None, fields: list[str]) -> DataFrame:
    """rows with _first, the fields of the first row of their code, as a struct; rows without a code share one. repeated: as above."""
    own = F.struct(*fields)
    if repeated is None:
        return rows.withColumn("_first", own)
    first = repeated.groupBy(F.coalesce("nex_codigo", F.lit("null")).alias("_key")).agg(F.min_by(own, F.col("_ord")).alias("_first"))
    return _shared(rows, first, "_first").withColumn("_first", F.coalesce("_first", own))


def all_codes(base: DataFrame, new: DataFrame) -> DataFrame:
    codes = base.select("nex_codigo").union(new.select("nex_codigo"))
    return codes.where(F.col("nex_codigo").isNotNull()).distinct()
