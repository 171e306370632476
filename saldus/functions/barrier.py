"""Keeping plans small where many rules read the same parsed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """df with its columns worked out once per row.

    The optimizer moves filters below projections and puts each column's expression in place of its name. Where dozens of rules read a
    parsed cell, that multiplies the parsers' expressions beyond what code generation takes. A generator of one row stops it: what stands above
    refers to values. It needs no shuffle and stays within whole-stage code.
    """
    names = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    return df.select(F.expr(f"inline(array(struct({names})))"))
