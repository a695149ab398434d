"""Columns of a caller's table that an operator passes on, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(df: DataFrame, *keys: Column) -> DataFrame:
    """``df`` as one field ``row`` beside the operator's own columns, so that no names can clash."""
    return df.select(F.struct(F.col("*")).alias("row"), *keys)


def passed(df: DataFrame, added: list[str]) -> dict[str, str]:
    """The name that each column of ``df`` gets beside the ``added`` ones.

    A column that is named like an added one gets ``_input`` after its name, and as many ``_`` more
    as make it different from all others; names are compared as Spark does, without regard to case.
    """
    results = {c.lower() for c in added}
    taken = results | {c.lower() for c in df.columns}
    names = {}
    for c in df.columns:
        name = c
        if c.lower() in results:
            name = f"{c}_input"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        names[c] = name
    return names


def unpacked(df: DataFrame, added: list[str], instead: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``df`` out of the field ``row``; some with another value ``instead``."""
    own = instead or {}
    return [own.get(c, F.col("row").getField(c)).alias(name) for c, name in passed(df, added).items()]
