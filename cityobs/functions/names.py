"""City names as column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identifier(name: str) -> str:
    """SQL name that survives dots, spaces and backticks in a city name."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    return F.col(identifier(name))


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def city_name(column: str) -> str:
    """The city a wide column stands for; underscores in a header stand for spaces."""
    return column.replace("_", " ")


def to_underscores(df: DataFrame) -> DataFrame:
    """Header without spaces. Only the header changes, no cell does."""
    return df.toDF(*[name.replace(" ", "_") for name in df.columns])
