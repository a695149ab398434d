"""Wide tables (one column per city) to long ones, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, NumericType

from cityobs.functions.localtime import as_time
from cityobs.functions.names import city_name, identifier, quoted, text_literal
from cityobs.sources.tables import YEAR_COLUMN


def time_column(wide: DataFrame) -> str:
    """The time column is found by position: it is the first one."""
    return wide.columns[0]


def city_columns(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns[1:] if c != YEAR_COLUMN]


def to_long(
    wide: DataFrame,
    measure: str,
    *,
    text: bool = False,
    cities: Sequence[str] | None = None,
    time_col: str | None = None,
    on_bad_cell: str = "error",
) -> DataFrame:
    """``(ts, City, measure)`` for every filled cell, plus the year partition where there is one.

    ``cities`` picks cities before the reshape, so that the scan reads only their columns.
    The cells travel as one array, which keeps the generated code small for thousands of cities
    and runs several times faster there than one projection per city.

    A cell that is filled but no number is an error; ``on_bad_cell="null"`` drops it.
    """
    if on_bad_cell not in ("error", "null"):
        raise ValueError(f"on_bad_cell is 'error' or 'null', not {on_bad_cell!r}")
    if not measure:
        raise ValueError("a measure needs a name")
    time_col = time_col or time_column(wide)
    columns = [c for c in city_columns(wide) if c != time_col]
    if cities is not None:
        chosen = set(cities)
        columns = [c for c in columns if city_name(c) in chosen]
    kept = [YEAR_COLUMN] if YEAR_COLUMN in wide.columns else []
    wanted = "string" if text else "double"
    ts = as_time(quoted(time_col), wide.schema[time_col].dataType).alias("ts")
    if not columns:
        empty = wide.limit(0)
        return empty.select(
            ts, F.lit(None).cast("string").alias("City"), F.lit(None).cast(wanted).alias(measure), *kept
        )
    shown = wanted if on_bad_cell == "null" else "string"
    cells = ", ".join(f"try_cast({identifier(c)} AS {shown})" for c in columns)
    if all(isinstance(wide.schema[c].dataType, (NumericType, NullType)) for c in columns):
        shown, cells = wanted, ", ".join(f"CAST({identifier(c)} AS {wanted})" for c in columns)
    names = F.expr(f"array({', '.join(text_literal(city_name(c)) for c in columns)})")
    cell = F.col("__cell")
    if shown != wanted:
        # Checked once per cell, after the reshape, so that the generated code stays small.
        bad = F.raise_error(F.concat(F.lit(f"a cell of {measure} is no number: "), cell))
        cell = F.when(F.trim(cell) == "", None).otherwise(F.coalesce(cell.try_cast(wanted), bad.cast(wanted)))
    return (
        wide.select(ts, *kept, F.expr(f"posexplode(array({cells}))").alias("__pos", "__cell"))
        .where(F.col("ts").isNotNull() & F.col("__cell").isNotNull())
        .select(
            "ts",
            F.element_at(names, F.col("__pos") + 1).alias("City"),
            cell.alias(measure),
            *kept,
        )
        .where(F.col(measure).isNotNull())
    )


def to_wide(long: DataFrame, measure: str, cities: Sequence[str]) -> DataFrame:
    """One row per time and one column per city, each cell the mean of its readings.

    ``cities`` names the columns, so no pass over the data is needed to find them.
    """
    return long.groupBy("ts").pivot("City", list(cities)).agg(F.avg(measure))
