"""Cleaning of raw wide tables and of the city dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityobs.functions.cells import (
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    RULES,
    RangeRule,
    any_of,
    number,
    unreadable,
)
from cityobs.functions.localtime import as_time
from cityobs.functions.names import identifier, quoted
from cityobs.operators.reshape import city_columns, time_column


def _timed_rows(wide: DataFrame, time_col: str) -> DataFrame:
    """Rows with a readable time, the time typed and the columns in their order."""
    ts = as_time(quoted(time_col), wide.schema[time_col].dataType)
    others = [identifier(c) for c in wide.columns if c != time_col]
    return wide.select(ts.alias(time_col), *others).where(quoted(time_col).isNotNull())


def _each(rows: DataFrame, columns: list[str], step: Callable[[str], str]) -> DataFrame:
    chosen = set(columns)
    names = [(identifier(c), c in chosen) for c in rows.columns]
    return rows.selectExpr(*[f"{step(n)} AS {n}" if touched else n for n, touched in names])


def clean_measure(
    wide: DataFrame,
    rule: str | RangeRule,
    *,
    on_bad_cell: str = "drop_row",
    time_col: str | None = None,
) -> DataFrame:
    """Apply the cell rule of a measure to every city column.

    Rows without a readable time go. Empty cells become null, readings out of range are blanked.
    A cell that is not a number drops its whole row, or with ``on_bad_cell="blank"`` only itself.
    """
    if on_bad_cell not in ("drop_row", "blank"):
        raise ValueError(f"on_bad_cell is 'drop_row' or 'blank', not {on_bad_cell!r}")
    rule = RULES[rule] if isinstance(rule, str) else rule
    time_col = time_col or time_column(wide)
    columns = [c for c in city_columns(wide) if c != time_col]
    rows = _timed_rows(wide, time_col)
    if on_bad_cell == "drop_row" and columns:
        rows = rows.where("NOT " + any_of([unreadable(identifier(c)) for c in columns]))
    # One projection per step, so that no step is computed again for each use of its result.
    for step in (number, rule.restore, rule.keep_valid):
        rows = _each(rows, columns, step)
    return rows


def clean_description(wide: DataFrame, *, time_col: str | None = None) -> DataFrame:
    """Only the time is checked; texts stay as they are."""
    return _timed_rows(wide, time_col or time_column(wide))


def clean_city(
    cities: DataFrame, *, lat_col: str | None = None, lon_col: str | None = None
) -> DataFrame:
    """Cities with valid coordinates, ends included. By default columns 2 and 3 hold them."""
    lat_col = lat_col or cities.columns[1]
    lon_col = lon_col or cities.columns[2]
    typed = cities.withColumns(
        {c: F.expr(number(identifier(c))) for c in (lat_col, lon_col)}
    )
    return typed.where(
        quoted(lat_col).between(*LATITUDE_RANGE) & quoted(lon_col).between(*LONGITUDE_RANGE)
    )
