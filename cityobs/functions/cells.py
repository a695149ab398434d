"""Rules for single cells of raw tables.

They take and give SQL expressions. A table has a column per city, and a thousand expressions in
one ``selectExpr`` are handed to Spark in one call, where each column object takes several.
"""

from __future__ import annotations

from dataclasses import dataclass

# Physical ranges (both ends valid) and the bound above which a
# temperature has lost its decimal point.
TEMPERATURE_RANGE = (184.0, 343.0)  # kelvin
PRESSURE_RANGE = (870.0, 1085.6)  # hPa
HUMIDITY_RANGE = (0.0, 100.0)  # percent
LATITUDE_RANGE = (-90.0, 90.0)  # degrees
LONGITUDE_RANGE = (-180.0, 180.0)  # degrees
LOST_POINT_ABOVE = 100000.0
LOST_POINT_DIVISOR = 1000.0


@dataclass(frozen=True)
class RangeRule:
    """Valid range of a measure; readings above ``lost_point_above`` are scaled back first."""

    low: float
    high: float
    lost_point_above: float | None = None

    def restore(self, value: str) -> str:
        """Put a lost decimal point back."""
        if self.lost_point_above is None:
            return value
        bound, divisor = float(self.lost_point_above), float(LOST_POINT_DIVISOR)
        return f"CASE WHEN {value} > {bound!r}D THEN {value} / {divisor!r}D ELSE {value} END"

    def keep_valid(self, value: str) -> str:
        """Blank what is out of range; NaN is."""
        low, high = float(self.low), float(self.high)
        return f"CASE WHEN {value} BETWEEN {low!r}D AND {high!r}D THEN {value} END"


RULES = {
    "temperature": RangeRule(*TEMPERATURE_RANGE, lost_point_above=LOST_POINT_ABOVE),
    "pressure": RangeRule(*PRESSURE_RANGE),
    "humidity": RangeRule(*HUMIDITY_RANGE),
}


def number(cell: str) -> str:
    """Numeric reading of a cell; empty and non-numeric cells are null."""
    return f"try_cast({cell} AS double)"


def unreadable(cell: str) -> str:
    """True for a cell that holds something, but not a number. Never null.

    The same texts are floats and doubles. The test asks for a float because the optimizer, where
    a filter repeats a projected expression, derives the condition with and without the
    projection for every combination of columns, and thirty cities would be too many.
    """
    return f"({cell} IS NOT NULL AND {cell} <> '' AND try_cast({cell} AS float) IS NULL)"


def any_of(flags: list[str]) -> str:
    """Whether any flag holds. Flat, so that thousands of columns do not nest."""
    return flags[0] if len(flags) == 1 else f"greatest({', '.join(flags)})"
