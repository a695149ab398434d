"""Offsets of any number of time zones by lookup in a table of clock changes.

A zone's clock changes at known instants, and between two of them its offset is fixed. Time is cut
into spans of ``2 ** SPAN_BITS`` seconds, a little over a year. The table has a row for each zone
and span: the offset at its start, and the few changes within it with the offsets after them. An
instant finds its row by one number made of zone and span, and its offset by comparing it with
those changes, so a lookup costs the same for five zones and for all there are.

The changes are those of the JVM's own rules, so the offsets are what ``from_utc_timestamp`` gives.
The table's size is bounded by the rules: about 280 rows a zone, and some 600 zones exist.

Defined cases: instants outside ``FIRST`` to ``LAST`` and zones that the table lacks have no offset
here, and the caller goes on with the zone's name; a null zone has none either.
"""

from __future__ import annotations

import datetime as dt
import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import DateTimeException, IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spans of 388 days.
SPAN_BITS = 25
#: Years that the table covers, the last one not included.
FIRST, LAST = 1800, 2100
#: Zones of a table, at most.
MAX_ZONES = 2000

_EPOCH = dt.datetime(1970, 1, 1)
_CHANGE = re.compile(r" at (\d{4}-\d\d-\d\dT[\d:]+)(Z|[+-][\d:]+) to (Z|[+-][\d:]+)\]")

Changes = tuple[int, list[tuple[int, int]]]  # the first offset; instants and the offsets from then on

_zones: dict[str, Changes | None] = {}
_yearly: dict[tuple[str, int], list[tuple[int, int]]] = {}


@dataclass(frozen=True)
class ZoneTable:
    """``numbers``: ``TimeUTC`` and ``zone_number``. ``changes``: ``zone_span`` and its offsets."""

    numbers: DataFrame
    changes: DataFrame
    most: int  # changes within one span


def _second(year: int) -> int:
    return int((dt.datetime(year, 1, 1) - _EPOCH).total_seconds())


def _offset(text: str) -> int:
    if text == "Z":
        return 0
    parts = [int(x) for x in text[1:].split(":")]
    return (-1 if text[0] == "-" else 1) * sum(x * 60 ** (2 - k) for k, x in enumerate(parts))


def _read(text: str) -> list[tuple[int, int, int]]:
    """Instant, offset before and offset after of every change that a text of the JVM lists."""
    out = []
    for at, before, after in _CHANGE.findall(text):
        local = int((dt.datetime.fromisoformat(at) - _EPOCH).total_seconds())
        out.append((local - _offset(before), _offset(before), _offset(after)))
    return out


def zone_changes(spark: SparkSession, zone: str) -> Changes | None:
    """Changes of one zone up to ``LAST``; none for a name that is no zone."""
    if zone in _zones:
        return _zones[zone]
    jvm = spark._jvm
    try:
        rules = jvm.org.apache.spark.sql.catalyst.util.DateTimeUtils.getZoneId(zone).getRules()
    except (DateTimeException, IllegalArgumentException):
        _zones[zone] = None
        return None
    fixed = _read(rules.getTransitions().toString())
    changes = [(at, after) for at, _, after in fixed]
    yearly = rules.getTransitionRules()
    if not yearly.isEmpty():  # the same every year from the last of the fixed ones on
        last = changes[-1][0] if changes else _second(FIRST)
        key = yearly.toString(), last
        if key not in _yearly:
            found, change = [], rules.nextTransition(jvm.java.time.Instant.ofEpochSecond(last))
            while change is not None and (not found or found[-1][0] < _second(LAST)):
                at, _, after = _read(change.toString())[0]
                found.append((at, after))
                change = rules.nextTransition(change.getInstant())
            _yearly[key] = found
        changes += _yearly[key]
    first = fixed[0][1] if fixed else rules.getOffset(jvm.java.time.Instant.EPOCH).getTotalSeconds()
    _zones[zone] = first, changes
    return _zones[zone]


def zone_table(spark: SparkSession, zones: Sequence[str]) -> ZoneTable:
    """The table of these zones; names that are no zones are left out."""
    known = [(z, c) for z in sorted(set(zones)) if (c := zone_changes(spark, z)) is not None]
    spans = range(_second(FIRST) >> SPAN_BITS, (_second(LAST) >> SPAN_BITS) + 1)
    keys, offsets = [], []  # offsets of a row: the first, then instant and offset of each change
    for number, (_, (first, changes)) in enumerate(known):
        at = [a for a, _ in changes]
        for span in spans:
            low, high = bisect_right(at, span << SPAN_BITS), bisect_right(at, ((span + 1) << SPAN_BITS) - 1)
            keys.append(_key(number, span))
            offsets.append((changes[low - 1][1] if low else first, changes[low:high]))
    most = max((len(c) for _, c in offsets), default=0)
    columns = {"zone_span": pa.array(keys, pa.int64()), "offset_0": pa.array([o for o, _ in offsets], pa.int32())}
    for k in range(most):
        there = [c[k] if k < len(c) else (None, None) for _, c in offsets]
        columns[f"change_{k + 1}"] = pa.array([a for a, _ in there], pa.int64())
        columns[f"offset_{k + 1}"] = pa.array([o for _, o in there], pa.int32())
    numbers = {"TimeUTC": pa.array([z for z, _ in known], pa.string()), "zone_number": pa.array(range(len(known)), pa.int64())}
    return ZoneTable(spark.createDataFrame(pa.table(numbers)), spark.createDataFrame(pa.table(columns)), most)


def _key(number, span):
    """One number for zone and span; spans lie between -1024 and 1023."""
    return number * 2048 + span + 1024


def with_offset(df: DataFrame, table: ZoneTable, seconds: Column, into: str = "zone_offset") -> DataFrame:
    """All columns but ``zone_number`` plus the offset of that zone at the instant ``seconds``, null if unknown."""
    span = F.shiftright(seconds, SPAN_BITS)
    key = F.when(span.between(-1024, 1023), _key(F.col("zone_number"), span)).alias("__zone_span")
    found = df.select("*", key).join(F.broadcast(table.changes), F.col("__zone_span") == F.col("zone_span"), "left")
    offset = F.col("offset_0")
    if table.most:
        later = F.when(seconds >= F.col(f"change_{table.most}"), F.col(f"offset_{table.most}"))
        for k in range(table.most - 1, 0, -1):
            later = later.when(seconds >= F.col(f"change_{k}"), F.col(f"offset_{k}"))
        offset = later.otherwise(offset)
    return found.select(*[c for c in df.columns if c != "zone_number"], offset.alias(into))
