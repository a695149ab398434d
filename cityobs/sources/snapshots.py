"""Tables that are replaced as a whole and that readers never see half written.

A snapshot's files go into a folder of its own. Only when all of them are there, a manifest that
names the folder is put in place under the next number, by a rename, and that is the moment from
which readers find it. A write that fails leaves no manifest, so the earlier snapshot stays what
readers get; two writers that race for a number cannot both have it, and the later one is told.

Manifests and folders stay until ``drop_old_snapshots`` takes away all but the last few, so that a
reader that has begun keeps its files.

Defined cases: a folder without a manifest has no snapshot, which is an error to read; a snapshot
may be empty and may have other columns than the one before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_MANIFESTS, _DATA = "_manifests", "data"


class SnapshotConflict(RuntimeError):
    """Another writer has put a snapshot in place meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its number, where its files are, and what its writer noted."""

    number: int
    path: str
    note: dict[str, Any] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, system = _path(spark, f"{root}/{_MANIFESTS}")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_MANIFESTS}/{number:012d}.json"


def _of(spark: SparkSession, root: str, number: int) -> Snapshot:
    path, system = _path(spark, _manifest(root, number))
    stream = system.open(path)
    try:
        told = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Snapshot(number, f"{root}/{_DATA}/{told['folder']}", told["note"])


def latest_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    numbers = _numbers(spark, root)
    return _of(spark, root, numbers[-1]) if numbers else None


def write_snapshot(df: DataFrame, root: str, note: dict[str, Any] | None = None, after: int | None = None) -> Snapshot:
    """Put ``df`` in place as the next snapshot.

    ``after`` is the number of the snapshot that the writer started from (0 for none); if another
    one is the latest by now, nothing changes and ``SnapshotConflict`` is raised.
    """
    spark = df.sparkSession
    numbers = _numbers(spark, root)
    last = numbers[-1] if numbers else 0
    if after is not None and after != last:
        raise SnapshotConflict(f"snapshot {last} is there, {after} was expected")
    folder = uuid.uuid4().hex
    df.write.parquet(f"{root}/{_DATA}/{folder}")
    half, system = _path(spark, f"{root}/{_MANIFESTS}/_{folder}")
    stream = system.create(half, False)
    try:
        stream.write(bytearray(json.dumps({"folder": folder, "note": note or {}}).encode()))
    finally:
        stream.close()
    whole, _ = _path(spark, _manifest(root, last + 1))
    if system.exists(whole) or not system.rename(half, whole):
        system.delete(half, False)
        raise SnapshotConflict(f"another writer has snapshot {last + 1}")
    return Snapshot(last + 1, f"{root}/{_DATA}/{folder}", note or {})


def read_snapshot(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The latest snapshot, or one of the earlier ones that are still there."""
    found = latest_snapshot(spark, root) if number is None else _of(spark, root, number)
    if found is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    return found.read(spark)


def drop_old_snapshots(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Take away all snapshots but the last ``keep``; tells how many went."""
    old = _numbers(spark, root)[: -max(1, keep)]
    for number in old:
        for name in (_of(spark, root, number).path, _manifest(root, number)):
            path, system = _path(spark, name)
            system.delete(path, True)
    return len(old)
