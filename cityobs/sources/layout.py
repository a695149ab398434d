"""Paths of the dataset, result and statistics trees below one root."""

from __future__ import annotations

import time
from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def data(self, name: str, fmt: str) -> str:
        return self._join("data", fmt, f"{name}.{fmt}")

    def result(self, query: str, variant: str, fmt: str, run: int) -> str:
        return self._join("results", f"{query}_{variant}_{fmt}_{run}.csv")

    def result_table(self, query: str) -> str:
        return self._join("tables", query)

    def stats(self, millis: int | None = None) -> str:
        return self._join("stats", f"{int(time.time() * 1000) if millis is None else millis}.csv")

    def run_log(self, millis: int) -> str:
        return self._join("runs", str(millis))
