"""Projected stage times: a stage timed on a sample, carried on to the full number of rows."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

LONG_MINUTES = 15


@dataclass
class StageTime:
    stage: str
    rows: int
    seconds: float
    full_rows: int

    @property
    def projected(self) -> float:
        return self.seconds * self.full_rows / max(1, self.rows)

    @property
    def long(self) -> bool:
        return self.projected > 60 * LONG_MINUTES


def timed(stage: str, make: Callable[[], DataFrame], full_rows: int) -> StageTime:
    """Run a stage whole, with all its columns; its output rows are the measure of its size."""
    began, seen = time.time(), Observation()
    make().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return StageTime(stage, seen.get["rows"], time.time() - began, full_rows)


def table(times: list[StageTime]) -> str:
    lines = [f"{'stage':<20} {'rows':>12} {'seconds':>9} {'full rows':>14} {'projected':>11}"]
    lines += [f"{t.stage:<20} {t.rows:>12,} {t.seconds:>9.1f} {t.full_rows:>14,} {t.projected / 60:>8.1f} min{' LONG' if t.long else ''}" for t in times]
    return "\n".join(lines)
