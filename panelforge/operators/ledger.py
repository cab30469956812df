"""Stage ledger (AGG-20, AGG-19, FLT-06, FN-25): what each stage of a run did to the table.

``Ledger.run`` writes a stage's result once, under the session's checkpoint folder, and reads
it back as the next stage's input. Rows, and NULLs of every column, are counted by an
``Observation`` on the very job that writes the stage, so the counts need no pass of their own and
hold for the rows that were written. A stage's input is the written result of the stage before.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

STAGES = "stage string, position int, rows_before long, rows_after long, removed long, columns_before int, columns_after int, created array<string>, dropped array<string>, elapsed_s double, finished string"
NULLS = "stage string, position int, column_name string, nulls long, rows long, created boolean"


@dataclass
class Ledger:
    spark: SparkSession
    stages: list[tuple] = field(default_factory=list)
    null_counts: list[tuple] = field(default_factory=list)
    rows: int | None = None
    columns: list[str] = field(default_factory=list)

    def run(self, name: str, df: DataFrame, build: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
        """Write ``build(df)`` as stage ``name``; ``df`` should be the previous stage's result (any table for the first)."""
        began = time.perf_counter()
        out = build(df)
        seen = Observation()
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(out.columns)]
        written = materialize(out.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls))
        found = seen.get  # the metrics of the finished write
        first = self.rows is None
        before = [] if first else self.columns
        created = [c for c in out.columns if c not in before]
        dropped = [c for c in before if c not in out.columns]
        position = len(self.stages)
        finished = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
        self.stages.append((name, position, self.rows, found["rows"], None if first else self.rows - found["rows"], None if first else len(before), len(out.columns), created, dropped, time.perf_counter() - began, finished))
        self.null_counts += [(name, position, c, found[f"n{i}"], found["rows"], c in created) for i, c in enumerate(out.columns)]
        self.rows, self.columns = found["rows"], out.columns
        return written

    def table(self) -> DataFrame:
        """One row per stage: rows before, after and removed, columns before, after, created and dropped, seconds, time (UTC)."""
        return self.spark.createDataFrame(self.stages, STAGES)

    def nulls(self, created_only: bool = False, digits: int = 2) -> DataFrame:
        """AGG-19 / FLT-06: columns of a stage with NULLs (of the columns it created), their count and percentage; none with 0."""
        out = self.spark.createDataFrame(self.null_counts, NULLS).where("nulls > 0")
        out = out.where("created") if created_only else out
        return out.select("stage", "position", "column_name", "nulls", "rows", F.round(F.col("nulls") / F.col("rows") * 100, digits).alias("pct"))
