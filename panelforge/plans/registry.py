"""Registry of catalogue queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query; ``sql`` is its DuckDB oracle (None = rows-only check)."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle hygiene: both sides round the same way)."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
