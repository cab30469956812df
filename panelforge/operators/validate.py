"""Schema and record validation (VAL-01..14).

Schema checks run on the driver against ``df.schema`` (no job). Record checks
produce one ``errors array<string>`` column per row so valid rows and the
quarantine are split with a filter, in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import parse_date
from ..spec import HISTORY_LEN, HISTORY_MAX


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, required) -> None:
    """VAL-01: raise listing every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"missing required columns: {missing}")


def require_rows(df: DataFrame, label: str = "table") -> None:
    """VAL-02: the table is non-empty (reads at most one row)."""
    if df.isEmpty():
        raise SchemaError(f"{label} is empty")


def require_date_type(df: DataFrame, col: str) -> None:
    """VAL-03."""
    if not isinstance(df.schema[col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise SchemaError(f"column {col} has type {df.schema[col].dataType.simpleString()}, not a date")


def column_set_diff(df: DataFrame, expected) -> tuple[list[str], list[str]]:
    """VAL-04: (missing, extra) column names."""
    have = set(df.columns)
    exp = list(expected)
    return [c for c in exp if c not in have], [c for c in df.columns if c not in set(exp)]


def require_same_schema(*dfs: DataFrame) -> None:
    """VAL-05: ordered schema equality (names and types)."""
    first = [(f.name, f.dataType) for f in dfs[0].schema.fields]
    for d in dfs[1:]:
        if [(f.name, f.dataType) for f in d.schema.fields] != first:
            raise SchemaError("schemas differ between frames")


def residual_nulls(df: DataFrame, cols) -> DataFrame:
    """VAL-06: NULL count per column after imputation (one pass)."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def check_weights(weights: dict[str, float], tol: float = 1e-9) -> None:
    """VAL-08."""
    if abs(sum(weights.values()) - 1.0) > tol:
        raise ValueError(f"weights sum to {sum(weights.values())}, not 1")


def _code(cond: Column, code: str) -> Column:
    return F.when(cond, F.lit(code))


def request_errors(city: Column, date: Column, pollutants: Column, required_keys, history: Column,
                   scalars: dict[str, Column], hist_len: int = HISTORY_LEN, hist_max: float = HISTORY_MAX) -> Column:
    """VAL-07: every failed rule of a request record as an error code.

    pollutants is a map<string,double>; a key must be present (its value may be NULL).
    """
    codes = [
        _code(city.isNull() | (F.trim(city) == ""), "city_blank"),
        _code(date.isNull() | parse_date(date).isNull(), "date_invalid"),
        _code(pollutants.isNull(), "pollutants_missing"),
    ]
    for k in required_keys:
        codes.append(_code(~F.coalesce(F.map_contains_key(pollutants, F.lit(k)), F.lit(False)), f"missing_key:{k}"))
        v = F.try_element_at(pollutants, F.lit(k))
        codes.append(_code(v < 0, f"negative:{k}"))
    codes += [
        _code(history.isNull() | (F.size(history) != hist_len), "history_length"),
        _code(F.exists(history, lambda x: x < 0), "history_negative"),
        _code(F.exists(history, lambda x: x > hist_max), "history_above_max"),
    ]
    for name, c in scalars.items():
        codes.append(_code(c < 0, f"negative:{name}"))
    return F.filter(F.array(*codes), lambda x: x.isNotNull())


def split_valid(df: DataFrame, errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Route rows: (valid, quarantine)."""
    return df.where(F.size(errors_col) == 0), df.where(F.size(errors_col) > 0)
