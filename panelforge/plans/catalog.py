"""The query catalogue: every registered query and its DuckDB oracle."""

from __future__ import annotations

from . import q_bands, q_clean, q_impute, q_ledger, q_models, q_quality, q_rank, q_stream, q_windows  # noqa: F401  (registers queries)
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
