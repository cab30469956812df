"""Features from a fixed-length history array (FN-12..14, FLT-07), all higher-order
functions on the array column -- no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(f"`{col}`") if isinstance(col, str) else col


def finite(arr: Column) -> Column:
    """FLT-07: drop NULL and NaN elements."""
    return F.filter(arr, lambda x: x.isNotNull() & ~F.isnan(x))


def from_end(arr, k: int) -> Column:
    """FN-12: element k positions from the end (k = 1 is the newest)."""
    return F.try_element_at(_c(arr), F.lit(-k))


def arr_mean(arr: Column) -> Column:
    n = F.size(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(n > 0, s / n)


def arr_std(arr: Column) -> Column:
    """Sample std (ddof = 1); NULL with fewer than 2 values."""
    n = F.size(arr)
    mean = arr_mean(arr)
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def history_features(hist, prefix: str = "AQI", digits: int = 6) -> dict[str, Column]:
    """FN-13: rolling statistics of a 7-long history (oldest first): mean of the last 3, and
    mean / std / max / min of all 7, over non-NULL values, rounded."""
    h = _c(hist)
    all7 = finite(h)
    last3 = finite(F.slice(h, -3, 3))
    return {
        f"{prefix}_roll_mean_3": F.round(arr_mean(last3), digits),
        f"{prefix}_roll_mean_7": F.round(arr_mean(all7), digits),
        f"{prefix}_roll_std_7": F.round(arr_std(all7), digits),
        f"{prefix}_roll_max_7": F.round(F.array_max(all7), digits),
        f"{prefix}_roll_min_7": F.round(F.array_min(all7), digits),
    }


def history_lags(hist, prefix: str = "AQI", lags=(1, 2, 3, 7)) -> dict[str, Column]:
    """FN-12: lag k of the target = element k from the end of the history."""
    return {f"{prefix}_lag_{k}": from_end(hist, k) for k in lags}
