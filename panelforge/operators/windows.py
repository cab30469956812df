"""Per-entity lag, rolling and delta features (WIN-01..06, POL-02, POL-07, POL-10).

Semantics are row-offset: ``lag(k)`` is the value k rows earlier in the
entity's series ordered by time (NULL time last), not k calendar days earlier.
Rolling frames look at the previous ``n`` rows and exclude the current one;
partial frames are allowed and NULLs are skipped.

Scale: a plain ``partitionBy(entity)`` sends a whole entity to one task, which
breaks when one entity holds a large share of the rows. Here rows are range
partitioned and sorted once by (entity, time, key), so an entity lies over as many
partitions as it needs. What a partition lacks are the ``reach`` (longest look-back)
rows before its first one: a small table of the last ``reach`` rows of every
partition gives each its *carry*. Each partition is then read as a stream; a feature is
computed for a whole Arrow batch at a time from shifted views of the carry and
the batch, and the last ``reach`` rows go on as the carry of the next batch.

So the source is read once and shuffled once, and memory is a batch plus
``reach`` rows. The sorted rows are a reliable checkpoint: that fixes the
partitions, which the carry belongs to, also when executors are lost. The carry
table has at most (partitions x reach) rows of the columns used and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fix_partitions

NULL_CHUNK = 2_147_483_647  # chunk id of rows with a NULL time: after every real chunk


def safe_name(col: str) -> str:
    """Column name without dots (``PM2.5`` -> ``PM25``), used for feature names."""
    return col.replace(".", "")


def qcol(name: str) -> Column:
    """Column reference that accepts dotted names literally."""
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Feature:
    """One window feature: ``kind`` in lag, mean, std, max, min, median, change, lead."""

    name: str
    kind: str
    source: str
    n: int = 1

    @property
    def reach(self) -> int:
        if self.kind in ("lag", "mean", "std", "max", "min"):
            return self.n
        if self.kind == "median":
            return self.n - 1  # frame includes the current row
        if self.kind == "change":
            return 1
        return 0

    def expr(self, w) -> Column:
        c = qcol(self.source)
        if self.kind == "lag":
            return F.lag(c, self.n).over(w)
        if self.kind == "change":
            return c - F.lag(c, 1).over(w)
        if self.kind == "median":
            return F.percentile(c, F.lit(0.5)).over(w.rowsBetween(-(self.n - 1), 0))
        frame = w.rowsBetween(-self.n, -1)
        fn = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}[self.kind]
        return fn(c).over(frame)


def lag_features(spec_lags: dict[str, list[int]]) -> list[Feature]:
    return [Feature(f"{safe_name(c)}_lag_{k}", "lag", c, k) for c, ks in spec_lags.items() for k in ks]


def rolling_features(col: str, means=(3, 7), stats_n: int | None = 7,
                     stats=("std", "max", "min")) -> list[Feature]:
    out = [Feature(f"{safe_name(col)}_roll_mean_{n}", "mean", col, n) for n in means]
    if stats_n:
        out += [Feature(f"{safe_name(col)}_roll_{s}_{stats_n}", s, col, stats_n) for s in stats]
    return out


def change_features(cols) -> list[Feature]:
    return [Feature(f"{safe_name(c)}_change", "change", c) for c in cols]


def _order(order_cols: list[str]) -> list[Column]:
    return [qcol(order_cols[0]).asc_nulls_last()] + [qcol(c).asc_nulls_last() for c in order_cols[1:]]


def _chunk_expr(time_col: str, chunk_days: int) -> Column:
    day = qcol(time_col).cast("date")
    idx = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / F.lit(chunk_days)).cast("int")
    return F.coalesce(idx, F.lit(NULL_CHUNK))


def window_features(df: DataFrame, entity: str, order_cols: list[str], features: list[Feature]) -> DataFrame:
    """The same features as plain Spark windows: an entity is one task. For small panels and as the definition."""
    w = Window.partitionBy(qcol(entity)).orderBy(*_order(order_cols))
    return df.select(*[qcol(c) for c in df.columns], *[f.expr(w).alias(f.name) for f in features])


class _Views:
    """Shifted views of one column over a batch: the value ``k`` rows back in the same entity."""

    def __init__(self, column: pa.Array, carried: int, place: np.ndarray):
        self.column, self.carried, self.place = column, carried, place
        self.floating = pa.types.is_floating(column.type)
        self.valid = column.is_valid().to_numpy(zero_copy_only=False)
        number = column.type if pa.types.is_floating(column.type) else pa.float64()
        self.values = None
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type) or pa.types.is_decimal(column.type):
            self.values = column.cast(number, safe=False).fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)

    def rows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the rows ``k`` back, and where there is one."""
        there = self.place >= k
        return np.where(there, np.arange(len(self.place)) + self.carried - k, 0), there

    def lag(self, k: int) -> pa.Array:
        index, there = self.rows(k)
        return self.column.take(pa.array(index, mask=~there))

    def number(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none) and where there is a non-null one."""
        index, there = self.rows(k)
        there = there & self.valid[index]
        return np.where(there, self.values[index], 0.0), there

    def mean(self, n: int) -> pa.Array:
        total, count = np.zeros(len(self.place)), np.zeros(len(self.place), dtype=np.int64)
        for k in range(n, 0, -1):
            x, there = self.number(k)
            total += x
            count += there
        return pa.array(total / np.maximum(count, 1), mask=count == 0)

    def std(self, n: int) -> pa.Array:
        mean, squares, count = np.zeros(len(self.place)), np.zeros(len(self.place)), np.zeros(len(self.place))
        for k in range(n, 0, -1):  # running moments, from the oldest row
            x, there = self.number(k)
            count += there
            off = np.where(there, x - mean, 0.0)
            step = off / np.maximum(count, 1)
            mean += step
            squares += off * (off - step)
        return pa.array(np.sqrt(squares / np.maximum(count - 1, 1)), mask=count < 2)

    def extreme(self, n: int, largest: bool) -> pa.Array:
        if not self.floating:
            views = [self.lag(k) for k in range(n, 0, -1)]
            return (pc.max_element_wise if largest else pc.min_element_wise)(*views)
        best, some = np.zeros(len(self.place)), np.zeros(len(self.place), dtype=bool)
        for k in range(n, 0, -1):  # NaN is the largest number
            x, there = self.number(k)
            better = (x > best) | (np.isnan(x) & ~np.isnan(best)) if largest else (x < best) | (np.isnan(best) & ~np.isnan(x))
            best = np.where(there & (~some | better), x, best)
            some |= there
        return pa.array(best, mask=~some).cast(self.column.type)

    def median(self, n: int) -> pa.Array:
        views = [self.number(k) for k in range(n)]
        count = sum(there.astype(np.int64) for _, there in views)
        ordered = np.sort(np.stack([np.where(there, x, np.nan) for x, there in views]), axis=0)  # those that are not there come last
        at = np.arange(len(self.place))
        low, high = np.maximum(count - 1, 0) // 2, np.minimum(count // 2, n - 1)
        a, b = ordered[low, at], ordered[high, at]
        return pa.array(0.5 * a + 0.5 * b, mask=count == 0)

    def feature(self, f: Feature) -> pa.Array:
        if f.kind == "lag":
            return self.lag(f.n)
        if f.kind == "change":
            return pc.subtract(self.column.slice(self.carried), self.lag(1))
        if f.kind == "median":
            return self.median(f.n)
        if f.kind in ("max", "min"):
            return self.extreme(f.n, f.kind == "max")
        return self.mean(f.n) if f.kind == "mean" else self.std(f.n)


def _places(entity: pa.Array, carried: int) -> np.ndarray:
    """Rows of the same entity before each row behind the carried ones, as far as carried rows tell."""
    before, here = entity.slice(0, len(entity) - 1), entity.slice(1)
    same = pc.equal(here, before).fill_null(False)
    same = pc.or_(same, pc.and_(here.is_null(nan_is_null=True), before.is_null(nan_is_null=True)))
    at = np.arange(len(entity))
    start = np.maximum.accumulate(np.where(np.append(False, same.to_numpy(zero_copy_only=False)), 0, at))
    return (at - start)[carried:]


def _joined(first: pa.Array, second: pa.Array) -> pa.Array:
    return pa.concat_arrays([first.cast(second.type), second]) if len(first) else second


def _carries(ranged: DataFrame, entity: str, sources: list[str], reach: int) -> dict[int, pa.Table]:
    """Of each partition with rows: the last ``reach`` rows before it (entity and source columns)."""
    named = ranged.select(qcol(entity).alias("_e"), *[qcol(c).alias(f"_s{i}") for i, c in enumerate(sources)])
    schema = T.StructType([T.StructField("_p", T.IntegerType()), T.StructField("_i", T.IntegerType()), *named.schema.fields])

    def last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            own = pa.Table.from_batches([pa.RecordBatch.from_arrays(b.columns, names=b.schema.names)])
            held = own if held is None else pa.concat_tables([held, own])
            held = held.slice(max(0, held.num_rows - reach))
        if held is not None and held.num_rows:
            n, held = held.num_rows, held.combine_chunks()
            p = pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([p, pa.array(np.arange(n, dtype=np.int32)), *[c.chunk(0) for c in held.columns]], names=schema.names)

    tails = named.mapInArrow(last_rows, schema).toArrow().sort_by([("_p", "ascending"), ("_i", "ascending")])
    out, recent = {}, tails.select(named.columns).slice(0, 0)
    parts = tails.column("_p").to_numpy()
    first = np.flatnonzero(np.append(len(parts) > 0, parts[1:] != parts[:-1]))
    for a, b in zip(first, np.append(first[1:], len(parts)), strict=False):
        out[int(parts[a])] = recent
        recent = pa.concat_tables([recent, tails.select(named.columns).slice(a, b - a)])
        recent = recent.slice(max(0, recent.num_rows - reach)).combine_chunks()
    return out


def add_window_features(df: DataFrame, entity: str, order_cols: list[str], features: list[Feature],
                        partitions: int | None = None) -> DataFrame:
    """Append ``features`` to ``df``; see the module docstring for the plan.

    ``order_cols`` must make the order within an entity total (time first).
    ``partitions`` is the number of ranges (the session's shuffle partitions by default).
    """
    if not features:
        return df
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    reach = max(f.reach for f in features)
    sources = list(dict.fromkeys(f.source for f in features))
    keys = [qcol(entity).asc_nulls_first(), *_order(order_cols)]
    ranged = fix_partitions(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    carries = spark.sparkContext.broadcast(_carries(ranged, entity, sources, reach) if reach else {})

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = window_features(df, entity, order_cols, features).schema
    arrow = to_arrow_schema(schema)
    entity_at, source_at = df.columns.index(entity), [df.columns.index(c) for c in sources]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for b in batches:
            if not b.num_rows:
                continue
            own = [b.column(entity_at), *[b.column(i) for i in source_at]]
            if carry is None:
                start = carries.value.get(TaskContext.get().partitionId())
                carry = [c.chunk(0) for c in start.columns] if start is not None and start.num_rows else [x.slice(0, 0) for x in own]
            carried = len(carry[0])
            both = [_joined(x, y) for x, y in zip(carry, own, strict=True)]
            place = _places(both[0], carried)
            views = {c: _Views(x, carried, place) for c, x in zip(sources, both[1:], strict=True)}
            made = [views[f.source].feature(f) for f in features]
            columns = [x if x.type == t.type else x.cast(t.type) for x, t in zip([*b.columns, *made], arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            carry = [x.slice(max(0, len(x) - reach)) for x in both]

    return ranged.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)  # names may have dots


# ---------------------------------------------------------------------------
# Preset feature blocks
# ---------------------------------------------------------------------------

def standard_features(target: str, channel_lags: dict[str, list[int]] | None = None,
                      change_cols: list[str] | None = None, target_lags=(1, 2, 3, 7)) -> list[Feature]:
    """The feature block of the reference pipeline, generalised by column name."""
    lags = {target: list(target_lags)}
    lags.update(channel_lags or {})
    feats = lag_features(lags) + rolling_features(target)
    feats += change_features(change_cols if change_cols is not None else [target])
    return feats


def threshold_crossings(df: DataFrame, entity: str, order_cols: list[str], col: str, limit: float,
                        partitions: int | None = None) -> DataFrame:
    """POL-10: rows where ``col`` crosses ``limit`` upwards (value >= limit, previous < limit)."""
    out = add_window_features(df, entity, order_cols, [Feature("_prev", "lag", col, 1)], partitions)
    return out.where((qcol(col) >= limit) & (F.col("_prev") < limit)).withColumnRenamed("_prev", f"{safe_name(col)}_prev")
