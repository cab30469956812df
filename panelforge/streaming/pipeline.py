"""Structured Streaming re-aim of the live parts (STR-01..04).

* STR-01 ``station_stream``: landed station JSON -> reading rows; event time from the
  station's last update; watermark + ``dropDuplicatesWithinWatermark``.
* STR-02 ``daily_aggregates``: tumbling 1-day windows per city with a watermark;
  ``daily_sensor_aggregates`` has a row per sensor as well.
* STR-03 ``stateful_features``: lag / rolling features per entity with ``transformWithStateInPandas``
  (``lag()`` is not allowed on streams). Rows wait in state until the watermark has passed
  their day, then an event-time timer emits them in the order of time, all that are due
  at once; rows that come too late go to a side output, and the state of an entity that
  falls silent expires. One operator, several outputs, told apart by ``kind``.
* STR-04 ``score_stream``: the batch scoring function in ``foreachBatch`` around an exactly-once sink.

All sinks and checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..session import checkpoint_dir
from ..sources.sinks import BatchSink
from ..sources.stations import PAYLOAD, stations_from_payload

#: The sensors of a reading row.
SENSORS = ("pm25", "pm10", "no2", "so2", "co", "o3")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return f"{base.rstrip('/')}/panelforge-{name}-{uuid.uuid4().hex}"


def _reports(spark: SparkSession, path: str, gaps: str) -> DataFrame:
    rows = stations_from_payload(spark.readStream.schema(PAYLOAD).json(path), json_col=None, gaps=gaps)
    return rows.withColumn("ts", F.to_timestamp("last_updated"))


def station_stream(spark: SparkSession, path: str, watermark: str = "1 day", gaps: str = "reference") -> DataFrame:
    """STR-01: file stream of landed payload documents (one JSON document per line), a row per report.

    A report that is delivered again is dropped; reports of one station and time that
    carry other readings are rows of their own.
    """
    return _reports(spark, path, gaps).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["city", "station", "last_updated", *SENSORS])


def sensor_stream(spark: SparkSession, path: str, watermark: str = "1 day", sensors=SENSORS) -> DataFrame:
    """STR-01, a row per reading: city, station, ts, sensor, value; one per (station, time, sensor)."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(s).alias("value")) for s in sensors]))
    rows = _reports(spark, path, "reference").select("city", "station", "ts", each.alias("r")).select("city", "station", "ts", "r.sensor", "r.value")
    return rows.where("value is not null").withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["city", "station", "ts", "sensor"])


def daily_aggregates(readings: DataFrame, entity: str = "city", value: str = "pm25") -> DataFrame:
    """STR-02 (AGG-14 per day): readings, rounded mean and max per entity and day."""
    return readings.groupBy(F.window("ts", "1 day").alias("w"), entity).agg(
        F.count(value).alias("readings"), F.round(F.avg(value), 1).alias("mean"), F.round(F.max(value), 1).alias("max")
    ).select(entity, F.col("w.start").cast("date").alias("day"), "readings", "mean", "max")


def daily_sensor_aggregates(readings: DataFrame, entity: str = "city", digits: int = 1) -> DataFrame:
    """STR-02 per sensor, of a ``sensor_stream``: readings, rounded mean and max per entity, day and sensor."""
    return readings.groupBy(F.window("ts", "1 day").alias("w"), entity, "sensor").agg(
        F.count("value").alias("readings"), F.round(F.avg("value"), digits).alias("mean"), F.round(F.max("value"), digits).alias("max")
    ).select(entity, F.col("w.start").cast("date").alias("day"), "sensor", "readings", "mean", "max")


def run_available_now(df: DataFrame, out_path: str, ckpt: str, mode: str = "append", batch_fn=None) -> None:
    """Run a stream over everything available, then stop (batch-like runs, tests)."""
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if batch_fn is not None:
        q = w.outputMode(mode).foreachBatch(batch_fn).start()
    else:
        q = w.outputMode(mode).format("parquet").option("path", out_path).start()
    q.awaitTermination()


def latest_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of update-mode rows with their batch id (``_batch``): the last one per key."""
    cols = [c for c in rows.columns if c not in key and c != "_batch"]
    g = rows.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("_l"))
    return g.select(*key, "_l.*")


# ---------------------------------------------------------------------------
# STR-03: stateful lag / rolling features
# ---------------------------------------------------------------------------

#: The store that keeps timers and several state variables of one operator.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
_EPOCH = dt.date(1970, 1, 1)


def feature_names(target: str, lags=(1, 2, 3, 7), n: int = 7) -> list[str]:
    return [f"{target}_lag_{k}" for k in lags] + [f"{target}_roll_{s}" for s in ("mean_3", f"mean_{n}", f"std_{n}", f"max_{n}", f"min_{n}")]


def feature_schema(entity_type: T.DataType, target: str, lags=(1, 2, 3, 7), n: int = 7) -> T.StructType:
    fields = [T.StructField("kind", T.StringType()), T.StructField("entity", entity_type), T.StructField("day", T.DateType()), T.StructField(target, T.DoubleType())]
    return T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in feature_names(target, lags, n)])


def series_features(values: np.ndarray, start: int, lags, n: int) -> np.ndarray:
    """Features (columns as in ``feature_names``) of ``values[start:]``; what stands before is history, NaN is NULL."""
    size = len(values) - start
    before = np.full((n, size), np.nan)  # row k: the value k + 1 rows earlier
    for k in range(1, n + 1):
        at = np.arange(start, len(values)) - k
        before[k - 1] = np.where(at >= 0, values[np.maximum(at, 0)], np.nan)
    there = ~np.isnan(before)

    def mean(m):
        count = there[:m].sum(axis=0)
        return np.where(count > 0, np.where(there[:m], before[:m], 0).sum(axis=0) / np.maximum(count, 1), np.nan)

    count, centre = there.sum(axis=0), mean(n)
    spread = np.sqrt(np.where(there, (before - centre) ** 2, 0).sum(axis=0) / np.maximum(count - 1, 1))
    high = np.where(there, before, -np.inf).max(axis=0)
    low = np.where(there, before, np.inf).min(axis=0)
    some = count > 0
    columns = [before[k - 1] for k in lags] + [mean(3), centre, np.where(count > 1, spread, np.nan), np.where(some, high, np.nan), np.where(some, low, np.nan)]
    return np.column_stack(columns)


class SeriesFeatures(StatefulProcessor):
    """State of one entity: the last ``n`` values and day that went out, and the rows that wait for the watermark."""

    def __init__(self, target: str, lags, n: int, expire_days: int | None, columns: list[str]):
        self.target, self.lags, self.n, self.expire_days, self.columns = target, tuple(lags), n, expire_days, columns

    def init(self, handle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", "history array<double>, last date")
        self.waiting = handle.getListState("waiting", "day date, value double")

    def close(self) -> None:
        pass

    def _frame(self, key, kind: str, days: list, values, features: np.ndarray | None = None) -> pd.DataFrame:
        made = np.full((len(days), len(self.columns) - 4), np.nan) if features is None else features
        frame = pd.DataFrame(made, columns=self.columns[4:])
        for at, (name, x) in enumerate([("kind", kind), ("entity", key[0]), ("day", days), (self.target, values)]):
            frame.insert(at, name, x)
        return frame

    def _wake(self, day: dt.date, after: int = 1) -> None:
        self.handle.registerTimer(((day - _EPOCH).days + after) * DAY_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.sent.get()[1] if self.sent.exists() else None
        waiting = dict(self.waiting.get()) if self.waiting.exists() else {}
        late_days, late_values, fresh = [], [], False
        for part in rows:
            for day, value in zip(part["day"], part[self.target], strict=True):
                if (last is not None and day <= last) or day in waiting:
                    late_days.append(day)
                    late_values.append(value)
                else:
                    waiting[day], fresh = (None if pd.isna(value) else float(value)), True
        if fresh:
            self.waiting.put(sorted(waiting.items()))
            self._wake(min(waiting))
        if late_days:
            yield self._frame(key, "late", late_days, late_values)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // DAY_MS  # days before this one are complete
        history, last = self.sent.get() if self.sent.exists() else ([], None)
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        due = [r for r in rows if (r[0] - _EPOCH).days < passed]
        rest = rows[len(due):]  # they wait in the order of time
        if due:
            values = np.array([np.nan if x is None else x for x in [*history, *[v for _, v in due]]], dtype=float)
            made = series_features(values, len(history), self.lags, self.n)
            history = [None if np.isnan(x) else float(x) for x in values[-self.n:]]
            last = due[-1][0]
            self.sent.update((history, last))
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
                if self.expire_days is not None:
                    self._wake(last, self.expire_days)
            yield self._frame(key, "features", [d for d, _ in due], [v for _, v in due], made)
        elif not rest and last is not None and self.expire_days is not None and passed >= (last - _EPOCH).days + self.expire_days:
            self.sent.clear()
            yield self._frame(key, "expired", [last], [np.nan])
        if rest:
            self._wake(rest[0][0])


def stateful_features(stream: DataFrame, entity: str, day: str, target: str, lags=(1, 2, 3, 7), n: int = 7,
                      watermark: str = "7 days", expire_days: int | None = None) -> DataFrame:
    """STR-03: rows of several outputs, by ``kind``.

    ``features``: every row once, in the order of time per entity, with lags and rolling features of the rows before it,
    as soon as the watermark (greatest day seen, less ``watermark``) has passed its day. ``late``: rows whose day has gone
    out already, and second rows of a day, as they came. ``expired``: entities whose state was dropped because
    ``expire_days`` had passed since their last row (None: never). No row is left out: those not due yet wait in state.
    Rows without an entity only move the watermark.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    schema = feature_schema(stream.schema[entity].dataType, target, lags, n)
    src = stream.select(F.col(entity).alias("entity"), F.col(day).alias("day"), F.col(target).cast("double").alias(target), F.col(day).cast("timestamp").alias("_ts"))
    # the watermark's column goes after this: late rows must reach the operator, not be dropped before it
    src = src.withWatermark("_ts", watermark).where(F.col("entity").isNotNull() | F.col("_ts").isNull()).select("entity", "day", target)
    return src.groupBy("entity").transformWithStateInPandas(SeriesFeatures(target, lags, n, expire_days, schema.names), schema, "Append", "EventTime")


def score_stream(requests_stream: DataFrame, score_fn, out_path: str, ckpt: str) -> BatchSink:
    """STR-04: every micro-batch through the batch scoring function, exactly once, into a sink that is read with its ``read``."""
    sink = BatchSink(requests_stream.sparkSession, out_path)
    run_available_now(requests_stream, out_path, ckpt, "append", sink.foreach_batch(score_fn))
    return sink
