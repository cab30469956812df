"""Station payload ingest (SRC-09, SRC-10, SET-06).

Landed JSON documents ``{"city": ..., "results": [station, ...]}`` are parsed
with an explicit schema, exploded to one row per station, and the sensor list
is reduced with higher-order functions (lower-cased parameter name, last
non-NULL reading per name wins, rounded to 2 dp). The same function serves
batch (``spark.read.json``) and stream (``readStream.json``) sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import category, first_present, subindex

SENSOR = T.StructType([
    T.StructField("parameter", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("latest", T.StructType([T.StructField("value", T.DoubleType())])),
])
STATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("coordinates", T.StructType([
        T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    ])),
    T.StructField("datetimeLast", T.StructType([T.StructField("local", T.StringType())])),
    T.StructField("sensors", T.ArrayType(SENSOR)),
])
PAYLOAD = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("results", T.ArrayType(STATION)),
])

READING_COLUMNS = [
    ("city", "string"), ("station", "string"), ("country", "string"), ("latitude", "double"),
    ("longitude", "double"), ("last_updated", "string"), ("pm25", "double"), ("pm10", "double"),
    ("no2", "double"), ("so2", "double"), ("co", "double"), ("o3", "double"),
    ("calculated_aqi", "int"), ("aqi_category", "string"),
]


def sensor_value(sensors: Column, name: str) -> Column:
    """Reading of one parameter: the last sensor with that lower-cased name and a
    non-NULL value, rounded to 2 dp."""
    hits = F.filter(sensors, lambda s: (F.lower(s["parameter"]["name"]) == F.lit(name)) & s["latest"]["value"].isNotNull())
    return F.round(F.try_element_at(hits, F.lit(-1))["latest"]["value"], 2)


def stations_from_payload(docs: DataFrame, json_col: str | None = "value", zero_is_missing: bool = True,
                          gaps: str = "reference") -> DataFrame:
    """SRC-09: one reading row per station. ``docs`` holds either the parsed payload
    columns (``city``, ``results``) or a JSON text column ``json_col``."""
    if json_col is not None and json_col in docs.columns:
        docs = docs.select(F.from_json(F.col(json_col), PAYLOAD).alias("p")).select("p.*")
    st = docs.select("city", F.explode("results").alias("s"))
    sensors = F.col("s.sensors")
    pm25 = first_present(sensor_value(sensors, "pm25"), sensor_value(sensors, "pm2.5"), zero_is_missing)
    out = st.select(
        "city",
        F.coalesce(F.col("s.name"), F.lit("Unknown Station")).alias("station"),
        F.coalesce(F.col("s.country.name"), F.lit("India")).alias("country"),
        F.col("s.coordinates.latitude").alias("latitude"),
        F.col("s.coordinates.longitude").alias("longitude"),
        F.coalesce(F.col("s.datetimeLast.local"), F.lit("N/A")).alias("last_updated"),
        pm25.alias("pm25"),
        *[sensor_value(sensors, p).alias(p) for p in ("pm10", "no2", "so2", "co", "o3")],
    )
    out = out.withColumn("calculated_aqi", subindex("pm25", gaps=gaps))
    return out.withColumn("aqi_category", category("calculated_aqi"))


def complete_cities(readings: DataFrame, expected: DataFrame, key: str = "city") -> DataFrame:
    """SRC-10 / SET-06: add a placeholder row for each expected city without readings."""
    missing = expected.select(key).join(readings.select(key).distinct(), key, "left_anti")
    placeholder = missing.select(
        key,
        F.lit("No Data").alias("station"),
        F.lit("India").alias("country"),
        F.lit("N/A").alias("last_updated"),
        F.lit("Unknown").alias("aqi_category"),
    )
    return readings.unionByName(placeholder, allowMissingColumns=True)
