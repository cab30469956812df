"""FIXTURES bad_requests (VAL-07) and split_edges (SET-04, Q16)."""

import datetime as dt

from pyspark.sql import functions as F

from panelforge.operators import split as SP
from panelforge.operators import validate as V


def test_bad_requests(spark):
    rows = [
        ("Delhi", "2024-01-05", {"pm25": 10.0, "co": 1.0}, [1.0] * 7),  # valid
        ("  ", "2024-01-05", {"pm25": 10.0, "co": 1.0}, [1.0] * 7),  # blank city
        ("Delhi", "2024-13-01", {"pm25": -1.0, "co": 1.0}, [1.0] * 7),  # bad date, negative value
        ("Delhi", "2024-01-05", {"pm25": 10.0, "co": 1.0}, [1.0] * 6),  # 6-long history
        ("Delhi", "2024-01-05", {"pm25": 10.0, "co": 1.0}, [1.0] * 6 + [1001.0]),  # above ceiling
        ("Delhi", "2024-01-05", {"pm25": 10.0}, [None] * 7),  # missing key; NULL history values allowed
    ]
    df = spark.createDataFrame(rows, "city string, date string, p map<string,double>, h array<double>")
    errs = V.request_errors(F.col("city"), F.col("date"), F.col("p"), ["pm25", "co"], F.col("h"), {})
    got = [r[0] for r in df.select(F.array_join(errs, ",")).collect()]
    assert got == ["", "city_blank", "date_invalid,negative:pm25", "history_length", "history_above_max",
                   "missing_key:co"]
    valid, bad = V.split_valid(df.withColumn("errors", errs))
    assert valid.count() == 1 and bad.count() == 5


def test_split_edges_inclusive_and_counted(spark):
    days = ["2018-12-31", "2019-01-01", "2019-12-31", "2020-01-01", "2020-07-31", "2020-08-01", None]
    df = spark.createDataFrame([(d and dt.date.fromisoformat(d),) for d in days], "d date")
    cut = ("2018-12-31", "2019-12-31", "2020-07-31")
    kept = SP.chronological_split(df, "d", cut, keep_unassigned=True).orderBy(F.col("d").asc_nulls_last())
    assert [r.split for r in kept.collect()] == ["train", "validation", "validation", "test", "test", None, None]
    assert SP.chronological_split(df, "d", cut).count() == 5  # after the last cutoff / NULL: dropped
    report = SP.missing_by_split(SP.chronological_split(df.withColumn("x", F.lit(None).cast("double")), "d", cut),
                                 ["x"]).first()
    assert (report.train_missing, report.valid_missing, report.test_missing) == (1, 2, 2)
    assert report.train_pct == 100.0


def test_period_edges_and_bad_dates(spark):
    from panelforge.functions import calendar as C
    from panelforge.operators import quality as Q

    raw = ["2020-02-29", "2020-03-01", "2020-07-31", "2020-08-01", "2020-13-01", "", None]
    df = spark.createDataFrame([(r,) for r in raw], "raw string").withColumn("d", C.parse_date("raw"))
    out = C.add_calendar(df, "d", names=("Y", "M", "DD", "DOW", "WK")).collect()
    assert [r.is_lockdown for r in out] == [0, 1, 1, 0, 0, 0, 0]
    assert [r.WK for r in out][4:] == [0, 0, 0] and [r.M for r in out][4:] == [None, None, None]
    assert out[0].DOW == 5 and out[0].WK == 1 and out[0].Season == "Winter"  # 2020-02-29 is a Saturday
    rng = Q.date_range(df, "raw").first()
    assert rng.invalid_dates == 2 and rng.span_days == 154  # '' and '2020-13-01'; NULL is not counted


def test_constant_channel_and_duplicates(spark):
    from panelforge.functions import index as IDX
    from panelforge.operators import clean as CL
    from panelforge.operators import rank as R

    df = spark.createDataFrame([(1, 10.0, 3.0), (2, 20.0, 3.0), (3, 30.0, 3.0), (4, None, 3.0)],
                               "id int, a double, c double")
    out = {r.id: r.idx for r in IDX.composite_index(df, {"a": 0.5, "c": 0.5}, name="idx").collect()}
    assert out == {1: 0.0, 2: 0.25, 3: 0.5, 4: None}  # constant channel contributes 0; NULL nulls the index
    norm = {r.id: r.norm_c for r in R.minmax_normalise(df, {"c": True}).collect()}
    assert set(norm.values()) == {0.5}

    dups = spark.createDataFrame([("x", 1, None), ("x", 1, None), ("x", 1, 2.0), ("y", 2, 1.0)],
                                 "e string, d int, v double")
    assert CL.remove_exact_duplicates(dups).count() == 3  # NULL equals NULL for exact duplicates
    assert CL.duplicate_count(dups).first().duplicate_rows == 1
