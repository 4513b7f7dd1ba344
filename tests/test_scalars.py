from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from loomline.functions import casting, cleaning, dates, naming


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_standardize_machine(spark):
    raw = [None, "", " 7 ", "wev7", "WEV0012", "1234", "m-3", "100.0", "abc", "0007", "7\n"]
    got = values(spark, cleaning.standardize_machine, raw)
    assert got == [None, None, "WEV007", "WEV007", "WEV0012", "WEV1234", "M-3", "WEV100", "ABC", "WEV007", "7\n"]


def test_long_machine_ids_stay_whole(spark):
    raw = ["1000", "1001.0", "wev12345", "0007", "000", "9" * 45, "m-1234", "WEV" + "8" * 70]
    assert values(spark, cleaning.standardize_machine, raw) == [
        "WEV1000", "WEV1001", "WEV12345", "WEV007", "WEV000", "WEV" + "9" * 45, "M-1234", "WEV" + "8" * 70
    ]


def test_standardize_machine_variants(spark):
    assert values(spark, lambda c: cleaning.standardize_machine(c, decimals=False), ["100.0", "9"]) == ["100.0", "WEV009"]
    assert values(spark, lambda c: cleaning.standardize_machine(c, prefixed=False), ["wev7", "7.0"]) == ["WEV7", "WEV007"]


def test_clean_machine_no(spark):
    assert values(spark, cleaning.clean_machine_no, ["12.0", " 5 ", "", None, "1.05"]) == ["12", "5", None, None, "1.05"]


def test_casts(spark):
    assert values(spark, casting.to_bigint, ["100.5", "-100.5", " 5 ", "1e3", "abc", "", None]) == [101, -101, 5, 1000, None, None, None]
    numbers = values(spark, casting.to_double, [" 5 ", "1e3", "1d", "2F", "0x1p3", "inf", "", None])
    assert numbers == [5.0, 1000.0, None, None, None, float("inf"), None, None]
    stamps = values(spark, casting.to_timestamp, [
        "2026", "45000", "2026-7-1", "07/01/2026", "2026/07/01", "2026-07-01 10:00:00+07:00", "2026-02-30", "2026-07-01 10", " 2026-07-01",
    ])
    day = dt.datetime(2026, 7, 1)
    assert stamps == [None, None, day, None, day, day.replace(hour=10), None, None, None]


def test_epoch_guard(spark):
    got = values(spark, lambda c: casting.drop_epoch(casting.to_timestamp(c)), ["1970-01-01", "1970-01-02", "1970-01-02 00:00:01"])
    assert got == [None, None, dt.datetime(1970, 1, 2, 0, 0, 1)]


def test_production_date_crosses_new_year(spark):
    rows = [("1월 5일", "s", 12), ("12월5일", "s", 1), ("2월 30일", "s", 2), ("2024-01-09", "d", 12), ("2024-01-09", "s", 1), (None, "s", 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, h string, k string, m int").orderBy("i")
    got = [r[0] for r in df.select(dates.production_date(F.col("h"), F.col("k"), F.lit(2024), F.col("m"))).collect()]
    assert got == [dt.date(2025, 1, 5), dt.date(2023, 12, 5), None, dt.date(2025, 1, 9), None, None]


def test_shutdown_overlap_by_hand(spark):
    def seconds(text):
        return int((dt.datetime.fromisoformat(text) - dt.datetime(1970, 1, 1)).total_seconds())

    cases = [  # 2024-01-07 is a Sunday
        ("2024-01-07T00:00:00", "2024-01-08T00:00:00", 18.5), ("2024-01-07T05:00:00", "2024-01-07T06:00:00", 0.5),
        ("2024-01-08T00:00:00", "2024-01-09T00:00:00", 6.5), ("2024-01-08T06:00:00", "2024-01-08T07:00:00", 0.5),
        ("2024-01-08T07:00:00", "2024-01-08T09:00:00", 0.0), ("2024-01-09T00:00:00", "2024-01-10T00:00:00", 0.0),
        ("2024-01-06T00:00:00", "2024-01-07T00:00:00", 0.0),
    ]
    df = spark.createDataFrame([(i, seconds(a), seconds(b)) for i, (a, b, _) in enumerate(cases)], "i int, a bigint, b bigint")
    got = [r[0] / 3600 for r in df.orderBy("i").select(dates.shutdown_overlap(F.col("a"), F.col("b"))).collect()]
    assert got == [c[2] for c in cases]


def test_local_date(spark):
    df = spark.sql("select timestamp_ntz'2026-07-29 12:30:00' a, timestamp_ntz'2026-07-31 00:45:00' b, timestamp_ntz'2026-07-31 18:00:00' c")
    row = df.select(*[dates.local_date(F.col(c)) for c in "abc"]).collect()[0]
    assert list(row) == [dt.date(2026, 7, 29), dt.date(2026, 7, 31), dt.date(2026, 8, 1)]


def test_header_names(spark):
    rows = [(["Date", "Unnamed: 1_level_1"],), (["Production (QTY)", "Kgs."],), (["Lot", "C"],), (["C"],), ([None, " "],), (["a / b - c#", None],)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p array<string>").orderBy("i")
    got = [r[0] for r in df.select(naming.header_name(F.col("p"))).collect()]
    assert got == ["date", "production_qty_kgs", "lot", "c", "unnamed", "a_b_c"]


def test_match_columns():
    assert naming.match_columns(["id", "Status"], ["ID", "status", "new"]) == (
        ["id", "Status", "new"], {"ID": "id", "status": "Status", "new": "new"})
