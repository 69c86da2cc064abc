from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pregonero.functions.timestamps import civil_days, with_utc_micros


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


CASES = [
    ("2018-03-28 19:55:40,287 America/Sao_Paulo", "UTC", "dmy", us(2018, 3, 28, 22, 55, 40) + 287_000),
    ("20180108T035012Z", "UTC", "dmy", us(2018, 1, 8, 3, 50, 12)),
    ("20180107143053", "America/Cuiaba", "dmy", us(2018, 1, 7, 17, 30, 53)),
    ("1515458195", None, None, 1515458195 * 10**6), ("1515244104267", None, None, 1515244104267 * 1000), ("1515251989661330", None, None, 1515251989661330),
    ("/Date(1515427036184)/", None, None, 1515427036184 * 1000),
    ("2018-01-06 09h16 (UTC-2)", "UTC", "dmy", us(2018, 1, 6, 11, 16)), ("01/Apr/2018:21:55:33 -0300", "UTC", "dmy", us(2018, 4, 2, 0, 55, 33)),
    ("Fri, 01 Aug 2025 07:06:31 GMT", None, None, us(2025, 8, 1, 7, 6, 31)), ("2026-09-30T21:49:54+05:30", None, None, us(2026, 9, 30, 16, 19, 54)),
    ("31/12/2024 06:05:36", "America/Manaus", "dmy", us(2024, 12, 31, 10, 5, 36)), ("12/31/2024 06:05:36", "America/New_York", "mdy", us(2024, 12, 31, 11, 5, 36)),
    ("01/01/2021 9:43:04 PM", "UTC", "dmy", us(2021, 1, 1, 21, 43, 4)), ("01/01/2021 12:00:00 AM", "UTC", "dmy", us(2021, 1, 1)),
    ("10.1.2018 03:58", "UTC", "dmy", us(2018, 1, 10, 3, 58)), ("01/01/19 11:49", "UTC", "dmy", us(2019, 1, 1, 11, 49)), ("15/06/2020", "UTC", "dmy", us(2020, 6, 15)),
    ("quarta-feira, 10 de abril de 2019 às 15h36min", "UTC", "dmy", us(2019, 4, 10, 15, 36)), ("1 de abr de 2020, 12h17", "UTC", "dmy", us(2020, 4, 1, 12, 17)),
    ("  01-May-2019 11:11  ", "UTC", "dmy", us(2019, 5, 1, 11, 11)), ("01-Aug-2018 15:02 BRT", "UTC", "dmy", us(2018, 8, 1, 18, 2)), ("10.1.2018 19:07 AMT", "UTC", "dmy", us(2018, 1, 10, 23, 7)),
    # impossible, void and unknown
    ("32/13/2025", "UTC", "dmy", None), ("31/02/2024 10:00", "UTC", "dmy", None), ("0000-00-00 00:00:00", "UTC", "dmy", None), ("a definir", "UTC", "dmy", None), ("", "UTC", "dmy", None), (None, "UTC", "dmy", None),
    ("2018-01-06 10:00:00", None, "dmy", None), ("2018-01-06 10:00:00 Nowhere/City", "UTC", "dmy", None), ("x" * 50_000, "UTC", "dmy", None),
    # the clock went back on 18 Feb 2018 and forward on 4 Nov 2018 in Sao Paulo
    ("2018-02-17 23:30:00", "America/Sao_Paulo", "dmy", None), ("2018-11-04 00:30:00", "America/Sao_Paulo", "dmy", None),
    ("2018-02-17 23:30:00 BRST", "America/Sao_Paulo", "dmy", us(2018, 2, 18, 1, 30)), ("2018-02-17 22:59:59", "America/Sao_Paulo", "dmy", us(2018, 2, 18, 0, 59, 59)),
]


def test_notations(spark):
    df = spark.createDataFrame([(i, t, z, o) for i, (t, z, o, _) in enumerate(CASES)], "i int, t string, z string, o string")
    got = {r.i: r.utc_us for r in with_utc_micros(df, "t", "z", "o").collect()}
    for i, case in enumerate(CASES):
        assert got[i] == case[3], case[:3]


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([("2018-01-06T00:00:00Z", "UTC", "dmy", 1, 2)], "t string, z string, o string, y int, wall int")
    out = with_utc_micros(df, "t", "z", "o")
    assert out.columns == ["t", "z", "o", "y", "wall", "utc_us"] and out.first().utc_us == us(2018, 1, 6)
    assert with_utc_micros(df.limit(0), "t", "z", "o").count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(min_value=datetime(1, 1, 1).date(), max_value=datetime(9999, 12, 31).date()), min_size=1, max_size=40))
def test_day_arithmetic(spark, days):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(d.year, d.month, d.day, d.toordinal() - 719163) for d in days], "y long, m long, d long, want long")
    assert df.where(civil_days(F.col("y"), F.col("m"), F.col("d")) != F.col("want")).count() == 0


@pytest.mark.parametrize("column", ["t", "z", "o"])
def test_nulls_anywhere(spark, column):
    df = spark.createDataFrame([("01/02/2020 10:00", "UTC", "dmy")], "t string, z string, o string").withColumn(column, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string"))
    got = with_utc_micros(df, "t", "z", "o").first().utc_us
    assert got == (us(2020, 2, 1, 10) if column == "o" else None)
