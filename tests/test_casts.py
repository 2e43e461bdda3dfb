"""Lenient casts against the reference engine's measured behaviour (FIXTURES 2.1)."""

import datetime as dt

from pyspark.sql import functions as F

from filmmart.functions.casts import try_bool, try_date, try_int

INTS = {"85": 85, "85.0": 85, "85.5": 86, " 85 ": 85, "1e2": 100, "+5": 5, "5.": 5, ".5": 1, "-2.5": -3,
        "2.5": 3, "2147483647.4": 2147483647, "-0": 0, "1e-1": 0, "": None, "3/4": None, "85d": None, "85f": None,
        "NaN": None, "99999999999": None, "2147483647.6": None, "B+": None, "85%": None, "1e400": None,
        "1 000": None, "0x10": None}
D = dt.date(2024, 3, 5)
DATES = {"2024-03-05": D, "2024/03/05": D, "2024 03 05": D, "2024-3-5": D, " 2024-03-05 ": D,
         "2024-03-05 10:00:00": D, "2024-03-05T10:00": D, "2024-03-05T10:00:00Z": D, "2024-03-05T10:00:00.000Z": D,
         "2024-03-05T10:00:00.123+02:00": D, "2024-03-05T23:30:00-05:00": D, "2024-03/05": None,
         "2024-03-05 abc": None, "2024-03-05T": None, "2024-02-30": None, "2024": None, "2024-03": None,
         "Jan 5, 2024": None, "": None}
BOOLS = {"true": True, "TRUE": True, "t": True, "yes": True, "Y": True, "1": True, "false": False, "No": False,
         "f": False, "0": False, "2": None, "maybe": None, "": None}


def _run(spark, cases, fn):
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    return {r["v"]: r["out"] for r in df.select("v", fn("v").alias("out")).collect()}


def test_try_int(spark):
    assert _run(spark, INTS, try_int) == INTS


def test_try_date(spark):
    assert _run(spark, DATES, try_date) == DATES


def test_try_bool(spark):
    assert _run(spark, BOOLS, try_bool) == BOOLS


def test_null_input(spark):
    df = spark.createDataFrame([(None,)], "v string")
    r = df.select(try_int("v").alias("i"), try_date("v").alias("d"), try_bool("v").alias("b")).first()
    assert (r["i"], r["d"], r["b"]) == (None, None, None)
    assert df.select(try_int(F.lit(" 7 ")).alias("x")).first()["x"] == 7
