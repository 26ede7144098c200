"""Column rules against Python's own decimals and calendar."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_DOWN, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from starloom.functions import bigint, calendar_fields, epoch_millis, integer, truncated_decimal


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def results(df, *columns):
    return [r[0] if len(columns) == 1 else tuple(r)[:-1] for r in df.select(*columns, "i").orderBy("i").collect()]


def numbers():
    rng = random.Random(3)
    found = ["0", "-0.0", "1e-7", "-1e-7", "0.99999999999999999999", "-0.999999999999999999",
             "1.9999999999999998e-05", "12345678901234", "999999999999999999", "1e17", "1e18", "-1e18"]
    for _ in range(400):
        digits = str(rng.randrange(10 ** rng.randrange(1, 13)))
        fraction = "".join(rng.choice("0123456789") for _ in range(rng.randrange(0, 17)))
        found.append(rng.choice(["", "-"]) + digits + ("." + fraction if fraction else ""))
        found.append(repr(rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 12)))
    return found


@pytest.mark.parametrize("scale", [0, 1, 5])
def test_decimals_are_cut_toward_zero(spark, scale):
    values = numbers()
    got = results(texts(spark, values), truncated_decimal(F.col("v"), 18, scale))
    with localcontext() as context:
        context.prec = 60
        for value, ours in zip(values, got):
            cut = Decimal(value).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_DOWN)
            expected = cut if abs(cut) < Decimal(10) ** (18 - scale) else None
            assert ours == expected, value


def test_integers(spark):
    values = ["0", "-7", "2147483647", "2147483648", "1.5", "", " ", "x", None, "007", "200.0", "-3e2", "1e20"]
    assert results(texts(spark, values), integer(F.col("v"))) == [
        0, -7, 2147483647, None, None, None, None, None, None, 7, 200, -300, None,
    ]


def test_bigints(spark):
    values = ["1600000123456.0", "1.600000123456E12", "9223372036854775807", "-9223372036854775808",
              "9223372036854775808", "", "x", None, "-1.9"]
    assert results(texts(spark, values), bigint(F.col("v"))) == [
        1600000123456, 1600000123456, 9223372036854775807, -9223372036854775808, None, None, None, None, -1,
    ]


def test_epoch_millis(spark):
    values = [0, -1, 1530203040506, 951782400000, 4102444800123, -62135596800000]
    got = results(texts(spark, [str(v) for v in values]), epoch_millis(F.col("v")))
    assert got == [datetime(1970, 1, 1) + timedelta(milliseconds=v) for v in values]


def test_milliseconds_beyond_any_timestamp(spark):
    values = ["9223372036854775807", "-9223372036854775808", "9223372036854776", "1e30", "x"]
    assert results(texts(spark, values), epoch_millis(F.col("v"))) == [None] * 5


def test_calendar(spark):
    start = datetime(1995, 12, 20, 3, 30)
    days = [start + timedelta(days=d, hours=d % 24) for d in range(0, 12000, 3)]
    data = spark.createDataFrame(list(enumerate(days)), "i int, ts timestamp_ntz")
    got = results(data, *calendar_fields(F.col("ts")))
    assert got == [
        (t.hour, t.day, t.isocalendar().week, t.month, t.year, t.isoweekday() % 7) for t in days
    ]
