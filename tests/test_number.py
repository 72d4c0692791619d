from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagstream.functions.number import clamped, rounded
from tagstream.functions.plan import each_column


def table_numbers(df):
    return each_column(each_column(df, ["v"], clamped), ["v"], rounded)


def stored(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.v for r in table_numbers(df).orderBy("i").collect()]


def test_clamp_round_null(spark):
    values = [12345678.9, -12345678.9, 1.23456, 0.0005, None, float("nan"), float("inf"), float("-inf")]
    assert stored(spark, values) == [9999999.999, -9999999.999, 1.235, 0.001, None, None, None, None]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-2e7, 2e7), min_size=1, max_size=50))
def test_agrees_with_decimal_arithmetic(spark, values):
    def model(v):
        v = max(min(v, 9999999.999), -9999999.999)
        return float(Decimal(repr(v)).quantize(Decimal("0.001"), ROUND_HALF_UP))

    assert stored(spark, values) == [model(v) for v in values]


def test_numbers_with_few_decimals_stay_themselves(spark):
    ids = spark.range(0, 2_000_000, 1, 4)
    for number in (F.col("id") * 4.999, F.col("id") / 1000, F.col("id") * -0.7777777):
        df = ids.select(number.alias("v"), F.round(number, 3).alias("r"))
        assert table_numbers(df).filter("v <> r").isEmpty()
