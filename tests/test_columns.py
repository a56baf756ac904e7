import pytest
from fixtures import at
from pyspark.sql import functions as F

from tidemark.functions import any_equals, as_timestamp, days_after, last_known, share_above, sum_or_zero, whole_days


@pytest.mark.parametrize(
    ("later", "earlier", "days"),
    [
        ("2018-01-02T06:00:00", "2018-01-01T18:00:00", 0),  # over midnight, but no whole day
        ("2018-01-01T00:00:00", "2018-01-01T12:00:00", -1),  # 12 hours early rounds down
        ("2018-01-03T12:00:00", "2018-01-01T12:00:00", 2),
        ("2018-01-01T12:00:00", "2018-01-03T12:00:00", -2),
        ("2018-01-01T11:59:59.999999", "2018-01-03T12:00:00", -3),
        ("9999-12-31T00:00:00", "0001-01-01T00:00:00", 3652058),
        ("0001-01-01T00:00:00", "9999-12-31T00:00:00", -3652058),
    ],
)
def test_whole_days_round_down(spark, later, earlier, days):
    df = spark.createDataFrame([(at(later), at(earlier))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days("a", "b").alias("d")).first()["d"] == days


def test_whole_days_ignore_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # the clocks of the zone changed on 2018-11-04
        df = spark.createDataFrame(
            [(at("2018-11-05T00:00:00"), at("2018-11-04T00:00:00"))], "a timestamp_ntz, b timestamp_ntz"
        )
        assert df.select(whole_days("a", "b").alias("d")).first()["d"] == 1
        moved = df.select(days_after(F.col("b"), 1).alias("d")).first()["d"]
        assert moved == at("2018-11-05T00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_whole_days_of_null_is_null(spark):
    df = spark.createDataFrame([(None, at("2018-01-01"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days("a", "b").alias("d")).first()["d"] is None


def test_as_timestamp_takes_text_and_datetime(spark):
    one = spark.range(1).select(as_timestamp("2018-07-01").alias("t"), as_timestamp(at("2018-07-01T01:02:03")).alias("u"))
    assert one.dtypes == [("t", "timestamp_ntz"), ("u", "timestamp_ntz")]
    assert tuple(one.first()) == (at("2018-07-01"), at("2018-07-01T01:02:03"))


def test_aggregates_of_unknown_values(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, kind string")
    found = df.agg(sum_or_zero("x").alias("s"), share_above("x", 0).alias("p"), any_equals("kind", "a").alias("k")).first()
    assert tuple(found) == (0.0, 0.0, 0)


def test_share_counts_unknown_rows(spark):
    df = spark.createDataFrame([(2,), (1,), (None,), (5,)], "x int")
    assert df.agg(share_above("x", 1).alias("p")).first()["p"] == 0.5


def test_last_known_passes_over_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "t int, v string")
    assert df.agg(last_known("v", "t").alias("v")).first()["v"] == "b"
    assert df.filter("v is null").agg(last_known("v", "t").alias("v")).first()["v"] is None
