import datetime as dt

import pytest

from tiffinlake.functions import (
    closed_hours, epoch_us, item_from_ad, micros, parse_iso_ts, parse_order_time, ratio, raw_field, safe_double, safe_int,
    split_key_values, time_bucket,
)


def one(spark, values, schema, column):
    return [r[0] for r in spark.createDataFrame(values, schema).select(column.alias("x")).collect()]


def test_safe_casts(spark):
    texts = [None, "", " ", "NaN", "NaN ", "null", "12", " 12 ", "12.0", "12.7", "conditions NaN", "x", "99999999999"]
    rows = [(t,) for t in texts]
    assert one(spark, rows, "t string", safe_int("t")) == [None] * 6 + [12, 12, 12, 12, None, None, None]
    assert one(spark, rows, "t string", safe_double("t")) == [None] * 6 + [12.0, 12.0, 12.0, 12.7, None, None, 99999999999.0]


def test_iso_timestamps(spark):
    texts = ["2026-02-04T10:30:00Z", "2026-02-04T10:30:00.123456", "2026-02-04T10:30:00+05:30", "2026-02-04", "bad", "2026", None]
    got = one(spark, [(t,) for t in texts], "t string", parse_iso_ts("t").cast("timestamp_ntz"))
    assert got == [dt.datetime(2026, 2, 4, 10, 30), dt.datetime(2026, 2, 4, 10, 30, 0, 123456), dt.datetime(2026, 2, 4, 5, 0),
                   dt.datetime(2026, 2, 4), None, None, None]


@pytest.mark.parametrize("text, expected", [
    ("14:05", (31, 14, 5)), ("24:00", (32, 0, 0)), ("0.458333333", (31, 11, 0)), ("1.0", (31, 0, 0)), ("NaN", (31, 0, 0)),
    ("", (31, 0, 0)), (None, (31, 0, 0)), ("garbage", (31, 0, 0)), ("25:99", (31, 0, 0)), ("-0.1", (31, 21, 36)), ("9:05", (31, 9, 5)),
])
def test_order_time(spark, text, expected):
    day, hour, minute = expected
    want = dt.datetime(2025, 12, 31) + dt.timedelta(days=day - 31, hours=hour, minutes=minute)
    got = one(spark, [("31-12-2025", text)], "d string, t string", parse_order_time("d", "t").cast("timestamp_ntz"))
    assert got == [want]


def test_order_time_bad_date(spark):
    assert one(spark, [("x", "14:05")], "d string, t string", parse_order_time("d", "t")) == [None]


def test_item_from_ad(spark):
    ads = [("food_12",), ("7",), ("ad_3",), (None,), ("food_",), ("food_9x",)]
    assert one(spark, ads, "a string", item_from_ad("a")) == [12, 7, None, None, None, None]


def test_raw_field(spark):
    raws = [('{"a":{"b":5}}',), ("oops",), ('{"a":{"b":"x"}}',), (None,)]
    assert one(spark, raws, "r string", raw_field("r", "$.a.b", "int")) == [5, None, None, None]


def test_ratio(spark):
    assert one(spark, [(1, 2), (1, 0), (1, None), (None, 4)], "a int, b int", ratio("a", "b")) == [0.5, 0.0, 0.0, 0.0]


def test_time_bucket_before_epoch(spark):
    times = [(-1,), (0,), (9,), (10,), (-10,), (-11,)]
    assert one(spark, times, "t bigint", time_bucket("t", 10)) == [-1, 0, 0, 1, -1, -2]


def test_durations_and_hours(spark):
    assert micros("30 minutes") == 1_800_000_000 and micros("1 day") == micros(86400) == micros(dt.timedelta(days=1))
    assert closed_hours(dt.datetime(2024, 1, 20, 13, 45), 2) == (dt.datetime(2024, 1, 20, 11), dt.datetime(2024, 1, 20, 13))
    assert one(spark, [(dt.datetime(1970, 1, 1, 0, 0, 1, 5),)], "t timestamp_ntz", epoch_us("t")) == [1_000_005]


def test_split_key_values(spark):
    path = "s3://b/bronze/year=2024/month=03/x.json"
    values = split_key_values("p", ["year", "month", "day"])
    got = spark.createDataFrame([(path,)], "p string").select(*[v.alias(k) for k, v in values.items()]).first()
    assert tuple(got) == ("2024", "03", None)


def test_fields_sent_with_other_types(spark):
    from pyspark.sql import functions as F

    from tiffinlake.functions import text_fields, typed_fields, unconvertible
    from tiffinlake.schemas import ORDER_EVENT
    bodies = ['{"user_id": 7, "price": 1.5, "metadata": {"a": "b"}}', '{"user_id": "7", "price": "1.50", "metadata": "{\\"a\\": \\"b\\"}"}',
              '{"user_id": 7.0, "price": null, "metadata": "none"}', '{"user_id": "x"}', '{"quantity": 1.5}', '{"price": {"a": 1}}', "{}"]
    sent = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").withColumn(
        "sent", F.from_json("b", text_fields(ORDER_EVENT)))
    got = sent.select("i", *typed_fields("sent", ORDER_EVENT), unconvertible("sent", ORDER_EVENT).alias("lost")).orderBy("i").collect()
    assert [r.user_id for r in got] == [7, 7, 7, None, None, None, None]
    assert [float(r.price) if r.price is not None else None for r in got] == [1.5, 1.5, None, None, None, None, None]
    assert [(r.metadata or {}).get("a") for r in got] == ["b", "b", None, None, None, None, None]
    assert [r.lost for r in got] == [False, False, False, True, True, True, False]
