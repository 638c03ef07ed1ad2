"""Dedup and validation edge rows."""

import random

from conftest import at, rows
from pyspark.sql import functions as F

from tiffinlake.operators import dedup, validation


def test_dedup_latest_ties_nulls_and_copies(spark):
    df = spark.createDataFrame(
        [("a", at(1), "x"), ("a", at(2), "y"), ("a", at(2), "z"), ("b", None, "n"), ("b", at(0), "m"), (None, at(1), "p"), (None, at(3), "q")],
        "k string, t timestamp_ntz, v string")
    assert rows(dedup.dedup_latest(df, ["k"], ["t"])) == rows(spark.createDataFrame(
        [("a", at(2), "z"), ("b", at(0), "m"), (None, at(3), "q")], df.schema))


def _wide(spark, ids):
    fields = [F.concat(F.lit(f"f{i}-"), F.col("n") % 7).alias(f"f{i}") for i in range(16)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "k string, n long").select("k", "n", F.struct(*fields).alias("payload"))


def test_wide_rows_are_sorted_in_bounded_tasks(spark):
    df = _wide(spark, [f"k{i % 900}" for i in range(1000)] + [None, None])
    out = dedup.dedup_latest(df, ["k"], ["n"], task_rows=100)
    text = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "REPARTITION_BY_NUM" in text and text.count("Exchange hashpartitioning") == 1
    assert out.rdd.getNumPartitions() == 11
    got = {r["k"]: (r["n"], r["payload"]["f15"]) for r in out.collect()}
    want = {f"k{i % 900}": (i, f"f15-{i % 7}") for i in range(1000)} | {None: (1001, f"f15-{1001 % 7}")}
    assert got == want and out.count() == 901


def test_wide_copies_of_a_busy_key_are_combined_before_the_shuffle(spark):
    df = _wide(spark, ["hot"] * 500 + [f"k{i}" for i in range(100)])
    out = dedup.dedup_latest(df, ["k"], ["n"], task_rows=100)
    assert "REPARTITION_BY_NUM" not in out._jdf.queryExecution().toString()
    assert {r["k"]: r["n"] for r in out.collect()} == {"hot": 499} | {f"k{i}": 500 + i for i in range(100)}


def test_dedup_latest_keeps_map_columns(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"x": "2"})], "k string, t int, m map<string,string>")
    assert dedup.dedup_latest(df, ["k"], ["t"]).first()["m"] == {"x": "2"}


def test_flag_duplicates_marks_all_but_the_earliest(spark):
    df = spark.createDataFrame(
        [("a", at(1), 1), ("a", at(1), 1), ("a", at(1), 1), ("a", at(0), 2), ("b", at(5), 3), (None, at(1), 4), (None, at(2), 5), ("c", None, 6), ("c", at(9), 7)],
        "k string, t timestamp_ntz, v int")
    got = rows(dedup.flag_duplicates(df, ["k"], ["t"]).select("k", "v", "is_duplicate"))
    assert got == sorted([("a", 1, True)] * 3 + [("a", 2, False), ("b", 3, False), (None, 4, False), (None, 5, True), ("c", 6, True), ("c", 7, False)], key=repr)


def test_flag_duplicates_of_exact_copies(spark):
    df = spark.range(250_000).select(F.lit("k").alias("k"), F.lit(1).alias("t"))
    got = dedup.flag_duplicates(df, ["k"], ["t"]).groupBy("is_duplicate").count()
    assert rows(got) == [(False, 1), (True, 249_999)]


def test_order_rules_report_the_first_failure(spark):
    df = spark.createDataFrame(
        [("o1", 1, 1, 5.0, at(0)), (None, None, 1, 5.0, at(0)), ("o3", 1, 1, 0.0, at(0)), ("o4", 1, 1, -1.0, None), ("o5", 1, 1, None, at(0)),
         ("o6", 1, None, 5.0, at(0)), ("o7", 1, 1, 5.0, None)],
        "order_id string, user_id int, item_id int, price double, event_timestamp timestamp_ntz")
    out = {r.order_id: (r.is_valid, r.validation_errors) for r in validation.validate_orders(df).collect()}
    assert out == {
        "o1": (True, None), None: (False, "Missing ORDER_ID"), "o3": (False, "Invalid PRICE"), "o4": (False, "Invalid PRICE"),
        "o5": (False, "Invalid PRICE"), "o6": (False, "Missing ITEM_ID"), "o7": (False, "Missing TIMESTAMP")}
    lake = {r.order_id: r.is_valid for r in validation.validate_orders(df, "lake").collect()}
    assert lake["o6"] and not lake["o5"]
    warehouse = {r.order_id: r.validation_errors for r in validation.validate_orders(df, "warehouse").collect()}
    assert warehouse["o5"] == "price_invalid" and warehouse["o6"] == "item_id_null" and warehouse["o7"] is None


def test_click_rules(spark):
    df = spark.createDataFrame(
        [("e1", 1, 1, "click", at(0)), ("e2", 1, None, "impression", at(0)), ("e3", 1, 1, "hover", at(0)), ("e4", None, 1, "click", at(0))],
        "event_id string, user_id int, item_id int, event_type string, event_timestamp timestamp_ntz")
    lake = {r.event_id: r.validation_errors for r in validation.validate_clicks(df).collect()}
    assert lake == {"e1": None, "e2": "hover_impression_noise", "e3": None, "e4": "Missing USER_ID"}
    warehouse = {r.event_id: r.validation_errors for r in validation.validate_clicks(df, "warehouse").collect()}
    assert warehouse == {"e1": None, "e2": None, "e3": "unknown_event_type", "e4": "user_id_null"}


def test_order_contract_lists_every_violation(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 0.0, "placed"), (0, 0, 0, -1.0, "lost"), (None, 5, None, None, None)],
        "user_id int, item_id int, quantity int, price double, order_type string")
    good, bad = validation.check_contract(df, "order")
    assert good.count() == 2 and len(bad.first()["violations"]) == 5


def test_structs_of_text_are_packed_in_their_order(spark):
    """Nulls, empty texts, prefixes and the marks themselves: the same row is kept, unchanged, as by the struct's own order."""
    r = random.Random(11)
    texts = [None, "", " ", "a", "ab", "b", "\u0000", "\u0000a", "\u0001", "\u0001\u0000", "\u0000\u0001", "\u0001\u0002", "\u0002", "a\u0000", "a\u0001", "é", "�", "\U0001f600"]
    data = [(r.randrange(60), r.choice([None, "1", "2"]), None if r.random() < .05 else tuple(r.choice(texts) for _ in range(4))) for _ in range(1500)]
    df = spark.createDataFrame(data, "id int, t string, payload struct<p: string, q: string, r: string, s: string>")
    # The struct's own order, which is the one of max.
    want = df.groupBy("id").agg(F.max(F.struct("t", "payload")).alias("x")).select("id", "x.*")
    got = dedup.dedup_latest(df, ["id"], ["t"])
    assert rows(got) == rows(want) and [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    by_tie = dedup.dedup_latest(df.withColumn("n", F.monotonically_increasing_id()), ["id"], ["t"], ["payload", "n"])
    assert rows(by_tie.drop("n")) == rows(want)
    # What is moved is one text, not the fields.
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange hashpartitioning(id"):]
    assert "max(struct(t, t#" in exchange and "payload, payload#" in exchange and plan.index("split(") < plan.index("Exchange")
