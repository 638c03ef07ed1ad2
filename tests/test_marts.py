import datetime as dt

import pytest
from conftest import at, rows

from tiffinlake.operators import ads, marts, profiles, ranking

CLICKS = "event_id int, user_id int, item_id int, event_type string, event_timestamp timestamp_ntz, partition_date date, session_id string"
ORDERS = ("order_id string, user_id int, item_id int, item_name string, price decimal(12,2), event_timestamp timestamp_ntz, "
          "partition_date date, session_id string")
DAY = dt.date(2024, 3, 1)


@pytest.fixture
def sides(spark):
    from decimal import Decimal as D
    clicks = [(1, 1, 5, "impression", at(0), DAY, "s"), (2, 1, 5, "click", at(10), DAY, "s"), (3, 1, 5, "click", at(20), DAY, "s"),
              (4, 2, 6, "click", at(0), DAY, "t"), (5, None, 5, "click", at(0), DAY, "x")]
    orders = [("a", 1, 5, "old", D("10.00"), at(1800), DAY, "s"), ("b", 1, 5, "new", D("20.00"), at(3700), DAY, "s"),
              ("c", 3, 7, "z", D("5.00"), at(3700), DAY, None)]
    return spark.createDataFrame(clicks, CLICKS), spark.createDataFrame(orders, ORDERS)


def test_an_order_with_two_clicks_counts_once(sides):
    clicks, orders = sides
    out = {r.item_id: r for r in ads.ads_attribution(clicks, orders).collect()}
    five = out[5]
    assert (five.impression_count, five.click_count, five.order_count, five.attributed_order_count) == (1, 3, 2, 1)
    assert float(five.attributed_revenue) == 10.0 and five.item_name == "new" and five.ctr == 3.0
    assert set(out) == {5, 7}
    assert {r.item_id for r in ads.ads_attribution(clicks, orders, include_unordered=True).collect()} == {5, 6, 7}


def test_recon_compat_counts_every_match_and_exact_counts_once(sides):
    clicks, orders = sides
    compat = {(r.date_hour.hour, r.item_id): r for r in ads.recon_hourly(clicks, orders, mode="compat").collect()}
    # Order a matches all three rows of user 1 within 30 minutes: the impression and both clicks.
    assert (compat[(0, 5)].impressions, compat[(0, 5)].clicks, compat[(0, 5)].orders, float(compat[(0, 5)].revenue)) == (1, 3, 1, 30.0)
    exact = {(r.date_hour.hour, r.item_id): r for r in ads.recon_hourly(clicks, orders).collect()}
    assert float(exact[(0, 5)].revenue) == 10.0 and exact[(0, 5)].attributed_orders == 1 and exact[(1, 5)].orders == 1


def test_reconcile_only_raises(spark):
    schema = "item_id int, date date, impressions bigint, clicks bigint, orders bigint, attributed_orders bigint, revenue double"
    counters = spark.createDataFrame([(1, DAY, 5, 5, 5, 5, 5.0), (2, DAY, 1, 1, 1, 1, 1.0)], schema)
    truth = spark.createDataFrame([(1, DAY, 9, 3, 5, 5, 7.5), (3, DAY, 1, 0, 0, 0, 0.0)], schema)
    out = {r.item_id: tuple(r)[2:] for r in ads.reconcile(counters, truth).collect()}
    assert out == {1: (9, 5, 5, 5, 7.5, 2), 2: (1, 1, 1, 1, 1.0, 0), 3: (1, 0, 0, 0, 0.0, 1)}


def test_gmv_of_an_empty_day_is_one_zero_row(sides):
    out = marts.daily_gmv(sides[1], "2030-01-01").collect()
    assert len(out) == 1 and out[0].order_count == 0 and float(out[0].total_revenue) == 0.0


def test_ranks_with_ties_and_one_dominant_value(spark):
    values = [(g, 7 if i % 3 == 0 else i % 50) for g in ("a", "b") for i in range(900)]
    df = spark.createDataFrame(values, "g string, v int")
    got = {(r.g, r.v): (r.place, round(r.place_pct, 9)) for r in ranking.add_rank(df, ["g"], "v", "place", slices=8).collect()}
    for g, v in set(values):
        above = sum(x > v for y, x in values if y == g)
        assert got[(g, v)] == (above + 1, round(above / 899, 9))


def test_recommendation_tiers(spark):
    foods = spark.createDataFrame([(i, f"f{i}", "xy"[i % 2], 1.0, i != 9) for i in range(1, 13)],
                                  "food_id int, name string, category string, price double, is_available boolean")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    items = spark.createDataFrame([(1, 4, 2.0), (1, 9, 9.0), (1, 3, 5.0)], "user_id int, item_id int, score double")
    categories = spark.createDataFrame([(1, "y", 1.0)], "user_id int, category string, score double")
    out = profiles.recommend(users, items, categories, foods, 8).orderBy("user_id", "position").collect()
    assert [(r.food_id, r.reason) for r in out if r.user_id == 1] == [
        (3, "user_item_preference"), (4, "user_item_preference"), *[(f, "user_category_preference") for f in (11, 7, 5, 1)],
        (12, "cold_start_popular"), (10, "cold_start_popular")]
    assert [r.food_id for r in out if r.user_id == 2] == [12, 11, 10, 8, 7, 6, 5, 4]


def test_profile_score_and_skip_rules(spark):
    events = spark.createDataFrame(
        [(1, 5, "a", "order", at(0)), (1, 5, "a", "odd", at(0)), (0, 5, "a", "click", at(0)), (1, 0, " ", "click", at(0)), (2, 5, "a", "click", None)],
        "user_id int, item_id int, category string, event_type string, event_time timestamp_ntz")
    out = {(r.user_id, r.item_id): round(r.score, 6) for r in profiles.interest_profiles(events, at(240 * 60), ttl=None).collect()}
    assert out == {(1, 5): round(6 * 2.718281828459045 ** -1, 6), (2, 5): 3.0}
    assert rows(profiles.interest_profiles(events, at(8 * 86400)).where("user_id = 1")) == []
