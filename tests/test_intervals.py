"""Window operators against brute force, on boundaries and on random data with hot keys and ties."""

import random
from collections import defaultdict

import pytest
from conftest import T0, at, rows
from pyspark.sql import functions as F

from tiffinlake.operators import intervals
from tiffinlake.operators.cooldown import cooldown

SCHEMA = "user string, event_id int, t timestamp_ntz, v int"


def noisy(seed, n=400, users=4, span=4000):
    r = random.Random(seed)
    return [(None if r.random() < .03 else ("hot" if r.random() < .5 else f"u{r.randrange(users)}"), i,
             at(r.randrange(span) if r.random() < .7 else 60 * r.randrange(span // 60)), r.randrange(10)) for i in range(n)]


def secs(t):
    return (t - T0).total_seconds()


def test_existence_bounds_are_inclusive_to_the_microsecond(spark):
    orders = spark.createDataFrame([("u", 1, at(1800), 0), ("u", 2, at(1800, 1), 0), ("u", 3, at(0), 0), ("u", 4, at(-1), 0), (None, 5, at(10), 0)], SCHEMA)
    clicks = spark.createDataFrame([("u", 1, at(0), 0), (None, 2, at(0), 0)], SCHEMA)
    out = intervals.has_prior(orders, clicks, ["user"], "t", "t", "30 minutes")
    assert {r.event_id: r.matched for r in out.collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}


@pytest.mark.parametrize("seed", range(3))
def test_matches_against_brute_force(spark, seed):
    left, right = noisy(seed, 150), noisy(seed + 50, 150)
    pairs = {(a[1], b[1]) for a in left for b in right
             if a[0] and a[0] == b[0] and 0 <= secs(b[2]) - secs(a[2]) <= 300}
    lefts = spark.createDataFrame(left, SCHEMA).select("user", F.col("event_id").alias("l"), F.col("t").alias("lt"))
    rights = spark.createDataFrame(right, SCHEMA).select("user", F.col("event_id").alias("r"), F.col("t").alias("rt"), "v")
    inner = intervals.interval_join(lefts, rights, ["user"], "lt", "rt", "5 minutes")
    assert rows(inner.select("l", "r")) == sorted(pairs, key=repr)
    full = intervals.interval_join(lefts, rights, ["user"], "lt", "rt", "5 minutes", "full").select("l", "r")
    alone = [(a[1], None) for a in left if a[1] not in {p[0] for p in pairs}] + [(None, b[1]) for b in right if b[1] not in {p[1] for p in pairs}]
    assert rows(full) == sorted([*pairs, *alone], key=repr)
    totals = intervals.interval_totals(lefts, rights, ["user"], "lt", "rt", "5 minutes", {"n": F.lit(1), "s": F.col("v")}, lag_us=300_000_000)
    got = {(r.user, r.at_us): (r.n or 0, r.s or 0) for r in totals.collect()}
    for a in left:
        if a[0]:
            hits = [b for b in right if b[0] == a[0] and 0 <= secs(b[2]) - secs(a[2]) <= 300]
            key = (a[0], round((a[2] - at(0)).total_seconds()) * 1_000_000 + epoch(at(0)))
            assert got[key] == (len(hits), sum(b[3] for b in hits))


def epoch(t):
    import datetime as dt
    return int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000


@pytest.mark.parametrize("lower", ["closed", "open"])
def test_trailing_counts(spark, lower):
    data = noisy(7)
    df = spark.createDataFrame(data, SCHEMA)
    out = intervals.interval_totals(df, df, ["user"], "t", "t", "5 minutes", {"n": F.lit(1)}, lower=lower)
    got = {(r.user, r.at_us): r.n for r in out.collect()}
    want = {}
    for a in data:
        if a[0]:
            age = [secs(a[2]) - secs(b[2]) for b in data if b[0] == a[0]]
            want[(a[0], epoch(a[2]))] = sum(0 <= x <= 300 if lower == "closed" else 0 <= x < 300 for x in age)
    assert got == want


def test_trailing_distinct(spark):
    data = [(f"d{i % 2}" if u else None, i, t, v) for i, (u, _, t, v) in enumerate(noisy(9))]
    df = spark.createDataFrame(data, SCHEMA)
    out = intervals.trailing_distinct(df, ["user"], "v", "t", "5 minutes")
    got = {(r.user, r.at_us): r.n_distinct for r in out.collect()}
    want = {(a[0], epoch(a[2])): len({b[3] for b in data if b[0] == a[0] and 0 <= secs(a[2]) - secs(b[2]) <= 300}) for a in data if a[0]}
    assert got == want


def test_running_count_spans_slices(spark):
    data = [d for d in noisy(3, span=20000) if d[0]]
    out = intervals.running_count(spark.createDataFrame(data, SCHEMA), ["user"], "t", ["event_id"])
    got = {r.event_id: r.running_count for r in out.collect()}
    seen, want = defaultdict(int), {}
    for u, i, t, _ in sorted(data, key=lambda d: (d[2], d[1])):
        seen[u] += 1
        want[i] = seen[u]
    assert got == want


def test_sessions_split_at_the_gap_exactly(spark):
    df = spark.createDataFrame([("u", 1, at(0), 0), ("u", 2, at(599, 999999), 0), ("u", 3, at(1199, 999999), 0), ("u", 4, at(1700), 0)], SCHEMA)
    out = intervals.sessions(df, ["user"], "t", "10 minutes").orderBy("start_us")
    assert [r.n_events for r in out.collect()] == [2, 2]
    fired = intervals.inactive_keys(df, ["user"], "t", "10 minutes")
    assert sorted(r.fired_us - epoch(at(0)) for r in fired.collect()) == [1_199_999_999, 2_300_000_000]


def greedy(data, period):
    last, keep = {}, []
    for u, i, t, _ in sorted(data, key=lambda d: (d[2], d[1])):
        if u not in last or secs(t) - last[u] > period:
            last[u] = secs(t)
            keep.append(i)
    return sorted(keep)


@pytest.mark.parametrize("options", [{}, {"listed": 1, "walked": 1}, {"listed": 4, "walked": 9}, {"walked": 1}])
@pytest.mark.parametrize("seed", range(2))
def test_cooldown_equals_the_state_machine(spark, seed, options):
    data = [d for d in noisy(seed, 600, span=30000) if d[0]]
    df = spark.createDataFrame(data, SCHEMA)
    out = cooldown(df, ["user"], "t", "5 minutes", ["event_id"], **options)
    assert sorted(r.event_id for r in out.collect()) == greedy(data, 300)


def test_cooldown_of_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1, at(0), 0), (None, 2, at(10), 0), ("u", 3, at(5), 0), ("u", 4, None, 0)], SCHEMA)
    assert sorted(r.event_id for r in cooldown(df, ["user"], "t", "5 minutes").collect()) == [1, 3]
    assert cooldown(df.limit(0), ["user"], "t", "5 minutes").collect() == []


def test_cooldown_needs_more_than_the_period(spark):
    df = spark.createDataFrame([("u", 1, at(0), 0), ("u", 2, at(300), 0), ("u", 3, at(300, 1), 0)], SCHEMA)
    assert sorted(r.event_id for r in cooldown(df, ["user"], "t", "5 minutes").collect()) == [1, 3]


@pytest.mark.parametrize("slice_rows", [1, 7, 40])
def test_busy_buckets_are_walked_in_slices(spark, slice_rows):
    data = [d for d in noisy(4, 500, span=4000) if d[0]]
    df = spark.createDataFrame(data, SCHEMA)
    measures = {"n": F.lit(1), "x": F.col("event_id").cast("decimal(20,2)")}
    whole, cut = (intervals.interval_totals(df, df, ["user"], "t", "t", "10 minutes", measures, slice_rows=n) for n in (10**6, slice_rows))
    assert rows(cut) == rows(whole)
    whole, cut = (intervals.trailing_distinct(df, ["user"], "v", "t", "10 minutes", slice_rows=n) for n in (10**6, slice_rows))
    assert rows(cut) == rows(whole)
    whole, cut = (intervals.running_count(df, ["user"], "t", ["event_id"], slice_rows=n) for n in (10**6, slice_rows))
    assert rows(cut) == rows(whole)


def test_no_slice_holds_much_of_a_hot_key(spark):
    # One user has all rows, in one bucket of the window.
    df = spark.range(20_000).select(F.lit("u").alias("user"), "id", F.lit(0).alias("b"), (F.col("id") * 1000).alias("at"))
    cut = intervals._in_slices(df, ["user", "b"], "at", F.lit(0), 20_000_000, {"n": F.count(F.lit(1))},
                               df.groupBy("user", "b").agg(F.count(F.lit(1)).alias("_n")), 500)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 600 and len(sizes) >= 35
