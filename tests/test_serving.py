"""Serving tables under many batches and replays; profiles that expire; attribution in order of arrival."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from conftest import T0, rows
from pyspark.sql import functions as F

from tiffinlake.operators.profiles import interest_profiles
from tiffinlake.sources.serving import ServingTable, appended, summed
from tiffinlake.sources.streams import file_sink, file_source, run_available
from tiffinlake.streaming import processors, profiles


def test_forty_batches_leave_few_folders_and_count_once(spark, base):
    table = ServingTable(spark, f"{base}/counters", "k string, n bigint", summed(["k"], ["n"]), every=4)
    want, most = {}, 0
    for i in range(40):
        batch = spark.createDataFrame([("all", 1), (f"k{i % 3}", i)], "k string, n bigint").coalesce(1)
        table.write(batch, i)
        if i in (5, 16, 39):
            table.write(batch, i)  # replayed at once
        if i == 20:
            table.write(spark.createDataFrame([("k0", 10_000)], "k string, n bigint"), 2)  # merged long ago
        for k, n in (("all", 1), (f"k{i % 3}", i)):
            want[k] = want.get(k, 0) + n
        most = max(most, len(table.folders()))
    assert {r["k"]: r["n"] for r in table.read().collect()} == want
    assert most <= 16 and len(table.folders()) <= 12
    assert table.read().agg(F.max("batch_id")).first()[0] == 39


def test_unfinished_folders_do_not_count(spark, base):
    from tiffinlake.sources.files import delete_path

    table = ServingTable(spark, f"{base}/log", "v int", appended, every=2)
    for i in range(2):
        table.write(spark.createDataFrame([(i,)], "v int"), i)
    assert rows(table.read().select("v")) == [(0,), (1,)]
    # A merge that was not committed: its parts still count, and the next batch merges them again.
    delete_path(spark, f"{base}/log/level1-0-1/_SUCCESS")
    assert rows(table.read().select("v")) == [(0,), (1,)]
    table.write(spark.createDataFrame([(2,)], "v int"), 2)
    assert rows(table.read().select("v")) == [(0,), (1,), (2,)]
    assert ServingTable(spark, f"{base}/none", "v int", appended).read().count() == 0
    with pytest.raises(ValueError):
        ServingTable(spark, base, "v int", appended, every=1)


def _files(spark, base, label, parts, schema):
    path = f"{base}/{label}"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return file_source(spark, path, spark.createDataFrame([], schema).schema, max_files=1)


def test_silent_profiles_expire_and_begin_anew(spark, base):
    day = lambda n: T0 + dt.timedelta(days=n)
    schema = "user_id bigint, item_id bigint, category string, event_type string, event_time timestamp_ntz"
    parts = [[(1, 7, "a", "order", day(0)), (2, 7, " a ", "click", day(0)), (0, 7, "a", "click", day(0)), (3, 0, " ", "view", day(0)), (4, 9, None, "click", day(0))],
             [(2, 8, "b", "view", day(5))], [(2, 8, "b", "other", day(9)), (1, 7, "a", "view", day(10))], [(1, 6, "a", "view", day(10))], [(5, 1, None, "view", day(11))]]
    updates = profiles.profile_updates(_files(spark, base, "signals", parts, schema))
    run_available(profiles.keep_profiles(updates, f"{base}/profiles", f"{base}/checkpoint", every=2))
    now = day(11)
    got = {(r["user_id"], r["item_id"]): r["score"] for r in profiles.current_profiles(spark, f"{base}/profiles", now).collect()}
    fade = lambda d: math.exp(-d * 1440 / 240)
    assert set(got) == {(1, 7), (1, 6), (2, 7), (2, 8), (5, 1)}  # user 4 is gone, user 3 never had an item
    # The order of day 0 went with user 1's expired profile.
    assert got[1, 7] == pytest.approx(1.5 * fade(1), rel=1e-9) and got[2, 8] == pytest.approx(1.5 * fade(6) + fade(2), rel=1e-9)
    named = profiles.current_profiles(spark, f"{base}/profiles", now, "category").where("user_id = 2")
    batch = interest_profiles(spark.createDataFrame(sum(parts, []), schema), now, "category").where("user_id = 2")
    assert {r["category"]: round(r["score"], 9) for r in named.collect()} == {r["category"]: round(r["score"], 9) for r in batch.collect()}


def test_a_profile_asks_its_state_as_often_for_a_thousand_targets_as_for_one():
    calls = []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    class Handle:
        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            calls.append("timer")

    def took(n):
        calls.clear()
        profile = profiles.InterestProfile(1000)
        profile.init(Handle())
        rows = [{"target": f"t{i % n}", "log_weight": float(i), "undated": 0.0, "at_us": i} for i in range(2 * n)]
        out = list(profile.handleInputRows((1, "item"), iter(rows), None))
        assert len(out) == n and out[0]["last_us"] == n and not out[0]["expired"]
        assert out[0]["log_sum"] == pytest.approx(math.log(1 + math.exp(n)) if n < 100 else n)
        return list(calls)

    assert took(1000) == took(1) == ["get", "timer", "update"]


def test_what_batches_add_to_a_profile_sums_up_in_any_merge(spark, base):
    hour = lambda n: T0 + dt.timedelta(hours=n)
    schema = "user_id bigint, item_id bigint, category string, event_type string, event_time timestamp_ntz"
    kinds = ["order", "click", "view", "impression", "other"]
    parts = [[(1, 7, "a", kinds[n], hour(20 * n)), (1, 7, "a", "view", hour(20 * n + 1)), (2, 5 + n, "b", kinds[n], hour(20 * n)), (None, 7, "a", "click", hour(20 * n))]
             for n in range(5)]
    parts[2].append((1, 7, "a", "order", None))  # no time: it does not fade
    parts[4].append((1, 8, "a", "order", None))
    now = hour(90)
    for every in (2, 8):
        path = f"{base}/profiles{every}"
        updates = profiles.profile_updates(_files(spark, base, f"signals{every}", parts, schema))
        run_available(profiles.keep_profiles(updates, path, f"{base}/checkpoint{every}", every=every))
        for kind, target in (("item", "item_id"), ("category", "category")):
            batch = interest_profiles(spark.createDataFrame(sum(parts, []), schema), now, kind)
            want = {(r["user_id"], r[target]): r["score"] for r in batch.collect()}
            got = {(r["user_id"], r[target]): r["score"] for r in profiles.current_profiles(spark, path, now, kind).collect()}
            assert got == pytest.approx(want, rel=1e-12)


class _Stores:
    """The state of one key and its timers, without a stream."""

    def __init__(self):
        self.timers, self.value, self.log = set(), {}, []

    def getValueState(self, name, schema):
        return type("Value", (), {"get": lambda _: self.value.get(name), "update": lambda _, v: self.value.__setitem__(name, v),
                                  "clear": lambda _: self.value.pop(name)})()

    def getListState(self, name, schema):
        return type("Log", (), {"get": lambda _: iter(self.log), "put": lambda _, v: self.__setattr__("log", list(v)),
                                "appendList": lambda _, v: self.log.extend(v), "clear": lambda _: self.__setattr__("log", [])})()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def fired(self, processor, key, now):
        for at in sorted(t for t in self.timers if t <= now):
            self.timers.remove(at)
            yield from processor.handleExpiredTimer(key, type("Times", (), {"getCurrentWatermarkInMs": lambda _: now})(), None)


def test_a_shard_ends_the_profiles_that_each_would_end_by_itself():
    rng, ttl = random.Random(7), 50_000
    stores, single, shard = {}, {}, profiles.ShardOfProfiles(ttl)
    shard.init(whole := _Stores())
    ended, longest = 0, 0
    for now in range(0, 2000, 10):  # milliseconds, the watermark after each batch
        batch = []
        for _ in range(rng.choice([0, 1, 5, 12]) if now % 400 < 200 else rng.choice([0, 0, 1])):
            at = rng.choice([0, (now + rng.randrange(10)) * 1000 + rng.randrange(1000)])
            batch.append((rng.randrange(1, 15), rng.choice([0, 3, 4]), rng.choice(["a", "b"]), 0.0, 0.0, at))
        if batch:
            columns = ["user_id", "item", "category", "log_sum", "undated", "last_us"]
            frames = [pd.DataFrame(batch[:3], columns=columns), pd.DataFrame(batch[3:], columns=columns)]
            passed = list(shard.handleInputRows((0,), iter([f for f in frames if len(f)]), None))
            assert [tuple(r)[:6] for f in passed for r in f.itertuples(index=False)] == batch
        for kind, column in (("item", 1), ("category", 2)):
            for user in {r[0] for r in batch if r[column]}:
                if (user, kind) not in single:
                    single[user, kind] = profiles.InterestProfile(ttl)
                    single[user, kind].init(stores.setdefault((user, kind), _Stores()))
                rows_of = [{"target": r[column], "log_weight": 0.0, "undated": 0.0, "at_us": r[5]} for r in batch if r[0] == user and r[column]]
                list(single[user, kind].handleInputRows((user, kind), iter(rows_of), None))
        want = sorted((r["user_id"], r["kind"], r["last_us"]) for key, profile in single.items() for r in stores[key].fired(profile, key, now))
        got = sorted((r.user_id, r.gone, r.last_us) for f in whole.fired(shard, (0,), now) for r in f.itertuples(index=False))
        assert got == want
        living = sum(bool(s.value) for s in stores.values())
        assert len(whole.timers) == (1 if living else 0)
        ended, longest = ended + len(got), max(longest, sum(len(users) for _, users, _ in whole.log))
    assert ended > 100 and longest <= 2 * 28


def test_users_share_state_and_a_micro_batch_is_added_up_before_it_is_written(spark, base):
    schema = "user_id bigint, item_id bigint, category string, event_type string, event_time timestamp_ntz"
    n = 4000
    parts = [[(u, 1 + u % 3, "a", "view", T0 + dt.timedelta(days=90 * i)) for u in range(1, n + 1) for i in range(2)]]
    updates = profiles.profile_updates(_files(spark, base, "signals", parts, schema))
    query = profiles.keep_profiles(updates, f"{base}/profiles", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    first = query.recentProgress[0]
    # Each user has two profiles; before, each of them had a state and a timer of its own.
    assert 0 < first.stateOperators[0].numRowsTotal <= 8 * profiles.SHARDS < 2 * 2 * n
    written = spark.read.parquet(f"{base}/profiles/level0-0-0")
    assert written.count() == 2 * 2 * n  # ninety days apart: two spans of logarithms
    now = T0 + dt.timedelta(days=90, hours=4)
    got = profiles.current_profiles(spark, f"{base}/profiles", now).agg(F.count("*"), F.min("score"), F.max("score")).first()
    assert got[0] == n and got[1] == pytest.approx(1.5 / math.e) and got[2] == pytest.approx(1.5 / math.e)


def test_weights_of_one_target_add_up_over_any_range(spark):
    logs = [float(x) for x in range(-3000, 3000, 37)] * 3 + [-math.inf, 255.999999, 256.0, -256.0]
    df = spark.createDataFrame([(1, "item", "7", x, 0.5, 9, False) for x in logs] + [(2, "item", "7", -math.inf, 2.0, 0, False), (2, "item", None, 0.0, 0.0, 5, True)],
                               "user_id bigint, kind string, target string, log_sum double, undated double, last_us bigint, expired boolean").repartition(5)
    for _ in range(2):  # what is added up adds up again
        df = profiles._added_up(df)
        found = [r for r in df.collect() if r["user_id"] == 1]
        high = max(r["log_sum"] for r in found)
        assert high + math.log(sum(math.exp(r["log_sum"] - high) for r in found)) == pytest.approx(max(logs) + math.log(sum(math.exp(x - max(logs)) for x in logs)), rel=1e-14)
        assert len(found) <= 6000 / 256 + 2 and sum(r["undated"] for r in found) == 0.5 * len(logs)
    assert sorted((r["log_sum"], r["undated"], r["last_us"], r["expired"]) for r in df.collect() if r["user_id"] == 2) == [(-math.inf, 2.0, 0, False), (0.0, 0.0, 5, True)]


def test_late_clicks_are_not_credited_to_earlier_orders(spark, base):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    schema = "kind string, id string, user_id bigint, item_id bigint, event_timestamp timestamp_ntz"
    parts = [[("click", None, 1, 1, at(0)), ("order", "same instant", 1, 1, at(0)), ("order", "before", 2, 1, at(5))],
             [("click", None, 2, 1, at(1)), ("order", "after", 2, 1, at(31)), ("order", "too late", 1, 1, at(31)), ("order", "no user", None, 1, at(3))],
             [("order", "out of order", 1, 1, at(30)), ("click", None, 3, 1, at(9)), ("order", "click later", 3, 1, at(8))]]
    stream = _files(spark, base, "arrivals", parts, schema)
    orders = stream.where("kind = 'order'").select("id", "user_id", "item_id", "event_timestamp")
    clicks = stream.where("kind = 'click'").select("user_id", "item_id", "event_timestamp", F.lit("click").alias("event_type"))
    out = processors.attribution_by_arrival(orders, clicks, "30 minutes", delay="1 hour")
    run_available(file_sink(out, f"{base}/out", f"{base}/checkpoint"))
    got = {r["id"]: r["attributed"] for r in spark.read.schema(out.schema).parquet(f"{base}/out").collect()}
    assert got == {"same instant": True, "before": False, "after": True, "too late": False, "out of order": True, "click later": False}


def test_a_failed_batch_leaves_nothing_visible(spark, base):
    import os

    from tiffinlake.sources.sinks import committed_sink, read_committed

    spark.range(200).repartition(4).write.parquet(f"{base}/in")
    os.makedirs(f"{base}/marks")
    mark = f"{base}/marks/failed"

    def flaky(frames):
        for frame in frames:
            if 7 in set(frame["id"]) and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost")
            yield frame

    schema = spark.range(0).schema
    job = lambda: committed_sink(file_source(spark, f"{base}/in", schema).mapInPandas(flaky, "id long"), f"{base}/out", f"{base}/cp")
    with pytest.raises(Exception, match="lost"):
        run_available(job())
    assert read_committed(spark, f"{base}/out", schema).count() == 0
    run_available(job())
    got = read_committed(spark, f"{base}/out", schema)
    assert sorted(r["id"] for r in got.collect()) == list(range(200)) and got.select("batch").distinct().count() == 1


def test_state_left_after_timers(spark, base):
    from tiffinlake.streaming.state import state_left

    at = lambda m: T0 + dt.timedelta(minutes=m)
    stream = _files(spark, base, "seen", [[("a", at(0)), ("b", at(0))], [("b", at(50))], [("c", at(65))]], "user_id string, t timestamp")
    out = processors.inactive_keys_stream(stream, "user_id", "t", "30 minutes")
    run_available(file_sink(out, f"{base}/out", f"{base}/cp"))
    assert {r["key"]["key"] for r in state_left(spark, f"{base}/cp", "last").collect()} == {"b", "c"}
