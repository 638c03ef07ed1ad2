"""Fraud rules against per-event state machines, on data with a hot user and a hot device."""

import random
from collections import defaultdict

import pytest
from conftest import T0, at, rows
from pyspark.sql import functions as F

from tiffinlake.operators import alerts, fraud

SCHEMA = "event_id int, user_id int, device_id string, order_id string, amount double, city string, event_time timestamp_ntz"


def transactions(seed, n=500):
    r = random.Random(seed)
    times = sorted(r.sample(range(6000), n))
    return [(i, None if r.random() < .02 else (1 if r.random() < .4 else r.randrange(2, 8)), "d0" if r.random() < .4 else f"d{r.randrange(1, 5)}", f"o{i}",
             float(r.randrange(1000, 2000)), "ABC"[0 if r.random() < .8 else r.randrange(3)], at(t)) for i, t in enumerate(times)]


@pytest.mark.parametrize("seed", range(3))
def test_rules_equal_the_state_machines(spark, seed):
    data = transactions(seed)
    df = spark.createDataFrame(data, SCHEMA)
    velocity, sharing, geo = {}, {}, {}
    times, users, cities = defaultdict(list), defaultdict(dict), defaultdict(dict)
    for i, user, device, _, _, city, when in data:
        if user is None:
            continue
        t = (when - T0).total_seconds()
        times[user] = [x for x in times[user] if x >= t - 300] + [t]
        if len(times[user]) > 3:
            velocity[i] = len(times[user])
        users[device] = {u: x for u, x in users[device].items() if x >= t - 300}
        users[device][user] = t
        if len(users[device]) > 3:
            sharing[i] = sorted(map(str, users[device]))
        recent = {c: x for c, x in cities[user].items() if x >= t - 600}
        if recent and city not in recent:
            geo[i] = sorted(recent)
        recent[city] = t
        cities[user] = recent
    assert velocity and sharing and geo
    assert {int(r.event_id): r.order_count for r in fraud.velocity_alerts(df).collect()} == velocity
    shared = fraud.device_sharing_alerts(df)
    assert {int(r.event_id): r.unique_users for r in shared.collect()} == {i: len(u) for i, u in sharing.items()}
    members = defaultdict(list)
    for r in fraud.device_users(shared, df).collect():
        members[int(r.event_id)].append(r.member)
    assert {i: sorted(u) for i, u in members.items()} == sharing
    assert {int(r.event_id): r.previous_cities for r in fraud.geo_anomaly_alerts(df).collect()} == geo


def test_thresholds(spark):
    df = spark.createDataFrame([(1, 1, "d", "o", 1500.0, "A", at(0)), (2, 1, "d", "o", 1500.01, "A", at(9))], SCHEMA)
    assert [r.event_id for r in fraud.high_value_alerts(df).collect()] == ["2"]
    assert fraud.high_value_alerts(df, inclusive=True).count() == 2


def test_velocity_bounds(spark):
    def count(times, **options):
        data = [(i, 1, "d", "o", 1.0, "A", t) for i, t in enumerate(times)]
        return len(fraud.velocity_alerts(spark.createDataFrame(data, SCHEMA), **options).collect())

    four = [at(0), at(100), at(200), at(300)]
    assert count(four) == 1 and count(four, lower="open") == 0
    assert count([at(0), at(100), at(200), at(300, 1)]) == 0


def test_simultaneous_events_see_each_other(spark):
    df = spark.createDataFrame([(i, 1, "d", "o", 1.0, "AB"[i % 2], at(0)) for i in range(4)], SCHEMA)
    assert {r.order_count for r in fraud.velocity_alerts(df).collect()} == {4}
    assert fraud.geo_anomaly_alerts(df).count() == 4


def test_union_and_records(spark):
    df = spark.createDataFrame(transactions(1), SCHEMA)
    union = fraud.union_alerts(fraud.velocity_alerts(df), fraud.device_sharing_alerts(df), fraud.high_value_alerts(df), fraud.geo_anomaly_alerts(df))
    record = fraud.alert_records(union).where("alert_type = 'GEO_ANOMALY_FRAUD'").first()
    assert '"previous_cities":[' in record.alert_data and record.detected_at > 1_700_000_000_000
    assert alerts.high_severity(union).where("severity = 'MEDIUM'").count() == 0
    stats = {(r.section, r.label): (r.position, r.n) for r in alerts.alert_stats(union, at(6000)).collect()}
    assert stats[("by_severity", "CRITICAL")][0] == 1 and stats[("by_severity", "MEDIUM")][0] == 3
    assert stats[("total", "all")][1] == union.count()


def test_spikes_need_to_hold(spark):
    burst = [(at(60 * m + s),) for m in range(10, 30) for s in range(5)]
    df = spark.createDataFrame(burst, "detected_at timestamp_ntz")
    got = [(r.minute - T0).total_seconds() / 60 for r in alerts.alert_spikes(df, 20).orderBy("minute").collect()]
    # An alert on the full minute belongs to that evaluation, later ones to the next.
    counts = {m: sum((m - 10) * 60 < (t[0] - T0).total_seconds() <= m * 60 for t in burst) for m in range(60)}
    want = [m for m in range(60) if all(counts.get(x, 0) > 20 for x in range(m - 5, m + 1))]
    assert got == want and want
    assert rows(alerts.alert_spikes(df, 1000)) == []


def _by_files(spark, base, groups, stream):
    """Rows that ``stream`` emits if each group of rows is one file and one micro-batch."""
    from tiffinlake.sources.streams import file_sink, file_source, run_available
    for part in groups:
        df = spark.createDataFrame(part, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        run_available(file_sink(stream(file_source(spark, f"{base}/in", df.schema)), f"{base}/out", f"{base}/cp"))
    return spark.read.parquet(f"{base}/out")


def test_a_late_row_is_judged_by_the_window_before_it(spark, base):
    from tiffinlake.streaming.processors import device_sharing_stream
    row = lambda i, user, t: (i, user, "d", f"o{i}", 1.0, "A", at(t))
    early, late = [row(i, i, 100 + i) for i in range(3)], [row(9, 9, 50)]
    out = _by_files(spark, base, [early, late, [row(10, 10, 200)]], lambda df: device_sharing_stream(df, window="5 minutes"))
    # The late user sees nobody before it, and counts for the last row.
    assert [(r.event_id, r.user_ids) for r in out.collect()] == [("10", ["0", "1", "10", "2", "9"])]


@pytest.mark.parametrize("name", ["velocity", "device", "cooldown"])
def test_state_ends_with_the_window(spark, base, name):
    """Nothing of the first files is left when the watermark is a window past them."""
    from tiffinlake.streaming import processors
    row = lambda i, t: (i, 1 if t < 1000 else 2, "d" if t < 1000 else "e", f"o{i}", 1.0, "A", at(t))
    groups = [[row(1, 0), row(2, 10)], [row(3, 5000)], [row(4, 9000)]]
    rules = {"velocity": (lambda df: processors.velocity_stream(df, window="5 minutes", delay="1 second"), "seen"),
             "device": (lambda df: processors.device_sharing_stream(df, window="5 minutes", delay="1 second"), "seen"),
             "cooldown": (lambda df: processors.cooldown_stream(df, ["user_id"], "event_time", delay="1 second"), "last")}
    stream, variable = rules[name]
    _by_files(spark, base, groups, stream)
    left = spark.read.format("statestore").option("stateVarName", variable).load(f"{base}/cp")
    keys = [r[0] for r in left.select("key.*").distinct().collect()]
    assert keys == [2 if name != "device" else "e"]


def test_streams_keep_the_time_type(spark, base):
    from tiffinlake.streaming.processors import velocity_stream
    out = _by_files(spark, base, [[(i, 1, "d", "o", 1.0, "A", at(i)) for i in range(5)]], velocity_stream)
    assert dict(out.dtypes)["detected_at"] == "timestamp_ntz" and out.count() == 2


class _Held:
    """A state variable and its handle in one; a call that is not here fails."""

    def __init__(self, rows=()):
        self.rows, self.timers, self.calls = list(rows), [], 0

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls += 1
        self.rows = list(rows)

    def appendList(self, rows):
        self.calls += 1
        self.rows += rows

    def getListState(self, name, schema):
        return self

    def registerTimer(self, at_ms):
        self.calls += 1
        self.timers.append(at_ms)

    def getCurrentWatermarkInMs(self):
        return 0


def test_lists_of_a_crowded_device_come_in_pieces(monkeypatch):
    import pandas as pd

    from tiffinlake.streaming.processors import LongTrailingMembers
    monkeypatch.setattr(LongTrailingMembers, "PIECE", 60)
    held, rule = _Held(), LongTrailingMembers(1000, 3)
    rule.init(held)
    frame = pd.DataFrame({"event_id": range(50), "member": [str(i) for i in range(50)], "at_us": range(50)})
    pieces = list(rule.handleInputRows(("d",), iter([frame[25:], frame[:25]]), held))
    assert len(pieces) > 10 and max(sum(map(len, p["members"])) for p in pieces) < 60 + 50
    got = {i: m for p in pieces for i, m in zip(p["event_id"], p["members"])}
    assert got == {i: sorted(str(k) for k in range(i + 1)) for i in range(3, 50)}


def test_a_key_without_news_costs_three_calls():
    from pyspark.sql import Row

    from tiffinlake.streaming.processors import TrailingCount, TrailingMembers
    for rule in (TrailingCount(1000, 3), TrailingMembers(1000, 1, new_only=True)):
        held = _Held()
        rule.init(held)
        came = [Row(event_id=2, member="b", at_us=20), Row(event_id=1, member="a", at_us=10)]
        out = list(rule.handleInputRows((1,), iter(came), held))
        assert held.calls == 3 and sorted(t for _, t in held.rows) == [10, 20]
        assert [(r.event_id, r.members) for r in out] == ([] if isinstance(rule, TrailingCount) else [(2, ["a", "b"])])


def test_rules_read_stored_transactions(spark):
    from workload import all_queries

    for name in ("alert_union", "device_sharing_users"):
        plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "get_json_object" not in plan and "props" not in plan


def test_cooldowns_of_a_shard_equal_those_of_each_key():
    import numpy as np

    from tiffinlake.streaming.processors import _greedy
    r = random.Random(3)
    # Many short lines and a long one, of which the last steps are walked alone; with and without an instant that passed before.
    for span, keys in ((400, 60), (2 ** 58, 60), (400, 3)):
        data = sorted({(0 if r.random() < .3 else r.randrange(keys), r.randrange(span)) for _ in range(1500)})
        codes, at_us = (np.array(x, dtype="int64") for x in zip(*data))
        codes = np.unique(codes, return_inverse=True)[1]
        fresh, last = (np.array([r.random() < .5 for _ in range(codes.max() + 1)]), np.array([r.randrange(-span, span) for _ in range(codes.max() + 1)], dtype="int64"))
        want = {int(k): None if fresh[k] else int(last[k]) for k in codes}
        expected = []
        for i, (k, t) in enumerate(zip(codes.tolist(), at_us.tolist())):
            if want[k] is None or t > want[k] + span // 20:
                expected.append(i)
                want[k] = t
        assert sorted(_greedy(codes, at_us, fresh, last, span // 20).tolist()) == expected


def test_cooldown_by_shards_calls_its_state_once_a_shard(monkeypatch):
    """However many keys a shard has; what it passes is what each key's own cooldown would."""
    import pandas as pd

    from tiffinlake.streaming import processors

    class Store:
        def __init__(self):
            self.calls, self.state, self.timers = 0, {}, set()

        def of(self, name):
            def act(kind):
                def call(*args):
                    self.calls += 1
                    held = self.state.get(name)
                    if kind == "get":
                        return iter(held or []) if name == "last" else held
                    self.state[name] = {"put": lambda x: list(x), "update": lambda x: x, "appendList": lambda x: [*(held or []), *x], "clear": lambda: None}[kind](*args)
                return call
            return type("Variable", (), {k: staticmethod(act(k)) for k in ("get", "put", "update", "appendList", "clear")})

        def getListState(self, name, schema):
            return self.of(name)

        getValueState = getListState
        registerTimer = lambda self, t: self.timers.add(t)
        deleteTimer = lambda self, t: self.timers.remove(t)
        watermark = 0
        getCurrentWatermarkInMs = lambda self: self.watermark

    monkeypatch.setattr(processors.ShardOfCooldowns, "ENTRY", 7)
    r = random.Random(8)
    store, rule = Store(), processors.ShardOfCooldowns(50_000, ["cooldown_key", "at_us", "event_id"])
    rule.init(store)
    passed = []
    for part in range(5):
        rows_ = [(f"k{r.randrange(200)}", 1000 * r.randrange(part * 100, part * 100 + 110), r.choice([None, *map(str, range(9))])) for _ in range(600)]
        frame = pd.DataFrame(rows_, columns=["cooldown_key", "at_us", "event_id"])
        store.calls = 0
        out = pd.concat(rule.handleInputRows((0,), iter([frame[:200], frame[200:]]), store))
        assert store.calls <= 4
        sent = sorted(rows_, key=lambda x: (x[1], x[2] is None, x[2]))
        last = {k: max(t for key, t, _ in passed if key == k) for k in {key for key, _, _ in passed}}
        want = []
        for key, t, i in sent:
            if key not in last or t > last[key] + 50_000:
                want.append((key, t, i))
                last[key] = t
        assert sorted(map(repr, out.itertuples(index=False, name=None))) == sorted(map(repr, want))
        passed += want
    # What no row can see any more goes with the timer, the rest stays; then nothing is left.
    newest = max(t for _, t, _ in passed)
    for store.watermark, left in ((newest // 1000 + 40, True), (newest // 1000 + 60, False)):
        store.timers.clear()
        list(rule.handleExpiredTimer((0,), store, None))
        held = {k: t for keys, last in (store.state["last"] or []) for k, t in zip(keys, last)}
        assert bool(held) == left == bool(store.timers) and all(t >= store.watermark * 1000 - 50_000 for t in held.values())


def test_cooldown_stream_by_shards_over_several_files(spark, base):
    """Keys of two columns with nulls, large whole numbers beside nulls, ties, rows without a time."""
    from tiffinlake.streaming.processors import cooldown_stream
    r = random.Random(4)
    big = 2 ** 60 + 1
    made = [(None if (u := r.randrange(6)) == 5 else u, r.choice([None, "d", "1:d"]), None if i % 3 else big + i, f"e{i:03d}", None if i == 7 else at(r.randrange(200) + 200 * (i // 100)))
            for i in range(300)]
    schema = "user_id int, device_id string, amount bigint, event_id string, detected_at timestamp_ntz"
    for label, shards in (("keys", None), ("shards", 3)):
        for part in range(3):
            some = [x for x in made[part * 100:part * 100 + 100] if x[4] is not None or shards]
            spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{base}/{label}/in")
        from tiffinlake.sources.streams import file_sink, file_source, run_available
        stream = file_source(spark, f"{base}/{label}/in", spark.read.parquet(f"{base}/{label}/in").schema, max_files=1)
        run_available(file_sink(cooldown_stream(stream, ["user_id", "device_id"], period="1 minute", shards=shards), f"{base}/{label}/out", f"{base}/{label}/cp"))
    by_key, by_shard = (spark.read.parquet(f"{base}/{label}/out") for label in ("keys", "shards"))
    assert by_key.dtypes == by_shard.dtypes and rows(by_key) == rows(by_shard)
    assert {x for x in made if x[2] is not None} >= {tuple(x) for x in by_shard.where("amount is not null").collect()}
    assert 20 < by_shard.count() < 300


def test_users_meet_alerts_in_bounded_lists(spark, monkeypatch):
    """A crowded device: alerts are joined with lists of users, of which those of another time are left whole."""
    monkeypatch.setattr(fraud, "CROWD", 50)
    r = random.Random(6)
    data = [(i, None if i % 50 == 0 else r.randrange(400), None if i % 70 == 0 else "d" if i % 9 else "e", f"o{i}", 1.0, "A", at(r.randrange(1500))) for i in range(1200)]
    df = spark.createDataFrame(data, SCHEMA)
    shared = fraud.device_sharing_alerts(df)
    want = {(str(i), d, str(u)) for i, user, d, _, _, _, t in data if user is not None and d is not None
            for _, u, e, _, _, _, x in data if u is not None and e == d and 0 <= (t - x).total_seconds() <= 300}
    alerted = {x.event_id for x in shared.collect()}
    assert rows(fraud.device_users(shared, df)) == sorted((x for x in want if x[0] in alerted), key=repr)
    seen = fraud.presence(df.select("device_id", F.col("user_id").cast("string").alias("member"), "event_time"), ["device_id"], "member", "event_time", "5 minutes")
    lists = fraud._crowds(seen, 300_000_000).select("*", F.size("crowd").alias("n")).collect()
    assert max(x.n for x in lists) <= 50 and len(lists) < seen.count() / 4
    # No entry lies outside the instants that its list names.
    assert all(x.first_us == min(u.us for u in x.crowd) and x.last_us == max(u.us for u in x.crowd) for x in lists)


@pytest.mark.parametrize("run", [4, 10_000])
def test_users_as_stretches_become_the_same_lists(spark, base, monkeypatch, run):
    """Several files, late rows among them, and rows of one instant; rows without a device or a time are on no device."""
    from tiffinlake.streaming import processors
    monkeypatch.setattr(processors.StretchesOfMembers, "RUN", run)
    r = random.Random(9)
    groups = [[(i, None if i % 40 == 0 else r.randrange(30), f"d{r.randrange(3)}", f"o{i}", 1.0, "A", at(r.randrange(k * 300, k * 300 + 500)))
               for i in range(k * 200, k * 200 + 200)] for k in range(3)]
    nowhere = lambda k: [(i, i % 9, None if i % 2 else "d1", "o", 1.0, "A", at(k * 300 + i % 60) if i % 2 else None) for i in range(1000 + k * 20, 1020 + k * 20)]
    lists = _by_files(spark, f"{base}/lists", groups, lambda df: processors.device_sharing_stream(df))
    stored = _by_files(spark, f"{base}/stretches", [part + nowhere(k) for k, part in enumerate(groups)], lambda df: processors.device_sharing_stream(df, users="stretches"))
    got = processors.with_user_lists(stored)
    assert got.columns == lists.columns and rows(got) == rows(lists) and lists.count() > 300
    assert stored.where("users is not null").count() == stored.select("run").distinct().count()


def test_users_of_a_crowded_device_are_told_once_a_run(monkeypatch):
    import pandas as pd

    from tiffinlake.streaming.processors import StretchesOfMembers
    monkeypatch.setattr(StretchesOfMembers, "RUN", 100)
    held, rule = _Held(), StretchesOfMembers(1000, 3)
    rule.init(held)
    frame = pd.DataFrame({"event_id": range(4000), "member": [str(i % 1500) for i in range(4000)], "at_us": range(4000)})
    out = pd.concat(rule.handleInputRows(("d",), iter([frame[2500:], frame[:2500]]), held))
    assert out["event_id"].tolist() == list(range(3, 4000)) and out["n"].tolist() == [min(i, 1000) + 1 for i in range(3, 4000)]
    # As lists they would be millions; each run has at most two windows of them.
    assert out["users"].dropna().map(len).sum() < 4 * 4000 and out["run"].nunique() == out["users"].notna().sum()
    for _, part in out.groupby("run"):
        users, come, gone = (part[c].dropna().iloc[0] for c in ("users", "come", "gone"))
        for t in part["at_us"]:
            assert sorted(u for u, a, b in zip(users, come, gone) if a <= t <= b) == sorted({str(i % 1500) for i in range(max(0, t - 1000), t + 1)})


def test_numbered_devices_stay_apart_beside_a_null_one(spark, base):
    from tiffinlake.streaming.processors import device_sharing_stream, with_user_lists
    df = [(i, i, None if i % 5 == 0 else i % 4, at(i)) for i in range(40)]
    spark.createDataFrame(df, "event_id int, user_id int, device_id bigint, event_time timestamp_ntz").selectExpr(
        "*", "'o' as order_id", "1.0D as amount", "'A' as city").coalesce(1).write.parquet(f"{base}/in")
    from tiffinlake.sources.streams import file_sink, file_source, run_available
    stream = file_source(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema)
    run_available(file_sink(device_sharing_stream(stream, users="stretches"), f"{base}/out", f"{base}/cp"))
    got = {int(x.event_id): x.user_ids for x in with_user_lists(spark.read.parquet(f"{base}/out")).collect()}
    want = {i: sorted(str(j) for j, _, e, _ in df if e == d and j <= i) for i, _, d, _ in df if d is not None}
    assert got == {i: users for i, users in want.items() if len(users) > 3} and got
