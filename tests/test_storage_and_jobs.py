"""Sinks are idempotent, merges keep what they must, and jobs can be run twice."""

import datetime as dt
import json

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tiffinlake.operators.delivery import build_events
from tiffinlake.plans import behaviour_daily, delivery_hourly, realtime, reconciliation
from tiffinlake.schemas import DELIVERY_CSV, TRANSACTION
from tiffinlake.session import scratch, shared_root
from tiffinlake.sources import files, tables
from tiffinlake.sources.streams import file_source, run_available
from tiffinlake.streaming import ingest

HOUR = dt.datetime(2024, 3, 1, 10)


def deliveries(spark, n=40):
    out = []
    for i in range(n):
        row = {c: None for c in DELIVERY_CSV.names}
        row.update({"ID": f"D{i}", "Order_Date": "01-03-2024", "Time_Orderd": "09:30", "City": "Urban" if i % 2 else "Metro", "Type_of_vehicle": "bike",
                    "Weather_conditions": "Sunny", "Delivery_person_Ratings": "4.5", "Festival": "No", "multiple_deliveries": "1.0", "Time_taken (min)": str(10 + i * 10)})
        out.append(tuple(row[c] for c in DELIVERY_CSV.names))
    return spark.createDataFrame(out, DELIVERY_CSV)


def test_delivery_job_runs_twice_with_the_same_result(spark, base):
    events = build_events(deliveries(spark), HOUR + dt.timedelta(minutes=5))
    files.write_bronze_jsonl(events.unionByName(events), base)
    first = delivery_hourly.run(spark, base, HOUR, HOUR)
    assert first == {"bronze_rows": 80, "silver_rows": 40, "valid_rows": 29, "duplicates": 40}
    before = rows(spark.read.parquet(f"{base}/gold/delivery_metrics"))
    delivery_hourly.run(spark, base, HOUR, HOUR)
    assert rows(spark.read.parquet(f"{base}/gold/delivery_metrics")) == before and len(before) == 4
    assert spark.read.parquet(f"{base}/gold/hourly_summary").count() == 1
    assert delivery_hourly.run(spark, base, HOUR - dt.timedelta(days=1), HOUR)["bronze_rows"] == 0


def bronze_tables(spark, base):
    day = F.to_date("event_timestamp").alias("partition_date")
    orders = spark.range(200).select(
        F.col("id").cast("string").alias("event_id"), F.concat(F.lit("o"), "id").alias("order_id"), (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 3).alias("item_id"), F.lit("food").alias("item_name"), F.lit(10).cast("decimal(12,2)").alias("price"), F.lit("s").alias("session_id"),
        (F.lit(at(0)) + F.make_dt_interval(mins=(F.col("id") * 20).cast("int"))).alias("event_timestamp"), F.concat(F.lit("i"), "id").alias("ingestion_id"))
    clicks = spark.range(300).select(
        F.col("id").cast("string").alias("event_id"), (F.col("id") % 7).alias("user_id"), (F.col("id") % 3).alias("item_id"), F.lit("s").alias("session_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("impression").alias("event_type"),
        (F.lit(at(0)) + F.make_dt_interval(mins=(F.col("id") * 13).cast("int"))).alias("event_timestamp"), F.concat(F.lit("i"), "id").alias("ingestion_id"))
    tables.write_table(orders.unionByName(orders).select("*", day), f"{base}/bronze/orders", ["partition_date"])
    tables.write_table(clicks.select("*", day), f"{base}/bronze/clicks", ["partition_date"])


def test_behaviour_job_is_idempotent_per_day(spark, base):
    bronze_tables(spark, base)
    days = [r.partition_date for r in behaviour_daily.bronze_dates(spark, base).collect()]
    assert days == [dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)]
    for day in [days[0], days[1], days[0]]:
        behaviour_daily.run(spark, base, day, HOUR)
    gmv = {r.date: r.order_count for r in spark.read.parquet(f"{base}/gold/daily_gmv").collect()}
    assert gmv == {days[0]: 72, days[1]: 72}
    assert spark.read.parquet(f"{base}/gold/ads_attribution").count() == 6
    flagged = behaviour_daily.silver_orders(tables.read_table(spark, f"{base}/bronze/orders", days[0]), HOUR, duplicates="flag")
    assert flagged.where("is_duplicate").count() == 72


def test_reconciliation_job_settles(spark, base):
    bronze_tables(spark, base)
    as_of = dt.datetime(2024, 3, 2, 12, 40)
    assert reconciliation.run(spark, base, as_of).count() > 0
    assert reconciliation.run(spark, base, as_of).count() == 0
    assert spark.read.parquet(f"{base}/recon/hourly_totals").agg(F.max("date_hour")).first()[0] < dt.datetime(2024, 3, 2, 12)


def test_merges(spark, base):
    schema = "d date, k int, v int"
    day, other = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    tables.write_table(spark.createDataFrame([(day, 1, 1), (day, 2, 1), (other, 3, 1), (None, 4, 1)], schema), base, ["d"])
    source = spark.createDataFrame([(day, 2, 9), (day, 5, 9), (None, 4, 9)], schema)
    tables.merge_insert(source, base, ["d", "k"], ["d"])
    assert {(r.k, r.v) for r in spark.read.parquet(base).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 9)}
    for _ in range(2):
        tables.merge_upsert(source, base, ["d", "k"], ["d"])
        assert sorted((r.k, r.v) for r in spark.read.parquet(base).collect()) == [(1, 1), (2, 9), (3, 1), (4, 9), (5, 9)]


def test_dimension_from_a_json_array(spark, base):
    from tiffinlake.schemas import FOODS
    spark.createDataFrame([(json.dumps([{"food_id": i, "name": f"n{i}", "category": "c", "price": 2.5, "is_available": True} for i in range(3)]),)],
                          "v string").coalesce(1).write.text(base)
    out = files.load_dimension(spark, base, FOODS, scratch(spark, "foods"))
    assert out.count() == 3 and float(out.first().price) == 2.5


def test_paths(spark):
    assert files.partition_path("b", "silver", 2024, 3, 1, 9) == "b/silver/year=2024/month=03/day=01/hour=09"
    assert scratch(spark, "x").startswith(shared_root(spark))


def test_order_time_feeds_the_envelope(spark):
    event = build_events(deliveries(spark, 1), HOUR).first()
    assert event.event_id == "D0_20240301100000000000" and event.event_time == "2024-03-01T09:30:00"


def transactions(spark):
    import random
    r = random.Random(5)
    out = []
    for i, t in enumerate(sorted(r.sample(range(20000), 300))):
        out.append((f"e{i:04d}", f"u{0 if r.random() < .5 else r.randrange(5)}", f"d{r.randrange(3)}", "web", f"o{i}", float(r.randrange(2000)), "r", "ABC"[r.randrange(3)],
                    "UPI", False, 1_700_000_000_000 + t * 1000, "normal"))
    return spark.createDataFrame(out, TRANSACTION).withColumn("event_time", F.timestamp_millis("event_time"))


def test_fraud_jobs_in_several_batches_equal_the_batch_rules(spark, base):
    """Files arrive in time order over several micro-batches; the state carries over."""
    from tiffinlake.operators import fraud
    tx = transactions(spark)
    size = 100
    numbered = tx.withColumn("n", F.substring("event_id", 2, 9).cast("int"))
    arriving = f"{base}/arriving"
    for i in range(3):
        part = numbered.where(F.col("n").between(i * size, (i + 1) * size - 1)).drop("n")
        part.coalesce(1).write.mode("append").parquet(arriving)
        run_available(realtime.rules_job(file_source(spark, arriving, tx.schema), f"{base}/alerts", f"{base}/cp-rules"))
        stored = file_source(spark, f"{base}/alerts", spark.read.parquet(f"{base}/alerts").schema)
        run_available(realtime.cooldown_job(stored, f"{base}/store", f"{base}/cp-cooldown"))
    batch = fraud.union_alerts(fraud.velocity_alerts(tx), fraud.device_sharing_alerts(tx), fraud.high_value_alerts(tx), fraud.geo_anomaly_alerts(tx))
    common = fraud.ALERT_COLUMNS
    assert rows(spark.read.parquet(f"{base}/alerts").select(*common)) == rows(batch.select(*common))
    passed = realtime.replay_cooldown(batch.select(*common))
    assert rows(ingest.alert_log(spark, f"{base}/store").read().select("alert_type", "event_id")) == rows(passed.select("alert_type", "event_id"))


def test_processing_time_cooldown_passes_one_per_key(spark, base):
    from tiffinlake.sources.streams import file_sink
    from tiffinlake.streaming.processors import cooldown_stream
    alerts = spark.createDataFrame([(f"e{i}", "k" if i < 5 else "l", at(i * 1000)) for i in range(8)], "event_id string, key string, detected_at timestamp_ntz")
    alerts.write.parquet(f"{base}/in")
    out = cooldown_stream(file_source(spark, f"{base}/in", alerts.schema), ["key"], clock="processing")
    run_available(file_sink(out, f"{base}/out", f"{base}/cp"), single_batch=True)
    assert rows(spark.read.parquet(f"{base}/out").select("event_id")) == [("e0",), ("e5",)]


def test_late_click_within_the_delay_is_credited(spark, base):
    """The order arrives a batch before its click."""
    click = spark.createDataFrame([("click", 1, 5, at(0))], "event_type string, user_id int, item_id int, event_timestamp timestamp")
    order = spark.createDataFrame([("o", 1, 5, at(60))], "order_id string, user_id int, item_id int, event_timestamp timestamp")
    order.write.parquet(f"{base}/orders")
    click.limit(0).write.parquet(f"{base}/clicks")
    job = lambda: realtime.attribution_job(
        file_source(spark, f"{base}/orders", order.schema), file_source(spark, f"{base}/clicks", click.schema), f"{base}/out", f"{base}/cp", delay="1 hour")
    run_available(job())
    click.write.mode("append").parquet(f"{base}/clicks")
    run_available(job())
    assert [r.order_id for r in spark.read.parquet(f"{base}/out").collect()] == ["o"]


def test_replace_computes_once_and_empties_escaped_partitions(spark, base):
    from tiffinlake.sources.files import files_by_folder, partition_folder
    from tiffinlake.sources.tables import replace_partition, write_table

    path = f"{base}/replace"
    old = spark.createDataFrame([(1, None), (2, "a:b"), (3, "c/d"), (4, "e")], "id int, k string")
    write_table(old, path, ["k"])
    passed = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            passed.add(len(frame))
            yield frame

    new = spark.createDataFrame([(5, "e"), (6, "f")], "id int, k string").mapInPandas(count, "id int, k string")
    replace_partition(new, path, ["k"], [{"k": None}, {"k": "a:b"}, {"k": "e"}, {"k": "never there"}])
    assert passed.value == 2
    assert {(r["id"], r["k"]) for r in spark.read.schema("id int, k string").parquet(path).collect()} == {(3, "c/d"), (5, "e"), (6, "f")}
    assert len(files_by_folder(spark, path)) == 3
    with pytest.raises(ValueError):
        partition_folder(spark, path, ["a", "b"], {"b": 1})


def test_leading_columns_name_all_below(spark, base):
    from tiffinlake.sources.tables import replace_partition, write_table

    path = f"{base}/below"
    write_table(spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, 2, "x")], "id int, hour int, kind string"), path, ["hour", "kind"])
    replace_partition(spark.createDataFrame([(9, 1, "x")], "id int, hour int, kind string"), path, ["hour", "kind"], [{"hour": 1}])
    assert {r["id"] for r in spark.read.parquet(path).collect()} == {9, 3}


def test_bronze_files_are_small_on_disk_and_bounded(spark, base, monkeypatch):
    import glob
    import os

    monkeypatch.setitem(files.BRONZE_FILES, "maxRecordsPerFile", "4000")
    sent = spark.range(10_000).select(F.col("id").cast("string").alias("event_id"), F.lit("2024-03-01T05:00:00").alias("ingestion_time"),
                                      F.lit("2024-03-01T04:00:00").alias("event_time"))
    files.write_bronze_jsonl(sent, base)
    stored = glob.glob(f"{base}/bronze/*/*/*/*/part-*")
    lines = sent.select(F.sum(F.length(F.to_json(F.struct("*"))) + 1)).first()[0]
    # Compressed files do not split, so none may hold more records than named.
    assert sum(map(os.path.getsize, stored)) < lines / 3 and all(p.endswith(".json.gz") for p in stored)
    assert max(spark.read.json(p).count() for p in stored) <= 4000
    assert files.read_bronze(spark, base).select("event_id").distinct().count() == 10_000


def test_gold_and_silver_are_computed_once_and_written_twice(spark, monkeypatch):
    from workload import all_queries, storage

    written = []
    write = files.write_gold
    monkeypatch.setattr(storage.files, "write_gold", lambda df, path, keys, **options: (written.append(df), write(df, path, keys, **options)))
    for name in ("silver_overwrite", "gold_partitions"):
        written.clear()
        assert all_queries()[name](spark, "/root/testdata/sf0.001").count() > 0
        assert len(written) == 2
        # What is written comes from stored files alone, without joins or aggregates.
        assert all("Aggregate" not in p and "Join" not in p for p in (df._jdf.queryExecution().optimizedPlan().toString() for df in written))


def test_a_batch_of_messages_is_classified_once(spark, base, monkeypatch):
    reads = []
    routed = ingest.routed
    monkeypatch.setattr(ingest, "routed", lambda read: (reads.append(read), routed(read))[1])
    schema = "value string, topic string, partition int, offset bigint, timestamp timestamp"
    body = '{"event_id": "1", "order_id": "o1", "user_id": 1, "item_id": 2, "price": 3, "timestamp": "2024-03-01T10:00:00Z"}'
    lines = [(body, "raw.orders.v1", 0, 1, HOUR), (body, "raw.orders.v1", 0, 1, HOUR), (body, "raw.clicks.v1", 0, 2, HOUR), ("{oops", "raw.clicks.v1", 0, 3, HOUR)]
    spark.createDataFrame(lines, schema).write.parquet(f"{base}/in")
    run_available(ingest.ingest_stream(file_source(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema), f"{base}/out", f"{base}/checkpoint"))
    assert len(reads) == 1 and "reason" in reads[0].columns and reads[0]._stored_at
    got = ingest.ingest_counts(spark, f"{base}/out").read().select("target", "received", "stored", "repeated")
    assert rows(got) == [("clicks", 1, 1, 0), ("orders", 2, 1, 1), ("quarantine", 1, 1, 0)]


def test_partitions_of_a_repeated_delivery_are_named_without_deduplication(spark, base, monkeypatch):
    asked = []
    touched = tables._touched
    monkeypatch.setattr(tables, "_touched", lambda source, path, keys, delivered=None: (asked.append(delivered), touched(source, path, keys, delivered))[1])
    feed = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 2, "x")], "id string, day int, v string")
    assert tables.append_idempotent(feed, f"{base}/t", "id", ["day"]) == 2
    assert tables.append_idempotent(feed, f"{base}/t", "id", ["day"]) == 0
    assert len(asked) == 1 and asked[0] is feed
    assert rows(spark.read.parquet(f"{base}/t").select("id", "day", "v")) == [("a", 1, None), ("b", 2, "x")]


def _moved(monkeypatch):
    """The folder columns of each frame that is brought together by them from now on."""
    moved = []
    rebalanced = files.rebalanced
    monkeypatch.setattr(files, "rebalanced", lambda df, keys: (moved.append(list(keys)), rebalanced(df, keys))[1])
    return moved


def test_stored_rows_of_few_folders_are_not_moved(spark, base, monkeypatch):
    from tiffinlake.session import materialize

    moved = _moved(monkeypatch)
    monkeypatch.setattr(files, "FILE_ROWS", 100)
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    made = spark.range(6000).repartition(3).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("year"))
    stored = materialize(made)
    for _ in range(2):
        files.write_gold(stored, f"{base}/few", ["year"])
    files.write_gold(stored.where("year = 2").withColumn("id", -F.col("id")), f"{base}/few", ["year"])
    assert moved == [["year"]] and spark.conf.get(setting) == before  # the last frame is not a stored one
    back = spark.read.parquet(f"{base}/few")
    assert rows(back.select(F.abs("id"), "year")) == rows(made) and back.where("id < 0").count() == stored.where("year = 2 and id > 0").count()
    # More folders than a task may write side by side, files too small, nothing at all: as before.
    monkeypatch.setattr(files, "FEW_FOLDERS", 3)
    files.write_gold(stored, f"{base}/few", ["year"])
    monkeypatch.setattr(files, "FILE_ROWS", 1000)
    files.write_gold(stored, f"{base}/few", ["year"])
    files.write_gold(materialize(made.limit(0)), f"{base}/few", ["year"])
    assert len(moved) == 4 and rows(spark.read.parquet(f"{base}/few")) == rows(made)


def test_hours_of_deliveries_are_not_moved_before_they_are_written(spark, base, monkeypatch):
    moved = _moved(monkeypatch)
    events = build_events(deliveries(spark), HOUR + dt.timedelta(minutes=5)).repartition(3)
    later = events.withColumn("ingestion_time", F.lit((HOUR + dt.timedelta(hours=1)).isoformat()))
    files.write_bronze_jsonl(events.unionByName(events).unionByName(later), base, hours=2)
    assert moved == []
    for _ in range(2):
        assert delivery_hourly.run(spark, base, HOUR, HOUR) == {"bronze_rows": 80, "silver_rows": 40, "valid_rows": 29, "duplicates": 40}
        assert delivery_hourly.run(spark, base, HOUR + dt.timedelta(hours=1), HOUR)["bronze_rows"] == 40
    # The hour's rows are of one folder; only its few metrics are brought together.
    assert moved and all(keys[-1] == "metric_type" or keys == files.HOUR_KEYS for keys in moved) and len(moved) == 8
    assert spark.read.parquet(f"{base}/silver").groupBy("hour").count().count() == 2


def test_stored_frames_leave_no_shuffle_files(spark):
    import time

    from tiffinlake.session import materialize

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    held = lambda: {n for n in (str(f.getName()) for f in _each(disk.getAllFiles())) if n.startswith("shuffle_")}
    there = held()
    made = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    stored = materialize(made)
    for _ in range(50):
        if not (left := held() - there):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting, None) == before
    assert rows(stored) == rows(made) and rows(made) == rows(stored)


def _each(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def test_lines_are_not_moved_by_their_customers(spark):
    """Orders meet their customers before the lines, of which there are many times more."""
    from tiffinlake.session import settings
    from workload.views import delivery_rows

    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = delivery_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    by_customer = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(by_customer) == 1
    under = plan[plan.index(by_customer[0]):].splitlines()
    assert "lineitem" not in next(line for line in under if "FileScan" in line)
