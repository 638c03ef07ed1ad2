"""Fraud rules over transactions in batch form, and their common alert schema.

A transaction has ``event_id, user_id, device_id, order_id, amount, city, event_time``. Events at
the very same time see each other, so results do not depend on arrival order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import epoch_us, micros, time_bucket
from .dedup import dedup_latest
from .intervals import interval_totals, presence, trailing_distinct

# Rule parameters, alert types, severities and message formats.
VELOCITY_LIMIT, VELOCITY_WINDOW = 3, "5 minutes"
DEVICE_LIMIT = 3
HIGH_VALUE_LIMIT = 1500
GEO_WINDOW = "10 minutes"
COOLDOWN = "5 minutes"
VELOCITY, DEVICE_SHARING = "VELOCITY_FRAUD", "DEVICE_SHARING_FRAUD"
HIGH_VALUE, GEO_ANOMALY = "HIGH_VALUE_FRAUD", "GEO_ANOMALY_FRAUD"
SEVERITY = {VELOCITY: "HIGH", DEVICE_SHARING: "CRITICAL", HIGH_VALUE: "MEDIUM", GEO_ANOMALY: "HIGH"}
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM"]
MESSAGES = {
    VELOCITY: "User %s placed %s orders in %s minutes",
    DEVICE_SHARING: "Device %s used by %s different users",
    HIGH_VALUE: "High-value transaction of ₹%s from user %s",
    GEO_ANOMALY: "User %s ordered from %s after ordering from [%s] recently",
}

ALERT_COLUMNS = ["alert_type", "user_id", "device_id", "order_id", "event_id", "amount", "severity", "message", "detected_at"]


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def alert_columns(kind: str, message: Column, ts: str, extra: list[Column]) -> list[Column]:
    return [
        F.lit(kind).alias("alert_type"), _text("user_id").alias("user_id"), _text("device_id").alias("device_id"),
        _text("order_id").alias("order_id"), _text("event_id").alias("event_id"),
        F.col("amount").cast("double").alias("amount"), F.lit(SEVERITY[kind]).alias("severity"),
        message.alias("message"), F.col(ts).alias("detected_at"), *extra,
    ]


def _with_point(df: DataFrame, points: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of ``df`` whose (key, time) is listed in ``points`` (unique per key and time)."""
    return df.withColumn("at_us", epoch_us(ts)).join(points, [key, "at_us"])


def velocity_alerts(
    df: DataFrame, limit: int = VELOCITY_LIMIT, window: str = VELOCITY_WINDOW, ts: str = "event_time",
    lower: str = "closed", distinct: str | None = None,
) -> DataFrame:
    """Orders that bring a user above ``limit`` orders in the trailing window.

    ``lower="open"`` leaves out an order exactly one window old; ``distinct="event_id"`` first
    keeps the latest copy of each event. Only points above the limit meet the transactions again.
    """
    if distinct:
        df = dedup_latest(df, [distinct], [ts])
    busy = interval_totals(df, df, ["user_id"], ts, ts, window, {"order_count": F.lit(1)}, lower=lower)
    busy = busy.where(F.col("order_count") > limit)
    message = F.format_string(
        MESSAGES[VELOCITY], _text("user_id"), _text("order_count"), F.lit(str(micros(window) // 60_000_000)))
    return _with_point(df, busy, "user_id", ts).select(
        *alert_columns(VELOCITY, message, ts, [F.col("order_count")]))


def device_sharing_alerts(
    df: DataFrame, limit: int = DEVICE_LIMIT, window: str = VELOCITY_WINDOW, ts: str = "event_time",
) -> DataFrame:
    """Transactions on a device that more than ``limit`` distinct users used in the trailing window.

    The users themselves are given by :func:`device_users`, one row each.
    """
    known = df.where("user_id is not null")
    shared = trailing_distinct(known, ["device_id"], "user_id", ts, window, "unique_users")
    shared = shared.where(F.col("unique_users") > limit)
    message = F.format_string(MESSAGES[DEVICE_SHARING], _text("device_id"), _text("unique_users"))
    return _with_point(known, shared, "device_id", ts).select(
        *alert_columns(DEVICE_SHARING, message, ts, [F.col("unique_users")]))


# Users of a device and time bucket that are joined as one row, and the parts of a bucket's time line they are taken from.
CROWD, CROWD_CELLS = 512, 16


def _crowds(seen: DataFrame, w: int) -> DataFrame:
    """What :func:`presence` tells of devices as lists of at most ``CROWD`` users that come, or go, at about the same time.

    Within its bucket a user is on the device from an instant on (``comes``), until an instant, or first until one and then again from
    another: one or two entries ``(us, member)`` of which at any time at most one holds. ``first_us`` and ``last_us`` bound a list's instants.
    """
    start, carried, here = F.col("bucket") * F.lit(w), F.col("last_us").isNotNull(), F.col("first_us").isNotNull()
    until = F.col("last_us") + F.lit(w)
    unbroken = F.coalesce(carried & (F.col("first_us") <= until), F.lit(False))
    entry = lambda comes, us: F.struct(F.lit(comes).alias("comes"), us.cast("bigint").alias("us"))
    entries = F.array_compact(F.array(
        F.when(unbroken, entry(True, start)).when(here, entry(True, F.col("first_us"))), F.when(carried & ~unbroken, entry(False, until))))
    cell = F.floor((F.col("us") - start) * F.lit(CROWD_CELLS / w)).cast("int")
    listed = seen.select("device_id", "bucket", "member", F.explode(entries).alias("_e")).select("device_id", "bucket", "member", "_e.*")
    group = ["device_id", "bucket", "comes", "cell"]
    listed = listed.withColumn("cell", cell)
    part = F.floor((F.row_number().over(Window.partitionBy(*group).orderBy("us")) - 1) / F.lit(CROWD)).alias("part")
    return listed.select("*", part).groupBy(*group, "part").agg(
        F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.collect_list(F.struct("us", "member")).alias("crowd")).drop("cell", "part")


def device_users(alerts: DataFrame, df: DataFrame, window: str = VELOCITY_WINDOW, ts: str = "event_time") -> DataFrame:
    """The users behind device-sharing alerts, one row per alert and user.

    A row per user keeps a device with very many users out of a single array. Alerts meet the users in bounded lists,
    which are left whole if none of the list is on the device at the time, and written out as rows without further joins.
    """
    w = micros(window)
    seen = presence(df.select(F.col("device_id").cast("string").alias("device_id"),
                              F.col("user_id").cast("string").alias("member"), ts),
                    ["device_id"], "member", ts, window)
    at = alerts.select("event_id", "device_id", epoch_us("detected_at").alias("_at"))
    holds = lambda first, last: (F.col("comes") & (first <= F.col("_at"))) | (~F.col("comes") & (last >= F.col("_at")))
    met = at.withColumn("bucket", time_bucket("_at", w)).join(_crowds(seen, w), ["device_id", "bucket"]).where(
        holds(F.col("first_us"), F.col("last_us")))
    return (
        met.select("event_id", "device_id", "_at", "comes", F.explode("crowd").alias("_u"))
        .where(holds(F.col("_u.us"), F.col("_u.us")))
        .select("event_id", "device_id", "_u.member")
    )


def high_value_alerts(df: DataFrame, threshold: float = HIGH_VALUE_LIMIT, inclusive: bool = False,
                      ts: str = "event_time") -> DataFrame:
    over = F.col("amount") >= threshold if inclusive else F.col("amount") > threshold
    message = F.format_string(MESSAGES[HIGH_VALUE], _text("amount"), _text("user_id"))
    return df.where(over).select(*alert_columns(HIGH_VALUE, message, ts, [F.lit(float(threshold)).alias("threshold")]))


def geo_anomaly_alerts(df: DataFrame, window: str = GEO_WINDOW, ts: str = "event_time") -> DataFrame:
    """Orders from a city the user was not in during the trailing window while being in another.

    Per (user, time bucket) the cities with their first and last times form one small array, at
    most one entry per city that exists. Buckets with a single city are dropped before the join.
    """
    w = micros(window)
    known = df.where("user_id is not null and city is not null")
    cities = (
        presence(known, ["user_id"], "city", ts, window)
        .groupBy("user_id", "bucket")
        .agg(F.array_sort(F.collect_list(F.struct("city", "first_us", "last_us"))).alias("_cities"))
        .where(F.size("_cities") > 1)
    )
    here = known.withColumn("_at", epoch_us(ts)).withColumn("bucket", time_bucket("_at", w)).join(
        cities, ["user_id", "bucket"])
    at = F.col("_at")
    own = F.coalesce(F.exists("_cities", lambda x: (x["city"] == F.col("city")) & (
        F.coalesce(x["first_us"] < at, F.lit(False)) | F.coalesce(x["last_us"] >= at - w, F.lit(False)))), F.lit(False))
    others = F.transform(
        F.filter("_cities", lambda x: (x["city"] != F.col("city")) & (
            F.coalesce(x["first_us"] <= at, F.lit(False)) | F.coalesce(x["last_us"] >= at - w, F.lit(False)))),
        lambda x: x["city"])
    found = here.withColumn("previous_cities", others).where(~own & (F.size("previous_cities") > 0))
    message = F.format_string(
        MESSAGES[GEO_ANOMALY], _text("user_id"), _text("city"), F.array_join("previous_cities", ", "))
    return found.select(
        *alert_columns(GEO_ANOMALY, message, ts, [F.col("city").alias("current_city"), F.col("previous_cities")]))


def union_alerts(*alerts: DataFrame) -> DataFrame:
    """Alerts of several rules in one schema; rule-specific columns are null elsewhere."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alerts)


def alert_records(alerts: DataFrame) -> DataFrame:
    """Alert store rows: the typed columns, epoch-millisecond time, and the whole alert as JSON."""
    ms = F.call_function("div", epoch_us("detected_at"), F.lit(1000))
    return alerts.select(
        *[F.col(c) for c in ALERT_COLUMNS if c != "detected_at"], ms.alias("detected_at"),
        F.to_json(F.struct("*")).alias("alert_data"),
    )
