"""Interest profiles kept up by a stream.

A score is a sum of weights that fade with their age. Written against a fixed landmark instead of the
moment of reading, a weight is a constant: exp((t - landmark) / decay) grows with the event's own time, and
the score at any moment is the sum times one factor for all rows. Sums therefore merge in any order and are
never rescaled; they are kept as logarithms, so that they do not overflow however far the landmark lies back.
"""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..functions import epoch_us, from_epoch_us, micros
from ..operators.profiles import DECAY_MINUTES, PROFILE_TTL, event_weight, fresh_users
from ..sources.serving import BATCH, MERGE_EVERY, ServingTable
from ..sources.streams import batch_sink
from .processors import DELAY, _apply_frames, _reach, _timer_ms
from .windows import with_watermark

#: Weights are kept relative to this instant; any will do, as long as it never changes.
LANDMARK = dt.datetime(2024, 1, 1)
_DECAY_US = DECAY_MINUTES * 60e6
_UPDATE = "user_id bigint, kind string, target string, log_sum double, undated double, last_us bigint, expired boolean"
_ROW = Row(*[field.split()[0] for field in _UPDATE.split(",")])
_LAST = T.StructType([T.StructField("last_us", T.LongType())])
KINDS = ("item", "category")
#: Parts of the users that keep their state together: many times the cores, and far fewer than the users.
SHARDS = 512
_COLUMNS = {"user_id": T.LongType(), "item": T.LongType(), "category": T.StringType(), "log_sum": T.DoubleType(), "undated": T.DoubleType(),
          "last_us": T.LongType(), "gone": T.StringType()}
_PASSED = T.StructType([T.StructField(name, kind) for name, kind in _COLUMNS.items()])
_LOG = T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(name, T.ArrayType(T.LongType())) for name in ("users", "last")]])
_EXTENT = T.StructType([T.StructField(name, T.LongType()) for name in ("stored", "distinct", "due_ms")])
#: Logarithms that differ by less are summed as plain numbers.
_SPAN = 256.0
_LANDMARK_US = (LANDMARK - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


class InterestProfile(StatefulProcessor):
    """What a micro-batch adds to the sums of one user's items, or categories, and when the profile ends.

    Sums merge in any order, so none is read back: the state is the last activity alone, whatever the number of targets,
    and goes when the user is silent for the time to live. This is the rule for one profile; :class:`ShardOfProfiles` applies it to many.
    """

    def __init__(self, ttl_us: int):
        self._ttl = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues):
        added = {}
        for row in rows:
            target, log_weight, undated, at = row["target"], row["log_weight"], row["undated"], row["at_us"]
            if target in added:
                before = added[target]
                added[target] = (_log_add(before[0], log_weight), before[1] + undated, max(before[2], at))
            else:
                added[target] = (log_weight, undated, at)
        last, known = max(at for _, _, at in added.values()), self._last.get()
        if known is None:
            self._handle.registerTimer(_timer_ms(last + self._ttl))
        if known is None or known[0] < last:
            self._last.update((last,))
        return (_ROW(*key, target, *sums, False) for target, sums in added.items())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = self._last.get()[0]
        if last < _reach(timerValues, self._ttl):
            self._last.clear()
            return iter([_ROW(*key, None, 0.0, 0.0, last, True)])
        self._handle.registerTimer(_timer_ms(last + self._ttl))
        return iter(())

    def close(self) -> None:
        pass


def _log_add(a: float, b: float) -> float:
    """The logarithm of the sum of two numbers given by theirs."""
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class ShardOfProfiles(StatefulProcessor):
    """The same for all users of a shard at once: their rows pass as frames, to be added up by the sink, then come the profiles that end.

    A key costs several calls to its state, whatever it brings; here a shard makes them, not each of its profiles. The state
    is a log of last activities, appended to and written anew when half of it is out of date or a profile has ended.
    """

    def __init__(self, ttl_us: int):
        self._ttl = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._log = handle.getListState("last", _LOG)
        self._extent = handle.getValueState("extent", _EXTENT)

    def handleInputRows(self, key, rows, timerValues):
        seen = {kind: [] for kind in KINDS}
        for frame in rows:
            for kind, there in (("item", frame["item"] > 0), ("category", frame["category"].notna())):
                seen[kind].append(frame[there].groupby("user_id")["last_us"].max())
            yield frame.assign(gone=None)[_PASSED.names]
        fresh = {kind: _newest(parts) for kind, parts in seen.items()}
        stored, distinct, due = self._extent.get() or (0, 0, None)
        came = sum(map(len, fresh.values()))
        first = _timer_ms(min(int(last.min()) for last in fresh.values() if len(last)) + self._ttl)
        if due is None or first < due:
            self._wake(due, first)
            due = first
        if stored + came > 2 * distinct:
            fresh = self._stored(fresh)
            stored = distinct = sum(map(len, fresh.values()))
            self._log.put(_entries(fresh))
        else:
            stored += came
            self._log.appendList(_entries(fresh))
        self._extent.update((stored, distinct, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reach, last = _reach(timerValues, self._ttl), self._stored()
        kept = {kind: newest[newest >= reach] for kind, newest in last.items()}
        if n := sum(map(len, kept.values())):
            due = _timer_ms(min(int(newest.min()) for newest in kept.values() if len(newest)) + self._ttl)
            self._wake(None, due)
            self._log.put(_entries(kept))
            self._extent.update((n, n, due))
        else:
            self._log.clear()
            self._extent.clear()
        for kind, newest in last.items():
            ended = newest[newest < reach]
            if len(ended):
                yield pd.DataFrame({"user_id": ended.index, "item": 0, "category": None, "log_sum": 0.0, "undated": 0.0,
                                    "last_us": ended.to_numpy(), "gone": kind})[_PASSED.names]

    def _stored(self, fresh: dict[str, pd.Series] | None = None) -> dict[str, pd.Series]:
        """Last activity by user for each kind, with what has just come."""
        parts = {kind: [fresh[kind]] if fresh else [] for kind in KINDS}
        for kind, users, last in self._log.get():
            parts[kind].append(pd.Series(last, index=users, dtype="int64"))
        return {kind: _newest(found) for kind, found in parts.items()}

    def _wake(self, instead_of: int | None, at: int) -> None:
        if instead_of is not None:
            self._handle.deleteTimer(instead_of)
        self._handle.registerTimer(at)

    def close(self) -> None:
        pass


def _newest(parts: list[pd.Series]) -> pd.Series:
    """The last activity of each user, of several lists."""
    if not parts:
        return pd.Series([], index=pd.Index([], dtype="int64"), dtype="int64")
    return parts[0] if len(parts) == 1 else (together := pd.concat(parts)).groupby(together.index).max()


def _entries(last: dict[str, pd.Series]) -> list[tuple[str, list[int], list[int]]]:
    return [(kind, newest.index.tolist(), newest.tolist()) for kind, newest in last.items() if len(newest)]


def profile_updates(events: DataFrame, ts: str = "event_time", ttl: str = PROFILE_TTL, delay: str = DELAY, shards: int = SHARDS) -> DataFrame:
    """What changes in the profiles: what each event adds to its targets, and one row for each profile that expires.

    Users and items must be positive, categories not blank. Each event feeds its item and its category. The state of
    ``shards`` parts of the users is kept; a checkpoint holds for one number of them.
    """
    timed = with_watermark(events.where("user_id > 0"), ts, delay)
    weight, at = event_weight("event_type"), epoch_us(ts)
    user, item, category = F.col("user_id").cast("bigint"), F.col("item_id"), F.trim("category")
    rows = timed.select(
        F.pmod(F.xxhash64(user), F.lit(shards)).alias("shard"), user.alias("user_id"),
        F.when(item > 0, item.cast("bigint")).otherwise(F.lit(0)).cast("bigint").alias("item"), F.when(category != "", category).alias("category"),
        F.coalesce(F.log(weight) + (at - F.lit(_LANDMARK_US)) / F.lit(_DECAY_US), F.lit(-math.inf)).alias("log_sum"),
        F.when(at.isNull(), weight).otherwise(F.lit(0.0)).alias("undated"), F.coalesce(at, F.lit(0)).cast("bigint").alias("last_us"), ts)
    passed = _apply_frames(rows.where("item > 0 or category is not null"), ["shard"], ShardOfProfiles(micros(ttl)), _PASSED, "EventTime")
    target = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("target"))
    fed = F.array_compact(F.array(
        F.when(F.col("item") > 0, target("item", F.col("item"))), F.when(F.col("category").isNotNull(), target("category", F.col("category"))),
        F.when(F.col("gone").isNotNull(), F.struct(F.col("gone").alias("kind"), F.lit(None).cast("string").alias("target")))))
    return passed.select("*", F.explode(fed).alias("x")).select(
        "user_id", "x.kind", "x.target", "log_sum", "undated", "last_us", F.col("gone").isNotNull().alias("expired"))


def _added_up(df: DataFrame, *newest: str) -> DataFrame:
    """Rows of one target, or one expiry, as one row for each span of their logarithms, within which plain sums neither overflow nor vanish."""
    span = F.when(F.col("log_sum") == -math.inf, F.lit(0)).otherwise(F.floor(F.col("log_sum") / F.lit(_SPAN)))
    base = F.col("_span") * F.lit(_SPAN)
    sums = df.withColumn("_span", span).groupBy("user_id", "kind", "target", "expired", "_span").agg(
        F.sum(F.exp(F.col("log_sum") - base)).alias("_mass"), F.sum("undated").alias("undated"), *[F.max(c).alias(c) for c in ("last_us", *newest)])
    return sums.withColumn("log_sum", F.coalesce(F.log("_mass") + base, F.lit(-math.inf))).drop("_span", "_mass")


def _summed(df: DataFrame) -> DataFrame:
    """The sums of every target since its profile last expired, and that expiry."""
    gone = df.where("expired").groupBy("user_id", "kind").agg(F.max(BATCH).alias("_gone"), F.max("last_us").alias("_left"))
    kept = df.where("not expired").join(gone, ["user_id", "kind"], "left").where(F.col("_gone").isNull() | (F.col(BATCH) > F.col("_gone")))
    left = gone.select("user_id", "kind", F.lit(None).cast("string").alias("target"), F.lit(0.0).alias("log_sum"), F.lit(0.0).alias("undated"),
                       F.col("_left").alias("last_us"), F.lit(True).alias("expired"), F.col("_gone").alias(BATCH))
    return _added_up(kept, BATCH).unionByName(left)


def profile_table(spark: SparkSession, path: str, every: int = MERGE_EVERY) -> ServingTable:
    return ServingTable(spark, path, _UPDATE, _summed, every)


def keep_profiles(updates: DataFrame, path: str, checkpoint: str, every: int = MERGE_EVERY) -> DataStreamWriter:
    """Profile updates into a serving table; those of a micro-batch are added up before they are written."""
    table = profile_table(updates.sparkSession, path, every)
    return batch_sink(updates, lambda batch, batch_id: table.write(_added_up(batch), batch_id), checkpoint)


def current_profiles(spark: SparkSession, path: str, as_of: dt.datetime, kind: str = "item", ttl: str | None = PROFILE_TTL) -> DataFrame:
    """Scores at ``as_of``, as :func:`tiffinlake.operators.profiles.interest_profiles` gives them; silent users are dropped."""
    target = {"item": F.col("target").cast("bigint").alias("item_id"), "category": F.col("target").alias("category")}[kind]
    age = (epoch_us(F.lit(as_of)) - F.lit(_LANDMARK_US)) / F.lit(_DECAY_US)
    rows = profile_table(spark, path).read().where((F.col("kind") == kind) & ~F.col("expired"))
    sums = rows.groupBy("user_id", target).agg(F.sum(F.exp(F.col("log_sum") - age) + F.col("undated")).alias("score"), F.max("last_us").alias("last_us"))
    scored = sums.withColumn("last_update", from_epoch_us("last_us")).drop("last_us")
    return fresh_users(scored, as_of, ttl) if ttl else scored
