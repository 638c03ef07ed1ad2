"""Stateful stream processors for rules no window expression covers.

Rows of one key in a micro-batch are taken in event-time order. The rules need a watermark: a row
more than ``delay`` behind the newest one is dropped. A later row within the delay is judged by the
window before its own time; alerts already sent are not revised. State reaches back one window
before the watermark and an event-time timer removes what is older, so a key that falls silent
leaves nothing behind. Only the running count, which never ends by definition, keeps one number for
every key.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import epoch_us, micros
from ..operators import fraud

_LONG = T.StructType([T.StructField("v", T.LongType())])
# How late a row may be against the newest one of its stream.
DELAY = "10 minutes"
_MEMBER = T.StructType([T.StructField("member", T.StringType()), T.StructField("t", T.LongType())])
_PASSED = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last", T.ArrayType(T.LongType()))])
_EXTENT = T.StructType([T.StructField(name, T.LongType()) for name in ("stored", "due_ms")])
#: Parts of the keys that keep their state together: many times the cores, and far fewer than the keys.
SHARDS = 512


def _timer_ms(at_us: int) -> int:
    """A timer that fires after ``at_us``: timers have millisecond resolution."""
    return at_us // 1000 + 1


def _reach(timers, window_us: int) -> int:
    """The oldest instant that a row yet to come can still see."""
    return timers.getCurrentWatermarkInMs() * 1000 - window_us


def _in_order(rows: Iterator[Row], *by: str) -> list[Row]:
    """A key's rows by these columns, nulls last."""
    return sorted(rows, key=lambda row: [(row[c] is None, row[c]) for c in by])


def _with(rows: list[Row], name: str, values: Iterable) -> Iterator[Row]:
    """The rows with one more column."""
    if rows:
        wider = Row(*rows[0].__fields__, name)
        for row, value in zip(rows, values):
            yield wider(*row, value)


class RunningCount(StatefulProcessor):
    """Each row with its key's running count."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", _LONG)

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "at_us", "event_id")
        before = (self._count.get() or (0,))[0]
        self._count.update((before + len(batch),))
        return _with(batch, "running_count", range(before + 1, before + len(batch) + 1))

    def close(self) -> None:
        pass


class Cooldown(StatefulProcessor):
    """Rows more than one period after the key's last emitted row; the state goes when the period is over.

    A late row before the last emitted one does not pass.
    """

    def __init__(self, period_us: int):
        self._period = period_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", _LONG)

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "at_us", "event_id")
        at = [row["at_us"] for row in batch]
        known = self._last.get()
        if known is None:
            self._handle.registerTimer(_timer_ms(at[0] + self._period))
        last = None if known is None else known[0]
        passed = []
        # From one row that passes to the next; those between are not looked at.
        i = 0 if last is None else bisect_right(at, last + self._period)
        while i < len(at):
            passed.append(batch[i])
            last = at[i]
            i = bisect_right(at, last + self._period)
        if passed:
            self._last.update((last,))
        return iter(passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = int(self._last.get()[0])
        if last < _reach(timerValues, self._period):
            self._last.clear()
        else:
            self._handle.registerTimer(_timer_ms(last + self._period))
        return iter(())

    def close(self) -> None:
        pass


class ShardOfCooldowns(StatefulProcessor):
    """The same for all keys of a shard at once, whose rows come as frames with the key's text in ``cooldown_key``.

    A key costs several calls to its state, whatever it brings; here a shard makes them, not each of its keys. The state
    is a log of the instants that passed last, appended to and written anew when half of it is out of date or some are out of reach.
    """

    #: Keys of one entry of the log.
    ENTRY = 50_000

    def __init__(self, period_us: int, columns: list[str]):
        self._period, self._columns = period_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._log = handle.getListState("last", _PASSED)
        self._extent = handle.getValueState("extent", _EXTENT)

    def handleInputRows(self, key, rows, timerValues):
        batch = _first_of_ties(pd.concat(list(rows), ignore_index=True), ["cooldown_key", "at_us"], "event_id")
        codes, keys = pd.factorize(batch["cooldown_key"])
        order = np.lexsort((batch["at_us"].to_numpy(), codes))
        known = self._stored()
        last = known.reindex(keys)
        passed = _greedy(codes[order], batch["at_us"].to_numpy()[order], last.isna().to_numpy(), last.fillna(0).to_numpy("int64"), self._period)
        out = batch.iloc[order[passed]]
        self._keep(known, out.groupby("cooldown_key")["at_us"].max())
        yield out[self._columns]

    def _stored(self) -> pd.Series:
        """The instant that passed last, by key."""
        keys, last = [], []
        for some, of_them in self._log.get():
            keys += some
            last += of_them
        # Of a key the last entry counts: what passes later is later.
        known = pd.Series(last, index=pd.Index(keys, dtype=object), dtype="int64")
        return known[~known.index.duplicated(keep="last")]

    def _keep(self, known: pd.Series, fresh: pd.Series) -> None:
        if not len(fresh):
            return
        stored, due = self._extent.get() or (0, None)
        merged = pd.concat([known[~known.index.isin(fresh.index)], fresh])
        first = _timer_ms(int(fresh.min()) + self._period)
        if due is None or first < due:
            if due is not None:
                self._handle.deleteTimer(due)
            self._handle.registerTimer(first)
            due = first
        if stored + len(fresh) > 2 * len(merged):
            self._log.put(self._entries(merged))
            stored = len(merged)
        else:
            self._log.appendList(self._entries(fresh))
            stored += len(fresh)
        self._extent.update((stored, due))

    def _entries(self, last: pd.Series) -> list[tuple[list[str], list[int]]]:
        keys, at = last.index.tolist(), last.tolist()
        return [(keys[i:i + self.ENTRY], at[i:i + self.ENTRY]) for i in range(0, len(keys), self.ENTRY)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = self._stored()
        kept = last[last >= _reach(timerValues, self._period)]
        if len(kept):
            due = _timer_ms(int(kept.min()) + self._period)
            self._handle.registerTimer(due)
            self._log.put(self._entries(kept))
            self._extent.update((len(kept), due))
        else:
            self._log.clear()
            self._extent.clear()
        return iter(())

    def close(self) -> None:
        pass


def _first_of_ties(batch: pd.DataFrame, by: list[str], tiebreak: str) -> pd.DataFrame:
    """One row for each value of ``by``, the least by ``tiebreak``, nulls last."""
    tied = batch.duplicated(by, keep=False)
    if not tied.any():
        return batch
    least = batch[tied].sort_values(tiebreak, kind="stable", na_position="last").drop_duplicates(by)
    return pd.concat([batch[~tied], least], ignore_index=True)


def _greedy(codes: np.ndarray, at: np.ndarray, fresh: np.ndarray, last: np.ndarray, period: int) -> np.ndarray:
    """Positions of the rows that pass, of rows sorted by key (numbered from 0) and time, distinct in both.

    ``last`` is each key's instant that passed before, if it is not ``fresh``. All keys go from one row that passes to the next at
    once, in one search over their time lines laid end to end; the last few keys with a long way to go are walked alone.
    """
    few, out = 16, []
    keys = len(last)
    ends = np.searchsorted(codes, np.arange(keys), side="right")
    starts = np.concatenate(([0], ends[:-1]))
    origin = int(at.min())
    span = int(at.max()) - origin + 2
    # Positions on the common line fit into 64 bits for so many keys.
    together = max(1, 2 ** 62 // span)
    for low in range(0, keys, together):
        high = min(keys, low + together)
        a, b = starts[low], ends[high - 1]
        line = (codes[a:b] - low) * span + (at[a:b] - origin)
        active = np.arange(low, high)

        def after(chosen: np.ndarray, instants: np.ndarray) -> np.ndarray:
            """The first row of each key later than an instant of it."""
            beyond = np.clip(instants - origin, -1, span - 1)
            return a + np.searchsorted(line, (chosen - low) * span + beyond, side="right")

        at_row = np.where(fresh[low:high], starts[low:high], after(active, last[low:high] + period))
        while len(active):
            onward = at_row < ends[active]
            active, at_row = active[onward], at_row[onward]
            out.append(at_row)
            if len(active) <= few:
                break
            at_row = after(active, at[at_row] + period)
        for one, i in zip(active.tolist(), at_row.tolist()):
            own = at[starts[one]:ends[one]].tolist()
            i -= int(starts[one])
            walked = []
            while (i := bisect_right(own, own[i] + period)) < len(own):
                walked.append(i + starts[one])
            out.append(np.array(walked, dtype="int64"))
    return np.concatenate(out) if out else np.array([], dtype="int64")


class ProcessingTimeCooldown(StatefulProcessor):
    """One row per key and period of processing time, whatever the rows' own times.

    The state entry carries a TTL, so it vanishes when the period is over.
    """

    def __init__(self, period_ms: int):
        self._period = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", _LONG, self._period)

    def handleInputRows(self, key, rows, timerValues):
        if self._open.exists():
            return iter(())
        self._open.update((1,))
        return iter(_in_order(rows, "at_us", "event_id")[:1])

    def close(self) -> None:
        pass


class Inactivity(StatefulProcessor):
    """One row per silence: an event-time timer ``gap`` after the last activity."""

    def __init__(self, gap_us: int):
        self._gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", _LONG)

    def handleInputRows(self, key, rows, timerValues):
        known = self._last.get()
        stored = [] if known is None else [known[0]]
        line = sorted(stored + [row["at_us"] for row in rows])
        if stored != line[-1:]:
            self._last.update((line[-1],))
            # The last activity is all there is to a timer, so the one to replace is known without a list.
            if stored:
                self._handle.deleteTimer(self._timer(stored[0]))
            self._handle.registerTimer(self._timer(line[-1]))
        return self._fired(key, [a for a, b in zip(line, line[1:]) if b - a >= self._gap])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = self._last.get()[0]
        self._last.clear()
        return self._fired(key, [last])

    def _timer(self, last: int) -> int:
        """Timers have millisecond resolution; rounded up so that none fires early."""
        return -(-(last + self._gap) // 1000)

    def _fired(self, key, lasts: list[int]) -> Iterator[Row]:
        return iter([Row(key=key[0], last_us=t, fired_us=t + self._gap) for t in lasts])

    def close(self) -> None:
        pass


class _Trailing(StatefulProcessor):
    """A list state of ``(member, t)`` of which a timer drops what no later row can see.

    New entries are appended; the list is written anew only when at least half of it is out of reach.
    """

    def __init__(self, window_us: int):
        self._window = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getListState("seen", _MEMBER)

    def _stored(self) -> list[tuple[str | None, int]]:
        return [(m, t) for m, t in self._seen.get()]

    def _store(self, stored: list, fresh: list, timers) -> None:
        reach = _reach(timers, self._window)
        kept = [x for x in stored if x[1] >= reach]
        if stored and len(kept) > len(stored) // 2:
            self._seen.appendList(fresh)
        else:
            self._seen.put(kept + fresh)
        if not stored:
            self._handle.registerTimer(_timer_ms(max(t for _, t in fresh) + self._window))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reach = _reach(timerValues, self._window)
        kept = [x for x in self._stored() if x[1] >= reach]
        if kept:
            self._seen.put(kept)
            self._handle.registerTimer(_timer_ms(max(t for _, t in kept) + self._window))
        else:
            self._seen.clear()
        return iter(())

    def close(self) -> None:
        pass


class TrailingCount(_Trailing):
    """Rows that bring their key above ``limit`` rows in the trailing window."""

    def __init__(self, window_us: int, limit: int):
        super().__init__(window_us)
        self._limit = limit

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "at_us")
        stored = self._stored()
        at = [row["at_us"] for row in batch]
        line = sorted([t for _, t in stored] + at)
        n = [bisect_right(line, t) - bisect_left(line, t - self._window) for t in at]
        self._store(stored, [(None, t) for t in at], timerValues)
        return _with([row for row, k in zip(batch, n) if k > self._limit], "n", [k for k in n if k > self._limit])


class TrailingMembers(_Trailing):
    """Rows whose key saw more than ``limit`` members in the trailing window, itself included, with those members.

    ``new_only`` keeps only rows whose own member was not in the window before them.
    """

    def __init__(self, window_us: int, limit: int, new_only: bool = False):
        super().__init__(window_us)
        self._limit, self._new_only = limit, new_only

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "at_us")
        crowds = list(self._crowds([(row["member"], row["at_us"]) for row in batch], timerValues))
        return _with([row for row, c in zip(batch, crowds) if c], "members", [c for c in crowds if c])

    def _crowds(self, came: list[tuple[str, int]], timers) -> Iterator[list[str] | None]:
        """The members that each row, given by member and time in order of time, passes with; none if it does not."""
        stored = self._stored()
        fresh = sorted(set(came) - set(stored), key=lambda x: x[1])
        if fresh:
            self._store(stored, fresh, timers)
        line = sorted(stored + fresh, key=lambda x: x[1])
        window, lo, hi = Counter(), 0, 0
        for t, peers in groupby(came, key=lambda x: x[1]):
            while hi < len(line) and line[hi][1] < t:
                window[line[hi][0]] += 1
                hi += 1
            while lo < hi and line[lo][1] < t - self._window:
                gone = line[lo][0]
                window[gone] -= 1
                if not window[gone]:
                    del window[gone]
                lo += 1
            members = [m for m, _ in peers]
            known = {m for m in members if m in window} if self._new_only else set()
            while hi < len(line) and line[hi][1] == t:
                window[line[hi][0]] += 1
                hi += 1
            crowd = sorted(window) if len(window) > self._limit else None
            yield from (None if m in known else crowd for m in members)


class LongTrailingMembers(TrailingMembers):
    """The same for keys whose windows hold very many members, such as devices: frames in and out, results in pieces.

    A key's lists together may be far larger than its rows, so no more than ``PIECE`` members are held at a time.
    """

    PIECE = 200_000

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values("at_us", kind="stable")
        passed, crowds, held = [], [], 0
        for i, crowd in enumerate(self._crowds(list(zip(batch["member"], batch["at_us"].tolist())), timerValues)):
            if crowd:
                passed.append(i)
                crowds.append(crowd)
                held += len(crowd)
            if held >= self.PIECE:
                yield self._piece(batch, passed, crowds)
                passed, crowds, held = [], [], 0
        yield self._piece(batch, passed, crowds)

    @staticmethod
    def _piece(batch: pd.DataFrame, passed: list[int], crowds: list[list[str]]) -> pd.DataFrame:
        out = batch.iloc[passed].copy()
        out["members"] = pd.Series(crowds, index=out.index, dtype=object)
        return out


class StretchesOfMembers(LongTrailingMembers):
    """The same with each member's stretches in place of a list for each row: what rows and members take grows with their number alone.

    A key's rows that pass come in runs of at least ``RUN``. The first row of a run carries the members that any of its rows passes with,
    each with the instants ``come`` and ``gone`` between which it is in the window; ``run`` names the run in all its rows.
    """

    RUN = 10_000

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values("at_us", kind="stable")
        came = list(zip(batch["member"], batch["at_us"].tolist()))
        stored = self._stored()
        fresh = sorted(set(came) - set(stored), key=lambda x: x[1])
        if fresh:
            self._store(stored, fresh, timerValues)
        stretches = self._stretches(sorted(stored + fresh, key=lambda x: x[1]))
        counts = self._counts(stretches, batch["at_us"].to_numpy())
        passed = np.flatnonzero(counts > self._limit)
        out, n = batch.iloc[passed], counts[passed]
        # Runs of rows of different instants, at least as many rows as members in their first window.
        at, first, begin = out["at_us"].to_numpy(), 0, 0
        held: list[tuple[str, int, int]] = []
        while first < len(out):
            last = min(len(out), first + max(self.RUN, int(n[first])))
            last = int(np.searchsorted(at, at[last - 1], side="right"))
            low, high = int(at[first]), int(at[last - 1])
            while begin < len(stretches) and stretches[begin][1] <= high:
                held.append(stretches[begin])
                begin += 1
            held = [x for x in held if x[2] >= low]
            yield self._run(out.iloc[first:last], n[first:last], held)
            first = last

    def _stretches(self, line: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
        """Member, first and last instant of the windows that it is in without a break, by the first instant."""
        open_, out = {}, []
        for member, t in line:
            known = open_.get(member)
            if known is not None and t <= out[known][2]:
                out[known][2] = t + self._window
            else:
                open_[member] = len(out)
                out.append([member, t, t + self._window])
        return [tuple(x) for x in out]

    @staticmethod
    def _counts(stretches: list[tuple[str, int, int]], at: np.ndarray) -> np.ndarray:
        come, gone = (np.sort(np.array([x[i] for x in stretches], dtype="int64")) for i in (1, 2))
        return np.searchsorted(come, at, side="right") - np.searchsorted(gone, at, side="left")

    @staticmethod
    def _run(rows: pd.DataFrame, n: np.ndarray, members: list[tuple[str, int, int]]) -> pd.DataFrame:
        out = rows.copy()
        out["n"], out["run"] = n, uuid.uuid4().hex
        for name, values in zip(("users", "come", "gone"), map(list, zip(*members))):
            out[name] = pd.Series([values] + [None] * (len(out) - 1), index=out.index, dtype=object)
        return out


class ArrivalAttribution(_Trailing):
    """Orders with a flag: was there a click of their key in the window before them, among those that have arrived?

    Rows carry ``is_order``. Within a micro-batch rows arrive in event-time order, a click before an order of its
    instant. A click that arrives after its order is not credited to it, only to later ones. The state holds the
    distinct instants of clicks that an order yet to come can still reach.
    """

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "at_us")
        stored = self._stored()
        known = {t for _, t in stored}
        fresh = sorted({row["at_us"] for row in batch if not row["is_order"]} - known)
        line = sorted([*known, *fresh])
        orders = [row for row in batch if row["is_order"]]
        credited = [bisect_right(line, t) > bisect_left(line, t - self._window) for t in (row["at_us"] for row in orders)]
        if fresh:
            self._store(stored, [(None, t) for t in fresh], timerValues)
        return _with(orders, "attributed", credited)


def _apply(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: T.StructType | str,
           time_mode: str = "None") -> DataFrame:
    """Keys come with few rows in a micro-batch, and a frame for each would cost far more than its rows."""
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode)


def _apply_frames(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: T.StructType | str,
                  time_mode: str = "None") -> DataFrame:
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode)


def _timed(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("at_us", epoch_us(ts))


def _extended(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema], *[T.StructField(n, t) for n, t in fields]])


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """``df`` with a watermark on ``ts`` (unless it has one) and the instant in microseconds."""
    from .windows import with_watermark

    has = "spark.watermarkDelayMs" in df.schema[ts].metadata
    return _timed(df if has else with_watermark(df, ts, delay), ts)


def _like(out: DataFrame, df: DataFrame, ts: str) -> DataFrame:
    """``ts`` in the type it had before the watermark, which needs TIMESTAMP."""
    return out.withColumn(ts, F.col(ts).cast(df.schema[ts].dataType))


def running_count_stream(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """``df`` (with ``event_id``) plus the running count per key."""
    timed = _timed(df, ts)
    return _apply(timed, keys, RunningCount(), _extended(timed, ("running_count", T.LongType()))).drop("at_us")


def _key_text(keys: list[str]) -> Column:
    """The values of the keys as one text, which differs if one of them does."""
    text = [F.col(k).cast("string") for k in keys]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def cooldown_stream(alerts: DataFrame, keys: list[str], ts: str = "detected_at", period: str = fraud.COOLDOWN,
                    clock: str = "event", delay: str = DELAY, shards: int | None = None) -> DataFrame:
    """Alerts that pass the cooldown, by event time or by processing time.

    With ``shards`` the state of an event-time cooldown is kept by so many parts of the keys, for streams of very many keys;
    keys are compared by their text, and alerts without a time do not pass. A checkpoint holds for one number of parts.
    """
    if clock == "processing":
        timed = _timed(alerts, ts)
        return _apply(timed, keys, ProcessingTimeCooldown(micros(period) // 1000), timed.schema, "ProcessingTime").drop("at_us")
    timed = _watermarked(alerts, ts, delay)
    if shards:
        # A frame has whole numbers with nulls between them as floating-point numbers, which do not hold all of them.
        long = [f.name for f in timed.schema if isinstance(f.dataType, T.LongType) and f.name != "at_us"]
        as_text = timed.where("at_us is not null").withColumns({"cooldown_key": _key_text(keys), **{c: F.col(c).cast("string") for c in long}})
        rows = as_text.withColumn("cooldown_shard", F.pmod(F.xxhash64("cooldown_key"), F.lit(shards)))
        fields = as_text.drop("cooldown_key", "at_us").schema
        out = _apply_frames(rows, ["cooldown_shard"], ShardOfCooldowns(micros(period), fields.names), fields, "EventTime")
        return _like(out.withColumns({c: F.col(c).cast("bigint") for c in long}) if long else out, alerts, ts)
    return _like(_apply(timed, keys, Cooldown(micros(period)), _extended(timed), "EventTime").drop("at_us"), alerts, ts)


def inactive_keys_stream(df: DataFrame, key: str, ts: str, gap: str, delay: str = "0 seconds") -> DataFrame:
    """When each key's inactivity timer fires."""
    from .windows import with_watermark

    timed = with_watermark(df, ts, delay)
    timed = _timed(timed, ts).select(F.col(key).alias("key"), ts, "at_us")
    key_type = timed.schema["key"].dataType
    out = T.StructType([T.StructField("key", key_type), T.StructField("last_us", T.LongType()),
                        T.StructField("fired_us", T.LongType())])
    return _apply(timed, ["key"], Inactivity(micros(gap)), out, "EventTime").withColumnRenamed("key", key)


def velocity_stream(df: DataFrame, limit: int = fraud.VELOCITY_LIMIT, window: str = fraud.VELOCITY_WINDOW,
                    ts: str = "event_time", delay: str = DELAY) -> DataFrame:
    timed = _watermarked(df, ts, delay)
    hits = _like(_apply(timed, ["user_id"], TrailingCount(micros(window), limit),
                        _extended(timed, ("n", T.LongType())), "EventTime"), df, ts)
    message = F.format_string(
        fraud.MESSAGES[fraud.VELOCITY], F.col("user_id").cast("string"), F.col("n").cast("string"),
        F.lit(str(micros(window) // 60_000_000)))
    return hits.select(*fraud.alert_columns(fraud.VELOCITY, message, ts, [F.col("n").alias("order_count")]))


def _members(df: DataFrame, key: str, member: str, processor: TrailingMembers, ts: str, delay: str, apply=_apply,
             told: tuple = (("members", T.ArrayType(T.StringType())),)) -> DataFrame:
    timed = _watermarked(df, ts, delay).withColumn("member", F.col(member).cast("string"))
    out = _extended(timed, *told)
    return _like(apply(timed, [key], processor, out, "EventTime"), df, ts)


#: Device-sharing alerts with their users as stretches, which :func:`with_user_lists` turns into lists.
_STRETCHES = (("n", T.LongType()), ("run", T.StringType()), ("users", T.ArrayType(T.StringType())), ("come", T.ArrayType(T.LongType())),
              ("gone", T.ArrayType(T.LongType())))


def device_sharing_stream(df: DataFrame, limit: int = fraud.DEVICE_LIMIT, window: str = fraud.VELOCITY_WINDOW,
                          ts: str = "event_time", delay: str = DELAY, users: str = "lists") -> DataFrame:
    """Device-sharing alerts with the list of users, which the state holds anyway.

    The lists of a crowded device grow with the square of its rows. With ``users="stretches"`` the alerts carry the same users as
    stretches of time, each user once for a run of alerts; :func:`with_user_lists` makes lists of them where the alerts are read.
    Then rows without a device or a time are left out, as by the batch rule; lists are not made of rows without a time either.
    """
    if users not in ("lists", "stretches"):
        raise ValueError(f"unknown form {users!r}")
    known, w = df.where("user_id is not null"), micros(window)
    if users == "lists":
        hits = _members(known, "device_id", "user_id", LongTrailingMembers(w, limit), ts, delay, _apply_frames)
        n, told = F.size("members"), [F.col("members").alias("user_ids")]
    else:
        hits = _members(known.where(F.col(ts).isNotNull() & F.col("device_id").isNotNull()), "device_id", "user_id", StretchesOfMembers(w, limit), ts, delay, _apply_frames, _STRETCHES)
        n, told = F.col("n"), [F.col(c) for c in ("run", "users", "come", "gone")]
    message = F.format_string(fraud.MESSAGES[fraud.DEVICE_SHARING], F.col("device_id").cast("string"), n.cast("string"))
    return hits.select(*fraud.alert_columns(fraud.DEVICE_SHARING, message, ts, [n.cast("bigint").alias("unique_users"), *told]))


def with_user_lists(alerts: DataFrame) -> DataFrame:
    """Stored device-sharing alerts whose users came as stretches, with ``user_ids`` as :func:`device_sharing_stream` lists them."""
    at = epoch_us("detected_at")
    runs = alerts.where("users is not null").select("run", F.arrays_zip("users", "come", "gone").alias("_members"))
    there = F.filter("_members", lambda m: (m["come"] <= at) & (at <= m["gone"]))
    listed = F.array_sort(F.transform(there, lambda m: m["users"])).alias("user_ids")
    bare = alerts.drop("users", "come", "gone")
    return bare.join(runs, "run", "left").select(*[c for c in bare.columns if c != "run"], listed)


def geo_anomaly_stream(df: DataFrame, window: str = fraud.GEO_WINDOW, ts: str = "event_time", delay: str = DELAY) -> DataFrame:
    hits = _members(df.where("user_id is not null and city is not null"), "user_id", "city", TrailingMembers(micros(window), 1, new_only=True), ts, delay)
    hits = hits.withColumn("previous_cities", F.array_remove("members", F.col("city")))
    message = F.format_string(
        fraud.MESSAGES[fraud.GEO_ANOMALY], F.col("user_id").cast("string"), F.col("city"),
        F.array_join("previous_cities", ", "))
    return hits.select(*fraud.alert_columns(
        fraud.GEO_ANOMALY, message, ts, [F.col("city").alias("current_city"), F.col("previous_cities")]))


def fraud_stream(df: DataFrame, ts: str = "event_time", velocity_limit: int = fraud.VELOCITY_LIMIT,
                 velocity_window: str = fraud.VELOCITY_WINDOW, device_limit: int = fraud.DEVICE_LIMIT,
                 geo_window: str = fraud.GEO_WINDOW, threshold: float = fraud.HIGH_VALUE_LIMIT, delay: str = DELAY) -> DataFrame:
    """All four rules as one alert stream, before the cooldown."""
    return fraud.union_alerts(
        velocity_stream(df, velocity_limit, velocity_window, ts, delay),
        device_sharing_stream(df, device_limit, velocity_window, ts, delay),
        fraud.high_value_alerts(df, threshold, ts=ts),
        geo_anomaly_stream(df, geo_window, ts, delay),
    )


def attribution_by_arrival(orders: DataFrame, clicks: DataFrame, window: str, ts: str = "event_timestamp", delay: str = DELAY,
                           include_impressions: bool = False) -> DataFrame:
    """``orders`` as they arrive, with ``attributed``: judged once, by the clicks of user and item that came before them.

    Both streams become one tagged stream with one watermark; orders are neither held back for late clicks nor
    revised, so an order's result is final when it is emitted. Rows more than ``delay`` late are dropped.
    """
    source = clicks if include_impressions else clicks.where("event_type = 'click'")
    keys = ["user_id", "item_id"]
    bare = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in (*keys, ts) else F.col(f.name) for f in orders.schema.fields]
    tagged = orders.withColumn("is_order", F.lit(True)).unionByName(source.select(*bare).withColumn("is_order", F.lit(False)))
    timed = _watermarked(tagged.where("user_id is not null and item_id is not null"), ts, delay)
    out = T.StructType([*_extended(timed.drop("is_order")).fields, T.StructField("attributed", T.BooleanType())])
    return _like(_apply(timed, keys, ArrivalAttribution(micros(window)), out, "EventTime").drop("at_us"), orders, ts)
