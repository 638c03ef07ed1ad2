"""Time-interval matching and trailing-window aggregates that survive a hot key.

All of them share one idea. Cut time into buckets as wide as the window; then a window
``[t - w, t]`` touches the bucket of ``t`` and the one before, nothing else. What the previous
bucket contributes is aggregated before the shuffle and carried forward, so rows are grouped by
(key, bucket) instead of by key: a key holding a third of the data is split over all its buckets.
Within one (key, bucket) rows of equal time are merged first, so a group holds at most one narrow
row per clock tick of the window, however many copies the input has; a group that is still large is
walked in slices at measured counts, each starting from the total of those before. No pair of rows is formed
except in :func:`interval_join`, whose result is the pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import epoch_us, micros, time_bucket
from ..session import materialize

# Rows of a (key, bucket) that one task walks; larger ones are cut into slices of so many at cells of the bucket.
SLICE_ROWS = 500_000
CELLS = 4096
# Order of the steps at one instant.
_ENTER, _PROBE, _LEAVE = 0, 1, 2


def _all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def has_prior(
    probe: DataFrame, source: DataFrame, keys: list[str], probe_ts: str, source_ts: str,
    window: str | int, lag_us: int = 0, flag: str = "matched",
) -> DataFrame:
    """``probe`` plus a flag: does ``source`` hold a row of the same key in ``[t - window, t]``?

    ``t`` is the probe time plus ``lag_us``. Both bounds are inclusive to the microsecond. In its
    own bucket a source row qualifies iff it is not later than the probe, so the earliest one
    decides; in the previous bucket iff it is late enough, so the latest one decides. Two numbers
    per (key, bucket) replace the join's candidate rows, and the lookup side is unique.
    """
    w = micros(window)
    bounds = (
        source.where(_all_present(keys) & F.col(source_ts).isNotNull())
        .select(*keys, epoch_us(source_ts).alias("_t"))
        .groupBy(*keys, time_bucket("_t", w).alias("_b"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    )
    lookup = (
        bounds.select(
            *keys,
            F.explode(F.array(
                F.struct(F.col("_b").alias("_b"), F.col("_first").alias("_first"), F.lit(None).cast("bigint").alias("_last")),
                F.struct((F.col("_b") + 1).alias("_b"), F.lit(None).cast("bigint").alias("_first"), F.col("_last").alias("_last")),
            )).alias("_x"),
        )
        .select(*keys, "_x.*")
        .groupBy(*keys, "_b")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    )
    timed = probe.withColumn("_p", epoch_us(probe_ts) + F.lit(lag_us)).withColumn("_b", time_bucket("_p", w))
    hit = (F.col("_first") <= F.col("_p")) | (F.col("_last") >= F.col("_p") - w)
    return (
        timed.join(lookup, [*keys, "_b"], "left")
        .select(*[F.col(c) for c in probe.columns], F.coalesce(hit, F.lit(False)).alias(flag))
    )


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
    window: str | int, how: str = "inner",
) -> DataFrame:
    """Pairs of the same key with ``right_ts`` in ``[left_ts, left_ts + window]``.

    Each left row looks into its own time bucket and the next, each right row lives in one bucket,
    so a pair meets once and a hot key is spread over its buckets. ``how`` may be ``inner``,
    ``left`` or ``full``; unmatched rows come from the pairless existence test. Column names of
    the two sides must differ apart from the keys. Use :func:`interval_totals` or
    :func:`has_prior` where only counts, sums or existence are needed.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    w = micros(window)
    lefts = (
        left.withColumn("_l", epoch_us(left_ts))
        .withColumn("_lb", F.explode(F.array(time_bucket("_l", w), time_bucket("_l", w) + 1)))
    )
    rights = right.withColumn("_r", epoch_us(right_ts)).withColumn("_rb", time_bucket("_r", w))
    on = [lefts[k] == rights[k] for k in keys] + [lefts["_lb"] == rights["_rb"]]
    columns = [lefts[c] for c in left.columns] + [rights[c] for c in right.columns if c not in keys]
    inner = (
        lefts.join(rights, reduce(lambda a, b: a & b, on), "inner")
        .where((F.col("_r") >= F.col("_l")) & (F.col("_r") <= F.col("_l") + w))
        .select(*columns)
    )
    if how == "inner":
        return inner
    alone = has_prior(left, right, keys, left_ts, right_ts, window, lag_us=w).where(~F.col("matched")).drop("matched")
    out = inner.unionByName(alone, allowMissingColumns=True)
    if how == "full":
        spare = has_prior(right, left, keys, right_ts, left_ts, window).where(~F.col("matched")).drop("matched")
        out = out.unionByName(spare, allowMissingColumns=True)
    return out


def _in_slices(rows: DataFrame, group: list[str], at: str, start: Column, width: int, measures: dict[str, Column],
               sizes: DataFrame, slice_rows: int) -> DataFrame:
    """``rows`` plus ``_slice`` and, for each measure, ``_base_<name>``: its total over the group's earlier slices.

    ``sizes`` has a count ``_n`` for each group. Groups of at most ``slice_rows`` rows are one slice; mostly
    there are no others. A larger one is cut between the cells of its time line at measured counts, so that no
    slice has more rows than that and one cell; rows of one instant stay together. Only the cells of
    large groups are looked up, a few for each slice of theirs.
    """
    nothing = [F.lit(0).alias("_slice"), *[F.lit(0).alias(f"_base_{n}") for n in measures]]
    large = sizes.where(F.col("_n") > slice_rows).select(*group)
    if large.isEmpty():
        return rows.select("*", *nothing)
    cell = F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor((F.col(at) - start) * (CELLS / width)))).cast("int")
    placed = rows.withColumn("_cell", cell)
    cells = placed.join(large, group, "left_semi").groupBy(*group, "_cell").agg(
        F.count(F.lit(1)).alias("_n"), *[m.alias(f"_sum_{n}") for n, m in measures.items()])
    earlier = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    cut = cells.withColumn("_slice", F.floor(before("_n") / F.lit(slice_rows)).cast("int")).select(
        "*", *[before(f"_sum_{n}").alias(f"_until_{n}") for n in measures])
    first = Window.partitionBy(*group, "_slice").orderBy("_cell")
    lookup = materialize(cut.select(*group, "_cell", "_slice", *[F.first(f"_until_{n}").over(first).alias(f"_base_{n}") for n in measures]), "slices")
    # Groups have no null keys: these are left out before.
    return placed.join(lookup, [*group, "_cell"], "left").select(
        *rows.columns, F.coalesce("_slice", F.lit(0)).alias("_slice"), *[F.coalesce(f"_base_{n}", F.lit(0)).alias(f"_base_{n}") for n in measures])


def _running(points: DataFrame, keys: list[str], totals: list[str], width: int, instants: DataFrame, slice_rows: int) -> DataFrame:
    """Running totals of signed steps within (key, bucket), steps of one instant and phase together.

    ``instants`` are rows with key and bucket of which each brings at most a few steps to its bucket and the next.
    """
    sizes = instants.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    next_too = F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b")
    sizes = sizes.where(F.col("_n") * 6 > slice_rows).select(*keys, next_too, (F.col("_n") * 3).alias("_n")).groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
    cut = _in_slices(points, [*keys, "_b"], "_at", F.col("_b") * F.lit(width), width, {c: F.sum(c) for c in totals}, sizes, slice_rows)
    w = (
        Window.partitionBy(*keys, "_b", "_slice").orderBy("_at", "_phase")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cut.select(*points.columns, *[(F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_base_{c}")).alias(f"_run_{c}") for c in totals])


def interval_totals(
    probe: DataFrame, source: DataFrame, keys: list[str], probe_ts: str, source_ts: str,
    window: str | int, measures: dict[str, Column], lower: str = "closed", lag_us: int = 0, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Totals of ``source`` over the trailing window of every distinct probe point.

    Returns one row per distinct (key, probe time) with each measure summed over the source rows
    of that key in ``[t - window, t]`` (``(t - window, t]`` with ``lower="open"``), ``t`` being
    the probe time plus ``lag_us``. A source row enters at its own time and leaves one window
    later; the running total within (key, bucket) starts from the previous bucket's total.
    """
    w = micros(window)
    leave_phase = _LEAVE if lower == "closed" else _ENTER
    names = list(measures)
    points = (
        source.where(_all_present(keys) & F.col(source_ts).isNotNull())
        .select(*keys, epoch_us(source_ts).alias("_at"), *[m.alias(n) for n, m in measures.items()])
        .groupBy(*keys, "_at", time_bucket("_at", w).alias("_b"))
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    enter = F.struct(
        F.col("_b").alias("_b"), F.col("_at").alias("_at"), F.lit(_ENTER).alias("_phase"),
        *[F.col(n).alias(n) for n in names])
    leave = F.struct(
        (F.col("_b") + 1).alias("_b"), (F.col("_at") + w).alias("_at"), F.lit(leave_phase).alias("_phase"),
        *[(-F.col(n)).alias(n) for n in names])
    steps = points.select(*keys, F.explode(F.array(enter, leave)).alias("_x")).select(*keys, "_x.*")
    carried = (
        points.groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in names])
        .select(*keys, (F.col("_b") + 1).alias("_b"), ((F.col("_b") + 1) * w - 1).alias("_at"),
                F.lit(_ENTER).alias("_phase"), *names)
    )
    probes = (
        probe.where(_all_present(keys) & F.col(probe_ts).isNotNull())
        .select(*keys, (epoch_us(probe_ts) + F.lit(lag_us)).alias("_at")).distinct()
        .select(*keys, time_bucket("_at", w).alias("_b"), "_at", F.lit(_PROBE).alias("_phase"))
    )
    moves = steps.unionByName(carried).unionByName(probes, allowMissingColumns=True)
    buckets = lambda df, ts, lag: df.where(_all_present(keys) & F.col(ts).isNotNull()).select(
        *keys, time_bucket(epoch_us(ts) + F.lit(lag), w).alias("_b"))
    source_buckets, probe_buckets = buckets(source, source_ts, 0), buckets(probe, probe_ts, lag_us)
    return (
        _running(moves, keys, names, w, source_buckets.unionByName(probe_buckets), slice_rows)
        .where(F.col("_phase") == _PROBE)
        .select(*keys, (F.col("_at") - F.lit(lag_us)).alias("at_us"),
                *[F.col(f"_run_{n}").alias(n) for n in names])
    )


def presence(source: DataFrame, keys: list[str], member: str, ts: str, window: str | int) -> DataFrame:
    """Per (key, bucket, member): first time in the bucket, last time in the previous one.

    A member was seen in ``[t - window, t]`` iff ``first_us <= t`` or ``last_us >= t - window``.
    """
    w = micros(window)
    seen = (
        source.where(_all_present([*keys, member]) & F.col(ts).isNotNull())
        .select(*keys, member, epoch_us(ts).alias("_t"))
        .groupBy(*keys, member, time_bucket("_t", w).alias("bucket"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    )
    none = F.lit(None).cast("bigint")
    return (
        seen.select(*keys, member, F.explode(F.array(
            F.struct(F.col("bucket").alias("bucket"), F.col("_first").alias("first_us"), none.alias("last_us")),
            F.struct((F.col("bucket") + 1).alias("bucket"), none.alias("first_us"), F.col("_last").alias("last_us")),
        )).alias("_x"))
        .select(*keys, member, "_x.*")
        .groupBy(*keys, member, "bucket")
        .agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))
    )


def trailing_distinct(
    source: DataFrame, keys: list[str], member: str, ts: str, window: str | int, out: str = "n_distinct", slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Distinct members of each key in ``[t - window, t]`` at every time the key has a row.

    Each member's presence within a bucket is at most two stretches, so it turns into at most
    three signed steps, and the running sum of steps is the distinct count.
    """
    w = micros(window)
    seen = presence(source, keys, member, ts, window).withColumnRenamed("bucket", "_b")
    start = F.col("_b") * w - 1
    step = lambda at, phase, value: F.struct(
        at.alias("_at"), F.lit(phase).alias("_phase"), F.lit(value).alias("_d"))
    carried = F.col("last_us").isNotNull()
    unbroken = carried & (F.col("first_us") <= F.col("last_us") + w)
    steps = F.array_compact(F.array(
        F.when(carried, step(start, _ENTER, 1)),
        F.when(carried & F.coalesce(~unbroken, F.lit(True)), step(F.col("last_us") + w, _LEAVE, -1)),
        F.when(F.col("first_us").isNotNull() & F.coalesce(~unbroken, F.lit(True)), step(F.col("first_us"), _ENTER, 1)),
    ))
    moves = (
        seen.select(*keys, "_b", F.explode(steps).alias("_x")).select(*keys, "_b", "_x.*")
        .groupBy(*keys, "_b", "_at", "_phase").agg(F.sum("_d").alias("_d"))
    )
    probes = (
        source.where(_all_present([*keys, member]) & F.col(ts).isNotNull())
        .select(*keys, epoch_us(ts).alias("_at")).distinct()
        .select(*keys, time_bucket("_at", w).alias("_b"), "_at", F.lit(_PROBE).alias("_phase"))
    )
    source_buckets = source.where(_all_present([*keys, member]) & F.col(ts).isNotNull()).select(*keys, time_bucket(epoch_us(ts), w).alias("_b"))
    return (
        _running(moves.unionByName(probes, allowMissingColumns=True), keys, ["_d"], w, source_buckets, slice_rows)
        .where(F.col("_phase") == _PROBE)
        .select(*keys, F.col("_at").alias("at_us"), F.col("_run__d").alias(out))
    )


def running_count(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], slice_: str = "1 hour",
                  out: str = "running_count", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus how many rows of the key came up to and including each row, in (ts, tiebreak) order.

    Counts per (key, time slice) are taken first; a row's count is the total of earlier slices plus
    its position in its own. A slice with very many rows is cut again, so no task has to walk a
    whole key or a busy hour of one.
    """
    width = micros(slice_)
    present = df.where(_all_present(keys) & F.col(ts).isNotNull())
    sliced = present.withColumn("_at", epoch_us(ts)).withColumn("_b", time_bucket("_at", width))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        sliced.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    sizes = sliced.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    cut = _in_slices(sliced, [*keys, "_b"], "_at", F.col("_b") * F.lit(width), width, {"n": F.count(F.lit(1))}, sizes, slice_rows)
    within = Window.partitionBy(*keys, "_b", "_slice").orderBy(ts, *tiebreak)
    return (
        cut.join(base, [*keys, "_b"])
        .select(*[F.col(c) for c in df.columns], (F.col("_base") + F.col("_base_n") + F.row_number().over(within)).alias(out))
    )


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str | int) -> DataFrame:
    """Gap-based sessions per key: a silence of ``gap`` or more starts a new one.

    Rows of one key in one gap-wide bucket always share a session, so they are merged before the
    shuffle; sessions are then chained over buckets, of which a key has few.
    """
    g = micros(gap)
    stretches = (
        df.where(_all_present(keys) & F.col(ts).isNotNull())
        .select(*keys, epoch_us(ts).alias("_t"))
        .groupBy(*keys, time_bucket("_t", g).alias("_b"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_n"))
    )
    by_time = Window.partitionBy(*keys).orderBy("_b")
    opens = F.coalesce((F.col("_first") - F.lag("_last").over(by_time) >= g).cast("int"), F.lit(1))
    return (
        stretches.withColumn("_opens", opens)
        .withColumn("session_no", F.sum("_opens").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "session_no")
        .agg(F.min("_first").alias("start_us"), F.max("_last").alias("last_us"), F.sum("_n").alias("n_events"))
    )


def inactive_keys(df: DataFrame, keys: list[str], ts: str, gap: str | int) -> DataFrame:
    """When each key's inactivity timer fires: once per silence of ``gap``, at last activity plus gap."""
    return (
        sessions(df, keys, ts, gap)
        .select(*keys, "last_us", (F.col("last_us") + micros(gap)).alias("fired_us"), "n_events")
    )
