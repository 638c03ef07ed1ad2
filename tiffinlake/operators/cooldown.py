"""Alert cooldown: per key, an alert passes only if none passed within the period before it.

The rule is greedy: whether an alert passes depends on which earlier ones did. But after an alert that
passes the next one is fixed, whatever came before: the first more than one period later. So every
alert has one successor, and what passes is the chain of successors from a key's first alert.

Time is cut into blocks of one period, in which at most one alert can pass. For each alert by which a
chain can enter a block, its row says where the chain leaves: the last alert that passed, and the
successor of that. Rows of neighbouring blocks compose by a join, successor with entry, and four blocks
become one in a round. Only entries from outside the larger block are kept, so each round has about a
quarter of the rows of the one before. Rounds go on until no key has more than ``walked`` rows, if any has
to begin with; then the chain through a key's rows is one walk over a short list. Rows list the alerts that
passed on the way until a block holds ``listed`` of them; rounds beyond that are walked back down, by the same joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import epoch_us, micros, time_bucket
from ..session import materialize

#: Blocks that become one in a round.
RADIX = 4
#: Alerts a row lists at most, and rows of a key that are walked as one list.
DEFAULT_LISTED, DEFAULT_WALKED = 4096, 4096


def cooldown(
    alerts: DataFrame, keys: list[str], ts: str = "detected_at", period: str = "5 minutes",
    tiebreak: list[str] | None = None, listed: int = DEFAULT_LISTED, walked: int = DEFAULT_WALKED,
) -> DataFrame:
    """The alerts that pass: the first per key, then each one more than ``period`` after the last that passed.

    Of several alerts at one instant the least by ``tiebreak`` (default: all columns) passes. Null
    keys are one key; alerts without a time do not pass. The alerts are used several times, so they
    are first written to the shared folder: the rules that produced them run once.
    """
    c = micros(period)
    rest = [x for x in alerts.columns if x not in keys]
    ties = tiebreak or [x for x in rest if x != ts]
    points = materialize(
        alerts.where(F.col(ts).isNotNull())
        .groupBy(F.struct(*keys).alias("_k"), epoch_us(ts).alias("_t"))
        .agg(F.min_by(F.struct(*rest), F.struct(*ties)).alias("_row")), "cooldown")
    passed = passing(points.select("_k", "_t"), c, listed, walked)
    return points.join(passed, ["_k", "_t"]).select(
        *[F.col("_k")[x].alias(x) if x in keys else F.col("_row")[x].alias(x) for x in alerts.columns])


def passing(times: DataFrame, period_us: int, listed: int = DEFAULT_LISTED, walked: int = DEFAULT_WALKED) -> DataFrame:
    """``_k, _t`` of the instants that pass, from distinct instants of each key."""
    rows = _entries(times, period_us)
    stored, length, number = [], 1, 0
    while (rows.groupBy("_k").count().agg(F.max("count")).first()[0] or 0) > max(1, walked):
        number += 1
        with_list = length * RADIX <= max(1, listed)
        if not with_list:
            stored.append((number, rows))
        rows = materialize(_compose(rows, number, with_list), "cooldown-round")
        length *= RADIX if with_list else 1
    entered = _walk(rows)
    # From the largest blocks down to those whose rows have lists.
    for number, below in reversed(stored):
        entered = materialize(_entered_below(entered, below, number), "cooldown-entered")
    lists = stored[0][1] if stored else rows
    return lists.join(entered, ["_k", "entry"]).select("_k", F.explode("passed").alias("_t"))


def _walk(rows: DataFrame) -> DataFrame:
    """The entries that each key's chain takes, from its first one on."""
    start = F.struct(F.lit(None).cast("bigint").alias("next"), F.array().cast("array<bigint>").alias("taken"))

    def step(done: Column, row: Column) -> Column:
        onward = F.struct(row["next"].alias("next"), F.array_append(done["taken"], row["entry"]).alias("taken"))
        return F.when((F.size(done["taken"]) == 0) | (done["next"] == row["entry"]), onward).otherwise(done)

    links = F.sort_array(F.collect_list(F.struct("entry", "next")))
    return rows.groupBy("_k").agg(links.alias("_links")).select(
        "_k", F.explode(F.aggregate("_links", start, step, lambda done: done["taken"])).alias("entry"))


def _entries(times: DataFrame, period_us: int) -> DataFrame:
    """One row for each instant that can pass: ``entry``, its block, the block of its first predecessor, and its successor.

    An instant that is no successor, and not the first of its key, never passes. Blocks count from the key's first.
    """
    blocked = times.withColumn("_b", time_bucket("_t", period_us))
    in_time = Window.partitionBy("_k").orderBy("_b")
    blocks = blocked.groupBy("_k", "_b").agg(F.min("_t").alias("_first"))
    blocks = blocks.select(
        "_k", "_b", F.min("_b").over(Window.partitionBy("_k")).alias("_b0"), F.lag("_b").over(in_time).isNull().alias("_opens"), "_first",
        F.lead("_b").over(in_time).alias("_b1"), F.lead("_first").over(in_time).alias("_f1"), F.lead("_first", 2).over(in_time).alias("_f2"))
    # What each instant meets in the next block: of instants and probes there, the first instant after the probe.
    instants = blocked.select("_k", "_b", "_t", F.lit(0).alias("_probe"), F.col("_t").alias("_at"))
    probes = blocked.select("_k", (F.col("_b") + 1).alias("_b"), "_t", F.lit(1).alias("_probe"), (F.col("_t") + period_us).alias("_at"))
    # Backwards in time, so that the window is a running one.
    after = Window.partitionBy("_k", "_b").orderBy(F.desc("_at"), F.desc("_probe")).rowsBetween(Window.unboundedPreceding, -1)
    met = instants.unionByName(probes).withColumn("_met", F.last(F.when(F.col("_probe") == 0, F.col("_at")), ignorenulls=True).over(after))
    met = met.where("_probe = 1").select("_k", (F.col("_b") - 1).alias("_b"), "_t", "_met")
    first = F.col("_opens") & (F.col("_t") == F.col("_first"))
    successor = F.when(F.col("_b1") == F.col("_b") + 1, F.coalesce("_met", "_f2")).otherwise(F.col("_f1"))
    linked = materialize(met.join(blocks, ["_k", "_b"]).select(
        "_k", F.col("_t").alias("entry"), (F.col("_b") - F.col("_b0")).alias("block"), first.alias("_opens"), successor.alias("next")), "cooldown-links")
    reached = linked.where("next is not null").groupBy("_k", F.col("next").alias("entry")).agg(F.min("block").alias("source"))
    rows = linked.join(reached, ["_k", "entry"], "left").where("_opens or source is not null")
    return materialize(rows.select("_k", "entry", "block", "source", "next", F.array("entry").alias("passed")), "cooldown-entries")


def _parent(block: Column, number: int) -> Column:
    """The block that ``block`` is part of after so many rounds."""
    return F.floor(block / F.lit(RADIX ** number))


def _onward(rows: DataFrame, number: int) -> DataFrame:
    """The rows as the next part of a chain: by the entry, in which larger block."""
    return rows.select(F.col("_k").alias("_ko"), F.col("entry").alias("_eo"), _parent(F.col("block"), number).alias("_po"),
                       F.col("next").alias("_no"), F.col("passed").alias("_lo"))


def _compose(rows: DataFrame, number: int, with_list: bool) -> DataFrame:
    """Rows of the blocks after round ``number``: chains followed through all parts of the larger block."""
    here = _parent(F.col("block"), number)
    out = rows.where(F.col("source").isNull() | (_parent(F.col("source"), number) < here))
    further = _onward(rows, number)
    for _ in range(RADIX - 1):
        out = out.join(further, (F.col("_k") == F.col("_ko")) & (F.col("next") == F.col("_eo")) & (here == F.col("_po")), "left")
        onward = F.col("_eo").isNotNull()
        listed = F.when(onward, F.concat("passed", "_lo")).otherwise(F.col("passed")) if with_list else F.lit(None).cast("array<bigint>")
        out = out.select("_k", "entry", "block", "source", F.when(onward, F.col("_no")).otherwise(F.col("next")).alias("next"), listed.alias("passed"))
    return out


def _entered_below(entered: DataFrame, below: DataFrame, number: int) -> DataFrame:
    """The entries of the parts of blocks that were entered at these."""
    rows = below.select("_k", "entry", "next", _parent(F.col("block"), number).alias("parent"))
    step = entered.join(rows, ["_k", "entry"])
    out = step.select("_k", "entry")
    further = _onward(below, number).select("_ko", "_eo", "_po", "_no")
    for _ in range(RADIX - 1):
        step = step.join(further, (F.col("_k") == F.col("_ko")) & (F.col("next") == F.col("_eo")) & (F.col("parent") == F.col("_po"))).select(
            "_k", F.col("_eo").alias("entry"), F.col("_no").alias("next"), "parent")
        out = out.unionByName(step.select("_k", "entry"))
    return out
