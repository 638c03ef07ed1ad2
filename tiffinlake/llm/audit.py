"""Filter interaction audit: what every filter removes at every step of every order, from one table of counts.

A row either passes or fails each filter, whatever the others do, so the counts of the 2 x 2 x ... x 2
combinations in a part of the table answer every question about orders. They form a tensor with
one axis for each filter. An order's step selects "pass" along the axes of earlier filters, "fail"
or "pass" along its own and "all" along later ones; one contraction gives all steps of all orders.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tiffinlake.session import materialize

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
# Parts contracted at once in a task.
PARTS_AT_ONCE = 64
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Maximal runs of other characters than ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def text_digest(text: Column) -> Column:
    """32 bytes that tell texts apart; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def failures(rows: DataFrame, filters: Mapping[str, Column], keep: Sequence[str | Column]) -> DataFrame:
    """The kept columns and ``mask``, whose bit i says that the row fails the i-th filter; a filter that is null is passed."""
    bits = [F.when(F.coalesce(test, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(filters.values())]
    return rows.select(*keep, sum(bits[1:], bits[0]).alias("mask"))


def fail_repeats(rows: DataFrame, bit: int, id_col: str = "doc_id", digest_col: str = "digest") -> DataFrame:
    """``rows`` with the bit set where a row of the same digest, anywhere in the table, has a smaller id.

    A row without id is neither smaller nor greater than another, and rows of equal id and digest
    are not each other's repeats. Each digest's least id is found by an aggregate and joined on id
    and digest, so a text that a third of the table repeats is no hot key.
    """
    least = rows.groupBy(digest_col).agg(F.min(id_col).alias(id_col)).where(F.col(id_col).isNotNull()).withColumn("__first", F.lit(True))
    known, nameless = rows.where(F.col(id_col).isNotNull()), rows.where(F.col(id_col).isNull())
    marked = known.join(least, [id_col, digest_col], "left")
    marked = marked.withColumn("mask", F.col("mask").bitwiseOR(F.when(F.col("__first"), 0).otherwise(1 << bit)))
    return marked.select(rows.columns).unionByName(nameless)


def selectors(letters: Sequence[str], orders: Sequence[Sequence[str]]) -> dict[str, np.ndarray]:
    """For each measure an array (order and step, filter, 2) of what is chosen along the filters' axes."""
    out = {name: [] for name in ("kept", "removed", "failing", "unique_fails")}
    for order in orders:
        for step, letter in enumerate(order):
            before = set(order[:step])
            earlier = [PASS if x in before else ALL for x in letters]
            own = list(letters).index(letter)
            out["kept"].append([PASS if i == own else s for i, s in enumerate(earlier)])
            out["removed"].append([FAIL if i == own else s for i, s in enumerate(earlier)])
            out["failing"].append([FAIL if i == own else ALL for i in range(len(letters))])
            out["unique_fails"].append([FAIL if i == own else PASS for i in range(len(letters))])
    return {name: np.array(chosen, dtype=np.int64) for name, chosen in out.items()}


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts (part, measure, order and step) under the choices; the tensor has axes part, measure and one of two for each filter."""
    axes = "cdefghij"[:tensor.ndim - 2]
    choices = [chosen[:, i] for i in range(len(axes))]
    return np.einsum(f"ab{axes}," + ",".join(f"z{x}" for x in axes) + "->abz", tensor, *choices)


def audit(rows: DataFrame, letters: str, part_col: str = "part", lost: Sequence[str] = (), orders: Sequence[str] | None = None) -> DataFrame:
    """One row for each part, order of the filters and step, from rows with a ``mask`` of the filters they fail.

    ``letters`` names the filters, lowest bit first, eight at most; ``orders`` are all permutations if not given.
    ``lost`` names columns with how often a row counts as one that should not be removed. An optional column ``n``
    is the number of equal rows a row stands for. Columns: the part, ``filter_order``, ``step`` (from 1), ``kept``,
    ``removed``, ``redundant`` (fails this filter, removed before), ``unique_fails`` (fails this filter only),
    ``<name>_lost`` and ``shapley`` (the filter's removed, summed over all orders). An empty table gives no rows.
    """
    if not 0 < len(letters) <= 8 or len(set(letters)) != len(letters):
        raise ValueError("one to eight filters with different letters")
    letters = list(letters)
    orders = ["".join(o) for o in permutations(letters)] if orders is None else list(orders)
    if any(sorted(o) != sorted(letters) for o in orders):
        raise ValueError("an order names every filter once")
    many = F.col("n") if "n" in rows.columns else F.lit(1)
    measures = ["n", *lost]
    # At most 2 ** len(letters) cells a part, combined before the shuffle.
    cells = rows.groupBy(F.col(part_col).alias("part"), "mask").agg(
        F.sum(many).cast("long").alias("n"), *[F.sum(many * F.col(c)).cast("long").alias(c) for c in lost])
    tables = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *measures)).alias("cells"))
    chosen = selectors(letters, orders)
    own = np.array([letters.index(x) for o in orders for x in o])
    step = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders))
    named = np.repeat(np.array(orders, dtype=object), len(letters))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), PARTS_AT_ONCE):
                some = frame.iloc[at:at + PARTS_AT_ONCE]
                tensor = np.zeros((len(some), len(measures), 1 << len(letters)), dtype=np.int64)
                for i, found in enumerate(some["cells"]):
                    for cell in found:
                        tensor[i, :, cell["mask"]] = [cell[m] or 0 for m in measures]
                # The last axis of a reshaped mask is its lowest bit; filters go lowest bit first.
                tensor = tensor.reshape(len(some), len(measures), *[2] * len(letters))
                tensor = tensor.transpose(0, 1, *range(tensor.ndim - 1, 1, -1))
                kept, failing, alone = (contract(tensor[:, :1], chosen[m])[:, 0] for m in ("kept", "failing", "unique_fails"))
                removed = contract(tensor, chosen["removed"])
                by_filter = np.stack([removed[:, 0, own == i].sum(axis=1) for i in range(len(letters))], axis=1)
                for i, part in enumerate(some["part"]):
                    yield pd.DataFrame({
                        "part": part, "filter_order": named, "step": step, "kept": kept[i], "removed": removed[i, 0],
                        "redundant": failing[i] - removed[i, 0], "unique_fails": alone[i],
                        **{f"{c}_lost": removed[i, j] for j, c in enumerate(lost, 1)}, "shapley": by_filter[i, own]})

    kinds = ["part string", "filter_order string", "step int", "kept long", "removed long", "redundant long", "unique_fails long",
             *[f"`{c}_lost` long" for c in lost], "shapley long"]
    return tables.select(F.col("part").cast("string"), "cells").mapInPandas(work, ", ".join(kinds))


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the four filters that look at one text: short, repetitive, loud, symbols."""
    text = F.coalesce(text, F.lit(""))
    all_words = words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(all_words) < 100, "B": 100 * F.size(F.array_distinct(all_words)) < 80 * F.size(all_words),
            "C": 100 * capitals > 10 * F.length(text), "D": text.rlike("[#$%&*|]")}


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over whole texts, one part for each language; null languages are the empty one.

    E fails texts that an earlier document has too. A document is good or toxic if any of its labels says so;
    labels without id count for nothing. Equal rows are counted before anything is joined.
    """
    keep = ["doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_digest(F.col("text")).alias("digest")]
    rows = failures(docs, text_filters(F.col("text")), keep)
    rows = materialize(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "filters")
    marked = fail_repeats(rows, 4)
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    known = marked.where("doc_id is not null").join(said, "doc_id", "left").fillna(0, ["good", "toxic"])
    nameless = marked.where("doc_id is null").withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
    return audit(known.unionByName(nameless), "ABCDE", lost=("good", "toxic"))
