"""SimHash near-duplicates: a fingerprint per text, a binary trie self-join within a bit budget, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tiffinlake.session import materialize

from .components import components
from .support import lean, small_batches

SHINGLE_WORDS = 3
MAX_BITS = 2
# Fingerprints of one trie; a larger one is split further down before any task sees it.
TRIE_LIMIT = 512
_HASH_BLOCK = 65_536


def text_fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text: XXH64 (seed 42) of its word shingles, a bit set by over half of them."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, k = b" ".join(words), min(words_per_shingle, len(words))
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _HASH_BLOCK):
        to = min(n, at + _HASH_BLOCK)
        hashes = np.array([digest(line[s:e - 1], 42) for s, e in zip(starts[at:to], starts[at + k:to + k])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: Column, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text column as a (signed) long; a null text has the fingerprint of an empty one, zero."""

    @pandas_udf("long")
    @lean
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([text_fingerprint(t, words_per_shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return simhash(text)


def _bits_in_runs(bits: list[int], runs: int) -> list[int]:
    """Masks of ``runs`` nearly equal runs of the given bit positions."""
    cut = [len(bits) * i // runs for i in range(runs + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cut, cut[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def trie_pairs(values: np.ndarray, groups: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of one group whose values differ in at most ``max_bits`` bits.

    ``values`` (uint64) are distinct and ascending within each group, so that a trie node is a range.
    The tries of all groups are walked together, one bit a step: a node pair has the children
    0-0 and 1-1 with its count of differing bits, 0-1 and 1-0 with one more, and is dropped when a
    side is empty or the count exceeds the budget.
    """
    edge = np.flatnonzero(np.diff(groups)) + 1
    lo, hi = np.r_[0, edge].astype(np.int64), np.r_[edge, len(values)].astype(np.int64)
    frontier = np.stack([lo, hi, lo, hi, np.zeros_like(lo)])
    found = []
    for bit in range(63, -1, -1):
        a, b, c, d, _ = frontier
        same = a == c
        frontier = frontier[:, np.where(same, b - a > 1, True)]
        alone = (frontier[1] - frontier[0] == 1) & (frontier[3] - frontier[2] == 1)
        if alone.any():  # two leaves: the rest of the path is one comparison
            x, y = frontier[0, alone], frontier[2, alone]
            near = np.bitwise_count(values[x] ^ values[y]) <= max_bits
            found.append(np.stack([x[near], y[near]]))
            frontier = frontier[:, ~alone]
        if not frontier.shape[1]:
            break
        zeros = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1) == 0)]
        a, b, c, d, differ = frontier
        left, right = a + zeros[b] - zeros[a], c + zeros[d] - zeros[c]
        same = a == c
        children = [np.stack([a, left, c, right, differ]), np.stack([left, b, right, d, differ]),
                    np.stack([a, left, right, d, differ + 1]),
                    np.stack([left, b, c, right, differ + 1])[:, ~same]]
        frontier = np.concatenate(children, axis=1)
        frontier = frontier[:, (frontier[1] > frontier[0]) & (frontier[3] > frontier[2]) & (frontier[4] <= max_bits)]
    else:
        # All bits are walked: ranges hold one value each, as values are distinct.
        a, _, c, _, _ = frontier
        found.append(np.stack([a[a != c], c[a != c]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
    return pairs[0], pairs[1]


def _linked(values: np.ndarray, groups: np.ndarray, max_bits: int) -> pd.DataFrame:
    """Each value linked to the lowest position its links reach inside its group: a star, never all pairs."""
    x, y = trie_pairs(values, groups, max_bits)
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(values)))
    signed = values.view(np.int64)
    return pd.DataFrame({"a": signed[moved], "b": signed[label[moved]]})


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, limit: int = TRIE_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct fingerprints ``fp`` within ``max_bits`` bits.

    Within the budget, two fingerprints agree on at least one of ``max_bits + 1`` runs of bits. Each
    run roots a trie join whose first levels have no budget: the fingerprints are grouped by the
    run's value and only groups are joined. A group above ``limit`` is rooted again, on runs of its
    remaining bits, until it is small, so that no task holds a large one. Links found inside a group
    are given as a star, so that a dense group yields no more rows than it has fingerprints.
    """
    spark = prints.sparkSession
    runs = max_bits + 1
    rest = {mask: [b for b in range(64) if not mask >> b & 1] for mask in _bits_in_runs(list(range(64)), runs)}
    level = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in rest])).alias("mask"))
    out = None

    @lean
    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            last = (frame["mask"] == frame["mask"].iloc[-1]) & (frame["key"] == frame["key"].iloc[-1])
            held, frame = frame[last], frame[~last]
            if len(frame):
                yield _group_links(frame, max_bits)
        if held is not None and len(held):
            yield _group_links(held, max_bits)

    while True:
        level = materialize(level.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "tries")
        sizes = materialize(level.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "tries")
        small = level.join(sizes.where(F.col("n") <= limit), ["mask", "key"])
        sign = F.lit(-(1 << 63)).cast("long")
        links = (small.select("mask", "key", "fp").repartition("mask", "key")
                 .sortWithinPartitions("mask", "key", F.col("fp").bitwiseXOR(sign))
                 .mapInPandas(join, "a long, b long"))
        out = links if out is None else out.unionByName(links)
        if sizes.where(F.col("n") > limit).isEmpty():
            return out
        deeper = {}
        for mask, bits in rest.items():
            for run in _bits_in_runs(bits, runs):
                deeper.setdefault(mask, []).append(mask | run)
        choose = F.create_map(*[x for mask, more in deeper.items() for x in (
            F.lit(_signed(mask)), F.array(*[F.lit(_signed(m)) for m in more]))])
        hot = level.join(sizes.where(F.col("n") > limit), ["mask", "key"])
        level = hot.select("fp", F.explode(choose[F.col("mask")]).alias("mask")).distinct()
        rest = {m: [b for b in range(64) if not m >> b & 1] for more in deeper.values() for m in more}


def _group_links(frame: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    mask, key = frame["mask"].to_numpy(), frame["key"].to_numpy()
    new = np.r_[False, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
    return _linked(frame["fp"].to_numpy().astype(np.int64).view(np.uint64), np.cumsum(new), max_bits)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS,
            max_bits: int = MAX_BITS, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the ``carry`` columns, ``fp`` and ``class``, the root fingerprint of its class."""
    small_batches(docs.sparkSession)
    rows = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), *(carry or []),
                                   fingerprint(F.col(text_col), words_per_shingle).alias("fp")), "simhash")
    prints = materialize(rows.select("fp").distinct(), "prints")
    roots = components(near_links(prints, max_bits)).withColumnRenamed("node", "fp")
    # Only linked fingerprints have a root of their own table; all others are their own class.
    return rows.join(roots, "fp", "left").select("doc_id", *(carry or []), "fp", F.coalesce("root", "fp").alias("class"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (long) and ``component_id``, the lowest id reachable.

    Fingerprints link when they differ in at most ``max_bits`` bits. Copies are one fingerprint and
    are never expanded. A null or empty text has fingerprint zero and links like any other; rows
    with a null id keep their row and count for a component's links, not for its id (null if it has
    no other); repeated rows stay; other columns are not read. An empty table gives an empty one.
    """
    marked = materialize(classes(docs, id_col, text_col, words_per_shingle, max_bits), "classes")
    lowest = marked.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return marked.join(lowest, "class").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
