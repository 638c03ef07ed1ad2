"""Shards that each hold the whole mixture: seeded-shuffled rows of every source, interleaved by their fractional rank, and cut.

A row's fractional rank is its place in its source's seeded order over the source's size. In the
order of this number every stretch holds each source in proportion, so that equal cuts are shards of
equal size and mixture. Ranks are counted in slices: a slice begins where the earlier ones end, and
no window holds a whole source or the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tiffinlake.session import materialize

HASH_DIGITS = 3  # hex digits of the seeded hash that name a slice of a source
RANK_SLICES = 4096  # slices of the fractional ranks


def text_bytes(text: Column) -> Column:
    """Size of a row: UTF-8 bytes of its text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def interleave(docs: DataFrame, shards: int, source_col: str = "source", key_col: str = "doc_id", text_col: str = "text",
               seed: int = 1) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``source``, ``shard`` and ``slot`` of every row.

    Shards differ by one row at most, slots count from 0 without gaps, and of each source a shard
    holds its share to within one row or two. Only a short row of each document moves, its
    text never. A null source is a source, a null key a key, a null text has checksum 0; rows equal
    in key and text follow each other and keep a slot each. An empty table gives an empty one.
    """
    crc = F.coalesce(F.crc32(F.col(text_col)), F.lit(0).cast("long"))
    rows = docs.select(F.col(key_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("size"), crc.alias("text_crc32"),
                       F.col(source_col).cast("string").alias("source"))
    # A null source gets a name no other has, so that it can be a join key.
    rows = (rows.withColumn("__s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
            .withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"))))
            .withColumn("__slice", F.substring("__h", 1, HASH_DIGITS)))
    rows = materialize(rows, "short")
    counts = rows.groupBy("__s", "__slice").agg(F.count("*").alias("n"))
    by_source = Window.partitionBy("__s")
    before = counts.select("__s", "__slice", F.sum("n").over(by_source).alias("__of"),
                           (F.sum("n").over(by_source.orderBy("__slice")) - F.col("n")).alias("__before"))
    within = Window.partitionBy("__s", "__slice").orderBy("__h", "doc_id", "size")
    ranked = rows.join(before, ["__s", "__slice"]).withColumn("__rank", F.col("__before") + F.row_number().over(within))
    share = (F.col("__rank") - F.lit(0.5)) / F.col("__of")
    ranked = ranked.withColumn("__f", share).withColumn("__g", F.floor(F.col("__f") * RANK_SLICES).cast("int"))
    ranked = materialize(ranked.select("doc_id", "size", "text_crc32", "source", "__s", "__h", "__f", "__g"), "ranked")
    starts = ranked.groupBy("__g").agg(F.count("*").alias("n"))  # at most RANK_SLICES rows
    everywhere = Window.partitionBy(F.lit(0))
    starts = starts.select("__g", F.sum("n").over(everywhere).alias("__all"), (F.sum("n").over(everywhere.orderBy("__g")) - F.col("n")).alias("__start"))
    order = Window.partitionBy("__g").orderBy("__f", "__s", "__h", "doc_id", "size")
    placed = ranked.join(F.broadcast(starts), "__g").withColumn("__place", F.col("__start") + F.row_number().over(order) - 1)
    shard = F.expr(f"(__place * {shards}L) div __all").cast("int")
    first = F.expr(f"(shard * __all + {shards - 1}L) div {shards}L")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("__place") - first)
            .select("doc_id", "size", "text_crc32", "source", "shard", "slot"))
