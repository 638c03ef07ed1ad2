"""Deduplication as map-side combinable aggregation: a hot key is reduced before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Wide rows of one task, hash cells that are counted.
TASK_ROWS, CELLS = 300_000, 4096


def _placed(df: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """Wide rows by key in partitions of about ``task_rows`` rows, however many rows there are.

    An aggregate whose value is the whole row sorts its rows: once before the shuffle, where a task's rows
    are as many as its files hold, and once after. Placed rows are sorted once, in tasks of bounded size. Rows are
    counted by a hash of the key first; if a key may hold more than a task's rows, all copies are combined
    before the shuffle, as they are without this.
    """
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS))
    total, most = df.groupBy(cell.alias("_cell")).count().agg(F.sum("count"), F.max("count")).first()
    if not total or most > max(task_rows, 2 * total // CELLS):
        return df
    few = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // 10_000))
    return df.repartition(max(few, -(-total // task_rows)), *keys)


# A null field of a packed struct, what stands between fields, and what marks these three within a field.
_NULL, _NEXT, _MARK = "\u0000", "\u0001", "\u0002"
_MARKED = {_MARK: _MARK + "\u0005", _NEXT: _MARK + "\u0004", _NULL: _MARK + "\u0003"}


def _packable(df: DataFrame, names: list[str]) -> list[str]:
    """Columns that are structs of several texts."""
    of_text = lambda kind: isinstance(kind, T.StructType) and len(kind) > 3 and all(f.dataType == T.StringType() for f in kind)
    return [f.name for f in df.schema if f.name in names and of_text(f.dataType)]


def _pack(df: DataFrame, name: str) -> Column:
    """A struct of texts as one text, which orders as the struct does: a row moves with a third less than with its fields apart.

    Texts are UTF-8, as Spark's readers give them.
    """
    fields = F.array(*[F.col(name)[f] for f in df.schema[name].dataType.names])
    text = F.array_join(fields, "")
    marks = F.contains(text, F.lit(_NULL)) | F.contains(text, F.lit(_NEXT)) | F.contains(text, F.lit(_MARK))

    def marked(c: Column) -> Column:
        for char, mark in _MARKED.items():
            c = F.replace(c, F.lit(char), F.lit(mark))
        return c

    packed = F.array_join(F.when(marks, F.transform(fields, marked)).otherwise(fields), _NEXT, _NULL)
    return F.when(F.col(name).isNotNull(), packed).alias(name)


def _fields(packed: Column) -> Column:
    """The texts that were packed, in an array."""
    def plain(c: Column) -> Column:
        for char, mark in reversed(_MARKED.items()):
            c = F.replace(c, F.lit(mark), F.lit(char))
        return c

    pieces = F.split(packed, _NEXT)
    return F.when(F.contains(packed, F.lit(_MARK)), F.transform(pieces, lambda c: F.when(c != _NULL, plain(c)))).otherwise(
        F.transform(pieces, lambda c: F.when(c != _NULL, c)))


def _unpack(pieces: Column, fields: T.StructType) -> Column:
    return F.when(pieces.isNotNull(), F.struct(*[pieces[i].alias(name) for i, name in enumerate(fields.names)]))


def _orderable(df: DataFrame, names: list[str]) -> list[Column]:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.to_json(F.col(n)) if isinstance(fields[n], (T.MapType, T.VariantType)) else F.col(n) for n in names
    ]


def dedup_latest(df: DataFrame, keys: list[str], order: list[str], tiebreak: list[str] | None = None,
                 task_rows: int | None = None) -> DataFrame:
    """One row per key, the greatest by ``order``; ties go to the greatest remaining columns.

    Null keys form one group and null order values come last, as with
    ``row_number() over (partition by keys order by order desc)``. With ``task_rows`` the rows,
    which must not be a stream or observed, are counted first and sorted in tasks of about so many: for large tables of wide rows.
    """
    rest = [c for c in df.columns if c not in keys]
    ties = [c for c in rest if c not in order] if tiebreak is None else tiebreak
    ranked = [*order, *[c for c in ties if c not in order]]
    unorderable = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.MapType, T.VariantType))]
    schema, packed = df.schema, _packable(df, rest)
    if packed:
        df = df.withColumns({c: _pack(df, c) for c in packed})
    if set(ranked) >= set(rest) and not unorderable:
        # The sort position already is the whole row.
        best = F.max(F.struct(*[c for c in ranked if c not in keys]))
    else:
        best = F.max_by(F.struct(*rest), F.struct(*_orderable(df, ranked)))
    out = (
        (df if task_rows is None else _placed(df, keys, task_rows)).groupBy(*keys).agg(best.alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )
    if not packed:
        return out
    for c in packed:  # one row each; without this the text would be split once for every field
        out = out.select(*[x for x in df.columns if x != c], F.explode(F.array(_fields(F.col(c)))).alias(c))
    return out.select(*[_unpack(F.col(c), schema[c].dataType).alias(c) if c in packed else c for c in df.columns])


def dimension(df: DataFrame, key: str, cols: list[str], order: list[str] | None = None) -> DataFrame:
    """Dimension extraction: one row per key, chosen by ``order`` rather than arbitrarily."""
    needed = [key, *cols, *[c for c in order or [] if c not in cols and c != key]]
    return dedup_latest(df.select(*needed), [key], list(order or cols)).select(key, *cols)


def flag_duplicates(df: DataFrame, keys: list[str], order: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """All rows plus ``is_duplicate``: the earliest row per key by ``order`` is the original.

    Exact copies are counted before any shuffle on the key; the original of each key is found by
    a combinable minimum and joined back, so no task sorts a whole key. A counted group is then
    written out again in runs of at most 100,000 copies.
    """
    run = 100_000
    groups = df.groupBy(*[F.col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    ties = [c for c in df.columns if c not in keys and c not in order] if tiebreak is None else tiebreak
    rank = F.struct(*_orderable(df, [*order, *ties]))
    # Nulls last in ascending order, as the original is the earliest known row.
    known = F.struct(*[F.col(c).isNull() for c in order], rank)
    firsts = df.groupBy(*keys).agg(F.min(known).alias("_first"))
    on = None
    for k in keys:
        term = groups[k].eqNullSafe(firsts[k])
        on = term if on is None else on & term
    joined = groups.join(firsts, on).select(
        *[groups[c] for c in df.columns], "_copies", (known_of(groups, order, ties) == F.col("_first")).alias("_orig"))
    runs = joined.withColumn("_run", F.explode(F.sequence(F.lit(0), F.call_function("div", F.col("_copies") - 1, F.lit(run)))))
    size = F.least(F.lit(run), F.col("_copies") - F.col("_run") * run).cast("int")
    return (
        runs.withColumn("_i", F.explode(F.sequence(F.lit(1), size)))
        .select(*df.columns, (~(F.col("_orig") & (F.col("_run") == 0) & (F.col("_i") == 1))).alias("is_duplicate"))
    )


def known_of(df: DataFrame, order: list[str], ties: list[str]) -> Column:
    """Sort position of a row of ``df``, comparable with the per-key minimum."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    rank = F.struct(*[
        F.to_json(df[c]).alias(c) if isinstance(fields[c], (T.MapType, T.VariantType)) else df[c] for c in [*order, *ties]])
    return F.struct(*[df[c].isNull() for c in order], rank)


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before, rows after and duplicates of a deduplication by ``keys``, in one aggregate."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"),
    )


def validity_report(df: DataFrame) -> DataFrame:
    """Total, valid and invalid rows of a validated table."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_valid")).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    )
