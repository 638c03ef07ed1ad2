"""Tolerant parsing of raw text. Every function is a JVM-side column expression; nothing raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The spellings of "no value" in the delivery feed.
MISSING_TOKENS = ["", "NaN", "nan", "NULL", "null"]

ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)

MINUTES_PER_DAY = 1440


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _present(c: Column | str) -> Column:
    text = F.trim(_col(c))
    return F.when(~text.isin(MISSING_TOKENS), text)


def safe_double(c: Column | str) -> Column:
    """Text to double; missing tokens and garbage become null.

    A failing ``try_cast`` throws and catches inside the JVM, so text that starts like no number
    (outside the byte range of sign, point and digits) is turned away by a plain comparison. So are
    the missing tokens, none of which starts like a number.
    """
    text = F.trim(_col(c))
    return F.when((text >= "+") & (text < ":"), text.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Text to int, truncating ``'12.7'`` to 12; missing tokens, garbage and overflow become null."""
    return safe_double(c).try_cast("int")


def parse_iso_ts(c: Column | str) -> Column:
    """ISO-8601 date or timestamp (with ``Z``, an offset, or neither = UTC); anything else is null."""
    text = _col(c)
    return F.when(text.rlike(ISO_TIMESTAMP), F.try_to_timestamp(text))


def parse_order_time(order_date: Column | str, order_time: Column | str) -> Column:
    """Order date ``dd-MM-yyyy`` plus a messy time of day.

    The time may be ``HH:MM``, ``24:00`` (midnight of the next day) or an Excel day fraction,
    whose minutes round half to even and wrap within the day. Missing or unreadable times mean
    midnight; an unreadable date gives null.
    """
    day = F.try_to_timestamp(F.trim(_col(order_date)), F.lit("dd-MM-yyyy"))
    text = F.trim(_col(order_time))
    parts = F.substring_index(text, ":", 1), F.substring_index(text, ":", -1)
    hour, minute = (F.when(text.contains(":"), p).try_cast("int") for p in parts)
    is_clock = hour.between(0, 23) & minute.between(0, 59) & (F.concat_ws(":", *parts) == text) & ~text.contains("+")
    wrapped = F.pmod(F.bround(safe_double(text) * MINUTES_PER_DAY).try_cast("bigint"), F.lit(MINUTES_PER_DAY))
    minutes = (
        F.when(text == "24:00", F.lit(MINUTES_PER_DAY))
        .when(is_clock, hour * 60 + minute)
        .when(~text.contains(":"), wrapped)
    )
    return day + F.make_dt_interval(mins=F.coalesce(minutes.cast("int"), F.lit(0)))


def item_from_ad(ad_id: Column | str) -> Column:
    """Item id named by an ad id: all digits, or ``food_<digits>``; otherwise null."""
    ad = _col(ad_id)
    return F.nullif(F.regexp_extract(ad, r"^(?:food_)?(\d+)$", 1), F.lit("")).try_cast("bigint")


def item_of_click(item_id: Column | str, ad_id: Column | str) -> Column:
    """Item of a click: its own item id if sent, else the one its ad names."""
    return F.coalesce(_col(item_id), item_from_ad(ad_id))


def raw_field(raw: Column | str, path: str, type_: str = "string") -> Column:
    """One field of a raw JSON event by path (``$.a.b``); bad JSON or a bad type gives null."""
    return F.try_variant_get(F.try_parse_json(_col(raw)), path, type_)


def text_fields(*schemas: T.StructType) -> T.StructType:
    """The fields of JSON events, each read as the text that was sent: ``7``, ``"7"`` and ``{"a": 1}`` all arrive."""
    return T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(f.name for s in schemas for f in s)])


def _converted(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return F.regexp_replace(text, r"\.0+$", "").try_cast(kind)
    if isinstance(kind, T.MapType):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def parsed_once(raw: Column | str, schema: T.StructType, build: Callable[[Column], Column]) -> Column:
    """``build`` over the parsed JSON, which is bound to a variable: the optimizer parses plain field accesses once a field."""
    return F.transform(F.array(F.from_json(_col(raw), schema)), build)[0]


def typed_fields(event: Column | str, schema: T.StructType) -> list[Column]:
    """The fields of ``schema`` out of a :func:`text_fields` struct; null where a value does not convert.

    Numbers sent as text are numbers; a map may be sent as an object or as a string that holds one.
    """
    return [_converted(_col(event)[f.name], f.dataType).alias(f.name) for f in schema]


def unconvertible(event: Column | str, schema: T.StructType) -> Column:
    """True if a number, decimal or flag was sent that does not convert to its type. Maps are optional detail and do not count."""
    typed = [f for f in schema if not isinstance(f.dataType, (T.StringType, T.MapType))]
    lost = [_col(event)[f.name].isNotNull() & _converted(_col(event)[f.name], f.dataType).isNull() for f in typed]
    return reduce(lambda a, b: a | b, lost, F.lit(False))


def split_key_values(path: Column | str, keys: list[str]) -> dict[str, Column]:
    """Values of Hive-style ``key=value`` segments in a path column."""
    text = _col(path)
    return {k: F.nullif(F.regexp_extract(text, rf"(?:^|/){k}=([^/]*)", 1), F.lit("")) for k in keys}
