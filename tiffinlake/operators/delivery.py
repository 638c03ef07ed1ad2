"""Delivery feed: envelope, flattening, quality flags and KPI rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parse_order_time, safe_double, safe_int
from ..schemas import DELIVERY_CSV_COLUMNS

MAX_DELIVERY_MINUTES = 300

# Silver column, payload field and type.
_TEXT, _INT, _DOUBLE = "text", "int", "double"
SILVER_COLUMNS = [
    ("order_id", "ID", _TEXT),
    ("delivery_person_id", "Delivery_person_ID", _TEXT),
    ("delivery_person_age", "Delivery_person_Age", _INT),
    ("delivery_person_rating", "Delivery_person_Ratings", _DOUBLE),
    ("restaurant_lat", "Restaurant_latitude", _DOUBLE),
    ("restaurant_lon", "Restaurant_longitude", _DOUBLE),
    ("delivery_lat", "Delivery_location_latitude", _DOUBLE),
    ("delivery_lon", "Delivery_location_longitude", _DOUBLE),
    ("order_date_raw", "Order_Date", _TEXT),
    ("time_ordered_raw", "Time_Orderd", _TEXT),
    ("time_picked_raw", "Time_Order_picked", _TEXT),
    ("weather_conditions", "Weather_conditions", _TEXT),
    ("road_traffic_density", "Road_traffic_density", _TEXT),
    ("vehicle_condition", "Vehicle_condition", _INT),
    ("order_type", "Type_of_order", _TEXT),
    ("vehicle_type", "Type_of_vehicle", _TEXT),
    ("multiple_deliveries", "multiple_deliveries", _INT),
    ("is_festival", "Festival", _TEXT),
    ("city", "City", _TEXT),
    ("delivery_time_minutes", "Time_taken (min)", _INT),
]

# Metric type of each KPI dimension.
KPI_DIMENSIONS = {"city": "city", "vehicle_type": "vehicle_type", "weather": "weather_conditions"}


def build_events(rows: DataFrame, ingest_ts: dt.datetime) -> DataFrame:
    """CSV rows to event envelopes: id from row id and ingestion time, parsed event time, raw payload."""
    ingest = F.lit(ingest_ts)
    return rows.select(
        F.concat_ws("_", "ID", F.date_format(ingest, "yyyyMMddHHmmssSSSSSS")).alias("event_id"),
        F.date_format(parse_order_time("Order_Date", "Time_Orderd"), "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
        F.date_format(ingest, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_time"),
        F.struct(*[F.col(f"`{c}`") for c in DELIVERY_CSV_COLUMNS]).alias("payload"),
    )


def flatten_delivery(events: DataFrame) -> DataFrame:
    """Nested payload to typed columns; the envelope's times become timestamps."""
    casts = {_TEXT: lambda c: c, _INT: safe_int, _DOUBLE: safe_double}
    return events.select(
        "event_id",
        F.try_to_timestamp("event_time").alias("event_time"),
        F.try_to_timestamp("ingestion_time").alias("ingestion_time"),
        *[casts[kind](F.col("payload").getField(field)).alias(name) for name, field, kind in SILVER_COLUMNS],
    )


def quality_flags(df: DataFrame) -> DataFrame:
    """Coordinate and delivery-time validity (0 < minutes < 300), and the 0 / 0.5 / 1 quality score."""
    located = (
        F.col("restaurant_lat").isNotNull() & F.col("restaurant_lon").isNotNull()
        & F.col("delivery_lat").isNotNull() & F.col("delivery_lon").isNotNull()
    )
    minutes = F.col("delivery_time_minutes")
    timed = F.coalesce((minutes > 0) & (minutes < MAX_DELIVERY_MINUTES), F.lit(False))
    return (
        df.withColumn("is_valid_coordinates", located)
        .withColumn("is_valid_delivery_time", timed)
        .withColumn("data_quality_score", (located.cast("int") + timed.cast("int")) / F.lit(2.0))
    )


def _kpis(time_digits: int | None) -> list[Column]:
    digits = (lambda c: F.round(c, time_digits)) if time_digits is not None else (lambda c: c)
    return [
        F.count(F.lit(1)).alias("total_deliveries"),
        digits(F.avg("delivery_time_minutes")).alias("avg_delivery_time"),
        F.min("delivery_time_minutes").alias("min_delivery_time"),
        F.max("delivery_time_minutes").alias("max_delivery_time"),
        digits(F.avg("delivery_person_rating")).alias("avg_rating"),
        digits(F.count_if("is_valid_delivery_time") / F.count(F.lit(1)) * 100).alias("success_rate_pct"),
    ]


def delivery_kpis(df: DataFrame, dims: dict[str, str] | None = None, mode: str = "scored") -> DataFrame:
    """KPIs per value of each dimension as one long table ``(metric_type, dim_value, ...)``.

    One scan and one grouping-sets aggregate serve all dimensions. ``scored`` keeps rows of
    quality 0.5 and up and rounds to 2 digits; ``valid_only`` keeps rows with a valid delivery
    time and does not round.
    """
    dims = dims or KPI_DIMENSIONS
    if mode == "scored":
        kept, digits = df.where("data_quality_score >= 0.5"), 2
    elif mode == "valid_only":
        kept, digits = df.where("is_valid_delivery_time"), None
    else:
        raise ValueError(f"unknown mode {mode!r}")
    columns = list(dims.values())
    sets = [[F.col(c)] for c in columns]
    # grouping(c) is 0 only in the set that groups by c.
    label = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(name)) for name, c in dims.items()])
    value = F.coalesce(*[F.when(F.grouping(c) == 0, F.col(c).cast("string")) for c in columns])
    return (
        kept.groupingSets(sets, *columns)
        .agg(label.alias("metric_type"), value.alias("dim_value"), *_kpis(digits))
        .drop(*columns)
    )


def hourly_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Deliveries, averages, festival and multi-drop counts per hour; global when ``by`` is empty."""
    return df.where("data_quality_score >= 0.5").groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.round(F.avg("delivery_time_minutes"), 2).alias("avg_delivery_time"),
        F.round(F.avg("delivery_person_rating"), 2).alias("avg_rating"),
        F.count_if(F.col("is_festival") == "Yes").alias("festival_deliveries"),
        F.count_if(F.col("multiple_deliveries") > 1).alias("multi_delivery_count"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("data_quality_score").agg(F.count(F.lit(1)).alias("n"))


def delivery_mart(fact: DataFrame, couriers: DataFrame, vehicles: DataFrame, key: str, city: str, minutes: str,
                  rating: str, vehicle: str) -> DataFrame:
    """Mean time, deliveries and mean rating per (city, vehicle type).

    The fact is filtered and pruned before either join. Spark picks the join strategy from
    measured sizes, so a dimension that outgrows the broadcast threshold is shuffled.
    """
    slim = fact.where(F.col(city).isNotNull()).select(key, city, minutes)
    return (
        slim.join(couriers.select(key, rating), key)
        .join(vehicles.select(key, vehicle), key)
        .groupBy(city, vehicle)
        .agg(
            F.avg(minutes).alias("avg_time"),
            F.count(F.lit(1)).alias("total_deliveries"),
            F.avg(rating).alias("avg_rating"),
        )
    )
