"""Food catalog queries, enrichment, and canonical behaviour events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import item_of_click


def catalog(foods: DataFrame, category: str | None = None, available_only: bool = True) -> DataFrame:
    if available_only:
        foods = foods.where("is_available")
    if category is not None:
        foods = foods.where(F.col("category") == category)
    return foods.orderBy("food_id")


def catalog_item(foods: DataFrame, food_id: int) -> DataFrame:
    return foods.where(F.col("food_id") == food_id)


def categories(foods: DataFrame) -> DataFrame:
    return foods.select("category").distinct().orderBy("category")


def enrich_orders(orders: DataFrame, foods: DataFrame) -> DataFrame:
    """Silver orders with the food's category, description and preparation time; unknown items keep nulls.

    A catalog without ``preparation_time`` leaves it null for all.

    The join strategy is left to AQE, which broadcasts the catalog only when its measured size allows.
    """
    details = foods.select(
        F.col("food_id").alias("item_id"), F.col("category").alias("enriched_category"),
        F.col("description").alias("enriched_description"),
        (F.col("preparation_time") if "preparation_time" in foods.columns else F.lit(None)).cast("int").alias("enriched_preparation_time"))
    return orders.join(details, "item_id", "left")


def order_to_behavior(orders: DataFrame) -> DataFrame:
    meta = lambda key: F.try_element_at("metadata", F.lit(key))
    return orders.select(
        "event_id", F.lit("order").alias("event_type"), F.col("timestamp").alias("event_time"), "user_id", "item_id",
        meta("category").alias("category"), meta("session_id").alias("session_id"),
        F.coalesce(meta("source_page"), F.lit("order")).alias("source_page"),
        F.create_map(F.lit("order_id"), F.col("order_id"),
                     F.lit("price"), F.coalesce(F.col("price").cast("double"), F.lit(0.0)).cast("string")).alias("metadata"),
    )


def click_to_behavior(clicks: DataFrame) -> DataFrame:
    """Clicks and impressions as behaviour events; rows that name no item are dropped."""
    meta = lambda key: F.try_element_at("metadata", F.lit(key))
    return clicks.select(
        "event_id", F.when(F.col("is_click"), "click").otherwise("impression").alias("event_type"),
        F.col("timestamp").alias("event_time"), "user_id", item_of_click("item_id", "ad_id").alias("item_id"),
        meta("category").alias("category"), "session_id", meta("source_page").alias("source_page"),
        F.create_map(F.lit("ad_id"), F.col("ad_id"), F.lit("ad_campaign_id"), F.col("ad_campaign_id")).alias("metadata"),
    ).where("item_id > 0")
