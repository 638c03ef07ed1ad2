"""Time-decayed interest profiles and personalised ranking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import epoch_us, micros
from .ranking import top_per_key

# Event weights, decay constant, profile lifetime, signals read per user, result limits.
EVENT_WEIGHTS = {"order": 5.0, "click": 3.0, "view": 1.5, "impression": 1.0}
OTHER_WEIGHT = 1.0
DECAY_MINUTES = 240.0
PROFILE_TTL = "7 days"
TOP_ITEMS, TOP_CATEGORIES = 50, 10
DEFAULT_LIMIT, MAX_LIMIT = 10, 25
REASONS = ["user_item_preference", "user_category_preference", "cold_start_popular"]


def event_weight(event_type: str) -> Column:
    weight = F.lit(OTHER_WEIGHT)
    for kind, value in EVENT_WEIGHTS.items():
        weight = F.when(F.col(event_type) == kind, F.lit(value)).otherwise(weight)
    return weight


def event_score(event_type: str, event_time: str, as_of: Column) -> Column:
    """Weight of the event type, decayed by age in minutes; undecayed without an event time."""
    age = F.greatest(F.lit(0.0), (epoch_us(as_of) - epoch_us(event_time)) / F.lit(60e6))
    return event_weight(event_type) * F.coalesce(F.exp(-age / F.lit(DECAY_MINUTES)), F.lit(1.0))


def fresh_users(scored: DataFrame, as_of: dt.datetime, ttl: str) -> DataFrame:
    """The rows of users with an update in the time to live; one short row a user decides, no user's rows meet in a task."""
    newest = scored.groupBy("user_id").agg(F.max("last_update").alias("_newest"))
    alive = newest.where(epoch_us("_newest") + micros(ttl) > epoch_us(F.lit(as_of))).select("user_id")
    return scored.join(alive, "user_id", "left_semi")


def interest_profiles(events: DataFrame, as_of: dt.datetime | None = None, kind: str = "item",
                      ts: str = "event_time", ingested: str | None = None, ttl: str | None = PROFILE_TTL) -> DataFrame:
    """Score per (user, item) or (user, category): the sum of decayed event weights.

    Ages run to ``as_of``, or with ``ingested`` to each event's own ingestion time. Users and
    items must be positive, categories not blank. Users without an update for ``ttl`` are dropped.
    """
    target = {"item": "item_id", "category": "category"}[kind]
    moment = F.col(ingested) if ingested else F.lit(as_of)
    counts = F.col("item_id") > 0 if kind == "item" else F.trim("category") != ""
    key = F.col("item_id") if kind == "item" else F.trim("category")
    scored = (
        events.where((F.col("user_id") > 0) & counts)
        .groupBy("user_id", key.alias(target))
        .agg(F.sum(event_score("event_type", ts, moment)).alias("score"), F.max(ts).alias("last_update"))
    )
    if ttl is None or as_of is None:
        return scored
    return fresh_users(scored, as_of, ttl)


def recommend(users: DataFrame, item_scores: DataFrame, category_scores: DataFrame, foods: DataFrame,
              limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Ranked foods per user: own items by score, then newest foods of top categories, then newest foods.

    A user needs at most ``limit`` rows and can have taken at most ``limit`` before a tier starts,
    so the ``2 * limit`` newest foods overall and per category always suffice. They travel as
    bounded arrays: no user is paired with the whole catalog, and a user's candidates are at most
    50 items, 10 category lists and one fallback list.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}")
    depth = 2 * limit
    available = foods.where("is_available")
    people = users.select("user_id").distinct()

    top_items = top_per_key(
        item_scores.select("user_id", "item_id", "score"), ["user_id"],
        [F.desc("score"), F.desc("item_id")], TOP_ITEMS, "_rank")
    liked = (
        top_items.join(available.select(F.col("food_id").alias("item_id")), "item_id")
        .select("user_id", F.lit(0).alias("tier"), F.lit(0).alias("_group"), F.col("item_id").alias("food_id"), "score")
    )
    newest_in = (
        top_per_key(available.select("category", "food_id"), ["category"], [F.desc("food_id")], depth, "_n")
        .groupBy("category").agg(F.collect_list("food_id").alias("_foods"))
    )
    top_categories = top_per_key(
        category_scores.select("user_id", "category", "score"), ["user_id"],
        [F.desc("score"), F.desc("category")], TOP_CATEGORIES, "_group")
    in_category = (
        top_categories.join(newest_in, "category")
        .select("user_id", F.lit(1).alias("tier"), "_group", F.explode("_foods").alias("food_id"), "score")
    )
    newest = (
        available.select("food_id").orderBy(F.desc("food_id")).limit(depth)
        .agg(F.collect_list("food_id").alias("_foods")).scalar()
    )
    fallback = people.select(
        "user_id", F.lit(2).alias("tier"), F.lit(0).alias("_group"), F.explode(newest).alias("food_id"),
        F.lit(0.0).alias("score"))
    mine = people.select("user_id")
    candidates = (
        liked.join(mine, "user_id", "left_semi")
        .unionByName(in_category.join(mine, "user_id", "left_semi"))
        .unionByName(fallback)
    )
    # A food offered by several tiers keeps its first place.
    place = F.struct("tier", "_group", (-F.col("score")).alias("_s"), (-F.col("food_id")).alias("_f"))
    chosen = candidates.groupBy("user_id", "food_id").agg(
        F.min(place).alias("_p"), F.min_by("score", place).alias("score"))
    ranked = top_per_key(chosen, ["user_id"], [F.col("_p")], limit, "position")
    reason = F.element_at(F.lit(REASONS), F.col("_p.tier") + 1)
    details = available.select("food_id", "name", "category", "price")
    return (
        ranked.join(details, "food_id")
        .select("user_id", "position", "food_id", "name", "category", "price",
                F.round("score", 4).alias("score"), reason.alias("reason"))
    )
