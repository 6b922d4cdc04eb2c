"""What users did on a day: activity, segments and samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions.events import has_text, is_type
from trolley.operators.ranking import first_of_group


def user_activity(events: DataFrame) -> DataFrame:
    """One row per day and user, invalid users (NULL, '') included.

    The state is a few fixed-width fields, so each task combines its rows
    before the shuffle, and a user with a third of all events costs one row per
    task. Results that need fewer columns prune the others from the aggregate.
    """
    typed = has_text("event_type")
    return events.groupBy(F.col("event_date").alias("report_date"), "user_id").agg(
        F.count("*").alias("events"),
        F.coalesce(F.bool_or(typed), F.lit(False)).alias("acted"),
        F.coalesce(F.bool_or(is_type(schemas.PURCHASE)), F.lit(False)).alias("bought"),
        F.min(F.when(typed, F.col("event_timestamp"))).alias("first_seen"),
    )


def user_segments(activity: DataFrame) -> DataFrame:
    """Buyers and window shoppers of each day, from ``user_activity``.

    A user without id, or without any event that has a type, has no segment.
    """
    return activity.where(has_text("user_id") & F.col("acted")).select(
        "report_date",
        "user_id",
        F.when(F.col("bought"), schemas.BUYER)
        .otherwise(schemas.WINDOW_SHOPPER)
        .alias("segment"),
        "first_seen",
    )


def buyers(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("segment") == schemas.BUYER)


def window_shoppers(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("segment") == schemas.WINDOW_SHOPPER)


def segment_rows(buyer_ids: DataFrame, shopper_ids: DataFrame) -> DataFrame:
    """Two user lists, made separately, as tagged rows of one relation."""
    keep = ("report_date", "user_id")
    tagged_buyers = buyer_ids.select(*keep, F.lit(schemas.BUYER).alias("segment"))
    tagged_shoppers = shopper_ids.select(
        *keep, F.lit(schemas.WINDOW_SHOPPER).alias("segment")
    )
    return tagged_buyers.unionByName(tagged_shoppers)


def user_action_sets(events: DataFrame) -> DataFrame:
    """The distinct event types of each user and day, sorted.

    For the sets themselves; ``user_activity`` answers whether a type occurs
    without building them.
    """
    valid = has_text("user_id") & has_text("event_type")
    return (
        events.where(valid)
        .groupBy(F.col("event_date").alias("report_date"), "user_id")
        .agg(F.array_sort(F.collect_set("event_type")).alias("actions"))
    )


def events_of(events: DataFrame, listed: DataFrame) -> DataFrame:
    """Events of the users in ``listed``, which may be a large table of ids.

    Spark drops most other events at the scan by a Bloom filter of the ids, if the list is
    filtered and the settings of the session find that worth it; see ``session.build_session``.
    """
    return events.join(listed.select("user_id"), "user_id", "left_semi").select(*events.columns)


def events_without(events: DataFrame, listed: DataFrame) -> DataFrame:
    """Events of users that are not in ``listed``, and those without a user."""
    return events.join(listed.select("user_id"), "user_id", "left_anti").select(*events.columns)


def first_users(segments: DataFrame, size: int = 10) -> DataFrame:
    """The first users of each day and segment with their position.

    For short samples the rank filter is applied on both sides of the shuffle, so each
    task sends at most ``size`` users per day and segment.
    """
    arrival = (F.asc_nulls_last("first_seen"), F.asc("user_id"))
    return first_of_group(segments, ["report_date", "segment"], arrival, "position", size)


def ids_in_order(only: Column | None = None) -> Column:
    """Aggregate of the user ids of ``first_users``, of some rows if ``only``."""
    entry = F.struct("position", "user_id")
    kept = entry if only is None else F.when(only, entry)
    return F.transform(F.array_sort(F.collect_list(kept)), lambda e: e["user_id"])


def segment_samples(segments: DataFrame, size: int = 10) -> DataFrame:
    """The ids of the first users of each day and segment, in order of appearance."""
    return (
        first_users(segments, size)
        .groupBy("report_date", "segment")
        .agg(ids_in_order().alias("user_ids"))
    )
