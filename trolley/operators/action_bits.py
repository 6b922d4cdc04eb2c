"""Sets of event types as bits: a user's state is one number, however many events there are."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.events import has_text

#: Bits of a number for types; one more says that there are others.
MOST_TYPES = 62
#: Longer types are not collected.
LONGEST_TYPE = 64


class TypeDictionary(NamedTuple):
    """Types by their bit, in ascending order, and whether there are no others."""

    types: tuple[str, ...]
    complete: bool

    @property
    def other(self) -> int:
        return 1 << len(self.types)

    def bit(self) -> Column:
        """The bit of ``event_type``; that of all others for types without one."""
        known = [
            F.when(F.col("event_type") == name, F.lit(1 << place).cast("bigint"))
            for place, name in enumerate(self.types)
        ]
        return F.coalesce(*known, F.lit(self.other).cast("bigint"))

    def names(self, bits: Column) -> Column:
        """The types whose bits are set, ascending."""
        every = F.array(*map(F.lit, self.types)).cast("array<string>")
        return F.filter(every, lambda name, place: F.getbit(bits, place) == 1)


def frequent_types(events: DataFrame, most: int = MOST_TYPES) -> TypeDictionary:
    """The ``most`` most frequent types; at most so many short strings reach the driver."""
    if not 0 <= most <= MOST_TYPES:
        raise ValueError(f"0 to {MOST_TYPES} types have a bit")
    counts = events.where(has_text("event_type")).groupBy("event_type").count()
    short = F.length("event_type") <= LONGEST_TYPE
    first = F.when(short, F.col("event_type"))
    ranked = counts.select(first.alias("name"), "count").orderBy(
        F.col("name").isNull(), F.desc("count"), "name"
    )
    found = [row.name for row in ranked.limit(most + 1).collect()]
    types = [name for name in found[:most] if name is not None]
    return TypeDictionary(tuple(sorted(types)), len(types) == len(found))


def user_action_bits(events: DataFrame, dictionary: TypeDictionary) -> DataFrame:
    """(report_date, user_id, bits): which types each user has on a day."""
    valid = has_text("user_id") & has_text("event_type")
    return (
        events.where(valid)
        .groupBy(F.col("event_date").alias("report_date"), "user_id")
        .agg(F.bit_or(dictionary.bit()).alias("bits"))
    )


def user_action_sets(
    events: DataFrame, dictionary: TypeDictionary | None = None
) -> DataFrame:
    """The rows of ``users.user_action_sets``, made from bits.

    Text is made of the bits at the end. Types beyond the dictionary are kept as rows of their own,
    one of each user and type, and put to the others then; nothing is lost. Without such types
    there is one shuffle, of two keys and a number.
    """
    dictionary = dictionary or frequent_types(events)
    bits = user_action_bits(events, dictionary)
    sets = bits.select("report_date", "user_id", dictionary.names(F.col("bits")).alias("actions"))
    if dictionary.complete:
        return sets
    beyond = has_text("user_id") & has_text("event_type")
    beyond = beyond & ~F.col("event_type").isin(*dictionary.types)
    others = (
        events.where(beyond)
        .select(F.col("event_date").alias("_day"), F.col("user_id").alias("_user"), "event_type")
        .distinct()
        .groupBy("_day", "_user")
        .agg(F.collect_list("event_type").alias("_others"))
    )
    same = F.col("report_date").eqNullSafe(F.col("_day")) & (F.col("user_id") == F.col("_user"))
    every = F.concat("actions", F.coalesce("_others", F.array().cast("array<string>")))
    return sets.join(others, same, "left").select(
        "report_date", "user_id", F.array_sort(every).alias("actions")
    )
