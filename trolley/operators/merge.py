"""Keyed upsert of one relation into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    updated: Sequence[str],
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """``target`` after inserting ``source`` rows or updating those of equal key.

    Stored rows without a new one stay. For a key that is there already the
    ``updated`` columns take the new value, NULL included, and all others keep
    the stored one. Inserted rows get ``now`` as ``stamp`` unless they bring a
    value. A key that comes twice in ``source`` is an error.

    Keys are unique on both sides of the join, so no key is hot. Rows of a key are
    numbered in the partitions and the order that the join needs anyway.
    """
    key = list(key)
    others = [name for name in source.columns if name not in key]
    repeated = F.raise_error(
        F.concat(F.lit("key comes twice in one batch: "), F.to_json(F.struct(*key)))
    )
    by_key = Window.partitionBy(*key).orderBy(*key)
    row = F.struct(F.lit(True).alias("_any"), *others)
    arrived = source.withColumn("_number", F.row_number().over(by_key)).select(
        *key, F.when(F.col("_number") == 1, row).otherwise(repeated).alias("_new")
    )
    stored = target.withColumn("_stored", F.lit(True))
    is_new = F.col("_new").isNotNull()
    is_stored = F.col("_stored").isNotNull()
    now = F.current_timestamp() if now is None else now

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        if name in updated:
            return F.when(is_new, F.col(f"_new.{name}")).otherwise(F.col(name))
        first = F.col(f"_new.{name}") if name in others else F.lit(None)
        if name == stamp:
            first = F.coalesce(first, now)
        return F.when(is_stored, F.col(name)).otherwise(first)

    return stored.join(arrived, key, "full_outer").select(
        *[
            merged(field.name).cast(field.dataType).alias(field.name)
            for field in target.schema
        ]
    )
