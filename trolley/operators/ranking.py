"""Positions within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.session import stage

# The layout of monotonically_increasing_id: partition above, row below.
ROW_BITS = 33
GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def positions(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Number the rows of each group from 1 in the given order.

    A ranking window would sort a whole group in one task. Here all rows are
    sorted by group and order over all tasks, written once with their place in
    their partition, and shifted by the rows of the same group in earlier
    partitions. There are at most as many such shifts as groups and partitions
    together. A NULL in a group column is a value like any other.
    """
    group = list(group)
    row_id = F.monotonically_increasing_id()
    # Cached nowhere: the written rows fix partition and place, which a second
    # evaluation of the sort would not.
    placed = stage(
        df.orderBy(*map(F.asc, group), *order).withColumn("_row", row_id), "ranked"
    )
    placed = placed.withColumn("_part", F.shiftright("_row", ROW_BITS))
    spans = placed.groupBy(*group, "_part").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_size")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    shifts = spans.select(
        *[F.col(column).alias(f"_of_{column}") for column in group],
        F.col("_part").alias("_of_part"),
        (before - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_of_part")
    for column in group:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    return placed.join(shifts, same).select(
        *df.columns, (F.col("_row") + F.col("_shift")).cast("int").alias(name)
    )


def first_of_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, n: int | None
) -> DataFrame:
    """The first ``n`` rows of each group with their position, all for None.

    Up to the limit of the session Spark cuts a ranked window in every task before the
    shuffle; beyond it a group may not fit into one task, so ``positions`` numbers
    the rows. Both give the same rows.
    """
    limit = int(df.sparkSession.conf.get(GROUP_LIMIT_SETTING))
    if n is not None and n <= limit:
        window = Window.partitionBy(*group).orderBy(*order)
        ranked = df.withColumn(name, F.row_number().over(window))
    else:
        ranked = positions(df, group, order, name)
    return ranked if n is None else ranked.where(F.col(name) <= n)
