"""The rules of the serving tables, checked before anything is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.schemas import ServingTable


def row_rules(table: ServingTable) -> dict[str, Column]:
    """Name of each rule for single rows, and when it is broken."""
    rules = {f"{name} is missing": F.col(name).isNull() for name in table.not_null}
    for name, length in table.max_length:
        rules[f"{name} is longer than {length}"] = F.length(name) > length
    for name in table.decimals:
        stored = F.col(name).try_cast(table.columns[name].dataType)
        rules[f"{name} is out of range"] = F.col(name).isNotNull() & stored.isNull()
    for name, values in table.one_of:
        rules[f"{name} is not allowed"] = ~F.col(name).isin(*values)
    return rules


def keeps_rules(table: ServingTable) -> Column:
    """The row breaks no single-row rule."""
    kept = F.lit(True)
    for broken in row_rules(table).values():
        kept = kept & ~F.coalesce(broken, F.lit(False))
    return kept


def constraint_violations(rows: DataFrame, table: ServingTable) -> DataFrame:
    """Key, rule and number of rows for each rule that rows of a key break.

    One aggregate over the key covers the single-row rules and uniqueness
    together. It only counts, so repeated keys are combined before the shuffle
    however many rows they have. Keys with a NULL part are never repeated.
    """
    key = list(table.key)
    rules = row_rules(table)
    counts = [
        F.count_if(broken).alias(f"_rule_{i}") for i, broken in enumerate(rules.values())
    ]
    complete = F.lit(True)
    for name in key:
        complete = complete & F.col(name).isNotNull()
    per_key = rows.groupBy(*key).agg(F.count("*").alias("_rows"), *counts)
    found = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"_rule_{i}").alias("rows"))
        for i, rule in enumerate(rules)
    ]
    repeated = F.when(complete & (F.col("_rows") > 1), F.col("_rows")).otherwise(0)
    found.append(
        F.struct(F.lit("key is not unique").alias("rule"), repeated.alias("rows"))
    )
    broken = F.filter(F.array(*found), lambda entry: entry["rows"] > 0)
    return per_key.select(*key, F.explode(broken).alias("found")).select(
        *key, "found.rule", "found.rows"
    )


def conform(rows: DataFrame, table: ServingTable) -> DataFrame:
    """The columns of the table, in its types; those not given are left out."""
    return rows.select(
        *[
            F.col(field.name).try_cast(field.dataType).alias(field.name)
            for field in table.columns
            if field.name in rows.columns
        ]
    )
