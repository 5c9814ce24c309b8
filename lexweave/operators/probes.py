"""Lookups over several indexes, thresholds and measures of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.lookups import small


def first_match(df: DataFrame, column: str, indexes: list[tuple[str, DataFrame]]) -> DataFrame:
    """df with ``source`` and ``row``: where the value stands in the first of the indexes (value, row) that has it."""
    found = df
    for k, (_, index) in enumerate(indexes):
        one = index.groupBy("value").agg(F.min("row").alias(f"_r{k}"))
        found = found.join(small(one.withColumnRenamed("value", column)), column, "left")
    rows = [F.col(f"_r{k}") for k in range(len(indexes))]
    source = reduce(lambda c, k: c.when(rows[k].isNotNull(), indexes[k][0]), range(1, len(rows)), F.when(rows[0].isNotNull(), indexes[0][0]))
    return found.select(*df.columns, source.alias("source"), F.coalesce(*rows).alias("row"))


def above(df: DataFrame, column: str, least: float) -> DataFrame:
    """Rows whose value, read as a number, is greater."""
    return df.where(F.col(column).try_cast("double") > least)


def most_words(df: DataFrame, column: str) -> DataFrame:
    """One row: the greatest number of words in a column."""
    return df.agg(F.max(F.size(F.split(F.trim(column), r"\s+"))).alias("words"))


def department(number: Column) -> Column:
    """The code of a department by its ordinal: the twentieth was split in 2A and 2B, so later ones are one behind."""
    return F.when(number == 20, "2A").when(number == 21, "2B").when(number > 21, F.lpad((number - 1).cast("string"), 2, "0")).otherwise(
        F.lpad(number.cast("string"), 2, "0")
    )
