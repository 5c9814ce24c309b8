"""The normalised model: entities, bridges, children, and their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable


def dense_ids(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """df with ids 1, 2, ... in a total order, without gathering it in one partition.

    Rows are range-partitioned and sorted, written once, counted per partition
    (one small row each), and numbered by their partition's offset.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = durable(placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = sorted((r["_part"], r["n"], r["first"]) for r in fixed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first")).collect())
    rows, total = [], 0
    for part, n, first in counts:
        rows.append((part, total - first))
        total += n
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_part int, _shift bigint")
    numbered = fixed.join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_at") + F.col("_shift") + 1).alias(name), *df.columns)


def entity(pairs: DataFrame, value: str = "name") -> DataFrame:
    """(id, value): one row per distinct value that is there, numbered in the order of their text."""
    return dense_ids(pairs.where(F.col(value).isNotNull()).select(value).distinct(), [value])


def bridge(pairs: DataFrame, dim: DataFrame, case: str = "itemid", value: str = "name") -> DataFrame:
    """(id, case): each pair of an entity and a case once."""
    return pairs.where(F.col(value).isNotNull()).select(case, value).distinct().join(dim.select("id", value), value).select("id", case)


def children(cases: DataFrame, values: Column, case: str = "itemid") -> DataFrame:
    """(case, name): each value of a case once."""
    return cases.select(case, F.explode(values).alias("name")).where(F.trim("name") != "").distinct()


def cross_reference(extracted: DataFrame, cases: DataFrame) -> DataFrame:
    """(itemid, name, isechr): whether an extracted number is a case's own number somewhere.

    Numbers are compared as distinct sets, so one that is cited everywhere is one row.
    """
    known = cases.where("appno is not null").select(F.explode(F.split("appno", ";")).alias("name")).select(F.trim("name").alias("name")).distinct()
    return extracted.join(known.withColumn("isechr", F.lit(True)), "name", "left").select("itemid", "name", F.coalesce("isechr", F.lit(False)).alias("isechr"))


def unique_or_reject(df: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that keep a column unique (of equals the least key), and the rejected others."""
    first = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(key).alias("_first"))
    marked = df.join(first, column, "left")
    taken = F.col("_first").isNull() | (F.col("_first") == F.col(key))
    return marked.where(taken).drop("_first"), marked.where(~taken).drop("_first")


def load_new(loaded: DataFrame, arriving: DataFrame, key: str) -> DataFrame:
    """What a reload adds: arriving rows whose key isn't there yet, each key once."""
    return arriving.join(loaded.select(key), key, "left_anti").dropDuplicates([key])


def conclusion_rows(judgments: DataFrame) -> DataFrame:
    """(itemid, element, type, article, base_article, details, mentions) of the typed findings."""
    return judgments.where("itemid is not null").select("itemid", F.explode("conclusions").alias("c")).select("itemid", "c.*")


_NATURAL = ["element", "type", "article", "base_article"]


def conclusions(rows: DataFrame) -> DataFrame:
    """(id, element, type, article, base_article): findings once each; a missing part is a value of its own."""
    return dense_ids(rows.where("element is not null").select(*_NATURAL).distinct(), _NATURAL)


def _same(a: DataFrame, b: DataFrame) -> Column:
    match = F.lit(True)
    for c in _NATURAL:
        match = match & a[c].eqNullSafe(b[c])
    return match


def conclusion_cases(rows: DataFrame, dim: DataFrame) -> DataFrame:
    return rows.join(dim, _same(rows, dim)).select("id", "itemid").distinct()


def conclusion_notes(rows: DataFrame, dim: DataFrame, notes: DataFrame, column: str) -> DataFrame:
    """(id, note_id): the details (or mentions) of each finding."""
    each = rows.select(*_NATURAL, F.explode(column).alias("name"))
    return (
        each.join(dim, _same(each, dim)).select(dim["id"], each["name"]).distinct()
        .join(notes.select(F.col("id").alias("note_id"), "name"), "name").select("id", "note_id")
    )
