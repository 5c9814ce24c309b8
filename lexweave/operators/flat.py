"""Nested records as paths, types, domains, one-hot columns and matrices."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inferred_schema(texts: DataFrame, column: str) -> DataFrame:
    """One row: the schema that all JSON texts of a column share, by one aggregation."""
    return texts.select(F.expr(f"schema_of_variant_agg(try_parse_json({column}))").alias("schema"))


def type_map(schema: T.DataType, prefix: str = "") -> dict[str, str]:
    """Dotted path to type name; a list's elements have the list's path."""
    if isinstance(schema, T.StructType):
        out = {}
        for field in schema.fields:
            out |= type_map(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
        return out
    if isinstance(schema, T.ArrayType):
        return {prefix: "array"} | type_map(schema.elementType, f"{prefix}[]")
    return {prefix: schema.simpleString()}


def flatten_json(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, value): the members of JSON objects, inner objects and lists as JSON text, lists by place."""
    return df.sparkSession.sql(
        f"select t.{key}, coalesce(e.key, cast(e.pos as string)) as path, try_variant_get(e.value, '$', 'string') as value"
        " from {t} t, lateral variant_explode(t.v) e",
        t=df.select(key, F.expr(f"try_parse_json({column})").alias("v")),
    )


def _scalars(text: str) -> Iterator[tuple[str, str | None]]:
    """(path, value) of every scalar and every empty list or object of a JSON text, in its order; nothing of an unreadable one."""
    try:
        work = [("", json.loads(text, parse_int=str, parse_float=str))]
    except (ValueError, RecursionError):
        return
    while work:
        path, value = work.pop()
        if isinstance(value, dict | list) and value:
            inner = value.items() if isinstance(value, dict) else enumerate(value)
            work.extend(reversed([(f"{path}.{k}" if path else str(k), v) for k, v in inner]))
        elif isinstance(value, dict | list):
            yield path, "{}" if isinstance(value, dict) else "[]"
        else:
            yield path, {True: "true", False: "false"}[value] if isinstance(value, bool) else value


def flatten_nested(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, value): every scalar of JSON texts by its dotted path, list elements by their place, to any depth.

    A text is walked inside its row, in one pass without recursion. Numbers stay as written;
    an empty list or object is a value of its own; null texts and unreadable ones have no rows.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 200):
                rows = [(i, p, v) for i, t in zip(batch[key][k : k + 200], batch[column][k : k + 200]) if t is not None for p, v in _scalars(t)]
                yield pd.DataFrame(rows, columns=[key, "path", "value"])

    return df.select(key, column).mapInPandas(run, f"{key} {kind}, path string, value string")


def domains(paths: DataFrame) -> DataFrame:
    """(path, value): the distinct values of each path."""
    return paths.where("value is not null").select("path", "value").distinct()


def count_pivot(rows: DataFrame, key: str, value: str, values: list[str], prefix: str) -> DataFrame:
    """A column ``prefix=value`` per given value: how often a key has it. A value that isn't given fails."""
    lost = F.raise_error(F.concat(F.lit(f"no column {prefix}="), F.col(value))).cast("string")
    rows = rows.select(key, F.when(F.col(value).isNull() | F.col(value).isin(values), F.col(value)).otherwise(lost).alias("_v"))
    sums = [F.count(F.when(F.col("_v") == v, 1)).alias(f"{prefix}={v}") for v in values]
    return rows.groupBy(key).agg(*sums) if sums else rows.select(key).distinct()


def values_of(rows: DataFrame, column: str, limit: int = 1_000) -> list[str]:
    """The distinct values of a column in the order of their text, for a pivot; refused above a bound."""
    found = [r[0] for r in rows.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} values of {column}")
    return sorted(found)


def ternary(elements: DataFrame, key: str, articles: list[str]) -> DataFrame:
    """A column ``ccl_article=a`` per article: 1 violation, -1 another finding on it, 0 none; the last finding counts."""

    sign = F.when(F.col("type") == "violation", 1).otherwise(-1)
    last = elements.groupBy(key, "article").agg(F.max_by(sign, F.struct("at", "k")).alias("sign"))

    def cell(a: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("article") == a, F.col("sign"))), F.lit(0)).alias(f"ccl_article={a}")

    cells = [cell(a) for a in articles]
    return last.groupBy(key).agg(*cells) if cells else last.select(key).distinct()


def edges(rows: DataFrame, source: str, values: Column) -> DataFrame:
    """(source, target): a matrix of ones in long form."""
    return rows.where(F.col(source).isNotNull()).select(source, F.explode(values).alias("target")).where("target <> ''").distinct()


def as_map(pairs: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """(source, refs): the matrix as one map per source, for export."""
    refs = F.map_from_entries(F.array_sort(F.collect_set(F.struct(F.col(target), F.lit(1).alias("one")))))
    return pairs.groupBy(source).agg(refs.alias("refs"))
