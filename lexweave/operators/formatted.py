"""Cases with their packed fields apart: the formatted case, its flat form and the fully encoded table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cases as fn
from ..session import durable
from ..sources.lookups import small
from .conclusions import findings

# Fields of a raw case that its formatted form keeps as they are.
KEPT = ["itemid", "docname", "application", "appno", "applicability", "decisiondate", "doctypebranch", "ecli", "importance", "introductiondate",
        "judgementdate", "kpdate", "languageisocode", "originatingbody", "rank", "respondent", "respondentordereng", "separateopinion",
        "sharepointid", "typedescription"]
# Fields with several values that are trimmed.
TRIMMED = ["externalsources", "documentcollectionid", "issue", "representedby"]
#: Cells of the encoded table that are in memory at once. A batch costs some microseconds a column, so few rows a batch are slow.
CELLS = 4_000_000
#: Cells that a task spreads, about as many as a row group of parquet holds.
TASK_CELLS = 32_000_000
#: The fields of a raw case that are read.
READ = [*KEPT, *TRIMMED, "article", "conclusion", "extractedappno", "kpthesaurus", "scl"]


def formatted(cases: DataFrame, countries: DataFrame, bodies: DataFrame) -> DataFrame:
    """The formatted case: fields with several values as arrays, findings, parties, country and body looked up.

    The texts that were parsed stay as ``__conclusion`` and ``__articles``. Unlike a lookup that
    fails, a country or body that isn't known is null; ``lookups.missing`` reports these.
    """
    first = fn.first_of(F.col("respondent"))
    out = cases.withColumn("alpha3", first).join(small(countries), "alpha3", "left").join(small(bodies), "originatingbody", "left")
    out = findings(out.withColumn("__conclusion", F.col("conclusion")), "__conclusion", "conclusion")
    packed = [fn.multi_value(F.col(c)).alias(c) for c in TRIMMED]
    return out.select(
        *KEPT, *packed, fn.multi_value(F.col("extractedappno"), keep_empty=True).alias("extractedappno"),
        F.split("kpthesaurus", ";").alias("kpthesaurus"), fn.multi_value(F.col("scl"), trimmed=False).alias("scl"),
        fn.parties(F.col("docname")).alias("parties"), fn.article_list(F.col("article")).alias("article"), fn.subarticle_list(F.col("article")).alias("paragraphs"),
        "conclusion", "country", F.col("body_type").alias("originatingbody_type"), F.col("body_name").alias("originatingbody_name"),
        "__conclusion", F.col("article").alias("__articles"),
    )


def flat(cases: DataFrame) -> DataFrame:
    """The flat form of formatted cases: first number and party, dates cut, names only, lists sorted; texts and sources go."""
    dates = [fn.cut_date(F.col(c)).alias(c) for c in ("decisiondate", "judgementdate", "introductiondate")]
    return cases.select(
        "itemid", fn.first_of(F.col("appno")).alias("appno"), F.try_element_at("parties", F.lit(1)).alias("parties"), "country",
        F.split("respondent", ";").alias("respondent"), F.split(fn.strip(F.col("applicability")), ";").alias("applicability"),
        *dates, fn.cut_date(F.col("kpdate"), False).alias("kpdate"), F.coalesce(F.col("separateopinion") == "TRUE", F.lit(False)).alias("separateopinion"),
        F.when(F.size("issue") > 0, F.array_sort("issue")).alias("issue"), "article", "paragraphs", "documentcollectionid", "conclusion",
        "doctypebranch", "importance", "languageisocode", "originatingbody", "originatingbody_type", "originatingbody_name", "rank", "respondentordereng",
        "sharepointid", "typedescription",
    )


def _counted(values: Column, name: str) -> Column:
    return F.transform(values, lambda v: F.struct(F.concat(F.lit(f"{name}="), v).alias("column"), F.lit(1).alias("v")))


def encoded_pairs(cases: DataFrame, lists: list[str]) -> Column:
    """The (column, v) of a flat case: one for each place of a value in a list, and 1 or -1 for an article's last finding."""

    def last(acc: Column, f: Column) -> Column:
        # Of several findings on an article the last one counts.
        return F.concat(F.filter(acc, lambda x: x["a"] != f["article"]), F.array(F.struct(f["article"].alias("a"), F.when(f["type"] == "violation", 1).otherwise(-1).alias("v"))))

    named = F.filter("conclusion", lambda f: f["article"].isNotNull())
    signs = F.reduce(named, F.expr("cast(array() as array<struct<a:string,v:int>>)"), last)
    ternary = F.transform(signs, lambda x: F.struct(F.concat(F.lit("ccl_article="), x["a"]).alias("column"), x["v"].alias("v")))
    none = F.expr("cast(array() as array<struct<column:string,v:int>>)")
    every = F.concat(*[F.coalesce(c, none) for c in (*[_counted(F.col(n), n) for n in lists], ternary)])
    return F.filter(every, lambda x: x["column"].isNotNull())


def encoded(cases: DataFrame, lists: list[str], scalars: list[str]) -> DataFrame:
    """One row per flat case: scalars, and a column per value of each list and per article of a finding, 0 where it is absent.

    The columns are all those that the data need, sorted; only their names are gathered. A case
    is spread over them inside its row, so what is shuffled or joined is never as wide as the table.
    The narrow rows are dealt out by the cells that they become, over all cores at least.
    """
    sparse = durable(cases.select("itemid", *scalars, encoded_pairs(cases, lists).alias("pairs")))
    names = sorted(r[0] for r in sparse.select(F.explode("pairs.column").alias("c")).distinct().collect())
    place = {name: k for k, name in enumerate(names)}
    own = ["itemid", *scalars]
    rows = sparse.count()
    tasks = max(sparse.sparkSession.sparkContext.defaultParallelism, -(-rows * len(names) // TASK_CELLS))
    coded = sparse.select(*own, F.col("pairs.column").alias("_columns"), F.col("pairs.v").alias("_values")).repartition(max(1, min(rows, tasks)))
    schema = T.StructType([*sparse.select(*own).schema.fields, *(T.StructField(name, T.LongType(), False) for name in names)])
    per = max(1, CELLS // max(1, len(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, per):
                part = batch.slice(at, per)
                n = part.num_rows
                cells = np.zeros((len(names), n), dtype=np.int64)
                columns, values = part.column("_columns"), part.column("_values")
                row = np.repeat(np.arange(n), columns.value_lengths().to_numpy(zero_copy_only=False))
                np.add.at(cells, ([place[c] for c in columns.flatten().to_pylist()], row), values.flatten().to_numpy(zero_copy_only=False))
                dense = pa.array(cells.ravel())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *(dense.slice(k * n, n) for k in range(len(names)))], [*own, *names])

    return coded.mapInArrow(run, schema)
