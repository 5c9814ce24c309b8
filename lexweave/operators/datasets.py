"""Labelled data sets: encodings of outcomes and features, and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cases import consistent, windowless_rank
from .relational import dense_ids

# Variables of a case in the order of their index; respondent stands twice and has its second place.
SCALARS = ["itemid", "respondent", "rank", "applicability", "decisiondate", "doctypebranch", "importance", "introductiondate",
           "judgementdate", "originatingbody_type", "originatingbody_name", "respondent", "separateopinion", "typedescription"]
LISTS = ["article", "documentcollectionid", "externalsources", "extractedappno", "kpthesaurus", "parties", "scl", "representedby"]


def feature_index() -> dict[str, int]:
    """Each variable's index; index 1 is nobody's."""
    return {name: k for k, name in enumerate([*SCALARS, *LISTS])}


def outcome_ids(elements: DataFrame, key: str = "itemid") -> DataFrame:
    """(base_article, outcome_id): ids from 1 in the order in which articles are first found, cases by their key."""
    found = elements.where(F.col("type").isin("violation", "no-violation") & F.col("base_article").isNotNull())
    first = found.groupBy("base_article").agg(F.min(F.struct(F.col(key).alias("c"), "at", "k")).alias("first"))
    ranked = windowless_rank(first, "first", "base_article")  # one row per article
    return ranked.select("base_article", F.col("rank").alias("outcome_id"))


def feature_values(cases: DataFrame, scalars: list[str], lists: dict[str, object], key: str = "itemid") -> DataFrame:
    """(key, variable, value): every variable's values in long form; lists give one row per element."""
    rows = [F.struct(F.lit(n).alias("variable"), F.array(F.col(n).cast("string")).alias("vs")) for n in scalars]
    rows += [F.struct(F.lit(n).alias("variable"), c.alias("vs")) for n, c in lists.items()]
    long = cases.select(key, F.explode(F.array(*rows)).alias("x")).select(F.col(key).alias("_key"), "x.variable", F.explode("x.vs").alias("value"))
    return long.where("value is not null").withColumnRenamed("_key", key)


def feature_ids(values: DataFrame) -> DataFrame:
    """(variable, value, feature_id): ids from 0, variables in their order, values in the order of their text."""
    index = feature_index()
    pairs = [x for k, v in index.items() for x in (F.lit(k), F.lit(v))]
    distinct = values.select("variable", "value").distinct().withColumn("ord", F.try_element_at(F.create_map(*pairs), F.col("variable")))
    ids = dense_ids(distinct, ["ord", "value"], "feature_id")
    return ids.select("variable", "value", (F.col("feature_id") - 1).alias("feature_id"))


def outcome_lines(elements: DataFrame, ids: DataFrame, features: DataFrame, key: str = "itemid") -> DataFrame:
    """(key, line) of every consistent case: ``0:`` and the id of its key, then ``outcome:1`` or ``outcome:0`` in the order of ids."""
    found = elements.where(F.col("type").isin("violation", "no-violation") & F.col("base_article").isNotNull())
    kept = found.join(consistent(elements, key, "base_article"), key, "left_semi").join(ids, "base_article")
    pair = F.struct(F.col("outcome_id").alias("i"), (F.col("type") == "violation").cast("int").alias("v"))
    sorted_ = F.array_sort(F.collect_set(pair))
    classes = kept.groupBy(key).agg(
        F.array_join(F.transform(sorted_, lambda p: F.concat_ws(":", p["i"].cast("string"), p["v"].cast("string"))), " ").alias("classes")
    )
    own = features.where("variable = 'itemid'").select(F.col("value").alias(key), "feature_id")
    return classes.join(own, key).select(key, F.concat(F.lit("0:"), F.col("feature_id").cast("string"), F.lit(" "), "classes").alias("line"))


def descriptive_lines(values: DataFrame, ids: DataFrame, key: str = "itemid") -> DataFrame:
    """(key, line): ``variable index:value id`` of a case, in the order of both."""
    index = feature_index()
    pairs = [x for k, v in index.items() for x in (F.lit(k), F.lit(v))]
    coded = values.join(ids, ["variable", "value"]).withColumn("i", F.try_element_at(F.create_map(*pairs), F.col("variable")))
    sorted_ = F.array_sort(F.collect_list(F.struct("i", "feature_id")))
    text = F.array_join(F.transform(sorted_, lambda p: F.concat_ws(":", p["i"].cast("string"), p["feature_id"].cast("string"))), " ")
    return coded.groupBy(key).agg(text.alias("line"), F.count("*").alias("n"))


def dataset_stats(lines: DataFrame) -> DataFrame:
    """One row: cases, and the least, greatest and mean number of features."""
    return lines.agg(
        F.count("*").alias("dataset_size"), F.min("n").alias("min_feature"), F.max("n").alias("max_feature"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_feature"),
    )
