"""Cases: the current state of each, filters, labels and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cases import multi_value

# Cases that are known to be broken at the source.
BLOCKED = ("001-154354", "001-108395", "001-79411")
_FINDINGS = ("violation", "no-violation")


def current(cases_info: DataFrame, *columns: str) -> DataFrame:
    """The latest row of each case, with the given columns or all; a fetch of overlapping years returns a case twice.

    Name the columns that are wanted: no others are read or shuffled.
    """
    # max_by over the row keeps one row per key while aggregating map-side; no window holds a key's versions.
    wanted = list(columns) or cases_info.columns
    rest = [c for c in wanted if c != "itemid"]
    return (
        cases_info.groupBy("itemid")
        .agg(F.max_by(F.struct(*[F.col(c) for c in rest] or [F.lit(0).alias("_")]), F.struct("fetched_at", "record_id")).alias("r"))
        .select(*[F.col("itemid") if c == "itemid" else F.col(f"r.{c}") for c in wanted])
    )


def predicates(blocked: tuple[str, ...] = BLOCKED) -> list[tuple[str, Column]]:
    """The four filters in their order: language, type of document, finding, list of broken cases."""
    ccl = F.col("conclusion")
    return [
        ("language", F.col("languageisocode") == "ENG"),
        ("doctype", F.col("doctype") == "HEJUD"),
        ("conclusion", ccl.contains("Violation") | ccl.contains("violation")),
        ("blocked", ~F.col("itemid").isin(*blocked) if blocked else F.lit(True)),
    ]


def usable(cases: DataFrame) -> DataFrame:
    for _, keep in predicates():
        cases = cases.where(keep)
    return cases


def funnel(cases: DataFrame) -> DataFrame:
    """(step, name, n, percent): how many cases are left after each filter, in one pass."""
    kept, sums = F.lit(True), [F.count("*").alias("n0")]
    steps = predicates()
    for k, (_, keep) in enumerate(steps, 1):
        kept = kept & F.coalesce(keep, F.lit(False))
        sums.append(F.count(F.when(kept, 1)).alias(f"n{k}"))
    names = ["all", *[n for n, _ in steps]]
    rows = F.explode(
        F.array(*[F.struct(F.lit(k).alias("step"), F.lit(n).alias("name"), F.col(f"n{k}").alias("n")) for k, n in enumerate(names)])
    )
    return (
        cases.agg(*sums)
        .select("n0", rows.alias("r"))
        .select("r.*", F.when(F.col("n0") > 0, F.round(100.0 * F.col("r.n") / F.col("n0"), 6)).otherwise(0.0).alias("percent"))
    )


def outcomes(elements: DataFrame, article: str = "article") -> DataFrame:
    """Findings per article: violation, no violation, total."""
    return (
        elements.where(F.col("type").isin(*_FINDINGS) & F.col(article).isNotNull())
        .groupBy(article)
        .agg(
            F.count(F.when(F.col("type") == "violation", 1)).alias("violation"),
            F.count(F.when(F.col("type") == "no-violation", 1)).alias("no_violation"),
            F.count("*").alias("total"),
        )
    )


def consistent(elements: DataFrame, key: str = "itemid", article: str = "article") -> DataFrame:
    """Cases with a finding whose findings never contradict one another on one article."""
    found = elements.where(F.col("type").isin(*_FINDINGS) & F.col(article).isNotNull())
    per = found.groupBy(key, article).agg(F.min("type").alias("a"), F.max("type").alias("b"))
    return per.groupBy(key).agg(F.bool_and(F.col("a") == F.col("b")).alias("ok")).where("ok").select(key)


def multilabel(elements: DataFrame, key: str = "itemid") -> DataFrame:
    """(key, article, label): every consistent case with all its labels."""
    found = elements.where(F.col("type").isin(*_FINDINGS) & F.col("article").isNotNull())
    labels = found.select(key, "article", (F.col("type") == "violation").cast("int").alias("label")).distinct()
    return labels.join(consistent(elements, key), key, "left_semi")


def multiclass(elements: DataFrame, key: str = "itemid") -> DataFrame:
    """(key, article, label): consistent cases that name one article only, with their first finding on it."""
    single = (
        elements.where(F.col("article").isNotNull()).groupBy(key).agg(F.min("article").alias("a"), F.max("article").alias("b")).where("a = b")
    )
    found = elements.where(F.col("type").isin(*_FINDINGS) & F.col("article").isNotNull())
    first = found.groupBy(key, "article").agg(F.min_by("type", F.struct("at", "k")).alias("type"))
    return (
        first.join(single.select(key), key, "left_semi")
        .join(consistent(elements, key), key, "left_semi")
        .select(key, "article", (F.col("type") == "violation").cast("int").alias("label"))
    )


def attribute_stats(cases: DataFrame, scalars: list[str], lists: list[str]) -> DataFrame:
    """(attribute, cardinality, density): distinct values of each attribute, and per case."""
    arrays = [F.array(F.col(c)) for c in scalars] + [multi_value(F.col(c)) for c in lists]
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("attribute"), a.alias("vs")) for n, a in zip([*scalars, *lists], arrays)]))
    values = cases.select(named.alias("x")).select("x.attribute", F.explode_outer("x.vs").alias("value"))
    kept = values.withColumn("value", F.when(F.trim("value") != "", F.col("value")))
    # Two steps rather than count(distinct): the first aggregates partially on both columns.
    distinct = kept.distinct().groupBy("attribute").agg(F.count("value").alias("cardinality"))
    n = cases.agg(F.count("*").alias("n"))
    return distinct.crossJoin(F.broadcast(n)).select(
        "attribute", "cardinality", F.when(F.col("n") > 0, F.col("cardinality") / F.col("n")).otherwise(0.0).alias("density")
    )


def prevalence(elements: DataFrame, key: str = "itemid", every: bool = True) -> DataFrame:
    """Per base article of consistent cases: findings and their shares; ``every`` False takes a case's first finding."""
    found = elements.where(F.col("type").isin(*_FINDINGS) & F.col("base_article").isNotNull())
    found = found.join(consistent(elements, key, "base_article"), key, "left_semi")
    size = found.agg(F.count_distinct(key).alias("size"))
    if not every:
        found = found.groupBy(key).agg(F.min_by(F.struct("base_article", "type"), F.struct("at", "k")).alias("f")).select(key, "f.*")
    counts = outcomes(found, "base_article")
    return counts.crossJoin(F.broadcast(size)).select(
        "base_article", "violation", "no_violation",
        (F.col("violation") / F.col("total")).alias("class_normalized"),
        (F.col("violation") / F.col("size")).alias("violation_normalized"),
        (F.col("no_violation") / F.col("size")).alias("no_violation_normalized"),
    )


def windowless_rank(df: DataFrame, *order: str) -> DataFrame:
    """df with ``rank`` from 1 in a total order, for small results only (one partition ranks them)."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
