"""Small dimensions and lookups against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Originating bodies by id, with their type.
BODIES = {
    "1": ("Commission", "First Chamber"),
    "2": ("Commission", "Second Chamber"),
    "3": ("Commission", "Plenary"),
    "4": ("Court", "First Section"),
    "5": ("Court", "Second Section"),
    "6": ("Court", "Third Section"),
    "7": ("Court", "Fourth Section"),
    "8": ("Court", "Grand Chamber"),
    "9": ("Court", "Chamber"),
    "15": ("Court", "Plenary"),
    "16": ("Court", "Screening Panel"),
    "17": ("Committee of Ministers", ""),
    "21": ("Commission", ""),
    "23": ("Court", "Fith Section"),
    "25": ("Court", "First Section Committee"),
    "26": ("Court", "Second Section Committee"),
    "27": ("Court", "Third Section Committee"),
    "28": ("Court", "Fourth Section Committee"),
    "29": ("Court", "Fith Section Committee"),
}
#: Rows up to which a dimension is broadcast.
SMALL = 10_000


def bodies(spark: SparkSession) -> DataFrame:
    rows = [(k, t, n) for k, (t, n) in BODIES.items()]
    return spark.createDataFrame(rows, "originatingbody string, body_type string, body_name string")


def countries(leading: DataFrame) -> DataFrame:
    """(alpha3, country) as the leading cases name their respondents."""
    name = F.trim(F.split_part("docname", F.lit(" v. "), F.lit(2)))
    return leading.groupBy(F.col("respondent").alias("alpha3")).agg(F.min(name).alias("country"))


def judges(nested: DataFrame) -> DataFrame:
    """(country, name, start, end, full_name) of a map of countries to maps of judges."""
    info = "struct<start:string,end:string,full_name:string>"
    parsed = nested.select(F.from_json("value", f"map<string,map<string,{info}>>").alias("m"))
    per_country = parsed.select(F.explode("m").alias("country", "judges"))
    return per_country.select("country", F.explode("judges").alias("name", "info")).select("country", "name", "info.*")


def small(dim: DataFrame, limit: int = SMALL) -> DataFrame:
    """The dimension with a broadcast hint if it is counted to be small; as it is otherwise."""
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def matched(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(small(dim), key)


def missing(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension lacks, to be reported rather than to fail."""
    return df.join(small(dim.select(key)), key, "left_anti")
