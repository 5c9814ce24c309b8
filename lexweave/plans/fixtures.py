"""Views that give the order tables the shape of findings, as one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table

# One finding per line item.
ELEMENTS = """
select l_orderkey ok, l_linenumber ln,
  concat(case l_returnflag when 'A' then 'Violation of Art. ' when 'R' then 'No violation of Art. '
                           else 'No separate issue under Art. ' end,
         cast(l_linenumber as varchar(9)),
         case when l_partkey % 3 = 0 then concat('-', cast(1 + l_suppkey % 3 as varchar(9))) else '' end,
         case when l_partkey % 7 = 0 then concat('+', cast(1 + l_suppkey % 13 as varchar(9))) else '' end,
         case when l_linestatus = 'O' then ' (procedural aspect)' else '' end) el
from lineitem
"""
# Articles with paragraphs and combinations.
ARTICLES = """
select distinct concat(cast(l_linenumber as varchar(9)),
  case when l_partkey % 3 = 0 then concat('-', cast(1 + l_suppkey % 3 as varchar(9))) else '' end,
  case when l_partkey % 5 = 0 then concat('+', cast(1 + l_suppkey % 14 as varchar(9))) else '' end,
  case when l_partkey % 11 = 0 then concat('+p', cast(1 + l_suppkey % 4 as varchar(9)), '-', cast(l_linenumber as varchar(9))) else '' end) art
from lineitem
"""


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    views(spark, sf_dir, *names)
    return spark.sql(text)
