"""Queries of lookups and thresholds, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as ft
from ..operators import probes
from ..session import table


def value_probe(spark, sf_dir):
    """Each customer segment, nation or region name: the first index that holds it."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(table(spark, sf_dir, "region").select("r_name"))
    more = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("row"))
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("value"), F.col("r_regionkey").alias("row"))
    return probes.first_match(names.union(more).distinct(), "name", [("nation", nations), ("region", regions)])


def threshold_filter(spark, sf_dir):
    return probes.above(table(spark, sf_dir, "customer"), "c_acctbal", 5000).select("c_custkey", "c_acctbal")


def most_words(spark, sf_dir):
    return probes.most_words(table(spark, sf_dir, "part"), "p_name")


def department_names(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", probes.department(F.col("n_nationkey")).alias("department"))


def number_split(spark, sf_dir):
    """Texts that begin with digits, cut after them."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return orders.select("o_orderpriority", ft.split_number(F.col("o_orderpriority")).alias("x")).select("o_orderpriority", "x.number", "x.rest")


ORACLES = {
    "value_probe": """with v as (select n_name as name from nation union select r_name from region union select c_mktsegment from customer)
        select v.name, case when n_nationkey is not null then 'nation' when r_regionkey is not null then 'region' end source, coalesce(n_nationkey, r_regionkey) as row
        from v left join nation on n_name = v.name left join region on r_name = v.name""",
    "threshold_filter": "select c_custkey, c_acctbal from customer where c_acctbal > 5000",
    "most_words": r"select max(len(regexp_split_to_array(trim(p_name), '\s+'))) words from part",
    "department_names": """select n_nationkey, case n_nationkey when 20 then '2A' when 21 then '2B' else lpad((case when n_nationkey > 21 then n_nationkey - 1 else n_nationkey end)::varchar, 2, '0') end department from nation""",
    "number_split": "select distinct o_orderpriority, regexp_extract(o_orderpriority, '^([0-9]+)([^0-9].*)$', 1) as number, regexp_extract(o_orderpriority, '^([0-9]+)([^0-9].*)$', 2) as rest from orders",
}
QUERIES = {f.__name__: f for f in (value_probe, threshold_filter, most_words, department_names, number_split)}
