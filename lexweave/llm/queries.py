"""Queries of the llm operators (problems 2, 4, 7, 8, 9) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe, canonical, mixing, names, spans


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: table(spark, sf_dir, t) for t in ("representative", "decisionbodymember", "party")}
    return names.name_pairs(names.link_names(tables))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per name with its class and the number of its links."""
    tables = {t: table(spark, sf_dir, t) for t in ("representative", "decisionbodymember", "party")}
    return names.entities(names.link_names(tables))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.map_to_list(table(spark, sf_dir, "conclusion"), table(spark, sf_dir, "article_list"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))[1]


def p8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source, whether its actual share is within 0.01 of its target and no record is repeated more than allowed."""
    near = F.abs(F.col("actual_share") - F.col("target_share")) <= 0.01
    return p8_shares(spark, sf_dir).select("source", near.alias("share_kept"), (F.col("most_repeats") <= F.col("max_repeats")).alias("cap_kept"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_pairs(table(spark, sf_dir, "documents"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_shares(table(spark, sf_dir, "documents"))


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and set of documents that hold the same run, with the number of documents."""
    return spans.shared_classes(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_entities, p4_found, p7_ids, p8_mix, p8_shares, p8_kept, p9_found, p9_shares, p9_classes)}
ORACLES: dict[str, str] = {"p8_kept": "select source, true share_kept, true cap_kept from mix_target"}
