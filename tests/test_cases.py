"""Columns and operators over case metadata against worked examples."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import cases as fn
from lexweave.operators import cases as op
from lexweave.operators import conclusions as ccl


def values(spark, column, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, x string")
    return [r[0] for r in df.orderBy("k").select(column(F.col("x"))).collect()]


def test_split_articles(spark):
    texts = ["3", "5-1+6+7+p1-3", "5-1+5-3", "14+5-3", ".2-a-c+,p3-1+#p41", ""]
    want = [["3"], ["5-1", "6", "7", "p1-3"], ["5-1", "5-3"], ["14", "5-3"], ["2-a-c", "p3-1", "p41"], [""]]
    assert [sorted(v) for v in values(spark, fn.split_articles, texts)] == [sorted(w) for w in want]
    assert values(spark, fn.split_articles, ["1+14"]) == [["14"]]
    assert sorted(values(spark, lambda c: fn.split_articles(c, strict=True), ["1+14"])[0]) == ["1", "14"]


def test_base_article(spark):
    assert values(spark, fn.base_article, ["5", "p1-3", "5-1", "14+5-3", "p4-4", "p7-1-1-a"]) == ["5", "p1-3", "5", "14", "p4-4", "p7-1"]


def test_parties(spark):
    texts = ["CASE OF SCHUMMER v. GERMANY(No. 1)", "CASE OF G.V. v. ROMANIA", "X v. Y AND Z"]
    assert values(spark, fn.parties, texts) == [["SCHUMMER", "GERMANY"], ["G.V.", "ROMANIA"], ["X", "Y AND Z"]]


def test_article_lists(spark):
    assert values(spark, fn.article_list, ["5;5-1;7;7-1", "1;14+7;14;P4-1"]) == [["5", "7"], ["1", "14", "7", "p4-1"]]
    assert values(spark, fn.subarticle_list, ["1;14+7;14;P4-1"]) == [["1", "14", "7", "P4-1"]]


def test_multi_value(spark):
    assert values(spark, fn.multi_value, ["A ; B", "", " "]) == [["A", "B"], [], []]
    assert values(spark, lambda c: fn.multi_value(c, keep_empty=True), [""]) == [[""]]


def test_dates_and_ids(spark):
    got = values(spark, lambda c: F.date_format(fn.case_date(c), "yyyy-MM-dd HH:mm"), ["13/02/2020 00:00:00", "13/02/2020", "2/13/2020 12:00:00 AM", "x", ""])
    assert got == ["2020-02-13 00:00", "2020-02-13 00:00", "2020-02-13 00:00", None, None]
    assert values(spark, fn.valid_id, ["001-12345", "001-1", "x001-12345"]) == [True, False, False]
    assert values(spark, fn.title_case, ["smith-jones o'neil ABC.d"]) == ["Smith-Jones O'Neil Abc.D"]


CONCLUSIONS = [
    ("Violation of Article 1 of Protocol No. 12 - General prohibition", [("p12-1", "p12-1", "violation", None)]),
    ("Violation of Article 13+P4-4 - Right", [("13", "13", "violation", None), ("p4-4", "p4-4", "violation", None)]),
    ("Violation of Article 6+6-1 - Right", [("6-1", "6", "violation", None)]),
    ("Violation of Article 14+5-3 - Right", [("14", "14", "violation", None), ("5-3", "5", "violation", None)]),
    (
        "Violation of Art. 2 (substantive aspect);Violation of Art. 2;Violation of Art. 13+2",
        [("2", "2", "violation", ["substantive aspect"]), ("13", "13", "violation", None), ("2", "2", "violation", None)],
    ),
    ("Non-pecuniary damage - award", [(None, None, "other", None)]),
    ("Violation of P1-1", []),
    ("", []),
]


@pytest.mark.parametrize("text,want", CONCLUSIONS)
def test_conclusions(spark, text, want):
    df = spark.createDataFrame([(1, text)], "id int, ccl string")
    got = ccl.conclusion_elements(df, "id", "ccl").select("article", "base_article", "type", "details").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_mentions_and_dropped_plain_elements(spark):
    text = "No violation of Article 14+2 - Ban (D1) (M1;M2)"
    df = spark.createDataFrame([(1, text), (2, "Plain one;Violation of Art. 3 (a);Plain two (b)"), (3, None)], "id int, ccl string")
    rows = ccl.conclusion_elements(df, "id", "ccl").collect()
    first = [r for r in rows if r["id"] == 1]
    assert {r["article"] for r in first} == {"14", "2"} and all(r["details"] == ["D1"] and r["mentions"] == ["M1", "M2"] for r in first)
    assert {r["element"] for r in rows if r["id"] == 2} == {"Violation of Art. 3", "Plain two"}
    kept = ccl.conclusion_elements(df.where("id = 2"), "id", "ccl", keep_plain=True).collect()
    assert {r["element"] for r in kept} == {"Plain one", "Violation of Art. 3", "Plain two"}


def test_funnel_and_labels_of_empty_tables(spark):
    empty = spark.createDataFrame([], "itemid string, languageisocode string, doctype string, conclusion string")
    assert {r["n"] for r in op.funnel(empty).collect()} == {0}
    none = spark.createDataFrame([], "itemid string, at int, k int, type string, article string, base_article string")
    assert op.consistent(none).count() == 0 and op.multiclass(none).count() == 0


def test_labels(spark):
    rows = [("a", 0, 0, "violation", "3", "3"), ("a", 1, 0, "no-violation", "3", "3"), ("b", 0, 0, "violation", "5-1", "5"), ("c", 0, 0, "other", None, None),
            ("d", 0, 0, "violation", "3", "3"), ("d", 1, 0, "violation", "5-1", "5")]
    e = spark.createDataFrame(rows, "itemid string, at int, k int, type string, article string, base_article string")
    assert {r[0] for r in op.consistent(e).collect()} == {"b", "d"}
    assert {tuple(r) for r in op.multiclass(e).collect()} == {("b", "5-1", 1)}
    assert op.multilabel(e).count() == 3


def test_attribute_stats(spark):
    df = spark.createDataFrame([("xyz", "1;2;3"), ("xy", "4;5;6"), ("x", "")], "a string, b string")
    got = {r["attribute"]: (r["cardinality"], r["density"]) for r in op.attribute_stats(df, ["a"], ["b"]).collect()}
    assert got == {"a": (3, 1.0), "b": (6, 2.0)}
