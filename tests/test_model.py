"""Documents, relational model, flat forms, sources, workflow and streaming."""

import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from lexweave.functions import tagging
from lexweave.functions import text as ft
from lexweave.operators import documents as od
from lexweave.operators import features, flat, formatted, relational
from lexweave.plans import model, texts, workflow
from lexweave.session import durable
from lexweave.sources import files, lookups
from lexweave.streaming.incremental import load_stream


# Columns of a case that passes the filters.
USABLE = {"languageisocode": "ENG", "doctype": "HEJUD", "fetched_at": 1, "record_id": 1}


def test_dense_ids_are_a_total_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v")).repartition(7)
    got = relational.dense_ids(df, ["v"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 1001)) and [r["v"] for r in got] == sorted(r["v"] for r in got)
    assert relational.dense_ids(df.limit(0), ["v"]).count() == 0


def test_tree_and_leaves(spark):
    rows = [(1, 0, "before", 5), (1, 1, "TITLE", 1), (1, 2, "1. intro", 5), (1, 3, "Head", 2), (1, 4, "2. para", 5), (1, 5, "NEXT", 1)]
    tree = od.tree(spark.createDataFrame(rows, "doc_id int, pos int, line string, level int"))
    assert {(r["pos"], r["parent_pos"]) for r in tree.collect()} == {(1, None), (2, 1), (3, 1), (4, 3), (5, None)}
    assert od.leaf_text(tree).first()["text"] == "intro\npara\nNEXT"
    skipped = spark.createDataFrame([(1, 1)], "doc_id int, pos int")
    assert od.leaf_text(tree, without=skipped).first()["text"] == "NEXT"
    got = json.loads(od.nested(tree).first()["tree"])
    assert [n["content"] for n in got] == ["TITLE", "NEXT"]
    assert [n["content"] for n in got[0]["elements"]] == ["1. intro", "Head"]


def test_tables(spark):
    rows = spark.createDataFrame([(1, 0, ["h1", "h2"], ["v1", "10"]), (1, 1, ["h1", "h2"], ["12.0", "v\n4"])], "t int, place int, header array<string>, cells array<string>")
    assert od.table_text(rows, "t").first()["text"] == "h1 h2\nv1 10\n12.0 v 4\n"
    twice = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3", "4"])], "h array<string>, c array<string>")
    assert twice.select(od.table_maps(F.col("h"), F.col("c"))).first()[0] == {"b": "2", "a": "3"}


def test_judges(spark):
    lines = spark.createDataFrame([(1, "Mr Kūris-Foo President,"), (2, "nobody")], "id int, line string")
    judges = spark.createDataFrame([("B", "KURIS FOO"), ("A", "KURIS"), ("C", "")], "country string, name string")
    assert [tuple(r)[::2] for r in od.match_judges(lines, judges).collect()] == [(1, "KURIS")]
    assert od.unmatched(lines, judges).first()["id"] == 2


def test_judges_of_every_country(spark, tmp_path):
    rows = [(1, "Foo, Ann", "judge", "TVR"), (2, "Ann FOO", "judge", "KES"), (3, "Bar, Bob", "judge", "KES"), (4, "Bob BAR", "judge", None), (5, "Nobody", None, None)]
    spark.createDataFrame(rows, "id int, name string, role string, country string").write.parquet(f"{tmp_path}/decisionbodymember.parquet")
    spark.createDataFrame([], "respondent string, docname string").write.parquet(f"{tmp_path}/leading_case.parquet")
    assert {(r["id"], r["judge"]) for r in texts.judge_match(spark, str(tmp_path)).collect()} == {(1, "Foo"), (2, "Foo"), (3, "Bar"), (4, "Bar")}
    assert [r["id"] for r in texts.judge_rejects(spark, str(tmp_path)).collect()] == [5]
    with pytest.raises(ValueError):
        od.match_judges(*texts._judge_lines(spark, str(tmp_path)), limit=1)


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The Court's café, naïve naïve!",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(ft.clean_tokens(F.col("t"))).collect()]
    assert got == [["court", "cafe", "naive", "naive"], [], None]
    assert df.select(ft.ngrams(ft.clean_tokens(F.col("t")), 3)).first()[0] == ["court_cafe_naive", "cafe_naive_naive"]


def test_frequencies_of_all_grams_are_corrected(spark):
    words = ["art", "arts", "part", "case", "cases", "law"]
    texts_ = [" ".join(words[(i * k + i // 3) % 6] for i in range(60)) for k in range(1, 6)] + [" ".join(f"word{i}" for i in range(700))]
    counts = features.ngram_counts(spark.createDataFrame([(t,) for t in texts_], "text string"), 3)
    before = {(r["n"], r["gram"]): r["count"] for r in counts.collect()}
    want = {
        (n, g): c - sum(("_" + g in x) + ("_" + g + "_" in x) + (g + "_" in x) for m, x in before if m == n + 1) for (n, g), c in before.items()
    }
    assert len(want) > 2000 and {(r["n"], r["gram"]): r["count"] for r in features.corrected_frequencies(counts).collect()} == want


def test_corrected_frequencies_of_words_with_underscores_and_few_rows_moved(spark):
    words = ["art", "arts", "part", "s_bureau", "bureau", "_law", "law_", "___", "law", "tsart"]
    texts_ = [" ".join(words[(i * k + i // 5) % 10] for i in range(90)) for k in range(1, 8)]
    counts = features.ngram_counts(spark.createDataFrame([(t,) for t in texts_], "text string"), 4)
    before = {(r["n"], r["gram"]): r["count"] for r in counts.collect()}
    want = {
        (n, g): c - sum(("_" + g in x) + ("_" + g + "_" in x) + (g + "_" in x) for m, x in before if m == n + 1) for (n, g), c in before.items()
    }
    assert any(n < 3 and g.count("_") > n for n, g in want) and {(r["n"], r["gram"]): r["count"] for r in features.corrected_frequencies(counts).collect()} == want
    long = spark.createDataFrame([(" ".join(f"{chr(97 + i % 26)}{'x' * 20}{i}" for i in range(300)),)], "text string")
    counts = durable(features.ngram_counts(long, 4))
    rows = len(features.corrected_frequencies(counts).collect())
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    run = store.executionsList().last()
    values, metrics = store.executionMetrics(run.executionId()), run.metrics()
    ids = {m.accumulatorId() for m in (metrics.apply(i) for i in range(metrics.size())) if m.name() == "shuffle records written"}
    moved = [int(values.apply(i).replace(",", "")) for i in ids if values.contains(i)]
    assert rows < sum(moved) < 8 * rows  # beginnings of words that no gram has aren't moved


def test_tfidf_rows_have_length_one(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["a", "c"]), (3, ["c"])], "doc_id int, tokens array<string>")
    bow = features.bag_of_words(docs, features.vocabulary(docs, 10))
    rows = features.tfidf(bow, docs.agg(F.count("*").alias("n"))).collect()
    for d in (1, 2, 3):
        assert sum(r["w"] ** 2 for r in rows if r["doc_id"] == d) == pytest.approx(1.0)


def test_ternary_and_counts(spark):
    rows = [("a", 0, 0, "violation", "3"), ("a", 1, 0, "other", "3"), ("b", 0, 0, "violation", "8")]
    e = spark.createDataFrame(rows, "itemid string, at int, k int, type string, article string")
    got = {r["itemid"]: (r["ccl_article=3"], r["ccl_article=8"]) for r in flat.ternary(e, "itemid", ["3", "8"]).collect()}
    assert got == {"a": (-1, 0), "b": (0, 1)}


def test_ternary_has_a_column_for_every_article(spark, tmp_path):
    rows = [("a", "Violation of Art. 3;No violation of Art. 14"), ("b", "Violation of Art. 18")]
    df = spark.createDataFrame(rows, "itemid string, conclusion string")
    fields = [F.lit(v).alias(k) for k, v in USABLE.items()]
    df.select("*", *fields).write.parquet(f"{tmp_path}/cases_info.parquet")
    got = {r["itemid"]: r.asDict() for r in model.ternary_matrix(spark, str(tmp_path)).collect()}
    assert got == {
        "a": {"itemid": "a", "ccl_article=14": -1, "ccl_article=18": 0, "ccl_article=3": 1},
        "b": {"itemid": "b", "ccl_article=14": 0, "ccl_article=18": 1, "ccl_article=3": 0},
    }
    with pytest.raises(ValueError):
        flat.values_of(df, "itemid", 1)


def test_one_hot_has_a_column_for_every_value(spark, tmp_path):
    df = spark.createDataFrame([("a", "CASELAW;KES", "NEW"), ("b", "KES", None)], "itemid string, documentcollectionid string, doctypebranch string")
    df.select("*", *[F.lit(v).alias(k) for k, v in USABLE.items() if k not in df.columns]).write.parquet(f"{tmp_path}/cases_info.parquet")
    got = {r["itemid"]: r.asDict() for r in model.onehot_list(spark, str(tmp_path)).collect()}
    assert {k: v["documentcollectionid=KES"] for k, v in got.items()} == {"a": 1, "b": 1} and got["b"]["documentcollectionid=CASELAW"] == 0
    assert {r["itemid"]: r["doctypebranch=NEW"] for r in model.onehot_scalar(spark, str(tmp_path)).collect()} == {"a": 1, "b": 0}
    with pytest.raises(Exception, match="no column x=NEW"):
        flat.count_pivot(df, "itemid", "doctypebranch", ["CHAMBER"], "x").collect()


def test_vocabulary_has_the_size_of_the_reference(spark, tmp_path):
    rows = [(k, " ".join(f"w{i}" for i in range(600 * k, 600 * k + 600))) for k in range(10)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert texts.vocab_topk(spark, str(tmp_path)).count() == texts.bow(spark, str(tmp_path)).count() == 5_000


def test_unique_or_reject_and_reload(spark):
    df = spark.createDataFrame([("a", "e1"), ("b", "e1"), ("c", None), ("d", None)], "itemid string, ecli string")
    kept, out = relational.unique_or_reject(df, "ecli", "itemid")
    assert {r[1 - 1] for r in kept.select("itemid").collect()} == {"a", "c", "d"} and out.select("itemid").first()[0] == "b"
    assert relational.load_new(kept, df, "itemid").count() == 1


def _docx(paragraphs, table=()):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r><w:smartTag><w:r><w:t>{x}</w:t></w:r></w:smartTag></w:p>' for s, t, x in paragraphs)
    rows = "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{c}</w:t></w:r></w:p></w:tc>" for c in r) + "</w:tr>" for r in table)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}<w:tbl>{rows}</w:tbl></w:body></w:document>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(_docx([("Ju_H_Head", "PROCEDURE", " tail"), ("Ju_Para", "1. text", "")], [("h", "k"), ("1", "2")]))
    (tmp_path / "b.docx").write_bytes(b"no zip")
    rows = files.read_docx(spark, str(tmp_path)).orderBy("path", "pos").collect()
    assert [(r["kind"], r["style"], r["text"]) for r in rows] == [
        ("paragraph", "Ju_H_Head", "PROCEDURE tail"), ("paragraph", "Ju_Para", "1. text"), ("table", "Ju_Para", "h\tk\n1\t2"), ("broken", None, None),
    ]
    styled = spark.createDataFrame([("Ju_H_Head",), ("Ju_Judges",), ("?",)], "s string")
    assert [r[0] for r in styled.select(od.style_level(F.col("s"))).collect()] == [1, -1, 0]


def test_case_files_and_sinks(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"results": [{"columns": {"itemid": "001-1", "docname": "X"}}]}))
    (folder / "b.json").write_text("{broken")
    df = files.read_cases(spark, str(folder))
    assert [r["itemid"] for r in df.collect()] == ["001-1"] and len(df.columns) == 34
    assert files.broken_files(spark, str(folder)).count() == 1
    files.write_csv(df.select("itemid", "docname"), str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv"), [1]).first()[0] == "X"
    files.write_json(df, str(tmp_path / "json"), by="itemid")
    files.write_lines(df, "docname", str(tmp_path / "txt"), "itemid")
    assert files.read_text(spark, str(tmp_path / "txt")).first()[0].strip() == "X"
    files.write_tables({"cases": df}, str(tmp_path / "db"))
    assert spark.read.parquet(str(tmp_path / "db" / "cases")).count() == 1


def test_judge_map(spark):
    nested = json.dumps({"Y": {"A": {"start": "1990", "end": None, "full_name": "A B"}}, "Z": {}})
    df = spark.createDataFrame([(nested,)], "value string")
    assert [tuple(r) for r in lookups.judges(df).collect()] == [("Y", "A", "1990", None, "A B")]


def test_workflow(monkeypatch, tmp_path):
    flows = {"local": [("datasets", "workflow"), ("database", "workflow")], "datasets": [("a", "action"), ("b", "action")], "database": [("a", "action"), ("c", "action")]}
    actions = {"a": lambda x: x, "b": lambda x: x + 1, "c": lambda x: x + 2}
    steps = workflow.flatten("local", flows, actions)
    assert steps == ["a", "b", "c"] and [r for *_, r in workflow.run(steps, actions, x=1)] == [1, 2, 3]
    with pytest.raises(KeyError):
        workflow.flatten("none", flows, actions)
    monkeypatch.setenv("FOO", "env")
    assert workflow.substitute("$FOO") == "env" and workflow.substitute("$BAR", {"bar": 3}) == 3 and workflow.substitute("$MAX_DOCUMENTS") == -1
    with pytest.raises(KeyError):
        workflow.substitute("$NOTHING")
    assert workflow.server_parameters("user=foo password=bar") == ({"user": "foo", "password": "bar"}, ["host", "folder", "build", "workflow"])
    workflow.prepare_folder(str(tmp_path / "b"))
    with pytest.raises(FileExistsError):
        workflow.prepare_folder(str(tmp_path / "b"))
    workflow.prepare_folder(str(tmp_path / "b"), "force")
    assert workflow.duration(3725) == "01:02:05"


def test_stream_loads_new_keys_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    first.write.parquet(source)
    load_stream(spark, source, first.schema, target, "id", check).awaitTermination()
    spark.createDataFrame([(2, "again"), (3, "c")], "id bigint, v string").write.mode("append").parquet(source)
    load_stream(spark, source, first.schema, target, "id", check).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_judge_list(spark):
    rows = ["NORTHLAND AND EAST / LE NORD", "1959 - 1966 Ann Mary SMITH-JONES", "1998 - Peter McCoy OLD (President)", "2001 - / X", "2003 - a", "1970 - 1971 Q. Ann SMITH JONES", "SOUTH OF WEST", "1999 - J. DOE", "note"]
    df = spark.createDataFrame([(1, 0, "1900 - Nobody's")] + [(1, k, r) for k, r in enumerate(rows, 1)], "doc_id int, pos int, line string")
    got = {(r["country"], r["name"]): (r["start"], r["end"], r["full_name"]) for r in od.judge_rows(df).collect()}
    assert got == {
        ("Northland and East", "SMITH JONES"): ("1970", "1971", "Q. Ann SMITH JONES"), ("Northland and East", "MCCOY OLD"): ("1998", None, "Peter McCoy OLD"),
        ("South of West", "DOE"): ("1999", None, "J. DOE"),
    }
    assert od.judge_rows(df.limit(0)).count() == 0


def test_sections_are_first_level_titles(spark):
    rows = [(1, 0, "III. THE LAW", 1), (1, 1, "The law on languages", 5), (1, 2, " the facts", 1), (1, 3, "Relevant facts", 1), (2, 0, "CONCLUSION of all", 1), (2, 1, None, 1)]
    df = spark.createDataFrame(rows, "doc_id int, pos int, line string, level int")
    assert {tuple(r) for r in od.tag_sections(df).collect()} == {(1, 0, "law"), (1, 2, "facts"), (2, 0, "conclusion")}


def test_flatten_nested(spark):
    texts = ['{"a":{"b":[1,{"c":null},[]]},"d":"x","e":true,"f":1.50}', "[]", "7", "nonsense", None, "", '{"x":{}}', "[" * 900 + "]" * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string").selectExpr("*", "1 as path")
    got = sorted(tuple(r) for r in flat.flatten_nested(df, "id", "j").collect())
    deep = [r for r in got if r[0] == 7]
    assert [r for r in got if r[0] != 7] == [(0, "a.b.0", "1"), (0, "a.b.1.c", None), (0, "a.b.2", "[]"), (0, "d", "x"), (0, "e", "true"), (0, "f", "1.50"), (1, "", "[]"), (2, "", "7"), (6, "x", "{}")]
    assert len(deep) == 1 and deep[0][1].count(".") == 898
    assert flat.flatten_nested(df.limit(0), "id", "j").count() == 0


def test_encoded_cases(spark):
    finding = "array<struct<article:string,type:string>>"
    rows = [("c1", ["a", "a", "b"], [("8", "violation"), ("8", "no-violation"), ("6", "violation")]), ("c2", [], [(None, "other")]), ("c3", None, None)]
    df = spark.createDataFrame(rows, f"itemid string, list array<string>, conclusion {finding}")
    got = {r["itemid"]: r.asDict() for r in formatted.encoded(df, ["list"], []).collect()}
    assert got["c1"] == {"itemid": "c1", "list=a": 2, "list=b": 1, "ccl_article=6": 1, "ccl_article=8": -1}
    assert set(got["c2"].values()) == {"c2", 0} and set(got["c3"].values()) == {"c3", 0}


def test_encoded_cases_have_as_many_columns_as_the_data_need(spark):
    values = [f"v{k:05}" for k in range(10_001)]
    df = spark.createDataFrame([("c1", values, None), ("c2", values[-1:] * 2, None)], "itemid string, list array<string>, conclusion array<struct<article:string,type:string>>")
    wide = formatted.encoded(df, ["list"], [])
    assert wide.columns == ["itemid", *[f"list={v}" for v in values]]
    got = wide.agg(F.sum("`list=v00000`"), F.sum("`list=v10000`"), F.max("`list=v10000`")).first()
    assert tuple(got) == (1, 3, 2)


def test_encoded_cases_are_dealt_out_by_their_cells(spark, monkeypatch):
    finding = "array<struct<article:string,type:string>>"
    df = spark.createDataFrame([(f"c{k}", [f"v{k % 5}"], None) for k in range(60)], f"itemid string, list array<string>, conclusion {finding}").coalesce(1)
    assert formatted.encoded(df, ["list"], []).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(formatted, "TASK_CELLS", 20)
    wide = formatted.encoded(df, ["list"], [])
    assert wide.rdd.getNumPartitions() == 15
    assert {tuple(r)[1:] for r in wide.collect()} == {tuple(int(k == j) for k in range(5)) for j in range(5)} and wide.count() == 60
    assert formatted.encoded(df.limit(0), ["list"], []).count() == 0


def test_data_set_lines_read_each_text_once_for_the_vocabulary_and_once_for_the_line(spark):
    both = model.dataset_descriptive_bow(spark, "/root/testdata/sf0.001")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") == 3  # once more for the cases' first documents, without texts


def test_tables_of_base_forms(spark):
    docs = spark.createDataFrame([(1, ["courts", "ran", "zzz", "courts"]), (2, None)], "doc_id int, tokens array<string>")
    lexicon = spark.createDataFrame([("courts", "noun", "court"), ("ran", "verb", "run")], "token string, pos string, lemma string")
    assert sorted(tuple(r) for r in tagging.by_table(docs, lexicon).collect()) == [(1, 0, "courts", "noun", "court"), (1, 1, "ran", "verb", "run"), (1, 3, "courts", "noun", "court")]
    tagged = docs.where("doc_id = 1").select(tagging.tag(F.col("tokens"), lambda ws: [("noun" if w == "courts" else "verb", w.rstrip("s")) for w in ws]).alias("t"))
    assert tagged.select(tagging.of_classes(F.col("t"), rejected=("verb",)).alias("x")).first()["x"] == ["court", "court"]
