"""The general training-data operators on edges and against brute force."""

import json
import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from lexweave.operators import orphans, packed, shredding, timestamps

CONCLUSION = "array<struct<element:string,type:string,article:string,base_article:string,details:array<string>,mentions:array<string>>>"


def test_shredded_records_come_back(spark):
    def node(depth, rng):
        n = {"content": rng.choice(["x", None, 3])}
        kind = rng.random()
        if depth and kind < 0.6:
            n["elements"] = [rng.choice([None, "text", 7]) if rng.random() < 0.2 else node(depth - 1, rng) for _ in range(rng.randint(0, 3))]
        elif depth and kind < 0.7:
            n["elements"] = node(depth - 1, rng)
        elif kind < 0.8:
            n["elements"] = rng.choice([None, [], "no list", 5])
        return n

    def brute(top, path="judgment"):
        out = []
        for k, e in enumerate(top):
            if isinstance(e, dict):
                out.append((path, f"{path}.{k}"))
                inner = e.get("elements")
                inner = [inner] if isinstance(inner, dict) else inner
                out.extend(brute(inner, f"{path}.{k}") if isinstance(inner, list) else [])
        return out

    rng = random.Random(5)
    rows, want = [], {}
    for i in range(60):
        top = [node(5, rng) for _ in range(rng.randint(0, 4))]
        text = json.dumps(top)
        text = {0: text, 1: json.dumps(text), 2: json.dumps({"a.docx": top}), 3: json.dumps({"content": {"a.docx": top}})}[i % 4]
        rows.append((i, text, None))
        want[i] = sorted(brute(top))
    deep = '[{"elements":' * 1_500 + "null" + "}]" * 1_500
    rows += [(100, None, None), (101, "", None), (102, "{bad", None), (103, "null", None), (104, "[]", None), (105, "5", None), (106, deep, None)]
    df = spark.createDataFrame(rows, f"record_no bigint, judgment string, conclusions {CONCLUSION}").withColumn("path", F.lit("clash"))
    got = shredding.nodes(shredding.shred(df)).collect()
    for i, nodes in want.items():
        assert sorted((r["parent_path"], r["child_path"]) for r in got if r["record_no"] == i) == nodes
    assert not [r for r in got if 100 <= r["record_no"] <= 105]
    assert sum(r["record_no"] == 106 for r in got) == 1_500


def test_deep_json_is_parsed_without_recursion():
    n = 200_000
    value, depth = shredding.parse('[{"a": 1, "elements":' * n + '[2, {"x": "y"}, null]' + "}]" * n), 0
    while isinstance(value[0], dict):
        value, depth = value[0]["elements"], depth + 1
    assert depth == n and value == [2, {"x": "y"}, None]
    assert shredding.parse("[" * n) is None and shredding.parse("[1" + "]" * n) is None


def test_shredded_conclusions(spark):
    c = [("e", "t", None, None, ["d0", "d1"], None), None, ("f", "t", "3", "3", [], ["m0", None, "m2"])]
    df = spark.createDataFrame([(1, "[]", c), (1, "[]", []), (2, None, None)], f"record_no bigint, judgment string, conclusions {CONCLUSION}")
    got = {(r["record_no"], r["child_path"], r["value"]) for r in shredding.nodes(shredding.shred(df)).collect()}
    assert got == {
        (1, "conclusions.0", "e"), (1, "conclusions.2", "f"), (1, "conclusions.0.details.0", "d0"), (1, "conclusions.0.details.1", "d1"),
        (1, "conclusions.2.mentions.0", "m0"), (1, "conclusions.2.mentions.2", "m2"),
    }


def test_packed_values(spark):
    texts = {
        "scl": ['"A v. B, no. 1/90; see x";C v. D | E v. F', '"X (""Y"") v. Z; q"', "Société « K » v. G, no. 1;;", "« A ; « B » ; c »;d", '"open; b', "", None, " ; "],
        "kpthesaurus": ["1 2;« a, b » 3", "“5”|6\n7"], "respondent": ['TVR, "MRN" / CRN and FRS', "SAND;andes"], "applicability": ["12;ratione materiae,“p / q”"],
    }
    rows = [(k, f, t) for f, ts in texts.items() for k, t in enumerate(ts)]
    out = {}
    for f in texts:
        df = spark.createDataFrame([(k, t) for k, g, t in rows if g == f], f"record_id bigint, {f} string")
        for limit in (50_000, 0):  # broadcast and shuffled rules
            got = packed.split_packed(df, fields={f: packed.FIELDS[f]}, broadcast_rules=limit).orderBy("record_id", "pos").collect()
            got = [(r["record_id"], r["pos"], r["item"]) for r in got]
            assert out.setdefault(f, got) == got
    items = lambda f, k: [i for r, _, i in out[f] if r == k]
    assert items("scl", 0) == ["A v. B, no. 1/90; see x", "C v. D", "E v. F"]
    assert items("scl", 1) == ['X ("Y") v. Z; q']
    assert items("scl", 2) == ["Société « K » v. G, no. 1"]
    assert items("scl", 3) == ["A ; « B » ; c", "d"]
    assert items("scl", 4) == ['"open', "b"]
    assert not items("scl", 5) + items("scl", 6) + items("scl", 7)
    assert items("kpthesaurus", 0) == ["1", "2", "a, b", "3"] and items("kpthesaurus", 1) == ["5", "6", "7"]
    assert items("respondent", 0) == ["TVR", "MRN", "CRN", "FRS"] and items("respondent", 1) == ["SAND", "andes"]
    assert items("applicability", 0) == ["12", "ratione materiae", "p / q"]
    assert [p for r, p, _ in out["scl"] if r == 0] == [1, 2, 3]


def test_timestamps_by_hand(spark):
    cases = {
        ("kpdate", "2/13/2020 12:00:00 AM"): "2020-02-12T23:00:00.000Z", ("judgementdate", "13/02/2020T01:02:03"): "2020-02-13T00:02:03.000Z",
        ("kpdate", "09.02.98"): "1998-02-08T23:00:00.000Z", ("kpdate", "1er avr. 2022 à 13h01"): "2022-04-01T11:01:00.000Z",
        ("kpdate", "30. Oktober 2017"): "2017-10-29T23:00:00.000Z", ("kpdate", "Tue, 20 Jan 2009 21:38:22 +0300"): "2009-01-20T18:38:22.000Z",
        ("kpdate", "1181213473413"): "2007-06-07T10:51:13.413Z", ("kpdate", "20060329T055800"): "2006-03-29T03:58:00.000Z",
        ("kpdate", "2012-10-28T02:30:00"): "2012-10-28T00:30:00.000Z", ("kpdate", "2012-03-25 02:30"): "2012-03-25T01:30:00.000Z",
        ("kpdate", "2002-09-06 07:31:23.044999+02:00"): "2002-09-06T05:31:23.044Z", ("kpdate", "01.01.49"): "2048-12-31T23:00:00.000Z",
        ("kpdate", "29/02/2015"): None, ("kpdate", "2019"): None, ("kpdate", "00/00/0000 00:00:00"): None, ("kpdate", ""): None, ("kpdate", None): None,
        ("decisiondate", "12/31/2015"): None, ("kpdate", "2014-04-26 17:44:07 CEST"): "2014-04-26T15:44:07.000Z", ("kpdate", "x" * 100_000): None,
    }
    fields = ("decisiondate", "judgementdate", "kpdate", "introductiondate")
    rows = [(k, *[t if f == field else None for f in fields]) for k, (field, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "record_id bigint, " + ", ".join(f"{f} string" for f in fields)).withColumn("utc", F.lit(1))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = {r["record_id"]: (r["field"], r["utc"]) for r in timestamps.normalise_timestamps(df).collect()}
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        for k, ((field, _), want) in enumerate(cases.items()):
            assert got.get(k) == ((field, want) if want else None), (k, field)


def test_wall_times_against_zoneinfo(spark):
    rng, paris = random.Random(2), ZoneInfo("Europe/Paris")
    times = [datetime(1980, 1, 1) + timedelta(seconds=rng.randrange(1_600_000_000)) for _ in range(400)]
    times += [datetime(2010 + y, m, d, 2, 30) for y in range(9) for m in (3, 10) for d in range(24, 32)]
    df = spark.createDataFrame([(k, t.strftime("%Y-%m-%d %H:%M:%S")) for k, t in enumerate(times)], "record_id bigint, kpdate string")
    got = {r["record_id"]: r["utc"] for r in timestamps.normalise_timestamps(df, fields=("kpdate",)).collect()}
    for k, t in enumerate(times):
        assert got[k] == t.replace(tzinfo=paris, fold=0).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")


def test_orphans(spark):
    at = datetime(2020, 1, 1)
    day = timedelta(days=1)
    cases = spark.createDataFrame(
        [("c1", "1/90;2/90", "False", at, 1), ("c2", "3/90", "False", at, 2), ("c2", "3/90", "TRUE", at + day, 3), ("c3", "4/90", None, at + 9 * day, 4), ("c4", None, "False", at, 5)],
        "itemid string, appno string, isplaceholder string, fetched_at timestamp, record_id bigint",
    )
    leading = spark.createDataFrame([("l1", "9/91;8/91")], "itemid string, appno string")
    names = ["1/90", "no. 3/90.", "4/1990", "7/77", "n° 0009 / 91", "2003/86/EC", "A/HRC/12/4", "vol. 12", "", None, "OJ L 155/17 p. 3", "3∕90"]
    apps = spark.createDataFrame([(k, n, "c1", at + day) for k, n in enumerate(names)], "id bigint, name string, itemid string, loaded_at timestamp")
    scl = spark.createDataFrame([(1, "A v. B, nos. 1/90, 5/95 and 5/1995, § 3", "c1", at + day), (2, "no number, §§ 1-2", None, at)], "id bigint, name string, itemid string, loaded_at timestamp")
    refs, states = orphans.references(apps, scl), orphans.case_states(cases, leading)
    for heavy in (orphans.HEAVY, 1.0):
        got = {(r["tbl"], r["ref_id"], r["appno"], r["reason"]) for r in orphans.orphans(refs, states, heavy).collect()}
        assert got == {
            ("extractedapp", 1, "3/90", "deleted"), ("extractedapp", 11, "3/90", "deleted"), ("extractedapp", 2, "4/90", "late"),
            ("extractedapp", 3, "7/77", "missing"), ("scl", 1, "5/95", "missing"),
        }
    assert orphans.orphans(refs, orphans.case_states(cases.limit(0), leading.limit(0))).where("reason <> 'missing'").count() == 0
    assert orphans.orphans(refs.limit(0), states).count() == 0
