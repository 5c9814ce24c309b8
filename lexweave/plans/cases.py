"""Queries over case metadata and findings, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cases as fn
from ..operators import cases as op
from ..operators import conclusions as ccl
from ..session import table
from ..sources import lookups
from .fixtures import ARTICLES, ELEMENTS, sql

LISTS = ["externalsources", "documentcollectionid", "issue", "representedby"]


FILTERED = ("itemid", "languageisocode", "doctype", "conclusion")


def _cases(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current cases with the given columns."""
    return op.current(table(spark, sf_dir, "cases_info"), *columns)


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ccl.conclusion_elements(op.usable(_cases(spark, sf_dir, *FILTERED)), "itemid", "conclusion")


def current_cases(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "record_id", "docname", "isplaceholder").select("itemid", "record_id", "docname", "isplaceholder")


def parties_split(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "docname").select("itemid", F.posexplode(fn.parties(F.col("docname"))).alias("pos", "party"))


def article_split(spark, sf_dir):
    arts = sql(spark, sf_dir, ARTICLES, "lineitem")
    return arts.select("art", F.posexplode(fn.split_articles(F.col("art"))).alias("pos", "part"))


def base_articles(spark, sf_dir):
    return sql(spark, sf_dir, ARTICLES, "lineitem").select("art", fn.base_article(F.col("art")).alias("base"))


def article_list(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "article").select("itemid", F.explode(fn.article_list(F.col("article"))).alias("article"))


def subarticle_list(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "article").select("itemid", F.explode(fn.subarticle_list(F.col("article"))).alias("article"))


def multivalue_split(spark, sf_dir):
    cases = _cases(spark, sf_dir, "itemid", *LISTS, "extractedappno")
    named = [F.struct(F.lit(n).alias("field"), fn.multi_value(F.col(n)).alias("vs")) for n in LISTS]
    named.append(F.struct(F.lit("extractedappno").alias("field"), fn.multi_value(F.col("extractedappno"), keep_empty=True).alias("vs")))
    return cases.select("itemid", F.explode(F.array(*named)).alias("x")).select(
        "itemid", "x.field", F.posexplode("x.vs").alias("pos", "value")
    )


def filter_funnel(spark, sf_dir):
    return op.funnel(_cases(spark, sf_dir, *FILTERED))


def conclusion_elements(spark, sf_dir):
    text = f"""with elements as ({ELEMENTS}) select ok, array_join(transform(array_sort(collect_list(struct(ln, el))), x -> x.el), ';') ccl
               from elements group by ok"""
    found = ccl.conclusion_elements(sql(spark, sf_dir, text, "lineitem"), "ok", "ccl")
    return found.select(
        "ok", "element", "type", "article", "base_article", F.array_join("details", "|").alias("details"), F.array_join("mentions", "|").alias("mentions")
    )


def finding_mentions(spark, sf_dir):
    """Findings followed by brackets of their own: these are mentions of the finding before."""
    text = f"""with elements as ({ELEMENTS}) select ok, array_join(transform(array_sort(collect_list(struct(ln, el))), x -> concat(x.el, case when x.el like '%)' then concat(' (note ', x.ln, ')') else '' end)), ';') ccl
               from elements group by ok"""
    found = ccl.conclusion_elements(sql(spark, sf_dir, text, "lineitem"), "ok", "ccl")
    return found.where("mentions is not null").select("ok", "element", "article", F.array_join("details", "|").alias("details"), F.array_join("mentions", "|").alias("mentions"))


def case_conclusions(spark, sf_dir):
    return _elements(spark, sf_dir).select(
        "itemid", "element", "type", "article", "base_article", F.array_join("details", "|").alias("details")
    )


def outcomes_per_article(spark, sf_dir):
    return op.outcomes(_elements(spark, sf_dir))


def label_consistent_cases(spark, sf_dir):
    return op.consistent(_elements(spark, sf_dir))


def cases_per_article(spark, sf_dir):
    found = _elements(spark, sf_dir).where("article is not null and type <> 'other'")
    return found.join(op.consistent(_elements(spark, sf_dir)), "itemid", "left_semi").select("article", "itemid", "type")


def multilabel(spark, sf_dir):
    return op.multilabel(_elements(spark, sf_dir))


def multiclass(spark, sf_dir):
    return op.multiclass(_elements(spark, sf_dir))


def articles_by_total(spark, sf_dir):
    return op.windowless_rank(op.outcomes(_elements(spark, sf_dir)).select("article", "total"), "total", "article")


def attribute_stats(spark, sf_dir):
    return op.attribute_stats(
        _cases(spark, sf_dir, "itemid", "doctypebranch", "respondent", "importance", "languageisocode", "rank", *LISTS, "extractedappno"), ["doctypebranch", "respondent", "importance", "languageisocode", "rank"], [*LISTS, "extractedappno"]
    )


def prevalence(spark, sf_dir):
    return op.prevalence(_elements(spark, sf_dir))


def prevalence_first(spark, sf_dir):
    return op.prevalence(_elements(spark, sf_dir), every=False)


def country_lookup(spark, sf_dir):
    countries = lookups.countries(table(spark, sf_dir, "leading_case"))
    cases = _cases(spark, sf_dir, "itemid", "respondent").withColumn("alpha3", fn.first_of(F.col("respondent")))
    return lookups.matched(cases, countries, "alpha3").select("itemid", "alpha3", "country")


def country_missing(spark, sf_dir):
    countries = lookups.countries(table(spark, sf_dir, "leading_case"))
    cases = _cases(spark, sf_dir, "itemid", "respondent").withColumn("alpha3", fn.first_of(F.col("respondent")))
    return lookups.missing(cases, countries, "alpha3").select("itemid", "alpha3")


def body_lookup(spark, sf_dir):
    bodies = lookups.bodies(spark)
    return lookups.matched(_cases(spark, sf_dir, "itemid", "originatingbody"), bodies, "originatingbody").select("itemid", "body_type", "body_name")


def date_parse(spark, sf_dir):
    fields = ["decisiondate", "introductiondate", "judgementdate", "kpdate"]
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), fn.case_date(F.col(f)).alias("at")) for f in fields]))
    return _cases(spark, sf_dir, "itemid", *fields).select("itemid", named.alias("x")).select("itemid", "x.field", F.date_format("x.at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def date_cut(spark, sf_dir):
    """The four dates without their times; the last one keeps its dashes."""
    dashed = ["decisiondate", "judgementdate", "introductiondate"]
    cases = _cases(spark, sf_dir, "itemid", *dashed, "kpdate")
    return cases.select("itemid", *[fn.cut_date(F.col(c)).alias(c) for c in dashed], fn.cut_date(F.col("kpdate"), False).alias("kpdate"))


def documents_present(spark, sf_dir):
    have = table(spark, sf_dir, "documents").where("itemid is not null").select("itemid")
    return _cases(spark, sf_dir, "itemid").select("itemid").join(have, "itemid", "left_semi")


def documents_absent(spark, sf_dir):
    have = table(spark, sf_dir, "documents").where("itemid is not null").select("itemid")
    return _cases(spark, sf_dir, "itemid").select("itemid").join(have, "itemid", "left_anti")


def document_paths(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "application").select("itemid", fn.document_path(F.col("application"), F.col("itemid")).alias("path"))


def id_list(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid").where(fn.valid_id(F.col("itemid"))).select("itemid")


def year_requests(spark, sf_dir):
    """One request per year from 1959 on, both ends included, as the metadata service is asked."""
    last = table(spark, sf_dir, "cases_info").agg(F.year(F.max("fetched_at")).alias("last"))
    year = F.explode(F.sequence(F.lit(1959), F.col("last"))).alias("year")
    return last.select(year).select(
        "year", F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("first"), F.concat((F.col("year") + 1).cast("string"), F.lit("-01-01")).alias("last")
    )


def separate_opinions(spark, sf_dir):
    return _cases(spark, sf_dir, "itemid", "separateopinion").groupBy(F.coalesce(fn.is_true(F.col("separateopinion")), F.lit(False)).alias("separate")).agg(F.count("*").alias("n"))


def flat_projection(spark, sf_dir):
    """The flat form of a case: first number and party, dates cut, lists as text."""
    cases = _cases(spark, sf_dir)
    reps = F.filter(fn.multi_value(F.col("representedby")), lambda r: r != "N/A")
    return cases.select(
        "itemid", fn.first_of(F.col("appno")).alias("appno"), F.try_element_at(fn.parties(F.col("docname")), F.lit(1)).alias("applicant"),
        fn.first_of(F.col("respondent")).alias("respondent"), F.array_join(reps, ";").alias("representedby"),
        F.array_join(F.array_sort(fn.multi_value(F.col("issue"))), ";").alias("issue"), fn.cut_date(F.col("judgementdate")).alias("judgementdate"),
        F.col("importance").try_cast("int").alias("importance"),
    )


def set_equality(spark, sf_dir):
    """Cases whose numbers and extracted numbers are the same set."""
    cases = _cases(spark, sf_dir, "itemid", "appno", "extractedappno").where("appno is not null and extractedappno is not null")
    return cases.where(fn.same_set(F.split("appno", ";"), F.split("extractedappno", ";"))).select("itemid")


def sorted_articles(spark, sf_dir):
    """Article lists sorted as numbers where all are numbers, else as text."""
    return _cases(spark, sf_dir, "itemid", "article").where("article is not null").select(
        "itemid", F.array_join(fn.sort_mixed(F.split("article", ";")), ";").alias("sorted")
    )


def title_names(spark, sf_dir):
    names = table(spark, sf_dir, "representative").where("name is not null").select("name").distinct()
    return names.select("name", fn.title_case(F.col("name")).alias("title"))


_C = "with c as (select * from cases_info qualify row_number() over (partition by itemid order by fetched_at desc, record_id desc) = 1)"
_BASE = "case when contains(lower(string_split({0}, '+')[1]), 'p') then array_to_string(string_split(string_split({0}, '+')[1], '-')[1:2], '-') else string_split(string_split({0}, '+')[1], '-')[1] end"
_PARTS = """list_concat([string_split({0}, '+')[-1]], list_transform(list_filter(range(1, len(string_split({0}, '+'))),
   lambda i: not starts_with(string_split({0}, '+')[i + 1], string_split({0}, '+')[i])), lambda i: string_split({0}, '+')[i]))"""
_E = _C + r"""
, u as (select itemid, conclusion from c where languageisocode = 'ENG' and doctype = 'HEJUD' and (contains(conclusion, 'Violation') or contains(conclusion, 'violation')))
, piece as (
  select itemid, unnest(string_split(conclusion, ';')) p, generate_subscripts(string_split(conclusion, ';'), 1) k, len(string_split(conclusion, ';')) n from u
), e0 as (
  select itemid, k, trim(regexp_replace(p, '\(.*$', '')) element, nullif(regexp_extract(p, '\(([^)]*)\)', 1), '') details from piece where trim(p) <> ''
), e1 as (
  select *, case when starts_with(lower(element), 'violation') then 'violation' when starts_with(lower(element), 'no violation')
    or starts_with(lower(element), 'no-violation') then 'no-violation' else 'other' end as type,
    lower(regexp_extract(element, '(?i)art\. (\S+)', 1)) art from e0
), e2 as (
  select itemid, k, element, type, details, unnest(case when type = 'other' then [null] else __PARTS__ end) article from e1 where type = 'other' or art <> ''
), e as (
  select itemid, element, type, article, case when article is not null then __BASE__ end base_article, arg_max(details, k) filter (details is not null) details, min(k) pos
  from e2 group by all
)""".replace("__PARTS__", _PARTS.format("art")).replace("__BASE__", _BASE.format("article"))
_E = _E.replace("group by all\n)", "group by itemid, element, type, article\n)")
_OK = """, ok as (select itemid from (select itemid, article, count(distinct type) n from e where type <> 'other' and article is not null group by all)
  group by itemid having max(n) = 1)"""
_FMT = ["%d/%m/%Y %H:%M:%S", "%d/%m/%YT%H:%M:%S", "%d/%m/%Y", "%m/%d/%Y %I:%M:%S %p"]
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_LISTS = " union all ".join(
    f"select itemid, '{n}' field, unnest(case when {_STRIP.format(n)} = '' then [] else string_split({n}, ';') end) v,"
    f" generate_subscripts(case when {_STRIP.format(n)} = '' then [] else string_split({n}, ';') end, 1) - 1 pos from c"
    for n in LISTS
)
_STATS = " union all ".join(
    [f"select '{n}' attribute, {n} v from c" for n in ("doctypebranch", "respondent", "importance", "languageisocode", "rank")]
    + [f"select '{n}', {_STRIP.format('x')} from (select unnest(string_split({n}, ';')) x from c)" for n in [*LISTS, "extractedappno"]]
)
_COUNTRY = ", d as (select respondent alpha3, min(trim(string_split(docname, ' v. ')[2])) country from leading_case group by 1), r as (select itemid, string_split(respondent, ';')[1] alpha3 from c)"

ORACLES = {
    "current_cases": _C + " select itemid, record_id, docname, isplaceholder from c",
    "parties_split": _C + rf""" , n as (select itemid, regexp_replace(docname, '^CASE OF ', '') d from c),
        m as (select itemid, string_split(case when ends_with(d, ')') then string_split(d, '(')[1] else d end, ' v. ') a from n)
        select itemid, {_STRIP.format('unnest(a)')} party, generate_subscripts(a, 1) - 1 pos from m""",
    "article_split": f"with arts as ({ARTICLES}), x as (select art, {_PARTS.format('art')} a from arts) select art, unnest(a) part, generate_subscripts(a, 1) - 1 pos from x",
    "base_articles": f"with arts as ({ARTICLES}) select art, {_BASE.format('art')} base from arts",
    "article_list": _C + f" select distinct itemid, {_BASE.format('x')} article from (select itemid, unnest(string_split(lower(article), ';')) x from c)",
    "subarticle_list": _C + " select distinct itemid, unnest(regexp_split_to_array(article, '[;+]')) article from c",
    "multivalue_split": _C + f""" , l as ({_LISTS}) select itemid, field, pos, {_STRIP.format('v')} as value from l union all
        select itemid, 'extractedappno', generate_subscripts(string_split(extractedappno, ';'), 1) - 1, trim(unnest(string_split(extractedappno, ';'))) from c""",
    "filter_funnel": _C + """ , f as (select coalesce(languageisocode = 'ENG', false) a, coalesce(doctype = 'HEJUD', false) b,
        coalesce(contains(conclusion, 'Violation') or contains(conclusion, 'violation'), false) d from c),
        s as (select count(*) n0, count(*) filter (a) n1, count(*) filter (a and b) n2, count(*) filter (a and b and d) n3 from f)
        select t.step, t.name, t.n, round(100.0 * t.n / n0, 6) percent from s, lateral (values (0, 'all', n0), (1, 'language', n1), (2, 'doctype', n2),
        (3, 'conclusion', n3), (4, 'blocked', n3)) t(step, name, n)""",
    # From the findings before they were joined: a plain one is lost if a bracketed one follows before the end.
    "conclusion_elements": f"""with elements as ({ELEMENTS}), o as (select ok, el, row_number() over (partition by ok order by ln, el) k from elements),
        m as (select *, contains(el, '(') par, max(case when contains(el, '(') then k end) over (partition by ok) lastpar,
          max(k) over (partition by ok) n from o),
        mm as (select *, max(case when par and k < lastpar then k end) over (partition by ok) prevpar from m),
        kept as (select ok, k, regexp_replace(el, ' \\(.*$', '') element, case when par then 'procedural aspect' end details from mm
          where par or lastpar is null or k > lastpar or (lastpar = n and k > coalesce(prevpar, 0))),
        t as (select *, case when starts_with(element, 'Violation') then 'violation' when starts_with(element, 'No violation') then 'no-violation' else 'other' end as type,
          regexp_extract(element, 'Art\\. (\\S+)', 1) art from kept),
        u as (select ok, k, element, type, details, unnest(case when type = 'other' then [null] else {_PARTS.format('art')} end) article from t)
        select ok, element, type, article, case when article is not null then {_BASE.format('article')} end base_article, max(details) details, null::varchar mentions
        from u group by ok, element, type, article""",
    "case_conclusions": _E + " select itemid, element, type, article, base_article, details from e",
    "outcomes_per_article": _E + """ select article, count(*) filter (type = 'violation') violation, count(*) filter (type = 'no-violation') no_violation, count(*) total
        from e where type <> 'other' and article is not null group by article""",
    "label_consistent_cases": _E + _OK + " select itemid from ok",
    "cases_per_article": _E + _OK + " select article, itemid, type from e where type <> 'other' and article is not null and itemid in (select itemid from ok)",
    "multilabel": _E + _OK + """ select distinct itemid, article, case when type = 'violation' then 1 else 0 end as label from e
        where type <> 'other' and article is not null and itemid in (select itemid from ok)""",
    "multiclass": _E + _OK + """ select itemid, article, case when arg_min(type, pos) = 'violation' then 1 else 0 end as label from e
        where type <> 'other' and article is not null and itemid in (select itemid from ok)
        and itemid in (select itemid from e where article is not null group by itemid having count(distinct article) = 1) group by itemid, article""",
    "articles_by_total": _E + """ , t as (select article, count(*) total from e where type <> 'other' and article is not null group by article)
        select article, total, row_number() over (order by total, article) as rank from t""",
    "attribute_stats": _C + f" , v as ({_STATS}) select attribute, count(distinct case when trim(v) <> '' then v end) cardinality, count(distinct case when trim(v) <> '' then v end) / (select count(*) from c)::double density from v group by attribute",
    "prevalence": _E + """ , okb as (select itemid from (select itemid, base_article, count(distinct type) n from e where type <> 'other' and base_article is not null group by all) group by itemid having max(n) = 1),
        f as (select * from e where type <> 'other' and base_article is not null and itemid in (select itemid from okb)), s as (select count(distinct itemid) n from f)
        select base_article, count(*) filter (type = 'violation') violation, count(*) filter (type = 'no-violation') no_violation,
        count(*) filter (type = 'violation') / count(*)::double class_normalized, count(*) filter (type = 'violation') / (select n from s)::double violation_normalized,
        count(*) filter (type = 'no-violation') / (select n from s)::double no_violation_normalized from f group by base_article""",
    "prevalence_first": _E + """ , okb as (select itemid from (select itemid, base_article, count(distinct type) n from e where type <> 'other' and base_article is not null group by all) group by itemid having max(n) = 1),
        g as (select * from e where type <> 'other' and base_article is not null and itemid in (select itemid from okb)), s as (select count(distinct itemid) n from g),
        f as (select itemid, arg_min({'b': base_article, 't': type}, {'p': pos, 'a': article}) x from g group by itemid)
        select x.b base_article, count(*) filter (x.t = 'violation') violation, count(*) filter (x.t = 'no-violation') no_violation,
        count(*) filter (x.t = 'violation') / count(*)::double class_normalized, count(*) filter (x.t = 'violation') / (select n from s)::double violation_normalized,
        count(*) filter (x.t = 'no-violation') / (select n from s)::double no_violation_normalized from f group by x.b""",
    "country_lookup": _C + _COUNTRY + " select itemid, alpha3, country from r join d using (alpha3)",
    "country_missing": _C + _COUNTRY + " select itemid, alpha3 from r where alpha3 is null or alpha3 not in (select alpha3 from d)",
    "body_lookup": _C + " , b(originatingbody, body_type, body_name) as (values " + ", ".join(
        f"('{k}', '{t}', '{n}')" for k, (t, n) in lookups.BODIES.items()) + ") select itemid, body_type, body_name from c join b using (originatingbody)",
    "date_parse": _C + " select itemid, field, strftime(coalesce(" + ", ".join(f"try_strptime(v, '{f}')" for f in _FMT) + "), '%Y-%m-%d %H:%M:%S') as at from (" + " union all ".join(
        f"select itemid, '{f}' field, {f} v from c" for f in ("decisiondate", "introductiondate", "judgementdate", "kpdate")) + ")",
    "date_cut": _C + " select itemid, " + ", ".join(f"replace(string_split(string_split({d}, ' ')[1], 'T')[1], '-', '/') {d}" for d in ("decisiondate", "judgementdate", "introductiondate"))
        + ", string_split(string_split(kpdate, ' ')[1], 'T')[1] kpdate from c",
    "documents_present": _C + " select itemid from c where itemid in (select itemid from documents where itemid is not null)",
    "documents_absent": _C + " select itemid from c where itemid not in (select itemid from documents where itemid is not null)",
    "document_paths": _C + " select itemid, itemid || case when starts_with(application, 'MS WORD') then '.docx' else '.pdf' end as path from c",
    "id_list": _C + " select itemid from c where regexp_matches(itemid, '^001-[0-9]{5,6}$')",
    "year_requests": """select y::int as year, y || '-01-01' as first, (y + 1) || '-01-01' as last
        from (select unnest(range(1959, (select year(max(fetched_at at time zone 'UTC')) + 1 from cases_info))) y)""",
    "separate_opinions": _C + " select coalesce(upper(separateopinion) = 'TRUE', false) as separate, count(*) n from c group by 1",
    "flat_projection": _C + rf""" , n as (select *, regexp_replace(docname, '^CASE OF ', '') d from c)
        select itemid, string_split(appno, ';')[1] appno, {_STRIP.format("string_split(case when ends_with(d, ')') then string_split(d, '(')[1] else d end, ' v. ')[1]")} applicant,
        string_split(respondent, ';')[1] respondent,
        array_to_string(list_filter(list_transform(case when trim(representedby) = '' then [] else string_split(representedby, ';') end, lambda x: trim(x)), lambda x: x <> 'N/A'), ';') representedby,
        array_to_string(list_sort(list_transform(case when trim(issue) = '' then [] else string_split(issue, ';') end, lambda x: trim(x))), ';') issue,
        replace(string_split(string_split(judgementdate, ' ')[1], 'T')[1], '-', '/') judgementdate, try_cast(importance as int) importance from n""",
    "set_equality": _C + " select itemid from c where list_sort(list_distinct(string_split(appno, ';'))) = list_sort(list_distinct(string_split(extractedappno, ';')))",
    "sorted_articles": _C + """ select itemid, case when len(list_filter(string_split(article, ';'), lambda x: try_cast(x as double) is null)) = 0
        then array_to_string(list_transform(list_sort(list_transform(string_split(article, ';'), lambda x: {'n': x::double, 'v': x})), lambda s: s.v), ';')
        else array_to_string(list_sort(string_split(article, ';')), ';') end sorted from c where article is not null""",
    "title_names": r"""select distinct name, array_to_string(list_transform(regexp_extract_all(lower(name), '\pL+|[^\pL]+'), lambda p: upper(p[1]) || p[2:]), '') title
        from representative where name is not null""",
}

QUERIES = {
    f.__name__: f
    for f in (
        current_cases, parties_split, article_split, base_articles, article_list, subarticle_list, multivalue_split, filter_funnel, conclusion_elements,
        case_conclusions, outcomes_per_article, label_consistent_cases, cases_per_article, multilabel, multiclass, articles_by_total, attribute_stats,
        prevalence, prevalence_first, country_lookup, country_missing, body_lookup, date_parse, date_cut, documents_present, documents_absent,
        document_paths, id_list, year_requests, separate_opinions, flat_projection, set_equality, sorted_articles, title_names, finding_mentions,
    )
}
