"""Queries of the relational model, flat forms and data sets, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cases as fn
from ..operators import cases as oc
from ..operators import datasets as ods
from ..operators import features as of
from ..operators import flat, formatted, relational
from ..session import durable, table
from ..sources import lookups
from . import cases as pc
from . import texts as pt

def _cases(spark, sf_dir, *columns):
    return pc._cases(spark, sf_dir, *columns)


def _pairs(spark, sf_dir, column, field):
    return _cases(spark, sf_dir, "itemid", field).select("itemid", F.explode(column).alias("name")).where("name <> ''").distinct()


def _parties(spark, sf_dir):
    return _pairs(spark, sf_dir, fn.parties(F.col("docname")), "docname")


def _representatives(spark, sf_dir):
    reps = F.filter(fn.multi_value(F.col("representedby")), lambda r: r != "N/A")
    return _pairs(spark, sf_dir, F.transform(reps, fn.title_case), "representedby")


def dim_party(spark, sf_dir):
    return relational.entity(_parties(spark, sf_dir))


def bridge_party(spark, sf_dir):
    return relational.bridge(_parties(spark, sf_dir), dim_party(spark, sf_dir))


def dim_representative(spark, sf_dir):
    return relational.entity(_representatives(spark, sf_dir))


def bridge_representative(spark, sf_dir):
    return relational.bridge(_representatives(spark, sf_dir), dim_representative(spark, sf_dir))


def _scl(spark, sf_dir):
    return table(spark, sf_dir, "scl").where("itemid is not null and name is not null").select("itemid", fn.title_case(F.col("name")).alias("name")).distinct()


def dim_scl(spark, sf_dir):
    return relational.entity(_scl(spark, sf_dir))


def bridge_scl(spark, sf_dir):
    return relational.bridge(_scl(spark, sf_dir), dim_scl(spark, sf_dir))


def dim_member(spark, sf_dir):
    """Members of decision bodies by name and role."""
    rows = table(spark, sf_dir, "decisionbodymember").where("name is not null").select(
        "name", F.coalesce(fn.title_case(F.col("role")), F.lit("")).alias("role")
    ).distinct()
    return relational.dense_ids(rows, ["name", "role"])


def _findings(spark, sf_dir):
    return relational.conclusion_rows(table(spark, sf_dir, "case_judgment"))


def dim_conclusion(spark, sf_dir):
    return relational.conclusions(_findings(spark, sf_dir))


def bridge_conclusion(spark, sf_dir):
    return relational.conclusion_cases(_findings(spark, sf_dir), dim_conclusion(spark, sf_dir))


def _notes(spark, sf_dir, column):
    return relational.entity(_findings(spark, sf_dir).select(F.explode(column).alias("name")))


def dim_detail(spark, sf_dir):
    return _notes(spark, sf_dir, "details")


def bridge_detail(spark, sf_dir):
    return relational.conclusion_notes(_findings(spark, sf_dir), dim_conclusion(spark, sf_dir), dim_detail(spark, sf_dir), "details")


def dim_mention(spark, sf_dir):
    return _notes(spark, sf_dir, "mentions")


def bridge_mention(spark, sf_dir):
    return relational.conclusion_notes(_findings(spark, sf_dir), dim_conclusion(spark, sf_dir), dim_mention(spark, sf_dir), "mentions")


def children(spark, sf_dir):
    """All child tables in one: (child, itemid, name)."""
    cases = _cases(spark, sf_dir)
    columns = {
        "article": fn.subarticle_list(F.col("article")), "issue": fn.multi_value(F.col("issue")),
        "externalsource": fn.multi_value(F.col("externalsources")), "documentcollectionid": fn.multi_value(F.col("documentcollectionid")),
        "kpthesaurus": fn.multi_value(F.col("kpthesaurus"), trimmed=False), "extractedapp": fn.multi_value(F.col("extractedappno")),
    }
    out = None
    for name, values in columns.items():
        part = relational.children(cases, values).select(F.lit(name).alias("child"), "itemid", "name")
        out = part if out is None else out.unionByName(part)
    return out


def case_table(spark, sf_dir):
    rows, _ = relational.unique_or_reject(_cases(spark, sf_dir), "ecli", "itemid")
    return rows.select(
        "itemid", "docname", "doctypebranch", "ecli", F.col("importance").try_cast("int").alias("importance"), "appno",
        F.date_format(fn.case_date(F.col("judgementdate")), "yyyy-MM-dd HH:mm:ss").alias("judgementdate"), "languageisocode",
        F.coalesce(fn.is_true(F.col("separateopinion")), F.lit(False)).alias("separateopinion"),
        F.col("typedescription").try_cast("int").alias("typedescription"),
    )


def ecli_rejects(spark, sf_dir):
    return relational.unique_or_reject(_cases(spark, sf_dir), "ecli", "itemid")[1].select("itemid", "ecli")


def cross_reference(spark, sf_dir):
    extracted = table(spark, sf_dir, "extractedapp").where("name is not null and itemid is not null").select("itemid", F.trim("name").alias("name")).distinct()
    return relational.cross_reference(extracted, _cases(spark, sf_dir))


def incremental_load(spark, sf_dir):
    """Cases fetched before 2020 are there; a reload of all brings the others."""
    rows = table(spark, sf_dir, "cases_info")
    loaded = rows.where("fetched_at < timestamp'2020-01-01 00:00:00Z'").select("itemid").distinct()
    return relational.load_new(loaded, rows.select("itemid"), "itemid")


def flatten_props(spark, sf_dir):
    return flat.flatten_json(table(spark, sf_dir, "events"), "event_id", "props")


def domain_mapping(spark, sf_dir):
    return flat.domains(flatten_props(spark, sf_dir))


def schema_infer(spark, sf_dir):
    return flat.inferred_schema(table(spark, sf_dir, "events"), "props")


def type_mapping(spark, sf_dir):
    """Path and type of every column of the judgments, nested ones by dotted path."""
    types = flat.type_map(table(spark, sf_dir, "case_judgment").schema)
    return spark.createDataFrame(list(types.items()), "path string, type string")


def onehot_list(spark, sf_dir):
    rows = _cases(spark, sf_dir).select("itemid", F.explode(fn.multi_value(F.col("documentcollectionid"))).alias("v"))
    return flat.count_pivot(rows, "itemid", "v", flat.values_of(rows, "v"), "documentcollectionid")


def onehot_scalar(spark, sf_dir):
    cases = _cases(spark, sf_dir)
    return flat.count_pivot(cases, "itemid", "doctypebranch", flat.values_of(cases, "doctypebranch"), "doctypebranch")


def ternary_matrix(spark, sf_dir):
    elements = durable(pc._elements(spark, sf_dir).where("article is not null").select("itemid", "at", "k", "type", "article"))
    return flat.ternary(elements, "itemid", flat.values_of(elements, "article"))


def citation_matrix(spark, sf_dir):
    return flat.edges(_cases(spark, sf_dir), "appno", fn.multi_value(F.col("extractedappno")))


def representative_matrix(spark, sf_dir):
    named = F.filter(fn.multi_value(F.col("representedby")), lambda r: r != "N/A")
    return flat.edges(_cases(spark, sf_dir, "itemid", "appno", "representedby"), "appno", named)


def scl_matrix(spark, sf_dir):
    return flat.edges(_cases(spark, sf_dir, "itemid", "appno", "scl"), "appno", fn.multi_value(F.col("scl"), trimmed=False))


def citation_map(spark, sf_dir):
    """The matrix of citations as one map per number, as text in the order of what is cited."""
    maps = flat.as_map(citation_matrix(spark, sf_dir), "appno")
    return maps.select("appno", F.array_join(F.transform(F.array_sort(F.map_keys("refs")), lambda k: F.concat(k, F.lit(":1"))), " ").alias("refs"))


def _formatted(spark, sf_dir):
    cases = oc.usable(_cases(spark, sf_dir, *formatted.READ, "doctype"))
    return formatted.formatted(cases, lookups.countries(table(spark, sf_dir, "leading_case")), lookups.bodies(spark))


_ARRAYS = ["externalsources", "documentcollectionid", "issue", "representedby", "extractedappno", "kpthesaurus", "scl", "parties", "article", "paragraphs"]


def formatted_case(spark, sf_dir):
    """The formatted case; lists as text, findings by their number."""
    cases = _formatted(spark, sf_dir)
    joined = [F.array_join(c, "|").alias(c) for c in _ARRAYS]
    return cases.select(*[c for c in cases.columns if c not in (*_ARRAYS, "conclusion")], *joined, F.size("conclusion").alias("findings"))


def flat_cases(spark, sf_dir):
    cases = formatted.flat(_formatted(spark, sf_dir))
    lists = ["respondent", "applicability", "issue", "article", "paragraphs", "documentcollectionid"]
    return cases.select(*[c for c in cases.columns if c not in (*lists, "conclusion")], *[F.array_join(c, "|").alias(c) for c in lists])


def encoded_cases(spark, sf_dir):
    """The flat case with a column per value of its lists and per article that a finding names."""
    return formatted.encoded(formatted.flat(_formatted(spark, sf_dir)), ["article", "documentcollectionid", "applicability", "paragraphs"], ["appno", "country", "importance"])


def flatten_nested(spark, sf_dir):
    """Every scalar of the judgments by its dotted path."""
    return flat.flatten_nested(table(spark, sf_dir, "case_judgment"), "record_no", "judgment")


def outcome_encode(spark, sf_dir):
    return ods.outcome_ids(pc._elements(spark, sf_dir))


def _values(spark, sf_dir):
    """All variables of the usable cases that have a finding."""
    lists = {n: F.col(n) for n in ods.LISTS}
    return ods.feature_values(_formatted(spark, sf_dir), list(dict.fromkeys(ods.SCALARS)), lists)


def feature_encode(spark, sf_dir):
    return ods.feature_ids(_values(spark, sf_dir))


def feature_index(spark, sf_dir):
    return spark.createDataFrame(list(ods.feature_index().items()), "variable string, i int")


def outcome_lines(spark, sf_dir):
    elements = durable(pc._elements(spark, sf_dir))
    return ods.outcome_lines(elements, ods.outcome_ids(elements), feature_encode(spark, sf_dir))


def _descriptive(spark, sf_dir, values, ids):
    kept = oc.consistent(pc._elements(spark, sf_dir), article="base_article")
    return ods.descriptive_lines(values, ids).join(kept, "itemid", "left_semi")


def descriptive_lines(spark, sf_dir):
    values = durable(_values(spark, sf_dir))
    return _descriptive(spark, sf_dir, values, ods.feature_ids(values)).select("itemid", "line")


def _case_bags(spark, sf_dir, cases, weights: bool):
    """(itemid, token_id, tf or weight) of the first document of each of the cases.

    The vocabulary, and with weights the documents that hold a token, are those of all documents;
    without weights only the texts of the cases are counted.
    """
    docs = pt._tokens(spark, sf_dir)
    vocab = of.vocabulary(docs, pt.TOKENS)
    held = table(spark, sf_dir, "documents").where("text is not null and itemid is not null")
    first = held.groupBy("itemid").agg(F.min("doc_id").alias("doc_id")).join(cases.select("itemid"), "itemid", "left_semi")
    if not weights:
        own = pt._docs(spark, sf_dir).join(first, "doc_id")
        return of.bag_of_words(own.select("itemid", pt.fn.tokens(F.col("text")).alias("tokens")), vocab, "itemid")
    bags = of.tfidf(of.bag_of_words(docs, vocab), docs.agg(F.count("*").alias("n")))
    return bags.select("doc_id", "token_id", F.format_string("%.6f", "w").alias("tf")).join(first, "doc_id").drop("doc_id")


def _dataset(spark, sf_dir, weights: bool):
    """(itemid, line, a, n, m) of the consistent cases that have a document: token ids stand after the descriptive features."""
    values = durable(_values(spark, sf_dir))
    ids = durable(ods.feature_ids(values))
    described = durable(_descriptive(spark, sf_dir, values, ids).withColumnRenamed("line", "a"))  # one plan for findings, another for texts
    own = _case_bags(spark, sf_dir, described, weights)
    shifted = own.crossJoin(F.broadcast(ids.agg(F.count("*").alias("shift")))).withColumn("token_id", F.col("token_id") + F.col("shift"))
    return described.join(of.vector_lines(shifted, "tf", "itemid", size="m"), "itemid")


def dataset_bow(spark, sf_dir):
    return _dataset(spark, sf_dir, False).select("itemid", "line")


def dataset_tfidf(spark, sf_dir):
    return _dataset(spark, sf_dir, True).select("itemid", "line")


def dataset_descriptive_bow(spark, sf_dir):
    return _dataset(spark, sf_dir, False).select("itemid", F.concat_ws(" ", "a", "line").alias("line"))


def dataset_descriptive_tfidf(spark, sf_dir):
    return _dataset(spark, sf_dir, True).select("itemid", F.concat_ws(" ", "a", "line").alias("line"))


def dataset_stats(spark, sf_dir):
    """Features of a case: descriptive ones and those of its bag of words."""
    return ods.dataset_stats(_dataset(spark, sf_dir, False).select((F.col("n") + F.col("m")).alias("n")))


_C, _E = pc._C, pc._E
_SP = pc._STRIP
_TITLE = r"array_to_string(list_transform(regexp_extract_all(lower({0}), '\pL+|[^\pL]+'), lambda p: upper(p[1]) || p[2:]), '')"
_PARTY = _C + rf""", n as (select itemid, regexp_replace(docname, '^CASE OF ', '') d from c),
  p as (select distinct itemid, {_SP.format('x')} as name from (select itemid, unnest(string_split(case when ends_with(d, ')') then string_split(d, '(')[1] else d end, ' v. ')) x from n)),
  dim as (select row_number() over (order by name) id, name from (select distinct name from p where name <> ''))"""
_REP = _C + f""", p as (select distinct itemid, {_TITLE.format('x')} as name from (select itemid, trim(unnest(string_split(representedby, ';'))) x from c) where x <> 'N/A' and x <> ''),
  dim as (select row_number() over (order by name) id, name from (select distinct name from p))"""
_SCLS = f"""with p as (select distinct itemid, {_TITLE.format('name')} as name from scl where itemid is not null and name is not null),
  dim as (select row_number() over (order by name) id, name from (select distinct name from p))"""
_CON = """with r as (select itemid, unnest(c) from (select itemid, unnest(conclusions) c from case_judgment where itemid is not null)),
  dim as (select row_number() over (order by element, type, article nulls first, base_article nulls first) id, * from (select distinct element, type, article, base_article from r where element is not null))"""
_ON = " and ".join(f"r.{c} is not distinct from dim.{c}" for c in ("element", "type", "article", "base_article"))
_SPLIT = "case when coalesce({0}, '') = '' then [] else string_split({0}, ';') end"
_TRIMMED = "list_transform(case when coalesce({0}, '') = '' or " + _SP.format("{0}") + " = '' then [] else string_split({0}, ';') end, lambda v: " + _SP.format("v") + ")"
_FORMAT = _C + ", co as (select respondent a3, min(trim(string_split(docname, ' v. ')[2])) country from leading_case group by 1), bo(ob, bt, bn) as (values " + ", ".join(
    f"('{k}', '{t}', '{n}')" for k, (t, n) in lookups.BODIES.items()) + rf"""),
  fu as (select c.*, co.country, bt originatingbody_type, bn originatingbody_name, regexp_replace(docname, '^CASE OF ', '') dn from c
    left join co on a3 = string_split(respondent, ';')[1] left join bo on ob = originatingbody
    where languageisocode = 'ENG' and doctype = 'HEJUD' and (contains(conclusion, 'Violation') or contains(conclusion, 'violation'))),
  fm as (select fu.* replace ({_TRIMMED.format('externalsources')} as externalsources, {_TRIMMED.format('documentcollectionid')} as documentcollectionid,
      {_TRIMMED.format('issue')} as issue, {_TRIMMED.format('representedby')} as representedby,
      list_transform(string_split(extractedappno, ';'), lambda v: {_SP.format('v')}) as extractedappno, string_split(kpthesaurus, ';') as kpthesaurus,
      case when coalesce({_SP.format('scl')}, '') = '' then [] else string_split(scl, ';') end as scl,
      list_sort(list_distinct(list_transform(string_split(lower(article), ';'), lambda x: {pc._BASE.format('x')}))) as article),
    list_transform(string_split(case when ends_with(dn, ')') then string_split(dn, '(')[1] else dn end, ' v. '), lambda v: {_SP.format('v')}) parties,
    list_sort(list_distinct(regexp_split_to_array(article, '[;+]'))) paragraphs, conclusion __conclusion, article __articles from fu)"""
_DATE = "replace(string_split(string_split({0}, ' ')[1], 'T')[1], '-', '/') {0}"
_ENC = _E + _FORMAT[len(_C):] + """,
  er as (select itemid, 'article=' || unnest(article) col, 1 v from fm union all select itemid, 'documentcollectionid=' || unnest(documentcollectionid), 1 from fm
    union all select itemid, 'paragraphs=' || unnest(paragraphs), 1 from fm union all select itemid, 'applicability=' || unnest(string_split(trim(applicability), ';')), 1 from fm
    union all select itemid, 'ccl_article=' || article, arg_max(case when type = 'violation' then 1 else -1 end, pos) from e where article is not null group by itemid, article)"""
# Variables by index, written by themselves: respondent stands at 1 and 11 and has the second place.
_VALUES = _FORMAT + """, v as (""" + " union all ".join(f"select itemid, '{n}' variable, {k} ord, {n}::varchar as value from fm where {n} is not null" for n, k in (
    ("itemid", 0), ("rank", 2), ("applicability", 3), ("decisiondate", 4), ("doctypebranch", 5), ("importance", 6), ("introductiondate", 7), ("judgementdate", 8),
    ("originatingbody_type", 9), ("originatingbody_name", 10), ("respondent", 11), ("separateopinion", 12), ("typedescription", 13))) + " union all " + " union all ".join(
    f"select itemid, '{n}', {k}, unnest({n}) from fm" for n, k in (("article", 14), ("documentcollectionid", 15), ("externalsources", 16), ("extractedappno", 17),
    ("kpthesaurus", 18), ("parties", 19), ("scl", 20), ("representedby", 21))) + """),
  f as (select variable, value, row_number() over (order by ord, value) - 1 feature_id, ord from (select distinct variable, ord, value from v where value is not null)),
  l0 as (select itemid, string_agg(ord || ':' || feature_id, ' ' order by ord, feature_id) line, count(*) n from v join f using (variable, ord, value) group by itemid)"""
_OUT = _E + """, o as (select base_article, row_number() over (order by min({'c': itemid, 'p': pos, 'a': k2}), base_article) outcome_id
    from (select *, 0 k2 from e) where type <> 'other' and base_article is not null group by base_article)"""


_OKB = """, okb as (select itemid from (select itemid, base_article, count(distinct type) n from e where type <> 'other' and base_article is not null group by all) group by itemid having max(n) = 1)"""
_BOTH = _OUT + _OKB + _VALUES[len(_C):] + ", l as (select * from l0 where itemid in (select itemid from okb))"
_DOC = _BOTH + ", " + pt._VOC[len("with "):] + """, fd as (select itemid, min(doc_id) doc_id from documents where text is not null and itemid is not null group by itemid), sh as (select count(*) k from f)"""
_BAG = _DOC + """, ln as (select fd.itemid, string_agg((token_id + (select k from sh)) || ':' || tf, ' ' order by token_id) line, count(*) m from b join fd using (doc_id) group by fd.itemid)"""
_WEIGHT = _DOC + """, q as (select token_id, count(*) df from b group by token_id), r1 as (select doc_id, token_id, tf * log2((select count(*) from d) / df::double) w from b join q using (token_id)),
  k1 as (select doc_id, token_id, printf('%.6f', w / sqrt(sum(w * w) over (partition by doc_id))) tf from r1 where abs(w) > 1e-12),
  ln as (select fd.itemid, string_agg((token_id + (select k from sh)) || ':' || tf, ' ' order by token_id) line, count(*) m from k1 join fd using (doc_id) group by fd.itemid)"""


def _note(column: str) -> str:
    return _CON + f", n as (select row_number() over (order by name) id, name from (select distinct unnest({column}) as name from r))"


ORACLES = {
    "dim_party": _PARTY + " select id, name from dim",
    "bridge_party": _PARTY + " select id, itemid from p join dim using (name)",
    "dim_representative": _REP + " select id, name from dim",
    "bridge_representative": _REP + " select id, itemid from p join dim using (name)",
    "dim_scl": _SCLS + " select id, name from dim",
    "bridge_scl": _SCLS + " select id, itemid from p join dim using (name)",
    "dim_member": f"""select row_number() over (order by name, role) id, name, role from (select distinct name, coalesce({_TITLE.format('role')}, '') as role
        from decisionbodymember where name is not null)""",
    "dim_conclusion": _CON + " select id, element, type, article, base_article from dim",
    "bridge_conclusion": _CON + f" select distinct id, itemid from r join dim on {_ON}",
    "dim_detail": _note("details") + " select id, name from n where name is not null",
    "bridge_detail": _note("details") + f" select distinct d.id, n.id note_id from (select dim.id, unnest(details) x from r join dim on {_ON}) d join n on n.name = d.x",
    "dim_mention": _note("mentions") + " select id, name from n where name is not null",
    "bridge_mention": _note("mentions") + f" select distinct d.id, n.id note_id from (select dim.id, unnest(mentions) x from r join dim on {_ON}) d join n on n.name = d.x",
    "children": _C + r""" select distinct child, itemid, x as name from (
        select 'article' child, itemid, unnest(regexp_split_to_array(article, '[;+]')) x from c union all select 'issue', itemid, trim(unnest(string_split(issue, ';'))) from c
        union all select 'externalsource', itemid, trim(unnest(string_split(externalsources, ';'))) from c
        union all select 'documentcollectionid', itemid, trim(unnest(string_split(documentcollectionid, ';'))) from c
        union all select 'kpthesaurus', itemid, unnest(string_split(kpthesaurus, ';')) from c
        union all select 'extractedapp', itemid, trim(unnest(string_split(extractedappno, ';'))) from c) where trim(x) <> ''""",
    "case_table": _C + " , k as (select * from c qualify ecli is null or row_number() over (partition by ecli order by itemid) = 1)"
        " select itemid, docname, doctypebranch, ecli, try_cast(importance as int) importance, appno, strftime(coalesce("
        + ", ".join(f"try_strptime(judgementdate, '{f}')" for f in pc._FMT)
        + "), '%Y-%m-%d %H:%M:%S') judgementdate, languageisocode, coalesce(upper(separateopinion) = 'TRUE', false) separateopinion,"
        " try_cast(typedescription as int) typedescription from k",
    "ecli_rejects": _C + " select itemid, ecli from c where ecli is not null qualify row_number() over (partition by ecli order by itemid) > 1",
    "cross_reference": _C + """ , k as (select distinct trim(unnest(string_split(appno, ';'))) as name from c), x as (select distinct itemid, trim(name, ' ') as name from extractedapp where name is not null and itemid is not null)
        select itemid, name, name in (select name from k where name is not null) isechr from x""",
    "incremental_load": "select distinct itemid from cases_info where itemid not in (select itemid from cases_info where fetched_at < timestamptz '2020-01-01 00:00:00+00')",
    "onehot_list": "pivot (" + _C + " select itemid, 'documentcollectionid=' || trim(unnest(string_split(documentcollectionid, ';'))) x from c where trim(documentcollectionid) <> '') on x using count(*) group by itemid",
    "onehot_scalar": "select itemid, columns(* exclude (itemid)) from (pivot (" + _C + " select itemid, coalesce('doctypebranch=' || doctypebranch, 'none') x from c) on x using count(*) group by itemid)",
    "ternary_matrix": "select itemid, coalesce(columns(* exclude (itemid)), 0) from (pivot (" + _E + " select itemid, 'ccl_article=' || article x, arg_max(case when type = 'violation' then 1 else -1 end, pos) v"
        " from e where article is not null group by itemid, article) on x using sum(v) group by itemid)",
    "encoded_cases": "with w as (pivot (" + _ENC + " select itemid, col, v from er) on col using sum(v) group by itemid), s as (" + _FORMAT + " select itemid, string_split(appno, ';')[1] appno, country, importance from fm)"
        " select s.itemid, s.appno, s.country, s.importance, coalesce(columns(w.* exclude (itemid)), 0) from s left join w on w.itemid = s.itemid",
    "formatted_case": _FORMAT + " select " + ", ".join(formatted.KEPT) + ", country, originatingbody_type, originatingbody_name, __conclusion, __articles, "
        + ", ".join(f"array_to_string({c}, '|') {c}" for c in _ARRAYS) + ", coalesce(k, 0)::int findings from fm left join (select itemid, count(*) k from (" + _E + " select * from e) group by itemid) using (itemid)",
    "flat_cases": _FORMAT + " select itemid, string_split(appno, ';')[1] appno, parties[1] parties, country, " + ", ".join(_DATE.format(d) for d in ("decisiondate", "judgementdate", "introductiondate"))
        + r""", string_split(string_split(kpdate, ' ')[1], 'T')[1] kpdate, coalesce(separateopinion = 'TRUE', false) separateopinion, doctypebranch, importance, languageisocode, originatingbody,
        originatingbody_type, originatingbody_name, rank, respondentordereng, sharepointid, typedescription, array_to_string(string_split(respondent, ';'), '|') respondent,
        array_to_string(string_split(trim(applicability), ';'), '|') applicability, case when len(issue) > 0 then array_to_string(list_sort(issue), '|') end issue,
        array_to_string(article, '|') article, array_to_string(paragraphs, '|') paragraphs, array_to_string(documentcollectionid, '|') documentcollectionid from fm""",
    "scl_matrix": _C + " select distinct appno, target from (select appno, unnest(string_split(scl, ';')) target from c where appno is not null) where target <> ''",
    "citation_map": _C + """ select appno, string_agg(target || ':1', ' ' order by target) refs from (select distinct appno, target from (
        select appno, trim(unnest(string_split(extractedappno, ';'))) target from c where appno is not null) where target <> '') group by appno""",
    "citation_matrix": _C + " select distinct appno, target from (select appno, trim(unnest(string_split(extractedappno, ';'))) target from c where appno is not null) where target <> ''",
    "representative_matrix": _C + " select distinct appno, target from (select appno, trim(unnest(string_split(representedby, ';'))) target from c where appno is not null) where target <> '' and target <> 'N/A'",
    "outcome_encode": _OUT + " select base_article, outcome_id from o",
    "feature_encode": _VALUES + " select variable, value, feature_id from f",
    # Written by itself: index 1 is nobody's, since respondent's second place wins.
    "feature_index": """select * from (values ('itemid', 0), ('rank', 2), ('applicability', 3), ('decisiondate', 4), ('doctypebranch', 5), ('importance', 6), ('introductiondate', 7),
        ('judgementdate', 8), ('originatingbody_type', 9), ('originatingbody_name', 10), ('respondent', 11), ('separateopinion', 12), ('typedescription', 13), ('article', 14),
        ('documentcollectionid', 15), ('externalsources', 16), ('extractedappno', 17), ('kpthesaurus', 18), ('parties', 19), ('scl', 20), ('representedby', 21)) t(variable, i)""",
    "outcome_lines": _BOTH + """, oc as (select itemid, string_agg(outcome_id || ':' || v, ' ' order by outcome_id) line from (select distinct itemid, outcome_id, case when type = 'violation' then 1 else 0 end v
        from e join o using (base_article) where type <> 'other' and itemid in (select itemid from okb)) group by itemid)
        select itemid, '0:' || feature_id || ' ' || line line from oc join f on f.variable = 'itemid' and f.value = oc.itemid""",
    "descriptive_lines": _BOTH + " select itemid, line from l",
    "dataset_bow": _BAG + " select itemid, ln.line from l join ln using (itemid)",
    "dataset_tfidf": _WEIGHT + " select itemid, ln.line from l join ln using (itemid)",
    "dataset_descriptive_bow": _BAG + " select itemid, l.line || ' ' || ln.line line from l join ln using (itemid)",
    "dataset_descriptive_tfidf": _WEIGHT + " select itemid, l.line || ' ' || ln.line line from l join ln using (itemid)",
    "dataset_stats": _BAG + " select count(*) dataset_size, min(n + m) min_feature, max(n + m) max_feature, coalesce(avg(n + m), 0.0) avg_feature from l join ln using (itemid)",
    "type_mapping": """select * from (values ('record_no', 'bigint'), ('itemid', 'string'), ('judgment', 'string'), ('conclusions', 'array'), ('conclusions[].element', 'string'),
        ('conclusions[].type', 'string'), ('conclusions[].article', 'string'), ('conclusions[].base_article', 'string'), ('conclusions[].details', 'array'), ('conclusions[].details[]', 'string'),
        ('conclusions[].mentions', 'array'), ('conclusions[].mentions[]', 'string')) t(path, type)""",
    "flatten_nested": r"""with t as (select record_no, t.fullkey, t.type, t.value from case_judgment c, lateral (select * from json_tree(case when json_valid(judgment) then judgment::json end)) t
        where t.type not in ('OBJECT', 'ARRAY') or t.value::varchar in ('[]', '{}'))
        select record_no, ltrim(regexp_replace(replace(fullkey[2:], '"', ''), '\[(\d+)\]', '.\1', 'g'), '.') path,
        case when type = 'NULL' then null when type = 'VARCHAR' then json_extract_string(value, '$') else value::varchar end as value from t""",
    "flatten_props": "select event_id, k as path, json_extract_string(props::json, '$.\"' || k || '\"') as value from (select event_id, props, unnest(json_keys(props::json)) k from events where json_valid(props))",
    "domain_mapping": "select distinct k as path, json_extract_string(props::json, '$.\"' || k || '\"') as value from (select props, unnest(json_keys(props::json)) k from events where json_valid(props)) where json_extract_string(props::json, '$.\"' || k || '\"') is not null",
}

QUERIES = {
    f.__name__: f
    for f in (
        dim_party, bridge_party, dim_representative, bridge_representative, dim_scl, bridge_scl, dim_member, dim_conclusion, bridge_conclusion,
        dim_detail, bridge_detail, dim_mention, bridge_mention, children, case_table, ecli_rejects, cross_reference, incremental_load, flatten_props,
        domain_mapping, schema_infer, type_mapping, onehot_list, onehot_scalar, ternary_matrix, citation_matrix, representative_matrix, outcome_encode,
        feature_encode, feature_index, outcome_lines, descriptive_lines, dataset_stats, dataset_bow, dataset_tfidf,
        dataset_descriptive_bow, dataset_descriptive_tfidf, formatted_case, flat_cases, encoded_cases, flatten_nested, scl_matrix, citation_map,
    )
}
