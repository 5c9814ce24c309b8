"""Queries over documents as text: tokens, n-grams, vocabularies, vectors, paragraphs, sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import documents as od
from ..operators import features as op
from ..operators import relational
from ..session import table
from ..sources import lookups

#: The reference's effective limit of tokens.
TOKENS = 5_000


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")


def _tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", fn.tokens(F.col("text")).alias("tokens"))


def token_counts(spark, sf_dir):
    return op.token_counts(_tokens(spark, sf_dir))


def document_frequency(spark, sf_dir):
    return op.document_frequency(_tokens(spark, sf_dir))


def token_clean(spark, sf_dir):
    clean = _docs(spark, sf_dir).select(fn.clean_tokens(F.col("text")).alias("tokens"))
    return op.token_counts(clean)


def ngram_sizes(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", fn.clean_tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", *[F.size(fn.ngrams(F.col("w"), n)).alias(f"n{n}") for n in (1, 2, 3, 4)])


def ngram_frequency_filter(spark, sf_dir):
    return op.ngram_counts(_docs(spark, sf_dir), 4, 60)


def frequency_correction(spark, sf_dir):
    return op.corrected_frequencies(op.ngram_counts(_docs(spark, sf_dir), 4))


def normalised_documents(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", fn.normalised(F.col("text")).alias("g"))
    return docs.select("doc_id", F.size("g").alias("n"), F.try_element_at("g", F.lit(1)).alias("first"), F.try_element_at("g", F.lit(-1)).alias("last"))


def vocab_topk(spark, sf_dir):
    return op.vocabulary(_tokens(spark, sf_dir), TOKENS)


def bow(spark, sf_dir):
    docs = _tokens(spark, sf_dir)
    return op.bag_of_words(docs, op.vocabulary(docs, TOKENS))


def tfidf(spark, sf_dir):
    docs = _tokens(spark, sf_dir)
    n = docs.agg(F.count("*").alias("n"))
    out = op.tfidf(op.bag_of_words(docs, op.vocabulary(docs, TOKENS)), n)
    return out.select("doc_id", "token_id", F.round("w", 6).alias("w"))


def bow_lines(spark, sf_dir):
    return op.vector_lines(bow(spark, sf_dir), "tf")


def _lines(spark, sf_dir):
    return od.lines(_docs(spark, sf_dir))


def paragraph_strip(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("stripped", fn.strip_number(F.col("line")))
    return lines.where("stripped <> line").select("doc_id", "pos", "stripped")


def section_tag(spark, sf_dir):
    """Sections of the lines in capitals, which stand for first-level titles."""
    return od.tag_sections(od.in_capitals(_lines(spark, sf_dir)))


def tree_parent(spark, sf_dir):
    return od.tree(od.levelled(_lines(spark, sf_dir))).select("doc_id", "pos", "level", "parent_pos")


def leaf_text(spark, sf_dir):
    nodes = od.tree(od.levelled(_lines(spark, sf_dir)))
    return od.leaf_text(nodes).select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def parser_choice(spark, sf_dir):
    """Documents whose every line is of a plain style go to the old parser."""
    lines = od.levelled(_lines(spark, sf_dir))
    style = F.when(F.col("level") == 5, "Normal").otherwise("Ju_H_Head")
    return od.parser_choice(lines.select("doc_id", style.alias("style")))


def title_strip(spark, sf_dir):
    """Numbered lines without their number."""
    lines = _lines(spark, sf_dir).withColumn("stripped", fn.strip_title_number(F.col("line")))
    return lines.where("stripped <> line").select("doc_id", "pos", "stripped")


def repeated_tokens(spark, sf_dir):
    """Each token as many times as it occurs, by size and digest of the text."""
    texts = op.repeat_tokens(op.token_counts(_tokens(spark, sf_dir)), "token", "n")
    return texts.select("token", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def sections_left_out(spark, sf_dir):
    """The text of documents without their sections on law, procedure and appendices."""
    nodes = od.tree(od.in_capitals(_lines(spark, sf_dir)))
    without = od.tag_sections(nodes).where(F.col("section").isin("law", "procedure", "appendix")).select("doc_id", "pos")
    return od.leaf_text(nodes, without=without).select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def table_to_text(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table_id"), F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q")).alias("place"),
        F.array(F.lit("line"), F.lit("part"), F.lit("quantity")).alias("header"),
        F.array(F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string")).alias("cells"),
    )
    return od.table_text(rows, "table_id").select("table_id", "text")


def judge_match(spark, sf_dir):
    lines, judges = _judge_lines(spark, sf_dir)
    return od.match_judges(lines, judges)


def judge_rejects(spark, sf_dir):
    lines, judges = _judge_lines(spark, sf_dir)
    return od.unmatched(lines, judges)


def _judge_lines(spark, sf_dir):
    members = table(spark, sf_dir, "decisionbodymember").where("name is not null")
    lines = members.select("id", fn.decision_body_line(F.concat("name", F.lit(", "), F.coalesce("role", F.lit("")))).alias("line"))
    leading = table(spark, sf_dir, "leading_case")
    name = F.regexp_replace(F.split_part("docname", F.lit(" v. "), F.lit(1)), "^CASE OF ", "")
    judges = leading.select(F.col("respondent").alias("country"), name.alias("name")).distinct()
    surnames = table(spark, sf_dir, "decisionbodymember").where("country is not null and name like '%,%'")
    more = surnames.select("country", F.trim(F.split_part("name", F.lit(","), F.lit(1))).alias("name")).distinct()
    return lines, judges.unionByName(more)


def _judge_list(spark, sf_dir):
    """A typed list of judges in the form of the published one, from the members of decision bodies."""
    members = table(spark, sf_dir, "decisionbodymember").where("name is not null and country is not null")
    place = F.concat("country", F.lpad(F.col("id").cast("string"), 12, "0"))
    second = F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat((F.col("id") % 40 + 1980).cast("string"), F.lit(" ")))
    line = F.concat((F.col("id") % 40 + 1960).cast("string"), F.lit(" - "), second, "name", F.when(F.col("id") % 5 == 0, " (President)").otherwise(""))
    heads = members.select("country").distinct().select(F.lit(1).alias("doc_id"), F.col("country").alias("pos"), F.concat("country", F.lit(" / LISTE")).alias("line"))
    return members.select(F.lit(1).alias("doc_id"), place.alias("pos"), line.alias("line")).unionByName(heads)


def judge_rows(spark, sf_dir):
    return od.judge_rows(_judge_list(spark, sf_dir))


def dim_judge(spark, sf_dir):
    """Judges by all that is known of them, numbered."""
    judges = judge_rows(spark, sf_dir).select("name", "full_name", F.col("start").try_cast("int").alias("start"), F.col("end").try_cast("int").alias("end")).distinct()
    return relational.dense_ids(judges, ["name", "full_name", "start", "end"])


def gazetteer_match(spark, sf_dir):
    """Names of countries inside documents: which line each stands in, the longest where they overlap."""
    names = lookups.countries(table(spark, sf_dir, "leading_case"))
    return od.gazetteer(_docs(spark, sf_dir), names.select(F.initcap("country").alias("entry")))


_T = r"[\pL\pN_]+|[^\pL\pN_\s\x0b]+"  # RE2 doesn't count the vertical tab as white space
_D = "with d as (select doc_id, text from documents where text is not null)"
_TOK = _D + f", tok as (select doc_id, unnest(regexp_extract_all(text, '{_T}')) token from d)"
# The stop words of the SQL, written by themselves; tokens never hold an apostrophe and letters, so the short forms are left out.
_STOP = ", ".join(f"'{w}'" for w in (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs "
    "themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t "
    "can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn").split())
_MARK = r'[,"()\\.]'
_ASCII = "translate(replace(replace(replace(replace(replace(replace({0}, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'ø', 'o'), 'þ', 'th'), 'ð', 'd'), '" + fn.ACCENTED + "', '" + fn.PLAIN + "')"
_CLEAN = _D + f""", w as (select doc_id, list_filter(list_transform(list_filter(regexp_extract_all(lower(text), '{_T}'), lambda t: t not in ({_STOP})),
  lambda t: {_ASCII.format(f"regexp_replace(t, '{_MARK}', '', 'g')")}), lambda t: length(t) >= 3) w from d)"""
_GRAM = _CLEAN + """, g as (select n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], '_'))) gram
  from w, (select unnest([1, 2, 3, 4]) n) where len(w) >= n)"""
_VOC = _TOK + f""", top as (select token, count(*) n from tok group by token order by n desc, token limit 5000),
  voc as (select *, row_number() over (order by token) - 1 token_id from top),
  b as (select doc_id, token_id, count(*) tf from tok join voc using (token) group by all)"""
_LINE = _D + r""", line as (select doc_id, unnest(a) line, generate_subscripts(a, 1) - 1 pos from (select doc_id, regexp_split_to_array(text, '\r\n|\n|\r') a from d)),
  l as (select * from line where regexp_replace(line, '^[__WS__]+|[__WS__]+$', '', 'g') <> '')""".replace("__WS__", fn.BLANK)
_LEVEL = _LINE + r""", lv as (select *, case when length(line) < 15 then 1 when length(line) < 30 then 2 when length(line) < 45 then 3 when length(line) < 60 then 4 else 5 end as level from l),
  mx as (select *, """ + ", ".join(f"max(case when level = {k} then pos end) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding) p{k}" for k in (1, 2, 3, 4)) + """ from lv),
  t as (select doc_id, pos, line, level, case level when 1 then null when 2 then p1 when 3 then greatest(p1, p2) when 4 then greatest(p1, p2, p3) else greatest(p1, p2, p3, p4) end parent_pos
    from mx where level = 1 or p1 is not null)"""
_LABEL = ", lab(section, priority, label) as (values " + ", ".join(
    f"('{s}', {k}, '{lab.upper().replace(chr(39), chr(39) * 2)}')" for k, (s, labs) in enumerate(od.SECTIONS.items()) for lab in labs) + ")"
_NUM = r"regexp_extract(line, '^(?:[\pL\pN_]+\.)([^\n]+)', 1)"
_STRIPPED = rf"case when {_NUM} <> '' then regexp_replace({_NUM}, '^[{fn.BLANK}]+|[{fn.BLANK}]+$', '', 'g') else line end"
_JUDGE = r"""with line as (select id, regexp_replace(replace(replace(replace(replace(name || ', ' || coalesce(role, ''), 'President', ''), ' Registrar', ''), 'judges', ''), ',', ''), '^\s+|\s+$', '', 'g') line
    from decisionbodymember where name is not null),
  j as (select distinct respondent country, regexp_replace(string_split(docname, ' v. ')[1], '^CASE OF ', '') as name from leading_case union
    select distinct country, trim(string_split(name, ',')[1]) from decisionbodymember where country is not null and name like '%,%'),
  lf as (select distinct id, line, F(line) form from line), jf as (select country, name, F(name) form from j where F(name) <> ''),
  hit as (select id, line, arg_min(name, {'c': country, 'n': name}) judge from lf, jf where contains(lf.form, jf.form) group by id, line)"""


def _match_sql(text: str) -> str:
    import re

    return re.sub(r"F\((\w+)\)", lambda m: f"replace(upper({_ASCII.format(f'lower({m[1]})')}), '-', ' ')", text)


ORACLES = {
    "token_counts": _TOK + " select token, count(*) n from tok group by token",
    "document_frequency": _TOK + " select token, count(distinct doc_id) df from tok group by token",
    "token_clean": _CLEAN + " select token, count(*) n from (select unnest(w) token from w) group by token",
    "ngram_sizes": _CLEAN + " select doc_id, len(w) n1, greatest(len(w) - 1, 0) n2, greatest(len(w) - 2, 0) n3, greatest(len(w) - 3, 0) n4 from w",
    "ngram_frequency_filter": _GRAM + " select n, gram, count(*) as count from g group by n, gram having count(*) >= 60",
    "normalised_documents": _CLEAN + """ select doc_id, len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) + greatest(len(w) - 3, 0) n, w[1] as first,
        nullif(array_to_string(w[greatest(len(w) - 3, 1):], '_'), '') as last from w where len(w) >= 4 or len(w) = 0
        union all select doc_id, (len(w) * (len(w) + 1)) // 2, w[1], array_to_string(w, '_') from w where len(w) between 1 and 3""",
    "vocab_topk": _VOC + " select token, n, token_id from voc",
    "bow": _VOC + " select doc_id, token_id, tf from b",
    "tfidf": _VOC + """, f as (select token_id, count(*) df from b group by token_id), r as (select doc_id, token_id, tf * log2((select count(*) from d) / df::double) w from b join f using (token_id)),
        k as (select * from r where abs(w) > 1e-12) select doc_id, token_id, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) w from k""",
    "bow_lines": _VOC + " select doc_id, string_agg(token_id || ':' || tf, ' ' order by token_id) line from b group by doc_id",
    "paragraph_strip": _LINE + f" select doc_id, pos, {_STRIPPED} stripped from l where {_STRIPPED} <> line",
    "section_tag": _LINE + _LABEL + " select doc_id, pos, arg_min(section, priority) section from l join lab on starts_with(upper(trim(line)), label) where upper(line) = line and lower(line) <> line group by doc_id, pos",
    "title_strip": _LINE + f" select doc_id, pos, {_STRIPPED} stripped from l where {_STRIPPED} <> line",
    "repeated_tokens": _TOK + ", r as (select token, rtrim(repeat(token || ' ', count(*)), ' ') t from tok group by token) select token, length(t) n_chars, md5(t) digest from r",
    "sections_left_out": _LINE + _LABEL + f""", h as (select *, upper(line) = line and lower(line) <> line top from l),
        r as (select *, max(case when top then pos end) over (partition by doc_id order by pos) root from h),
        tag as (select doc_id, pos, arg_min(section, priority) section from r join lab on top and starts_with(upper(regexp_replace(line, '^[{fn.BLANK}]+|[{fn.BLANK}]+$', '', 'g')), label) group by doc_id, pos),
        k as (select * from r where root is not null and (doc_id, root) not in (select (doc_id, pos) from tag where section in ('law', 'procedure', 'appendix'))),
        leaf as (select * from k where not top or not exists (select 1 from r u where u.doc_id = k.doc_id and u.root = k.pos and not u.top)),
        txt as (select doc_id, string_agg({_STRIPPED}, chr(10) order by pos) as text from leaf group by doc_id) select doc_id, length(text) n_chars, md5(text) digest from txt""",
    "tree_parent": _LEVEL + " select doc_id, pos, level, parent_pos from t",
    "leaf_text": _LEVEL + f""", leaf as (select * from t where not exists (select 1 from t u where u.doc_id = t.doc_id and u.parent_pos = t.pos)),
        txt as (select doc_id, string_agg({_STRIPPED}, chr(10) order by pos) as text from leaf group by doc_id) select doc_id, length(text) n_chars, md5(text) digest from txt""",
    "parser_choice": _LEVEL + " select doc_id, case when bool_and(level = 5) then 'old' else 'new' end parser from lv group by doc_id",
    "table_to_text": """select l_orderkey table_id, 'line part quantity' || chr(10) || string_agg(l_linenumber || ' ' || l_partkey || ' ' || l_quantity::int, chr(10)
        order by l_linenumber, l_partkey, l_quantity::int) || chr(10) as text from lineitem group by l_orderkey""",
    "judge_match": _match_sql(_JUDGE) + " select id, line, judge from hit",
    "judge_rejects": _match_sql(_JUDGE) + " select id, line from line where id not in (select id from hit)",
}

_LIST = r"""with m as (select * from decisionbodymember where name is not null and country is not null),
  w as (select country, id, list_filter(regexp_split_to_array((id % 40 + 1960) || ' - ' || case when id % 3 = 0 then '' else (id % 40 + 1980) || ' ' end || name
    || case when id % 5 = 0 then ' (President)' else '' end, '\s+'), lambda x: x <> '') w from m),
  n as (select *, case when regexp_full_match(w[3], '[0-9]+') then w[3] end as e, case when regexp_full_match(w[3], '[0-9]+') then w[4:] else w[3:] end names from w where len(w) > 2),
  k as (select *, array_to_string(list_filter(names, lambda x: (upper(x) = x or starts_with(x, 'Mc')) and not contains(x, '.')), ' ') idx, array_to_string(names, ' ') nm from n),
  j as (select upper(country[1]) || lower(country[2:]) country, replace(upper(idx), '-', ' ') as name, w[1] as start, e as "end",
    case when contains(nm, '(P') then string_split(nm, ' (')[1] else nm end full_name, id from k where length(idx) >= 2 and not starts_with(idx, '/')),
  l as (select country, name, arg_max({'s': start, 'e': "end", 'f': full_name}, id) x from j group by country, name)"""
ORACLES["judge_rows"] = _LIST + ' select country, name, x.s as start, x.e as "end", x.f full_name from l'
ORACLES["dim_judge"] = _LIST + """ select row_number() over (order by name, full_name, start nulls first, "end" nulls first) id, * from (
  select distinct name, x.f full_name, try_cast(x.s as int) as start, try_cast(x.e as int) as "end" from l)"""

ORACLES["gazetteer_match"] = _D + r""", e as (select distinct upper(c[1]) || lower(c[2:]) entry from (
    select min(trim(string_split(docname, ' v. ')[2])) c from leading_case group by respondent)),
  s as (select doc_id, text, entry, string_split(text, entry) a from d join e on contains(text, entry)),
  p as (select doc_id, text, entry, a, unnest(range(1, len(a))) k from s),
  q as (select doc_id, text, entry, (list_sum(list_transform(a[1:k], lambda x: length(x))) + (k - 1) * length(entry))::int as start from p)
  select doc_id, entry, start, len(regexp_split_to_array(text[1:start], '\r\n|\n|\r')) - 1 line from q"""

QUERIES = {
    f.__name__: f
    for f in (
        token_counts, document_frequency, token_clean, ngram_sizes, ngram_frequency_filter, frequency_correction, normalised_documents, vocab_topk, bow,
        tfidf, bow_lines, paragraph_strip, section_tag, tree_parent, leaf_text, parser_choice, table_to_text, title_strip, repeated_tokens, sections_left_out, judge_match, judge_rejects, gazetteer_match,
        judge_rows, dim_judge,
    )
}
