"""Queries of the general training-data operators (problems 1, 3, 5, 6) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import orphans, packed, shredding, timestamps
from ..session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    shredded = shredding.shred(table(spark, sf_dir, "case_judgment"))
    return shredding.nodes(shredded).select("record_no", "parent_path", "child_path")


def p1_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns themselves: per leaf path how many entries, values and records they hold."""
    levels = shredding.shred(table(spark, sf_dir, "case_judgment"))
    return levels.groupBy("path").agg(
        {"record_no": "count"}
    ).withColumnRenamed("count(record_no)", "n_records")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_packed(table(spark, sf_dir, "cases_info"))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = orphans.references(table(spark, sf_dir, "extractedapp"), table(spark, sf_dir, "scl"))
    states = orphans.case_states(table(spark, sf_dir, "cases_info"), table(spark, sf_dir, "leading_case"))
    return orphans.orphans(refs, states)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("tbl", "ref_id", "appno", "reason")


def p5_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_counts(_orphans(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.normalise_timestamps(table(spark, sf_dir, "cases_info"))


QUERIES = {f.__name__: f for f in (p1_found, p1_levels, p3_found, p5_found, p5_by_month, p6_found)}

_P5 = r"""
with number as (
  select itemid, x[1] || '/' || right(x[2], 2) appno from (
    select itemid, unnest(list_transform(
      regexp_extract_all(appno, '[0-9]+\s*[/∕⁄／]\s*[0-9]{2,4}'),
      lambda t: [ltrim(regexp_extract(t, '^[0-9]+'), '0'), regexp_extract(t, '[0-9]+$')])) x
    from {src} where appno is not null)
), one_case as (
  select itemid, arg_max(lower(trim(coalesce(isplaceholder, ''))) = 'true', fetched_at) gone, min(fetched_at) since
  from cases_info group by itemid
), state as (
  select appno, bool_or(not gone) standing, min(case when not gone then since end) since
  from (select distinct * from number) join one_case using (itemid) group by appno
), lead as (
  select distinct x[1] || '/' || right(x[2], 2) appno from (
    select unnest(list_transform(
      regexp_extract_all(appno, '[0-9]+\s*[/∕⁄／]\s*[0-9]{2,4}'),
      lambda t: [ltrim(regexp_extract(t, '^[0-9]+'), '0'), regexp_extract(t, '[0-9]+$')])) x
    from leading_case where appno is not null)
), ref as (
  select 'extractedapp' tbl, id ref_id, loaded_at,
    ltrim(regexp_extract(name, '([0-9]+)\s*[/∕⁄／]\s*[0-9]+[\s\pP]*$', 1), '0') || '/' ||
    right(regexp_extract(name, '[/∕⁄／]\s*([0-9]+)[\s\pP]*$', 1), 2) appno
  from extractedapp
  where regexp_matches(name, '(?i)^[\s\pP]*(n[o°º]s?[\s.°º]*)?[0-9]+\s*[/∕⁄／]\s*([0-9]{4}|[0-9]{2})[\s\pP]*$')
  union all
  select distinct 'scl', id, loaded_at, x[1] || '/' || right(x[2], 2) from (
    select id, loaded_at, unnest(list_transform(
      regexp_extract_all(name, '[0-9]+\s*[/∕⁄／]\s*(?:[0-9]{4}|[0-9]{2})\b'),
      lambda t: [ltrim(regexp_extract(t, '^[0-9]+'), '0'), regexp_extract(t, '[0-9]+$')])) x
    from scl)
), orphan as (
  select tbl, ref_id, appno, strftime(loaded_at at time zone 'UTC', '%Y-%m') as month,
    case when standing is null then 'missing' when not standing then 'deleted' when since > loaded_at then 'late' end reason
  from ref left join state using (appno) where appno not in (select appno from lead)
)
""".replace("{src}", "cases_info")

_MONTHS = [(name, n) for n, names in timestamps.MONTHS.items() for name in names]
_ZONES = ", ".join(f"('{z}', {m})" for z, m in timestamps.ZONES.items())
_P6 = r"""
with mon(word, m) as (values __MONTHS__), zone(z, off) as (values __ZONES__), raw as (
  __FIELDS__
), t as (
  select record_id, field, v, coalesce(nullif(regexp_extract(v, '\d:\d{2}(?:\.\d+)? ?([+-]\d{2}:?\d{2})$', 1), ''), nullif(regexp_extract(v, '(?:\d|\s)([A-Z]{1,4})$', 1), '')) as tail,
    regexp_extract(v, '(?:[T ]|à )(\d{1,2})[:h](\d{2})(?::(\d{2}))?(?:\.(\d+))?', ['h', 'mi', 's', 'f']) clock,
    regexp_extract(v, '^\d{8}T(\d{2})(\d{2})(\d{2})$', ['h', 'mi', 's']) packed,
    case when regexp_matches(v, '[AP]M$') then right(v, 2) end half,
    case when regexp_matches(v, '^\d{4}[-/]\d{2}[-/]\d{2}') then [v[1:4], v[6:7], v[9:10]]
         when regexp_matches(v, '^\d{1,2}/\d{1,2}/\d{4}') then
           case when field = 'kpdate' then [regexp_extract(v, '^\d+/\d+/(\d{4})', 1), regexp_extract(v, '^(\d+)/', 1), regexp_extract(v, '^\d+/(\d+)/', 1)]
                else [regexp_extract(v, '^\d+/\d+/(\d{4})', 1), regexp_extract(v, '^\d+/(\d+)/', 1), regexp_extract(v, '^(\d+)/', 1)] end
         when regexp_matches(v, '^\d{1,2}\.\d{1,2}\.(\d{4}|\d{2})$') then [string_split(v, '.')[3], string_split(v, '.')[2], string_split(v, '.')[1]]
         when regexp_matches(v, '^\d{8}(T\d{6})?$') then [v[1:4], v[5:6], v[7:8]] end nums,
    regexp_extract(v, '^(?:\pL+, )?(\d{1,2})(?:er|\.)?[ -](\pL+)\.?[ -](\d{4})', ['d', 'w', 'y']) dmy,
    regexp_extract(v, '^(\pL+) (\d{1,2}), (\d{4})$', ['w', 'd', 'y']) mdy,
    case when regexp_matches(v, '^\d{9,10}$') then v::bigint * 1000 when regexp_matches(v, '^\d{11,13}$') then v::bigint end epoch
  from raw where v <> ''
), c as (
  select t.*, coalesce(nums, case when dmy.w <> '' then [dmy.y, (select max(m)::varchar from mon where word = strip_accents(lower(dmy.w))), dmy.d]
      when mdy.w <> '' then [mdy.y, (select max(m)::varchar from mon where word = strip_accents(lower(mdy.w))), mdy.d] end) ymd,
    coalesce(nullif(packed.h, ''), nullif(clock.h, ''), '0')::int hh, coalesce(nullif(packed.mi, ''), nullif(clock.mi, ''), '0') mm,
    coalesce(nullif(packed.s, ''), nullif(clock.s, ''), '0') ss, rpad(left(clock.f, 3), 3, '0')::int ms
  from t
), w as (
  select record_id, field, epoch, case when half is null and tail is not null then tail end tail, ms,
    try_cast(lpad(case when length(ymd[1]) = 2 then case when ymd[1]::int >= 50 then '19' else '20' end || ymd[1] else ymd[1] end, 4, '0') || '-' || lpad(ymd[2], 2, '0')
      || '-' || lpad(ymd[3], 2, '0') || ' ' || lpad((case half when 'AM' then hh % 12 when 'PM' then hh % 12 + 12 else hh end)::varchar, 2, '0') || ':' || mm || ':' || lpad(ss, 2, '0') as timestamp) wall
  from c
), i as (
  select record_id, field, ms, epoch, wall,
    case when tail is null then null when regexp_matches(tail, '^[+-]') then (case when tail[1] = '-' then -1 else 1 end) * (substr(tail, 2, 2)::int * 60 + right(tail, 2)::int)
         else (select max(off) from zone where z = tail) end as off, tail,
    epoch_ms(timezone('Europe/Paris', wall)) last_pass from w
), u as (
  select record_id, field, coalesce(epoch, case
    when tail is not null then epoch_ms(wall) - off * 60000 + ms
    when timezone('Europe/Paris', make_timestamptz((last_pass - 3600000) * 1000)) = wall then last_pass - 3600000 + ms
    else last_pass + ms end) at_ms from i
)
select record_id, field, strftime(make_timestamp(at_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') utc from u where at_ms is not null
""".replace("__MONTHS__", ", ".join(f"('{w}', {n})" for w, n in _MONTHS)).replace("__ZONES__", _ZONES).replace(
    "__FIELDS__",
    " union all ".join(f"select record_id, '{f}' field, trim({f}) v from cases_info" for f in ("decisiondate", "judgementdate", "kpdate", "introductiondate")),
)



def _packed_sql(field: str, seps: str, words: str = "''") -> str:
    """Items by one pattern: a quoted item up to its separator, else a run without separators."""
    quoted = r""""(?:[^"]|"")*"|“[^”]*”|«[^»]*»"""
    pattern = rf"[ \t\r\n\x{{a0}}]*(?:{quoted})[ \t\r\n\x{{a0}}]*(?:[{seps}]|$)|[^{seps}]+"
    ends = rf"^[{seps}\s\x{{a0}}]+|[{seps}\s\x{{a0}}]+$"
    return rf"""select record_id, '{field}' field, list_filter(list_transform(list_filter(list_transform(regexp_extract_all({field}, '{pattern}'),
        lambda x: regexp_replace(x, '{ends}', '', 'g')), lambda y: lower(y) not in ({words})),
      lambda y: trim(case when length(y) > 1 and y[1] = '"' and y[-1] = '"' then replace(y[2:-2], '""', '"')
        when (y[1] = '“' and y[-1] = '”') or (y[1] = '«' and y[-1] = '»') then y[2:-2] else y end, ' ' || chr(9) || chr(160))), lambda z: z <> '') items
      from cases_info where {field} is not null"""


_P3 = "with f as (" + " union all ".join(
    [
        _packed_sql("kpthesaurus", r";,| \t\r\n"), _packed_sql("scl", r";|\t\r\n"),
        _packed_sql("respondent", r";,|/&+ \t\r\n", "'and', 'et', 'und'"), _packed_sql("applicability", r";,|/\t\r\n"),
    ]
) + ") select record_id, field, generate_subscripts(items, 1) as pos, unnest(items) item from f"

_P1 = """
with recursive un(record_no, j, k) as (
  select record_no, case when json_valid(judgment) then judgment::json end, 0 from case_judgment
  union all
  select record_no, case
      when json_type(j) = 'VARCHAR' then case when json_valid(j->>'$') then (j->>'$')::json end
      when json_type(j, '$.content') in ('OBJECT', 'ARRAY') and not json_exists(j, '$.elements') then j->'$.content'
      else json_extract(j, '$."' || json_keys(j)[1] || '"') end, k + 1
  from un where j is not null and (json_type(j) = 'VARCHAR' or json_type(j) = 'OBJECT' and (
    json_type(j, '$.content') in ('OBJECT', 'ARRAY') and not json_exists(j, '$.elements')
    or len(list_intersect(json_keys(j), ['content', 'elements', 'section_name', 'level', 'node_type', 'attributes'])) = 0 and len(json_keys(j)) > 0))
), top as (
  select record_no, case json_type(j) when 'OBJECT' then [j] when 'ARRAY' then from_json(j, '["json"]') end a from un
  qualify k = max(k) over (partition by record_no)
), node(record_no, parent_path, child_path, j) as (
  select record_no, 'judgment', 'judgment.' || i, x from (select record_no, unnest(a) x, generate_subscripts(a, 1) - 1 i from top where a is not null)
  where json_type(x) = 'OBJECT'
  union all
  select record_no, child_path, child_path || '.' || i, x from (
    select record_no, child_path, unnest(b) x, generate_subscripts(b, 1) - 1 i from (
      select record_no, child_path, case json_type(j, '$.elements') when 'OBJECT' then [j->'$.elements'] when 'ARRAY' then from_json(j->'$.elements', '["json"]') end b from node) where b is not null)
  where json_type(x) = 'OBJECT'
), con as (
  select record_no, unnest(conclusions) c, generate_subscripts(conclusions, 1) - 1 k from case_judgment
)
select record_no, parent_path, child_path from node
union all select record_no, 'conclusions', 'conclusions.' || k from con where c is not null
union all select record_no, 'conclusions.' || k, 'conclusions.' || k || '.details.' || i from (select record_no, k, unnest(c.details) x, generate_subscripts(c.details, 1) - 1 i from con) where x is not null
union all select record_no, 'conclusions.' || k, 'conclusions.' || k || '.mentions.' || i from (select record_no, k, unnest(c.mentions) x, generate_subscripts(c.mentions, 1) - 1 i from con) where x is not null
"""

ORACLES = {
    "p1_found": _P1,
    "p3_found": _P3,
    "p6_found": _P6,
    "p5_found": _P5 + "select tbl, ref_id, appno, reason from orphan where reason is not null",
    "p5_by_month": _P5
    + "select tbl, month, reason, count(*) n from orphan where reason is not null group by all",
}
