"""Column functions over case metadata: parties, articles, packed lists, dates, ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` uses it inside other lambdas."""
    return F.transform(F.array(value), then).getItem(0)


def strip(text: Column) -> Column:
    """Outer white space of any kind removed."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parties(docname: Column) -> Column:
    """Parties of a case name: prefix ``CASE OF`` and a closing bracket's contents go; split at ``v.``."""
    name = F.regexp_replace(docname, "^CASE OF ", "")
    name = F.when(name.endswith(")"), F.split_part(name, F.lit("("), F.lit(1))).otherwise(name)
    return F.transform(F.split(name, r" v\. "), strip)


def split_articles(text: Column, strict: bool = False) -> Column:
    """Articles joined by ``+``: the last one, then each earlier one that the next doesn't refine.

    By default "refine" is a test of text prefix, so ``1`` goes before ``14``;
    ``strict`` asks for the same article or one of its paragraphs.
    """

    def kept(part: Column, after: Column) -> Column:
        refined = (after == part) | after.startswith(F.concat(part, F.lit("-"))) if strict else after.startswith(part)
        return F.when(~refined, part)

    def each(parts: Column) -> Column:
        head = F.slice(parts, 1, F.size(parts) - 1)
        tail = F.slice(parts, 2, F.size(parts))
        earlier = F.filter(F.zip_with(head, tail, kept), lambda x: x.isNotNull())
        both = F.concat(F.array(F.element_at(parts, -1)), earlier)
        return F.transform(both, lambda x: F.regexp_replace(x, r"^\W", ""))

    return let(F.split(text, r"\+"), each)


def base_article(article: Column) -> Column:
    """Article without paragraphs; of a protocol's article the first two parts."""
    first = F.substring_index(article, "+", 1)
    return F.when(F.contains(F.lower(first), F.lit("p")), F.substring_index(first, "-", 2)).otherwise(
        F.substring_index(first, "-", 1)
    )


def article_list(field: Column) -> Column:
    """Distinct base articles of a case's article field, sorted."""
    each = F.transform(F.split(F.lower(field), ";"), lambda x: split_articles(x))
    return F.array_sort(F.array_distinct(F.transform(F.flatten(each), base_article)))


def subarticle_list(field: Column) -> Column:
    """Distinct articles with paragraphs as written, sorted."""
    return F.array_sort(F.array_distinct(F.split(field, r"[;+]")))


def multi_value(field: Column, trimmed: bool = True, keep_empty: bool = False) -> Column:
    """A field's values between semicolons; an empty field has none, or one empty value with ``keep_empty``."""
    values = F.split(field, ";")
    values = F.transform(values, strip) if trimmed else values
    if keep_empty:
        return values
    return F.when(F.length(strip(field)) > 0, values).otherwise(F.array().cast("array<string>"))


def element_type(element: Column) -> Column:
    low = F.lower(element)
    return (
        F.when(low.startswith("violation"), "violation")
        .when(low.startswith("no-violation") | low.startswith("no violation"), "no-violation")
        .otherwise("other")
    )


def first_of(field: Column) -> Column:
    return F.split_part(field, F.lit(";"), F.lit(1))


#: Formats of case dates, tried in order.
DATE_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy'T'HH:mm:ss", "dd/MM/yyyy", "M/d/yyyy h:mm:ss a")


def case_date(text: Column) -> Column:
    """Timestamp of a case date, null where no format fits."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    return F.coalesce(*tries)


def cut_date(text: Column, dashes: bool = True) -> Column:
    """Date text without its time."""
    day = F.split_part(F.split_part(text, F.lit(" "), F.lit(1)), F.lit("T"), F.lit(1))
    return F.replace(day, F.lit("-"), F.lit("/")) if dashes else day


def valid_id(text: Column) -> Column:
    return text.rlike("^001-[0-9]{5,6}$")


def document_path(application: Column, itemid: Column) -> Column:
    return F.concat(itemid, F.when(application.startswith("MS WORD"), ".docx").otherwise(".pdf"))


def title_case(text: Column) -> Column:
    """Every letter after a non-letter in upper case, the others in lower case."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1_000_000))), "")


def is_true(text: Column) -> Column:
    return F.upper(text) == "TRUE"


def sort_mixed(values: Column) -> Column:
    """Array sorted as numbers if all are numbers, else as text."""
    numbers = F.transform(values, lambda v: v.try_cast("double"))
    by_number = F.transform(
        F.array_sort(F.transform(values, lambda v: F.struct(v.try_cast("double").alias("n"), v.alias("v")))), lambda s: s["v"]
    )
    return F.when(F.forall(numbers, lambda n: n.isNotNull()), by_number).otherwise(F.array_sort(values))


def same_set(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
