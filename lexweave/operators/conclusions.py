"""Findings: conclusion texts to elements with article, type, details and mentions.

A text is cut at closing brackets; state that runs over the pieces (which
element a stray bracket belongs to) stays inside one row as an array fold, so a
text of any length is one row's work and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cases import base_article, element_type, let, split_articles, strip

_NO_ARTICLES = "cast(array() as array<struct<article:string,base_article:string>>)"
_EMPTY = "cast(array() as array<struct<element:string,details:array<string>,mentions:array<string>>>)"


def raw_elements(ccl: Column, keep_plain: bool = False) -> Column:
    """Array of (element, details, mentions) of a conclusion text, in the order they are taken.

    The text is cut at ``)``; a piece without ``(`` is cut at ``;`` too. Of a
    piece's heads the last one is the element that its bracket details; a
    bracket without any head holds mentions of the element before. Plain heads
    before a bracketed one are dropped unless theirs is the last piece, which
    adds them at the end; ``keep_plain`` keeps all, in order.
    """
    chunks = F.filter(F.split(ccl, r"\)"), lambda c: c != "")
    pieces = F.flatten(F.transform(chunks, lambda c: F.when(c.contains("("), F.array(c)).otherwise(F.split(c, ";"))))
    pieces = F.filter(pieces, lambda p: p != "")

    def shape(p: Column) -> Column:
        heads = F.filter(F.transform(F.split(F.split_part(p, F.lit("("), F.lit(1)), ";"), strip), lambda h: h != "")
        inner = F.split_part(p, F.lit("("), F.lit(2))
        details = F.when(p.contains("(") & (inner != ""), F.split(inner, ";"))
        return F.struct(heads.alias("heads"), details.alias("details"))

    shaped = F.transform(pieces, shape)

    def plain(h: Column) -> Column:
        none = F.lit(None).cast("array<string>")
        return F.struct(h.alias("element"), none.alias("details"), none.alias("mentions"))

    def take(acc: Column, p: Column) -> Column:
        head = F.struct(
            F.element_at(p["heads"], -1).alias("element"), p["details"].alias("details"),
            F.lit(None).cast("array<string>").alias("mentions"),
        )
        before = F.transform(F.slice(p["heads"], 1, F.size(p["heads"]) - 1), plain) if keep_plain else F.expr(_EMPTY)
        last = F.element_at(acc, -1)
        noted = F.struct(
            last["element"].alias("element"), last["details"].alias("details"),
            F.concat(F.coalesce(last["mentions"], F.array().cast("array<string>")), p["details"]).alias("mentions"),
        )
        return (
            F.when(F.size(p["heads"]) > 0, F.concat(acc, before, F.array(head)))
            .when((F.size(acc) > 0) & p["details"].isNotNull(), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(noted)))
            .otherwise(acc)
        )

    def whole(shaped: Column) -> Column:
        taken = F.reduce(shaped, F.expr(_EMPTY), take)
        if keep_plain:
            return taken
        final = F.try_element_at(shaped, F.lit(-1))["heads"]
        rest = F.when(F.size(final) > 1, F.transform(F.slice(final, 1, F.size(final) - 1), plain)).otherwise(F.expr(_EMPTY))
        return F.concat(taken, rest)

    return let(shaped, whole)


def element_articles(element: Column) -> Column:
    """Array of (article, base_article) that a finding names, empty where none can be read.

    A protocol's article is ``p<protocol>-<article>``; else what follows the
    first word that begins with ``art``, of ``and``-joined ones each. Other
    elements that name a protocol's article come twice, without and with base.
    """
    none = F.expr(_NO_ARTICLES)
    other = element_type(element) == "other"

    def both(a: Column) -> Column:
        return F.struct(a.alias("article"), base_article(a).alias("base_article"))

    def of_protocol(low: Column) -> Column:
        words = F.filter(F.split(F.regexp_extract(low, r"^(.*?)protocol", 1), r"\s+"), lambda w: w != "")
        number = F.regexp_extract(low, r"protocol no\.\s*(\S+)", 1)
        name = F.when(number != "", F.concat(F.lit("p"), number, F.lit("-"), F.try_element_at(words, F.lit(-2))))
        bare = F.lit(None).cast("string").alias("base_article")
        return let(name, lambda a: F.when(a.isNotNull(), F.when(other, F.array(F.struct(a.alias("article"), bare), both(a))).otherwise(F.array(both(a)))))

    def of_convention(low: Column) -> Column:
        joined = F.regexp_replace(F.regexp_replace(low, r" and art\. ", "+"), r" and of | and ", "+")
        named = F.regexp_extract(joined, r"(?:^|\s)art(?:\.(\S+)|\S*\s+(\S+))", 0)
        plain = let(F.trim(named), lambda n: F.regexp_replace(n, r"^art(?:\.(?=\S)|\S*\s+)", ""))
        return F.when(plain != "", F.transform(split_articles(plain), both)).otherwise(none)

    return let(F.lower(element), lambda low: F.when(low.contains("protocol"), of_protocol(low)).when(~other, of_convention(low)).otherwise(none))


_FINDINGS = (
    "cast(array() as array<struct<at:int,k:int,element:string,type:string,article:string,base_article:string,"
    "details:array<string>,mentions:array<string>>>)"
)


def findings(cases: DataFrame, text: str, name: str = "findings", keep_plain: bool = False) -> DataFrame:
    """cases with an array of (at, k, element, type, article, base_article, details, mentions), one per finding and article.

    Equal findings of a row (same article and element; without article same
    element) are merged: the first one's place, the last one's details. All
    happens inside the row, nothing is shuffled.
    """
    raw = cases.withColumn("_raw", raw_elements(F.col(text), keep_plain))

    def read(e: Column, at: Column) -> Column:
        articles = F.coalesce(element_articles(e["element"]), F.expr(_NO_ARTICLES))
        return F.struct(at.alias("at"), e["element"].alias("element"), element_type(e["element"]).alias("type"), articles.alias("articles"),
                        e["details"].alias("details"), e["mentions"].alias("mentions"))

    def row(e: Column, k: Column, article: Column, base: Column) -> Column:
        return F.struct(e["at"].alias("at"), k.alias("k"), e["element"].alias("element"), e["type"].alias("type"), article.alias("article"),
                        base.alias("base_article"), e["details"].alias("details"), e["mentions"].alias("mentions"))

    def each(e: Column) -> Column:
        none = F.lit(None).cast("string")
        named = F.transform(e["articles"], lambda a, k: row(e, k, a["article"], a["base_article"]))
        return F.when(F.size(e["articles"]) > 0, named).when(e["type"] == "other", F.array(row(e, F.lit(0), none, none))).otherwise(F.expr(_FINDINGS))

    def same(x: Column, r: Column) -> Column:
        return (x["element"] == r["element"]) & x["article"].eqNullSafe(r["article"]) & x["base_article"].eqNullSafe(r["base_article"])

    def later(x: Column, r: Column) -> Column:
        kept = [x[c].alias(c) for c in ("at", "k", "element", "type", "article", "base_article")]
        return F.struct(*kept, *[F.coalesce(r[c], x[c]).alias(c) for c in ("details", "mentions")])

    def merge(acc: Column, r: Column) -> Column:
        known = F.transform(acc, lambda x: F.when(same(x, r), later(x, r)).otherwise(x))
        return F.when(F.exists(acc, lambda x: same(x, r)), known).otherwise(F.concat(acc, F.array(r)))

    found = raw.withColumn("_raw", F.transform("_raw", read)).withColumn("_raw", F.flatten(F.transform("_raw", each)))
    return found.withColumn(name, F.reduce("_raw", F.expr(_FINDINGS), merge)).drop("_raw")


def conclusion_elements(cases: DataFrame, key: str, text: str, keep_plain: bool = False) -> DataFrame:
    """(key, at, k, element, type, article, base_article, details, mentions): one row per finding and article."""
    found = findings(cases.select(F.col(key), F.col(text).alias("_text")), "_text", "_found", keep_plain)
    return found.select(key, F.explode("_found").alias("f")).select(key, "f.*")
