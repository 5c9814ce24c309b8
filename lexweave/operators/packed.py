"""Problem 3: several values packed in one field, one row per value with its position.

A value is cut into tokens: each delimiter or quotation mark is a token of its
own, a run of other characters is one. Masking the ordinary tokens leaves the
value's delimiter skeleton (``a;"a, a";a``). What to cut where depends on the
skeleton alone, so it is resolved once per distinct skeleton, and each value
then takes its items by token position. Values without any delimiter or quote
skip all of this.

Scale: skeletons are pre-aggregated before they meet; the table of rules is
broadcast only where its counted size is under ``broadcast_rules`` rows, and
joined by shuffle (AQE splits a hot skeleton) beyond it.

Defined results: null, empty and blank values, and items that are empty, give
no row and no position. An opening mark that is never closed before a
delimiter is ordinary text. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: Opening marks with the marks that close them.
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“”"}
_MARKS = "".join(QUOTES) + "".join(QUOTES.values())
_BLANK, _PLAIN, _WORD = "_", "a", "&"


@dataclass(frozen=True)
class Packing:
    """What separates the values of one field."""

    separators: str
    words: tuple[str, ...] = ()  # words that separate, as "and" between state codes

    @property
    def alphabet(self) -> str:
        return "".join(dict.fromkeys(self.separators + _MARKS))


#: The four packed fields of cases_info.
FIELDS = {
    "kpthesaurus": Packing(";,| \t\r\n"),
    "scl": Packing(";|\t\r\n"),
    "respondent": Packing(";,|/&+ \t\r\n", ("and", "et", "und")),
    "applicability": Packing(";,|/\t\r\n"),
}


def resolve(skeleton: str, separators: str) -> list[tuple[int, int, bool]]:
    """The items of a skeleton: (first token, number of tokens, whether doubled marks are to be undone).

    The k-th character of a skeleton stands for the k-th token of the value.
    """
    blanks = {c for c in " \t\r\n " if c not in separators} | {_BLANK}
    breaks = set(separators) | {_WORD}
    n, at, items = len(skeleton), 0, []

    def ends(k: int) -> bool:
        while k < n and skeleton[k] in blanks:
            k += 1
        return k >= n or skeleton[k] in breaks

    def closing(k: int) -> int | None:
        """The mark that closes the one at k, if after it the item ends."""
        opener, depth, i, fallback = skeleton[k], 1, k + 1, None
        closers = QUOTES[opener]
        while i < n:
            c = skeleton[i]
            if c in closers:
                if c == opener and i + 1 < n and skeleton[i + 1] == c:
                    i += 2
                    continue
                depth -= 1
                if ends(i + 1):
                    if depth <= 0 or c == opener:
                        return i
                    fallback = i if fallback is None else fallback
            elif c == opener:
                depth += 1
            i += 1
        return fallback

    while at < n:
        if skeleton[at] in blanks or skeleton[at] in breaks:
            at += 1
            continue
        if skeleton[at] in QUOTES and (end := closing(at)) is not None:
            items.append((at + 1, end - at - 1, skeleton[at] in QUOTES[skeleton[at]]))
            at = end + 1
            continue
        start = at
        while at < n and skeleton[at] not in breaks:
            at += 1
        items.append((start, at - start, False))
    return items


_RULE = "array<struct<first:int,size:int,doubled:boolean>>"


def _rules(batches: Iterator[pd.DataFrame], packings: dict[str, Packing]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["rule"] = [
            [{"first": a, "size": b, "doubled": c} for a, b, c in resolve(s, packings[f].separators)]
            for f, s in zip(batch["field"], batch["skeleton"])
        ]
        yield batch[["field", "skeleton", "rule"]]


def _escape(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


def _tokens(value: Column, packing: Packing) -> Column:
    cls = _escape(packing.alphabet)
    words = "".join(rf"|(?<![\p{{L}}\p{{N}}]){w}(?![\p{{L}}\p{{N}}])" for w in packing.words)
    if packing.words:
        stop = "|".join(packing.words)
        plain = rf"(?:(?!(?<![\p{{L}}\p{{N}}])(?:{stop})(?![\p{{L}}\p{{N}}]))[^{cls}])+"
    else:
        plain = rf"[^{cls}]+"
    return F.regexp_extract_all(value, F.lit(rf"(?i)[{cls}]{words}|{plain}"), F.lit(0))


def _mask(token: Column, packing: Packing) -> Column:
    special = F.lit(packing.alphabet)
    mark = F.when((F.length(token) == 1) & (F.instr(special, token) > 0), token)
    if packing.words:
        mark = mark.when(F.lower(token).isin(*packing.words), _WORD)
    return mark.when(token.rlike(r"^[\s\x{a0}]*$"), _BLANK).otherwise(_PLAIN)


def _masker(packing: Packing) -> Callable[[Column], Column]:
    return lambda token: _mask(token, packing)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")


def split_packed(
    df: DataFrame,
    key: str = "record_id",
    fields: dict[str, Packing] | None = None,
    broadcast_rules: int = 50_000,
) -> DataFrame:
    """(key, field, pos, item): one row per value of each field of each row, pos from 1."""
    fields = FIELDS if fields is None else fields
    spark = df.sparkSession

    def entry(name: str, packing: Packing) -> Column:
        value = F.col(name).cast("string")
        tokens = _tokens(value, packing)
        return F.struct(F.lit(name).alias("field"), value.alias("value"), tokens.alias("tokens"))

    long = (
        df.select(F.col(key), F.explode(F.array(*[entry(n, p) for n, p in fields.items()])).alias("e"))
        .select(key, "e.*")
        .where(F.col("value").isNotNull() & (_strip(F.col("value")) != ""))
    )
    masked = F.lit(None).cast("string")
    for name, packing in fields.items():
        skeleton = F.array_join(F.transform("tokens", _masker(packing)), "")
        masked = F.when(F.col("field") == name, skeleton).otherwise(masked)
    long = long.withColumn("skeleton", masked)
    alone = F.col("skeleton").rlike(rf"^{_BLANK}?{_PLAIN}{_BLANK}?$")

    distinct = long.where(~alone).select("field", "skeleton").distinct()
    rules = durable(
        distinct.mapInPandas(lambda b: _rules(b, fields), f"field string, skeleton string, rule {_RULE}")
    )
    if rules.count() <= broadcast_rules:
        rules = F.broadcast(rules)
    else:
        rules = rules.hint("shuffle_hash")
    packed = long.where(~alone).join(rules, ["field", "skeleton"])

    def item(rule: Column) -> Column:
        text = F.array_join(F.slice(F.col("tokens"), rule["first"] + 1, rule["size"]), "")
        return _strip(F.when(rule["doubled"], F.replace(text, F.lit('""'), F.lit('"'))).otherwise(text))

    many = F.filter(F.transform("rule", item), lambda x: x != "")
    out = packed.select(key, "field", many.alias("items")).unionByName(
        long.where(alone).select(key, "field", F.array(_strip(F.col("value"))).alias("items"))
    )
    return out.select(key, "field", F.posexplode("items").alias("pos", "item")).withColumn("pos", F.col("pos") + 1)
