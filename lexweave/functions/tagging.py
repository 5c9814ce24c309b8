"""Word classes and base forms: a tagger that is handed in, or a table of base forms."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tagger = Callable[[list[str]], list[tuple[str, str]]]
TAGGED = "array<struct<token:string,pos:string,lemma:string>>"


def tag(tokens: Column, tagger: Tagger) -> Column:
    """Array of (token, pos, lemma) by a model of the caller's; Arrow batches, one call of the tagger per row."""

    @F.pandas_udf(TAGGED)
    def run(batch: pd.Series) -> pd.Series:
        rows = []
        for words in batch:
            words = [] if words is None else list(words)
            rows.append([{"token": w, "pos": p, "lemma": base} for w, (p, base) in zip(words, tagger(words))])
        return pd.Series(rows)

    return run(tokens)


def by_table(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", column: str = "tokens") -> DataFrame:
    """(key, at, token, pos, lemma) of the tokens that a table (token, pos, lemma) of one row per token knows; others go."""
    each = docs.select(key, F.posexplode(column).alias("at", "token"))
    return each.join(lexicon, "token").select(key, "at", "token", "pos", "lemma")


def of_classes(tagged: Column, accepted: tuple[str, ...] = ("adj", "verb", "noun", "adv"), rejected: tuple[str, ...] = ()) -> Column:
    """Base forms of the tokens of some classes and of none of others."""
    kept = F.filter(tagged, lambda t: t["pos"].isin(*accepted) & ~t["pos"].isin(*rejected) if rejected else t["pos"].isin(*accepted))
    return F.transform(kept, lambda t: t["lemma"])
