"""Problem 5: references to records that do not exist, per table and period.

Skew-aware: references are pre-aggregated per key and period; keys that hold
more than a thousandth of all references are heavy, so there are at most a
thousand of them and their states are broadcast; the other keys meet the
states by a shuffle join. The two parts are united.

Defined results: a null, blank or unreadable name refers to nothing and gives
no row; a number that a name holds twice counts once; repeated rows give
repeated results; an empty table of records leaves every reference missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: A key is heavy from this share of all references on: at most 1 / HEAVY keys can be.
HEAVY = 0.001
_SLASH = "[/∕⁄／]"
# One number: prefix, number, slash, year, and nothing but blanks and punctuation around.
_ONE = (
    r"(?i)^[\s\p{P}\x{a0}]*(?:(?:app(?:l(?:ication)?)?s?\.?|requ[eê]tes?|req\.)\s*)?(?:(?:n[o°ºr]s?|num(?:ber|[ée]ro)?s?)[\s.°º]*)?"
    rf"[\s\p{{P}}\x{{a0}}]*0*([0-9]+)\s*{_SLASH}\s*([0-9]{{4}}|[0-9]{{2}})[\s\p{{P}}\x{{a0}}]*$"
)
_ANY = rf"(?<![0-9/.])0*([0-9]+)\s*{_SLASH}\s*([0-9]{{4}}|[0-9]{{2}})(?![0-9])(?!\s*{_SLASH})"


def _number(number: Column, year: Column) -> Column:
    return F.concat(number, F.lit("/"), F.right(year, F.lit(2)))


def one_number(name: Column) -> Column:
    """The application number that a name is, as number/two-digit year; null where it is something else."""
    number = F.regexp_extract(name, _ONE, 1)
    return F.when(number != "", _number(number, F.regexp_extract(name, _ONE, 2)))


def all_numbers(text: Column) -> Column:
    """The distinct application numbers in a text."""
    numbers = F.regexp_extract_all(text, F.lit(_ANY), F.lit(1))
    years = F.regexp_extract_all(text, F.lit(_ANY), F.lit(2))
    pairs = F.arrays_zip(numbers.alias("n"), years.alias("y"))
    return F.array_distinct(F.transform(pairs, lambda p: _number(p["n"], p["y"])))


def references(extractedapp: DataFrame, scl: DataFrame) -> DataFrame:
    """(tbl, ref_id, appno, loaded_at): one row per number that a row refers to."""
    one = extractedapp.select(
        F.lit("extractedapp").alias("tbl"), F.col("id").alias("ref_id"), one_number(F.col("name")).alias("appno"), "loaded_at"
    ).where(F.col("appno").isNotNull())
    cited = scl.select(
        F.lit("scl").alias("tbl"), F.col("id").alias("ref_id"), F.explode(all_numbers(F.col("name"))).alias("appno"), "loaded_at"
    )
    return one.unionByName(cited)


def case_states(cases: DataFrame, leading: DataFrame) -> DataFrame:
    """(appno, standing, since): whether a standing case bears the number, and its earliest fetch.

    A case stands by its row with the latest fetched_at (of equal ones the one
    that is withdrawn). Numbers of leading cases stand since ever.
    """
    bears = F.explode(all_numbers(F.col("appno")))
    gone = F.lower(F.trim("isplaceholder")) == "true"
    case = cases.groupBy("itemid").agg(
        F.max_by(F.coalesce(gone, F.lit(False)), F.struct("fetched_at", F.coalesce(gone, F.lit(False)))).alias("gone"),
        F.min("fetched_at").alias("since"),
    )
    borne = cases.where(F.col("appno").isNotNull()).select("itemid", bears.alias("appno")).distinct()
    own = borne.join(case, "itemid").groupBy("appno").agg(
        F.bool_or(~F.col("gone")).alias("standing"), F.min(F.when(~F.col("gone"), F.col("since"))).alias("since")
    )
    always = leading.select(bears.alias("appno")).distinct().select("appno", F.lit(True).alias("always"))
    # leading_case is a fixed list, but nothing bounds it here: the optimiser picks the join by its size.
    return own.join(always, "appno", "full").select(
        "appno", F.coalesce("standing", F.lit(False)).alias("standing"), "since", F.coalesce("always", F.lit(False)).alias("always")
    )


def orphans(refs: DataFrame, states: DataFrame, heavy: float = HEAVY) -> DataFrame:
    """(tbl, ref_id, appno, month, reason) of the references that no standing record met at load time."""
    month = F.date_format("loaded_at", "yyyy-MM")
    # Both are read more than once below: the patterns run once, and lineage ends here.
    refs, states = durable(refs.withColumn("month", month)), durable(states)
    counts = refs.groupBy("appno", "month").agg(F.count("*").alias("n"))
    per_key = counts.groupBy("appno").agg(F.sum("n").alias("n"))
    total = per_key.agg(F.sum("n").alias("total"))
    # At most 1 / heavy rows can pass, whatever the input: a proven bound for the broadcasts.
    hot = F.broadcast(
        per_key.crossJoin(F.broadcast(total)).where(F.col("n") > F.col("total") * heavy).select("appno", F.lit(True).alias("hot"))
    )
    marked = refs.join(hot, "appno", "left")
    hot_states = F.broadcast(states.join(hot, "appno", "left_semi"))

    reason = (
        F.when(F.col("always"), None)
        .when(F.col("standing").isNull(), "missing")
        .when(~F.col("standing"), "deleted")
        .when(F.col("since") > F.col("loaded_at"), "late")
    )
    parts = [
        marked.where("hot").join(hot_states, "appno", "left"),
        marked.where("hot is null").join(states, "appno", "left"),
    ]
    out = [p.withColumn("reason", reason).where(F.col("reason").isNotNull()) for p in parts]
    return out[0].unionByName(out[1]).select("tbl", "ref_id", "appno", "month", "reason")


def orphan_counts(found: DataFrame) -> DataFrame:
    """(tbl, month, reason, n): the orphans per table and month of loading."""
    return found.groupBy("tbl", "month", "reason").agg(F.count("*").alias("n"))
