"""Problem 6: date texts of many formats, precisions and zones to one UTC form.

All formats are one regular expression with named groups. A single
``regexp_replace`` pass lays the groups out in fixed slots, so the components
are extracted once; calendar checks and the instant are integer arithmetic.
Everything is a built-in expression: no Python runs on the executors.

Defined results: null, blank, unknown formats, dates that do not exist
(``31/02``, ``00/00/0000``), incomplete dates (``2019``), impossible times and
unknown zone letters give no row. Repeated rows give repeated results. Extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names in English, French and German, folded to lower case without accents.
MONTHS = {
    1: ["january", "jan", "janvier", "janv", "januar", "jaenner", "janner"],
    2: ["february", "feb", "fevrier", "fevr", "fev", "februar"],
    3: ["march", "mar", "mars", "marz", "maerz", "mrz"],
    4: ["april", "apr", "avril", "avr"],
    5: ["may", "mai"],
    6: ["june", "jun", "juin", "juni"],
    7: ["july", "jul", "juillet", "juil", "juli"],
    8: ["august", "aug", "aout"],
    9: ["september", "sep", "sept", "septembre"],
    10: ["october", "oct", "octobre", "oktober", "okt"],
    11: ["november", "nov", "novembre"],
    12: ["december", "dec", "decembre", "dezember", "dez"],
}
# Zone abbreviations and their offsets in minutes.
ZONES = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "UT": 0,
    "CET": 60, "WEST": 60, "BST": 60, "MEZ": 60,
    "CEST": 120, "EET": 120, "MESZ": 120,
    "EEST": 180, "MSK": 180, "TRT": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
#: Which fields write the month first when slashes separate the parts.
MONTH_FIRST = ("kpdate",)
DAY_MS = 86_400_000

_WORD = r"\p{L}+"
_DATES = [
    r"(?<y1>\d{4})[-/.](?<m1>\d{1,2})[-/.](?<d1>\d{1,2})",
    r"(?<a2>\d{1,2})/(?<b2>\d{1,2})/(?<y2>\d{4}|\d{2})",
    r"(?<d3>\d{1,2})\.(?<m3>\d{1,2})\.(?<y3>\d{4}|\d{2})",
    r"(?<y4>\d{4})(?<m4>\d{2})(?<d4>\d{2})",
    rf"(?:{_WORD}\.?,?\s+)?(?<d5>\d{{1,2}})(?:er|\.|st|nd|rd|th)?(?:\s+|-)(?<t5>{_WORD})\.?,?(?:\s+|-)(?<y5>\d{{4}}|\d{{2}})",
    rf"(?:{_WORD}\.?,\s+)?(?<t6>{_WORD})\.?\s+(?<d6>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y6>\d{{4}})",
    r"(?<d7>\d{1,2})-(?<m7>\d{1,2})-(?<y7>\d{4})",
]
_TIME = (
    r"(?:(?:T|\s+|,\s*|\s+(?:à|a|at|um)\s+)(?:(?<h1>\d{1,2})(?::|h)(?<i1>\d{2})(?:(?::|m)(?<s1>\d{2})(?:[.,](?<f1>\d+))?)?"
    r"|(?<h2>\d{2})(?<i2>\d{2})(?<s2>\d{2})(?:[.,](?<f2>\d+))?)"
    r"(?:\s*(?<p>[AaPp])\.?[Mm]\.?)?(?:\s*(?:UTC|GMT)?(?<o>[+−-]\d{2}:?\d{2}|[+−-]\d{2})|\s*(?<z>[A-Z]{1,4}))?)?"
)
PATTERN = rf"^[\s ]*(?:(?:{'|'.join(_DATES)}){_TIME}|(?<e1>-?\d{{9,10}})|(?<e2>-?\d{{11,13}}))[\s ]*$"
_SLOTS = {
    "y": ["y1", "y2", "y3", "y4", "y5", "y6", "y7"],
    "m": ["m1", "m3", "m4", "m7"],
    "t": ["t5", "t6"],
    "d": ["d1", "d3", "d4", "d5", "d6", "d7"],
    "a": ["a2"],
    "b": ["b2"],
    "h": ["h1", "h2"],
    "i": ["i1", "i2"],
    "s": ["s1", "s2"],
    "f": ["f1", "f2"],
    "p": ["p"],
    "o": ["o"],
    "z": ["z"],
    "e1": ["e1"],
    "e2": ["e2"],
}
_MARK = "\u0001"
_LAYOUT = _MARK + "|".join("".join("${%s}" % g for g in groups) for groups in _SLOTS.values())


def _lookup(pairs: dict[str, int], key: Column) -> Column:
    entries = [x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*entries), key)


def instant_ms(text: Column, month_first: Column | bool, zone: str = "Europe/Paris") -> Column:
    """Milliseconds since 1970 UTC of a date text, null where it names no full, existing date.

    A text without zone is wall time of ``zone``: a doubled hour is its first
    pass, a skipped one keeps the offset before the change.
    """
    month_first = F.lit(month_first) if isinstance(month_first, bool) else month_first

    def assemble(slots: Column) -> Column:
        def part(name: str) -> Column:
            return slots.getItem(list(_SLOTS).index(name))

        def num(name: str, kind: str = "int") -> Column:
            return F.when(part(name) != "", part(name)).try_cast(kind)

        word = F.translate(F.lower(part("t")), "éèûùôâäöü", "eeuuoaaou")
        months = {name: n for n, names in MONTHS.items() for name in names}
        short = F.length(part("y")) == 2
        year = F.when(short, num("y") + F.when(num("y") >= 50, 1900).otherwise(2000)).otherwise(num("y"))
        slashed = part("a") != ""
        month = (
            F.when(part("t") != "", _lookup(months, word))
            .when(slashed, F.when(month_first, num("a")).otherwise(num("b")))
            .otherwise(num("m"))
        )
        day = F.when(slashed, F.when(month_first, num("b")).otherwise(num("a"))).otherwise(num("d"))
        hour12 = num("h") % 12 + F.when(F.upper(part("p")) == "P", 12).otherwise(0)
        hour = F.coalesce(F.when((part("p") != "") & (num("h") <= 12), hour12).otherwise(num("h")), F.lit(0))
        minute, second = F.coalesce(num("i"), F.lit(0)), F.coalesce(num("s"), F.lit(0))
        milli = F.coalesce(F.rpad(F.substring(part("f"), 1, 3), 3, "0").try_cast("int"), F.lit(0))
        leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
        length = (
            F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
        )
        exists = (
            (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= length)
            & (hour <= 23) & (minute <= 59) & (second <= 59)
        )
        # Days since 1970 by integers: years that begin in March, 400-year eras.
        y = year - F.when(month <= 2, 1).otherwise(0)
        era = F.floor(y / 400)
        yoe = y - era * 400
        doy = F.floor((153 * (month + F.when(month > 2, -3).otherwise(9)) + 2) / 5) + day - 1
        days = era * 146_097 + yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy - 719_468
        wall = days.cast("long") * DAY_MS + ((hour * 60 + minute) * 60 + second).cast("long") * 1000 + milli
        digits = F.regexp_replace(part("o"), r"[^0-9]", "")
        sign = F.when(F.substring(part("o"), 1, 1) == "+", 1).otherwise(-1)
        minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(
            F.substring(digits, 3, 2).try_cast("int"), F.lit(0)
        )
        offset = F.when(part("o") != "", sign * minutes).when(part("z") != "", _lookup(ZONES, part("z")))
        zoned = (part("o") != "") | (part("z") != "")
        at_zone = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall), zone))
        dated = F.when(exists, F.when(zoned, wall - offset.cast("long") * 60_000).otherwise(at_zone))
        return (
            F.when(part("e1") != "", num("e1", "long") * 1000)
            .when(part("e2") != "", num("e2", "long"))
            .otherwise(dated)
        )

    laid = F.regexp_replace(text, PATTERN, _LAYOUT)
    slots = F.split(F.substring(laid, 2, 1_000), r"\|", -1)
    # transform over a one-element array binds the slots to a variable: the pattern runs once per value.
    return F.when(laid.startswith(_MARK), F.transform(F.array(slots), assemble).getItem(0))


def utc_text(ms: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSZ`` of milliseconds since 1970, whatever the session's zone."""
    rest = F.pmod(ms, F.lit(DAY_MS))
    day = F.date_from_unix_date(((ms - rest) / DAY_MS).cast("int")).cast("string")

    def two(x: Column, n: int = 2) -> Column:
        return F.lpad(F.floor(x).cast("string"), n, "0")

    hms = [two(rest / 3_600_000), F.lit(":"), two(rest / 60_000 % 60), F.lit(":"), two(rest / 1000 % 60)]
    return F.concat(day, F.lit("T"), *hms, F.lit("."), two(rest % 1000, 3), F.lit("Z"))


def normalise_timestamps(
    df: DataFrame,
    key: str = "record_id",
    fields: tuple[str, ...] = ("decisiondate", "judgementdate", "kpdate", "introductiondate"),
    month_first: tuple[str, ...] = MONTH_FIRST,
    zone: str = "Europe/Paris",
) -> DataFrame:
    """(key, field, utc): one row per value that names a full, existing date. One scan, no shuffle."""
    values = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])
    )
    long = df.select(F.col(key), values.alias("v")).select(key, "v.field", "v.text").where(F.col("text").isNotNull())
    first = reduce(lambda a, f: a | (F.col("field") == f), month_first, F.lit(False))
    return (
        long.withColumn("ms", instant_ms(F.col("text"), first, zone))
        .where(F.col("ms").isNotNull())
        .select(key, "field", utc_text(F.col("ms")).alias("utc"))
    )
