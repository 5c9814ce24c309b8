"""Problem 2: linking the spellings of names that mean one person or organisation.

1. Reading. A name is cut into tokens: titles and professions go, order and
   case don't matter; a person has a family name, given names or initials, an
   organisation (told by words of trade or legal form) a core, a trade and a
   form, with abbreviations undone. Equal readings are pre-aggregated to one
   profile, so many rows of one spelling are one node.
   Which of two words is the family name is told by the nickname table, else by
   how often each stands as family or given name in names that leave no doubt
   (``Family, Given`` and initials), counted over all names.
2. Blocking. Family names and cores (their sorted tokens) are blocked by what is
   left of their letters without as many as slips are allowed, so that any two
   that are alike have a block in common. Inside a block they are compared by
   Jaro-Winkler and edit distance.
3. Heads. A spelling that may be a slip of a more frequent one has the nearest
   such head; whether a spelling is a head hangs on the more frequent ones only
   and is settled in rounds of joins, so no family is gathered anywhere.
4. Deciding. Among profiles of one head, given names are compared by Jaro-Winkler, edit
   distance and the nickname table. A full given name decides; an initial, a
   nickname of two names or a missing country goes to the one person it fits,
   and to nobody if it fits several.
5. Clusters are the connected components of the accepted pairs.

Scale: only distinct family names are compared and only inside blocks. What is
decided together is the distinct profiles of one head and one class of initials
(persons) or one trade (organisations), as no pair is accepted across these;
this holds at every size. Components run as joins.

Defined results: null, blank, ``-``, ``N/A`` and names without a word mean
nobody and are linked to nothing. Repeated rows are linked to one another.
Unknown words are compared as typed. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable, spread
from .bktree import distance
from .components import components

# Given names with their short and pet forms.
NICKNAMES = {
    "alexander": "alex sasha", "alma": "", "andrew": "andy drew", "anthony": "tony", "anton": "", "barbara": "barb basia",
    "benjamin": "ben", "bohdan": "", "catherine": "cathy kate katya", "charles": "charlie chuck", "christopher": "chris",
    "clara": "", "daniel": "dan danny", "deborah": "debbie deb", "desmond": "des", "dmitri": "dima mitya", "edward": "ed ted eddie",
    "elena": "lena", "elizabeth": "liz beth lizzie betty", "emil": "", "eugenia": "zhenya", "fatima": "fatma",
    "francesca": "fran", "frederick": "fred freddie", "gabriel": "gabe", "gregory": "greg", "gudrun": "", "hasan": "",
    "helena": "lena", "henrik": "henk", "hugo": "", "ilse": "", "irena": "", "isabella": "bella", "ivan": "vanya",
    "jacob": "jake", "johannes": "hannes jan", "josef": "", "joseph": "joe sepp", "karl": "", "katarina": "kata katya kate",
    "konstantin": "kostya", "lawrence": "larry", "leonard": "leo len", "lucas": "", "margaret": "maggie peggy", "maria": "",
    "maximilian": "max", "michael": "mike misha", "natalia": "natasha", "nicholas": "nick niko", "olga": "olya",
    "oliver": "ollie", "patricia": "pat trish", "pavel": "", "peter": "pete petya", "quentin": "", "rebecca": "becky",
    "robert": "bob rob", "roman": "roma", "rosa": "", "rudolf": "rudi", "samuel": "sam", "sergei": "seryozha", "sofia": "",
    "stefania": "stefa", "tatiana": "tanya", "theodore": "ted theo", "thomas": "tom", "ulrich": "uli", "ursula": "ursel",
    "vera": "", "victoria": "vicky", "viktor": "", "vladimir": "vova volodya", "wilhelmina": "mina", "william": "will bill",
    "xenia": "", "yaroslav": "slava", "yusuf": "", "zoltan": "zoli", "zuzana": "zuzka",
}
# Words that belong to no name.
TITLES = {"mr", "mrs", "ms", "miss", "dr", "prof", "me", "maitre", "sir", "herr", "frau", "mme", "mlle"}
PROFESSIONS = {"lawyer", "barrister", "advocate", "avocat", "avocate", "rechtsanwalt", "rechtsanwaltin", "solicitor", "attorney"}
# Words of trade, each with its short forms, and legal forms with theirs.
TRADES = {
    "international": "intl int'l", "trade": "", "press": "", "media": "", "farmers": "", "growers": "",
    "manufacturing": "mfg manuf", "publishing": "publ", "railway": "rlwy railwaymen railways", "workers": "", "savings": "sav",
    "bank": "bk", "telecommunications": "telecom telecomms", "construction": "constr", "brothers": "bros", "shipping": "",
}
FORMS = {
    "ltd": "limited", "inc": "incorporated", "gmbh": "g.m.b.h", "sa": "s.a", "bv": "b.v", "union": "un",
    "foundation": "fdn found", "association": "assn ass'n assoc", "llc": "l.l.c", "plc": "p.l.c", "ag": "a.g",
}
_FILLERS = {"the", "and", "house", "of", "&"}
#: Letters above which a name is blocked by its parts.
LONG = 21

_FULL: dict[str, frozenset[str]] = {}
for _name, _short in NICKNAMES.items():
    for _form in [_name, *_short.split()]:
        _FULL[_form] = _FULL.get(_form, frozenset()) | {_name}
# Initials that one pet form may stand for are one class, named after its first letter.
_CLASS_OF = {c: c for c in "abcdefghijklmnopqrstuvwxyz"}
for _names in _FULL.values():
    _initials = {_CLASS_OF[n[0]] for n in _names}
    _CLASS_OF = {c: min(_initials) if k in _initials else k for c, k in _CLASS_OF.items()}
_TRADE = {form: word for word, short in TRADES.items() for form in [word, *short.replace("'", "").split()]}
_FORM = {re.sub(r"[.']", "", form): word for word, short in FORMS.items() for form in [word, *short.split()]}


def fold(text: str) -> str:
    text = text.translate(str.maketrans({"ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ı": "i", "ß": "ss"}))
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).lower().replace("’", "'")


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    moved = sum(x != y for x, y in zip(left, right)) / 2
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def slips(a: str, b: str) -> int:
    """Edit distance in which two neighbours that changed places count once."""
    if a == b:
        return 0
    before, last = None, list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = [i]
        for j, d in enumerate(b, 1):
            best = min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d))
            if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == d:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


def _umlaut(word: str) -> str:
    return re.sub(r"([aou])e", r"\1", word)


@lru_cache(maxsize=200_000)
def alike(a: str, b: str) -> bool:
    """Whether two family names or cores may be one, typed differently."""
    if a == b:
        return True
    short = min(len(a), len(b))
    if short < 4 or abs(len(a) - len(b)) > 3:
        return False
    allowed = _allowed(short)
    for x, y in {(a, b), (_umlaut(a), _umlaut(b))}:
        n = slips(x, y)
        if n <= allowed and jaro_winkler(x, y) >= (0.72 if n == 1 and short > 5 else 0.86):
            return True
    return False


@lru_cache(maxsize=100_000)
def given_of(word: str) -> frozenset[str]:
    """The full names that a given name, nickname or slip of one stands for; itself where unknown."""
    if word in _FULL:
        return _FULL[word]
    if len(word) >= 4:
        near = []
        for form, names in _FULL.items():
            if len(form) < 3 or abs(len(form) - len(word)) > 2:
                continue
            d = slips(word, form)
            if d <= (1 if len(form) < 6 else 2) and jaro_winkler(word, form) >= 0.8:
                near.append((d, -len(form), names))
        if near:
            return min(near, key=lambda x: x[:2])[2]
    return frozenset([word])


@lru_cache(maxsize=100_000)
def _vocabulary_word(word: str) -> tuple[str, str] | None:
    """('trade' or 'form', word) of a word of an organisation's name."""
    bare = word.replace(".", "").replace("'", "")
    if bare in _TRADE:
        return "trade", _TRADE[bare]
    if bare in _FORM:
        return "form", _FORM[bare]
    if len(bare) >= 5:
        for kind, table in (("trade", _TRADE), ("form", _FORM)):
            near = [w for w in table if len(w) >= 5 and abs(len(w) - len(bare)) <= 2 and slips(bare, w) <= (1 if len(w) < 8 else 2)]
            if near:
                return kind, table[min(near, key=lambda w: slips(bare, w))]
    return None


def read(name: str | None, roles: dict[str, tuple[int, int]] | None = None) -> tuple[str, str, str, str, str] | None:
    """(kind, family, given, middle, trade) of a name; None where it names nobody.

    ``roles`` tells of words how often they stand as family and as given name elsewhere.

    For an organisation family is the core, given the legal form and trade its
    trade. A person's given is a full name (with other readings after ``|``)
    or one letter; middle is the letters after it.
    """
    text = fold(name or "").strip()
    if len(re.findall(r"[^\W\d_]", text)) < 3 or text in ("n/a", "none", "null", "unknown", "anonymous"):
        return None
    text = re.sub(r'["“”«»„]', " ", text)
    joined = re.sub(r"\b(g\.?\s?m\.?\s?b\.?\s?h|s\.\s?a|b\.\s?v|p\.l\.c|l\.l\.c)\b\.?", lambda m: re.sub(r"[.\s]", "", m[0]), text)
    words = re.findall(r"[^\W\d_]+(?:['.][^\W\d_]+)*|&", joined)
    kinds = [_vocabulary_word(w) if len(w) > 1 else None for w in words]
    traded, formed = (any(k and k[0] == kind for k in kinds) for kind in ("trade", "form"))
    if (traded or formed and len(words) <= 3) and not (words and words[0] in TITLES):
        core = [w for w, k in zip(words, kinds) if not k and w not in _FILLERS]
        if core:
            trade = " ".join(sorted({k[1] for k in kinds if k and k[0] == "trade"}))
            form = next((k[1] for k in kinds if k and k[0] == "form"), "")
            return "org", " ".join(sorted(core)), form, "", trade
    first, comma, rest = text.partition(",")
    tail = re.findall(r"[^\W\d_]+", text.rpartition(",")[2]) if comma else []
    if tail and all(w in PROFESSIONS for w in tail):
        text = text.rpartition(",")[0]
        first, comma, rest = text.partition(",")
    tokens = re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", text)
    while len(tokens) > 1 and tokens[0] in TITLES:
        tokens.pop(0)
    tokens = [t for t in tokens if t not in PROFESSIONS] or tokens
    long = [t for t in tokens if len(t) > 1]
    if not long:
        return None
    known = [t for t in long if given_of(t) != frozenset([t])  or t in _FULL]
    if comma and (lead := [t for t in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", first) if t not in TITLES and len(t) > 1]):
        family = [t for t in lead if t not in known] or lead
    elif len(long) == 1:
        family = long
    else:
        family = [t for t in long if t not in known]
        if not family or len(family) == len(long):
            family = _by_roles(long, roles or {})
        if not family:
            # Nothing helps: the word in capitals beside one that isn't, else the longest, else the last.
            capitals = [fold(w) for w in re.findall(r"[^\W\d_]{2,}", name or "") if w.isupper()]
            family = [t for t in long if t in capitals] if 0 < len(capitals) < len(long) else []
            family = family or [max(long, key=lambda t: (len(t), long.index(t)))]
    others = [t for t in tokens if t not in family]
    given = others[0] if others else ""
    if len(given) > 1:
        given = "|".join(sorted(given_of(given)))
    middle = "".join(t[0] for t in others[1:])
    return "person", " ".join(sorted(family)), given, middle[:1], ""


def _by_roles(words: list[str], roles: dict[str, tuple[int, int]]) -> list[str]:
    """Of the words of a name those that are family names elsewhere; none if that doesn't tell them apart."""
    share = {w: (f + 0.5) / (f + g + 1) for w in words for f, g in [roles.get(w, (0, 0))]}
    most, least = max(share.values()), min(share.values())
    return [w for w in words if share[w] == most] if most >= least + 0.2 else []


def evidence(name: str | None) -> tuple[list[str], list[str], list[str]]:
    """(family, given, open) words: those whose place leaves no doubt, and those of a person's name that leaves it open."""
    got = read(name)
    if got is None or got[0] == "org":
        return [], [], []
    words = [w for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", fold(name or "")) if w not in TITLES and w not in PROFESSIONS]
    long = [w for w in words if len(w) > 1]
    first, comma, rest = fold(name or "").partition(",")
    lead = [w for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", first) if w in long]
    after = [w for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", rest) if w in long]
    if comma and lead and after:
        return lead, after, []
    if len(long) == 1:
        return (long, [], []) if len(words) > 1 else ([], [], [])
    return [], [], long


def _allowed(size: int) -> int:
    """Slips that two names may be apart of which the shorter has so many letters."""
    return 0 if size < 4 else 1 if size < 7 else 2 if size < 9 else 3


def block_keys(words: str) -> set[str]:
    """Keys of which any two names that are ``alike`` have one in common.

    Of a name and of its form without umlauts, all that is left when up to as many
    letters go as it may have slips: names k slips apart have a text in common that
    lacks at most k letters of either. In a long name, three slips touch at most
    six of seven parts, so one part stands in the other name, at most three
    letters away: its keys are such parts, whose number doesn't grow with the name.
    """
    keys = {words}
    for form in {words, _umlaut(words)}:
        n, gone = len(form), _allowed(len(words))
        if n <= LONG + 3:
            for k in range(gone + 1):
                keys.update(map("".join, combinations(form, max(n - k, 0))))
        for size in range(max(LONG + 1, n - 3), n + 1):  # lengths of the shorter name
            for i in range(7):
                start, end = i * size // 7, (i + 1) * size // 7
                keys.update(f"{size}.{i}.{form[start + d : end + d]}" for d in range(-3, 4) if 0 <= start + d and end + d <= n)
    return keys


_PROFILE = "tbl string, id bigint, kind string, family string, given string, middle string, trade string, country string"


def _evidence_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([(n, *evidence(n)) for n in batch["name"]], columns=["name", "family", "given", "open"])


def _with_roles(rows: DataFrame) -> DataFrame:
    """rows with ``roles``: of the words of a name that leaves its family name open, how often each is family and given name."""
    told = durable(spread(rows.select("name").distinct()).mapInPandas(_evidence_batches, "name string, family array<string>, given array<string>, open array<string>"))
    each = [told.select(F.explode(c).alias("word"), F.lit(1 - k).alias("f"), F.lit(k).alias("g")) for k, c in enumerate(("family", "given"))]
    counts = each[0].unionByName(each[1]).groupBy("word").agg(F.sum("f").alias("f"), F.sum("g").alias("g"))
    roles = told.select("name", F.explode("open").alias("word")).join(counts.hint("merge"), "word").groupBy("name").agg(F.collect_list(F.struct("word", "f", "g")).alias("roles"))
    return rows.join(roles.hint("merge"), "name", "left")


def _read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for tbl, key, name, country, roles in zip(batch["tbl"], batch["id"], batch["name"], batch["country"], batch["roles"]):
            got = read(name, {r["word"]: (r["f"], r["g"]) for r in roles} if roles is not None else None)
            if got:
                kind, family, given, middle, trade = got
                rows.append((tbl, key, kind, family, given, middle, trade, (country or "").strip().upper()))
        yield pd.DataFrame(rows, columns=["tbl", "id", "kind", "family", "given", "middle", "trade", "country"])


def _key_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for k in range(0, len(batch), 500):
            part = batch.iloc[k : k + 500]
            yield part.assign(keys=[sorted(block_keys(f)) for f in part["family"]])


def _compare_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of alike family names in each block, with their slips."""
    for batch in batches:
        out = {}
        for tbl, kind, block in zip(batch["tbl"], batch["kind"], batch["families"]):
            for f, g in combinations(sorted(block), 2):
                if alike(f, g) and (tbl, kind, f, g) not in out:
                    out[tbl, kind, f, g] = min(slips(f, g), slips(_umlaut(f), _umlaut(g)))
        yield pd.DataFrame([(*k, d) for k, d in sorted(out.items())], columns=["tbl", "kind", "fa", "fb", "d"])


def heads(names: DataFrame, near: DataFrame) -> DataFrame:
    """(tbl, kind, family, head) of the spellings that are a slip of another.

    ``names`` (tbl, kind, family, n) counts distinct profiles, so repeated rows change
    nothing; ``near`` (tbl, kind, fa, fb, d) has the alike pairs. A spelling's head is the
    nearest of the more frequent heads that it may be a slip of; without one it is a
    head itself. What counts is how often a spelling recurs beside its head: one that
    recurs nearly as often is hardly a slip of many letters, and one that doesn't may be.
    """
    key = ["tbl", "kind"]
    at = [names.select(*key, F.col("family").alias(f), F.col("n").alias(n)) for f, n in (("fa", "na"), ("fb", "nb"))]
    pairs = near.join(at[0].hint("merge"), [*key, "fa"]).join(at[1].hint("merge"), [*key, "fb"])
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("fa") < F.col("fb")))
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    ordered = pairs.select(*key, pick("fa", "fb").alias("c"), pick("na", "nb").alias("nc"), pick("fb", "fa").alias("f"), pick("nb", "na").alias("nf"), "d")
    again = F.col("nf") - 1
    edges = durable(ordered.where(F.col("d") <= F.when(16 * again <= F.col("nc"), 3).when(2 * again <= F.col("nc"), 2).otherwise(1)))
    # Round by round: who has a head before it is none; who has only such before it is one; the others wait, their ``head`` null.
    # One table a round, and no join by way of the driver, which holds something of every table, stage and task.
    ends = edges.select(*key, F.col("c").alias("f"), F.lit(True).alias("head")).unionByName(edges.select(*key, "f", F.lit(None).cast("boolean").alias("head")))
    state = durable(ends.groupBy(*key, "f").agg(F.every(F.col("head").isNotNull()).alias("first")).select(*key, "f", F.when(F.col("first"), True).alias("head")))
    while not state.where("head is null").isEmpty():
        told = edges.join(state.withColumnRenamed("f", "c").hint("merge"), [*key, "c"]).groupBy(*key, "f").agg(
            F.max(F.coalesce("head", F.lit(False))).alias("under"), F.bool_and(F.col("head").isNotNull()).alias("all")
        )
        now = F.coalesce("head", F.when(F.col("under"), False).when(F.col("all"), True))
        state = durable(state.join(told.hint("merge"), [*key, "f"], "left").select(*key, "f", now.alias("head")))
    centres = state.where("head").select(*key, F.col("f").alias("c"))
    best = F.min(F.struct("d", (-F.col("nc")).alias("n"), "c"))
    under = edges.join(state.where("not head").select(*key, "f").hint("merge"), [*key, "f"], "left_semi").join(centres.hint("merge"), [*key, "c"], "left_semi")
    return under.groupBy(*key, "f").agg(best.alias("best")).select(*key, F.col("f").alias("family"), F.col("best.c").alias("head"))


class _Cluster:
    def __init__(self, row: tuple):
        self.pids, self.country, self.given, self.middles = [row[0]], row[5], row[2], {row[3]} - {""}

    def take(self, row: tuple) -> tuple[int, int]:
        self.pids.append(row[0])
        self.middles |= {row[3]} - {""}
        return self.pids[0], row[0]


def _organisations(rows: list[tuple]) -> list[tuple[int, int]]:
    """One core and trade: one organisation per country; a missing country goes to the only one there is."""
    pairs, clusters = [], {}
    for row in sorted((r for r in rows if r[5]), key=lambda r: r[0]):
        if row[5] in clusters:
            pairs.append(clusters[row[5]].take(row))
        else:
            clusters[row[5]] = _Cluster(row)
    lone: dict[str, _Cluster] = {}
    forms: dict[str, set[str]] = defaultdict(set)
    for row in rows:
        if row[5] and row[2]:
            forms[row[5]].add(row[2])
    for row in sorted((r for r in rows if not r[5]), key=lambda r: r[0]):
        fit = list(clusters)
        if len(fit) > 1 and row[2]:
            fit = [c for c in fit if row[2] in forms[c]]
        if len(fit) == 1:
            pairs.append(clusters[fit[0]].take(row))
        elif not clusters:
            if "" in lone:
                pairs.append(lone[""].take(row))
            else:
                lone[""] = _Cluster(row)
    return pairs


def _persons(rows: list[tuple]) -> list[tuple[int, int]]:
    pairs: list[tuple[int, int]] = []
    clusters: list[_Cluster] = []

    def fits(row: tuple, c: _Cluster) -> bool:
        """Whether a reading and a cluster with a given name may be one person."""
        mine, its = set(row[2].split("|")), set(c.given.split("|"))
        if row[5] and c.country and row[5] != c.country:
            return False
        if row[3] and c.middles and row[3] not in c.middles:
            return False
        if len(row[2]) == 1:
            return any(g.startswith(row[2]) for g in its)
        if len(c.given) == 1:
            return any(g.startswith(c.given) for g in mine)
        return bool(mine & its)

    def place(row: tuple, among: list[_Cluster], found: bool) -> None:
        near = [c for c in among if fits(row, c)]
        if len(near) > 1 and row[3]:
            near = [c for c in near if row[3] in c.middles] or near
        if len(near) == 1:
            pairs.append(near[0].take(row))
        elif not near and found:
            clusters.append(_Cluster(row))

    def rank(row: tuple) -> tuple:
        return ("|" in row[2], not row[3], row[2], row[3], -row[6], row[0])

    full = [r for r in rows if len(r[2]) > 1]
    letters = [r for r in rows if len(r[2]) == 1]
    bare = [r for r in rows if not r[2]]
    for row in sorted((r for r in full if r[5]), key=rank):  # full name and country: these make the persons
        place(row, clusters, True)
    for row in sorted((r for r in full if not r[5]), key=rank):
        place(row, clusters, True)
    for row in sorted((r for r in letters if r[5]), key=rank):
        place(row, clusters, True)
    for row in sorted((r for r in letters if not r[5]), key=rank):
        place(row, clusters, True)
    same: dict[str, _Cluster] = {}
    for row in sorted(bare, key=lambda r: r[0]):  # a family name alone: equal ones of a country
        if row[5] in same:
            pairs.append(same[row[5]].take(row))
        else:
            same[row[5]] = _Cluster(row)
    return pairs


def _decide_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple[int, int]] = []
    for (_, kind, _, _, _), part in pdf.groupby(["tbl", "kind", "head", "trade", "part"], sort=False):
        if len(part) > 1:
            rows = list(zip(part["pid"], part["family"], part["given"], part["middle"], part["trade"], part["country"], part["n"]))
            out.extend(_organisations(rows) if kind == "org" else _persons(rows))
    stars = defaultdict(list)  # a profile is in one cluster, whose pairs all have its first profile
    for a, b in out:
        stars[a].append(b)
    edges = [(min(a, *bs), x) for a, bs in stars.items() for x in (a, *bs)]
    return pd.DataFrame([e for e in edges if e[0] != e[1]], columns=["a", "b"], dtype="int64")


def _buckets(df: DataFrame, per: int = 20_000) -> int:
    return max(1, -(-df.count() // per))


def link_names(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, id, entity): the rows that name somebody, with the entity that they mean."""
    every = None
    for tbl, df in tables.items():
        part = df.select(F.lit(tbl).alias("tbl"), F.col("id").cast("bigint").alias("id"), "name", "country")
        every = part if every is None else every.unionByName(part)
    fields = ["tbl", "kind", "family", "given", "middle", "trade", "country"]
    rows = durable(_with_roles(every).mapInPandas(_read_batches, _PROFILE).withColumn("pid", F.xxhash64(*fields)))
    profiles = rows.groupBy("pid", *fields).agg(F.count("*").alias("n"))

    names = durable(profiles.groupBy("tbl", "kind", "family").agg(F.count("*").alias("n")))
    count = _buckets(rows, 2_000)
    keyed = spread(names.select("tbl", "kind", "family")).mapInPandas(_key_batches, "tbl string, kind string, family string, keys array<string>")
    hashed = keyed.select("tbl", "kind", "family", F.explode("keys").alias("key")).withColumn("key", F.xxhash64("key"))
    blocks = hashed.groupBy("tbl", "kind", "key").agg(F.sort_array(F.collect_set("family")).alias("families")).where(F.size("families") > 1)
    near = blocks.select("tbl", "kind", "families").distinct().mapInPandas(_compare_blocks, "tbl string, kind string, fa string, fb string, d int").distinct()

    placed = profiles.join(heads(names, near).hint("merge"), ["tbl", "kind", "family"], "left").withColumn("head", F.coalesce("head", "family"))
    # Accepted pairs of persons agree in the class of their initial.
    initial = F.translate(F.substring("given", 1, 1), "".join(_CLASS_OF), "".join(_CLASS_OF.values()))
    placed = placed.withColumn("part", F.when(F.col("kind") == "org", "").otherwise(initial))
    bucket = F.pmod(F.xxhash64("tbl", "kind", "head", "trade", "part"), F.lit(count)).alias("bucket")
    clusters = components(placed.groupBy(bucket).applyInPandas(_decide_bucket, "a bigint, b bigint"))
    return rows.join(clusters.withColumnRenamed("node", "pid").hint("merge"), "pid", "left").select(
        "tbl", "id", F.coalesce("component", "pid").alias("entity")
    )


def entities(linked: DataFrame) -> DataFrame:
    """(tbl, id, entity, links): every row that names somebody, its entity and how many other rows mean the same."""
    linked = durable(linked)
    sizes = linked.groupBy("tbl", "entity").agg((F.count("*") - 1).alias("links"))
    return linked.join(sizes.hint("merge"), ["tbl", "entity"]).select("tbl", "id", "entity", "links")


def name_pairs(linked: DataFrame) -> DataFrame:
    """(tbl, id_a, id_b), id_a < id_b: all pairs of rows that mean the same."""
    linked = durable(linked)
    return (
        linked.withColumnRenamed("id", "id_a")
        .join(linked.withColumnRenamed("id", "id_b").hint("merge"), ["tbl", "entity"])
        .where("id_a < id_b")
        .select("tbl", "id_a", "id_b")
    )
