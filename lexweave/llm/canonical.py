"""Problem 4: mapping what people typed to the closest entry of a reference list.

1. Values. Equal rows, then equal texts, are one; rows get their codes by join.
2. Reading. A value names an article by number in one of many notations or by
   title, with slips. A small grammar, after slips in its cue words ("Artcile",
   "Protcol") are mended by a BK-tree over these words, brings numbers to the
   list's own form of a code; what is left is a title, as words.
3. Entries. Codes and titles (as they stand, sorted, and without small words)
   are entries of the same BK-trees under the Levenshtein distance. A code must
   be listed exactly, else its nearest listed parent is taken: its radius is 0.
   A title's words are mended by BK-trees over the words of the list, and the
   title is searched with a radius that grows with its length; the triangle
   inequality prunes, every entry within the radius is returned, the nearest wins.
4. Shards. A list of up to SHARD entries is broadcast, after a count. A larger
   one is cut into shards by length and hash: a query goes to the shards whose
   lengths are within its radius, a shard's entries are compiled to trees where
   its queries are, and the shards' winners are merged by query.

Defined results: one row per row. Null, empty and blank fields name nothing; a
row without any listed article has the code ``none``. Of several codes the one
with most levels wins; of equals the one of ``article``, then ``element``, then
``base_article``. An empty list leaves every row ``none``. Repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable, spread
from .bktree import BKTree, Shards

#: Entries of a list that one worker's trees hold, and queries that one task asks of them.
SHARD = 20_000
QUERIES = 20_000
_BAND = 8
#: Titles farther than this share of their length are another title.
NEAR = 0.28
NONE = "none"

# Words that numbers are read by.
ONES = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
        "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh",
            "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth"]
TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50}
CUES = {"article": "art", "articles": "art", "art": "art", "arts": "art", "artikel": "art", "protocol": "prot",
        "protocole": "prot", "protokoll": "prot", "prot": "prot", "paragraph": "§", "paragraphs": "§", "para": "§",
        "paras": "§", "par": "§", "paragraphe": "§", "lit": "lit", "littera": "lit", "letter": "lit"}
# How findings begin, before what they are about.
_LEAD = re.compile(
    r"^(?:(?:no[ -]+)?(?:violat\w*|breach\w*)(?:\s+found)?(?:\s+of)?\b|not\s+necessary\s+to\s+examine|no\s+separate\s+issue\s+under"
    r"|remainder\s+inadmissible\s+under|inadmissible\s+under)\s*",
    re.I,
)
# Words that a title may lose.
_SMALL = {"a", "and", "at", "by", "in", "of", "on", "the", "to", "upon"}
_ASPECT = re.compile(r"\s*\((?=[^()]*[^\W\d_]{4})[^()\d]*\)\s*$")
_TOKEN = re.compile(r"\d+|[^\W\d_]+|\S")
_ROMAN = re.compile(r"^(?=[ivxl])(?:x{0,3}|xl|l)(?:ix|iv|v?i{0,3})$")


def roman(text: str) -> int | None:
    if not text or not _ROMAN.match(text):
        return None
    values = [{"i": 1, "v": 5, "x": 10, "l": 50}[c] for c in text]
    return sum(-v if k + 1 < len(values) and values[k + 1] > v else v for k, v in enumerate(values))


def fold(text: str) -> str:
    """Lower case without accents, dashes and blanks of one kind."""
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    return re.sub(r"[‐‑‒–—−]", "-", text).replace("ß", "ss")


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text)


def _radius(word: str) -> int:
    return 0 if len(word) <= 4 else 1 if len(word) <= 6 else 2


def _radius_of(word: Column) -> Column:
    return F.when(F.length(word) <= 4, 0).when(F.length(word) <= 6, 1).otherwise(2)


_numbers = {w: k + 1 for k, w in enumerate(ONES)} | {w: k + 1 for k, w in enumerate(ORDINALS)} | TENS
_cue_tree = BKTree(sorted([*CUES, *_numbers]))


@lru_cache(maxsize=50_000)
def cue(word: str) -> str | int | None:
    """What a word of a number is, typed with slips or not: 'art', 'prot', '§', 'lit', or a number."""
    if word in CUES:
        return CUES[word]
    if word in _numbers:
        return _numbers[word]
    near = sorted(_cue_tree.within(word, _radius(word)))
    return (CUES.get(near[0][1]) or _numbers[near[0][1]]) if near else None


def _tokens(text: str) -> list[tuple[str, bool]]:
    """(token, whether it is joined to the one before) of a folded text, with l and o between digits mended."""
    text = re.sub(r"(?<![^\W_])[li|](?=\d)", "1", text)
    text = re.sub(r"(?<=\d)[li|](?![^\W_])", "1", text)
    text = re.sub(r"(?<=\d)o(?![^\W\d_])", "0", text)
    text = re.sub(r"(?<![^\W_])p[li](?=[\s.-]*\d)", "p1", text)
    out, last = [], -1
    for m in _TOKEN.finditer(text):
        out.append((m[0], m.start() == last))
        last = m.end()
    return out


class Reader:
    """Reads the numbers that a text names."""

    def __init__(self, text: str, bare: bool):
        self.t = _tokens(text)
        self.bare = bare  # a field that holds nothing but a number
        self.used: set[int] = set()

    def _number(self, k: int, plain: bool = True) -> tuple[int | None, int]:
        """A number at token k as digits, Roman numeral or word, and the token after it."""
        if k >= len(self.t):
            return None, k
        w = self.t[k][0]
        if w.isdecimal():
            return int(w), k + 1
        if plain and w.isalpha():
            value = roman(w)
            if value is not None:
                return value, k + 1
            value = cue(w)
            if isinstance(value, int):
                if value >= 20 and k + 1 < len(self.t):
                    j = k + 2 if self.t[k + 1][0] == "-" else k + 1
                    unit = cue(self.t[j][0]) if j < len(self.t) and self.t[j][0].isalpha() else None
                    if isinstance(unit, int) and unit < 10:
                        return value + unit, j + 1
                return value, k + 1
        return None, k

    def _levels(self, k: int) -> tuple[list[str], int]:
        """Paragraph and letter after an article's number."""
        levels: list[str] = []
        while len(levels) < 3:
            j, marks = k, ""
            while j < len(self.t):
                w = self.t[j][0]
                kind = w if w in "-.§(),:" else cue(w) if w.isalpha() and len(w) > 1 else None
                if kind in ("§", "lit") or (isinstance(kind, str) and kind in "-.§()"):
                    marks += kind[0]
                    j += 1
                else:
                    break
            if j >= len(self.t):
                break
            w = self.t[j][0]
            if w.isdecimal() and marks and marks[-1] != ")":
                levels.append(str(int(w)))
            elif w.isalpha() and len(w) == 1 and (marks or self.t[j][1] or (j + 1 < len(self.t) and self.t[j + 1][0] == ")")):
                after = self.t[j + 1] if j + 1 < len(self.t) else None
                if after is not None and (after[0].isalpha() or after[0].isdecimal()) and after[0] not in ("of",) and not after[1]:
                    # a word follows: the letter was a word itself, unless it was marked as a letter
                    if not marks.endswith(("l", "(")):
                        break
                levels.append(w)
                if j + 1 < len(self.t) and self.t[j + 1][0] == ")":
                    j += 1
                return levels, j + 1
            else:
                break
            k = j + 1
            if k < len(self.t) and self.t[k][0] == ")":
                k += 1
        return levels, k

    def codes(self) -> list[str]:
        """The codes named, in order."""
        arts: list[tuple[int, int, list[str]]] = []  # (place, number, levels)
        prots: list[tuple[int, int]] = []
        out: list[tuple[int, str]] = []
        k = 0
        while k < len(self.t):
            w, joined = self.t[k]
            kind = cue(w) if w.isalpha() and len(w) > 1 else None
            start = k
            if w == "p" and k + 1 < len(self.t) and self.t[k + 1][0].isdecimal() and self.t[k + 1][1]:
                j = k + 2
                while j < len(self.t) and self.t[j][0] in "-.":
                    j += 1
                if j > k + 2:
                    number, j2 = self._number(j, plain=False)
                    if number is not None:
                        levels, end = self._levels(j2)
                        out.append((k, "-".join([f"p{int(self.t[k + 1][0])}", str(number), *levels])))
                        self.used.update(range(start, end))
                        k = end
                        continue
                k += 1
            elif kind == "prot":
                j = k + 1
                while j < len(self.t) and self.t[j][0] in (".", "no", "n", "nr", "°", "º", "number", ","):
                    j += 1
                number, j2 = self._number(j)
                before = cue(self.t[k - 1][0]) if k and self.t[k - 1][0].isalpha() else None
                if number is not None:
                    prots.append((k, number))
                    self.used.update(range(start, j2))
                    k = j2
                elif isinstance(before, int):
                    prots.append((k, before))
                    self.used.update((k - 1, k))
                    k += 1
                else:
                    k += 1
            elif kind == "art" or (self.bare and k == 0):
                j = k + 1 if kind == "art" else k
                while j < len(self.t) and self.t[j][0] in ".:":
                    j += 1
                number, j2 = self._number(j)
                if number is None:
                    k += 1
                    continue
                levels, end = self._levels(j2)
                arts.append((k, number, levels))
                self.used.update(range(start, end))
                k = max(end, k + 1)
            else:
                k += 1
        for place, number, levels in arts:
            code = "-".join([str(number), *levels])
            if prots:  # the protocol that is nearest
                nearest = min(prots, key=lambda p: abs(p[0] - place))
                code = f"p{nearest[1]}-{code}"
            out.append((place, code))
        return [c for _, c in sorted(out)]

    def rest(self) -> str:
        """What the numbers leave of the text."""
        return " ".join(w for k, (w, _) in enumerate(self.t) if k not in self.used and w.isalpha() and cue(w) not in ("art", "prot"))


def _forms(words: list[str]) -> set[str]:
    """A title's words as they stand, sorted, and sorted without the small ones."""
    return {" ".join(words), " ".join(sorted(words)), " ".join(sorted(w for w in words if w not in _SMALL) or words)}


_HITS = "hits array<struct<d:int,entry:string,code:string>>"
_VALUE = "text string, bare boolean, codes array<string>, used boolean, words array<struct<word:string,cut:boolean>>"


def _answers(trees: Shards, codes: dict[str, str], queries: list[tuple[str, int]]) -> pd.DataFrame:
    rows = [(q, [{"d": d, "entry": e, "code": codes[e]} for d, e in trees.within(q, r)]) for q, r in queries]
    return pd.DataFrame([r for r in rows if r[1]], columns=["query", "hits"])


def search(queries: DataFrame, entries: DataFrame, shard: int = SHARD) -> DataFrame:
    """(query, hits): every entry within the radius of each distinct (query, radius), nearest first; none, no row.

    ``entries`` has distinct texts ``entry`` and a ``code`` each, and is read more than once.
    """
    if entries.limit(shard + 1).count() <= shard:
        shared = queries.sparkSession.sparkContext.broadcast({r["entry"]: r["code"] for r in entries.select("entry", "code").collect()})

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trees = Shards(shared.value, _BAND)
            for batch in batches:
                yield _answers(trees, shared.value, list(zip(batch["query"], batch["radius"])))

        return spread(queries.select("query", "radius")).mapInPandas(ask, "query string, " + _HITS)

    band = F.floor(F.length("entry") / _BAND).cast("int")
    parts = entries.groupBy(band.alias("band")).agg(F.ceil(F.count("*") / shard).cast("int").alias("parts"))
    near = [F.floor((F.length("query") + k * F.col("radius")) / _BAND).cast("int") for k in (-1, 1)]
    asked = queries.select("query", "radius", F.explode(F.sequence(*near)).alias("band"))
    blocks = asked.groupBy("band").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    plan = parts.join(blocks, "band")  # one row per band of lengths
    held = entries.withColumn("band", band).join(plan, "band").select(
        "band", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(0).alias("kind"), F.col("entry").alias("text"), "code", F.lit(0).alias("radius"),
    )
    sent = asked.join(plan, "band").select(
        "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int").alias("block"),
        F.lit(1).alias("kind"), F.col("query").alias("text"), F.lit(None).cast("string").alias("code"), "radius",
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, codes, trees = None, {}, None
        for batch in batches:
            for own, part in batch.groupby(["band", "part", "block"], sort=False):
                if own != key:
                    key, codes, trees = own, {}, None
                entry = part[part["kind"] == 0]
                codes.update(zip(entry["text"], entry["code"]))
                ask = part[part["kind"] == 1]
                if len(ask):
                    trees = trees or Shards(codes, _BAND)
                    yield _answers(trees, codes, list(zip(ask["text"], ask["radius"])))

    keys = ["band", "part", "block"]
    told = held.unionByName(sent).repartition(*keys).sortWithinPartitions(*keys, "kind").mapInPandas(stream, "query string, " + _HITS)
    return told.groupBy("query").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))


def _read_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, bare in zip(batch["text"], batch["bare"]):
            plain = _ASPECT.sub("", fold(text).replace("&", " and ").strip())
            reader = Reader(plain, bare)
            codes = reader.codes()
            rest = _LEAD.sub("", reader.rest() if reader.used else plain).strip()
            words = [{"word": m[1], "cut": m[2] == "."} for m in re.finditer(r"([^\W\d_]+)(\.?)", rest)]
            if sum(len(w["word"]) for w in words) < 4:
                words = []
            rows.append((text, bare, codes, bool(reader.used), words))
        yield pd.DataFrame(rows, columns=["text", "bare", "codes", "used", "words"])


def _title_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for code, title in zip(batch["code"], batch["title"]):
            words = words_of(fold(title or ""))
            rows.append((code, sorted(_forms(words)) if words else [], words))
        yield pd.DataFrame(rows, columns=["code", "forms", "words"])


def _listed(codes: DataFrame) -> DataFrame:
    """(entry, code): the shortest code of each entry."""
    return codes.groupBy("entry").agg(F.min(F.struct(F.length("code"), "code")).alias("c")).select("entry", "c.code")


def mended_words(words: DataFrame, vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, cut, mended): the word of the list that was meant; ``cut`` words were shortened by a full stop.

    A word is itself if listed; a cut one the only word that begins so; then the one nearest
    word; then two words typed as one, of which one is right; then it stays as it is.
    """
    near = search(words.select(F.col("word").alias("query"), _radius_of(F.col("word")).alias("radius")).distinct(), vocabulary, shard)
    begins = vocabulary.where(F.length("entry") >= 3).select("entry", F.explode(F.sequence(F.lit(3), F.length("entry"))).alias("n"))
    begins = begins.select(F.expr("substring(entry, 1, n)").alias("word"), "entry").groupBy("word").agg(F.count("*").alias("n"), F.min("entry").alias("full"))
    begins = begins.where("n = 1").select("word", F.lit(True).alias("cut"), "full")
    first, second = F.try_element_at("hits", F.lit(1)), F.try_element_at("hits", F.lit(2))
    single = second.isNull() | (first["d"] < second["d"])
    known = words.join(near.withColumnRenamed("query", "word"), "word", "left").join(begins, ["word", "cut"], "left").select(
        "word", "cut",
        F.when(first["d"] == 0, F.col("word")).when(F.col("full").isNotNull(), F.col("full"))
        .when(first.isNotNull(), F.when(single, first["entry"]).otherwise(F.col("word"))).alias("mended"),
    )
    known = durable(known)
    longest = (vocabulary.agg(F.max(F.length("entry"))).first()[0] or 0) + 2
    size = F.length("word")
    low, high = F.greatest(F.lit(3), size - longest), F.least(size - 3, F.lit(longest))
    halves = known.where("mended is null").select("word").distinct().where(high >= low).select("word", F.explode(F.sequence(low, high)).alias("k"))
    halves = halves.select("word", F.expr("substring(word, 1, k)").alias("l"), F.expr("substring(word, k + 1)").alias("r"))
    halves = durable(halves)
    ask = halves.select(F.explode(F.array("l", "r")).alias("query")).distinct().withColumn("radius", _radius_of(F.col("query")))
    part = durable(search(ask, vocabulary, shard).select("query", F.element_at("hits", 1).alias("hit")))
    both = halves.join(part.select(F.col("query").alias("l"), F.col("hit").alias("a")), "l").join(part.select(F.col("query").alias("r"), F.col("hit").alias("b")), "r")
    both = both.where("a.d = 0 or b.d = 0").groupBy("word").agg(F.min(F.struct((F.col("a.d") + F.col("b.d")).alias("d"), F.concat_ws(" ", "a.entry", "b.entry").alias("two"))).alias("m"))
    return known.join(both, "word", "left").select("word", "cut", F.coalesce("mended", "m.two", "word").alias("mended"))


def _forms_of(words: Column) -> Column:
    """As ``_forms``, of an array column."""
    large = F.filter(words, lambda w: ~w.isin(*sorted(_SMALL)))
    kept = F.when(F.size(large) > 0, large).otherwise(words)
    return F.array(*[F.array_join(w, " ") for w in (words, F.array_sort(words), F.array_sort(kept))])


def _titles(values: DataFrame, entries: DataFrame, vocabulary: DataFrame, shard: int) -> DataFrame:
    """(words, title): the code of the title that words are, typed with slips, moved, cut or left out."""
    texts = durable(values.where(F.size("words") > 0).select("words").distinct())
    each = texts.select("words", F.posexplode("words").alias("pos", "w")).select("words", "pos", "w.word", "w.cut")
    mended = mended_words(each.select("word", "cut").distinct(), vocabulary, shard)
    lines = each.join(mended, ["word", "cut"]).groupBy("words").agg(F.array_sort(F.collect_list(F.struct("pos", "mended"))).alias("m"))
    meant = F.flatten(F.transform("m", lambda x: F.split(x["mended"], " ")))
    typed = F.transform("words", lambda w: w["word"])
    forms = durable(lines.select("words", F.explode(F.array_distinct(F.concat(_forms_of(typed), _forms_of(meant)))).alias("query")))

    def best(asked: DataFrame, radius: Column) -> DataFrame:
        found = search(asked.select("query").distinct().withColumn("radius", radius), entries, shard)
        size = lambda h: F.greatest(F.length("query"), F.length(h["entry"]))
        rank = F.array_min(F.transform("hits", lambda h: F.struct((h["d"] / size(h)).alias("share"), F.length(h["code"]).alias("n"), h["code"].alias("code"))))
        return asked.join(found.select("query", rank.alias("rank")), "query").groupBy("words").agg(F.min("rank").alias("rank")).select("words", "rank.code")

    exact = durable(best(forms, F.lit(0)))  # nothing is nearer, so only the others are searched on
    others = forms.join(exact, "words", "left_anti")
    return exact.unionByName(best(others, F.floor(NEAR * F.length("query")).cast("int"))).withColumnRenamed("code", "title")


def map_to_list(df: DataFrame, reference: DataFrame, key: str = "id", shard: int = SHARD) -> DataFrame:
    """(key, code): one row per row, with the most exact code of the list that a field supports."""
    fields = ["element", "article", "base_article"]
    rows = df.select(key, *fields)
    triples = durable(rows.select(*fields).distinct())
    order = [("article", True, 0), ("element", False, 1), ("base_article", True, 2)]
    field = F.explode(F.array(*[F.struct(F.col(c).alias("text"), F.lit(bare).alias("bare"), F.lit(k).alias("ord")) for c, bare, k in order])).alias("f")
    named = triples.select(*fields, field).select(*fields, "f.*").where(F.trim("text") != "")
    values = durable(spread(named.select("text", "bare").distinct()).mapInPandas(_read_values, _VALUE))

    titles = durable(reference.where("code is not null").select("code", "title").mapInPandas(_title_entries, "code string, forms array<string>, words array<string>"))
    forms = titles.select(F.explode("forms").alias("entry"), "code")
    entries = durable(_listed(titles.select(F.col("code").alias("entry"), "code").unionByName(forms)))
    vocabulary = durable(titles.select(F.explode("words").alias("entry")).distinct().withColumn("code", F.col("entry")))

    # A code and its parents, nearest first: all are asked for with radius 0.
    codes = values.where(F.size("codes") > 0).select("codes").distinct().select("codes", F.posexplode("codes").alias("pos", "code"))
    levels = F.split("code", "-")
    chain = codes.select("codes", "pos", F.explode(F.transform(F.sequence(F.lit(1), F.size(levels)), lambda n: F.array_join(F.slice(levels, 1, n), "-"))).alias("query"))
    known = search(chain.select("query").distinct().withColumn("radius", F.lit(0)), entries, shard).select("query", F.col("hits")[0]["code"].alias("code"))
    nearest = chain.join(known, "query").groupBy("codes", "pos").agg(F.max_by("code", F.length("query")).alias("code"))
    depth = F.size(F.split("code", "-")) - F.when(F.col("code").startswith("p"), 1).otherwise(0)
    listed = nearest.groupBy("codes").agg(F.max_by(F.struct("code", depth.alias("depth")), F.struct(depth, -F.col("pos"))).alias("number"))

    read = values.join(listed, "codes", "left").join(_titles(values, entries, vocabulary, shard), "words", "left")
    titled = F.when(~F.col("used") | F.col("number").isNotNull(), F.col("title"))
    own = F.when(titled.isNotNull(), F.struct(titled.alias("code"), (F.size(F.split(titled, "-")) - F.when(titled.startswith("p"), 1).otherwise(0)).alias("depth")))
    pick = F.when(F.col("number").isNull() | (own["depth"] > F.col("number.depth")), own).otherwise(F.col("number"))
    read = read.select("text", "bare", pick.alias("pick")).where("pick is not null")
    best = durable(named.join(read, ["text", "bare"]).groupBy(*fields).agg(F.max_by("pick.code", F.struct("pick.depth", -F.col("ord"))).alias("code")))
    same = [rows[c].eqNullSafe(best[c]) for c in fields]
    return rows.join(best, same[0] & same[1] & same[2], "left").select(rows[key], F.coalesce(best["code"], F.lit(NONE)).alias("code"))
