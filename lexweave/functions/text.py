"""Column functions over texts: tokens, cleaning, n-grams, numbering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words, as published with common toolkits.
STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself she "
    "she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't couldn "
    "couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
# Marks that are taken out of tokens.
MARKS = (",", '"', ")", "(", "\\", ".")
# Letters with marks and what they are written as in ASCII, one for one.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďđēęěğģīįķłļńņňōőŕřśşšţťūůűųźżžșțı"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaaaccddeeeggiikllnnnoorrsssttuuuuzzzsti"
#: White space of any kind, spelled out because engines disagree on it; for use inside a character class.
BLANK = r"\t\n\x0b\x0c\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+$", "")


def lower(text: Column) -> Column:
    """Lower case in which a dotted capital I is one letter."""
    return F.lower(F.replace(text, F.lit("İ"), F.lit("i")))


def tokens(text: Column) -> Column:
    """Runs of word characters and runs of marks."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def transliterate(text: Column) -> Column:
    """Accented Latin letters in ASCII; letters with two-letter forms too."""
    for a, b in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("þ", "th"), ("ð", "d")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.translate(text, ACCENTED, PLAIN)


def clean_tokens(text: Column, least: int = 3) -> Column:
    """Lower case; stop words and marks go, marks inside tokens too; ASCII; short ones go last."""
    marks = "[" + "".join(f"\\x{{{ord(m):x}}}" for m in MARKS) + "]"
    low = F.filter(tokens(lower(text)), lambda t: ~t.isin(*STOPWORDS))
    ascii_ = F.transform(low, lambda t: transliterate(F.regexp_replace(t, marks, "")))
    return F.filter(ascii_, lambda t: F.length(t) >= least)


def ngrams(words: Column, n: int) -> Column:
    """Runs of n tokens joined by ``_``; none where there are fewer."""
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), "_"))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def normalised(text: Column, orders: int = 4) -> Column:
    """1-grams, then 2-grams and so on, in one array."""

    # A variable of a lambda holds the tokens: an expression would be worked out again for every gram.
    def grams(words: Column) -> Column:
        return F.concat(words, *[ngrams(words, n) for n in range(2, orders + 1)])

    return F.transform(F.array(clean_tokens(text)), grams).getItem(0)


def strip_number(line: Column) -> Column:
    """A paragraph without its number, trimmed; as it is where it has none."""
    rest = F.regexp_extract(line, r"^(?:[\p{L}\p{N}_]+\.)([^\n]+)", 1)
    return F.when(rest != "", strip(rest)).otherwise(line)


def strip_title_number(line: Column) -> Column:
    rest = F.regexp_extract(line, r"^[\p{L}\p{N}_]+\.([^\n]+)", 1)
    return F.when(rest != "", strip(rest)).otherwise(line)


def split_number(line: Column) -> Column:
    """Leading digits and what follows them, for texts that lost the blank between."""
    return F.struct(F.regexp_extract(line, r"^([0-9]+)([^0-9].*)$", 1).alias("number"), F.regexp_extract(line, r"^([0-9]+)([^0-9].*)$", 2).alias("rest"))


def decision_body_line(line: Column) -> Column:
    """A line of the decision body without offices and commas."""
    for word in ("President", " Registrar", "judges", ","):
        line = F.replace(line, F.lit(word), F.lit(""))
    return strip(line)


def match_form(text: Column) -> Column:
    """Upper case, ASCII, hyphens as blanks: the form in which names are looked for."""
    return F.replace(F.upper(transliterate(lower(text))), F.lit("-"), F.lit(" "))


def clean_cell(cell: Column) -> Column:
    return F.trim(F.translate(cell, "\n", " "))
