"""Token counts, vocabularies, bags of words and TF-IDF in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as fn
from ..session import durable


def token_counts(docs: DataFrame, column: str = "tokens") -> DataFrame:
    """(token, n) over the corpus."""
    return docs.select(F.explode(column).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def document_frequency(docs: DataFrame, column: str = "tokens") -> DataFrame:
    """(token, df): documents that hold a token; duplicates go inside the row, before the shuffle."""
    return docs.select(F.explode(F.array_distinct(column)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def ngram_counts(docs: DataFrame, orders: int = 4, least: int = 1) -> DataFrame:
    """(n, gram, count) of n-grams that occur ``least`` times or more."""
    words = docs.select(fn.clean_tokens(F.col("text")).alias("words"))
    grams = F.array(*[F.struct(F.lit(n).alias("n"), fn.ngrams(F.col("words"), n).alias("gs")) for n in range(1, orders + 1)])
    rows = words.select(F.explode(grams).alias("g")).select("g.n", F.explode("g.gs").alias("gram"))
    return rows.groupBy("n", "gram").agg(F.count("*").alias("count")).where(F.col("count") >= least)


def vocabulary(docs: DataFrame, size: int, column: str = "tokens") -> DataFrame:
    """(token, n, token_id): the ``size`` most frequent tokens, numbered in the order of their text.

    The limit is the feature; at most ``size`` rows are ranked in one partition.
    """
    top = token_counts(docs, column).orderBy(F.desc("n"), "token").limit(size)
    return top.withColumn("token_id", F.row_number().over(Window.orderBy("token")) - 1)


def bag_of_words(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", column: str = "tokens") -> DataFrame:
    """(key, token_id, tf). Tokens meet the vocabulary, are counted inside their partition, then by one shuffle on key and token id.

    The vocabulary has a given size, so it is broadcast.
    """
    rows = docs.select(key, F.explode(column).alias("token")).join(F.broadcast(vocab.select("token", "token_id")), "token")
    return rows.groupBy(key, "token_id").agg(F.count("*").alias("tf"))


def tfidf(bow: DataFrame, n_docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, token_id, w): tf * log2(N / df), each document's vector of length one; zeros go.

    ``n_docs`` is a one-row frame (n): the number of documents.
    """
    bow = durable(bow)  # read twice below; the texts are cut into tokens once
    df = bow.groupBy("token_id").agg(F.count("*").alias("df"))
    raw = bow.join(F.broadcast(df), "token_id").crossJoin(F.broadcast(n_docs))
    raw = raw.withColumn("w", F.col("tf") * F.log2(F.col("n") / F.col("df"))).where(F.abs("w") > 1e-12)
    # A document has no more rows than the vocabulary, so a window holds little.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "token_id", (F.col("w") / norm).alias("w"))


def vector_lines(vectors: DataFrame, value: str, key: str = "doc_id", offset: int = 0, size: str = "") -> DataFrame:
    """(key, line): a document's vector as ``id:value`` pairs in the order of ids; with ``size`` also the number of pairs, so named."""
    pairs = F.array_sort(F.collect_list(F.struct((F.col("token_id") + offset).alias("i"), F.col(value).cast("string").alias("v"))))
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(p["i"].cast("string"), F.lit(":"), p["v"])), " ")
    return vectors.groupBy(key).agg(joined.alias("line"), *[F.count("*").alias(size)] * bool(size))


def corrected_frequencies(grams: DataFrame) -> DataFrame:
    """(n, gram, count): counts lowered by one for each longer gram that begins with, holds or ends in a gram.

    Each of the three is a test of text: ``_g``, ``_g_`` and ``g_`` stand in the longer gram.
    A longer gram of n words without underscores of their own has n - 1 underscores, so what
    stands beside one and has n - 2 is all but its first word, with any part of the last one
    left out at the end, or all but its last word likewise. These two ends are counted first;
    parts of a word are put in their place only if some gram ends (or begins) with such a part.
    """
    grams = durable(grams, compression="zstd")  # read below again and again; the texts are cut into grams once
    gram, first, last = F.col("gram"), F.substring_index("gram", "_", 1), F.substring_index("gram", "_", -1)
    plain = F.length(gram) - F.length(F.replace(gram, F.lit("_"), F.lit(""))) == F.col("n") - 1
    after, before = F.substring(gram, F.length(first) + 2, F.length(gram)), F.substring(gram, F.lit(1), F.length(gram) - F.length(last) - 1)
    two = F.array(F.struct(F.lit(0).alias("side"), after.alias("gram")), F.struct(F.lit(1).alias("side"), before.alias("gram")))
    ends = grams.where("n > 1").where(plain).select((F.col("n") - 1).alias("n"), F.explode(two).alias("e")).groupBy("n", "e.side", "e.gram").agg(F.count("*").alias("less"))
    ends = ends.withColumn("word", F.when(F.col("side") == 0, last).otherwise(first))
    rest = F.length(gram) - F.length("word")
    spelled = F.when(F.col("side") == 0, F.concat(F.substring(gram, F.lit(1), rest), "part")).otherwise(F.concat("part", F.substring(gram, F.length("word") + 1, rest)))
    parted = ends.join(_parts_of_words(grams), ["side", "word"], "left").select("*", F.explode(F.array_append(F.coalesce("parts", F.array().cast("array<string>")), F.col("word"))).alias("part"))
    hits = parted.select("n", spelled.alias("gram"), (-F.col("less")).alias("count")).unionByName(_hits_of_odd(grams.where("n > 1").where(~plain)))
    every = grams.select("n", "gram", "count", F.lit(True).alias("is")).unionByName(hits.withColumn("is", F.lit(False)))
    return every.groupBy("n", "gram").agg(F.sum("count").alias("count"), F.max("is").alias("is")).where("is").select("n", "gram", "count")


def _parts_of_words(grams: DataFrame) -> DataFrame:
    """(side, word, parts): of the last (side 0) and first (side 1) words of grams their beginnings (endings) that are such words too."""
    place = F.array(*[F.struct(F.lit(k).alias("side"), F.substring_index("gram", "_", 1 - 2 * (k == 0)).alias("word")) for k in (0, 1)])
    words = durable(grams.select(F.explode(place).alias("w")).select("w.*").distinct())
    sizes = F.when(F.length("word") > 1, F.sequence(F.lit(1), F.length("word") - 1))
    cut = words.select("side", "word", F.explode(sizes).alias("k")).select(
        "side", F.col("word").alias("whole"), F.when(F.col("side") == 0, F.substring(F.col("word"), F.lit(1), F.col("k"))).otherwise(F.substring(F.col("word"), F.col("k") + 1, F.length("word"))).alias("word")
    )
    return cut.join(words, ["side", "word"], "left_semi").groupBy("side", F.col("whole").alias("word")).agg(F.collect_list(F.col("word")).alias("parts"))


def _hits_of_odd(grams: DataFrame) -> DataFrame:
    """(n, gram, count), -1 for each text that a gram with underscores inside its words holds beside an underscore."""
    longer, early, late = F.col("gram"), F.col("early"), F.col("late")
    marks = F.filter(F.sequence(F.lit(1), F.length(longer)), lambda i: F.substring(longer, i, F.lit(1)) == "_")
    marked = grams.select("n", "gram", marks.alias("marks"))
    # A text with n - 1 underscores begins before the mark that leaves as many behind it, and ends likewise.
    free = F.size("marks") - F.col("n") + 2
    marked = marked.select("n", "gram", F.slice("marks", F.lit(1), free).alias("early"), F.slice("marks", F.col("n") - 1, free).alias("late"))

    def parts(after: Column, ends: Column) -> Column:
        """The distinct texts from a place to each of the places behind it."""
        found = F.flatten(F.transform(after, lambda s: F.transform(F.filter(ends, lambda e: e > s), lambda e: F.substring(longer, s + 1, e - s - 1))))
        return F.array_distinct(F.filter(found, lambda t: F.length(F.replace(t, F.lit("_"), F.lit(""))) <= F.length(t) - F.col("n") + 2))

    any_start = F.sequence(F.lit(0), F.element_at(early, -1) - 1)
    any_end = F.sequence(F.element_at(late, 1) + 1, F.length(longer) + 1)
    hits = F.concat(parts(early, any_end), parts(early, late), parts(any_start, late))
    cut = marked.select("n", F.explode(hits).alias("piece")).where("piece <> ''")
    return cut.select((F.col("n") - 1).alias("n"), F.col("piece").alias("gram"), F.lit(-1).cast("bigint").alias("count"))


def repeat_tokens(counts: DataFrame, token: str = "gram", n: str = "count") -> DataFrame:
    """Each token as many times as it is counted, joined by blanks."""
    times = F.greatest(F.col(n), F.lit(0)).cast("int")
    return counts.select(token, F.array_join(F.array_repeat(F.col(token), times), " ").alias("text"))
