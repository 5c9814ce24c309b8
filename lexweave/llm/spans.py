"""Problem 9: long exact spans that several records share, by repeated-phrase automata.

1. Phrases. In every run of SPAN characters the PHRASE-gram of least hash is a
   phrase (winnowing, vectorised over whole batches), so records that share a
   run of SPAN characters hold the phrase of that run, at the same place in it.
2. Recurring phrases. A phrase that only one record holds leads nowhere; one
   shuffle of hashes keeps the others, a few per cent. Their text is cut from
   the first record that holds them.
3. Automata. Recurring phrases go to shards, those of one passage to the same
   one. A shard compiles its phrases into a pyahocorasick automaton, and whole
   texts are streamed through it, which locates every occurrence of every
   phrase, character by character. Only what it locates goes on: without the
   automata there is no result. Winnowing proves which shards' phrases a text
   can hold, so it is streamed through these; a shard that many texts need is
   compiled in several tasks (blocks), each of which streams a part of them.
4. Runs. Each occurrence has its passage: all runs of SPAN characters that hold
   the phrase. Equal passages of a phrase are one. Where a phrase stands in
   different passages, their runs are compared by 128-bit hashes of their text.
   Runs that two records or more hold form a class; classes with the same
   members are kept once.
5. Results. Classes join back to documents: members for p9_classes, pairs for
   p9_found, and covered positions for the share of each text in p9_shares.

Skew and size: a task holds one shard's phrases and one text at a time; hot
phrases are rows like others. Hashes, passages and runs are pre-aggregated.
Pairs are emitted per class; their number is that of the result.

Defined results: null, empty and short texts share nothing. Equal texts of
SPAN or more characters share all. A run that repeats inside one record only is
not shared. Positions and lengths are in code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, spread

SPAN = 300
PHRASE = 160
#: Phrases that a shard's automaton is meant to hold, and texts that one task is meant to stream through it.
SHARD = 4_000
TEXTS = 4_000
#: Passages of one phrase whose runs one task compares.
PASSAGES = 10_000
#: Positions of a text whose phrases go to one shard: bounds what a very long text brings.
_STRETCH = 50_000
_BASE = 0x9E3779B97F4A7C15
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A well-mixed 64-bit hash of every gram of ``size`` code points."""
    n = len(codes)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, n.bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[size:] - sums[:-size]) * down[: n - size + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = np.minimum(out[:-rest], out[rest:])
    return out


def phrases_of(texts: list[str], span: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash) of the phrases of several texts, all at once."""
    empty = np.zeros(0, np.int64)
    if not texts:
        return empty, empty, empty
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    width = span - phrase + 1
    h = gram_hashes(codes, phrase)
    if len(h) < width:
        return empty, empty, empty
    least = window_min(h, width)
    # Runs that cross the border of two texts don't count.
    inside = np.ones(len(codes), bool)
    for s in starts[1:]:
        inside[max(0, s - span + 1) : s] = False
    inside = inside[: len(least)]
    # A gram is kept if it is the least of some run inside a text: compare with the runs that hold it.
    best = np.where(inside, least, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = ~window_min(~np.concatenate([pad, best, pad]), width)
    at = np.nonzero(h == most)[0]
    # A run's least lies in it, so a gram equal to the greatest least among the runs that hold it is the least of one.
    owner = np.searchsorted(starts, at, "right") - 1
    return owner, at - starts[owner], h[at].view(np.int64)


def _phrase_rows(docs: DataFrame, span: int, phrase: int) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):  # a bounded number of characters at a time
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= 1_000_000):
                    chars += len(texts[end])
                    end += 1
                owner, pos, h = phrases_of(texts[at:end], span, phrase)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner + at)), pa.array(pos, pa.int32()), pa.array(h, pa.int64())],
                    names=["doc_id", "pos", "h"],
                )
                at = end

    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, pos int, h bigint")


def recurring_phrases(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE) -> DataFrame:
    """(doc_id, pos, h, a, at): the phrases that several documents hold; the first of them is a, which holds it at ``at``."""
    rows = _phrase_rows(docs.where(F.char_length("text") >= span), span, phrase)
    # One shuffle of hashes; a window spills, so it bears a phrase that many documents hold.
    same = Window.partitionBy("h")
    first, last = F.min(F.struct("doc_id", "pos")).over(same), F.max("doc_id").over(same)
    found = rows.withColumn("first", first).withColumn("last", last).where(F.col("first.doc_id") < F.col("last"))
    return found.select("doc_id", "pos", "h", F.col("first.doc_id").alias("a"), F.col("first.pos").alias("at"))


def _routed(docs: DataFrame, hits: DataFrame, phrase: int, shard: int) -> DataFrame:
    """(shard, block, kind, h, doc_id, text): phrases (kind 0) and the texts (kind 1) that each block streams."""
    witness = (F.col("doc_id") == F.col("a")) & (F.col("pos") == F.col("at"))
    shards = max(1, -(-hits.where(witness).count() // shard))
    # Phrases of one passage have the same first document: they share a shard, so a text meets few of them.
    home = F.pmod(F.xxhash64("a", F.floor(F.col("at") / _STRETCH)), F.lit(shards)).cast("int")
    hits = hits.withColumn("shard", home).withColumn("piece", F.when(witness, F.struct("shard", "h", "pos")))
    need = hits.select("shard", "doc_id").distinct().groupBy("shard").agg(F.ceil(F.count("*") / TEXTS).cast("int").alias("blocks"))
    per = hits.groupBy("doc_id", "shard").agg(F.collect_set("piece").alias("pieces"))
    per = per.join(need, "shard")  # one row per shard, so the optimiser decides how to join
    block = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")).cast("int")
    none = F.lit(None).cast("int")
    streams = F.array(F.struct("shard", block.alias("block"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("h"), none.alias("pos")))
    compiled = F.flatten(F.transform("pieces", lambda p: F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(
        p["shard"].alias("shard"), b.alias("block"), F.lit(0).alias("kind"), p["h"].alias("h"), p["pos"].alias("pos")))))
    per = per.groupBy("doc_id").agg(F.flatten(F.collect_list(F.concat(streams, compiled))).alias("parts"))
    cut = F.when(F.col("p.kind") == 0, F.substring("text", F.col("p.pos") + 1, F.lit(phrase))).otherwise(F.col("text"))
    return docs.select("doc_id", "text").join(per, "doc_id").select("doc_id", "text", F.explode("parts").alias("p")).select(
        "p.shard", "p.block", "p.kind", "p.h", "doc_id", cut.alias("text")
    )


class Phrases:
    """One shard's automaton: phrases as text, and where they stand in other texts."""

    def __init__(self, phrase: int, span: int):
        self.phrase, self.margin = phrase, span - phrase
        self.words: dict[str, int] = {}
        self.automaton = None

    def add(self, text: str, h: int) -> None:
        self.words[text] = h

    def passages(self, text: str) -> dict[tuple[int, int, str], list[int]]:
        """(hash, place of the phrase, passage) of every occurrence, with the positions at which such a passage begins."""
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for word, h in self.words.items():
                self.automaton.add_word(word, h)
            self.automaton.make_automaton()
        out: dict[tuple[int, int, str], list[int]] = {}
        if self.words:
            for end, h in self.automaton.iter(text):
                at = end - self.phrase + 1
                begin = max(0, at - self.margin)
                out.setdefault((h, at - begin, text[begin : end + 1 + self.margin]), []).append(begin)
        return out


def occurrences(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE, shard: int = SHARD, automaton: type = Phrases) -> DataFrame:
    """(doc_id, h, left, passage, ats): every occurrence of every recurring phrase, located by the shards' automata."""
    docs = docs.select("doc_id", "text").where(F.char_length("text") >= span)
    routed = _routed(docs, durable(recurring_phrases(docs, span, phrase)), phrase, shard)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, h bigint, `left` int, passage string, ats array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, phrases = None, automaton(phrase, span)
        ids, rows = [], []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            types = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *map(pa.array, cols, types)], names=["doc_id", "h", "left", "passage", "ats"])

        for batch in batches:
            shards, blocks, kinds, hs, texts = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
            for n, text in enumerate(texts):
                if key != (shards[n], blocks[n]):
                    key, phrases = (shards[n], blocks[n]), automaton(phrase, span)
                if kinds[n] == 0:
                    phrases.add(text, hs[n])
                    continue
                found = phrases.passages(text)
                if found:
                    ids.append(batch.column(4).take(pa.array([n] * len(found))))
                    rows.extend((h, left, passage, ats) for (h, left, passage), ats in found.items())
                if len(rows) > 5_000:
                    yield flush()
                    ids, rows = [], []
        if rows:
            yield flush()

    # A block's phrases come before its texts, so it is compiled once and texts are not kept.
    streams = routed.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
    return streams.mapInArrow(run, schema)


def _named(docs: DataFrame, span: int, phrase: int, shard: int, automaton: type) -> DataFrame:
    """Occurrences with p1, p2, which name the phrase's passage."""
    found = occurrences(docs, span, phrase, shard, automaton)
    return durable(found.withColumn("p1", F.xxhash64("h", "left", "passage", F.lit(1))).withColumn("p2", F.xxhash64("h", "left", "passage", F.lit(2))))


def _runs(named: DataFrame, span: int, phrase: int) -> tuple[DataFrame, DataFrame]:
    """Members (c1, c2, p1, p2) of the classes of runs that several documents hold, and (p1, p2, lo, hi): what of a passage is shared."""
    each = named.groupBy("h", "p1", "p2").agg(
        F.first("left").alias("left"), F.first("passage").alias("passage"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")
    )
    first = F.greatest(F.col("left") + phrase - span, F.lit(0))
    last = F.least(F.col("left"), F.char_length("passage") - span)
    each = durable(each.withColumn("first", first).withColumn("last", last).where("last >= first"))
    many = each.groupBy("h").agg(F.count("*").alias("n"))
    alone = each.join(many.where("n = 1"), "h", "left_semi").where("a < b")  # one passage: all its runs are one class
    # Equal runs have the phrase at the same place k in them. A phrase's passages go to one task, which explodes their
    # runs, or to several, each for its part of the places; so passages are shuffled and runs, of which there are many, aren't.
    blocks = F.least(F.ceil(F.col("n") / PASSAGES), F.lit(span - phrase + 1)).cast("int")
    several = each.join(many.where("n > 1"), "h").withColumn("blocks", blocks).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    starts = F.filter(F.sequence("first", "last"), lambda at: F.pmod(F.col("left") - at, F.col("blocks")) == F.col("block"))
    runs = (
        several.repartition("h", "block").select("h", "block", "p1", "p2", "a", "b", "left", "passage", F.explode(starts).alias("start"))
        .withColumn("run", F.expr(f"substring(passage, start + 1, {span})")).withColumn("k", F.col("left") - F.col("start"))
        .select("h", "block", "p1", "p2", "a", "b", "start", F.xxhash64("k", "run", F.lit(3)).alias("c1"), F.xxhash64("k", "run", F.lit(4)).alias("c2"))
    )
    same = Window.partitionBy("h", "block", "c1", "c2")
    held = runs.select(
        "h", "block", "c1", "c2", "p1", "p2", "start", F.min("a").over(same).alias("a"), F.max("b").over(same).alias("b"),
        F.count("*").over(same).alias("n"), F.sum(F.col("p1").cast("decimal(38,0)")).over(same).alias("s"),
    ).where("a < b")
    alike = Window.partitionBy("h", "block", "n", "s")
    kept = held.withColumn("least", F.min(F.struct("c1", "c2")).over(alike)).where("least.c1 = c1 and least.c2 = c2")
    members = kept.select("c1", "c2", "p1", "p2").unionByName(alone.select(F.col("p1").alias("c1"), F.col("p2").alias("c2"), "p1", "p2"))
    # Shared runs of a passage all hold the phrase, so together they are one stretch.
    shared = held.groupBy("p1", "p2").agg(F.min("start").alias("lo"), (F.max("start") + span).alias("hi"))
    shared = shared.unionByName(alone.select("p1", "p2", F.col("first").alias("lo"), (F.col("last") + span).alias("hi")))
    return members, shared


def shared_classes(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE, shard: int = SHARD, automaton: type = Phrases) -> DataFrame:
    """(c1, c2, doc_id, n_docs): sets of documents that hold the same run of ``span`` characters, each set once."""
    named = _named(docs, span, phrase, shard, automaton)
    members, _ = _runs(named, span, phrase)
    held = durable(members.join(named.select("p1", "p2", "doc_id"), ["p1", "p2"]).select("c1", "c2", "doc_id").distinct())
    # Classes of different phrases of a passage have the same documents: keep one of each set.
    sets = held.groupBy("c1", "c2").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.xxhash64("doc_id", F.lit(5)).cast("decimal(38,0)")).alias("s1"),
        F.sum(F.xxhash64("doc_id", F.lit(6)).cast("decimal(38,0)")).alias("s2"),
    )
    kept = sets.groupBy("n_docs", "s1", "s2").agg(F.min(F.struct("c1", "c2")).alias("c")).select("c.c1", "c.c2", "n_docs")
    return held.join(kept, ["c1", "c2"]).select("c1", "c2", "doc_id", "n_docs")


def shared_pairs(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE, shard: int = SHARD, automaton: type = Phrases) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: the documents in which the same run of ``span`` characters stands."""
    own = durable(shared_classes(docs, span, phrase, shard, automaton))
    return (
        own.select("c1", "c2", F.col("doc_id").alias("doc_a"))
        .join(own.select("c1", "c2", F.col("doc_id").alias("doc_b")), ["c1", "c2"])
        .where("doc_a < doc_b")
        .select("doc_a", "doc_b")
        .distinct()
    )


def shared_shares(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE, shard: int = SHARD, automaton: type = Phrases) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share) of every document: how much of its text stands elsewhere in runs of ``span``."""
    named = _named(docs, span, phrase, shard, automaton)
    _, covered = _runs(named, span, phrase)
    spans = (
        named.select("p1", "p2", "doc_id", F.explode("ats").alias("at")).join(covered, ["p1", "p2"])
        .select("doc_id", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
        .groupBy("doc_id", "lo").agg(F.max("hi").alias("hi"))
    )
    before = Window.partitionBy("doc_id").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("hi") - F.greatest("lo", F.coalesce(F.max("hi").over(before), F.lit(0))), F.lit(0))
    totals = spans.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("shared_chars"))
    sizes = docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
    return sizes.join(totals, "doc_id", "left").select(
        "doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"),
        F.when(F.col("n_chars") > 0, F.coalesce("shared_chars", F.lit(0)) / F.col("n_chars")).otherwise(0.0).alias("share"),
    )
