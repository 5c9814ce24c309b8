"""Problem 8: mixing sources to target weights by Poisson replication.

A record's number of copies is drawn by inverting a Poisson distribution at a
uniform value seeded by a hash of its id, cut off at the source's
``max_repeats``. For a fixed uniform value the number of copies only grows
with the mean, so each source's mean is calibrated on the draws themselves:
two rounds of a grid of means, each one aggregation to GRID small rows per
source, find the mean whose drawn total comes nearest the source's share.
The draws depend on id and seed alone, so lost tasks repeat them alike.

Total size: the largest that no cap forbids, at most the corpus's own:
min(corpus, min over sources of max_repeats * size / share).

Copies are spread by a hash of id and copy number: a repartition by that hash
and a sort inside the partitions is a global shuffle of the corpus.

Defined results: sources without a target (also null) are left out. A target
source without tokens can't be met: its share is spread over the others in
proportion, and the report says so (``size`` 0). Null and empty texts have no
tokens and take part like others. Repeated rows are records of their own, by
their id. A share of 0 gives no copies. Columns named like the operator's own
are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .bpe import VOCABULARIES, count_tokens

#: Means in each round of calibration.
GRID = 48


def uniform(key: Column, seed: int) -> Column:
    """A value in (0, 1) that depends on the key and the seed alone."""
    # 52 bits of the hash, so every value is exact in a double.
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)


def copies(u: Column, mean: Column, cap: int) -> Column:
    """The Poisson number of copies at u, at most cap: the inverse distribution function."""
    term = F.exp(-mean)
    below, n = term, F.when(u > term, 1).otherwise(0)
    for k in range(1, cap):
        term = term * mean / k
        below = below + term
        n = n + F.when(u > below, 1).otherwise(0)
    return n if cap > 0 else F.lit(0)


def capped_mean(mean: np.ndarray, cap: int) -> np.ndarray:
    """The expected number of copies for a Poisson mean under a cap."""
    term, expected, below = np.exp(-mean), np.zeros_like(mean), np.zeros_like(mean)
    for k in range(cap):
        below = below + term
        expected = expected + (1 - below)
        term = term * mean / (k + 1)
    return expected


def plan(sizes: dict[str, int], targets: pd.DataFrame, corpus: int) -> pd.DataFrame:
    """Per source with a target: its share after absent sources, and the tokens that it should give."""
    t = targets.groupby("source", as_index=False).agg(target_share=("target_share", "sum"), max_repeats=("max_repeats", "max"))
    t["target_share"] = t["target_share"].fillna(0.0).clip(lower=0.0)
    t["max_repeats"] = t["max_repeats"].fillna(0).astype(int)
    t["size"] = [int(sizes.get(s, 0)) for s in t["source"]]
    usable = (t["size"] > 0) & (t["max_repeats"] > 0) & (t["target_share"] > 0)
    whole = t.loc[usable, "target_share"].sum()
    t["share"] = np.where(usable, t["target_share"] / whole if whole else 0.0, 0.0)
    room = (t["max_repeats"] * t["size"] / t["share"].where(usable, np.inf))[usable]
    total = min([float(corpus), *room.tolist()]) if usable.any() else 0.0
    t["goal"] = t["share"] * total
    t["rate"] = np.where(usable, t["goal"] / t["size"].where(t["size"] > 0, 1), 0.0)
    return t


def _by_source(values: dict[str, float], default: float = 0.0) -> Column:
    if not values:
        return F.lit(default)
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(default))


def _draw(u: np.ndarray, mean: float, cap: int) -> np.ndarray:
    """As copies(), for a column of uniform values."""
    term = below = math.exp(-mean)
    n = (u > below).astype(np.int64) if cap else np.zeros(len(u), np.int64)
    for k in range(1, cap):
        term = term * mean / k
        below += term
        n += u > below
    return n


def _grid_totals(
    batches: Iterator[pd.DataFrame], grids: dict[str, np.ndarray], caps: dict[str, int]
) -> Iterator[pd.DataFrame]:
    """Per batch, source and mean of the grid: the tokens drawn."""
    for batch in batches:
        out = []
        for source, rows in batch.groupby("source"):
            u, size = rows["u"].to_numpy(), rows["n_tokens"].to_numpy()
            out.extend((source, k, int((_draw(u, m, caps[source]) * size).sum())) for k, m in enumerate(grids[source]))
        yield pd.DataFrame(out, columns=["source", "step", "total"])


def calibrate(sized: DataFrame, wanted: pd.DataFrame) -> dict[str, float]:
    """The Poisson mean of each source whose draws come nearest its goal; inf where every record takes its cap."""
    means: dict[str, float] = {}
    lows, highs, caps, goals = {}, {}, {}, {}
    for row in wanted.itertuples():
        if row.goal <= 0:
            continue
        if row.rate >= row.max_repeats - 1e-9:
            means[row.source] = float("inf")
            continue
        # Invert the expected number of copies for a first guess, then look around it.
        grid = np.linspace(0.0, 12.0 + 6.0 * row.max_repeats, 20_001)
        guess = float(grid[np.searchsorted(capped_mean(grid, row.max_repeats), row.rate)])
        lows[row.source], highs[row.source] = guess * 0.5, guess * 1.6 + 0.05
        caps[row.source], goals[row.source] = int(row.max_repeats), row.goal
    for _ in range(2):
        if not lows:
            break
        grids = {s: np.linspace(lows[s], highs[s], GRID) for s in lows}
        totals = (
            sized.where(F.col("source").isin(*lows))
            .select("source", "u", "n_tokens")
            .mapInPandas(partial(_grid_totals, grids=grids, caps=caps), "source string, step int, total bigint")
            .groupBy("source", "step")
            .agg(F.sum("total").alias("total"))
            .toPandas()  # GRID rows per target source
        )
        for s, rows in totals.groupby("source"):
            best = int(rows.loc[(rows["total"] - goals[s]).abs().idxmin(), "step"])
            step = grids[s][1] - grids[s][0]
            means[s] = float(grids[s][best])
            lows[s], highs[s] = max(0.0, means[s] - step), means[s] + step
    return means


def mix_sources(
    docs: DataFrame,
    targets: DataFrame,
    seed: int = 20_240_229,
    name: str = "byte_bpe_50k",
    folder: str = VOCABULARIES,
    target_rows: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """The mixed corpus (docs' columns, n_tokens, copy) in shuffled order, and the report per source.

    ``targets`` (source, target_share, max_repeats) is a hand-written list; more
    than ``target_rows`` sources are refused rather than collected.
    """
    spark = docs.sparkSession
    few = targets.select("source", "target_share", "max_repeats").limit(target_rows + 1).toPandas()
    if len(few) > target_rows:
        raise ValueError(f"more than {target_rows} target sources")
    own = [c for c in docs.columns if c not in ("n_tokens", "copy", "u")]
    sized = durable(count_tokens(docs.select(*own), name=name, folder=folder)).withColumn("u", uniform(F.col("doc_id"), seed))

    known = [s for s in few["source"].dropna().unique().tolist()]
    group = F.when(F.col("source").isin(*known), F.col("source")) if known else F.lit(None).cast("string")
    totals = sized.groupBy(group.alias("source")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()
    sizes = {r["source"]: int(r["n"] or 0) for r in totals if r["source"] is not None}
    wanted = plan(sizes, few.dropna(subset=["source"]), sum(int(r["n"] or 0) for r in totals))
    means = calibrate(sized, wanted)

    caps = {r.source: int(r.max_repeats) for r in wanted.itertuples() if r.source in means}
    drawn = F.least(
        copies(F.col("u"), _by_source({s: m for s, m in means.items() if m != float("inf")}), max(caps.values(), default=0)),
        _by_source(caps).cast("int"),
    )
    full = [s for s, m in means.items() if m == float("inf")]
    n = F.when(F.col("source").isin(*full), _by_source(caps).cast("int")).otherwise(drawn) if full else drawn
    drawn_rows = sized.withColumn("n_copies", n).where(F.col("n_copies") > 0)

    place = F.xxhash64(F.col("doc_id"), F.col("copy"), F.lit(seed + 1))
    mixed = (
        drawn_rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
        .withColumn("place", place)
        .repartition("place")
        .sortWithinPartitions("place")
        .select(*own, "n_tokens", "copy")
    )
    got = drawn_rows.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("n_copies")).alias("mixed_tokens"),
        F.sum("n_copies").alias("mixed_records"),
        F.max("n_copies").alias("most_repeats"),
    )
    asked = spark.createDataFrame(
        wanted[["source", "target_share", "max_repeats", "size"]],
        "source string, target_share double, max_repeats int, size bigint",
    )
    every = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    report = (
        asked.join(got, "source", "left")
        .crossJoin(F.broadcast(every))
        .select(
            "source", "target_share", "max_repeats", "size",
            F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.coalesce("mixed_records", F.lit(0)).alias("mixed_records"),
            F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            (F.coalesce("mixed_tokens", F.lit(0)) / F.nullif("all_tokens", F.lit(0))).alias("actual_share"),
        )
    )
    return mixed, report
