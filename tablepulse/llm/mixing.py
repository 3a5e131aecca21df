"""Mixing sources to target weights by balanced (cube) sampling.

Each source's target is its share of all words, at most ``most_repeats`` times
its own size, with the excess shared again by weight. A document of a source
with target/size = r is taken floor(r) times, and once more with inclusion
probability r - floor(r). The extra takes are chosen by the cube method: the
vector of probabilities moves through the null space of two constraints, words
and documents, until units become 0 or 1, so both totals stay at their expected
values.

The flight runs in parallel: each source is dealt to cells of about
``CELL_UNITS`` units, each cell flies until fewer than three units are still
fractional (two constraints), and these survivors, with their probabilities,
are dealt to cells of the next, smaller level, until a source fits into one
cell. There the last two land together with ``LANDING_UNITS`` units of all
sizes that were kept back: of all their outcomes the one with the words nearest
to the expectation. A source with a third of all rows
is many cells; no cell grows with the input.

The random directions come from a generator seeded by the source's position
and the cell, and units are sorted by id within a cell, so reruns agree.

Defined cases: null text has size 0; a null source is a source of its own that
comes last; documents of size 0 take 0 words; an empty table gives no rows; a
mix without words has targets 0. Rows that repeat an id are units of their own;
equal ones (same id, size) are interchangeable. A null id sorts first in its
cell. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.functions.sequence import with_sequence
from tablepulse.llm.common import WORD, filled
from tablepulse.session import checkpointed

#: weights of the sources in their order, repeating
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
CELL_UNITS = 512
#: units of a source that skip the flight and land together with the two that it leaves
LANDING_UNITS = 12
EPS = 1e-9


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text)."""
    return docs.select("doc_id", "source", F.regexp_count(filled("text"), F.lit(WORD)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """source, place (position among the sources), source_size, target: one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_sequence(per, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    per = checkpointed(placed.withColumn("weight", weight).withColumn("most", (F.col("source_size") * most_repeats).cast("double")))
    total = float(per.agg(F.sum("source_size")).first()[0] or 0)
    # sources that reach their limit leave the sharing; the rate of the others can only rise, so this ends
    rate, at_limit = 0.0, -1
    while True:
        full = F.col("weight") * rate >= F.col("most")
        n, held, open_weight = per.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight or n == at_limit:
            break
        at_limit, rate = n, max(rate, (total - (held or 0.0)) / open_weight)
    return per.select("source", "place", "source_size", F.least(F.col("weight") * rate, F.col("most")).alias("target"))


def flight(p: list[float], size: list[int], rng: np.random.Generator) -> list[float]:
    """Move probabilities through the null space of (words, documents) until fewer than three are fractional."""
    p = [0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x for x in p]
    waiting = iter([i for i, x in enumerate(p) if 0 < x < 1])
    held, draws = list(islice(waiting, 3)), iter(())
    while len(held) == 3:
        a, b, c = held
        # a vector with sum 0 and, weighed by size, sum 0
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(u):
            u = (1, -1, 0)
        up = min(((1 - p[i]) if d > 0 else p[i]) / abs(d) for i, d in zip(held, u, strict=True) if d)
        down = min((p[i] if d > 0 else (1 - p[i])) / abs(d) for i, d in zip(held, u, strict=True) if d)
        if (draw := next(draws, None)) is None:
            draws = iter(rng.random(1024).tolist())
            draw = next(draws)
        # the expected step is 0, so that every unit keeps its inclusion probability
        step = up if draw * (up + down) < down else -down
        rest = []
        for i, d in zip(held, u, strict=True):
            x = p[i] + step * d
            p[i] = 0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x
            if 0 < p[i] < 1:
                rest.append(i)
        held = rest + list(islice(waiting, 3 - len(rest)))
    return p


def landing(p: list[float], size: list[int]) -> list[float]:
    """Round the last fractional units: of all their outcomes the nearest in words, then in documents."""
    open_ = [i for i, x in enumerate(p) if 0 < x < 1]
    outcomes = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    moved = outcomes - np.array([p[i] for i in open_])
    words = np.abs(moved @ np.array([size[i] for i in open_], float)).round(3)
    best = np.lexsort((np.arange(len(outcomes)), np.abs(moved.sum(axis=1)).round(6), words))[0]
    landed = list(p)
    for i, x in zip(open_, outcomes[best].tolist(), strict=True):
        landed[i] = float(x)
    return landed


def _fly(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["size", "doc_id", "copy"], ascending=[False, True, True], kind="stable")
        seed = [int(cell[c].iloc[0]) for c in ("place", "cell", "level")]
        size, p = cell["size"].tolist(), cell["p"].tolist()
        # a few units of all sizes wait for the landing, where they can make up for the last large one
        waiting = {int(k) for k in np.linspace(0, len(p) - 1, min(len(p), LANDING_UNITS))} if last else set()
        flying = [i for i in range(len(p)) if i not in waiting]
        for i, x in zip(flying, flight([p[i] for i in flying], [size[i] for i in flying], np.random.default_rng(seed)), strict=True):
            p[i] = x
        return cell.assign(p=landing(p, size) if last else p)

    return run


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, cell_units: int = CELL_UNITS) -> DataFrame:
    """doc_id, source, size, copy, source_size, target, times, taken: one row per document.

    ``copy`` tells rows with the same doc_id, source and size apart; ``times`` says how often the mix takes the document.
    """
    sizes = sized(docs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = targets(sizes, weights, most_repeats).withColumns({"whole": F.floor(rate + EPS), "p": rate - F.floor(rate + EPS)})
    per = checkpointed(per)
    each = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    each = each.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    # sources are few next to documents but not bounded: the planner chooses the join by their size
    units = each.join(per.select(F.col("source").alias("_source"), "place", "p"), F.col("source").eqNullSafe(F.col("_source")))
    p = F.when((F.col("p") < EPS) | (F.col("size") == 0), 0.0).otherwise(F.col("p"))
    flying = checkpointed(units.select("place", "doc_id", "size", "copy", p.alias("p")))
    settled = flying.where("p = 0")
    flying = flying.where("p > 0")
    level = 0
    while most := flying.groupBy("place").count().agg(F.max("count")).first()[0]:
        last = most <= cell_units
        cell = F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit(level)), F.lit(-(-most // cell_units)))
        cells = flying.withColumns({"cell": cell, "level": F.lit(level)})
        schema = ", ".join(f"{n} {t}" for n, t in cells.dtypes)
        flown = checkpointed(cells.groupBy("place", "cell").applyInPandas(_fly(last), schema).drop("cell", "level"))
        settled = settled.unionByName(flown.where("p = 0 or p = 1"))
        if last:
            break
        flying = flown.where("p > 0 and p < 1")
        level += 1
    times = (F.col("whole") + F.col("settled.p")).cast("long")
    both = settled.alias("settled").join(per.alias("per"), "place")
    return both.select(
        "doc_id", "source", "size", "copy", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken")
    )


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, cell_units: int = CELL_UNITS) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    key = ["__doc_id", "__source", "__size"]
    picks = mixed(docs, weights, most_repeats, cell_units).select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "source", "size", "copy", "times")])
    picks = checkpointed(picks)
    # a row per key; of a key with one document also how often it is taken
    keys = checkpointed(picks.groupBy(*key).agg(F.max("__copy").alias("__copies"), F.max("__times").alias("__once")))
    keyed = docs.withColumn("__words", F.regexp_count(filled("text"), F.lit(WORD)).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size"))
    keyed = keyed.join(keys, same)
    single = keyed.where("__copies = 1").withColumn("__n", F.col("__once")).select(*docs.columns, "__n")
    # documents that share a key are numbered by a sort over all tasks: no task gets all of a key
    several = keyed.where("__copies > 1").select(*docs.columns, *key)
    numbered = with_sequence(several, [*[F.col(c).asc_nulls_last() for c in key], F.col("text"), F.rand(0)], "__seq")
    first = checkpointed(numbered.groupBy(*key).agg(F.min("__seq").alias("__first")))
    numbered = _by_key(numbered, first, key).withColumn("__copy", F.col("__seq") - F.col("__first") + 1)
    several = _by_key(numbered, picks.select(*key, "__copy", F.col("__times").alias("__n")), [*key, "__copy"]).select(*docs.columns, "__n")
    taken = single.unionByName(several).where("__n > 0")
    return taken.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)


def _by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys of which some may be null; the right one's keys go."""
    other = right.select(*[F.col(c).alias(f"{c}_r") if c in keys else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_r"))
    return left.join(other, same).drop(*[f"{c}_r" for c in keys])
