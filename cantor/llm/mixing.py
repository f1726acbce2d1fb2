"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic); the cells' weights are raked in turn to the target of
each marginal until they agree; a document is then kept with its cell's calibrated probability. Only
DataFrame functions are used. The iteration works on the cell table; texts are never shuffled for it.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantor.llm.common import Scratch, fresh

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its share of tokens to this power, scaled to a sum of 1.
TEMPER = {"source": 0.8, "lang": 0.9, "topic": 0.9}
NONE = "\x00none"
#: What speaks for a topic, words (in lower case) or characters.
TOPIC_CUES = {
    "legal": ("licen", "copyright", "lizenz"),
    "contact": ("@",),
    "technical": ("=", "{", "<"),
    "speech": ("?", "!"),
}
#: Tokens that the weights are laid out for, as a share of the corpus's tokens: more of them keep more
#: documents, and leave more cells too small for their share.
BUDGET = 0.8
#: Cells up to which the raking stays in one task, without exchanges; beyond it, marginals are aggregated and joined.
ONE_TASK_CELLS = 100_000
ROUNDS, BATCH, TOLERANCE = 60, 6, 1e-6


def topic_of(text: Column) -> Column:
    """A coarse topic by fixed lexical cues: that with most cues, of equals the first; without any, general."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    level = F.lower(t)

    def times(cue: str) -> Column:
        """How often a cue of ASCII letters stands in the text: by how much it is shorter without them."""
        x = level if cue.isalpha() else t
        return ((F.octet_length(x) - F.octet_length(F.replace(x, F.lit(cue), F.lit("")))) / len(cue)).cast("int")

    found = {name: functools.reduce(lambda a, b: a + b, map(times, cues)) for name, cues in TOPIC_CUES.items()}
    ranked = [F.struct(n.alias("n"), F.lit(-i).alias("turn"), F.lit(name).alias("name")) for i, (name, n) in enumerate([("general", F.lit(0)), *found.items()])]
    return F.greatest(*ranked)["name"]


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def rake(cells: DataFrame, temper: dict[str, float] | None = None, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Adds ``weight`` to cells (source, lang, topic, tokens, ...): raked token weights that sum to 1.

    targets: given shares of a dimension's values; those it doesn't name share the rest of 1, tempered, as
    all do in dimensions left out; shares of more than 1 in all are scaled to it. Cells without tokens have weight 0. Stops when every marginal is met to TOLERANCE, or after
    ROUNDS rounds (targets that no weights can meet).
    """
    temper = TEMPER | (temper or {})
    spark = cells.sparkSession
    scratch = Scratch(spark, "mixing")
    cells = scratch.save(cells, "cells")
    whole = cells.count() <= ONE_TASK_CELLS
    if whole:
        cells = cells.coalesce(1)

    def with_sums(cells: DataFrame, name: str, **sums: Column) -> DataFrame:
        """Aggregates of the cells that share a value of a dimension; joined ones combine before they shuffle."""
        if whole:
            return cells.withColumns({k: v.over(Window.partitionBy(name)) for k, v in sums.items()})
        return cells.join(scratch.save(cells.groupBy(name).agg(*[v.alias(k) for k, v in sums.items()]), f"sums-{uuid.uuid4().hex[:8]}"), name)

    for name in DIMENSIONS:
        cells = with_sums(cells, name, _tokens=F.sum("tokens"), **{f"_n_{name}": F.count("*")})
        goal = F.pow("_tokens", F.lit(temper[name]))
        given = (targets or {}).get(name) or {}
        share = F.try_element_at(F.create_map(*[F.lit(x) for kv in given.items() for x in (kv[0], float(kv[1]))]), F.col(name)) if given else F.lit(None).cast("double")
        some = F.col("_tokens") > 0
        cells = cells.withColumns({f"_given_{name}": F.when(some, share), f"_goal_{name}": F.when(some & share.isNull(), goal).otherwise(0.0)}).drop("_tokens")
    if not whole:
        cells = scratch.save(cells, "goals")
    once = [F.sum(F.coalesce(f"_{what}_{d}", F.lit(0.0)) / F.col(f"_n_{d}")).alias(f"{what}_{d}") for d in DIMENSIONS for what in ("given", "goal")]
    totals = cells.agg(*once, F.sum("tokens").alias("tokens")).first()
    goals = {}
    for d in DIMENSIONS:
        given, rest = totals[f"given_{d}"] or 0.0, totals[f"goal_{d}"] or 0.0
        left = max(0.0, 1 - given) / rest if rest else 0.0
        goals[d] = F.coalesce(f"_given_{d}", F.col(f"_goal_{d}") * F.lit(left)) / F.lit(given + left * rest or 1.0)
    cells = cells.select(*[c for c in cells.columns if not c.startswith("_")], *[goals[d].alias(f"_goal_{d}") for d in DIMENSIONS])
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(float(totals["tokens"] or 1)))
    done = 0
    while done < ROUNDS:
        for _ in range(BATCH):
            for name in DIMENSIONS:
                cells = with_sums(cells, name, _now=F.sum("weight"))
                cells = cells.withColumn("weight", F.when(F.col("_now") > 0, F.col("weight") * F.col(f"_goal_{name}") / F.col("_now")).otherwise(0.0)).drop("_now")
        done += BATCH
        cells = scratch.save(cells, f"round{done}")
        if whole:
            cells = cells.coalesce(1)
        gaps = cells
        for name in DIMENSIONS:
            gaps = with_sums(gaps, name, _now=F.sum("weight")).withColumn(f"_gap_{name}", F.abs(F.col("_now") - F.col(f"_goal_{name}"))).drop("_now")
        worst = gaps.agg(F.max(F.greatest(*[f"_gap_{d}" for d in DIMENSIONS])).alias("gap")).first()["gap"]
        if worst is None or worst <= TOLERANCE:
            break
    return cells.drop(*[f"_goal_{d}" for d in DIMENSIONS])


def mix(docs: DataFrame, seed: int = 11, temper: dict[str, float] | None = None, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """Columns of ``docs`` with topic (kept if there is one), n_tokens, probability and kept.

    probability: the cell's share of ``budget`` times the corpus's tokens, by its raked weight, over its own
    tokens, and 1 at most. A cell with more tokens than its share is brought down to it in expectation, one
    with fewer is kept whole and falls short of its share; no document is repeated. A rare cell changes the
    rates of others by its share of the weights only. kept compares it with a hash of doc_id and seed, so it is the same
    on every run and for repeated rows; rows without a doc_id are told apart by their texts. Null sources, languages and topics are values of their own. Documents
    without tokens are in cells like any other; a cell that has no tokens at all keeps nothing.
    """
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(F.col("text"))
    names = [c for c in docs.columns if c not in ("topic", "n_tokens", "probability", "kept")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], topic.alias("topic"), token_count(F.col("text")).alias("n_tokens"))
    keys = {d: F.coalesce(F.col(d).cast("string"), F.lit(NONE)) for d in DIMENSIONS}
    cells = rows.select(*[k.alias(d) for d, k in keys.items()], "n_tokens").groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    raked = rake(cells, temper, targets).withColumn("_ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0))
    tokens = raked.agg(F.sum("tokens")).first()[0] or 0
    own = {d: fresh(rows, d) for d in DIMENSIONS}
    odds = raked.select(*[F.col(d).alias(own[d]) for d in DIMENSIONS], F.least(F.lit(1.0), F.col("_ratio") * F.lit(float(budget * tokens))).alias("probability"))
    for d in DIMENSIONS:
        rows = rows.withColumn(own[d], keys[d])
    rows = rows.join(odds, list(own.values()), "left").drop(*own.values())
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")), F.lit(seed)), 11) / F.lit(float(1 << 53))
    return rows.withColumn("kept", chance < F.col("probability"))
