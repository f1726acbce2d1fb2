"""Half-open sample intervals: gaps, checks, pause classes, windows of text units, and the split of takes."""

from __future__ import annotations

import math
import statistics

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantor.functions import columns as C

#: The pilot's defaults.
PAUSES = {"minimum_gap_ms": 100, "minimum_gap_count": 4, "separation_ratio": 1.8, "maximum_iterations": 50, "minimum_cluster_size": 2, "maximum_cluster_imbalance_ratio": 3.0}
SPLITS = {"minimum_ratio": 0.65, "maximum_ratio": 1.35, "minimum_score_margin": 0.02}


def gaps(intervals: DataFrame, key: str, minimum_gap_ms: Column | int = 0, rate: Column | int = 1000) -> DataFrame:
    """(key, start, end) of the silence between neighbours, by integer arithmetic."""
    w = Window.partitionBy(key).orderBy("start", "end")
    rows = intervals.select(key, "start", "end", F.lead("start").over(w).alias("next"))
    least = minimum_gap_ms if isinstance(minimum_gap_ms, Column) else F.lit(minimum_gap_ms)
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    rows = rows.filter(F.col("next").isNotNull() & ((F.col("next") - F.col("end")) * 1000 >= least.cast("long") * rate.cast("long")) & (F.col("next") > F.col("end")))
    return rows.select(key, F.col("end").alias("start"), F.col("next").alias("end"))


def order_violations(intervals: DataFrame, key: str) -> DataFrame:
    """Intervals that are empty or begin before the one before has ended."""
    w = Window.partitionBy(key).orderBy("start", "end")
    return intervals.withColumn("previous_end", F.lag("end").over(w)).filter((F.col("end") <= F.col("start")) | (F.col("previous_end") > F.col("start")))


def contiguity_violations(units: DataFrame, key: str) -> DataFrame:
    """Units whose token ranges don't follow on each other from 0, or whose ordinals skip."""
    w = Window.partitionBy(key).orderBy("ordinal")
    return units.withColumn("_end", F.lag("token_end", 1, 0).over(w)).withColumn("_n", F.row_number().over(w)).filter((F.col("_end") != F.col("token_start")) | (F.col("_n") != F.col("ordinal")) | (F.col("token_end") <= F.col("token_start"))).drop("_end", "_n")


def frame_grid(recordings: DataFrame, key: str, samples: str, window: int = 512) -> DataFrame:
    """Consecutive analysis windows; the last one may be short."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({samples} - 1) div {window}"))).alias("frame")
    rows = recordings.filter(F.col(samples) > 0).select(key, samples, at)
    return rows.select(key, "frame", (F.col("frame") * window).alias("start"), F.least(F.col(samples), (F.col("frame") + 1) * window).alias("end"))


def two_means(seconds: list[float], p: dict) -> tuple[str, float | None]:
    """(status, threshold) of the gaps' lengths: 2-means of their logarithms, from the quartiles.

    Ties go to the short class. Stops when labels and centres repeat, or after the given rounds.
    """
    if len(seconds) < p["minimum_gap_count"]:
        return "PAUSE_CLASSES_AMBIGUOUS", None
    logs = [math.log(s) for s in seconds]
    ranked = sorted(logs)
    centres = (ranked[len(logs) // 4], ranked[3 * len(logs) // 4])
    labels: list[bool] = []
    for _ in range(p["maximum_iterations"]):
        now = [abs(x - centres[1]) < abs(x - centres[0]) for x in logs]
        sides = [[x for x, long in zip(logs, now, strict=True) if long is side] for side in (False, True)]
        if not all(sides):
            return "PAUSE_CLASSES_AMBIGUOUS", None
        means = tuple(map(statistics.fmean, sides))
        done = now == labels and means == centres
        labels, centres = now, means
        if done:
            break
    short, long = ([s for s, label in zip(seconds, labels, strict=True) if label is side] for side in (False, True))
    few, many = sorted((len(short), len(long)))
    middle = statistics.median(short), statistics.median(long)
    if few < p["minimum_cluster_size"] or many / few > p["maximum_cluster_imbalance_ratio"] or middle[1] / middle[0] < p["separation_ratio"]:
        return "PAUSE_CLASSES_AMBIGUOUS", None
    return "ok", math.sqrt(middle[0] * middle[1])


def classify_pauses(pauses: DataFrame, key: str, rate: int, **parameters: float) -> DataFrame:
    """(key, status, threshold_s, start, end, kind): a row per gap, or one without a gap if the classes are unclear.

    The class is by the threshold, not by the cluster. A recording's gaps are one group (hours of speech are
    thousands of gaps); recordings are spread over the cluster.
    """
    p = PAUSES | parameters
    if p["minimum_gap_count"] < 2 * p["minimum_cluster_size"]:
        raise ValueError("minimum_gap_count must be at least twice minimum_cluster_size")
    kind = pauses.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"])
        seconds = ((pdf["end"] - pdf["start"]) / rate).tolist()
        status, threshold = two_means(seconds, p)
        if threshold is None:
            return pd.DataFrame({key: pdf[key].iloc[:1], "status": [status], "threshold_s": [None], "start": [None], "end": [None], "kind": [None]})
        return pd.DataFrame({key: pdf[key], "status": status, "threshold_s": threshold, "start": pdf["start"], "end": pdf["end"], "kind": ["short" if s < threshold else "long" for s in seconds]})

    return pauses.select(key, "start", "end").groupBy(key).applyInPandas(one, f"{key} {kind}, status string, threshold_s double, start long, end long, kind string")


def unit_windows(speech: DataFrame, pauses: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """(key, ordinal, start, end, status, short_pauses): the n-th unit gets the n-th window between long pauses.

    Windows run from the first speech to the last, cut at the midpoints of long pauses. A recording whose
    windows and units differ in number is a TRANSCRIPT_SPOKEN_MISMATCH. Pauses inside a window are found by
    their window's number (long pauses before them), an equi-join, not by a range join.
    """
    w = Window.partitionBy(key).orderBy("start", "end")
    bounds = speech.groupBy(key).agg(F.min("start").alias("first"), F.max("end").alias("last"))
    long = F.col("kind") == "long"
    marked = pauses.withColumn("ordinal", F.sum(long.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    cuts = marked.filter(long).select(key, "ordinal", C.midpoint(F.col("start"), F.col("end")).alias("cut"))
    edges = bounds.select(key, F.lit(1).alias("ordinal"), F.col("first").alias("start"), "last").unionByName(cuts.join(bounds, key).select(key, "ordinal", F.col("cut").alias("start"), "last"))
    by = Window.partitionBy(key).orderBy("ordinal")
    windows = edges.withColumn("end", F.coalesce(F.lead("start").over(by), "last")).drop("last")
    shorts = marked.filter(F.col("kind") == "short").groupBy(key, "ordinal").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("short_pauses"))
    both = windows.join(units.select(key, "ordinal", "unit_id", "text"), [key, "ordinal"], "full")
    whole = Window.partitionBy(key)
    mismatch = F.max((F.col("start").isNull() | F.col("unit_id").isNull()).cast("int")).over(whole) == 1
    both = both.withColumn("status", F.when(mismatch, "TRANSCRIPT_SPOKEN_MISMATCH").otherwise("ok")).join(shorts, [key, "ordinal"], "left")
    inside = F.filter(F.coalesce("short_pauses", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda p: (p["start"] >= F.col("start")) & (p["end"] <= F.col("end")))
    return both.withColumn("short_pauses", inside)


def split_candidates(windows: DataFrame, key: str) -> DataFrame:
    """A row per window and short pause: the takes before and after its midpoint."""
    rows = windows.filter("status = 'ok'").select(key, "unit_id", "start", "end", F.explode("short_pauses").alias("p"))
    return rows.select(key, "unit_id", "start", "end", C.midpoint(F.col("p.start"), F.col("p.end")).alias("split"))


def choose_split(windows: DataFrame, evidence: DataFrame, keys: list[str], **parameters: float) -> DataFrame:
    """(keys, outcome, split, first_end, second_start): the best split of each window, or why there is none.

    Candidates (split, first_score, second_score, word_order_same, coverage) rank by their lower score, then
    coverage, then the earlier split.
    """
    p = SPLITS | parameters
    e = evidence.withColumn("score", F.least("first_score", "second_score"))
    usable = F.col("word_order_same")
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("coverage").desc(), F.col("split"))
    ranked = e.filter(usable).withColumn("_n", F.row_number().over(w)).withColumn("_next", F.lead("score").over(w)).withColumn("_cover", F.lead("coverage").over(w)).filter("_n = 1")
    n = e.groupBy(*keys).agg(F.count("*").alias("n_candidates"))
    rows = windows.select(*keys, "start", "end").join(n, keys, "left").join(ranked.select(*keys, "split", "score", "coverage", "_next", "_cover"), keys, "left")
    ratio = (F.col("split") - F.col("start")) / (F.col("end") - F.col("split"))
    tie = (F.col("score") == F.col("_next")) & (F.col("coverage") == F.col("_cover"))
    outcome = (
        F.when(F.col("n_candidates").isNull(), "TAKE_COUNT_MISMATCH")
        .when(F.col("split").isNull(), "TAKE_TEXT_MISMATCH")
        .when(F.col("_next").isNotNull() & (tie | (F.col("score") - F.col("_next") < p["minimum_score_margin"])), "TAKE_COUNT_MISMATCH")
        .when(~ratio.between(p["minimum_ratio"], p["maximum_ratio"]), "TAKE_DURATION_MISMATCH")
        .otherwise("selected")
    )
    rows = rows.withColumn("outcome", outcome)
    return rows.withColumn("split", F.when(F.col("outcome") == "selected", F.col("split"))).select(*keys, "start", "end", "outcome", "split", "score")


def foreign_splits(evidence: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Evidence for a split that is no midpoint of a short pause of its window."""
    return evidence.join(candidates.select(*keys, "split"), [*keys, "split"], "left_anti")
