"""Quality audit of gold rows, and the KPI report with its verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.functions import tables as T

#: The audit's policy.
MINIMUM_TOTAL = 320
CATEGORY_MINIMUMS = {"vowels": 20, "diphthongs": 20, "consonants": 100, "syllabification": 40, "stress": 60, "orthographic_variants": 30, "liturgical": 50}
GOLD = "word string, normalized string, syllables array<string>, stress_index int, ipa string, category string, rule_ids array<string>, source_ids array<string>, review_state string"
RATE = 16000


def histogram(rows: DataFrame, column: str, allowed: list[str] | None = None) -> DataFrame:
    """Counts by value in order; with ``allowed``, other values are errors."""
    if allowed is not None:
        rows = rows.withColumn(column, F.when(F.col(column).isin(allowed), F.col(column)).otherwise(F.raise_error(F.concat(F.lit("unknown code: "), F.col(column))).cast("string")))
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def policy_errors(counts: DataFrame, total: DataFrame, minimums: dict[str, int], minimum_total: int) -> DataFrame:
    """(code, detail) for totals and categories under their minimum; a missing category counts 0.

    counts: category, n; total: one row, n.
    """
    policy = counts.sparkSession.createDataFrame(list(minimums.items()), "category string, minimum long")
    short = policy.join(counts, "category", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < minimum")
    cats = short.select(F.lit("CATEGORY_MINIMUM_NOT_MET").alias("code"), F.format_string("%s: %d < %d", "category", "n", "minimum").alias("detail"))
    return cats.union(total.filter(F.col("n") < minimum_total).select(F.lit("TOTAL_MINIMUM_NOT_MET").alias("code"), F.col("n").cast("string").alias("detail")))


def audit_gold(rows: DataFrame, minimums: dict[str, int] | None = None, minimum_total: int = MINIMUM_TOTAL) -> DataFrame:
    """(code, detail) of all problems; rows: line, valid, and the fields of GOLD (those of invalid rows are null)."""
    good = rows.filter("valid")
    blank = lambda c: F.trim(c) == ""
    empty = F.lit(False)
    for c in ("word", "normalized", "ipa", "category", "review_state"):
        empty = empty | blank(F.col(c))
    for c in ("syllables", "rule_ids", "source_ids"):
        empty = empty | (F.size(c) == 0) | F.exists(c, blank)
    line = F.format_string("line %d", "line")
    known = F.array(*[F.lit(s) for s in T.SOURCES])
    tests = {
        "EMPTY_FIELD": (empty, line), "INVALID_STRESS": (~F.col("stress_index").between(0, F.size("syllables") - 1), F.col("word")),
        "UNAPPROVED_ENTRY": (F.col("review_state") != "approved", F.col("word")), "MISSING_PROVENANCE": ((F.size("rule_ids") == 0) | (F.size("source_ids") == 0), F.col("word")),
    }
    found = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(code).alias("code"), detail.alias("detail"))) for code, (test, detail) in tests.items()]))
    out = rows.filter("not valid").select(F.lit("INVALID_ROW").alias("code"), line.alias("detail"))
    out = out.union(good.select(F.explode(found).alias("e")).select("e.code", "e.detail"))
    out = out.union(good.select("word", F.explode(F.array_sort(F.array_except("source_ids", known))).alias("s")).select(F.lit("UNKNOWN_SOURCE"), F.concat("word", F.lit(": "), "s")))
    again = good.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1").select("word", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))))
    out = out.union(again.select(F.lit("DUPLICATE_WORD"), "word"))
    counts = good.groupBy("category").agg(F.count("*").alias("n"))
    return out.union(policy_errors(counts, rows.agg(F.count("*").alias("n")), CATEGORY_MINIMUMS if minimums is None else minimums, minimum_total))


def readiness(auto: Column, boundary: Column, review: Column, approved: Column) -> Column:
    """not_ready, optimize or scalable."""
    red = (auto < 0.85) | (boundary < 0.70) | (review > 6.0) | (approved < 0.60)
    green = (auto >= 0.95) & (boundary >= 0.85) & (review <= 3.0) & (approved >= 0.80)
    return F.when(red, "not_ready").when(green, "scalable").otherwise("optimize")


def rejection_reasons(events: DataFrame) -> DataFrame:
    """Histogram of the reason of the last rejection of each take that ends up rejected."""
    last = events.filter("field = 'review_decision'").groupBy("entity_id").agg(F.max_by("after", "seq").alias("decision"), F.max_by("reason", "seq").alias("reason"))
    return histogram(last.filter("decision = 'rejected'"), "reason")


def kpi_report(recordings: DataFrame, speech: DataFrame, groups: DataFrame, takes: DataFrame, events: DataFrame, telemetry: DataFrame) -> DataFrame:
    """One row of metrics, with the verdict.

    recordings: recording_id, duration_seconds, selected; speech: start, end (16 kHz samples); groups:
    automatic; takes: entity_id, decision, seconds; events: entity_id, field; telemetry: one row. A
    denominator of 0 is an error. Each table is aggregated alone; only one-row results are joined.
    """
    chosen = F.col("selected")
    r = recordings.agg(F.sum(F.when(chosen, F.col("duration_seconds"))).alias("input_seconds"), F.sum("duration_seconds").alias("full_seconds"), F.sum(chosen.cast("int")).alias("n_recordings"))
    s = speech.agg((F.sum(F.col("end") - F.col("start")) / RATE).alias("speech_seconds"))
    g = groups.agg(F.count("*").alias("n_groups"), F.sum(F.col("automatic").cast("int")).alias("n_automatic"))
    moved = events.filter("field in ('segment_start', 'segment_end')").select("entity_id").distinct().withColumn("_moved", F.lit(True))
    decided = F.col("decision").isin("approved", "rejected")
    by = [F.sum(F.when(F.col("decision") == d, F.col("seconds")).otherwise(0.0)).alias(f"{d}_seconds") for d in ("approved", "rejected", "unreviewed")]
    t = takes.join(moved, "entity_id", "left").agg(F.count("*").alias("n_takes"), F.sum(decided.cast("int")).alias("n_decided"), F.sum((decided & F.col("_moved").isNull()).cast("int")).alias("n_unchanged"), *by)
    one = r.crossJoin(s).crossJoin(g).crossJoin(t).crossJoin(telemetry)  # one row each

    def ratio(a: Column, b: Column, name: str) -> Column:
        return F.when(F.coalesce(b, F.lit(0)) > 0, a / b).otherwise(F.raise_error(F.lit(f"{name}: denominator must be positive")).cast("double")).alias(name)

    total = F.col("approved_seconds") + F.col("rejected_seconds") + F.col("unreviewed_seconds")
    scaled = one.select("*", ratio(F.col("n_automatic"), F.col("n_groups"), "auto_pairing_ratio"), ratio(F.col("n_unchanged"), F.col("n_decided"), "boundary_unchanged_ratio"), ratio(F.col("review_seconds"), F.col("input_seconds"), "review_ratio"), ratio(F.col("approved_seconds"), total, "approved_ratio"), ratio(F.col("alignment_wall_seconds"), F.col("input_seconds"), "gpu_rtf"), ratio(F.col("full_seconds"), F.col("input_seconds"), "scale"))
    scaled = scaled.withColumn("person_hours", (F.col("text_preparation_seconds") + F.col("review_seconds")) * F.col("scale") / 3600).withColumn("gpu_hours", F.col("alignment_wall_seconds") * F.col("scale") / 3600)
    scaled = scaled.withColumn("storage_bytes", F.ceil(F.col("pilot_storage_bytes") * F.col("scale")))
    verdict = F.when(F.col("unreviewed_seconds") > 0, "not_ready").otherwise(readiness(F.col("auto_pairing_ratio"), F.col("boundary_unchanged_ratio"), F.col("review_ratio"), F.col("approved_ratio")))
    return scaled.withColumn("verdict", verdict)
