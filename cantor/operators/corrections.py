"""Stored evidence against what it claims to come from: alignments of takes, human pairing corrections, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import identity
from cantor.operators.corpus import duplicates
from cantor.operators.events import review_event_id

TAKE = ("group_id", "take_index")
EVIDENCE = ("unit_id", "audio_sha256", "alignment_cache_key", "alignment_integrity_sha256")
FIELD = "pairing_selected_split"


def alignment_coverage_problems(takes: DataFrame, aligned: DataFrame) -> DataFrame:
    """(group_id, take_index, problem) where alignments don't cover the selected takes exactly.

    Both tables: group_id, take_index and EVIDENCE. Problems: DUPLICATE_ALIGNMENT, MISSING_ALIGNMENT,
    EXTRA_ALIGNMENT, EVIDENCE_DIFFERS.
    """
    again = duplicates(aligned, *TAKE).select(*TAKE, F.lit("DUPLICATE_ALIGNMENT").alias("problem"))
    own = takes.select(*TAKE, F.struct(*EVIDENCE).alias("wanted"))
    both = own.join(aligned.select(*TAKE, F.struct(*EVIDENCE).alias("found")).distinct(), list(TAKE), "full")
    problem = F.when(F.col("found").isNull(), "MISSING_ALIGNMENT").when(F.col("wanted").isNull(), "EXTRA_ALIGNMENT").when(~F.col("wanted").eqNullSafe(F.col("found")), "EVIDENCE_DIFFERS")
    return again.unionByName(both.select(*TAKE, problem.alias("problem")).filter("problem is not null").distinct())


def cached_alignment_problems(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """(cache_key, problem) of what a cache has for requests: NOT_ONE_RESULT, SEAL_BROKEN, PROVENANCE_DIFFERS.

    requests: cache_key and the columns of identity.RUNTIME; stored: those and integrity_sha256, and whatever
    else a result has. A request without a stored result is a miss, not a problem.
    """
    wanted = stored.join(requests.select("cache_key"), "cache_key", "left_semi")
    many = duplicates(wanted, "cache_key").select("cache_key", F.lit("NOT_ONE_RESULT").alias("problem"))
    broken = identity.broken_seals(wanted).select("cache_key", F.lit("SEAL_BROKEN").alias("problem")).distinct()
    runtime = identity.alignment_runtime_digest()
    sides = requests.select("cache_key", runtime.alias("wanted")).join(wanted.select("cache_key", runtime.alias("found")), "cache_key")
    other = sides.filter("wanted <> found").select("cache_key", F.lit("PROVENANCE_DIFFERS").alias("problem")).distinct()
    return many.unionByName(broken).unionByName(other)


def recomputed_differences(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows of cached evidence that recomputing doesn't give, and the reverse, with their side; repeated rows count."""
    names = stored.columns
    gone = stored.exceptAll(recomputed.select(names)).withColumn("side", F.lit("stored"))
    return gone.unionByName(recomputed.select(names).exceptAll(stored).withColumn("side", F.lit("recomputed")))


def pairing_entity_id(recording: Column, unit: Column) -> Column:
    return F.format_string("pairing:%d:%s:%d:%s", F.length(recording), recording, F.length(unit), unit)


def correction_bundle(outcomes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(path, content) of the files on which a person picks splits: the saved candidates and a template for each unit to review."""
    review = outcomes.filter("status = 'review'").select("recording_id", "unit_id")
    saved = candidates.join(review, ["recording_id", "unit_id"], "left_semi").groupBy("recording_id", "unit_id").agg(F.array_sort(F.collect_set(F.struct("split_sample", "score"))).alias("candidates"))
    rows = review.join(saved, ["recording_id", "unit_id"], "left")
    entity = pairing_entity_id(F.col("recording_id"), F.col("unit_id"))
    content = F.to_json(F.struct(entity.alias("entity_id"), F.coalesce("candidates", F.array().cast("array<struct<split_sample:bigint,score:double>>")).alias("candidates"), F.lit(None).cast("long").alias("selected_split"), F.lit("").alias("reason"), F.lit("").alias("reviewer")), {"ignoreNullFields": "false"})
    return rows.select(F.concat_ws("/", "recording_id", F.lit("pairing"), F.concat("unit_id", F.lit(".json"))).alias("path"), content.alias("content"))


def selection_problems(outcomes: DataFrame, candidates: DataFrame, selections: DataFrame) -> DataFrame:
    """(recording_id, unit_id, problem): selections (…, split_sample) must cover the units to review and pick one saved split.

    outcomes: recording_id, unit_id, status; candidates: recording_id, unit_id, split_sample. Problems:
    NOT_SELECTED, NOT_TO_REVIEW, SELECTED_TWICE, NO_SAVED_CANDIDATE, AMBIGUOUS_CANDIDATE.
    """
    key = ["recording_id", "unit_id"]
    review = outcomes.filter("status = 'review'").select(*key)
    named = lambda df, problem: df.select(*key, F.lit(problem).alias("problem"))
    saved = candidates.groupBy(*key, "split_sample").agg(F.count("*").alias("n"))
    picked = selections.select(*key, "split_sample").join(review, key, "left_semi").join(saved, [*key, "split_sample"], "left")
    wrong = picked.select(*key, F.when(F.col("n").isNull(), "NO_SAVED_CANDIDATE").when(F.col("n") > 1, "AMBIGUOUS_CANDIDATE").alias("problem")).filter("problem is not null")
    out = named(review.join(selections, key, "left_anti"), "NOT_SELECTED").unionByName(named(selections.join(review, key, "left_anti"), "NOT_TO_REVIEW"))
    return out.unionByName(named(duplicates(selections, *key), "SELECTED_TWICE")).unionByName(wrong)


def reviewed_pairing(outcomes: DataFrame, windows: DataFrame, candidates: DataFrame, selections: DataFrame) -> DataFrame:
    """Takes of corrected units: (recording_id, unit_id, group_id, take_index, start_sample, end_sample).

    Both takes of a window (recording_id, unit_id, start_sample, end_sample), cut at the split that a person
    picked among the saved ones. What selection_problems lists isn't in it; check that first.
    """
    key = ["recording_id", "unit_id"]
    saved = candidates.groupBy(*key, "split_sample").agg(F.count("*").alias("n")).filter("n = 1").drop("n")
    review = outcomes.filter("status = 'review'").select(*key)
    rows = selections.select(*key, "split_sample").join(review, key, "left_semi").join(saved, [*key, "split_sample"]).join(windows, key)
    cuts = F.array(F.struct(F.lit(1).alias("take_index"), "start_sample", F.col("split_sample").alias("end_sample")), F.struct(F.lit(2).alias("take_index"), F.col("split_sample").alias("start_sample"), "end_sample"))
    group = C.group_id(F.col("recording_id"), F.col("unit_id"))
    return rows.select(*key, group.alias("group_id"), F.explode(cuts).alias("t")).select(*key, "group_id", "t.*")


def correction_events(selections: DataFrame) -> DataFrame:
    """Review events that record selections (recording_id, unit_id, split_sample, reason, reviewer, reviewed_at)."""
    rows = selections.select(
        F.lit("1").alias("schema_version"), pairing_entity_id(F.col("recording_id"), F.col("unit_id")).alias("entity_id"), F.lit(FIELD).alias("field"), F.lit(None).cast("string").alias("before"),
        F.col("split_sample").cast("string").alias("after"), "reason", "reviewer", "reviewed_at",
    )
    return review_event_id(rows)


def correction_event_problems(selections: DataFrame, events: DataFrame) -> DataFrame:
    """(entity_id, problem): a correction's history must have one right event for each corrected unit and no other.

    Problems: MISSING_EVENT, ORPHAN_EVENT, DUPLICATE_EVENT, EVENT_DIFFERS (field, before, after or id).
    """
    wanted = selections.select(pairing_entity_id(F.col("recording_id"), F.col("unit_id")).alias("entity_id"), F.col("split_sample").cast("string").alias("split"))
    mine = events.filter(F.startswith("entity_id", F.lit("pairing:")))
    named = lambda df, problem: df.select("entity_id", F.lit(problem).alias("problem"))
    checked = review_event_id(mine.withColumnRenamed("review_event_id", "given")).join(wanted, "entity_id")
    right = (F.col("field") == FIELD) & F.col("before").isNull() & F.col("after").eqNullSafe(F.col("split")) & F.col("given").eqNullSafe(F.col("review_event_id"))
    out = named(wanted.join(mine, "entity_id", "left_anti"), "MISSING_EVENT").unionByName(named(mine.join(wanted, "entity_id", "left_anti"), "ORPHAN_EVENT"))
    return out.unionByName(named(duplicates(mine, "entity_id"), "DUPLICATE_EVENT")).unionByName(named(checked.filter(~F.coalesce(right, F.lit(False))), "EVENT_DIFFERS"))


def last_reviewed(events: DataFrame, key: str = "entity_id") -> DataFrame:
    """(key, reviewed_at): the latest time of each entity's reviews, as text, which is how they are ordered."""
    return events.groupBy(key).agg(F.max("reviewed_at").alias("reviewed_at"))


def segment_problems(segments: DataFrame, decisions: DataFrame) -> DataFrame:
    """(recording_id, group_id, take_index, problem): segments must be the approved takes exactly, each once.

    decisions: recording_id, group_id, take_index, decision.
    """
    key = ["recording_id", "group_id", "take_index"]
    approved = decisions.filter("decision = 'approved'").select(*key).distinct()
    named = lambda df, problem: df.select(*key, F.lit(problem).alias("problem"))
    out = named(segments.join(approved, key, "left_anti").distinct(), "NOT_APPROVED").unionByName(named(approved.join(segments, key, "left_anti"), "NO_SEGMENT"))
    return out.unionByName(named(duplicates(segments, *key), "DUPLICATE_SEGMENT"))


def stale_words(takes: DataFrame) -> DataFrame:
    """Takes whose reviewed or aligned words aren't the expected ones, case aside (string arrays reviewed, aligned, expected)."""
    problem = F.when(~C.same_words(F.col("reviewed"), F.col("expected")), "REVIEWED_WORDS_STALE").when(~C.same_words(F.col("aligned"), F.col("expected")), "ALIGNED_WORDS_STALE")
    return takes.withColumn("problem", problem).filter("problem is not null")
