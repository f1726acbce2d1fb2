"""What a journal's events rest on: terminal evidence and its attestations, and whole processing histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.operators.corpus import duplicates
from cantor.operators.events import event_existence, event_id, journal_problems

#: Evidence that a terminal event's inputs name, in order, by version; and its marker.
INPUTS = {
    "v2": ("recording_sha256", "inventory_sha256", "rights_sha256", "transcripts_sha256", "pairing_sha256", "alignment_sha256", "review_sha256", "segments_sha256"),
    "v1": ("recording_sha256", "rights_sha256", "transcripts_sha256", "pairing_sha256", "alignment_sha256", "review_sha256", "segments_sha256"),
    "legacy": ("recording_sha256", "pairing_sha256", "alignment_sha256", "review_sha256", "segments_sha256"),
}
MARKERS = {"v2": "approved-manifest-v2", "v1": "approved-manifest-v1", "legacy": "approved-manifest-v1"}


def evidence_version(marker: Column, inputs: Column) -> Column:
    """v2, v1 or legacy by an event's marker and number of inputs; null for any other."""
    out = F.lit(None).cast("string")
    for name, fields in INPUTS.items():
        out = F.when((marker == MARKERS[name]) & (F.size(inputs) == len(fields)), name).otherwise(out)
    return out


def _bound(version: Column, inputs: Column) -> Column:
    """Whether inputs are the current evidence (columns of INPUTS["v2"]) in the order of the version."""
    out = F.lit(False)
    for name, fields in INPUTS.items():
        out = F.when(version == name, inputs.eqNullSafe(F.array(*fields))).otherwise(out)
    return out


def terminal_problems(recordings: DataFrame, events: DataFrame, attestations: DataFrame) -> DataFrame:
    """(recording_id, problem) of the terminal events of finished recordings.

    recordings: recording_id, state and the evidence columns; events: event_id, recording_id, previous_state,
    target_state, input_sha256s, tool_versions (array); attestations: terminal_event_id, recording_id and an
    evidence event's input_sha256s and tool_versions. An event must name the evidence of its version; an old
    version needs one attestation of the present one, and there may be no other attestation.
    """
    version = lambda: evidence_version(F.get("tool_versions", F.lit(0)), F.col("input_sha256s"))
    last = events.filter("previous_state = 'REVIEWED'").withColumn("version", F.when(F.size("tool_versions") == 2, version()))
    rows = recordings.join(last.withColumnRenamed("target_state", "state"), ["recording_id", "state"], "left")
    named = lambda df, problem: df.select("recording_id", F.lit(problem).alias("problem"))
    once = rows.groupBy("recording_id").agg(F.count("event_id").alias("n"))
    out = named(once.filter("n <> 1"), "NOT_ONE_TERMINAL_EVENT")
    found = rows.filter("event_id is not null")
    problem = F.when(F.col("version").isNull(), "UNSUPPORTED_VERSION").when(~_bound(F.col("version"), F.col("input_sha256s")), "EVIDENCE_DIFFERS")
    out = out.unionByName(found.select("recording_id", problem.alias("problem")).filter("problem is not null"))
    old = found.filter("version in ('v1', 'legacy')").select("event_id", "recording_id", *INPUTS["v2"])
    given = attestations.select(F.col("terminal_event_id").alias("event_id"), F.col("recording_id").alias("attested"), "input_sha256s", "tool_versions", F.lit(True).alias("there"))
    both = old.join(given, "event_id", "left")
    right = (F.col("attested") == F.col("recording_id")) & F.coalesce(version() == "v2", F.lit(False)) & _bound(F.lit("v2"), F.col("input_sha256s"))
    problem = F.when(F.col("there").isNull(), "NO_ATTESTATION").when(~F.coalesce(right, F.lit(False)), "ATTESTATION_DIFFERS")
    out = out.unionByName(both.select("recording_id", problem.alias("problem")).filter("problem is not null"))
    extra = attestations.join(old.select(F.col("event_id").alias("terminal_event_id")), "terminal_event_id", "left_anti")
    again = duplicates(attestations, "terminal_event_id").join(attestations.select("terminal_event_id", "recording_id").distinct(), "terminal_event_id")
    return out.unionByName(named(extra, "EXTRA_ATTESTATION")).unionByName(named(again, "DUPLICATE_ATTESTATION"))


def history_problems(recordings: DataFrame, events: DataFrame, expected: DataFrame) -> DataFrame:
    """(recording_id, problem) of journals that don't bind recordings (recording_id, state) to their artifacts.

    events: the journal's columns and seq; expected: the transitions that the present artifacts stand for,
    with the semantic fields of an event. A journal may be one terminal step ahead of a reviewed recording.
    Problems beside those of journal_problems: NO_HISTORY, STATE_NOT_BOUND, ARTIFACT_NOT_BOUND,
    ARTIFACT_CONFLICTS.
    """
    out = journal_problems(events).select("recording_id", "problem")
    last = events.groupBy("recording_id").agg(F.max_by(F.struct("previous_state", "target_state"), "seq").alias("last"))
    ahead = (F.col("state") == "REVIEWED") & (F.col("last.previous_state") == "REVIEWED") & F.col("last.target_state").isin("APPROVED", "REJECTED")
    problem = F.when(F.col("last").isNull(), "NO_HISTORY").when((F.col("last.target_state") != F.col("state")) & ~ahead, "STATE_NOT_BOUND")
    out = out.unionByName(recordings.join(last, "recording_id", "left").select("recording_id", problem.alias("problem")).filter("problem is not null"))
    named = event_id(expected.withColumn("result", F.lit("success"))) if "event_id" not in expected.columns else expected
    status = event_existence(events, named)
    problem = F.when(F.col("status") == "new", "ARTIFACT_NOT_BOUND").when(F.col("status") == "conflict", "ARTIFACT_CONFLICTS")
    return out.unionByName(status.select("recording_id", problem.alias("problem")).filter("problem is not null"))


def recovery(journal: DataFrame, recordings: DataFrame) -> DataFrame:
    """Recordings (recording_id, state) that the journal is ahead of, with the state to recover, or what is wrong.

    status: current; recover, where the journal's events lead on from the stored state; inconsistent, where
    they don't, which is for a person to mend.
    """
    steps = journal.groupBy("recording_id").agg(F.max_by("target_state", "seq").alias("journal_state"), F.collect_set("previous_state").alias("left"))
    rows = recordings.join(steps, "recording_id", "left")
    status = F.when(F.col("journal_state").isNull() | (F.col("journal_state") == F.col("state")), "current").when(F.array_contains("left", F.col("state")), "recover").otherwise("inconsistent")
    return rows.select("recording_id", "state", "journal_state", status.alias("status"))
