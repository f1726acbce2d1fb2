"""Event journals: chains of states, replay of reviews, advancing records."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions.udf import arrow_udf
from cantor.operators.corpus import STATES, duplicates

#: Each state's successors; terminal states have none.
TRANSITIONS = {a: (b,) for a, b in zip(STATES[:7], STATES[1:8], strict=True)} | {"REVIEWED": ("APPROVED", "REJECTED")}
SEMANTICS = ("recording_id", "previous_state", "target_state", "input_sha256s", "config_sha256", "tool_versions")


def transition_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, bs in TRANSITIONS.items() for b in bs], "previous_state string, target_state string")


def chain_breaks(events: DataFrame, key: str = "recording_id", order: str = "seq") -> DataFrame:
    """Events whose previous state isn't the last target; the first of a key is free."""
    last = F.lag("target_state").over(Window.partitionBy(key).orderBy(order))
    return events.withColumn("expected_state", last).filter(F.col("expected_state").isNotNull() & ~F.col("expected_state").eqNullSafe(F.col("previous_state")))


def journal_problems(events: DataFrame) -> DataFrame:
    """(problem, recording_id, event_id): repeated ids, repeated semantics, steps that don't exist, broken chains."""
    ids = duplicates(events, "event_id").select(F.lit("DUPLICATE_EVENT_ID").alias("problem"), F.lit(None).cast("string").alias("recording_id"), "event_id")
    same = events.groupBy(*SEMANTICS).agg(F.count("*").alias("n"), F.max("event_id").alias("event_id")).filter("n > 1").select(F.lit("DUPLICATE_SEMANTICS").alias("problem"), "recording_id", "event_id")
    steps = F.broadcast(transition_frame(events.sparkSession))  # ten rows, fixed
    bad = events.join(steps, ["previous_state", "target_state"], "left_anti").select(F.lit("ILLEGAL_TRANSITION").alias("problem"), "recording_id", "event_id")
    broken = chain_breaks(events).select(F.lit("BROKEN_CHAIN").alias("problem"), "recording_id", "event_id")
    return ids.unionByName(same).unionByName(bad).unionByName(broken)


def advance(recordings: DataFrame, moves: DataFrame) -> DataFrame:
    """Recordings with the target state of their move (recording_id, target_state), if that step exists, else the issue."""
    steps = F.broadcast(transition_frame(recordings.sparkSession).withColumnRenamed("previous_state", "state").withColumn("_ok", F.lit(True)))
    rows = recordings.join(moves.select("recording_id", "target_state"), "recording_id", "left").join(steps, ["state", "target_state"], "left")
    moved = F.coalesce("_ok", F.lit(False))
    issue = F.when(F.col("target_state").isNotNull() & ~moved, "ILLEGAL_TRANSITION")
    return rows.withColumn("issue", issue).withColumn("state", F.when(moved, F.col("target_state")).otherwise(F.col("state"))).drop("target_state", "_ok")


def transition(recordings: DataFrame, moves: DataFrame, config_sha256: str, tool_versions: list[str]) -> tuple[DataFrame, DataFrame]:
    """(recordings one state further, the events that say so) for moves (recording_id, target_state, input_sha256s).

    A move whose step doesn't exist leaves its recording as it is, with an issue, and makes no event. Event ids
    are of their content, so a stage that runs again proposes the same events.
    """
    moved = advance(recordings, moves)
    steps = recordings.select("recording_id", F.col("state").alias("previous_state")).join(moved.filter("issue is null").select("recording_id", F.col("state").alias("target_state")), "recording_id")
    done = steps.join(moves.select("recording_id", "target_state", "input_sha256s"), ["recording_id", "target_state"])
    fixed = {"config_sha256": F.lit(config_sha256), "tool_versions": F.array(*map(F.lit, tool_versions)), "result": F.lit("success")}
    return moved, event_id(done.withColumns(fixed))


def event_existence(journal: DataFrame, events: DataFrame) -> DataFrame:
    """Each proposed event as new, exists (same id and semantics), or conflict (either alone)."""
    digest = F.xxhash64(*SEMANTICS)
    known = journal.select("event_id", digest.alias("_known"))
    rows = events.withColumn("_own", digest).join(known, "event_id", "left")
    rows = rows.join(journal.select(digest.alias("_own"), F.lit(True).alias("_same")).distinct(), "_own", "left")
    status = F.when(F.col("_known").isNotNull(), F.when(F.col("_known") == F.col("_own"), "exists").otherwise("conflict")).when(F.col("_same"), "conflict").otherwise("new")
    return rows.withColumn("status", status).drop("_known", "_own", "_same")


def event_id(events: DataFrame) -> DataFrame:
    """Adds event_id: of the canonical ASCII JSON of the semantic fields."""
    text = F.to_json(F.struct(*[F.col(c) for c in SEMANTICS], "result"), {"ignoreNullFields": "false"})
    return events.withColumn("event_id", F.concat(F.lit("state-"), F.substring(C.canonical_digest(text, ascii_only=True), 1, 16)))


def replay(automatic: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Final value of each (keys, field), and whether every event saw the value it said it saw.

    automatic: keys, field, value; events: keys, field, before, after, seq. Values are JSON tokens, so 1 and
    1.0 differ. Where valid is false, value is what the last event says, which is not to be used. An event's before must equal the last after, or the automatic value: lag over the field's
    events, no fold in Python.
    """
    w = Window.partitionBy(*keys, "field").orderBy("seq")
    seen = events.withColumn("_last", F.lag("after").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    seen = seen.join(automatic.withColumnRenamed("value", "_auto"), [*keys, "field"], "left")
    wrong = ~F.when(F.col("_first"), F.col("_auto").eqNullSafe(F.col("before"))).otherwise(F.col("_last").eqNullSafe(F.col("before")))
    no_change = F.col("before").eqNullSafe(F.col("after"))
    done = seen.groupBy(*keys, "field").agg(F.max_by("after", "seq").alias("final"), F.max((wrong | no_change).cast("int")).alias("n_bad"), F.count("*").alias("n_events"))
    rows = automatic.join(done, [*keys, "field"], "full")
    return rows.select(*keys, "field", F.when(F.col("n_events").isNull(), F.col("value")).otherwise(F.col("final")).alias("value"), F.coalesce("n_events", F.lit(0)).alias("n_events"), (F.coalesce("n_bad", F.lit(0)) == 0).alias("valid"))


def unknown_entities(events: DataFrame, entities: DataFrame, key: str = "entity_id") -> DataFrame:
    return events.join(entities, key, "left_anti")


def target_events(effective: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Field changes that lead from the effective values to the target ones."""
    both = effective.withColumnRenamed("value", "before").join(target.withColumnRenamed("value", "after"), [*keys, "field"])
    return both.filter(~F.col("before").eqNullSafe(F.col("after")))


@arrow_udf("string")
def _review_digest(text: pd.Series) -> pd.Series:
    def one(t: str) -> str:
        row = json.loads(t)
        row |= {k: json.loads(row[k]) if row.get(k) is not None else None for k in ("before", "after")}
        return "review-" + hashlib.sha256(C.canonical_json(row).encode()).hexdigest()

    return text.map(one)


def review_event_id(events: DataFrame) -> DataFrame:
    """Adds review_event_id: of the canonical JSON of all other fields (before and after are JSON tokens)."""

    fields = ["schema_version", "entity_id", "field", "before", "after", "reason", "reviewer", "reviewed_at"]
    return events.withColumn("review_event_id", _review_digest(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))


def entity_state(takes: DataFrame, key: str = "recording_id") -> DataFrame:
    """APPROVED with any approved take, REJECTED if all are rejected, else null."""
    state = F.when(F.bool_or(F.col("decision") == "approved"), "APPROVED").when(F.bool_and(F.col("decision") == "rejected"), "REJECTED")
    return takes.groupBy(key).agg(state.alias("state"))


def terminal_evidence(events: DataFrame) -> DataFrame:
    """Version of a terminal event's evidence, by its number of inputs."""
    n = F.size("input_sha256s")
    return events.filter("target_state in ('APPROVED', 'REJECTED')").withColumn("evidence", F.when(n == 8, "v2").when(n == 7, "v1").when(n == 5, "legacy").otherwise("INVALID"))


def journal_prefix(lines: list[str], digest: str) -> int | None:
    """How many lines of a journal have this SHA-256 together, in order; a running hash, so not an aggregate.

    For one review journal (thousands of lines), read on the driver in order.
    """
    running = hashlib.sha256()
    if running.hexdigest() == digest:
        return 0
    for n, line in enumerate(lines, 1):
        running.update(line.encode() + b"\n")
        if running.hexdigest() == digest:
            return n
    return None
