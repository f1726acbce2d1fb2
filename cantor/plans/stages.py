"""The corpus stages end to end, as compositions of operators over tables, and what each stage touches."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantor.functions import backends
from cantor.functions import columns as C
from cantor.functions import identity
from cantor.operators import corpus, corrections, events, intervals, pronunciation
from cantor.sources import documents, files

#: Tables that each stage reads and writes, relative to the corpus.
TOUCHES = {
    "inventory": ("READ intake.csv; READ rights; READ raw; WRITE recordings; WRITE events"),
    "select-pilot": ("READ recordings; WRITE selection"),
    "prepare-text": ("READ selection; READ recordings; READ transcript_intake; WRITE transcripts; WRITE events; WRITE recordings"),
    "segment": ("READ selection; READ transcripts; READ raw; WRITE segmentation; WRITE events; WRITE recordings"),
    "pair": ("READ segmentation; READ transcripts; WRITE pairing; WRITE alignments; WRITE events; WRITE recordings"),
    "align": ("READ pairing; READ alignments; WRITE alignment; WRITE events; WRITE recordings"),
    "export-review": ("READ alignment; WRITE review_bundle"),
    "import-review": ("READ review_bundle; READ alignment; WRITE review_events; WRITE events; WRITE recordings"),
    "build-manifest": ("READ alignment; READ review_events; READ transcripts; READ rights; WRITE segments; WRITE events; WRITE recordings"),
    "report": ("READ segments; READ review_events; READ recordings; READ telemetry; WRITE report"),
}


def dry_run(spark: SparkSession, stage: str, ahead: bool = False) -> DataFrame:
    """(op, path) that a stage would touch, reads first; where the journal is ahead, states are recovered before."""
    rows = [tuple(x.split()) for x in TOUCHES[stage].split("; ")]
    if ahead and ("WRITE", "recordings") in rows:
        rows += [("READ", "events"), ("RECOVER", "recordings")]
    return spark.createDataFrame(rows, "op string, path string").orderBy(F.when(F.col("op") == "READ", 0).when(F.col("op") == "RECOVER", 1).otherwise(2), "path")


def prepare_text(texts: DataFrame, key: str = "recording_id") -> tuple[DataFrame, DataFrame]:
    """(units with token ranges, plans of the whole texts)."""
    units = corpus.token_ranges(corpus.spoken_units(texts, key), key, "ordinal")
    return units, pronunciation.analyze(texts, key)


def segment(recordings: DataFrame, vad: Callable[[], backends.VadBackend], threshold: float = 0.5, rate: int = 16000, key: str = "recording_id", **pauses: float) -> tuple[DataFrame, DataFrame]:
    """(speech, pauses with classes): frames over the threshold, neighbours merged, and the gaps between them."""
    frames = backends.voice_activity(recordings, vad).select(key, F.explode("frames").alias("f")).select(key, "f.*").filter(F.col("probability") >= threshold)
    w = Window.partitionBy(key).orderBy("start")
    opened = F.coalesce((F.col("start") > F.lag("end").over(w)).cast("int"), F.lit(1))
    speech = frames.withColumn("_new", opened).withColumn("_run", F.sum("_new").over(w)).groupBy(key, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")
    gaps = intervals.gaps(speech, key, int(pauses.get("minimum_gap_ms", intervals.PAUSES["minimum_gap_ms"])), rate)
    return speech, intervals.classify_pauses(gaps, key, rate, **pauses)


def pair(speech: DataFrame, pauses: DataFrame, units: DataFrame, takes: Callable[[DataFrame], DataFrame], key: str = "recording_id", **parameters: float) -> DataFrame:
    """Outcome of each unit. takes: split candidates to evidence (adds scores, word order, coverage)."""
    windows = intervals.unit_windows(speech, pauses.filter("kind is not null").select(key, "start", "end", "kind"), units, key)
    evidence = takes(intervals.split_candidates(windows, key))
    usable = windows.filter("status = 'ok'")
    chosen = intervals.choose_split(usable, evidence, [key, "unit_id"], **parameters)
    missed = windows.filter("status <> 'ok'").select(key, "unit_id", "start", "end", F.col("status").alias("outcome"), F.lit(None).cast("long").alias("split"), F.lit(None).cast("double").alias("score"))
    return chosen.unionByName(missed)


def review_bundle(takes: DataFrame) -> DataFrame:
    """(path, content) of the files that a person gets: automatic values and a decision template per take.

    takes: recording_id, group_id, take_index, segment_start, segment_end, and words (array of start, end,
    text in seconds of the segment) if they are to be drawn. Audio isn't text: see ``operators/audio.py``.
    """
    folder = F.concat_ws("/", "recording_id", "group_id", F.col("take_index").cast("string"))
    automatic = F.to_json(F.struct("segment_start", "segment_end", F.lit("unreviewed").alias("review_decision")))
    entity = C.review_entity_id(F.col("recording_id"), F.col("group_id"), F.col("take_index"))
    template = F.to_json(F.struct(entity.alias("entity_id"), F.lit("unreviewed").alias("decision"), F.lit("").alias("reason"), F.lit("").alias("reviewer")))
    page = F.concat(F.lit("<!doctype html><title>"), C.html_escape(entity), F.lit("</title><p>"), C.html_escape(F.format_string("%s to %s seconds", F.col("segment_start").cast("string"), F.col("segment_end").cast("string"))))
    made = {"automatic.json": automatic, "decision.json": template, "index.html": page}
    if "words" in takes.columns:
        made["words.TextGrid"] = files.textgrid(F.col("segment_end") - F.col("segment_start"), F.col("words"))
    return _exploded(takes, folder, made)


def _exploded(rows: DataFrame, folder, made: dict) -> DataFrame:
    listed = F.array(*[F.struct(F.concat(folder, F.lit(f"/{name}")).alias("path"), content.alias("content")) for name, content in made.items()])
    return rows.select(F.explode(listed).alias("f")).select("f.*")


def bundle_problems(exported: DataFrame, submitted: DataFrame) -> DataFrame:
    """(path, problem) of a bundle that came back: MISSING and EXTRA files, REPEATED ones, and CHANGED automatic values.

    Only decisions may differ from what was exported.
    """
    twice = corpus.duplicates(submitted, "path").select("path", F.lit("REPEATED").alias("problem"))
    both = exported.select("path", F.col("content").alias("a")).join(submitted.select("path", F.col("content").alias("b")).distinct(), "path", "full")
    fixed = ~F.endswith("path", F.lit("/decision.json"))
    problem = F.when(F.col("b").isNull(), "MISSING").when(F.col("a").isNull(), "EXTRA").when(fixed & (F.col("a") != F.col("b")), "CHANGED")
    return twice.unionByName(both.select("path", problem.alias("problem")).filter("problem is not null").distinct())


def import_review(automatic: DataFrame, journal: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """New events that lead from what the journal gives to the submitted values; none if it is there already."""
    return events.target_events(events.replay(automatic, journal, keys).select(*keys, "field", "value"), target, keys)


def align(takes: DataFrame, stored: DataFrame, aligner: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(alignments of the takes, problems): stored ones are used where their key is known, the others are made.

    takes: group_id, take_index, corrections.EVIDENCE without the seal, and what ``aligner`` needs; stored and
    what it returns: alignment_cache_key and integrity_sha256, and the result. Problems are those of coverage.
    """
    key = "alignment_cache_key"
    found = corpus.materialize(takes, stored, aligner, key)
    rows = takes.join(found, key)
    wanted = takes.select("group_id", "take_index", "unit_id", "audio_sha256", key)
    missing = wanted.join(found.select(key), key, "left_anti").select("group_id", "take_index", F.lit("MISSING_ALIGNMENT").alias("problem"))
    broken = identity.broken_seals(found).select(key).join(wanted, key).select("group_id", "take_index", F.lit("SEAL_BROKEN").alias("problem"))
    return rows, missing.unionByName(broken)


def finish(recordings: DataFrame, takes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recordings moved to APPROVED or REJECTED, recordings that stay reviewed because takes are undecided)."""
    states = events.entity_state(takes)
    moved = events.advance(recordings, states.filter("state is not null").withColumnRenamed("state", "target_state"))
    return moved, states.filter("state is null")


#: A reviewed take's fields, whose values are JSON.
REVIEWED = {"review_decision": "string", "segment_start": "double", "segment_end": "double", "words": "array<struct<text:string,start_seconds:double,end_seconds:double>>"}


def reviewed_takes(takes: DataFrame, automatic: DataFrame, journal: DataFrame) -> DataFrame:
    """Takes with what their review leaves: decision, segment ends and words, by replay of the journal.

    takes: recording_id, group_id, take_index, expected (its words), aligned (words as aligned), and what a
    manifest needs; automatic: entity_id, field, value of REVIEWED; journal: those events. A replay that isn't
    valid, an event of no take, and approved words that aren't the expected ones are errors.
    """
    named = takes.withColumn("entity_id", C.review_entity_id(F.col("recording_id"), F.col("group_id"), F.col("take_index")))
    corpus.require(events.unknown_entities(journal, named.select("entity_id")), "review of an unknown take")
    effective = events.replay(automatic, journal, ["entity_id"])
    corpus.require(effective.filter("not valid"), "review doesn't follow on what it saw")
    of = lambda field, kind: F.from_json(F.concat(F.lit('{"v":'), F.max(F.when(F.col("field") == field, F.col("value"))), F.lit("}")), f"v {kind}")["v"].alias(field)
    values = effective.groupBy("entity_id").agg(*[of(field, kind) for field, kind in REVIEWED.items()])
    rows = named.join(values, "entity_id").withColumnRenamed("review_decision", "decision").withColumn("reviewed", F.transform("words", lambda w: w["text"]))
    corpus.require(corrections.stale_words(rows.filter("decision = 'approved'")).select("entity_id", "problem"), "words are stale")
    fixed = F.transform("words", lambda w, i: F.struct(F.get("expected", i).alias("text"), w["start_seconds"].alias("start_seconds"), w["end_seconds"].alias("end_seconds")))
    return rows.withColumn("word_spans", fixed).drop("reviewed", "words")


def doctor() -> list[tuple[str, bool, str]]:
    """(tool, whether it is there, version) of what the stages may call, on this machine."""
    import pyarrow
    import pyspark

    out = [(m.__name__, True, m.__version__) for m in (pyspark, pyarrow)]
    for tool in ("ffmpeg", "ffprobe"):
        path = shutil.which(tool)
        said = subprocess.run([path, "-version"], capture_output=True, text=True, check=False).stdout.partition("\n")[0] if path else ""
        out.append((tool, path is not None, said))
    return out


def build_manifest(takes: DataFrame, rights: DataFrame) -> DataFrame:
    """Approved segments in order; overlaps and missing rights fail the stage."""
    allowed = rights.filter("allow_local_processing and allow_model_training").select("rights_id")
    corpus.require(takes.join(allowed, "rights_id", "left_anti"), "rights are missing")
    segments = corpus.approved_segments(takes)
    corpus.require(corpus.overlapping_segments(segments), "segments overlap")
    return segments.orderBy("recording_id", "group_id", "take_index")


def require_evaluation_rights(recordings: DataFrame, rights: DataFrame) -> None:
    """A report needs more than a manifest does: internal evaluation too."""
    usable = rights.join(documents.unauthorized(rights, evaluation=True).select("rights_id"), "rights_id", "left_anti")
    corpus.require(recordings.join(usable.select("rights_id"), "rights_id", "left_anti"), "rights to evaluate are missing")


def report_markdown(metrics: DataFrame) -> DataFrame:
    """A report row as lines of a Markdown table (position, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("k"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")) for c in metrics.columns])
    head = F.array(F.lit("| metric | value |"), F.lit("| --- | --- |"))
    lines = F.concat(head, F.transform(cells, lambda x: F.concat(F.lit("| "), C.markdown_cell(x["k"]), F.lit(" | "), C.markdown_cell(x["v"]), F.lit(" |"))))
    return metrics.select(F.posexplode(lines).alias("position", "value"))
