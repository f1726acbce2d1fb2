"""Intake, rights, selection, transcripts: the tables around a recorded corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.operators.pronunciation import tokens

STATES = ("DISCOVERED", "INVENTORIED", "TEXT_CANDIDATES_READY", "TRANSCRIPT_CONFIRMED", "SEGMENTED", "PAIRED", "ALIGNED", "REVIEWED", "APPROVED", "REJECTED")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that come more than once, with their number; counting combines before it shuffles."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def set_differences(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Keys of one side only, with the side: no row means that the sets are equal."""
    left = a.select(*keys).distinct().join(b, list(keys), "left_anti").withColumn("side", F.lit("left"))
    return left.unionByName(b.select(*keys).distinct().join(a, list(keys), "left_anti").withColumn("side", F.lit("right")))


def require(problems: DataFrame, message: str) -> None:
    """Raises ValueError with one example if there is any problem row."""
    if found := problems.take(1):
        raise ValueError(f"{message}: {found[0].asDict()}")


def inventory(intake: DataFrame, rights: DataFrame, probes: DataFrame) -> DataFrame:
    """Recordings from intake rows, their rights and probed audio; issues are a column.

    probes: relative_path, sha256, metadata. Rights without local processing and training are no rights.
    """
    allowed = rights.filter("allow_local_processing and allow_model_training").select("rights_id", F.col("speaker_id").alias("_speaker"))
    rows = intake.join(allowed, "rights_id", "left").join(probes, "relative_path", "left")
    issue = F.when(F.col("_speaker").isNull() | (F.col("_speaker") != F.col("speaker_id")), "RIGHTS_SCOPE_UNCONFIRMED").when(F.col("sha256").isNull(), "AUDIO_MISSING")
    identity = F.concat(F.lit("rec-"), F.substring("sha256", 1, 12))
    return rows.select(F.lit("1").alias("schema_version"), identity.alias("recording_id"), "relative_path", "sha256", C.content_type(F.col("relative_path")).alias("content_type"), "title_or_citation", "speaker_id", "rights_id", "notes", "metadata", F.lit("INVENTORIED").alias("state"), issue.alias("issue"))


def select_pilot(recordings: DataFrame, partition: list[str] | None = None, identity: str = "recording_id", duration: str = "duration_seconds") -> DataFrame:
    """Shortest, median-nearest and longest of each partition's eligible rows; all if there are at most three.

    The median-nearest is taken from the rows between the other two. Ends are found by aggregation, so no
    partition is sorted as a whole.
    """
    by = partition or []
    value = F.struct(F.col(duration).alias("d"), F.col(identity).alias("id"))
    ends = recordings.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.median(duration).alias("mid"), F.count("*").alias("n"))
    rows = recordings.join(ends, by) if by else recordings.crossJoin(F.broadcast(ends))
    inner = rows.filter((value > F.col("low")) & (value < F.col("high")) & (F.col("n") > 3))
    near = inner.groupBy(*by).agg(F.min(F.struct(F.abs(F.col(duration) - F.col("mid")).alias("gap"), F.col(duration).alias("d"), F.col(identity).alias("id"))).alias("m"))
    parts = [ends.filter("n >= 2").select(*by, F.lit(s).alias("slot"), F.col(f"{c}.id").alias(identity), F.col(f"{c}.d").alias(duration)) for s, c in (("short", "low"), ("long", "high"))]
    parts.append(near.select(*by, F.lit("middle").alias("slot"), F.col("m.id").alias(identity), F.col("m.d").alias(duration)).filter(F.col(identity).isNotNull()))
    few = rows.filter((F.col("n") == 3) & (value > F.col("low")) & (value < F.col("high"))).select(*by, F.lit("middle").alias("slot"), identity, duration)
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(few)


def eligible(recordings: DataFrame) -> DataFrame:
    return recordings.filter("content_type = 'spoken' and state = 'INVENTORIED'")


def select_explicit(recordings: DataFrame, ids: list[str]) -> DataFrame:
    """Two or three eligible recordings, in the order asked for."""
    if not 2 <= len(ids) <= 3 or len(set(ids)) != len(ids):
        raise ValueError("an explicit selection names two or three different recordings")
    asked = recordings.sparkSession.createDataFrame(list(enumerate(ids)), "position int, recording_id string")
    found = asked.join(eligible(recordings), "recording_id")
    require(asked.join(found, "recording_id", "left_anti"), "not eligible")
    return found.orderBy("position")


def selection_rows(selections: DataFrame) -> DataFrame:
    """A stored selection's parallel arrays as rows (position, recording_id, sha256)."""
    return selections.select(F.posexplode(F.arrays_zip("recording_ids", "inventory_hashes")).alias("position", "x")).select("position", F.col("x.recording_ids").alias("recording_id"), F.col("x.inventory_hashes").alias("sha256"))


def text_candidates(intake: DataFrame, texts: DataFrame) -> DataFrame:
    """Source candidates with content-addressed ids; texts: recording_id, source_id, text."""
    rows = intake.select("recording_id", F.explode("source_candidates").alias("c")).select("recording_id", "c.*").join(texts, ["recording_id", "source_id"])
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return rows.withColumn("text_sha256", sha).withColumn("candidate_id", C.candidate_id(F.col("source_id"), F.col("source_version"), sha))


def selection_problems(candidates: DataFrame) -> DataFrame:
    """Recordings without exactly one selected candidate."""
    return candidates.groupBy("recording_id").agg(F.sum(F.col("selected").cast("int")).alias("n_selected")).filter("n_selected <> 1")


def spoken_units(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Non-blank trimmed lines as units: key, ordinal (from 1), unit_id, text."""
    lines = F.filter(F.transform(F.split(F.col(text), r"\r\n|\r|\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c"))), lambda x: x != "")
    rows = texts.select(key, F.posexplode(lines).alias("at", "text"))
    return rows.select(key, (F.col("at") + 1).alias("ordinal"), C.unit_id(F.col(key).cast("string"), F.col("at") + 1).alias("unit_id"), "text")


def token_ranges(units: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """Adds token_start and token_end: running numbers of words before and after each unit."""
    n = F.size(C.surfaces(F.col(text)))
    running = F.sum("_n").over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return units.withColumn("_n", n).withColumn("token_end", running.cast("long")).withColumn("token_start", F.col("token_end") - F.col("_n")).drop("_n")


def unit_tokens(units: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """The tokens of each unit's range. Ranges don't overlap and are spelled out by number, so this is an
    equi-join whose size is that of the tokens, however many units a document has."""
    at = F.explode(F.sequence("token_start", F.col("token_end") - 1)).alias("token_index")
    wanted = units.filter("token_end > token_start").select("*", at)
    return tokens(docs, key).join(wanted, [key, "token_index"])


def resolution_problems(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens that a controlled resolution must not have changed: those without a warning before, or not resolved."""
    b = before.select(*keys, F.col("stress_index").alias("s0"), F.col("ipa").alias("i0"), F.col("needs_review").alias("w0"))
    a = after.select(*keys, F.col("stress_index").alias("s1"), F.col("ipa").alias("i1"), F.col("needs_review").alias("w1"))
    both = b.join(a, keys, "full")
    changed = ~(F.col("s0").eqNullSafe(F.col("s1")) & F.col("i0").eqNullSafe(F.col("i1")))
    return both.filter((changed & ~F.coalesce("w0", F.lit(False))) | (F.coalesce("w1", F.lit(False)) & ~F.coalesce("w0", F.lit(False))))


def resolution_steps(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, problem) of resolutions that aren't controlled: warnings must shrink, and none may be new.

    Both tables: key, token_index, warning_codes (array of string). Warnings are counted with repetition.
    Problems: TOKENS_DIFFER, NEW_WARNING, NOT_FEWER_WARNINGS.
    """
    b, a = (x.select(key, "token_index", F.col("warning_codes").alias(c)) for x, c in ((before, "b"), (after, "a")))
    both = b.join(a, [key, "token_index"], "full")
    there = both.groupBy(key).agg(F.bool_or(F.col("a").isNull() | F.col("b").isNull()).alias("differ"))
    counts = both.select(key, "token_index", F.explode(F.concat(F.transform(F.coalesce("b", F.array()), lambda w: F.struct(w.alias("w"), F.lit(-1).alias("n"))), F.transform(F.coalesce("a", F.array()), lambda w: F.struct(w.alias("w"), F.lit(1).alias("n"))))).alias("x"))
    moved = counts.groupBy(key, "token_index", "x.w").agg(F.sum("x.n").alias("n")).groupBy(key).agg((F.max("n") > 0).alias("grown"), (F.min("n") < 0).alias("shrunk"))
    rows = there.join(moved, key, "left")
    problem = F.when(F.col("differ"), "TOKENS_DIFFER").when(F.col("grown"), "NEW_WARNING").when(~F.coalesce("shrunk", F.lit(False)), "NOT_FEWER_WARNINGS")
    return rows.select(key, problem.alias("problem")).filter("problem is not null")


def approval(decision: Column, warnings: Column) -> Column:
    """Rejected before warnings are looked at; approved only without any."""
    return F.when(decision == "rejected", "rejected").when((decision == "approved") & (warnings > 0), "PRONUNCIATION_NEEDS_REVIEW").otherwise(decision)


def approved_segments(takes: DataFrame) -> DataFrame:
    """Segments of approved takes, in native samples, with ids.

    takes: recording_id, group_id, take_index, segment_start, segment_end (seconds), sample_rate, decision,
    n_warnings, word_spans (array of text, start_seconds, end_seconds). Word spans count from the segment.
    """
    rows = takes.withColumn("status", approval(F.col("decision"), F.col("n_warnings"))).filter("status = 'approved'")
    start, end = (C.sample_position(F.col(f"segment_{x}"), F.col("sample_rate")) for x in ("start", "end"))
    spans = F.transform("word_spans", lambda s: F.struct(s["text"].alias("text"), (s["start_seconds"] - F.col("segment_start")).alias("start_seconds"), (s["end_seconds"] - F.col("segment_start")).alias("end_seconds")))
    return rows.select(C.segment_id(F.col("recording_id"), F.col("group_id"), F.col("take_index")).alias("segment_id"), "recording_id", "group_id", "take_index", start.alias("source_start_sample"), end.alias("source_end_sample"), spans.alias("word_spans"))


def overlapping_segments(segments: DataFrame) -> DataFrame:
    w = Window.partitionBy("recording_id").orderBy("source_start_sample", "source_end_sample", "segment_id")
    return segments.withColumn("_next", F.lead("source_start_sample").over(w)).filter(F.col("_next") < F.col("source_end_sample")).drop("_next")


def cache_misses(wanted: DataFrame, stored: DataFrame, key: str = "cache_key") -> DataFrame:
    """Work that has no stored artifact yet."""
    return wanted.join(stored.select(key), key, "left_anti")


def materialize(wanted: DataFrame, stored: DataFrame, build, key: str = "cache_key") -> DataFrame:
    """Stored artifacts that are wanted, and new ones for the misses (``build``: rows to artifacts)."""
    return stored.join(wanted.select(key).distinct(), key, "left_semi").unionByName(build(cache_misses(wanted, stored, key)))


def alignment_problems(words: DataFrame) -> DataFrame:
    """Checks of aligned words (cache_key, spoken_token_index, token, text, start_seconds, end_seconds, score, duration).

    Words that claim one index come in the order of their other fields, so the result is the same on every run.
    """
    w = Window.partitionBy("cache_key").orderBy("spoken_token_index", "start_seconds", "end_seconds", "token", "text", "score")
    rows = words.withColumn("_n", F.row_number().over(w) - 1).withColumn("_end", F.lag("end_seconds").over(w))
    problem = (
        F.when(F.col("spoken_token_index") != F.col("_n"), "TOKEN_ORDER")
        .when(~C.alignment_form(F.col("text")).eqNullSafe(C.alignment_form(F.col("token"))), "TOKEN_TEXT")
        .when(~C.is_ratio(F.col("score")), "SCORE_RANGE")
        .when(~((F.col("start_seconds") >= 0) & (F.col("end_seconds") > F.col("start_seconds")) & (F.col("end_seconds") <= F.col("duration"))), "TIME_RANGE")
        .when(F.col("_end") > F.col("start_seconds"), "OVERLAP")
    )
    return rows.withColumn("problem", problem).filter("problem is not null").drop("_n", "_end")


def normalize_alignment(raw: DataFrame) -> DataFrame:
    """Aligner output with scores as probabilities and words in aligner form."""
    return raw.withColumn("score", C.probability(F.col("score"))).withColumn("form", C.alignment_form(F.col("text")))


def multiset_difference(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Keys that ``a`` has more often than ``b``, with how many more."""
    left = a.groupBy(*keys).agg(F.count("*").alias("_a"))
    right = b.groupBy(*keys).agg(F.count("*").alias("_b"))
    return left.join(right, list(keys), "left").withColumn("n", F.col("_a") - F.coalesce("_b", F.lit(0))).filter("n > 0").drop("_a", "_b")


def foreign_pauses(pauses: DataFrame, gaps: DataFrame, key: str) -> DataFrame:
    """Pauses that are no gap of the speech they claim to come from."""
    return pauses.join(gaps, [key, "start", "end"], "left_anti")
