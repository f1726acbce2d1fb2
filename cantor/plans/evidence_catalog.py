"""Further queries: content addresses, corrections, terminal evidence, histories, audio checks and readers' checks.

Orders stand for recordings and line items for their takes; what a query spoils on purpose, so that its
operator has something to find, follows from the keys and is said in its docstring.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import identity
from cantor.operators import audio, corpus, corrections, evidence, intervals, report
from cantor.plans.catalog import long, query, table
from cantor.plans.corpus_catalog import ORACLES, QUERIES
from cantor.sources import documents

__all__ = ["ORACLES", "QUERIES"]
STAMP = "2024-01-01T00:00:00+00:00"


def _sha(x):
    return F.sha2(x.cast("string").cast("binary"), 256)


#: Line items by their keys, which repeat in the table: least flags, status and part, largest quantity.
_LINES = "(SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2)"


def _lines(spark, sf_dir):
    least = [F.min(c).alias(c) for c in ("l_returnflag", "l_linestatus", "l_partkey", "l_discount")]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*least, F.max("l_quantity").alias("l_quantity"))


@query("""
SELECT page_id, sha256('{"config_sha256":"c","end_seconds":null,"ffmpeg_version":"7.1","mode":"' || m || '","output_config_sha256":"o","schema_version":"1","source_relative_path":"' || url || '","source_sha256":"' || sha256(html) || '","start_seconds":null}') AS cache_key,
  CASE m WHEN 'analysis' THEN 'derived/normalized/analysis-' ELSE 'derived/segments/review/review-' END IS NOT NULL AS known
FROM (SELECT *, CASE WHEN page_id % 2 = 0 THEN 'analysis' ELSE 'review' END AS m FROM pages WHERE html IS NOT NULL)""")
def audio_cache_keys(spark, sf_dir):
    """Pages as whole source files of two modes."""
    mode = F.when(F.col("page_id") % 2 == 0, "analysis").otherwise("review")
    rows = table(spark, sf_dir, "pages").filter("html is not null").select(
        "page_id", mode.alias("mode"), F.col("url").alias("source_relative_path"), _sha(F.col("html")).alias("source_sha256"), F.lit("c").alias("config_sha256"), F.lit("o").alias("output_config_sha256"), F.lit("7.1").alias("ffmpeg_version"),
        F.lit(None).cast("double").alias("start_seconds"), F.lit(None).cast("double").alias("end_seconds"),
    )
    keyed = rows.withColumn("cache_key", identity.audio_cache_key())
    return keyed.select("page_id", "cache_key", F.endswith(identity.audio_path(F.col("mode"), F.col("cache_key")), F.concat("cache_key", F.lit(".wav"))).alias("known"))


def _requests(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _sha(F.col("l_orderkey")).alias("audio_sha256"), _sha(F.col("l_linenumber")).alias("spoken_text_sha256"))
    fixed = {"alignment_text_sha256": "a", "segmentation_artifact_sha256": "s", "backend": "ctc", "backend_version": "1", "model_id": "m", "model_revision": "r", "model_license": "cc", "config_sha256": "c", "alignment_transform_version": "t1"}
    parameters = F.concat(F.lit('{"window": '), F.col("l_linenumber").cast("string"), F.lit(', "batch": 4}'))
    return rows.select("*", *[F.lit(v).alias(k) for k, v in fixed.items()], parameters.alias("effective_parameters"))


@query("""
WITH l AS (SELECT *, '{"batch":4,"window":' || l_linenumber || '}' AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, sha256('{"alignment_text_sha256":"a","alignment_transform_version":"t1","audio_sha256":"' || sha256(CAST(l_orderkey AS VARCHAR)) || '","backend":"ctc","backend_version":"1","config_sha256":"c","effective_parameters":' || p ||
    ',"model_id":"m","model_license":"cc","model_revision":"r","schema_version":"2","segmentation_artifact_sha256":"s","spoken_text_sha256":"' || sha256(CAST(l_linenumber AS VARCHAR)) || '"}') AS cache_key,
  sha256('{"alignment_transform_version":"t1","backend":"ctc","backend_version":"1","effective_parameters":' || p || ',"model_id":"m","model_license":"cc","model_revision":"r"}') AS runtime FROM l""")
def alignment_cache_keys(spark, sf_dir):
    """Line items as alignment requests."""
    return _requests(spark, sf_dir).select("l_orderkey", "l_linenumber", identity.alignment_cache_key().alias("cache_key"), identity.alignment_runtime_digest().alias("runtime"))


@query("""
SELECT o_orderkey, sha256('{"config_sha256":"c","input_sha256s":["' || o_orderstatus || '","' || o_custkey || '"],"recording_id":"rec-' || o_orderkey || '","schema_version":"1"}') AS segmentation_key,
  sha256('{"analysis_audio_relative_path":"p","analysis_audio_sha256":"a","config_sha256":"c","ffmpeg_version":"7","pairing_parameters":{"margin":0.02},"recording_id":"rec-' || o_orderkey || '","schema_version":"1","segmentation_artifact_sha256":"s","windows":[{"end":' || o_custkey || ',"start":0}]}') AS pairing_key
FROM orders""")
def stage_cache_keys(spark, sf_dir):
    """Orders as recordings with one window each."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("rec-"), F.col("o_orderkey").cast("string")).alias("recording_id"), F.lit("c").alias("config_sha256"), F.array("o_orderstatus", F.col("o_custkey").cast("string")).alias("input_sha256s"),
        F.concat(F.lit('[{"start": 0, "end": '), F.col("o_custkey").cast("string"), F.lit("}]")).alias("windows"), F.lit("p").alias("analysis_audio_relative_path"), F.lit("a").alias("analysis_audio_sha256"), F.lit("s").alias("segmentation_artifact_sha256"),
        F.lit('{"margin": 0.02}').alias("pairing_parameters"), F.lit("7").alias("ffmpeg_version"),
    )
    return rows.select("o_orderkey", identity.segmentation_cache_key().alias("segmentation_key"), identity.pairing_cache_key().alias("pairing_key"))


@query("SELECT c_custkey, sha256('{\"c_custkey\":' || c_custkey || ',\"c_nationkey\":' || c_nationkey || '}') AS integrity_sha256 FROM customer WHERE c_custkey % 7 = 0")
def broken_seals(spark, sf_dir):
    """Customers sealed; then every seventh one's nation is changed, which its seal shows."""
    rows = identity.sealed(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    changed = rows.withColumn("c_nationkey", F.when(F.col("c_custkey") % 7 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")))
    return identity.broken_seals(changed).select("c_custkey", "integrity_sha256")


_TAKE = "SELECT DISTINCT 'g' || l_orderkey AS group_id, CAST(l_linenumber AS INT) AS take_index, l_orderkey AS o, l_linenumber AS n FROM lineitem"


@query(f"""
WITH t AS ({_TAKE})
SELECT group_id, take_index, CASE WHEN o % 11 = 0 THEN 'MISSING_ALIGNMENT' ELSE 'EVIDENCE_DIFFERS' END AS problem FROM t WHERE o % 11 = 0 OR (o + n) % 13 = 0
UNION ALL SELECT group_id, take_index, 'DUPLICATE_ALIGNMENT' FROM t WHERE o % 11 <> 0 AND o % 17 = 0
UNION ALL SELECT group_id, take_index + 100, 'EXTRA_ALIGNMENT' FROM t WHERE o % 11 <> 0 AND o % 19 = 0""")
def alignment_coverage(spark, sf_dir):
    """Line items as takes. Of their alignments those of every 11th order are gone, of every 17th stored twice; some have other audio, some are of no take."""
    rows = _lines(spark, sf_dir).select(
        F.concat(F.lit("g"), F.col("l_orderkey").cast("string")).alias("group_id"), F.col("l_linenumber").cast("int").alias("take_index"), F.lit("u").alias("unit_id"), _sha(F.col("l_partkey")).alias("audio_sha256"),
        F.lit("k").alias("alignment_cache_key"), F.lit("i").alias("alignment_integrity_sha256"), F.col("l_orderkey").alias("o"),
    )
    there = rows.filter("o % 11 <> 0").withColumn("audio_sha256", F.when((F.col("o") + F.col("take_index")) % 13 == 0, "x").otherwise(F.col("audio_sha256")))
    found = there.unionByName(there.filter("o % 17 = 0")).unionByName(there.filter("o % 19 = 0").withColumn("take_index", F.col("take_index") + 100))
    # a duplicate of an order of both kinds is one of the moved rows, which aren't doubled
    return corrections.alignment_coverage_problems(rows, found)


def _pairing(spark, sf_dir):
    """Orders as units; the lines of an order are its saved splits, and an urgent order is to be reviewed."""
    unit = F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select(F.lit("rec").alias("recording_id"), unit.alias("unit_id"), F.col("o_orderkey").alias("o"), F.when(F.col("o_orderpriority") == "1-URGENT", "review").otherwise("selected").alias("status"))
    lines = _lines(spark, sf_dir).select(F.lit("rec").alias("recording_id"), F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("unit_id"), F.col("l_orderkey").alias("o"), (F.col("l_linenumber") * 100).cast("long").alias("split_sample"), F.col("l_discount").cast("double").alias("score"))
    return orders, lines


_REVIEW = "SELECT o_orderkey AS o, 'u' || o_orderkey AS u FROM orders WHERE o_orderpriority = '1-URGENT'"


@query(f"""
WITH r AS ({_REVIEW}), s AS (SELECT o, u, CASE WHEN o % 5 = 0 THEN 7 ELSE 100 END AS sp FROM r WHERE o % 3 <> 0), c AS (SELECT DISTINCT l_orderkey AS o, l_linenumber * 100 AS sp FROM lineitem)
SELECT 'rec' AS recording_id, u AS unit_id, 'NOT_SELECTED' AS problem FROM r WHERE o % 3 = 0
UNION ALL SELECT 'rec', u, 'NO_SAVED_CANDIDATE' FROM s WHERE (o, sp) NOT IN (SELECT (o, sp) FROM c)
UNION ALL SELECT 'rec', 'u' || o_orderkey, 'NOT_TO_REVIEW' FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderkey % 29 = 0""")
def correction_selection_problems(spark, sf_dir):
    """Picks for two thirds of the units to review, every fifth no saved split, and some for units that need none."""
    orders, lines = _pairing(spark, sf_dir)
    picks = orders.filter("(status = 'review' and o % 3 <> 0) or (status = 'selected' and o % 29 = 0)")
    picks = picks.select("recording_id", "unit_id", F.when(F.col("o") % 5 == 0, 7).otherwise(100).cast("long").alias("split_sample"))
    return corrections.selection_problems(orders, lines, picks)


@query(f"""
WITH r AS ({_REVIEW}), c AS (SELECT l_orderkey AS o, min(l_linenumber) * 100 AS sp FROM lineitem GROUP BY 1), k AS (SELECT u, sp, 'rec-' || u AS g FROM r JOIN c USING (o))
SELECT u AS unit_id, g AS group_id, 1 AS take_index, CAST(0 AS BIGINT) AS start_sample, CAST(sp AS BIGINT) AS end_sample FROM k UNION ALL SELECT u, g, 2, sp, 1000 FROM k""")
def corrected_takes(spark, sf_dir):
    """The first saved split picked for every unit to review."""
    orders, lines = _pairing(spark, sf_dir)
    picks = lines.groupBy("recording_id", "unit_id").agg(F.min("split_sample").alias("split_sample"))
    windows = orders.select("recording_id", "unit_id", F.lit(0).cast("long").alias("start_sample"), F.lit(1000).cast("long").alias("end_sample"))
    return corrections.reviewed_pairing(orders, windows, lines, picks).drop("recording_id")


@query(f"""
WITH r AS ({_REVIEW} AND o_orderkey IN (SELECT l_orderkey FROM lineitem)), e AS (SELECT o, 'pairing:3:rec:' || length(u) || ':' || u AS entity_id FROM r)
SELECT entity_id, 'MISSING_EVENT' AS problem FROM e WHERE o % 7 = 0 UNION ALL SELECT entity_id, 'EVENT_DIFFERS' FROM e WHERE o % 7 <> 0 AND o % 5 = 0
UNION ALL SELECT 'pairing:3:rec:1:x', 'ORPHAN_EVENT'""")
def correction_event_audit(spark, sf_dir):
    """Events of the picks: every seventh is gone, every fifth names another split, one is of no unit."""
    orders, lines = _pairing(spark, sf_dir)
    review = orders.filter("status = 'review'").select("recording_id", "unit_id")
    picks = lines.join(review, ["recording_id", "unit_id"], "left_semi").groupBy("recording_id", "unit_id", "o").agg(F.min("split_sample").alias("split_sample"))
    orphan = spark.createDataFrame([("rec", "x", 1, 5)], "recording_id string, unit_id string, o bigint, split_sample bigint")
    told = picks.filter("o % 7 <> 0").withColumn("split_sample", F.when(F.col("o") % 5 == 0, F.col("split_sample") + 1).otherwise(F.col("split_sample"))).unionByName(orphan)
    events = corrections.correction_events(told.select("*", F.lit("heard").alias("reason"), F.lit("me").alias("reviewer"), F.lit(STAMP).alias("reviewed_at")))
    return corrections.correction_event_problems(picks, events)


@query(f"""
WITH d AS (SELECT l_orderkey AS o, l_linenumber AS n, l_returnflag AS f FROM {_LINES})
SELECT 'r' || o AS recording_id, CAST(n AS INT) AS take_index, 'NOT_APPROVED' AS problem FROM d WHERE f <> 'A' AND o % 9 = 0
UNION ALL SELECT 'r' || o, n, 'NO_SEGMENT' FROM d WHERE f = 'A' AND o % 4 = 0 AND o % 9 <> 0
UNION ALL SELECT 'r' || o, n, 'DUPLICATE_SEGMENT' FROM d WHERE f = 'A' AND o % 4 <> 0 AND o % 9 <> 0 AND o % 5 = 0""")
def segment_decisions(spark, sf_dir):
    """Returned (A) line items are approved takes; segments of some are gone or twice there, and some are of no approved take."""
    rows = _lines(spark, sf_dir).select(F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("recording_id"), F.lit("g").alias("group_id"), F.col("l_linenumber").cast("int").alias("take_index"), F.col("l_orderkey").alias("o"), F.when(F.col("l_returnflag") == "A", "approved").otherwise("rejected").alias("decision"))
    right = rows.filter("decision = 'approved' and o % 4 <> 0 and o % 9 <> 0")
    segments = right.unionByName(right.filter("o % 5 = 0")).unionByName(rows.filter("o % 9 = 0"))
    return corrections.segment_problems(segments, rows).drop("group_id")


@query("SELECT user_id AS entity_id, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS reviewed_at FROM events GROUP BY user_id")
def last_review_times(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("reviewed_at"))
    return corrections.last_reviewed(rows)


@query("""
WITH o AS (SELECT o_orderkey AS o, CASE WHEN o_orderkey % 3 = 0 THEN 'v2' WHEN o_orderkey % 3 = 1 THEN 'v1' ELSE 'legacy' END AS v FROM orders)
SELECT 'r' || o AS recording_id, 'NOT_ONE_TERMINAL_EVENT' AS problem FROM o WHERE o % 31 = 0
UNION ALL SELECT 'r' || o, 'EVIDENCE_DIFFERS' FROM o WHERE o % 31 <> 0 AND o % 7 = 0
UNION ALL SELECT 'r' || o, 'NO_ATTESTATION' FROM o WHERE o % 31 <> 0 AND v <> 'v2' AND o % 5 = 0
UNION ALL SELECT 'r' || o, 'ATTESTATION_DIFFERS' FROM o WHERE o % 31 <> 0 AND v <> 'v2' AND o % 5 <> 0 AND o % 11 = 0
UNION ALL SELECT 'r' || o, 'EXTRA_ATTESTATION' FROM o WHERE o % 5 <> 0 AND (v = 'v2' OR o % 31 = 0)""")
def terminal_evidence_audit(spark, sf_dir):
    """Orders as finished recordings with events of three versions; some events, evidence and attestations are missing or of other content."""
    names = evidence.INPUTS["v2"]
    o = F.col("o_orderkey")
    version = F.when(o % 3 == 0, "v2").when(o % 3 == 1, "v1").otherwise("legacy")
    rows = table(spark, sf_dir, "orders").select(o.alias("o"), F.concat(F.lit("r"), o.cast("string")).alias("recording_id"), F.lit("APPROVED").alias("state"), version.alias("v"), *[F.concat(F.lit(n + "-"), o.cast("string")).alias(n) for n in names])
    marker = F.when(F.col("v") == "v2", evidence.MARKERS["v2"]).otherwise(evidence.MARKERS["v1"])
    inputs = F.when(F.col("v") == "v2", F.array(*names)).when(F.col("v") == "v1", F.array(*evidence.INPUTS["v1"])).otherwise(F.array(*evidence.INPUTS["legacy"]))
    spoiled = F.when(F.col("o") % 7 == 0, F.transform(inputs, lambda x: F.concat(x, F.lit("'")))).otherwise(inputs)
    named = F.concat(F.lit("e"), F.col("o").cast("string"))
    events = rows.filter("o % 31 <> 0").select(named.alias("event_id"), "recording_id", F.lit("REVIEWED").alias("previous_state"), F.lit("APPROVED").alias("target_state"), spoiled.alias("input_sha256s"), F.array(marker, F.lit("7.1")).alias("tool_versions"))
    whole = F.when(F.col("o") % 11 == 0, F.array(F.lit("x"))).otherwise(F.array(*names))
    attested = rows.filter("o % 5 <> 0").select(named.alias("terminal_event_id"), "recording_id", whole.alias("input_sha256s"), F.array(F.lit(evidence.MARKERS["v2"]), F.lit("7.1")).alias("tool_versions"))
    return evidence.terminal_problems(rows, events, attested)


@query("""
WITH o AS (SELECT o_orderkey AS o FROM orders)
SELECT 'r' || o AS recording_id, 'NO_HISTORY' AS problem FROM o WHERE o % 23 = 0
UNION ALL SELECT 'r' || o, 'ARTIFACT_NOT_BOUND' FROM o WHERE o % 23 = 0
UNION ALL SELECT 'r' || o, 'STATE_NOT_BOUND' FROM o WHERE o % 23 <> 0 AND o % 7 = 0
UNION ALL SELECT 'r' || o, 'ARTIFACT_CONFLICTS' FROM o WHERE o % 23 <> 0 AND o % 5 = 0
UNION ALL SELECT 'r' || o, 'BROKEN_CHAIN' FROM o WHERE o % 23 <> 0 AND o % 9 = 0""")
def history_audit(spark, sf_dir):
    """Orders as recordings with two steps each; some have none, other inputs than the artifact, a gap, or another state."""
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(o.alias("o"), F.concat(F.lit("r"), o.cast("string")).alias("recording_id"), F.when(o % 7 == 0, "ALIGNED").otherwise("PAIRED").alias("state"))
    first = F.when(F.col("o") % 9 == 0, F.struct(F.lit("INVENTORIED").alias("previous_state"), F.lit("TEXT_CANDIDATES_READY").alias("target_state"))).otherwise(F.struct(F.lit("TRANSCRIPT_CONFIRMED").alias("previous_state"), F.lit("SEGMENTED").alias("target_state")))
    second = F.struct(F.lit("SEGMENTED").alias("previous_state"), F.lit("PAIRED").alias("target_state"))
    both = rows.filter("o % 23 <> 0").select("o", "recording_id", F.posexplode(F.array(first, second)).alias("seq", "s")).select("o", "recording_id", "seq", "s.*")
    event = lambda df, sha: df.select(F.concat(F.lit("e"), F.col("o").cast("string"), F.lit("-"), F.col("target_state")).alias("event_id"), "recording_id", "seq", "previous_state", "target_state", F.array(sha).alias("input_sha256s"), F.lit("c").alias("config_sha256"), F.array(F.lit("t")).alias("tool_versions"))
    wanted = event(rows.select("o", "recording_id", F.lit(1).alias("seq"), F.lit("SEGMENTED").alias("previous_state"), F.lit("PAIRED").alias("target_state")), F.lit("s"))
    return evidence.history_problems(rows, event(both, F.when((F.col("seq") == 1) & (F.col("o") % 5 == 0), "other").otherwise("s")), wanted)


@query("""
WITH v AS (SELECT user_id, event_id, datediff('second', TIMESTAMP '2024-01-01', ts) AS s, 1 + event_id % 4 - CASE WHEN event_id % 50 = 0 THEN 9 ELSE 0 END AS d FROM events),
i AS (SELECT user_id, s * 16 AS s, s * 16 + d * 8000 AS e FROM v), r AS (SELECT user_id, max(s) - 1000 AS n FROM i GROUP BY user_id),
x AS (SELECT i.user_id, s, e, n, lag(e) OVER (PARTITION BY i.user_id ORDER BY s, e) AS p FROM i JOIN r ON r.user_id = i.user_id)
SELECT user_id, problem, count(*) AS n FROM (SELECT user_id, CASE WHEN s < 0 OR e <= s THEN 'NOT_A_RANGE' WHEN s < p THEN 'OVERLAP' WHEN e > n THEN 'BEYOND_END' END AS problem FROM x) WHERE problem IS NOT NULL GROUP BY 1, 2""")
def speech_audit(spark, sf_dir):
    """Events as speech of some seconds; every fiftieth runs backwards, and each user's file is cut before the last one starts."""
    second = F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))
    span = (1 + F.col("event_id") % 4 - F.when(F.col("event_id") % 50 == 0, 9).otherwise(0)) * 8000
    speech = table(spark, sf_dir, "events").select("user_id", (second * 16).alias("start"), (second * 16 + span).alias("end"))
    files = speech.groupBy("user_id").agg((F.max("start") - 1000).alias("n_samples")).withColumn("duration_seconds", F.lit(1e12))
    return audio.speech_problems(speech, files, "user_id").groupBy("user_id", "problem").agg(F.count("*").alias("n"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_linenumber AS s, l_linenumber + l_quantity / 10 - 1 AS e FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN e <= s THEN 'NOT_A_RANGE' WHEN e > 6 THEN 'BEYOND_END' END AS problem,
  CASE WHEN (CAST(q AS BIGINT) * 1 * 16000) % (l_linenumber * 1000) = 0 THEN CAST((CAST(q AS BIGINT) * 16000) // (l_linenumber * 1000) AS BIGINT) END AS samples FROM l""")
def segment_bounds(spark, sf_dir):
    """Line items as segments of files of six seconds, and as tick counts in time bases that not all give whole samples."""
    start = F.col("l_linenumber").cast("double")
    end = start + F.col("l_quantity") / 10 - 1
    base = F.concat(F.lit("1/"), (F.col("l_linenumber") * 1000).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", audio.bounds_problem(start, end, F.lit(6.0)).alias("problem"), audio.rational_samples(F.col("l_quantity").cast("long"), base, F.lit(16000)).alias("samples"))


@query("""
WITH p AS (SELECT conv_id, turn, role, text, CASE WHEN turn % 4 = 0 THEN upper(text) WHEN turn % 4 = 1 THEN text || ' x' ELSE text END AS other FROM conversations WHERE text IS NOT NULL AND regexp_full_match(text, '[ -~\\n]*'))
SELECT conv_id, turn, CASE WHEN turn % 4 = 1 THEN 'REVIEWED_WORDS_STALE' ELSE 'ALIGNED_WORDS_STALE' END AS problem FROM p WHERE turn % 4 IN (1, 3)""")
def stale_take_words(spark, sf_dir):
    """Turns as takes: capitals make no word stale, another word does; of every fourth the alignment lacks a word."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("text").rlike(r"^[ -~\n]*\z"))
    words = F.split("text", " ")
    reviewed = F.when(F.col("turn") % 4 == 0, F.split(F.upper("text"), " ")).when(F.col("turn") % 4 == 1, F.array_append(words, "x")).otherwise(words)
    aligned = F.when(F.col("turn") % 4 == 3, F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)
    return corrections.stale_words(turns.select("conv_id", "turn", reviewed.alias("reviewed"), aligned.alias("aligned"), words.alias("expected"))).select("conv_id", "turn", "problem")


@query(r"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\p{L}[\p{L}\p{M}]*')) AS s FROM documents)
SELECT s AS surface, regexp_full_match(s, '[a-ik-uw-z]+') AS is_key FROM w WHERE regexp_full_match(s, '[A-Za-z]+')""")
def exception_keys(spark, sf_dir):
    """Distinct words of ASCII letters: which are in the form of an exception's key."""
    rows = table(spark, sf_dir, "documents").select(F.explode(C.surfaces(F.col("text"))).alias("surface")).distinct().filter(F.col("surface").rlike("^[A-Za-z]+$"))
    return rows.select("surface", C.is_exception_key("surface").alias("is_key"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'INVALID' WHEN c_custkey % 5 = 1 THEN 'DUPLICATE' END AS list_problem,
  CASE WHEN c_custkey % 4 = 0 THEN 'SPOKEN_TEXT_DIFFERS' WHEN c_custkey % 4 = 1 THEN 'INVALID_INDEX' WHEN c_custkey % 4 = 2 THEN 'INVALID_JSON' END AS override_problem, CASE WHEN c_custkey % 4 = 3 THEN c_custkey END AS token_index FROM customer""")
def loader_checks(spark, sf_dir):
    """Customers as lists of sources and as override files of four kinds, one of which is right."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(k % 5 == 0, F.array(F.lit("a"), F.lit(""))).when(k % 5 == 1, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("sources"), F.col("c_name").alias("spoken"))
    index = F.when(k % 4 == 1, F.concat(F.lit("0"), k.cast("string"))).otherwise(k.cast("string"))
    digest = F.when(k % 4 == 0, "0").otherwise(_sha(F.col("spoken")))
    text = F.concat(F.lit('{"spoken_text_sha256": "'), digest, F.lit('", "overrides": {"'), index, F.lit('": {"stress_index": null, "ipa": "a", "model_phonemes": ["a"]}}'), F.when(k % 4 == 2, "").otherwise("}"))
    found = rows.withColumn("o", C.overrides(text, F.col("spoken")))
    return found.select("c_custkey", C.strings_problem(F.col("sources")).alias("list_problem"), F.col("o.error").alias("override_problem"), F.get("o.overrides", F.lit(0))["token_index"].cast("long").alias("token_index"))


@query(f"""
SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R' AND l_orderkey % 3 = 0) THEN 'TOKENS_DIFFER' WHEN bool_or(l_linestatus = 'O' AND l_orderkey % 5 = 0) THEN 'NEW_WARNING' ELSE 'NOT_FEWER_WARNINGS' END AS problem FROM {_LINES} GROUP BY l_orderkey
HAVING bool_or(l_returnflag = 'R' AND l_orderkey % 3 = 0) OR bool_or(l_linestatus = 'O' AND l_orderkey % 5 = 0) OR NOT bool_or(l_returnflag = 'N')""")
def resolution_audit(spark, sf_dir):
    """Line items as tokens with a warning each: it goes where the flag is N; some tokens go too, some get another warning."""
    rows = _lines(spark, sf_dir)
    tokens = rows.select("l_orderkey", F.col("l_linenumber").alias("token_index"), F.array(F.lit("w")).alias("warning_codes"))
    fresh = F.when((F.col("l_linestatus") == "O") & (F.col("l_orderkey") % 5 == 0), F.array(F.lit("new"))).otherwise(F.array().cast("array<string>"))
    kept = F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(F.array(F.lit("w")))
    after = rows.filter("not (l_returnflag = 'R' and l_orderkey % 3 = 0)").select("l_orderkey", F.col("l_linenumber").alias("token_index"), F.concat(kept, fresh).alias("warning_codes"))
    return corpus.resolution_steps(tokens, after, "l_orderkey")


@query("""
SELECT n AS position, o_orderkey AS o, CASE WHEN o_orderkey % 4 = 0 THEN 'MISSING' WHEN o_orderkey % 4 = 1 THEN 'SHA256_MISMATCH' END AS problem
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 300))""")
def selection_matches(spark, sf_dir):
    """A selection of 300 orders, stored as parallel arrays; a quarter of them is gone by now, a quarter has another digest."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("rec-"), F.col("o_orderkey").cast("string")).alias("recording_id"), _sha(F.col("o_orderkey")).alias("sha256"))
    first = orders.orderBy("o_orderkey").limit(300)
    listed = F.array_sort(F.collect_list(F.struct("o_orderkey", "recording_id", "sha256")))
    stored = first.agg(listed.alias("x")).select(F.col("x.recording_id").alias("recording_ids"), F.col("x.sha256").alias("inventory_hashes"))
    now = orders.filter("o_orderkey % 4 <> 0").withColumn("sha256", F.when(F.col("o_orderkey") % 4 == 1, "x").otherwise(F.col("sha256"))).drop("o_orderkey")
    found = documents.selected_recordings(corpus.selection_rows(stored), now)
    return found.select(long(F.col("position")).alias("position"), F.substring("recording_id", 5, 20).cast("long").alias("o"), "problem")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey % 3 = 0")
def unusable_rights(spark, sf_dir):
    """Customers as rights: builders allow no training, every third nation no internal evaluation."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lit(True).alias("allow_local_processing"), (F.col("c_mktsegment") != "BUILDING").alias("allow_model_training"), (F.col("c_nationkey") % 3 != 0).alias("allow_internal_evaluation"))
    return documents.unauthorized(rows, evaluation=True).select("c_custkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'SHA256_INVALID' WHEN o_orderkey % 5 = 1 THEN 'RECORDING_ID_MISMATCH' ELSE 'UNKNOWN_STATE' END AS problem FROM orders WHERE o_orderkey % 5 < 3""")
def recording_audit(spark, sf_dir):
    """Orders as recordings of three kinds of fault."""
    k = F.col("o_orderkey")
    sha = F.when(k % 5 == 0, F.upper(F.concat(_sha(k), F.lit("x")))).otherwise(_sha(k))
    rows = table(spark, sf_dir, "orders").select(k, sha.alias("sha256"), F.concat(F.lit("rec-"), F.substring(F.when(k % 5 == 1, _sha(F.concat(F.lit("x"), k.cast("string")))).otherwise(sha), 1, 12)).alias("recording_id"), F.when(k % 5 == 2, "LOST").otherwise("PAIRED").alias("state"))
    found = documents.recording_problems(rows).filter("problem <> 'DUPLICATE_RECORDING_ID'")
    return found.join(rows.select("recording_id", "o_orderkey"), "recording_id").select("o_orderkey", "problem")


@query("""
WITH s AS (SELECT o_custkey AS c, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders)
SELECT CAST(c AS VARCHAR) AS recording_id, CASE WHEN c % 3 = 2 THEN 'inconsistent' WHEN c % 3 = 0 OR max(m) < 1 THEN 'current' ELSE 'recover' END AS status FROM s GROUP BY c""")
def recoverable_states(spark, sf_dir):
    """A customer's orders as steps of a chain; the stored state is the last one, one before it, or none of the chain."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    steps = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("recording_id"), n.alias("seq"), F.concat(F.lit("s"), (n - 1).cast("string")).alias("previous_state"), F.concat(F.lit("s"), n.cast("string")).alias("target_state"))
    k = F.col("recording_id").cast("long") % 3
    now = steps.groupBy("recording_id").agg(F.max_by(F.struct("previous_state", "target_state"), "seq").alias("x"))
    state = F.when(k == 0, F.col("x.target_state")).when(k == 1, F.col("x.previous_state")).otherwise("lost")
    return evidence.recovery(steps, now.select("recording_id", state.alias("state"))).select("recording_id", "status")


@query("""
WITH t AS (SELECT l_orderkey AS o, CASE WHEN l_returnflag = 'R' THEN 'rejected' ELSE 'approved' END AS d, l_quantity AS s, (l_orderkey + l_linenumber) % 10 = 0 AS m FROM lineitem),
a AS (SELECT count(*) AS n_takes, sum(CASE WHEN d = 'approved' THEN s ELSE 0 END) AS ap, sum(s) AS al, avg(CASE WHEN m THEN 0.0 ELSE 1.0 END) AS b FROM t),
o AS (SELECT sum(CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE 0 END) AS inp, sum(100) AS total, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE 1.0 END) AS auto FROM orders)
SELECT n_takes, round(auto, 6) AS auto_pairing_ratio, round(b, 6) AS boundary_unchanged_ratio, round(5000.0 / inp, 6) AS review_ratio, round(ap / al, 6) AS approved_ratio,
  CASE WHEN auto < 0.85 OR b < 0.70 OR 5000.0 / inp > 6 OR ap / al < 0.60 THEN 'not_ready' WHEN auto >= 0.95 AND b >= 0.85 AND 5000.0 / inp <= 3 AND ap / al >= 0.80 THEN 'scalable' ELSE 'optimize' END AS verdict FROM a, o""")
def pilot_report(spark, sf_dir):
    """The whole report: orders as recordings of 100 seconds and as groups, line items as takes, every tenth with moved ends."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    recordings = orders.select(F.col("o_orderkey").alias("recording_id"), F.lit(100.0).alias("duration_seconds"), (F.col("o_orderkey") % 2 == 0).alias("selected"))
    speech = orders.select(F.lit(0).alias("start"), F.lit(160_000).alias("end"))
    entity = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    takes = lines.select(entity.alias("entity_id"), F.when(F.col("l_returnflag") == "R", "rejected").otherwise("approved").alias("decision"), F.col("l_quantity").cast("double").alias("seconds"))
    moved = lines.filter((F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0).select(entity.alias("entity_id"), F.lit("segment_start").alias("field"))
    telemetry = spark.createDataFrame([(5000.0, 1000.0, 300.0, 10**9)], "review_seconds double, text_preparation_seconds double, alignment_wall_seconds double, pilot_storage_bytes bigint")
    one = report.kpi_report(recordings, speech, orders.select((F.col("o_orderpriority") != "1-URGENT").alias("automatic")), takes, moved, telemetry)
    return one.select("n_takes", *[F.round(c, 6).alias(c) for c in ("auto_pairing_ratio", "boundary_unchanged_ratio", "review_ratio", "approved_ratio")], "verdict")


@query("""
WITH v AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + CASE WHEN event_id % 10 = 0 THEN 7200000000 ELSE 1000 END AS e FROM events),
x AS (SELECT user_id, s, e, lag(e) OVER (PARTITION BY user_id ORDER BY s, e) AS p FROM v)
SELECT user_id, count(*) AS n FROM x WHERE e <= s OR p > s GROUP BY user_id""")
def long_speech_overlaps(spark, sf_dir):
    """Events as speech; every tenth lasts two hours and runs into what follows."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    speech = table(spark, sf_dir, "events").select("user_id", us.alias("start"), (us + F.when(F.col("event_id") % 10 == 0, 7_200_000_000).otherwise(1000)).alias("end"))
    return intervals.order_violations(speech, "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


@query(f"""
WITH u AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n FROM {_LINES} WHERE (l_orderkey + l_linenumber) % 6 <> 0),
r AS (SELECT l_orderkey, l_linenumber, n, sum(n) OVER w AS e, row_number() OVER w AS k FROM u WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT l_orderkey, count(*) AS n_bad FROM r WHERE k <> l_linenumber OR n <= 0 GROUP BY l_orderkey""")
def line_range_violations(spark, sf_dir):
    """Line items as units with token ranges; one in six is lost, which skips an ordinal."""
    lines = _lines(spark, sf_dir).filter("(l_orderkey + l_linenumber) % 6 <> 0").select("l_orderkey", F.col("l_linenumber").alias("ordinal"), F.col("l_quantity").cast("long").alias("n"))
    end = F.sum("n").over(Window.partitionBy("l_orderkey").orderBy("ordinal"))
    units = lines.withColumn("token_end", end).withColumn("token_start", F.col("token_end") - F.col("n"))
    return intervals.contiguity_violations(units, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n_bad"))


@query("""
SELECT c_custkey AS custkey, 'left' AS side FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0
UNION ALL SELECT c_custkey, 'right' FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 7 <> 0""")
def shifted_set_differences(spark, sf_dir):
    """Customers without every fifth against those without every seventh."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return corpus.set_differences(keys.filter("custkey % 5 <> 0"), keys.filter("custkey % 7 <> 0"), "custkey")
