"""Further queries: what is written is read again and checked, and the rules of selection, approval and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import tables as T
from cantor.operators import audio, corpus, pronunciation, report
from cantor.operators import events as journal
from cantor.plans import stages
from cantor.plans.catalog import _SURFACES, long, query, table
from cantor.plans.evidence_catalog import _LINES, ORACLES, QUERIES, STAMP, _lines, _sha
from cantor.sources import documents, files, jsonl
from cantor.sources.scratch import shared_folder

__all__ = ["ORACLES", "QUERIES"]


@query("""
SELECT fault, count(*) AS n FROM (SELECT CASE c_custkey % 7 WHEN 0 THEN 'DUPLICATE_KEY' WHEN 1 THEN 'NON_STANDARD_CONSTANT' WHEN 2 THEN 'INVALID_JSON' WHEN 3 THEN 'NOT_AN_OBJECT' WHEN 4 THEN 'FIELDS_DIFFER' WHEN 5 THEN 'INVALID_ROW' END AS fault FROM customer)
GROUP BY fault""")
def strict_line_faults(spark, sf_dir):
    """Customers as JSON lines, six of seven spoiled in one way each, read again with their faults."""
    k, key = F.col("c_custkey") % 7, F.col("c_custkey").cast("string")
    forms = {0: '{"a": %s, "a": 1, "b": "x"}', 1: '{"a": %s, "b": NaN}', 2: '{"a": %s, "b": ', 3: '[%s]', 4: '{"a": %s, "c": "x"}', 5: '{"a": "%s", "b": "x"}', 6: '{"b": "x", "a": %s}'}
    line = F.lit("")
    for i, form in forms.items():
        line = F.when(k == i, F.format_string(form, key)).otherwise(line)
    path = shared_folder(spark, "lines")
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    rows = jsonl.read_strict(spark, path, "a long, b string", fail=False)
    return rows.groupBy(F.col("_fault").alias("fault")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def snapshot_round_trip(spark, sf_dir):
    """Orders as canonical lines in a snapshot, read again strictly through its pointer."""
    root = shared_folder(spark, "snapshot")
    rows = table(spark, sf_dir, "orders").select(*(long(F.col(c)).alias(c) for c in ("o_orderkey", "o_custkey")), "o_orderstatus", "o_orderpriority")
    jsonl.write_snapshot(rows, root, ["o_orderkey"])
    return jsonl.read_strict(spark, jsonl.current_snapshot(spark, root), "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")


@query("SELECT o_orderkey, sha256('{\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || '}') AS line_sha FROM orders")
def canonical_line_digests(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = jsonl.canonical_lines(rows)
    return lines.select(F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"), F.sha2(F.col("value").cast("binary"), 256).alias("line_sha"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS recording_id, count(*) AS n FROM orders GROUP BY 1")
def persisted_events(spark, sf_dir):
    """Orders as events, persisted in two overlapping batches: each is in the journal once."""
    root = shared_folder(spark, "journal")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("event_id"), F.col("o_custkey").cast("string").alias("recording_id")).distinct()
    state = rows.select("recording_id").distinct().withColumn("state", F.lit("PAIRED"))
    for batch in (rows.filter("event_id % 3 <> 0"), rows.filter("event_id % 3 <> 1")):
        jsonl.persist_transition(batch, state, f"{root}/events", f"{root}/state")
    return spark.read.parquet(f"{root}/events").groupBy("recording_id").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_nationkey % 3 = 0 OR c_mktsegment = 'BUILDING' AS usable FROM customer")
def rights_round_trip(spark, sf_dir):
    """Customers as rights, written and read without their filter; those for which it would fail are marked."""
    root = shared_folder(spark, "rights")
    k = F.col("c_nationkey") % 3 == 0
    values = {"rights_id": F.col("c_custkey").cast("string"), "allow_local_processing": F.lit(True), "allow_model_training": k | (F.col("c_mktsegment") == "BUILDING"), "allow_internal_evaluation": F.lit(False)}
    rows = table(spark, sf_dir, "customer").select(*[values.get(c.split()[0], F.lit("x")).alias(c.split()[0]) for c in files.RIGHTS.split(", ")])
    read = documents.read_rights(spark, jsonl.write_snapshot(rows, root), authorized=False)
    bad = documents.unauthorized(read).select("rights_id", F.lit(False).alias("usable"))
    return read.join(bad, "rights_id", "left").select(F.col("rights_id").cast("long").alias("c_custkey"), F.coalesce("usable", F.lit(True)).alias("usable"))


@query("SELECT 'raw/' || CASE WHEN p_partkey % 3 = 0 THEN 'sung/' ELSE 'spoken/' END || p_partkey || '.wav' AS relative_path, CASE WHEN p_partkey % 3 = 0 THEN 'sung' ELSE 'spoken' END AS content_type, '.wav' AS suffix, p_name AS title_or_citation FROM part")
def intake_round_trip(spark, sf_dir):
    """Parts as rows of an intake table, written as CSV and read with its checks."""
    path = F.concat(F.lit("raw/"), F.when(F.col("p_partkey") % 3 == 0, "sung/").otherwise("spoken/"), F.col("p_partkey").cast("string"), F.lit(".wav"))
    root = shared_folder(spark, "intake")
    table(spark, sf_dir, "part").select(path.alias("relative_path"), F.col("p_name").alias("title_or_citation"), F.lit("s").alias("speaker_id"), F.lit("r").alias("rights_id"), F.lit("n").alias("notes")).write.csv(root, header=True)
    rows = files.read_intake(spark, root)
    return rows.select("relative_path", C.content_type(F.col("relative_path")).alias("content_type"), C.audio_suffix(F.col("relative_path")).alias("suffix"), "title_or_citation")


@query("""
SELECT o_orderkey, 'rec-' || left(sha256(o_orderstatus), 12) AS recording_id, left(sha256(CAST(o_orderkey AS VARCHAR) || chr(0) || o_orderstatus || chr(0) || 'v'), 24) AS run_id, sha256('rec-' || o_orderkey) AS slug,
  'state-' || left(sha256('{"config_sha256":"c","input_sha256s":["' || o_orderstatus || '"],"previous_state":"SEGMENTED","recording_id":"rec-' || o_orderkey || '","result":"success","target_state":"PAIRED","tool_versions":["t"]}'), 16) AS event_id,
  'review-' || sha256('{"after":' || o_orderkey || ',"before":null,"entity_id":"' || o_orderkey || '","field":"f","reason":"r","reviewed_at":"2024-01-01T00:00:00+00:00","reviewer":"me","schema_version":"1"}') AS review_event_id FROM orders""")
def order_ids(spark, sf_dir):
    """Every other content-addressed id of orders: recordings, smoke runs, slugs, processing and review events."""
    key = F.col("o_orderkey").cast("string")
    name = F.concat(F.lit("rec-"), key)
    fixed = {"schema_version": "1", "field": "f", "reason": "r", "reviewer": "me", "reviewed_at": STAMP, "config_sha256": "c", "result": "success", "previous_state": "SEGMENTED", "target_state": "PAIRED"}
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", C.recording_id(F.col("o_orderstatus")).alias("own"), C.smoke_run_id(key, F.col("o_orderstatus"), F.lit("v")).alias("run_id"), C.review_slug(name).alias("slug"), name.alias("recording_id"), key.alias("entity_id"), F.lit(None).cast("string").alias("before"),
        key.alias("after"), F.array("o_orderstatus").alias("input_sha256s"), F.array(F.lit("t")).alias("tool_versions"), *[F.lit(v).alias(k) for k, v in fixed.items()],
    )
    return journal.review_event_id(journal.event_id(rows)).select("o_orderkey", F.col("own").alias("recording_id"), "run_id", "slug", "event_id", "review_event_id")


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'rejected' WHEN l_returnflag = 'N' THEN 'unreviewed' WHEN l_linenumber % 3 = 0 THEN 'PRONUNCIATION_NEEDS_REVIEW' ELSE 'approved' END AS status FROM {_LINES}""")
def take_approval(spark, sf_dir):
    """Line items as takes: returned (R) are rejected whatever they warn of, A are approved where they don't warn."""
    flag = F.col("l_returnflag")
    decision = F.when(flag == "R", "rejected").when(flag == "A", "approved").otherwise("unreviewed")
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", corpus.approval(decision, (F.col("l_linenumber") % 3 == 0).cast("int")).alias("status"))


@query(f"""
WITH t AS (SELECT 'o' || l_orderkey AS r, l_linenumber AS n, l_quantity AS q FROM {_LINES} WHERE l_returnflag = 'A' AND l_linenumber % 3 <> 0)
SELECT r AS recording_id, n AS take_index, 'segment-' || left(sha256(r || chr(0) || 'g' || chr(0) || n), 24) AS segment_id, CAST(n * 16000 AS BIGINT) AS source_start_sample, CAST(round_even((n + q / 100) * 16000, 0) AS BIGINT) AS source_end_sample FROM t""")
def approved_line_segments(spark, sf_dir):
    """Approved takes without warnings as segments in native samples."""
    n = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    takes = _lines(spark, sf_dir).select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("recording_id"), F.lit("g").alias("group_id"), n.alias("take_index"), n.cast("double").alias("segment_start"), (n + F.col("l_quantity") / 100).alias("segment_end"), F.lit(16000).alias("sample_rate"),
        F.when(flag == "A", "approved").otherwise("rejected").alias("decision"), (n % 3 == 0).cast("int").alias("n_warnings"), F.array(F.struct(F.lit("w").alias("text"), n.cast("double").alias("start_seconds"), (n + 0.1).alias("end_seconds"))).alias("word_spans"),
    )
    return corpus.approved_segments(takes).select("recording_id", "take_index", "segment_id", "source_start_sample", "source_end_sample")


@query("""
SELECT 'p' || p_partkey AS relative_path, 'rec-' || left(sha256(CAST(p_partkey AS VARCHAR)), 12) AS recording_id,
  CASE WHEN p_partkey % 4 = 0 OR p_partkey % 5 = 0 THEN 'RIGHTS_SCOPE_UNCONFIRMED' END AS issue FROM part WHERE p_partkey % 6 <> 0
UNION ALL SELECT 'p' || p_partkey, NULL, CASE WHEN p_partkey % 4 = 0 OR p_partkey % 5 = 0 THEN 'RIGHTS_SCOPE_UNCONFIRMED' ELSE 'AUDIO_MISSING' END FROM part WHERE p_partkey % 6 = 0""")
def part_inventory(spark, sf_dir):
    """Parts as intake rows: every fourth's rights allow no training, every fifth's are another speaker's, every sixth has no file."""
    k = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(k, F.concat(F.lit("p"), k.cast("string")).alias("relative_path"))
    intake = parts.select("relative_path", F.lit("t").alias("title_or_citation"), F.lit("s").alias("speaker_id"), k.cast("string").alias("rights_id"), F.lit("").alias("notes"))
    rights = parts.select(k.cast("string").alias("rights_id"), F.when(k % 5 == 0, "other").otherwise("s").alias("speaker_id"), F.lit(True).alias("allow_local_processing"), (k % 4 != 0).alias("allow_model_training"))
    probes = parts.filter("p_partkey % 6 <> 0").select("relative_path", _sha(k).alias("sha256"), F.lit("m").alias("metadata"))
    return corpus.inventory(intake, rights, probes).select("relative_path", "recording_id", "issue")


@query("""
WITH c AS (SELECT l_orderkey AS o, l_suppkey AS s, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS sel FROM lineitem GROUP BY 1, 2)
SELECT CAST(o AS VARCHAR) AS recording_id, CAST(sum(sel) AS BIGINT) AS n_selected FROM c GROUP BY o HAVING sum(sel) <> 1""")
def candidate_selection(spark, sf_dir):
    """An order's suppliers as candidate texts, of which exactly one must be chosen."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg((F.max(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)) == 1).alias("selected"))
    intake = rows.groupBy(F.col("l_orderkey").cast("string").alias("recording_id")).agg(F.collect_list(F.struct(F.col("l_suppkey").cast("string").alias("source_id"), F.lit("1").alias("source_version"), "selected")).alias("source_candidates"))
    texts = rows.select(F.col("l_orderkey").cast("string").alias("recording_id"), F.col("l_suppkey").cast("string").alias("source_id"), F.lit("text").alias("text"))
    return corpus.selection_problems(corpus.text_candidates(intake, texts))


@query(f"""
WITH v AS (SELECT l_orderkey AS o, CAST(l_linenumber AS DOUBLE) AS n, l_returnflag AS f FROM {_LINES})
SELECT o AS l_orderkey, n AS start, n + CAST(0.5 AS DOUBLE) AS "end", f AS text FROM v
UNION ALL SELECT o, lag(n, 1, CAST(-0.5 AS DOUBLE)) OVER (PARTITION BY o ORDER BY n) + CAST(0.5 AS DOUBLE), n, '' FROM v
UNION ALL SELECT o, max(n) + CAST(0.5 AS DOUBLE), CAST(9 AS DOUBLE), '' FROM v GROUP BY o""")
def textgrid_round_trip(spark, sf_dir):
    """An order's lines as words of half a second in a file of nine; written as TextGrids and read again, with the gaps."""
    n = F.col("l_linenumber").cast("double")
    words = _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(n.alias("start"), (n + 0.5).alias("end"), F.col("l_returnflag").alias("text")))).alias("words"))
    grids = words.select("l_orderkey", files.textgrid(F.lit(9.0), F.col("words")).alias("grid"))
    found = grids.select("l_orderkey", F.explode(files.textgrid_intervals("grid")).alias("i"))
    return found.select("l_orderkey", "i.start", "i.end", "i.text")


_GOLD_SQL = """
WITH g AS (SELECT p_partkey AS line, p_partkey % 9 <> 0 AS valid, CASE WHEN p_partkey % 8 = 0 THEN ' ' ELSE 'w' || p_partkey // 2 END AS word, CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 1 END AS stress, CASE WHEN p_partkey % 5 = 0 THEN 'draft' ELSE 'approved' END AS state,
    CASE WHEN p_partkey % 11 = 0 THEN 'nowhere' ELSE 'perseus-lewis-short' END AS src, p_size % 3 AS cat FROM part)
SELECT code, count(*) AS n FROM (
  SELECT 'INVALID_ROW' AS code FROM g WHERE NOT valid UNION ALL SELECT 'EMPTY_FIELD' FROM g WHERE valid AND word = ' ' UNION ALL SELECT 'INVALID_STRESS' FROM g WHERE valid AND stress = 5
  UNION ALL SELECT 'UNAPPROVED_ENTRY' FROM g WHERE valid AND state = 'draft' UNION ALL SELECT 'UNKNOWN_SOURCE' FROM g WHERE valid AND src = 'nowhere'
  UNION ALL SELECT 'DUPLICATE_WORD' FROM (SELECT word, unnest(range(count(*) - 1)) FROM g WHERE valid GROUP BY word HAVING count(*) > 1)
  UNION ALL SELECT 'CATEGORY_MINIMUM_NOT_MET' FROM (SELECT 1 WHERE (SELECT count(*) FROM g WHERE valid AND cat = 1) < 1000000)) GROUP BY code"""


@query(_GOLD_SQL)
def gold_audit(spark, sf_dir):
    """Parts as gold rows with faults of six kinds."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        k.alias("line"), (k % 9 != 0).alias("valid"), F.when(k % 8 == 0, " ").otherwise(F.concat(F.lit("w"), F.floor(k / 2).cast("string"))).alias("word"), F.lit("n").alias("normalized"), F.array(F.lit("a"), F.lit("b")).alias("syllables"), F.when(k % 7 == 0, 5).otherwise(1).alias("stress_index"),
        F.lit("i").alias("ipa"), (F.col("p_size") % 3).cast("string").alias("category"), F.array(F.lit("r")).alias("rule_ids"), F.array(F.when(k % 11 == 0, "nowhere").otherwise("perseus-lewis-short")).alias("source_ids"), F.when(k % 5 == 0, "draft").otherwise("approved").alias("review_state"),
    )
    return report.audit_gold(rows, {"1": 1_000_000}, 0).groupBy("code").agg(F.count("*").alias("n"))


@query("""
SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS made FROM events WHERE user_id % 2 = 0""")
def materialized_artifacts(spark, sf_dir):
    """Users of even number want their events; purchases have to be made, the others are stored."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_id").cast("string").alias("cache_key"), "event_type")
    stored = rows.filter("event_type <> 'purchase'").select("cache_key", "user_id", "event_id", F.lit(0).alias("made"))
    wanted = rows.filter("user_id % 2 = 0")
    found = corpus.materialize(wanted, stored, lambda misses: misses.select("cache_key", "user_id", "event_id", F.lit(1).alias("made")))
    return found.drop("cache_key")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'read <path> and <project>/a' WHEN c_custkey % 3 = 1 THEN 'in <project>/data/x.wav' ELSE 'lib==1.0 @ <source>' END AS said FROM customer""")
def redacted_messages(spark, sf_dir):
    """Messages with places in them, and requirement lines with sources."""
    k = F.col("c_custkey")
    message = F.when(k % 3 == 0, "read /home/me/x.wav and /srv/project/a").otherwise("in /srv/project/data/x.wav")
    said = F.when(k % 3 == 2, C.redact_freeze(F.lit("lib==1.0 @ file:///home/me/lib"))).otherwise(C.redact_paths(message, "/srv/project"))
    return table(spark, sf_dir, "customer").select("c_custkey", said.alias("said"))


_KNOWN = ", ".join(f"'{s}'" for s in sorted(T.SOURCES))


@query(f"SELECT p_partkey, p_name AS stranger FROM part WHERE p_partkey % 3 = 0 AND p_name NOT IN ({_KNOWN})")
def unknown_part_sources(spark, sf_dir):
    """Every third part names a source that isn't registered."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array(F.lit("perseus-lewis-short"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise("liber-usualis-1962")).alias("source_ids"))
    return pronunciation.unknown_sources(rows).select("p_partkey", F.get("unknown_sources", F.lit(0)).alias("stranger"))


@query("""
WITH o AS (SELECT o_custkey AS c, count(*) FILTER (WHERE o_orderstatus = 'F') AS a, count(*) FILTER (WHERE o_orderstatus = 'P') AS u, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(c AS VARCHAR) AS recording_id, CASE WHEN a > 0 THEN 'APPROVED' WHEN u = 0 THEN 'REJECTED' ELSE 'REVIEWED' END AS state FROM o""")
def finished_recordings(spark, sf_dir):
    """Customers as reviewed recordings; finished orders are approved takes, open ones rejected, others undecided."""
    status = F.col("o_orderstatus")
    takes = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("recording_id"), F.when(status == "F", "approved").when(status == "O", "rejected").otherwise("unreviewed").alias("decision"))
    recordings = takes.select("recording_id").distinct().withColumn("state", F.lit("REVIEWED"))
    return stages.finish(recordings, takes)[0].select("recording_id", "state")


@query("""
WITH o AS (SELECT o_orderkey AS o FROM orders)
SELECT 'r/g' || o || '/1/decision.json' AS path, 'MISSING' AS problem FROM o WHERE o % 5 = 0
UNION ALL SELECT 'r/g' || o || '/1/automatic.json', 'CHANGED' FROM o WHERE o % 7 = 0
UNION ALL SELECT 'extra', 'EXTRA'""")
def review_bundle_audit(spark, sf_dir):
    """A bundle of orders as takes that comes back with files lost, changed and added."""
    takes = table(spark, sf_dir, "orders").select(F.lit("r").alias("recording_id"), F.concat(F.lit("g"), F.col("o_orderkey").cast("string")).alias("group_id"), F.lit(1).alias("take_index"), F.lit(0.0).alias("segment_start"), F.lit(1.0).alias("segment_end"))
    out = stages.review_bundle(takes)
    order = F.regexp_extract("path", r"^r/g(\d+)/", 1).cast("long")
    lost = F.endswith("path", F.lit("/decision.json")) & (order % 5 == 0)
    content = F.when(F.endswith("path", F.lit("/automatic.json")) & (order % 7 == 0), "{}").when(F.endswith("path", F.lit("/decision.json")), "decided").otherwise(F.col("content"))
    back = out.filter(~lost).select("path", content.alias("content")).unionByName(spark.createDataFrame([("extra", "x")], "path string, content string"))
    return stages.bundle_problems(out, back)


def _little(x, digits: int):
    """A whole number's little-endian bytes, as hex digits."""
    text = F.lpad(F.hex(x), digits, "0")
    return F.concat(*[F.substring(text, i, 2) for i in range(digits - 1, 0, -2)])


@query("""
SELECT p_partkey, 1 AS channels, 16000 AS sample_rate, CAST(p_size AS BIGINT) AS samples, round((p_partkey % 700) / 32768.0, 9) AS peak, round((p_partkey % 700) / 32768.0, 9) AS rms,
  CAST(CASE WHEN p_partkey % 700 <= 327 THEN 1 ELSE 0 END AS DOUBLE) AS silent_ratio, CASE WHEN p_size % 2 = 1 THEN 'SAMPLES' END AS problem FROM part WHERE p_size > 0""")
def wav_checks(spark, sf_dir):
    """Parts as 16 kHz mono WAV files of as many equal samples as their size; odd ones were asked for two more."""
    n, level = F.col("p_size").cast("int"), (F.col("p_partkey") % 700).cast("int")
    head = F.concat(F.lit("52494646"), _little(36 + 2 * n, 8), F.lit("57415645666D74201000000001000100803E0000007D00000200100064617461"), _little(2 * n, 8))
    rows = table(spark, sf_dir, "part").filter("p_size > 0").select("p_partkey", n.alias("n"), F.unhex(F.concat(head, F.repeat(_little(level, 4), n))).alias("content"))
    found = rows.select("p_partkey", "n", files.wav_measures("content").alias("m"), audio.wav_layout("content").alias("l"))
    problem = audio.analysis_problem(F.col("l"), F.col("n") + F.when(F.col("n") % 2 == 1, 2).otherwise(0))
    return found.select("p_partkey", "m.channels", "m.sample_rate", "m.samples", F.round("m.peak", 9).alias("peak"), F.round("m.rms", 9).alias("rms"), "m.silent_ratio", problem.alias("problem"))


@query(f"""
WITH t AS (SELECT conv_id, len({_SURFACES.format("text")}) AS n FROM conversations WHERE turn = 0 AND text IS NOT NULL)
SELECT conv_id, n <= conv_id % 40 AS unknown FROM t""")
def override_audit(spark, sf_dir):
    """An override of one token of each conversation's first turn, which not every turn has."""
    turns = table(spark, sf_dir, "conversations").filter("turn = 0 and text is not null")
    fixes = turns.select("conv_id", (F.col("conv_id") % 40).cast("int").alias("token_index"), F.lit(None).cast("int").alias("stress_index"), F.lit("a").alias("ipa"), F.array(F.lit("a")).alias("phonemes"))
    plans = pronunciation.analyze(turns, "conv_id", overrides=fixes)
    return plans.select("conv_id", F.col("error_code").eqNullSafe("OVERRIDE_UNKNOWN_TOKEN").alias("unknown"))


@query(f"SELECT doc_id, n AS n_tokens, n AS n_right FROM (SELECT doc_id, len({_SURFACES.format('text')}) AS n FROM documents WHERE text IS NOT NULL) WHERE n > 0")
def token_offsets(spark, sf_dir):
    """Tokens that stand in their document where they say they do."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text is not null")
    spans = C.word_spans(docs).filter(F.size("spans") > 0)
    return spans.select("doc_id", long(F.size("spans")).alias("n_tokens"), long(C.words_in_place("text", "spans")).alias("n_right"))
