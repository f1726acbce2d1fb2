"""Intervals, selection, transcripts, journals, audit, report, files."""

import io
import json
import math
import struct
import wave

import pytest
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.operators import corpus, events, intervals, report
from cantor.sources import files, jsonl
from cantor.streaming import reviews

IV = "rec string, start long, end long"


def iv(spark, *pairs):
    return spark.createDataFrame([("r", a, b) for a, b in pairs], IV)


def classify(spark, lengths):
    at, out = 0, []
    for n in lengths:
        out.append((at + 1000, at + 1000 + n))
        at += 1000 + n
    rows = intervals.classify_pauses(iv(spark, *out), "rec", 1000).orderBy("start").collect()
    return rows[0].status if rows[0].status != "ok" else " ".join(r.kind for r in rows)


def test_pauses(spark):
    speech = iv(spark, (0, 1000), (1200, 2000), (4000, 5000), (5250, 6000), (7800, 8500))
    found = intervals.gaps(speech, "rec", 100, 1000)
    assert sorted((r.start, r.end) for r in found.collect()) == [(1000, 1200), (2000, 4000), (5000, 5250), (6000, 7800)]
    assert [r.kind for r in intervals.classify_pauses(found, "rec", 1000).orderBy("start").collect()] == ["short", "long", "short", "long"]
    assert classify(spark, [200] * 4) == "PAUSE_CLASSES_AMBIGUOUS" and classify(spark, [200]) == "PAUSE_CLASSES_AMBIGUOUS"
    assert classify(spark, [180, 220, 1900, 2100, 20000]) == "short short long long long"
    assert intervals.order_violations(iv(spark, (0, 10), (5, 20), (30, 30)), "rec").count() == 2
    assert intervals.gaps(iv(spark), "rec").count() == 0
    with pytest.raises(ValueError):
        intervals.classify_pauses(found, "rec", 1000, minimum_gap_count=3)


def test_windows(spark):
    speech = iv(spark, (100, 1000), (1200, 2000), (2800, 3700), (3900, 5000))
    pauses = spark.createDataFrame([("r", 1000, 1200, "short"), ("r", 2000, 2800, "long"), ("r", 3700, 3900, "short")], IV + ", kind string")
    units = spark.createDataFrame([("r", 1, "unit-1", "Pater noster"), ("r", 2, "unit-2", "qui es")], "rec string, ordinal int, unit_id string, text string")
    got = intervals.unit_windows(speech, pauses, units, "rec").orderBy("ordinal").collect()
    assert [(r.unit_id, r.start, r.end, [tuple(p) for p in r.short_pauses], r.status) for r in got] == [("unit-1", 100, 2400, [(1000, 1200)], "ok"), ("unit-2", 2400, 5000, [(3700, 3900)], "ok")]
    assert [r.split for r in intervals.split_candidates(intervals.unit_windows(speech, pauses, units, "rec"), "rec").orderBy("split").collect()] == [1100, 3800]
    assert {r.status for r in intervals.unit_windows(speech, pauses.filter("kind = 'short'"), units, "rec").collect()} == {"TRANSCRIPT_SPOKEN_MISMATCH"}


@pytest.mark.parametrize(("candidates", "margin", "outcome"), [
    ([(4750, 0.92, 0.90, True, 0.95)], 0.02, "selected"), ([(4750, 0.9, 0.9, False, 0.95)], 0.02, "TAKE_TEXT_MISMATCH"), ([], 0.02, "TAKE_COUNT_MISMATCH"), ([(1750, 0.95, 0.95, True, 1.0)], 0.02, "TAKE_DURATION_MISMATCH"),
    ([(4500, 0.91, 0.90, True, 1.0), (5500, 0.90, 0.90, True, 1.0)], 0.02, "TAKE_COUNT_MISMATCH"), ([(4500, 0.9, 0.9, True, 1.0), (5500, 0.9, 0.9, True, 1.0)], 0.0, "TAKE_COUNT_MISMATCH"),
])
def test_choose_split(spark, candidates, margin, outcome):
    evidence = spark.createDataFrame([("r", *c) for c in candidates], "rec string, split long, first_score double, second_score double, word_order_same boolean, coverage double")
    got = intervals.choose_split(iv(spark, (0, 10000)), evidence, ["rec"], minimum_score_margin=margin).first()
    assert got.outcome == outcome and got.split == (4750 if outcome == "selected" else None)


def test_foreign_split_and_grid(spark):
    s = spark.createDataFrame([("r", 4999)], "rec string, split long")
    assert intervals.foreign_splits(s, s.withColumn("split", F.lit(4750).cast("long")), ["rec"]).count() == 1
    grid = intervals.frame_grid(spark.createDataFrame([("r", 1030), ("z", 0)], "rec string, n long"), "rec", "n").orderBy("frame").collect()
    assert [(r.start, r.end) for r in grid] == [(0, 512), (512, 1024), (1024, 1030)]


def test_selection(spark):
    rows = [("short", 10.0, "spoken"), ("middle-low", 20.0, "spoken"), ("middle", 30.0, "spoken"), ("long", 60.0, "spoken"), ("chant", 120.0, "sung")]
    df = spark.createDataFrame(rows, "recording_id string, duration_seconds double, content_type string").withColumn("state", F.lit("INVENTORIED"))
    got = {r.slot: r.recording_id for r in corpus.select_pilot(corpus.eligible(df)).collect()}
    assert got == {"short": "short", "middle": "middle-low", "long": "long"}
    assert len(corpus.select_pilot(corpus.eligible(df).limit(3)).collect()) == 3 and corpus.select_pilot(df.limit(1)).count() == 0
    assert [r.recording_id for r in corpus.select_explicit(df, ["middle", "short"]).collect()] == ["middle", "short"]
    for bad in (["short"], ["short", "short"], ["a", "b", "c", "d"], ["short", "chant"]):
        with pytest.raises(ValueError):
            corpus.select_explicit(df, bad)


def test_transcript(spark):
    units = corpus.spoken_units(spark.createDataFrame([("rec-1", "Pater noster\n\n  qui es in caelis \r\n")], "rec string, text string"), "rec")
    got = corpus.token_ranges(units, "rec", "ordinal").orderBy("ordinal").collect()
    assert [(r.unit_id, r.text, r.token_start, r.token_end) for r in got] == [("rec-1-unit-0001", "Pater noster", 0, 2), ("rec-1-unit-0002", "qui es in caelis", 2, 6)]
    assert intervals.contiguity_violations(corpus.token_ranges(units, "rec", "ordinal"), "rec").count() == 0
    d = spark.createDataFrame([("pater noster", "pater poster")], "a string, b string").select(C.word_differences("a", "b").alias("d")).first().d
    assert [tuple(x) for x in d] == [("replace", 1, 2, 1, 2)]


EV = "event_id string, recording_id string, previous_state string, target_state string, input_sha256s array<string>, config_sha256 string, tool_versions array<string>, seq int"


def test_journal(spark):
    def e(i, a, b, n, sha="x"):
        return (i, "r", a, b, [sha], "c", [], n)

    good = spark.createDataFrame([e("1", "DISCOVERED", "INVENTORIED", 1), e("2", "INVENTORIED", "TEXT_CANDIDATES_READY", 2)], EV)
    assert events.journal_problems(good).count() == 0
    bad = good.union(spark.createDataFrame([e("2", "TEXT_CANDIDATES_READY", "APPROVED", 3), e("3", "DISCOVERED", "INVENTORIED", 4)], EV))
    assert {r.problem for r in events.journal_problems(bad).collect()} == {"DUPLICATE_EVENT_ID", "DUPLICATE_SEMANTICS", "ILLEGAL_TRANSITION", "BROKEN_CHAIN"}
    new = spark.createDataFrame([e("1", "DISCOVERED", "INVENTORIED", 1), e("9", "DISCOVERED", "INVENTORIED", 1), e("1", "INVENTORIED", "PAIRED", 1), e("8", "PAIRED", "ALIGNED", 1)], EV)
    assert sorted(r.status for r in events.event_existence(good, new).collect()) == ["conflict", "conflict", "exists", "new"]
    moved = events.advance(spark.createDataFrame([("r", "PAIRED"), ("s", "PAIRED"), ("t", "PAIRED")], "recording_id string, state string"), spark.createDataFrame([("r", "ALIGNED"), ("s", "APPROVED")], "recording_id string, target_state string"))
    assert {r.recording_id: (r.state, r.issue) for r in moved.collect()} == {"r": ("ALIGNED", None), "s": ("PAIRED", "ILLEGAL_TRANSITION"), "t": ("PAIRED", None)}
    assert events.event_id(good.withColumn("result", F.lit("success"))).filter("event_id rlike '^state-[0-9a-f]{16}$'").count() == 2


def test_replay(spark):
    auto = spark.createDataFrame([("e", "segment_start", "0.0"), ("e", "segment_end", "1.4"), ("e", "decision", '"unreviewed"')], "id string, field string, value string")
    ev = "id string, field string, before string, after string, seq int"
    good = spark.createDataFrame([("e", "segment_end", "1.4", "1.5", 1), ("e", "decision", '"unreviewed"', '"approved"', 2)], ev)
    got = {r.field: (r.value, r.valid) for r in events.replay(auto, good, ["id"]).collect()}
    assert got == {"segment_start": ("0.0", True), "segment_end": ("1.5", True), "decision": ('"approved"', True)}
    bad = spark.createDataFrame([("e", "segment_end", "1.40", "1.5", 1), ("e", "decision", '"unreviewed"', '"unreviewed"', 2)], ev)
    assert {r.field: r.valid for r in events.replay(auto, bad, ["id"]).collect()} == {"segment_start": True, "segment_end": False, "decision": False}
    target = auto.withColumn("value", F.when(F.col("field") == "segment_end", "2.0").otherwise(F.col("value")))
    assert [tuple(r) for r in events.target_events(auto, target, ["id"]).collect()] == [("e", "segment_end", "1.4", "2.0")]


def test_review_event_id(spark):
    row = spark.createDataFrame([("1", "e", "f", "1.0", '"x"', "r", "p", "2026-01-01T00:00:00Z")], "schema_version string, entity_id string, field string, before string, after string, reason string, reviewer string, reviewed_at string")
    import hashlib

    want = '{"after":"x","before":1.0,"entity_id":"e","field":"f","reason":"r","reviewed_at":"2026-01-01T00:00:00Z","reviewer":"p","schema_version":"1"}'
    assert events.review_event_id(row).first().review_event_id == "review-" + hashlib.sha256(want.encode()).hexdigest()


def test_segments(spark):
    rows = [("r", "g", 1, 0.5, 1.5, 3, "approved", 0), ("r", "g", 2, 1.2, 2.0, 10, "approved", 0), ("r", "h", 1, 3.0, 4.0, 10, "approved", 1), ("r", "h", 2, 3.0, 4.0, 10, "rejected", 1)]
    takes = spark.createDataFrame(rows, "recording_id string, group_id string, take_index int, segment_start double, segment_end double, sample_rate int, decision string, n_warnings int").withColumn("word_spans", F.array(F.struct(F.lit("a").alias("text"), (F.col("segment_start") + 0.25).alias("start_seconds"), F.col("segment_end").alias("end_seconds"))))
    got = corpus.approved_segments(takes).orderBy("take_index").collect()
    assert [(r.source_start_sample, r.source_end_sample) for r in got] == [(2, 4), (12, 20)] and got[0].word_spans[0].start_seconds == 0.25
    assert corpus.overlapping_segments(corpus.approved_segments(takes)).count() == 0 and got[0].segment_id.startswith("segment-") and len(got[0].segment_id) == 32
    half = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "s double").select(C.sample_position(F.col("s"), F.lit(1))).collect()
    assert [r[0] for r in half] == [0, 2, 2]


@pytest.mark.parametrize(("metrics", "verdict"), [((0.95, 0.85, 3.0, 0.80), "scalable"), ((0.85, 0.85, 3.0, 0.8), "optimize"), ((0.949999, 0.85, 3.0, 0.8), "optimize"), ((0.95, 0.70, 3.0, 0.8), "optimize"), ((0.95, 0.85, 3.000001, 0.8), "optimize"), ((0.95, 0.85, 6.0, 0.8), "optimize"), ((0.95, 0.85, 3.0, 0.60), "optimize"), ((0.84, 0.85, 3.0, 0.8), "not_ready"), ((0.95, 0.85, 6.01, 0.8), "not_ready")])
def test_readiness(spark, metrics, verdict):
    assert spark.range(1).select(report.readiness(*map(F.lit, metrics))).first()[0] == verdict


def test_kpi_report(spark):
    recordings = spark.createDataFrame([("a", 10.0, True), ("b", 10.0, True), ("c", 10.0, False)], "recording_id string, duration_seconds double, selected boolean")
    speech = spark.createDataFrame([(0, 166400)], "start long, end long")
    groups = spark.createDataFrame([(True,)] * 6, "automatic boolean")
    takes = spark.createDataFrame([(f"e{i}", "approved", 14.8 / 12) for i in range(12)], "entity_id string, decision string, seconds double")
    ev = spark.createDataFrame([], "entity_id string, field string")
    telemetry = spark.createDataFrame([(10.0, 20.0, 1.48, 1000)], "text_preparation_seconds double, review_seconds double, alignment_wall_seconds double, pilot_storage_bytes long")
    r = report.kpi_report(recordings, speech, groups, takes, ev, telemetry).first()
    assert (r.speech_seconds, r.input_seconds, r.full_seconds, r.storage_bytes, r.verdict) == (10.4, 20.0, 30.0, 1500, "scalable")
    assert math.isclose(r.gpu_rtf, 0.074) and math.isclose(r.person_hours, 45 / 3600) and math.isclose(r.approved_seconds, 14.8) and r.review_ratio == 1.0
    with pytest.raises(Exception, match="denominator"):
        report.kpi_report(recordings, speech, groups.limit(0), takes, ev, telemetry).collect()


def test_audit(spark):
    row = ["w", "w", ["w"], 0, "i", "vowels", ["r"], ["liber-usualis-1962"], "approved"]

    def made(line, **change):
        names = [c.split()[0] for c in report.GOLD.split(", ")]
        return (line, True, *[change.get(n, v) for n, v in zip(names, row, strict=True)])

    rows = [made(1), made(2), made(3, word="a", ipa=" "), made(4, word="b", stress_index=1), made(5, word="c", review_state="draft"), made(6, word="d", source_ids=["x"]), made(7, word="e", rule_ids=[]), (8, False, *[None] * 9)]
    got = sorted((r.code, r.detail) for r in report.audit_gold(spark.createDataFrame(rows, "line int, valid boolean, " + report.GOLD), {"vowels": 7, "stress": 1}, 9).collect())
    assert got == sorted([("DUPLICATE_WORD", "w"), ("EMPTY_FIELD", "line 3"), ("INVALID_STRESS", "b"), ("UNAPPROVED_ENTRY", "c"), ("UNKNOWN_SOURCE", "d: x"), ("MISSING_PROVENANCE", "e"), ("EMPTY_FIELD", "line 7"), ("INVALID_ROW", "line 8"), ("TOTAL_MINIMUM_NOT_MET", "8"), ("CATEGORY_MINIMUM_NOT_MET", "stress: 0 < 1")])


def test_strict_jsonl(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', "", '{"a": 1, "a": 2, "b": ""}', '{"a": NaN, "b": ""}', "[1]", "{", '{"a": 1}', '{"a": 1, "b": "x", "c": 2}']
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    got = [r._fault for r in jsonl.read_strict(spark, str(tmp_path / "x.jsonl"), "a int, b string", fail=False).collect()]
    assert got == [None, "BLANK_LINE", "DUPLICATE_KEY", "NON_STANDARD_CONSTANT", "NOT_AN_OBJECT", "INVALID_JSON", "FIELDS_DIFFER", "FIELDS_DIFFER"]
    with pytest.raises(Exception, match="BLANK_LINE|DUPLICATE_KEY"):
        jsonl.read_strict(spark, str(tmp_path / "x.jsonl"), "a int, b string").collect()
    rows = spark.createDataFrame([(2, 1e-5, "é"), (1, 2.0, None)], "b int, a double, c string")
    path = jsonl.write_snapshot(rows, str(tmp_path / "snap"), ["b"])
    assert jsonl.current_snapshot(spark, str(tmp_path / "snap")) == path
    assert [r.value for r in spark.read.text(path).orderBy("value").collect()] == ['{"a":1e-05,"b":2,"c":"é"}', '{"a":2.0,"b":1,"c":null}']


def test_files(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "sung").mkdir(parents=True)
    data = io.BytesIO()
    with wave.open(data, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(struct.pack("<4h", 0, 327, -32768, 32760))
    (root / "sung" / "A.WAV").write_bytes(data.getvalue())
    (root / "note.txt").write_text("x")
    found = files.discover_audio(spark, str(root), with_hash=True).collect()
    assert [r.relative_path for r in found] == ["sung/A.WAV"] and len(found[0].sha256) == 64
    m = spark.read.format("binaryFile").load(str(root / "sung")).select(files.wav_measures("content").alias("m")).first().m
    assert (m.samples, m.peak, m.clipped_ratio, m.silent_ratio, m.error) == (4, 1.0, 0.5, 0.5, None)
    assert math.isclose(m.rms, math.sqrt((327**2 + 32768**2 + 32760**2) / 4) / 32768)
    header = "relative_path,title_or_citation,speaker_id,rights_id,notes\n"
    (tmp_path / "in.csv").write_text("﻿" + header + "raw/a.wav,t,s,r,\n", encoding="utf-8")
    assert files.read_intake(spark, str(tmp_path / "in.csv")).count() == 1
    (tmp_path / "two.csv").write_text(header + "raw/a.wav,t,s,r,\nraw/a.wav,t,s,r,\n")
    with pytest.raises(ValueError):
        files.read_intake(spark, str(tmp_path / "two.csv"))


def test_textgrid():
    tiers = {"words": [(0.5, 1.0, 'say "x"'), (1.0, 1.25, "y")], "phones": []}
    text = files.format_textgrid(2.0, tiers)
    assert files.parse_textgrid(text) == [("words", 0.0, 0.5, ""), ("words", 0.5, 1.0, 'say "x"'), ("words", 1.0, 1.25, "y"), ("words", 1.25, 2.0, ""), ("phones", 0.0, 2.0, "")]
    with pytest.raises(ValueError):
        files.format_textgrid(2.0, {"w": [(0.0, 1.0, "a"), (0.5, 1.5, "b")]})


def test_inventory(spark):
    intake = spark.createDataFrame([("raw/sung/a.wav", "t", "s", "ok", ""), ("raw/b.wav", "t", "s", "no", ""), ("raw/c.wav", "t", "s", "ok", "")], files.INTAKE)
    rights = spark.createDataFrame([("ok", "s", True, True), ("no", "s", True, False)], "rights_id string, speaker_id string, allow_local_processing boolean, allow_model_training boolean")
    probes = spark.createDataFrame([("raw/sung/a.wav", "ab" * 32, 1), ("raw/b.wav", "cd" * 32, 1)], "relative_path string, sha256 string, metadata int")
    got = {r.relative_path: (r.recording_id, r.content_type, r.issue) for r in corpus.inventory(intake, rights, probes).collect()}
    assert got == {"raw/sung/a.wav": ("rec-abababababab", "sung", None), "raw/b.wav": ("rec-cdcdcdcdcdcd", "spoken", "RIGHTS_SCOPE_UNCONFIRMED"), "raw/c.wav": (None, "spoken", "AUDIO_MISSING")}


def test_predicates_and_ids(spark):
    one = spark.createDataFrame([("a/b", "..", "a\\b", 5, 8)], "p string, q string, r string, s long, e long")
    r = one.select(C.is_canonical_path(F.col("p")), C.is_canonical_path(F.col("q")), C.is_canonical_path(F.col("r")), C.is_safe_component(F.col("q")), C.midpoint(F.col("s"), F.col("e")), C.review_entity_id(F.lit("rec"), F.lit("g"), F.lit(1)), C.group_id(F.lit("rec"), F.lit("rec-u")), C.group_id(F.lit("rec"), F.lit("u")), C.redact_paths(F.lit("bad /home/me/p/x.wav and /etc/passwd"), "/home/me/p"), C.probability(F.lit(-0.5)), C.probability(F.lit(1.5)), C.float_hex(F.lit(0.5)), C.html_escape(F.lit("<a>"))).first()
    assert tuple(r)[:9] == (True, False, False, False, 6, "review:3:rec:1:g:take:1", "rec-u", "rec-u", "bad <project>/x.wav and <path>")
    assert math.isclose(r[9], math.exp(-0.5)) and r[10] == 1.0 and r[11] == "0x1.0000000000000p-1" and r[12] == "&lt;a&gt;"
    assert json.loads(C.canonical_json({"b": 1, "a": "é"})) == {"a": "é", "b": 1} and C.canonical_json({"a": "é"}, True) == '{"a":"\\u00e9"}'


def test_review_stream(spark, tmp_path):
    rows = [("1", "e", "f", "a", 1), ("2", "e", "f", "b", 2), ("2", "e", "f", "b", 2)]
    schema = "review_event_id string, entity_id string, field string, after string, seq int"
    spark.createDataFrame(rows, schema).withColumn("reviewed_at", F.timestamp_seconds(F.col("seq"))).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema + ", reviewed_at timestamp").parquet(str(tmp_path / "in"))
    q = reviews.current_values(stream).writeStream.outputMode("complete").format("memory").queryName("current_values").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("current_values").collect()] == [("e", "f", "b", 2)]


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and e.entry(spark).count() >= 1
