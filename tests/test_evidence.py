"""Readers of documents, audio checks and conversions, recovery, and stages around them, on small fixtures."""

import hashlib
import io
import json
import os
import wave

import pytest
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import identity, latin
from cantor.operators import audio, corrections, evidence
from cantor.operators import events as journal
from cantor.plans import stages
from cantor.sources import documents, files, jsonl

SHA = hashlib.sha256(b"x").hexdigest()


def _lines(tmp_path, name, *rows):
    path = tmp_path / name
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def _right(i, **more):
    names = [c.split()[0] for c in files.RIGHTS.split(", ")]
    return dict.fromkeys(names, "x") | {"rights_id": f"r{i}", "allow_local_processing": True, "allow_model_training": True, "allow_internal_evaluation": False} | more


def test_rights(spark, tmp_path):
    good = _lines(tmp_path, "good.jsonl", _right(1), _right(2))
    assert documents.read_rights(spark, good).count() == 2
    assert documents.unauthorized(documents.read_rights(spark, good), evaluation=True).count() == 2
    with pytest.raises(ValueError, match="repeated"):
        documents.read_rights(spark, _lines(tmp_path, "twice.jsonl", _right(1), _right(1)))
    bare = _lines(tmp_path, "bare.jsonl", _right(1, allow_model_training=False))
    assert documents.read_rights(spark, bare, authorized=False).count() == 1
    with pytest.raises(ValueError, match="authorization"):
        documents.read_rights(spark, bare)
    owners = spark.createDataFrame([("a", "r1")], "recording_id string, rights_id string")
    with pytest.raises(ValueError, match="evaluate"):
        stages.require_evaluation_rights(owners, documents.read_rights(spark, good))
    stages.require_evaluation_rights(owners, documents.read_rights(spark, _lines(tmp_path, "all.jsonl", _right(1, allow_internal_evaluation=True))))


def _recording(**more):
    meta = {"duration_seconds": 1.0, "sample_rate": 16000, "channels": 1, "codec": "wav", "bit_rate": 1}
    return {"schema_version": "1", "recording_id": f"rec-{SHA[:12]}", "relative_path": "a.wav", "sha256": SHA, "content_type": "spoken", "title_or_citation": "t", "speaker_id": "s", "rights_id": "r", "notes": "", "metadata": meta, "state": "PAIRED"} | more


def test_recordings(spark, tmp_path):
    assert documents.read_recordings(spark, _lines(tmp_path, "a", _recording())).count() == 1
    for bad in ([_recording(), _recording()], [_recording(state="LOST")], [_recording(recording_id="rec-1")], [_recording(sha256="X")]):
        with pytest.raises(ValueError, match="invalid"):
            documents.read_recordings(spark, _lines(tmp_path, f"b{len(bad)}{bad[0]['state']}{bad[0]['recording_id']}{bad[0]['sha256']}", *bad))


def test_selection_and_transcript_intake(spark, tmp_path):
    row = {"schema_version": "1", "strategy": "explicit", "recording_ids": ["a", "b"], "inventory_hashes": [SHA, SHA]}
    assert documents.read_selection(spark, _lines(tmp_path, "s", row)).count() == 1
    for i, bad in enumerate(([row, row], [row | {"inventory_hashes": [SHA]}], [row | {"recording_ids": ["a", ""]}], [row | {"recording_ids": ["a", "a"]}], [row | {"inventory_hashes": [SHA, "x"]}])):
        with pytest.raises(ValueError):
            documents.read_selection(spark, _lines(tmp_path, f"bad{i}", *bad))
    chosen = spark.createDataFrame([("a",), ("b",)], "recording_id string")
    blank = documents.transcript_skeleton(chosen)
    assert documents.skeleton_action(None, blank) == "write" and documents.skeleton_action(blank, blank) == "keep"
    other = documents.transcript_skeleton(chosen.limit(1))
    with pytest.raises(ValueError, match="differs"):
        documents.skeleton_action(other, blank)
    assert documents.skeleton_action(other, blank, replace=True) == "write"
    stored = jsonl.write_snapshot(blank, str(tmp_path / "intake"))
    assert documents.read_transcript_intake(spark, stored).count() == 2
    (tmp_path / "twice").write_text("".join((tmp_path / "intake").joinpath(os.path.basename(stored), n).read_text() for n in os.listdir(stored) if n.startswith("part-")) * 2)
    with pytest.raises(ValueError, match="repeated"):
        documents.read_transcript_intake(spark, str(tmp_path / "twice"))


def test_config_paths_and_texts(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"b": [1, 2.5], "schema_version": "1", "a": "é"}', encoding="utf-8")
    found, digest = documents.read_config(spark, str(path), {"a", "b", "schema_version"}, schema_version="1")
    assert found["a"] == "é" and digest == hashlib.sha256('{"a":"é","b":[1,2.5],"schema_version":"1"}'.encode()).hexdigest()
    with pytest.raises(ValueError, match="fields"):
        documents.read_config(spark, str(path), {"a"})
    with pytest.raises(ValueError, match="version"):
        documents.read_config(spark, str(path), schema_version="2")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.txt").write_text("salvē\nb", encoding="utf-8")
    (tmp_path / "out.txt").write_text("no")
    os.symlink(tmp_path / "out.txt", tmp_path / "in" / "link.txt")
    assert documents.read_text_under(spark, str(tmp_path / "in"), "t.txt") == "salvē\nb"
    for bad in ("../out.txt", "/etc/passwd", "", "a/../../out.txt", "a\\b", "link.txt"):
        with pytest.raises(ValueError, match="below"):
            documents.read_text_under(spark, str(tmp_path / "in"), bad)


def test_model_weights(spark, tmp_path):
    for name, data in (("m/a.safetensors", b"1"), ("m/b.safetensors", b"2"), ("m/model.safetensors.index.json", b'{"weight_map": {"x": "a.safetensors", "y": "b.safetensors"}}'), ("readme.md", b"")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    digest, manifest = documents.weights_manifest(documents.snapshot_files(spark, str(tmp_path)))
    want = [{"filename": f"m/{n}", "sha256": hashlib.sha256((tmp_path / "m" / n).read_bytes()).hexdigest(), "size_bytes": (tmp_path / "m" / n).stat().st_size} for n in ("model.safetensors.index.json", "a.safetensors", "b.safetensors")]
    assert manifest == want and digest == hashlib.sha256(json.dumps(want, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    (tmp_path / "m" / "c.safetensors").write_bytes(b"3")
    with pytest.raises(ValueError, match="differ"):
        documents.weights_manifest(documents.snapshot_files(spark, str(tmp_path)))
    (tmp_path / "m" / "model.safetensors.index.json").unlink()
    with pytest.raises(ValueError, match="unique"):
        documents.weights_manifest(documents.snapshot_files(spark, str(tmp_path)))


def test_review_events(spark):
    picks = spark.createDataFrame([("rec", "u1", 5, "r", "me", "2024-01-01T00:00:00Z")], "recording_id string, unit_id string, split_sample long, reason string, reviewer string, reviewed_at string")
    events = corrections.correction_events(picks)
    row = events.first()
    body = {"schema_version": "1", "entity_id": "pairing:3:rec:2:u1", "field": "pairing_selected_split", "before": None, "after": 5, "reason": "r", "reviewer": "me", "reviewed_at": "2024-01-01T00:00:00Z"}
    assert row.review_event_id == "review-" + hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert documents.review_event_problems(events).count() == 0
    changed = events.withColumn("after", F.lit("6")).unionByName(events).unionByName(events)
    assert {(r.problem) for r in documents.review_event_problems(changed).collect()} == {"DUPLICATE_EVENT_ID", "EVENT_ID_MISMATCH"}
    same = events.withColumn("after", F.col("before"))
    assert "NO_CHANGE" not in {r.problem for r in documents.review_event_problems(same).collect()}  # another id comes first


def _wav(frames=160, channels=1, width=2, rate=16000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(b"\x01" * frames * channels * width)
    return out.getvalue()


def test_wav_layouts(spark):
    rows = [("ok", _wav(), 160), ("near", _wav(), 161), ("far", _wav(), 170), ("any", _wav(), None), ("stereo", _wav(channels=2), 160), ("empty", _wav(0), 0), ("broken", b"RIFF", 160), ("none", None, 160), ("deep", _wav(441, 2, 3, 44100), 441)]
    found = spark.createDataFrame(rows, "k string, content binary, n long").withColumn("l", audio.wav_layout("content"))
    got = {r.k: (r.a, r.b) for r in found.select("k", audio.analysis_problem(F.col("l"), F.col("n")).alias("a"), audio.review_problem(F.col("l"), F.lit(44100), F.lit(2), F.col("n")).alias("b")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"ok": None, "near": None, "far": "SAMPLES", "any": None, "stereo": "LAYOUT", "empty": "EMPTY", "broken": "UNREADABLE", "none": "UNREADABLE", "deep": "LAYOUT"}
    assert got["deep"][1] is None and got["ok"][1] == "LAYOUT"


def test_probes_and_lossless_segments(spark):
    def prober(path):
        if path == "bad":
            raise FileNotFoundError("no prober")
        stream = {"codec_type": "audio", "codec_name": "flac", "sample_rate": "44100", "channels": 2, "duration_ts": 441 if path != "odd" else 7, "time_base": "1/44100" if path != "odd" else "1/90001", "duration": "0.01"}
        return json.dumps({"streams": [] if path == "silent" else [{"codec_type": "video"}, stream], "format": {"duration": "0.01", "bit_rate": "9"}})

    rows = audio.probe_files(spark.createDataFrame([("a",), ("bad",), ("silent",), ("odd",)], "path string"), prober)
    probed = F.struct(*[c for c in rows.columns if c != "path"])
    got = {r.path: (r.problem, r.bit_rate) for r in rows.select("path", "bit_rate", audio.lossless_problem(probed, F.lit(44100), F.lit(2), F.lit(441)).alias("problem")).collect()}
    assert got == {"a": (None, 9), "bad": ("UNREADABLE", None), "silent": ("UNREADABLE", None), "odd": ("SAMPLES", 9)}


def test_bounds_and_rational_samples(spark):
    rows = [(0.0, 1.0, None), (float("nan"), 1.0, "NOT_FINITE"), (None, 1.0, "NOT_FINITE"), (-1.0, 1.0, "NOT_A_RANGE"), (1.0, 1.0, "NOT_A_RANGE"), (0.0, 2.5, "BEYOND_END"), (0.0, float("inf"), "NOT_FINITE")]
    found = spark.createDataFrame(rows, "a double, b double, want string").select("want", audio.bounds_problem(F.col("a"), F.col("b"), F.lit(2.0)).alias("got"))
    assert found.filter(~F.col("want").eqNullSafe(F.col("got"))).count() == 0
    ticks = spark.createDataFrame([(441, "1/44100", 441), (10, "1/11", None), (3, "1/3", 44100), (2**40, "1/44100", 2**40), (5, "x", None), (5, "1/0", None), (4, "1001/30000", None)], "t long, b string, want long")
    got = ticks.select("want", audio.rational_samples(F.col("t"), F.col("b"), F.lit(44100)).alias("got"))
    assert got.filter(~F.col("want").eqNullSafe(F.col("got"))).collect() == []


def test_conversions_are_published_by_hash(spark):
    def converter(mode, path, start, end):
        if path == "gone":
            raise FileNotFoundError(path)
        return f"{mode} {path} {start} {end}".encode()

    rows = [("k1", "review", "a", 0.5, 1.0), ("k2", "analysis", "b", None, None), ("k3", "review", "gone", 0.0, 1.0)]
    made = audio.convert(spark.createDataFrame(rows, "cache_key string, mode string, path string, start_seconds double, end_seconds double"), converter)
    right = hashlib.sha256(b"review a 0.5 1.0").hexdigest()
    wanted = spark.createDataFrame([("k1", right), ("k2", "other"), ("k3", "x"), ("k4", "x")], "cache_key string, sha256 string")
    got = {r.cache_key: r.problem for r in audio.publishable(made, wanted).collect()}
    assert got == {"k1": None, "k2": "HASH_DIFFERS", "k3": "FAILED", "k4": "MISSING"}
    assert audio.conversion("lossless", "s.wav", 0.5, 2.0)[5:11] == ["-i", "s.wav", "-ss", "0.5", "-to", "2.0"]


def test_cached_alignments(spark):
    names = ("cache_key", *identity.RUNTIME, "result")
    rows = [(k, "b", "1", "m", "r", "cc", '{"w":1}', "t", 7) for k in ("k1", "k2", "k3", "k4")]
    requests = spark.createDataFrame([(*r[:1], "other" if r[0] == "k2" else r[1], *r[2:]) for r in rows[:3]], ", ".join(f"{n} {'long' if n == 'result' else 'string'}" for n in names))
    sealed = identity.sealed(spark.createDataFrame(rows, requests.schema))
    stored = sealed.withColumn("result", F.when(F.col("cache_key") == "k3", 8).otherwise(F.col("result"))).unionByName(sealed.filter("cache_key = 'k1'"))
    got = {tuple(r) for r in corrections.cached_alignment_problems(requests.drop("result"), stored).collect()}
    assert got == {("k1", "NOT_ONE_RESULT"), ("k2", "PROVENANCE_DIFFERS"), ("k3", "SEAL_BROKEN")}
    assert corrections.recomputed_differences(stored, stored).count() == 0
    assert {r.side for r in corrections.recomputed_differences(stored, sealed).collect()} == {"stored", "recomputed"}


def test_align_stage(spark):
    takes = spark.createDataFrame([("g", 1, "u", "a", "k1"), ("g", 2, "u", "a", "k2"), ("g", 3, "u", "a", "k3")], "group_id string, take_index int, unit_id string, audio_sha256 string, alignment_cache_key string")
    result = lambda keys: identity.sealed(spark.createDataFrame([(k, 1) for k in keys], "alignment_cache_key string, words int"))
    stored = result(["k1", "old"]).withColumn("words", F.when(F.col("alignment_cache_key") == "k1", 2).otherwise(1))
    asked = []

    def aligner(misses):
        asked.append(sorted(r.alignment_cache_key for r in misses.collect()))
        return result(["k2"])

    rows, problems = stages.align(takes, stored, aligner)
    assert rows.count() == 2 and asked == [["k2", "k3"]]
    assert {tuple(r) for r in problems.collect()} == {("g", 3, "MISSING_ALIGNMENT"), ("g", 1, "SEAL_BROKEN")}


def test_overrides_and_keys(spark):
    spoken = "ave"
    digest = hashlib.sha256(spoken.encode()).hexdigest()
    one = {"stress_index": None, "ipa": None, "model_phonemes": ["a"]}
    cases = [({"0": one, "12": one}, None), ({"01": one}, "INVALID_INDEX"), ({"1": {}}, "OVERRIDE_FIELDS_DIFFER"), ({"1": one | {"stress_index": True}}, "INVALID_VALUE"), ({"1": one | {"model_phonemes": [1]}}, "INVALID_VALUE"), ([], "OVERRIDES_NO_OBJECT")]
    rows = [(json.dumps({"spoken_text_sha256": digest, "overrides": o}), want) for o, want in cases] + [("{", "INVALID_JSON"), ("[]", "FIELDS_DIFFER"), (None, "INVALID_JSON")]
    got = spark.createDataFrame(rows, "t string, want string").withColumn("o", C.overrides(F.col("t"), F.lit(spoken))).collect()
    assert [r.o.error for r in got] == [r.want for r in got] and [x.token_index for x in got[0].o.overrides] == [0, 12]
    assert [latin.is_exception_key(k) for k in ("mihi", "", "Mihi", "iam", "jam", "via", "caelum", "cælum", "poë", "dé", "a b")] == [True, False, False, True, False, False, True, False, True, False, False]


def test_recovery_of_a_stopped_transition(spark, tmp_path):
    journal, root = str(tmp_path / "journal"), str(tmp_path / "state")
    event = lambda n, a, b: (f"e{n}", "r1", n, a, b)
    schema = "event_id string, recording_id string, seq int, previous_state string, target_state string"
    state = lambda s: spark.createDataFrame([("r1", s), ("r2", "DISCOVERED")], "recording_id string, state string")
    first = spark.createDataFrame([event(1, "DISCOVERED", "INVENTORIED")], schema)
    jsonl.persist_transition(first, state("INVENTORIED"), journal, root)
    assert jsonl.recover_state(spark, journal, root) is None
    jsonl.persist_transition(first, state("INVENTORIED"), journal, root)
    assert spark.read.parquet(journal).count() == 1  # once, however often it is written
    jsonl.append_events(spark.createDataFrame([event(2, "INVENTORIED", "TEXT_CANDIDATES_READY")], schema), journal)  # stopped before the state
    assert {r.status for r in evidence.recovery(spark.read.parquet(journal), state("INVENTORIED")).collect()} == {"recover", "current"}
    path = jsonl.recover_state(spark, journal, root)
    assert {(r.recording_id, r.state) for r in spark.read.json(path).collect()} == {("r1", "TEXT_CANDIDATES_READY"), ("r2", "DISCOVERED")}
    jsonl.write_snapshot(state("PAIRED"), root)
    with pytest.raises(ValueError, match="disagree"):
        jsonl.recover_state(spark, journal, root)


def test_report_pair_and_dry_run(spark, tmp_path):
    metrics = spark.createDataFrame([("a|b", 1.5)], "name string, ratio double")
    lines = [r.value for r in stages.report_markdown(metrics).orderBy("position").collect()]
    path = jsonl.publish_pair(spark, str(tmp_path), metrics, lines)
    assert jsonl.current_snapshot(spark, str(tmp_path)) == path
    assert spark.read.json(f"{path}/json").first().asDict() == {"name": "a|b", "ratio": 1.5}
    assert [r.value for r in spark.read.text(f"{path}/markdown").collect()] == lines
    assert documents.lines_digest(metrics, ["name"]) == hashlib.sha256(b'{"name":"a|b","ratio":1.5}\n').hexdigest()
    plan = [tuple(r) for r in stages.dry_run(spark, "pair", ahead=True).collect()]
    assert ("RECOVER", "recordings") in plan and [p[0] for p in plan] == sorted((p[0] for p in plan), key=["READ", "RECOVER", "WRITE"].index)
    assert ("RECOVER", "recordings") not in [tuple(r) for r in stages.dry_run(spark, "report", ahead=True).collect()]


def test_review_bundle_comes_back(spark):
    takes = spark.createDataFrame([("r", "g", 1, 0.0, 2.0, [(0.5, 1.0, "a<b")])], "recording_id string, group_id string, take_index int, segment_start double, segment_end double, words array<struct<start:double,end:double,text:string>>")
    out = stages.review_bundle(takes)
    made = {r.path: r.content for r in out.collect()}
    assert set(made) == {f"r/g/1/{n}" for n in ("automatic.json", "decision.json", "index.html", "words.TextGrid")}
    assert [x[3] for x in files.parse_textgrid(made["r/g/1/words.TextGrid"])] == ["", "a<b", ""]
    back = out.withColumn("content", F.when(F.endswith("path", F.lit("decision.json")), "decided").when(F.endswith("path", F.lit("html")), "other").otherwise(F.col("content")))
    back = back.filter("path not like '%TextGrid'").unionByName(spark.createDataFrame([("x", "y"), ("x", "y")], "path string, content string"))
    assert {tuple(r) for r in stages.bundle_problems(out, back).collect()} == {("r/g/1/index.html", "CHANGED"), ("r/g/1/words.TextGrid", "MISSING"), ("x", "EXTRA"), ("x", "REPEATED")}
    outcomes = spark.createDataFrame([("r", "u", "review"), ("r", "v", "selected"), ("r", "w", "review")], "recording_id string, unit_id string, status string")
    saved = spark.createDataFrame([("r", "u", 10, 0.5)], "recording_id string, unit_id string, split_sample long, score double")
    bundle = {r.path: json.loads(r.content) for r in corrections.correction_bundle(outcomes, saved).collect()}
    assert set(bundle) == {"r/pairing/u.json", "r/pairing/w.json"} and bundle["r/pairing/u.json"]["candidates"] == [{"split_sample": 10, "score": 0.5}] and bundle["r/pairing/w.json"]["candidates"] == []


def test_finish(spark):
    recordings = spark.createDataFrame([(f"r{i}", "REVIEWED") for i in range(3)], "recording_id string, state string")
    takes = spark.createDataFrame([("r0", "approved"), ("r0", "rejected"), ("r1", "rejected"), ("r2", "unreviewed")], "recording_id string, decision string")
    moved, open_ = stages.finish(recordings, takes)
    assert {r.recording_id: r.state for r in moved.collect()} == {"r0": "APPROVED", "r1": "REJECTED", "r2": "REVIEWED"} and [r.recording_id for r in open_.collect()] == ["r2"]


def test_reviewed_takes_and_manifest(spark):
    rows = [("r", "g", 1, ["Ave", "Maria"], ["ave", "maria"]), ("r", "g", 2, ["Ave", "Maria"], ["ave", "maria"])]
    takes = spark.createDataFrame(rows, "recording_id string, group_id string, take_index int, expected array<string>, aligned array<string>")
    takes = takes.withColumns({"rights_id": F.lit("x"), "sample_rate": F.lit(16000), "n_warnings": F.lit(0)})
    words = json.dumps([{"text": "ave", "start_seconds": 0.1, "end_seconds": 0.2}, {"text": "MARIA", "start_seconds": 0.3, "end_seconds": 0.4}])
    entity = [f"review:1:r:1:g:take:{i}" for i in (1, 2)]
    auto = [(e, f, v) for e in entity for f, v in (("review_decision", '"unreviewed"'), ("segment_start", "0.0"), ("segment_end", "0.5"), ("words", words))]
    automatic = spark.createDataFrame(auto, "entity_id string, field string, value string")
    schema = "entity_id string, field string, before string, after string, seq int"
    told = [(entity[0], "review_decision", '"unreviewed"', '"approved"', 1), (entity[0], "segment_end", "0.5", "0.45", 2), (entity[1], "review_decision", '"unreviewed"', '"rejected"', 1)]
    found = stages.reviewed_takes(takes, automatic, spark.createDataFrame(told, schema))
    rights = spark.createDataFrame([("x", True, True)], "rights_id string, allow_local_processing boolean, allow_model_training boolean")
    segments = stages.build_manifest(found, rights).collect()
    assert len(segments) == 1 and (segments[0].take_index, segments[0].source_end_sample) == (1, 7200)
    assert [w.text for w in segments[0].word_spans] == ["Ave", "Maria"]
    for bad in ([(entity[0], "segment_end", "0.6", "0.4", 1)], [("other", "segment_end", "0.5", "0.4", 1)], [(entity[0], "review_decision", '"unreviewed"', '"approved"', 1), (entity[0], "words", words, words.replace("MARIA", "mater"), 2)]):
        with pytest.raises(ValueError):
            stages.reviewed_takes(takes, automatic, spark.createDataFrame(bad, schema))


def test_transition_and_doctor(spark):
    recordings = spark.createDataFrame([("a", "SEGMENTED"), ("b", "PAIRED"), ("c", "SEGMENTED")], "recording_id string, state string")
    moves = spark.createDataFrame([("a", "PAIRED", ["x"]), ("b", "APPROVED", ["x"])], "recording_id string, target_state string, input_sha256s array<string>")
    moved, made = journal.transition(recordings, moves, "c", ["t"])
    assert {(r.recording_id, r.state, r.issue) for r in moved.collect()} == {("a", "PAIRED", None), ("b", "PAIRED", "ILLEGAL_TRANSITION"), ("c", "SEGMENTED", None)}
    body = {"recording_id": "a", "previous_state": "SEGMENTED", "target_state": "PAIRED", "input_sha256s": ["x"], "config_sha256": "c", "tool_versions": ["t"], "result": "success"}
    assert [r.event_id for r in made.collect()] == ["state-" + hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]]
    assert {"pyspark", "pyarrow", "ffmpeg", "ffprobe"} == {x[0] for x in stages.doctor()}
