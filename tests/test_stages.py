"""Stages end to end with fake backends."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cantor.operators import corpus, events
from cantor.plans import stages


def fake_vad():
    speech = [(100, 1000), (1200, 2000), (2800, 3700), (3900, 5000)]

    class Fake:
        def analyze(self, path):
            if path == "broken":
                raise OSError("no file")
            return [(a, a + 100, 0.9 if any(x <= a < y for x, y in speech) else 0.1) for a in range(0, 5100, 100)]

    return lambda: Fake()


def fake_takes(candidates):
    return candidates.select("recording_id", "unit_id", "split", F.lit(0.92).alias("first_score"), F.lit(0.9).alias("second_score"), F.lit(True).alias("word_order_same"), F.lit(0.95).alias("coverage"))


def test_segment_and_pair(spark):
    recordings = spark.createDataFrame([("r", "ok"), ("x", "broken")], "recording_id string, path string")
    speech, pauses = stages.segment(recordings, fake_vad(), rate=1000, minimum_gap_count=2, minimum_cluster_size=1)
    assert sorted((r.start, r.end) for r in speech.collect()) == [(100, 1000), (1200, 2000), (2800, 3700), (3900, 5000)]
    assert [(r.start, r.kind) for r in pauses.orderBy("start").collect()] == [(1000, "short"), (2000, "long"), (3700, "short")]
    texts = spark.createDataFrame([("r", "Pater noster\nqui es")], "recording_id string, text string")
    units, plans = stages.prepare_text(texts)
    got = stages.pair(speech, pauses, units, fake_takes).orderBy("unit_id").collect()
    assert [(r.outcome, r.split) for r in got] == [("selected", 1100), ("selected", 3800)]
    assert plans.first().error_code is None


def test_dry_run_and_bundle(spark):
    assert [tuple(r) for r in stages.dry_run(spark, "select-pilot").collect()] == [("READ", "recordings"), ("WRITE", "selection")]
    takes = spark.createDataFrame([("r", "g", 1, 0.0, 1.4)], "recording_id string, group_id string, take_index int, segment_start double, segment_end double")
    assert sorted(r.path for r in stages.review_bundle(takes).collect()) == ["r/g/1/automatic.json", "r/g/1/decision.json", "r/g/1/index.html"]


def test_import_review_is_idempotent(spark):
    auto = spark.createDataFrame([("e", "end", "1.4")], "id string, field string, value string")
    target = auto.withColumn("value", F.lit("1.5"))
    journal = spark.createDataFrame([], "id string, field string, before string, after string, seq int")
    new = stages.import_review(auto, journal, target, ["id"])
    assert [tuple(r) for r in new.collect()] == [("e", "end", "1.4", "1.5")]
    assert stages.import_review(auto, new.withColumn("seq", F.lit(1)), target, ["id"]).count() == 0


def test_manifest(spark):
    schema = "recording_id string, group_id string, take_index int, segment_start double, segment_end double, sample_rate int, decision string, n_warnings int, rights_id string"
    spans = F.array(F.struct(F.lit("a").alias("text"), F.lit(0.5).alias("start_seconds"), F.lit(1.0).alias("end_seconds")))
    takes = spark.createDataFrame([("r", "g", 2, 1.0, 2.0, 10, "approved", 0, "k"), ("r", "g", 1, 0.0, 1.0, 10, "approved", 0, "k")], schema).withColumn("word_spans", spans)
    rights = spark.createDataFrame([("k", True, True)], "rights_id string, allow_local_processing boolean, allow_model_training boolean")
    assert [r.take_index for r in stages.build_manifest(takes, rights).collect()] == [1, 2]
    with pytest.raises(ValueError, match="rights"):
        stages.build_manifest(takes, rights.limit(0))
    with pytest.raises(ValueError, match="overlap"):
        stages.build_manifest(takes.withColumn("segment_end", F.lit(1.5)), rights)


def test_small_helpers(spark):
    a = spark.createDataFrame([("w",), ("w",), ("x",)], "code string")
    assert [tuple(r) for r in corpus.multiset_difference(a, a.limit(1), "code").orderBy("code").collect()] == [("w", 1), ("x", 1)]
    assert events.journal_prefix(["a", "b"], hashlib.sha256(b"a\n").hexdigest()) == 1 and events.journal_prefix(["a"], "x") is None
    lines = [r.value for r in stages.report_markdown(spark.createDataFrame([(1, "a|b")], "n int, s string")).orderBy("position").collect()]
    assert lines == ["| metric | value |", "| --- | --- |", "| n | 1 |", "| s | a\\|b |"]
