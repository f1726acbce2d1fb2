"""Readers of a corpus's small documents, each with the checks that its readers rely on."""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import identity
from cantor.functions.udf import frame
from cantor.operators.corpus import STATES, duplicates, require
from cantor.operators.events import review_event_id
from cantor.sources.files import RECORDINGS, RIGHTS
from cantor.sources.jsonl import canonical_lines, read_strict

SNAPSHOT = "filename string, sha256 string, size_bytes long, content string"
SELECTION = "schema_version string, strategy string, recording_ids array<string>, inventory_hashes array<string>"
TRANSCRIPT_INTAKE = (
    "recording_id string, source_candidates array<struct<source_id:string,source_url:string,source_version:string,accessed_at:string,source_file:string,selected:boolean>>, spoken_units_file string, "
    "pronunciation_overrides_file string, confirmed boolean, asr_hypothesis_file string"
)
REVIEW_EVENTS = "schema_version string, review_event_id string, entity_id string, field string, before string, after string, reason string, reviewer string, reviewed_at string"


def read_rights(spark: SparkSession, path: str, authorized: bool = True) -> DataFrame:
    """Rights of unique ids; with ``authorized``, one without local processing or training is an error."""
    rows = read_strict(spark, path, RIGHTS)
    require(duplicates(rows, "rights_id"), "repeated rights_id")
    if authorized:
        require(unauthorized(rows), "missing local or training authorization")
    return rows


def unauthorized(rights: DataFrame, evaluation: bool = False) -> DataFrame:
    """Rights without local processing and training, or (``evaluation``) without internal evaluation."""
    allowed = F.coalesce(F.col("allow_local_processing") & F.col("allow_model_training"), F.lit(False))
    return rights.filter(~(allowed & F.coalesce("allow_internal_evaluation", F.lit(False)) if evaluation else allowed))


def recording_problems(recordings: DataFrame) -> DataFrame:
    """(recording_id, problem): repeated ids, digests that are none, ids that aren't the digest's, unknown states."""
    again = duplicates(recordings, "recording_id").select("recording_id", F.lit("DUPLICATE_RECORDING_ID").alias("problem"))
    own = F.concat(F.lit("rec-"), F.substring("sha256", 1, 12))
    problem = (
        F.when(~C.is_digest(F.col("sha256")), "SHA256_INVALID")
        .when(~F.col("recording_id").eqNullSafe(own), "RECORDING_ID_MISMATCH")
        .when(~F.coalesce(F.col("state").isin(*STATES), F.lit(False)), "UNKNOWN_STATE")
    )
    return again.unionByName(recordings.select("recording_id", problem.alias("problem")).filter("problem is not null"))


def read_recordings(spark: SparkSession, path: str) -> DataFrame:
    rows = read_strict(spark, path, RECORDINGS)
    require(recording_problems(rows), "recordings are invalid")
    return rows


def one_row(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` if there is exactly one."""
    if (n := len(rows.take(2))) != 1:
        raise ValueError(f"{kind} must have exactly one row, not {'none' if not n else 'more'}")
    return rows


def selection_problems(selections: DataFrame) -> DataFrame:
    """(problem): arrays of different lengths, empty ids, digests that are none, ids that come twice."""
    found = (
        F.when(F.size("recording_ids") != F.size("inventory_hashes"), "LENGTHS_DIFFER")
        .when(F.exists("recording_ids", lambda x: F.coalesce(x == "", F.lit(True))), "EMPTY_RECORDING_ID")
        .when(F.exists("inventory_hashes", lambda x: ~C.is_digest(x)), "SHA256_INVALID")
        .when(F.size(F.array_distinct("recording_ids")) != F.size("recording_ids"), "DUPLICATE_RECORDING_ID")
    )
    return selections.select(found.alias("problem")).filter("problem is not null")


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    rows = one_row(read_strict(spark, path, SELECTION), "selection")
    require(selection_problems(rows), "selection is invalid")
    return rows


def selected_recordings(selection: DataFrame, recordings: DataFrame) -> DataFrame:
    """Recordings of a selection (position, recording_id, sha256) in its order, with what doesn't match.

    problem: MISSING where there is no such recording, SHA256_MISMATCH where it is another one by now.
    """
    rows = selection.withColumnRenamed("sha256", "selected_sha256").join(recordings, "recording_id", "left")
    problem = F.when(F.col("sha256").isNull(), "MISSING").when(F.col("sha256") != F.col("selected_sha256"), "SHA256_MISMATCH")
    return rows.withColumn("problem", problem).drop("selected_sha256")


def transcript_skeleton(selection: DataFrame) -> DataFrame:
    """Intake rows to fill in, one for each selected recording (recording_id), with one blank chosen candidate."""
    kinds = dict(x.split(" ", 1) for x in TRANSCRIPT_INTAKE.split(", "))
    names = [x.split(":")[0] for x in kinds["source_candidates"].removeprefix("array<struct<").split(",")]
    blank = F.array(F.struct(*[F.lit(True if n == "selected" else "").alias(n) for n in names]))
    out = {"recording_id": F.col("recording_id"), "source_candidates": blank, "confirmed": F.lit(False)}
    return selection.select(*[out.get(k, F.lit("")).cast(v).alias(k) for k, v in kinds.items()])


def skeleton_action(existing: DataFrame | None, wanted: DataFrame, replace: bool = False) -> str:
    """write, or keep where the table is the same already; another one is only replaced if asked for."""
    if existing is None:
        return "write"
    if not existing.exceptAll(wanted).take(1) and not wanted.exceptAll(existing).take(1):
        return "keep"
    if not replace:
        raise ValueError("the intake differs from what would be written")
    return "write"


def read_transcript_intake(spark: SparkSession, path: str) -> DataFrame:
    rows = read_strict(spark, path, TRANSCRIPT_INTAKE)
    require(duplicates(rows, "recording_id"), "repeated recording_id")
    return rows


def review_event_problems(events: DataFrame) -> DataFrame:
    """(review_event_id, problem): repeated ids, ids that aren't the content's, events that change nothing."""
    again = duplicates(events, "review_event_id").select("review_event_id", F.lit("DUPLICATE_EVENT_ID").alias("problem"))
    own = review_event_id(events.withColumn("_given", F.col("review_event_id")))
    problem = F.when(~F.col("_given").eqNullSafe(F.col("review_event_id")), "EVENT_ID_MISMATCH").when(F.col("before").eqNullSafe(F.col("after")), "NO_CHANGE")
    return again.unionByName(own.select(F.col("_given").alias("review_event_id"), problem.alias("problem")).filter("problem is not null"))


def read_config(spark: SparkSession, path: str, fields: set[str] | None = None, **versions: str) -> tuple[dict, str]:
    """A configuration object and its digest; ``fields`` are the exact ones, ``versions`` what some must be."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    found = json.loads(text)
    if not isinstance(found, dict) or (fields is not None and set(found) != fields):
        raise ValueError("the configuration must have the exact fields")
    if any(found.get(k) != v for k, v in versions.items()):
        raise ValueError("unsupported version of the configuration")
    return found, hashlib.sha256(C.canonical_json(found).encode()).hexdigest()


def resolve_under(root: str, relative: str) -> str:
    """A path below ``root``; one that would leave it, or that is empty or absolute, is an error."""
    whole = posixpath.normpath(posixpath.join(root, relative))
    if not relative.strip() or posixpath.isabs(relative) or "\\" in relative or not whole.startswith(posixpath.normpath(root).rstrip("/") + "/"):
        raise ValueError(f"path must stay below its root: {relative!r}")
    return whole


def read_text_under(spark: SparkSession, root: str, relative: str) -> str:
    """A whole UTF-8 file below ``root``; links that lead out of it are refused where the root is local."""
    whole = resolve_under(root, relative)
    if ":" not in root and not os.path.realpath(whole).startswith(os.path.realpath(root) + os.sep):
        raise ValueError(f"path must stay below its root: {relative!r}")
    return spark.read.text(whole, wholetext=True).first()["value"]


def weights_manifest(files: DataFrame) -> tuple[str, list[dict]]:
    """(digest, manifest) of a model snapshot's weights; files: filename, sha256, size_bytes, content of the index.

    One index: it and the shards that it names, no more and no fewer. No index: the one .safetensors file, or
    else the one .bin file. The table has a snapshot's files, some hundreds at most.
    """
    rows = {r.filename: r for r in files.filter("filename rlike '[.](safetensors|safetensors[.]index[.]json|bin)$'").collect()}
    shards = {n for n in rows if n.endswith(".safetensors")}
    indexes = sorted(n for n in rows if n.endswith(".safetensors.index.json"))
    if len(indexes) > 1:
        raise ValueError("the snapshot has several indexes")
    if indexes:
        try:
            named = set(json.loads(rows[indexes[0]].content)["weight_map"].values())
        except (ValueError, KeyError, TypeError, AttributeError) as error:
            raise ValueError("the index is invalid") from error
        folder = posixpath.dirname(indexes[0])
        named = {posixpath.normpath(posixpath.join(folder, n)) for n in named}
        if not named or named != shards:
            raise ValueError("the index and the shards differ")
        chosen = [indexes[0], *sorted(shards)]
    else:
        chosen = sorted(shards) or sorted(n for n in rows if n.endswith(".bin"))
        if len(chosen) != 1:
            raise ValueError("the snapshot has no unique weights")
    manifest = [{"filename": n, "sha256": rows[n].sha256, "size_bytes": rows[n].size_bytes} for n in chosen]
    return hashlib.sha256(C.canonical_json(manifest, ascii_only=True).encode()).hexdigest(), manifest


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    """(filename, sha256, size_bytes, content) of a model snapshot; content only of indexes.

    Files are hashed in blocks inside the tasks, so weights of any size do.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    base = (root if ":" in root and not root.startswith("file:") else re.sub(r"^(file:)?/*", "/", root)).rstrip("/") + "/"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            out = []
            for path, length in part.itertuples(index=False):
                fs, name = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
                with fs.open_input_stream(name) as f:
                    digest, kept = hashlib.sha256(), []
                    while block := f.read(1 << 20):
                        digest.update(block)
                        if path.endswith(".index.json"):
                            kept.append(block)
                short = re.sub(r"^file:/*", "/", path)
                out.append({"filename": short.removeprefix(base), "sha256": digest.hexdigest(), "size_bytes": length, "content": b"".join(kept).decode("utf-8", "replace") if kept else None})
            yield frame(out, SNAPSHOT)

    return rows.mapInPandas(run, SNAPSHOT)


def lines_digest(rows: DataFrame, order: list[str]) -> str:
    """Digest of a small table as canonical JSON lines in order."""
    return identity.lines_digest([r.value for r in canonical_lines(rows.orderBy(*order).coalesce(1)).collect()])
