"""Content addresses: digests of canonical JSON that name artifacts, and seals that tell whether one was changed."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.functions import columns as C

#: The fields of each identity beside schema_version, and the schema's version.
ALIGNMENT = ("audio_sha256", "spoken_text_sha256", "alignment_text_sha256", "segmentation_artifact_sha256", "backend", "backend_version", "model_id", "model_revision", "model_license", "config_sha256", "effective_parameters", "alignment_transform_version")
RUNTIME = ("backend", "backend_version", "model_id", "model_revision", "model_license", "effective_parameters", "alignment_transform_version")
AUDIO = ("mode", "source_relative_path", "source_sha256", "config_sha256", "output_config_sha256", "ffmpeg_version")
PAIRING = ("recording_id", "windows", "analysis_audio_relative_path", "analysis_audio_sha256", "segmentation_artifact_sha256", "config_sha256", "pairing_parameters", "ffmpeg_version")
SEGMENTATION = ("recording_id", "config_sha256", "input_sha256s")
#: Where derived audio of each mode goes, under the folder of derived data.
FOLDERS = {"analysis": "normalized/analysis-%s.wav", "candidate": "segments/candidates/candidate-%s.wav", "review": "segments/review/review-%s.wav", "lossless": "segments/lossless/lossless-%s.flac"}
SEAL = "integrity_sha256"


def identity_digest(fields: dict[str, Column], nested: tuple[str, ...] = (), ascii_only: bool = False) -> Column:
    """SHA-256 of the canonical JSON object of ``fields``; those of ``nested`` are JSON text that stands as it is.

    Nulls are JSON nulls. A field of ``nested`` that isn't JSON makes the job fail.
    """
    parts = []
    for name, value in fields.items():
        if name in nested:
            text = F.coalesce(value, F.lit("null"))
        else:
            text = F.regexp_replace(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":|\}$', "")
        parts.append(F.concat(F.lit(f'"{name}":'), text))
    return C.canonical_digest(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), ascii_only)


def _columns(names: tuple[str, ...]) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def alignment_cache_key() -> Column:
    """Of a request's columns (ALIGNMENT); effective_parameters is JSON text."""
    return identity_digest({"schema_version": F.lit("2")} | _columns(ALIGNMENT), ("effective_parameters",))


def alignment_runtime_digest() -> Column:
    return identity_digest(_columns(RUNTIME), ("effective_parameters",))


def audio_cache_key() -> Column:
    """Of a derived file's columns (AUDIO, start_seconds, end_seconds); whole files have no ends."""
    ends = {n: C.float_hex(F.col(n)) for n in ("start_seconds", "end_seconds")}
    return identity_digest({"schema_version": F.lit("1")} | _columns(AUDIO) | ends, ascii_only=True)


def audio_path(mode: Column, key: Column, root: str = "derived/") -> Column:
    """The relative path of derived audio; null for a mode that doesn't exist."""
    path = F.lit(None).cast("string")
    for name, form in FOLDERS.items():
        path = F.when(mode == name, F.format_string(root + form, key)).otherwise(path)
    return path


def pairing_cache_key() -> Column:
    """Of a recording's columns (PAIRING); windows and pairing_parameters are JSON text."""
    return identity_digest({"schema_version": F.lit("1")} | _columns(PAIRING), ("windows", "pairing_parameters"))


def segmentation_cache_key() -> Column:
    return identity_digest({"schema_version": F.lit("1")} | _columns(SEGMENTATION))


def _content(rows: DataFrame) -> Column:
    names = [c for c in rows.columns if c != SEAL]
    return C.canonical_digest(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"}))


def sealed(rows: DataFrame) -> DataFrame:
    """Rows with integrity_sha256, the digest of the canonical JSON of their other fields."""
    return rows.withColumn(SEAL, _content(rows))


def broken_seals(rows: DataFrame) -> DataFrame:
    """Rows whose integrity_sha256 isn't that of their content."""
    return rows.filter(~F.col(SEAL).eqNullSafe(_content(rows)))


def lines_digest(lines: list[str]) -> str:
    """SHA-256 of canonical JSON lines, each with its line feed: the digest of a small file, in order."""
    return hashlib.sha256("".join(x + "\n" for x in lines).encode()).hexdigest()
