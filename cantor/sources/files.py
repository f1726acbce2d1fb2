"""Files of a corpus: intake tables, audio discovery and measures, TextGrids."""

from __future__ import annotations

import io
import re
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions.udf import arrow_udf, frame
from cantor.operators.corpus import duplicates, require

INTAKE = "relative_path string, title_or_citation string, speaker_id string, rights_id string, notes string"
RIGHTS = "rights_id string, owner_id string, speaker_id string, allow_local_processing boolean, allow_model_training boolean, allow_internal_evaluation boolean, allow_raw_release string, allow_segment_release string, allow_model_release string, authorized_at string, basis string, notes string"
RECORDINGS = "schema_version string, recording_id string, relative_path string, sha256 string, content_type string, title_or_citation string, speaker_id string, rights_id string, notes string, metadata struct<duration_seconds:double,sample_rate:int,channels:int,codec:string,bit_rate:int>, state string"
#: Audio that is picked up, and the sample limits of the measures.
SUFFIXES = (".wav", ".flac", ".mp3", ".m4a", ".ogg", ".opus", ".aac")
CLIPPED, SILENT = 32760, 327


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    """The intake table; its header must have the columns in order, and paths must be unique and canonical."""
    rows = spark.read.csv(path, schema=INTAKE, header=True, enforceSchema=False, encoding="UTF-8", mode="FAILFAST")
    require(duplicates(rows, "relative_path"), "repeated relative_path")
    require(rows.filter(~C.is_canonical_path(F.col("relative_path"))), "path is not canonical")
    return rows


def write_intake_skeleton(files: DataFrame, path: str) -> None:
    """A table to fill in, for files (relative_path); never over one that exists."""
    blank = [F.lit("").alias(c.split()[0]) for c in INTAKE.split(", ")[1:]]
    files.select("relative_path", *blank).orderBy("relative_path").coalesce(1).write.mode("errorifexists").csv(path, header=True)


def discover_audio(spark: SparkSession, root: str, with_hash: bool = False) -> DataFrame:
    """(relative_path, length[, sha256]) of audio files under ``root``; contents are read only for hashes."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = re.sub(r"^file:/*", "file:/", root if ":" in root else f"file:{root}").rstrip("/") + "/"
    path = F.replace(F.regexp_replace("path", r"^file:/*", "file:/"), F.lit(base), F.lit(""))
    hashed = [F.sha2("content", 256).alias("sha256")] if with_hash else []
    return rows.select(path.alias("relative_path"), "length", *hashed).filter(C.audio_suffix(F.col("relative_path")).isin(*SUFFIXES))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of whole UTF-8 text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def pcm_measures(data: bytes) -> dict:
    """Peak, RMS and shares of a 16-bit PCM WAV, read by blocks."""
    with wave.open(io.BytesIO(data)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("not 16-bit PCM")
        rate, channels, n, top, squares, clipped, silent = w.getframerate(), w.getnchannels(), 0, 0, 0, 0, 0
        while block := w.readframes(1 << 16):
            s = np.abs(np.frombuffer(block, "<i2").astype(np.int64))
            n, top, squares = n + len(s), max(top, int(s.max(initial=0))), squares + int(s @ s)
            clipped, silent = clipped + int((s >= CLIPPED).sum()), silent + int((s <= SILENT).sum())
    if not n:
        raise ValueError("no samples")
    return {"sample_rate": rate, "channels": channels, "samples": n // channels, "peak": min(top / 32768, 1.0), "rms": (squares / n) ** 0.5 / 32768, "clipped_ratio": clipped / n, "silent_ratio": silent / n}


MEASURES = "sample_rate int, channels int, samples long, peak double, rms double, clipped_ratio double, silent_ratio double, error string"


@arrow_udf(MEASURES)
def wav_measures(content: pd.Series) -> pd.DataFrame:
    rows = []
    for data in content:
        try:
            rows.append(pcm_measures(data) | {"error": None})
        except (wave.Error, ValueError, EOFError) as error:
            rows.append({"error": str(error)})
    return frame(rows, MEASURES)


def quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def format_textgrid(duration: float, tiers: dict[str, list[tuple[float, float, str]]]) -> str:
    """A long TextGrid of interval tiers; gaps become empty intervals."""
    out = ['File type = "ooTextFile"', 'Object class = "TextGrid"', "", "xmin = 0", f"xmax = {duration!r}", "tiers? <exists>", f"size = {len(tiers)}", "item []:"]
    for i, (name, intervals) in enumerate(tiers.items(), 1):
        whole, at = [], 0.0
        for a, b, text in sorted(intervals):
            if a < at or b <= a or b > duration:
                raise ValueError("intervals must be ordered, apart and inside the file")
            whole += [(at, a, "")] * (a > at) + [(a, b, text)]
            at = b
        whole += [(at, duration, "")] * (at < duration)
        out += [f"    item [{i}]:", '        class = "IntervalTier"', f"        name = {quoted(name)}", "        xmin = 0", f"        xmax = {duration!r}", f"        intervals: size = {len(whole)}"]
        for j, (a, b, text) in enumerate(whole, 1):
            out += [f"        intervals [{j}]:", f"            xmin = {a!r}", f"            xmax = {b!r}", f"            text = {quoted(text)}"]
    return "\n".join(out) + "\n"


@arrow_udf("string")
def textgrid(duration: pd.Series, words: pd.Series) -> pd.Series:
    """A TextGrid of one tier from intervals (start, end, text); rows of none are empty files of that length."""
    return pd.Series([format_textgrid(float(d), {"words": [(w["start"], w["end"], w["text"]) for w in ([] if ws is None else ws)]}) for d, ws in zip(duration, words, strict=True)])


def write_textgrids(rows: DataFrame, root: str) -> None:
    """One file for each row (path, content) below ``root``; a task that runs again writes the same bytes."""
    rows.select("content", "path").write.mode("errorifexists").partitionBy("path").option("lineSep", "").text(root)


_FIELD = re.compile(r'(?:^|\n)[ \t]*(name|xmin|xmax|text|intervals: size|size|class) = ("(?:[^"]|"")*"|[^\n]*)')


def parse_textgrid(text: str) -> list[tuple[str, float, float, str]]:
    """(tier, start, end, text) of all intervals; they must cover each tier without gaps."""
    if not text.startswith('File type = "ooTextFile"'):
        raise ValueError("not a TextGrid")
    tier, at, a, b, top, rows = None, 0.0, 0.0, 0.0, None, []
    ends: dict[str, float] = {}
    for name, value in _FIELD.findall(text):
        if name == "name":
            tier, at = value[1:-1].replace('""', '"'), 0.0
        elif name == "xmin":
            a = float(value)
        elif name == "xmax":
            b = float(value)
            top = b if top is None else top
        elif name == "text":
            if tier is None or a != at or b <= a:
                raise ValueError("intervals don't follow on each other")
            rows.append((tier, a, b, value[1:-1].replace('""', '"')))
            at = ends[tier] = b
    if any(end != top for end in ends.values()):
        raise ValueError("a tier ends early")
    return rows


@arrow_udf("array<struct<tier:string,start:double,end:double,text:string>>")
def textgrid_intervals(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [dict(zip(("tier", "start", "end", "text"), r, strict=True)) for r in parse_textgrid(t)])
