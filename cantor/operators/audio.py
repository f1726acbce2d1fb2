"""Checks on audio that was cut or converted, and the conversions themselves as tasks over rows."""

from __future__ import annotations

import io
import json
import subprocess
import wave
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantor.functions.udf import arrow_udf, frame

RATE = 16_000
LAYOUT = "channels int, sample_width int, sample_rate int, frames long, compression string, error string"
PROBED = "duration_seconds double, sample_rate int, channels int, codec string, bit_rate long, duration_ts long, time_base string, error string"
MADE = "cache_key string, content binary, error string"
#: What each kind of derived audio is encoded as.
ENCODINGS = {
    "analysis": ("-ac", "1", "-ar", str(RATE), "-c:a", "pcm_s16le", "-f", "wav"),
    "candidate": ("-ac", "1", "-ar", str(RATE), "-c:a", "pcm_s16le", "-f", "wav"),
    "review": ("-c:a", "pcm_s24le", "-f", "wav"),
    "lossless": ("-c:a", "flac", "-f", "flac"),
}


def bounds_problem(start: Column, end: Column, duration: Column) -> Column:
    """Why (start, end) in seconds is no segment of a file of that duration, or null."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(bad(start) | bad(end), "NOT_FINITE").when((start < 0) | (end <= start), "NOT_A_RANGE").when(end > duration, "BEYOND_END")


def speech_problems(speech: DataFrame, recordings: DataFrame, key: str = "recording_id") -> DataFrame:
    """Speech intervals (key, start, end in 16 kHz samples) that are empty, overlap, or pass the file's end.

    recordings: key, duration_seconds and n_samples of the analysis file. A recording without any interval is
    a row with null ends and NO_SPEECH.
    """
    before = F.lag("end").over(Window.partitionBy(key).orderBy("start", "end"))
    rows = speech.select(key, "start", "end", before.alias("before"))
    rows = recordings.select(key, "duration_seconds", "n_samples").join(rows, key, "left")
    last = F.least("n_samples", F.ceil(F.col("duration_seconds") * RATE))
    problem = (
        F.when(F.col("start").isNull(), "NO_SPEECH").when((F.col("start") < 0) | (F.col("end") <= F.col("start")), "NOT_A_RANGE")
        .when(F.col("start") < F.col("before"), "OVERLAP").when(F.col("end") > last, "BEYOND_END")
    )
    return rows.select(key, "start", "end", problem.alias("problem")).filter("problem is not null")


def rational_samples(ticks: Column, time_base: Column, rate: Column) -> Column:
    """ticks * time_base (``num/den``) * rate if that is a whole number, else null; exact integers throughout."""
    parts = F.split(time_base, "/")
    numerator, denominator = (F.get(parts, F.lit(i)).try_cast("decimal(10,0)") for i in (0, 1))
    product = ticks.cast("decimal(18,0)") * numerator * rate.cast("decimal(10,0)")
    return F.when((denominator > 0) & (product % denominator == 0), (product / denominator).cast("long"))


def layout_of(data: bytes) -> dict:
    with wave.open(io.BytesIO(data)) as w:
        return {"channels": w.getnchannels(), "sample_width": w.getsampwidth(), "sample_rate": w.getframerate(), "frames": w.getnframes(), "compression": w.getcomptype()}


@arrow_udf(LAYOUT)
def wav_layout(content: pd.Series) -> pd.DataFrame:
    rows = []
    for data in content:
        try:
            rows.append(layout_of(data) | {"error": None})
        except (wave.Error, EOFError, TypeError) as error:
            rows.append({"error": str(error) or type(error).__name__})
    return frame(rows, LAYOUT)


def analysis_problem(layout: Column, samples: Column) -> Column:
    """Analysis and candidate files: 16 kHz mono PCM16, not empty, within a sample of what was asked for (null: any)."""
    right = (layout["channels"] == 1) & (layout["sample_width"] == 2) & (layout["sample_rate"] == RATE) & (layout["compression"] == "NONE")
    near = samples.isNull() | (F.abs(layout["frames"] - samples) <= 1)
    return F.when(layout["error"].isNotNull(), "UNREADABLE").when(~right, "LAYOUT").when(layout["frames"] == 0, "EMPTY").when(~near, "SAMPLES")


def review_problem(layout: Column, rate: Column, channels: Column, samples: Column) -> Column:
    """Files for review: the source's layout in PCM24, within a sample of what was asked for."""
    right = (layout["channels"] == channels) & (layout["sample_width"] == 3) & (layout["sample_rate"] == rate)
    return F.when(layout["error"].isNotNull(), "UNREADABLE").when(~right, "LAYOUT").when((layout["frames"] == 0) | (F.abs(layout["frames"] - samples) > 1), "SAMPLES")


def lossless_problem(probed: Column, rate: Column, channels: Column, samples: Column) -> Column:
    """Lossless segments: FLAC in the source's layout, a whole number of samples near what was asked for, a duration that agrees."""
    found = rational_samples(probed["duration_ts"], probed["time_base"], probed["sample_rate"])
    right = (probed["codec"] == "flac") & (probed["sample_rate"] == rate) & (probed["channels"] == channels)
    near = F.coalesce(F.abs(found - samples) <= 1, F.lit(False))
    agrees = (probed["duration_seconds"] > 0) & (F.abs(probed["duration_seconds"] - found / rate) <= 0.05)
    return F.when(probed["error"].isNotNull(), "UNREADABLE").when(~F.coalesce(right, F.lit(False)), "LAYOUT").when(~near, "SAMPLES").when(~F.coalesce(agrees, F.lit(False)), "DURATION")


def probed_stream(said: str) -> dict:
    """Of a prober's JSON, the first audio stream."""
    found = json.loads(said)
    stream = next((s for s in found.get("streams", []) if s.get("codec_type") == "audio"), None)
    if stream is None:
        raise ValueError("no audio stream")
    rate = stream.get("bit_rate") or found.get("format", {}).get("bit_rate")
    ticks = stream.get("duration_ts")
    return {
        "duration_seconds": float(stream.get("duration") or found["format"]["duration"]), "sample_rate": int(stream["sample_rate"]), "channels": int(stream["channels"]), "codec": stream["codec_name"],
        "bit_rate": int(rate) if rate else None, "duration_ts": int(ticks) if ticks is not None else None, "time_base": stream.get("time_base"), "error": None,
    }


def probe_files(files: DataFrame, prober: Callable[[str], str]) -> DataFrame:
    """files (path) with PROBED: an external prober's JSON, path by path inside the tasks; what fails is an error column."""
    schema = f"path string, {PROBED}"

    def one(path: str) -> dict:
        try:
            return probed_stream(prober(path))
        except (OSError, ValueError, KeyError, TypeError, subprocess.SubprocessError) as error:
            return {"error": f"{type(error).__name__}: {error}"}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            yield frame([one(p) | {"path": p} for p in part["path"]], schema)

    return files.select("path").mapInPandas(run, schema)


def ffprobe(path: str) -> str:
    command = ["ffprobe", "-v", "error", "-print_format", "json", "-show_streams", "-show_format", path]
    return subprocess.run(command, capture_output=True, check=True, encoding="utf-8").stdout


def conversion(mode: str, source: str, start: float | None = None, end: float | None = None) -> list[str]:
    """The command that writes audio of a mode to its output; whole files have no ends."""
    cut = [] if start is None else ["-ss", repr(float(start)), "-to", repr(float(end))]
    return ["ffmpeg", "-nostdin", "-v", "error", "-xerror", "-i", source, *cut, "-map", "0:a:0", "-map_metadata", "-1", *ENCODINGS[mode], "pipe:1"]


def ffmpeg(mode: str, source: str, start: float | None = None, end: float | None = None) -> bytes:
    return subprocess.run(conversion(mode, source, start, end), capture_output=True, check=True).stdout


def convert(wanted: DataFrame, converter: Callable[..., bytes]) -> DataFrame:
    """MADE for each row of ``wanted`` (cache_key, mode, path, start_seconds, end_seconds); a failure is an error column.

    Rows are content-addressed, so a task that runs again makes the same row; nothing is written on executors.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            for key, mode, path, start, end in part.itertuples(index=False):
                try:
                    content, error = converter(mode, path, *(None if x is None or x != x else x for x in (start, end))), None
                except (OSError, ValueError, KeyError, subprocess.SubprocessError) as problem:
                    content, error = None, f"{type(problem).__name__}: {problem}"
                yield frame([{"cache_key": key, "content": content, "error": error}], MADE)

    return wanted.select("cache_key", "mode", "path", "start_seconds", "end_seconds").mapInPandas(run, MADE)


def publishable(made: DataFrame, wanted: DataFrame) -> DataFrame:
    """Converted audio that may be published: (cache_key, content, sha256, problem) against wanted (cache_key, sha256).

    problem: FAILED where it couldn't be made, HASH_DIFFERS where it isn't what the manifest names, MISSING
    where it wasn't asked to be made. Publish the rows without a problem only if there is none with one.
    """
    found = made.select("cache_key", "content", "error", F.sha2("content", 256).alias("sha256"))
    rows = wanted.select("cache_key", F.col("sha256").alias("wanted")).join(found, "cache_key", "left")
    problem = F.when(F.col("error").isNotNull(), "FAILED").when(F.col("sha256").isNull(), "MISSING").when(F.col("sha256") != F.col("wanted"), "HASH_DIFFERS")
    return rows.select("cache_key", "content", "sha256", problem.alias("problem"))
