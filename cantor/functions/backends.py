"""What models and media tools must offer, and how they run: batches on executors, one backend per worker.

No model is shipped. A factory is pickled with the task; it makes its backend once in each Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class VadBackend(Protocol):
    """Speech probabilities of consecutive windows of an audio file."""

    def analyze(self, path: str) -> list[tuple[int, int, float]]: ...


class AlignmentBackend(Protocol):
    """Word spans of a text in an audio file: (text, start seconds, end seconds, score)."""

    def align(self, path: str, text: str) -> list[tuple[str, float, float, float]]: ...


FRAMES = "frames array<struct<start:bigint,end:bigint,probability:double>>, error string"
WORDS = "words array<struct<text:string,start_seconds:double,end_seconds:double,score:double>>, error string"


def _batched(rows: DataFrame, factory: Callable, call: Callable, column: str, fields: tuple[str, ...], kind: str) -> DataFrame:
    """Runs ``call(backend, row)`` on each row; a failure is the row's error, not the job's."""
    names = rows.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = factory()
        for frame in frames:
            found, errors = [], []
            for row in frame.itertuples(index=False):
                try:
                    found.append([dict(zip(fields, x, strict=True)) for x in call(backend, row)])
                    errors.append(None)
                except Exception as error:  # any failure of a foreign backend belongs to its row
                    found.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield frame[names].assign(**{column: found, "error": errors})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{schema}, {kind}")


def voice_activity(recordings: DataFrame, factory: Callable[[], VadBackend]) -> DataFrame:
    """recordings (with path) and their frames."""
    return _batched(recordings, factory, lambda b, r: b.analyze(r.path), "frames", ("start", "end", "probability"), FRAMES)


def align(requests: DataFrame, factory: Callable[[], AlignmentBackend]) -> DataFrame:
    """requests (with path and text) and their word spans."""
    return _batched(requests, factory, lambda b, r: b.align(r.path, r.text), "words", ("text", "start_seconds", "end_seconds", "score"), WORDS)
