"""Arrow UDFs that are made on first use, so that modules import without a session."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(kind: str, deterministic: bool = True) -> Callable[[Callable], Callable[..., Column]]:
    """Like pandas_udf. A costly function is declared nondeterministic: filters on its result then reuse it."""

    def wrap(f: Callable) -> Callable[..., Column]:
        @cache
        def made():
            udf = F.pandas_udf(f, kind)
            return udf if deterministic else udf.asNondeterministic()

        def call(*columns) -> Column:
            return made()(*columns)

        call.__doc__, call.__name__ = f.__doc__, f.__name__
        return call

    return wrap


def portions(batches: Iterator[pa.RecordBatch], most: int = 256 << 10) -> Iterator[pa.RecordBatch]:
    """The batches cut into portions of about ``most`` bytes: long texts come one by one, short ones together."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def frame(rows: list[dict], schema: str) -> pd.DataFrame:
    """Rows as a frame that Arrow takes for ``schema``: missing values are nulls, numbers stay whole, strings objects."""
    kinds = dict(c.split(" ") for c in schema.split(", "))
    whole = {"int": "Int32", "long": "Int64", "boolean": "boolean", "double": "Float64"}
    return pd.DataFrame({name: pd.Series([r.get(name) for r in rows], dtype=whole.get(kind, object)) for name, kind in kinds.items()})
