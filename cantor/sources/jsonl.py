"""Strict JSON lines: read with every fault as a column, write in canonical form, publish by snapshot."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantor.functions.columns import canonical_json
from cantor.functions.udf import arrow_udf
from cantor.operators import corpus, evidence


def _fits(value: object, kind: T.DataType) -> bool:
    """Whether a JSON value is of a type itself; Spark's parser would also take numbers for strings and the reverse."""
    if value is None:
        return True
    if isinstance(kind, T.StructType):
        return isinstance(value, dict) and all(_fits(value.get(f.name), f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return isinstance(value, list) and all(_fits(x, kind.elementType) for x in value)
    if isinstance(kind, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(kind, T.IntegralType):
        return type(value) is int
    return type(value) in (int, float) if isinstance(kind, T.FractionalType) else isinstance(value, str)


def fault_of(line: str, kind: T.StructType | None = None) -> str | None:
    """Why a line is no strict JSON object (of a type, if there is one), or None."""

    def pairs(items: list) -> dict:
        if len({k for k, _ in items}) != len(items):
            raise ValueError("DUPLICATE_KEY")
        return dict(items)

    def constant(_: str) -> None:
        raise ValueError("NON_STANDARD_CONSTANT")

    if not line.strip():
        return "BLANK_LINE"
    try:
        row = json.loads(line, object_pairs_hook=pairs, parse_constant=constant)
    except json.JSONDecodeError:
        return "INVALID_JSON"
    except ValueError as error:
        return str(error)
    if not isinstance(row, dict):
        return "NOT_AN_OBJECT"
    if kind is None:
        return None
    if set(row) != set(kind.names):
        return "FIELDS_DIFFER"
    return None if _fits(row, kind) else "INVALID_ROW"


@arrow_udf("string", deterministic=False)
def _fault(lines: pd.Series) -> pd.Series:
    return lines.map(fault_of)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, fault) of each line. Line numbers are no part of it: a split file has no global order to count by."""
    return spark.read.text(path).withColumn("fault", _fault("value"))


def read_strict(spark: SparkSession, path: str, schema: str, exact: bool = True, fail: bool = True) -> DataFrame:
    """Rows of ``schema``; any fault, other type or, if ``exact``, other field set fails the job (or drops to _fault).

    With ``fail`` false, all lines come back with their fault in ``_fault``.
    """
    kind = T.StructType.fromDDL(schema)

    @arrow_udf("string", deterministic=False)
    def typed(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: fault_of(x, kind if exact else None))

    rows = spark.read.text(path).withColumn("fault", typed("value")).withColumn("row", F.from_json("value", schema, {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "_corrupt"}))
    fault = F.coalesce("fault", F.when(F.col("row").isNull(), "INVALID_ROW"))
    if fail:
        checked = F.when(fault.isNull(), F.col("row")).otherwise(F.from_json(F.raise_error(F.concat(fault, F.lit(": "), F.substring("value", 1, 80))).cast("string"), schema))
        return rows.select(checked.alias("row")).select("row.*")
    return rows.select(fault.alias("_fault"), "value", "row.*")


def canonical_lines(rows: DataFrame) -> DataFrame:
    """Rows as canonical JSON text in a column ``value``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"value": [canonical_json(json.loads(t)) for t in frame["value"]]})

    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).mapInPandas(run, "value string")


def write_snapshot(rows: DataFrame, root: str, order: list[str] | None = None) -> str:
    """Writes canonical lines to a new directory under ``root`` and returns it: what is there is never touched.

    A reader takes the directory named in ``root/_current``, replaced last; a failed write leaves no trace in it.
    """
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    lines = canonical_lines(rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows)
    lines.write.mode("errorifexists").text(path)
    spark = rows.sparkSession
    spark.createDataFrame([(path,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}/_current")
    return path


def current_snapshot(spark: SparkSession, root: str) -> str:
    return spark.read.text(f"{root.rstrip('/')}/_current").first()["value"]


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)


def recover_state(spark: SparkSession, journal: str, root: str) -> str | None:
    """After a stop between the two writes: a new snapshot with the journal's states, or None where all agree.

    A state that the journal doesn't lead on from is an error: that is for a person to mend.
    """
    state = spark.read.json(current_snapshot(spark, root))
    found = evidence.recovery(spark.read.parquet(journal), state)
    corpus.require(found.filter("status = 'inconsistent'"), "state and journal disagree")
    moved = found.filter("status = 'recover'").select("recording_id", F.col("journal_state").alias("_to"))
    if not moved.take(1):
        return None
    rows = state.join(moved, "recording_id", "left").withColumn("state", F.coalesce("_to", "state")).select(state.columns)
    return write_snapshot(rows, root, ["recording_id"])


def publish_pair(spark: SparkSession, root: str, rows: DataFrame, markdown: list[str]) -> str:
    """A report's JSON lines and its Markdown in one new directory under ``root``, named by one pointer written last.

    A reader sees both files of one report or those of the one before, never one of each.
    """
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    canonical_lines(rows).coalesce(1).write.mode("errorifexists").text(f"{path}/json")
    spark.createDataFrame([("\n".join(markdown),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/markdown")
    spark.createDataFrame([(path,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}/_current")
    return path


def persist_transition(events: DataFrame, state: DataFrame, journal: str, root: str) -> str:
    """The journal first, then the state: a journal ahead of the state can be recovered, the reverse is corruption.

    Events that the journal holds already are not written again. Of many recordings at once, as of one;
    ``recover_state`` finishes what stopped in between.
    """
    spark = events.sparkSession
    if path_exists(spark, journal):
        events = events.join(spark.read.parquet(journal).select("event_id"), "event_id", "left_anti")
    append_events(events, journal)
    return write_snapshot(state, root, ["recording_id"])
