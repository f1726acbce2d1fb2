"""Column functions: native expressions where Spark has them, Arrow-batched Python where it has not."""

from __future__ import annotations

import difflib
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.functions import latin
from cantor.functions.udf import arrow_udf, portions

WORD = (
    "surface string, normalized string, lookup_key string, transforms array<string>, syllables array<string>, stress_index int, ipa string, phonemes array<string>, "
    "method string, rule_ids array<string>, source_ids array<string>, needs_review boolean, error_code string, error_detail string"
)
SPANS = "array<struct<surface:string,start:int,end:int>>"
_SPAN = [("surface", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
#: Words that are objects at once.
_FEW = 1 << 14


def surfaces(text: Column) -> Column:
    """Runs of letters and the marks after them, without offsets, in the JVM."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0))


def word_spans(docs: DataFrame) -> DataFrame:
    """docs (key, text) with spans (SPANS): its words and where they stand, in code points; none in a null text.

    Texts come in portions, and words become Arrow columns a few at a time, so few are held as objects.
    """
    names, kind = [*docs.columns, "spans"], pa.struct(_SPAN)

    def columns(words: tuple) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array(part, field.type) for part, field in zip(zip(*words, strict=True), kind, strict=True)], fields=list(kind))

    def flow(texts: list[str | None], ends: list[int]) -> Iterator[tuple[str, int, int]]:
        for text in texts:
            n = ends[-1]
            for n, word in enumerate(latin.words(text or ""), n + 1):  # noqa: B007
                yield word
            ends.append(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            ends = [0]
            parts = [columns(words) for words in batched(flow(batch.column(1).to_pylist(), ends), _FEW)]
            spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([pa.array([], kind), *parts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, spans], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, spans {SPANS}")


def words_in_place(text: str, spans: str) -> Column:
    """How many spans (SPANS) have the surface that stands at their place in the text.

    Characters are as wide as each other in the bytes compared, so no place is counted from the text's start.
    """
    wide = F.length(text) != F.octet_length(text)
    code = lambda s, wide: F.when(wide, F.encode(s, "UTF-32")).otherwise(s.cast("binary"))
    # A list of one, so that lambdas get a text's bytes made once, not by each span
    coded = F.array(F.struct(wide.alias("wide"), F.when(wide, 4).otherwise(1).alias("width"), code(F.col(text), wide).alias("bytes")))

    def right(t: Column) -> Column:
        at = lambda s: F.substring(t["bytes"], s["start"] * t["width"] + 1, (s["end"] - s["start"]) * t["width"])
        return F.size(F.filter(spans, lambda s: at(s) == code(s["surface"], t["wide"])))

    return F.transform(coded, right)[0]


@arrow_udf(WORD, deterministic=False)
def pronounce(surface: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([latin.analyze_word(s) for s in surface], columns=[c.split()[0] for c in WORD.split(", ")]).astype({"stress_index": "Int32", "needs_review": "boolean"})


#: Tokens of a plan, and overrides of some of them.
_TOKEN = [f for f in WORD.split(", ") if not f.startswith("surface ")]
_FIELDS = [f.replace(" ", ":", 1) for f in ("token_index int", "surface string", "start int", "end int", *_TOKEN)]
TOKENS = f"array<struct<{','.join(_FIELDS)}>>"
FIXES = "array<struct<token_index:int,stress_index:int,ipa:string,phonemes:array<string>>>"
#: Words that a worker remembers.
KNOWN_WORDS = 200_000


@lru_cache(KNOWN_WORDS)
def _known(word: str) -> dict:
    return latin.analyze_word(word)


def plan_tokens(docs: DataFrame) -> DataFrame:
    """docs (key, text, fixes) with tokens and unknown: all that is known of each word, and whether a fix names no token.

    fixes: overrides (FIXES) or null. Texts come in portions, so few tokens are held at once.
    """
    kinds = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    token = pa.list_(pa.struct([(name, kinds[kind]) for name, kind in (f.split(":", 1) for f in _FIELDS)]))
    key, text, _ = docs.columns

    def plan(text: str | None, listed: list[dict] | None) -> tuple[list[dict], bool]:
        own = {f["token_index"]: {k: f[k] for k in ("stress_index", "ipa", "phonemes")} for f in listed or []}
        rows = []
        for i, (word, start, end) in enumerate(latin.tokenize(text or "")):
            rows.append({**(latin.analyze_word(word, own[i]) if i in own else _known(word)), "token_index": i, "start": start, "end": end})
        return rows, any(not 0 <= i < len(rows) for i in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            plans = [plan(t, listed) for t, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array([p[0] for p in plans], token), pa.array([p[1] for p in plans], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, text, "tokens", "unknown"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"`{key}` {kind}, `{text}` string, tokens {TOKENS}, unknown boolean")


@arrow_udf("string")
def lookup_keys(surface: pd.Series) -> pd.Series:
    return surface.map(lambda s: None if s is None else latin.normalize_word(s)[1])


@arrow_udf("string")
def phrase_form(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else latin.normalize_phrase(t))


@arrow_udf("string")
def alignment_form(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else latin.alignment_form(t))


@arrow_udf("array<struct<op:string,a_start:int,a_end:int,b_start:int,b_end:int>>")
def word_differences(source: pd.Series, spoken: pd.Series) -> pd.Series:
    """Opcodes but equal ones between the blank-separated words of two texts."""

    def one(a: str | None, b: str | None) -> list[dict]:
        found = difflib.SequenceMatcher(None, (a or "").split(), (b or "").split(), autojunk=False).get_opcodes()
        return [{"op": op, "a_start": i, "a_end": j, "b_start": k, "b_end": m} for op, i, j, k, m in found if op != "equal"]

    return pd.Series([one(a, b) for a, b in zip(source, spoken, strict=True)])


@arrow_udf("boolean")
def same_words(found: pd.Series, expected: pd.Series) -> pd.Series:
    """Whether two word lists agree but for case; a null list or word agrees with nothing."""

    def one(a, b) -> bool:
        return a is not None and b is not None and len(a) == len(b) and all(x is not None and y is not None and x.casefold() == y.casefold() for x, y in zip(a, b, strict=True))

    return pd.Series([one(a, b) for a, b in zip(found, expected, strict=True)], dtype="boolean")


def strings_problem(values: Column) -> Column:
    """Why a list isn't one of different, non-empty strings, or null."""
    return F.when(values.isNull() | (F.size(values) == 0) | F.exists(values, lambda x: F.coalesce(x == "", F.lit(True))), "INVALID").when(F.size(F.array_distinct(values)) != F.size(values), "DUPLICATE")


@arrow_udf("boolean")
def is_exception_key(key: pd.Series) -> pd.Series:
    return key.map(lambda k: k is not None and latin.is_exception_key(k)).astype("boolean")


OVERRIDES = "struct<error:string,overrides:array<struct<token_index:int,stress_index:int,ipa:string,phonemes:array<string>>>>"


def parse_overrides(text: str, spoken: str) -> list[dict]:
    """Overrides of a file that is bound to a spoken text by its digest; anything else in it is a ValueError."""
    raw = json.loads(text)
    if not isinstance(raw, dict) or set(raw) != {"spoken_text_sha256", "overrides"}:
        raise ValueError("FIELDS_DIFFER")
    if raw["spoken_text_sha256"] != hashlib.sha256(spoken.encode()).hexdigest():
        raise ValueError("SPOKEN_TEXT_DIFFERS")
    if not isinstance(raw["overrides"], dict):
        raise ValueError("OVERRIDES_NO_OBJECT")
    out = []
    for key, value in raw["overrides"].items():
        if not re.fullmatch("0|[1-9][0-9]*", key):
            raise ValueError("INVALID_INDEX")
        if not isinstance(value, dict) or set(value) != {"stress_index", "ipa", "model_phonemes"}:
            raise ValueError("OVERRIDE_FIELDS_DIFFER")
        stress, ipa, phonemes = value["stress_index"], value["ipa"], value["model_phonemes"]
        if not (stress is None or type(stress) is int) or not (ipa is None or isinstance(ipa, str)):
            raise ValueError("INVALID_VALUE")
        if not (phonemes is None or isinstance(phonemes, list) and all(isinstance(x, str) for x in phonemes)):
            raise ValueError("INVALID_VALUE")
        out.append({"token_index": int(key), "stress_index": stress, "ipa": ipa, "phonemes": phonemes})
    return sorted(out, key=lambda o: o["token_index"])


@arrow_udf(OVERRIDES)
def overrides(text: pd.Series, spoken: pd.Series) -> pd.DataFrame:
    """Overrides by token from the JSON of an override file, or why it isn't one."""
    rows = []
    for t, s in zip(text, spoken, strict=True):
        try:
            rows.append((None, parse_overrides(t or "", s or "")))
        except json.JSONDecodeError:
            rows.append(("INVALID_JSON", None))
        except ValueError as error:
            rows.append((str(error), None))
    return pd.DataFrame(rows, columns=["error", "overrides"])


def canonical_json(row: object, ascii_only: bool = False) -> str:
    """Sorted keys, no blanks, no NaN: the text that digests are taken of."""
    return json.dumps(row, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only, allow_nan=False)


def canonical_digest(rows: Column, ascii_only: bool = False) -> Column:
    """SHA-256 of the canonical form of JSON text."""

    @arrow_udf("string")
    def digest(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else hashlib.sha256(canonical_json(json.loads(t), ascii_only).encode()).hexdigest())

    return digest(rows)


def _id(prefix: str, digits: int, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x00", *parts).cast("binary"), 256), 1, digits))


def recording_id(content: Column) -> Column:
    return F.concat(F.lit("rec-"), F.substring(F.sha2(content.cast("binary"), 256), 1, 12))


def candidate_id(source_id: Column, version: Column, text_sha: Column) -> Column:
    return _id("text-", 16, source_id, version, text_sha)


def segment_id(recording: Column, group: Column, take: Column) -> Column:
    return _id("segment-", 24, recording, group, take.cast("string"))


def smoke_run_id(started: Column, config: Column, revision: Column) -> Column:
    return _id("", 24, started, config, revision)


def unit_id(recording: Column, ordinal: Column) -> Column:
    return F.format_string("%s-unit-%04d", recording, ordinal)


def group_id(recording: Column, unit: Column) -> Column:
    return F.when(F.startswith(unit, F.concat(recording, F.lit("-"))), unit).otherwise(F.concat(recording, F.lit("-"), unit))


def review_entity_id(recording: Column, group: Column, take: Column) -> Column:
    return F.format_string("review:%d:%s:%d:%s:take:%d", F.length(recording), recording, F.length(group), group, take)


def review_slug(recording: Column) -> Column:
    return F.sha2(recording.cast("binary"), 256)


def midpoint(start: Column, end: Column) -> Column:
    return start + F.floor((end - start) / 2).cast("long")


def sample_position(seconds: Column, rate: Column) -> Column:
    """Seconds as samples, halves to even."""
    return F.bround(seconds * rate, 0).cast("long")


def probability(score: Column) -> Column:
    """A log probability (below 0) or a probability, held to [0, 1]; not a number is null."""
    value = F.when(F.isnan(score), F.lit(None)).when(score < 0, F.exp(score)).otherwise(score)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def is_ratio(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (x >= 0) & (x <= 1), F.lit(False))


def is_digest(x: Column) -> Column:
    return F.coalesce(x.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_safe_component(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^[A-Za-z0-9._-]+\z") & ~x.isin(".", ".."), F.lit(False))


def is_canonical_path(x: Column) -> Column:
    """A relative POSIX path without empty, dot or dot-dot parts and without backslashes."""
    parts = F.split(x, "/")
    return F.coalesce((F.length(x) > 0) & ~F.contains(x, F.lit("\\")) & ~F.exists(parts, lambda p: p.isin("", ".", "..")) & ~x.rlike("^[A-Za-z]:"), F.lit(False))


def is_timestamp_text(x: Column) -> Column:
    """An ISO timestamp with a zone."""
    return F.coalesce(x.rlike(r"(Z|[+-]\d\d:?\d\d)\z") & F.try_to_timestamp(x).isNotNull(), F.lit(False))


def audio_suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def content_type(path: Column) -> Column:
    return F.when(F.startswith(path, F.lit("raw/sung/")), "sung").otherwise("spoken")


def markdown_cell(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def html_escape(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def redact_paths(message: Column, project_root: str) -> Column:
    """The project root becomes <project>, other absolute paths <path>, and climbing out of the project too."""
    x = F.replace(message, F.lit(project_root.rstrip("/")), F.lit("<project>"))
    x = F.regexp_replace(x, r"<project>(/[^\s'\"]*)?/\.\.(/[^\s'\"]*)?", "<path>")
    x = F.regexp_replace(x, r"""(?<![\w<>/.])[A-Za-z]:[\\/][^\s'"]*""", "<path>")
    return F.regexp_replace(x, r"""(?<![\w<>/.:])/(?:[^\s'"/]+/)*[^\s'"/]+""", "<path>")


def redact_freeze(line: Column) -> Column:
    """A requirement line without the place or the credentials of its source."""
    return F.regexp_replace(F.regexp_replace(line, r"@ \S+$", "@ <source>"), r"^-e \S+", "-e <source>")


def float_hex(x: Column) -> Column:
    @arrow_udf("string")
    def one(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None or v != v else float(v).hex())

    return one(x.cast("double"))
