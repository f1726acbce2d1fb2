"""Chat formatting with typed content parts, reversible escapes and a loss mask.

A message's content is a list of typed parts. A visitor flattens them in order: text stays text, images,
audio and documents become placeholders; it records each attachment and the tokens it expands to. Turns are
marked ``<|im_start|>role``, newline, content, ``<|im_end|>``, newline. Inside roles and contents a backslash
is doubled and ``<|`` becomes ``<\\|``, so texts can't forge a mark and every text can be read back.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.llm.common import portions

START, STOP = "<|im_start|>", "<|im_end|>\n"
#: Code points of formatted text in one stored row; longer conversations take several rows.
ROW_CHARS = 1 << 20
#: Fixed values of the expansion: pixels of an image patch's side, audio tokens a second, tokens a page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 512
FORMATTED = "conv_id long, part long, last boolean, formatted string, loss array<struct<start:long,end:long>>, attachments array<struct<turn:long,kind:string,uri:string,tokens:long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
#: A placeholder; in a text, escaped, ``<`` and ``|`` never touch.
_PLACEHOLDER = re.compile(r"<\|(image|audio|document)\|>")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def _measure(part: dict, name: str) -> float:
    """A part's measure; numbers written as text count, what is no finite number of at least 0 is 0."""
    try:
        value = float(part.get(name) or 0)
    except (TypeError, ValueError, OverflowError):
        return 0.0
    return value if 0 <= value < math.inf else 0.0


def _string(value) -> str | None:
    """A string without lone surrogates, which JSON can spell and UTF-8 can't; JSON of anything else."""
    if value is None or isinstance(value, str):
        return value and value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return json.dumps(value)


def read_parts(content: str) -> list[tuple[str, str]]:
    """Typed parts of escaped content, in order: (text, its text), and (kind, "") for a placeholder."""
    out: list[tuple[str, str]] = []
    at = 0
    for m in _PLACEHOLDER.finditer(content):
        if m.start() > at:
            out.append(("text", unescape(content[at : m.start()])))
        out.append((m[1], ""))
        at = m.end()
    return out + ([("text", unescape(content[at:]))] if at < len(content) else [])


class PartVisitor:
    """Flattens parts ``{"type", "text" | "uri", ...}``; unknown types are kept as documents of no pages.

    What isn't an object is a text part; a text that isn't a string stands as JSON.
    """

    def __init__(self, turn: int):
        self.turn, self.out, self.attachments = turn, [], []

    def visit(self, part) -> None:
        if not isinstance(part, dict):
            part = {"type": "text", "text": part}
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(_string(part.get("text")) or ""))

    def _place(self, kind: str, part: dict, tokens: int) -> None:
        self.out.append(f"<|{kind}|>")
        self.attachments.append({"turn": self.turn, "kind": kind, "uri": _string(part.get("uri")), "tokens": min(tokens, (1 << 63) - 1)})

    def visit_image(self, part: dict) -> None:
        self._place("image", part, math.ceil(_measure(part, "width") / PATCH) * math.ceil(_measure(part, "height") / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._place("audio", part, math.ceil(_measure(part, "seconds") * AUDIO_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._place("document", part, math.ceil(_measure(part, "pages")) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._place("document", part, 0)


def flatten(turn: int, text: str | None, parts: str | None = None) -> tuple[str, list[dict]]:
    """Escaped content and attachments of a message: its JSON list of parts if it has one, else its text.

    Parts that are JSON but no list are one part; what isn't JSON is the text of one part.
    """
    visitor = PartVisitor(turn)
    listed: list = [text]
    if parts:
        try:
            found = json.loads(parts)
            listed = found if isinstance(found, list) else [found]
        except (ValueError, RecursionError):
            listed = [parts]
    for part in listed:
        visitor.visit(part)
    return "".join(visitor.out), visitor.attachments


def _format_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn; at most one stored row's text is held."""
    nothing = object()
    conv: object = nothing
    part = size = n = 0
    text: list[str] = []
    loss: list[dict] = []
    attached: list[dict] = []

    def emit(last: bool) -> dict:
        nonlocal part, size, text, loss, attached
        row = {"conv_id": conv, "part": part, "last": last, "formatted": "".join(text), "loss": loss, "attachments": attached}
        part, size, text, loss, attached = part + 1, 0, [], [], []
        return row

    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("last", pa.bool_()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("attachments", pa.list_(pa.struct([("turn", pa.int64()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())])))])
    rows: list[dict] = []
    for batch in portions(batches):
        for conv_id, role, content, parts in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
            if conv is nothing or conv_id != conv:
                if conv is not nothing:
                    rows.append(emit(True))
                conv, part, n = conv_id, 0, 0
            elif size >= ROW_CHARS:
                rows.append(emit(False))
            body, more = flatten(n, content, parts)
            head = f"{START}{escape_role(role or '')}\n"
            if role == "assistant":
                loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
            text += (head, body, STOP)
            size += len(head) + len(body) + len(STOP)
            attached += more
            n += 1
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows = []
    if conv is not nothing:
        yield pa.RecordBatch.from_pylist([emit(True)], schema)


def format_conversations(rows: DataFrame) -> DataFrame:
    """Formats ``rows`` (conv_id, turn, role, text, and parts if there is such a column) by turn.

    Null texts and roles are empty, null turns come first, equal turns go by role and text; rows without a
    conv_id form one conversation. A conversation is streamed, not gathered: its text is stored in rows of
    about ROW_CHARS (columns of FORMATTED) whose loss spans count from the row's start.
    """
    parts = F.col("parts").cast("string") if "parts" in rows.columns else F.lit(None).cast("string")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("role").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), parts.alias("parts"), F.col("turn").cast("long"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "parts").mapInArrow(_format_sorted, FORMATTED)


def read_back(formatted: str, loss: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns (role, text) and loss texts of stored text, unescaped."""
    turns = [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]
    return turns, [unescape(formatted[s["start"] : s["end"]]) for s in loss or []]


def _digest_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation come one after the other, in order; only digests are carried on."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    n = chars = total = 0
    whole, masked = hashlib.sha256(), hashlib.sha256()
    for batch in portions(batches):
        out = []
        for conv_id, last, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "last", "formatted", "loss")), strict=True):
            turns, texts = read_back(formatted, loss)
            for role, text in turns:
                whole.update(f"{role}\n{text}\n".encode())
            for text in texts:
                masked.update(text.encode())
                chars += len(text)
            n, total = n + len(turns), total + len(formatted)
            if last:
                out.append((conv_id, n, whole.hexdigest(), chars, masked.hexdigest(), total))
                n = chars = total = 0
                whole, masked = hashlib.sha256(), hashlib.sha256()
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from their stored text (columns of DIGESTS).

    Conversations stored in one row need no shuffle; only the rest are brought together, in order.
    """
    single = formatted.filter("part = 0 and last")
    several = formatted.filter("part > 0 or not last").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    columns = ["conv_id", "last", "formatted", "loss"]
    return single.select(columns).mapInArrow(_digest_sorted, DIGESTS).union(several.select(columns).mapInArrow(_digest_sorted, DIGESTS))
