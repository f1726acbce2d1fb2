"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bulk-synchronous best fit. Documents (cut into pieces where longer than a sequence) are range-sorted by
length over the cluster, so that each has a rank. Open gaps are kept in size order too. In each superstep
the longest unplaced length class goes to its successors, the smallest gaps that hold it; documents of the
class that want the same gap are told apart by rank; the gaps shrink, and the next class follows.

Lengths are whole numbers up to ``max_tokens``, so both sorted orders are kept as runs: a run is a range of
document ranks or of sequence numbers that are alike. The supersteps look at runs only (their number depends
on ``max_tokens``, not on the number of documents) and every document then finds its place from its rank,
in parallel. This is best-fit decreasing, exactly.
"""

from __future__ import annotations

import array
import bisect
import json
import os
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.llm.common import Scratch, portions

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Distinct chunks without white space, and words of them, in a generation of what a worker remembers.
CACHE_CHUNKS = 500_000
#: How the files that the quick way is for normalise and split text.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Most runs that are broadcast (40 bytes each); beyond it they are joined by blocks of ranks.
BROADCAST_RUNS = 1_000_000
RANK_BLOCK = 1 << 16
#: Outside this, white space and normal forms need the tokenizer's own rules on the whole text.
_UNUSUAL = "[\x1c-\x1fɐ-\U0010ffff]"
_IN_PART = (1 << 33) - 1

_tokenizers: dict[str, tuple] = {}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()
_WORDS = regex.compile(SPLIT)


class _Ids(dict):
    """Ids of chunks without white space and of their words, from the tokenizer's merges alone.

    When it is full, what it held goes on as a second generation, from which what is still met comes back.
    """

    def __init__(self, model):
        self.tokenize, self.older = model.tokenize, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(chunk)
        if ids is None:
            lower = chunk.lower()
            if not lower.isalpha():
                body, last = lower[:-1], lower[-1:]
                words = [body, last] if last in ",." and body.isalpha() else _WORDS.findall(lower)
                ids = self._merged(lower) if words == [lower] else b"".join([self[w] for w in words])
            elif lower != chunk:
                ids = self[lower]
            else:
                ids = self._merged(lower)
        self[chunk] = ids
        return ids

    def _merged(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else "".join([_LETTERS[b] for b in word.encode()])
        return _packed_ids([t.id for t in self.tokenize(letters)])


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        unusual = re.compile("|".join([_UNUSUAL, *map(re.escape, special)]))
        _tokenizers[path] = (tokenizer, _Ids(tokenizer.model) if _is_quick(form) else None, unusual)
    return _tokenizers[path]


def _is_quick(form: dict) -> bool:
    """Whether a tokenizer's file splits text the way that ``_Ids`` does."""
    before = form["pre_tokenizer"] or {}
    split, letters = ((before.get("pretokenizers") or []) + [{}, {}])[:2]
    model = form["model"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "fuse_unk"))
    whole = not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in form["added_tokens"])
    return (
        plain and whole and form["truncation"] is None and form["post_processor"] is None
        and (form["normalizer"] or {}).get("normalizers") == NORMALIZERS
        and len(before.get("pretokenizers") or []) == 2
        and split == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        and letters.get("type") == "ByteLevel" and not letters.get("add_prefix_space") and not letters.get("use_regex")
    )


def _packed_ids(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()


def encode_texts(texts: list[str], tokenizer_path: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit words.

    The tokenizer drops white space and merges within words only, so a text's ids are those of its chunks in
    turn, and a chunk's those of its words; a worker remembers both. Texts with unusual characters, whose
    white space or normal form need the tokenizer's own rules, or with its special tokens, are encoded as a
    whole; so are all texts where the file has another form of splitting.
    """
    tokenizer, chunks, unusual = _tokenizer(tokenizer_path)
    out: list[bytes] = []
    for text in texts:
        if chunks is None or unusual.search(text):
            out.append(_packed_ids(tokenizer.encode(text, add_special_tokens=False).ids))
        else:
            out.append(b"".join(map(chunks.__getitem__, text.split())))
    return out


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of each document, whose last id is ``end_id``.

    A null or empty text is the end id alone. Repeated rows are documents of their own.
    """
    end = _packed_ids([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_texts([t or "" for t in batch.column(1).to_pylist()], tokenizer_path), strict=True):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, max_tokens)):
                    part = ids if n <= max_tokens else ids[4 * start : 4 * (start + max_tokens)]
                    rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def best_fit_runs(counts: dict[int, int], max_tokens: int) -> tuple[np.ndarray, int]:
    """Supersteps over the length classes, longest first.

    counts: documents by length. Returns rows (first rank, length, documents in a sequence, first sequence,
    place in it), ordered by rank, and the number of sequences. Ranks count from the longest document.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    runs: list[tuple[int, int, int, int, int]] = []
    rank = opened = 0

    def leave(gap: int, first: int, last: int) -> None:
        if gap and last > first:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, last))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, last = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = max_tokens, opened
                last = opened = opened + -(-left // (gap // length))
            each = gap // length
            used = min(last - first, -(-left // each))
            placed = min(left, used * each)
            runs.append((rank, length, each, first, max_tokens - gap))
            rank, left = rank + placed, left - placed
            full = placed // each
            leave(gap - each * length, first, first + full)
            leave(gap - (placed - full * each) * length, first + full, first + used)
            leave(gap, first + used, last)
    return np.asarray(runs, dtype=np.int64).reshape(-1, 5), opened


def pack_pieces(pieces: DataFrame, max_tokens: int = 4096) -> DataFrame:
    """Gives each piece a sequence and a place in it: columns of ``pieces``, sequence_id and offset.

    Ties go by a hash of the document, so that a length that a third of all pieces have is still spread.
    An empty table packs into no sequence.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.save(pieces, "pieces")
    order = [F.col("length").desc(), F.xxhash64("doc_id", "piece")]
    placed = pieces.repartitionByRange(*order).sortWithinPartitions(*order, "doc_id", "piece")
    ranked = scratch.save(placed.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    scratch.drop("pieces")
    by_part = ranked.groupBy(F.shiftright("_at", 33).alias("part")).count().collect()
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    sizes = np.zeros(max([r["part"] for r in by_part], default=0) + 2, dtype=np.int64)
    for r in by_part:
        sizes[r["part"] + 1] = r["count"]
    starts = np.cumsum(sizes)
    runs, _ = best_fit_runs(counts, max_tokens)
    names = pieces.columns
    if len(runs) > BROADCAST_RUNS:
        return _by_join(ranked, starts, runs, counts, names)
    shared = spark.sparkContext.broadcast((starts, runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, runs = shared.value
        for batch in batches:
            at = batch.column(len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = starts[at >> 33] + (at & _IN_PART)
            row = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1] if len(at) else runs[:0]
            nth = rank - row[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * row[:, 1])],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def _by_join(ranked: DataFrame, starts: np.ndarray, runs: np.ndarray, counts: dict[int, int], names: list[str]) -> DataFrame:
    """The same places by a shuffled join on blocks of ranks, for more runs than are broadcast."""
    spark = ranked.sparkSession
    ends = np.append(runs[1:, 0], sum(counts.values()))
    table = spark.createDataFrame([(*map(int, r), int(e)) for r, e in zip(runs, ends, strict=True)], "r0 long, run_length long, each long, s0 long, o0 long, r1 long")
    table = table.withColumn("block", F.explode(F.expr(f"sequence(r0 div {RANK_BLOCK}, (r1 - 1) div {RANK_BLOCK})")))
    parts = spark.createDataFrame([(i, int(v)) for i, v in enumerate(starts)], "part long, base long")
    rows = ranked.withColumn("part", F.shiftright("_at", 33)).join(parts, "part")
    rows = rows.withColumn("rank", F.col("base") + F.col("_at").bitwiseAND(_IN_PART)).withColumn("block", F.expr(f"rank div {RANK_BLOCK}"))
    rows = rows.join(table, (rows["block"] == table["block"]) & (F.col("rank") >= F.col("r0")) & (F.col("rank") < F.col("r1")))
    nth = F.col("rank") - F.col("r0")
    return rows.select(*names, (F.col("s0") + F.expr("(rank - r0) div each")).alias("sequence_id"), (F.col("o0") + nth % F.col("each") * F.col("run_length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenises and packs ``docs`` (doc_id, text); further columns are ignored."""
    return pack_pieces(tokenize_pieces(docs, tokenizer_path, max_tokens, end_id), max_tokens)
