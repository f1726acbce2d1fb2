"""WARC archives: a writer with revisit records, and a reader that checks the chain of record boundaries.

Archives are plain WARC/1.0 files. The reader cuts them into byte ranges. Each task lists the candidates of
its range, every place that looks like a record header, with the offset where the next record should start.
Pointer jumping from offset 0 of each file then keeps the candidates that the chain reaches, so a magic
string inside a payload is never taken for a record. Tasks shorten chains inside their own range first; the
jumps between ranges double each round.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantor.llm.common import Scratch, open_uri

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: Bytes that a reader adds at first to find the end of a range's last header; it doubles them until it does.
HEADER_BYTES = 1 << 16
#: Tasks that ranges are dealt to at most; each then has several.
MOST_TASKS = 50_000
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, record_offset long, digest_ok boolean"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1, in Spark's own expressions."""
    hexa = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexa, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record per row of ``pages`` (page_id, url, html) to WARC files under ``path``.

    Payload: the html in UTF-8, a null is empty. Of equal payloads of at least ``min_revisit_bytes`` bytes
    that with the smallest page_id is a response (rows that repeat it too), the others are revisits, which
    carry the payload's digest and length but not the payload. Control characters and blanks of a url are
    percent-encoded; a null url becomes ``urn:page:<id>``. A null page_id is written as ``null``.
    Spark's text sink writes the bytes, so its committer settles retried tasks.
    """
    url = F.coalesce(F.col("url").cast("string"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    for code in (13, 10, 32, 9):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1("html")).withColumn("size", F.octet_length("html").cast("long"))
    copies = rows.filter(F.col("size") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("digest", "first_id")
    # written, so that its size is known: under Spark's threshold it is broadcast, beyond it pages are shuffled
    copies = Scratch(pages.sparkSession, "warc-copies").save(copies, "copies")
    rows = rows.join(copies, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id")) & (F.col("size") >= min_revisit_bytes)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), page, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Payload-Length: "), F.col("size").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string")), F.lit(END),
    )
    record = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    rows.select(record.alias("value")).write.mode("overwrite").option("lineSep", END).option("compression", "none").text(path)


def _header(block: bytes) -> dict[bytes, bytes]:
    fields = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _candidates(data: bytes, base: int, end: int, more: Callable[[], bytes]) -> list[tuple[int, int]]:
    """(offset, successor) of each likely record header that starts before ``end``.

    A record starts its file or follows the end of another one, so no two headers overlap. ``data`` begins at
    ``base``, up to four bytes before the range; ``more`` returns what comes after it, at the end nothing.
    """
    edge = END.encode()
    found, at = [], data.find(MAGIC)
    while at != -1 and base + at < end:
        if base + at == 0 or data[max(at - 4, 0) : at] == edge:
            stop = data.find(edge, at)
            while stop == -1 and (further := more()):
                seen = len(data)
                data += further
                stop = data.find(edge, max(at, seen - 3))
            size = _header(data[at:stop]).get(b"content-length", b"") if stop != -1 else b""
            if size.isdigit():
                found.append((base + at, base + stop + 4 + int(size) + 4))
        at = data.find(MAGIC, at + 1)
    return found


def scan_candidates(ranges: DataFrame) -> DataFrame:
    """Candidates of each range (path, chunk, lo, hi): offset, successor, and the exit of its chain from the range."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, chunk, lo, hi in frame[["path", "chunk", "lo", "hi"]].itertuples(index=False):
                fs, name = open_uri(path)
                with fs.open_input_file(name) as f:
                    base, step = max(lo - 4, 0), itertools.count()
                    f.seek(base)
                    data = f.read(hi - base + HEADER_BYTES)
                    found = _candidates(data, base, hi, lambda f=f, step=step: f.read(HEADER_BYTES << min(next(step), 8)))
                exits: dict[int, int] = {}
                rows = []
                for offset, succ in reversed(found):
                    exits[offset] = succ if succ >= hi else exits.get(succ, -1)
                    rows.append((path, chunk, offset, succ, exits[offset]))
                yield pd.DataFrame(rows, columns=["path", "chunk", "offset", "succ", "exit"])

    return ranges.mapInPandas(run, "path string, chunk long, offset long, succ long, exit long")


def reachable_entries(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(path, chunk, entry, exit): where the chain from each file's start enters and leaves each range, by pointer jumping."""
    landing = candidates.select("path", F.col("exit").alias("offset")).union(candidates.select("path", F.lit(0).cast("long").alias("offset"))).distinct()
    nodes = scratch.save(candidates.join(landing, ["path", "offset"], "left_semi").select("path", "chunk", "offset", "exit"), "nodes")
    most = nodes.agg(F.max("chunk")).first()[0] or 0
    reached = nodes.filter("offset = 0").select("path", "offset")
    jump = nodes.select("path", "offset", F.col("exit").alias("next"))
    hops, turn = 1, 0
    while hops <= most:
        further = reached.join(jump, ["path", "offset"]).select("path", F.col("next").alias("offset"))
        reached = scratch.save(reached.union(further).distinct(), f"reached{turn}")
        after = jump.select("path", F.col("offset").alias("next"), F.col("next").alias("after"))
        jump = scratch.save(jump.join(after, ["path", "next"]).select("path", "offset", F.col("after").alias("next")), f"jump{turn}")
        hops, turn = 2 * hops, turn + 1
    return nodes.join(reached, ["path", "offset"], "left_semi").select("path", "chunk", F.col("offset").alias("entry"), "exit")


def _page(value: bytes) -> int | None:
    """The page_id of our own record ids; null for those of other writers."""
    found = re.fullmatch(rb"<?urn:page:(-?[0-9]{1,19})>?", value)
    return int(found[1]) if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None


def _read_range(group: pd.DataFrame) -> pd.DataFrame:
    """The records of one range, along the chain from its entry."""
    path, at = group["path"].iloc[0], int(group["entry"].iloc[0])
    succ = dict(zip(group["offset"], group["succ"], strict=True))
    rows = []
    fs, name = open_uri(path)
    with fs.open_input_file(name) as f:
        while at in succ:
            f.seek(at)
            data = f.read(int(succ[at]) - at)
            stop = data.find(b"\r\n\r\n")
            head, payload = _header(data[:stop]), data[stop + 4 : -4]
            named = head.get(b"warc-payload-digest", b"").decode("utf-8", "replace")
            digest = named.removeprefix("sha1:") if named.startswith("sha1:") else None
            kind = head.get(b"warc-type", b"").decode("utf-8", "replace")
            length = head.get(b"warc-payload-length", b"")
            if kind == "revisit":
                own, size = digest, int(length) if length.isdigit() else None
            else:
                own, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
            rows.append((_page(head.get(b"warc-record-id", b"")), size, own, kind, _page(head.get(b"warc-refers-to", b"")), path, at, None if digest is None else own == digest))
            at = int(succ[at])
    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "record_offset", "digest_ok"])
    return out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64", "digest_ok": "boolean"})


def read_warc(spark, path: str, range_bytes: int = 16 << 20) -> DataFrame:
    """The records of the WARC files under ``path`` (columns of RECORDS); payload digests are recomputed.

    Records of other writers come too: with their own type, a null page_id where the record id isn't one of
    ours, a null digest_ok where none or no SHA-1 is named, and for revisits a null payload_bytes where the
    length isn't. A payload is what follows the record's header. Gzipped files are refused.
    Empty files give no row; a chain of records that doesn't end at its file's length is an error.
    """
    scratch = Scratch(spark, "warc-read")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").filter("length > 0")
    if zipped := files.filter("path like '%.gz'").head(1):
        raise ValueError(f"{zipped[0].path} is gzipped; unpack it first")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))).alias("chunk"))
    ranges = ranges.select("path", "chunk", (F.col("chunk") * range_bytes).alias("lo"), F.least("length", (F.col("chunk") + 1) * range_bytes).alias("hi"))
    # ranges are dealt by number: adaptive execution would go by the bytes of their rows, not of what they stand for
    tasks = max(1, min(ranges.count(), MOST_TASKS))
    candidates = scratch.save(scan_candidates(ranges.repartition(tasks, "path", "chunk")), "candidates")
    entries = scratch.save(reachable_entries(candidates, scratch), "entries")
    ended = entries.select("path", F.col("exit").alias("length"))
    if broken := files.select("path", "length").join(ended, ["path", "length"], "left_anti").head(1):
        raise ValueError(f"the records of {broken[0].path} don't end at its length, {broken[0].length} bytes")
    entries = entries.drop("exit")
    return candidates.join(entries, ["path", "chunk"]).repartition(tasks, "path", "chunk").groupBy("path", "chunk").applyInPandas(_read_range, RECORDS)
