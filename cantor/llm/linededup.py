"""Cross-site boilerplate: lines that stand on many sites are removed.

Each line hash gets a HyperLogLog sketch of its sites; sketches merge in the aggregation, so a line on a
third of all documents is a few bytes from each task. Lines whose estimate is near the threshold get an
exact distinct count, so the decision is that of exact counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.llm import jaccard
from cantor.llm.common import Scratch, fresh

SPACE_CHARS = " \t\x0b\x0c\r"
#: A line on this many distinct sites is boilerplate; one of fewer than MIN_CHARS characters, blanks at the
#: ends aside, that has a blank within needs SHORT_SITES, and a short single word never is.
MIN_CHARS, MIN_SITES, SHORT_SITES = 20, 4, 12
#: 2**LG_K buckets: a relative standard error of about 1.04 / 2**(LG_K / 2).
LG_K = 10
#: A document that loses more than this share of its characters is mostly boilerplate, or a copy.
MOST_LOST = 0.5


def _trimmed(line):
    return F.btrim(line, F.lit(SPACE_CHARS))


def document_lines(docs: DataFrame, site: str, min_chars: int = MIN_CHARS, min_sites: int = MIN_SITES, short_sites: int = SHORT_SITES) -> DataFrame:
    """(key of the text, position, line hash, site, sites needed) of each line that can be boilerplate."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col(site).cast("string").alias("site")).filter("text is not null")
    rows = rows.select(F.xxhash64("text", F.length("text")).alias("key"), "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    need = F.when(F.length("line") >= min_chars, min_sites).when(F.col("line").rlike("[ \t\x0b\x0c\r]"), short_sites)
    return rows.select("key", "pos", "site", _trimmed(F.col("line")).alias("line")).withColumn("need", need).filter("need is not null").select("key", "pos", "site", F.xxhash64("line").alias("hash"), "need")


def boilerplate_lines(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(hash, n_sites) of the lines on at least as many distinct sites as they need; a null site is none."""
    sketches = lines.filter("site is not null").groupBy("hash", "need").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    estimates = sketches.select("hash", "need", F.hll_sketch_estimate("sketch").alias("estimate"))
    margin = 5 * 1.04 / 2 ** (lg_k / 2)
    low, high = F.col("need") * (1 - margin) - 1, F.col("need") * (1 + margin) + 1
    scratch = Scratch(lines.sparkSession, "linededup")
    estimates = scratch.save(estimates.filter((F.col("estimate") >= 2) & (F.col("estimate") >= low)), "estimates")
    near = estimates.filter(F.col("estimate") <= high).select("hash")
    exact = lines.filter("site is not null").select("hash", "need", "site").join(near, "hash", "left_semi").distinct().groupBy("hash", "need").agg(F.count("*").cast("long").alias("n_sites"))
    sure = estimates.filter(F.col("estimate") > high).select("hash", F.col("estimate").cast("long").alias("n_sites"))
    return scratch.save(exact.filter(F.col("n_sites") >= F.col("need")).select("hash", "n_sites").union(sure), "boilerplate")


def copied_texts(texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(key) of the texts (key, doc_id, text) that two documents have, or that are near copies of another one.

    Rows of one doc_id are one document; each row without one is a document.
    """
    scratch = Scratch(texts.sparkSession, "linededup-copies")
    unnamed = F.sum(F.col("doc_id").isNull().cast("long"))
    several = (F.min("doc_id") != F.max("doc_id")) | (unnamed + F.max("doc_id").isNotNull().cast("long") > 1)
    groups = scratch.save(texts.groupBy("key").agg(F.first("text").alias("text"), F.coalesce(several, unnamed > 1).alias("several")), "texts")
    joined = scratch.save(jaccard.ngram_jaccard_join(groups.select(F.col("key").alias("doc_id"), "text"), percent, words), "joined")
    crowds = joined.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1")
    near = joined.join(crowds, "component_id", "left_semi").select(F.col("doc_id").alias("key"))
    return scratch.save(groups.filter("several").select("key").union(near).distinct(), "copies")


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, short_sites: int = SHORT_SITES, near: tuple[int, int] | None = None) -> DataFrame:
    """Columns of ``docs`` with ``text`` cleaned (and n_chars counted anew), n_lines, n_boilerplate, n_removed and mostly_boilerplate.

    Proven lines go from every document. mostly_boilerplate tells that more than MOST_LOST of the characters
    stand in them. With ``near`` (percent, words of a near copy) such a document stays whole if another one
    of them has the same text or a near copy of it: a text on many sites would go from all of them.

    A null text stays null, has no lines and loses none. Every row stays, repeated ones too; columns of
    ``docs`` that are named like the added ones are replaced. The text is shuffled once, by its hash, which
    is unique on the other side; crowds of copies are split by adaptive execution.
    """
    lines = document_lines(docs, site, min_chars, min_sites, short_sites)
    hit = lines.join(boilerplate_lines(lines).select("hash"), "hash", "left_semi")
    key, flags, cleaned, copy = (fresh(docs, x) for x in ("key", "flagged", "clean", "copy"))
    flagged = hit.groupBy(F.col("key").alias(key)).agg(F.collect_set("pos").alias(flags))
    # written, so that the join deals both sides anew and the copies of one text can be split
    flagged = Scratch(docs.sparkSession, "linededup-flagged").save(flagged, "flagged")
    text = F.col("text").cast("string")
    keyed = docs.withColumn(key, F.xxhash64(text, F.length(text)))
    parts = F.split(text, "\n")
    clean = F.when(F.col(flags).isNull(), text).otherwise(F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(flags), i)), "\n"))
    mostly = F.coalesce(F.length(cleaned) < (1 - MOST_LOST) * F.length(text), F.lit(False))
    whole = F.lit(False)
    if near is not None:
        bare = keyed.select(key, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(flagged.hint("merge"), key).withColumn(cleaned, clean)
        losing = Scratch(docs.sparkSession, "linededup-whole").save(bare.filter(mostly).select(F.col(key).alias("key"), "doc_id", "text"), "losing")
        copies = copied_texts(losing, *near).select(F.col("key").alias(key), F.lit(True).alias(copy))
        flagged = Scratch(docs.sparkSession, "linededup-copies").save(flagged.join(copies, key, "left"), "flagged")
        whole = mostly & F.coalesce(copy, F.lit(False))
    rows = keyed.join(flagged.hint("merge"), key, "left").withColumn(cleaned, clean)  # the same plan at every size
    n_hit = F.when(F.col(flags).isNull(), 0).otherwise(F.size(flags)).cast("long")
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = F.when(whole, text).otherwise(F.col(cleaned))
    if "n_chars" in out:
        out["n_chars"] = F.coalesce(F.length(out["text"]), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    out["n_lines"] = F.coalesce(F.size(parts), F.lit(0)).cast("long")
    out["n_boilerplate"] = n_hit
    out["n_removed"] = F.when(whole, F.lit(0)).otherwise(n_hit).cast("long")
    out["mostly_boilerplate"] = mostly
    return rows.select(*(v.alias(k) for k, v in out.items()))
