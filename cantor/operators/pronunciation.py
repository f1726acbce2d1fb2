"""Pronunciation of texts: tokens, distinct words, plans.

A word's pronunciation depends on the word alone, so words are made distinct before they meet Python and are
joined back after; the join is left to Spark, which broadcasts the dictionary only while it is small.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import latin
from cantor.functions import tables as T
from cantor.functions.udf import arrow_udf


def tokens(docs: DataFrame, key: str, text: str = "text", spans: bool = False) -> DataFrame:
    """A row per word: key, token_index, surface, and code-point start and end if ``spans``."""
    if not spans:
        return docs.select(F.col(key), F.posexplode(C.surfaces(F.col(text))).alias("token_index", "surface"))
    rows = C.word_spans(docs.select(F.col(key), F.col(text).alias("_text"))).select(key, F.posexplode("spans").alias("token_index", "span"))
    return rows.select(key, "token_index", "span.surface", "span.start", "span.end")


def pronounce_words(words: DataFrame, surface: str = "surface") -> DataFrame:
    """The distinct surfaces with all pronunciation fields; words without one carry error_code and error_detail."""
    return spread(words.select(F.col(surface).alias("surface")).filter("surface is not null").distinct()).select(C.pronounce("surface").alias("w")).select("w.*")


def spread(words: DataFrame) -> DataFrame:
    """Words over all cores: few bytes, but much work each, which AQE would pack into few tasks."""
    spark = words.sparkSession
    return words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "surface")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct surfaces with their number of tokens."""
    return docs.select(F.explode(C.surfaces(F.col(text))).alias("surface")).groupBy("surface").agg(F.count("*").alias("n_tokens"))


def pronounced_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word_counts with pronunciation fields, in one pass: counting already makes words distinct."""
    return spread(word_counts(docs, text)).select("n_tokens", C.pronounce("surface").alias("w")).select("n_tokens", "w.*")


def analyze(docs: DataFrame, key: str, text: str = "text", overrides: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Pronunciation plans: a row per document with its tokens, phrase phonemes and warnings.

    A document's plan is made where its text is: workers remember words, and no token is ever shuffled.

    overrides: key, token_index, stress_index, ipa, phonemes. An index without a token is an error of the
    plan. ``strict`` fails the job at the first error instead of returning codes.
    """
    plans = docs.select(key, F.col(text).alias("original_text"))
    if overrides is None:
        plans = plans.withColumn("fixes", F.lit(None).cast(C.FIXES))
    else:
        fixes = overrides.groupBy(key).agg(F.collect_list(F.struct("token_index", "stress_index", "ipa", "phonemes")).cast(C.FIXES).alias("fixes"))
        plans = plans.join(fixes, key, "left")
    plans = C.plan_tokens(plans).withColumnRenamed("unknown", "_unknown").withColumn("normalized_text", C.phrase_form(F.col("original_text")))
    spoken = F.filter(F.transform("tokens", lambda t: F.coalesce(t["phonemes"], F.array().cast("array<string>"))), lambda p: F.size(p) > 0)
    phrase = F.flatten(F.transform(spoken, lambda p, i: F.when(i > 0, F.concat(F.array(F.lit("|")), p)).otherwise(p)))
    warned = F.transform(F.filter("tokens", lambda t: t["needs_review"]), lambda t: F.struct(F.lit("PRONUNCIATION_NEEDS_REVIEW").alias("code"), t["token_index"].alias("token_index"), t["start"].alias("start"), t["end"].alias("end")))
    plans = plans.select(key, F.lit("1").alias("schema_version"), F.lit(T.RULE_VERSION).alias("rule_version"), "original_text", "normalized_text", "tokens", phrase.alias("phrase_phonemes"), warned.alias("warnings"), "_unknown")
    first = F.get(F.filter("tokens", lambda t: t["error_code"].isNotNull()), F.lit(0))["error_code"]
    plans = plans.withColumn("error_code", F.coalesce(F.when(F.col("_unknown"), "OVERRIDE_UNKNOWN_TOKEN"), first)).drop("_unknown")
    if strict:
        plans = plans.withColumn("error_code", F.when(F.col("error_code").isNull(), F.lit(None).cast("string")).otherwise(F.raise_error(F.col("error_code")).cast("string")))
    return plans


def seven_fields(plans: DataFrame, key: str) -> DataFrame:
    """The plan as it is stored: seven fields, tokens of ten, without rules, transforms and overrides."""
    kept = ("surface", "normalized", "start", "end", "syllables", "stress_index", "ipa", "phonemes", "method", "source_ids")
    return plans.select(key, "schema_version", "rule_version", "original_text", "normalized_text", F.transform("tokens", lambda t: F.struct(*[t[c].alias(c) for c in kept])).alias("tokens"), "phrase_phonemes", "warnings")


def review_template(plans: DataFrame, key: str) -> DataFrame:
    """Tokens that a person must look at."""
    return plans.select(key, F.explode(F.filter("tokens", lambda t: t["needs_review"])).alias("t")).select(key, "t.token_index", "t.surface", "t.stress_index", "t.ipa")


def lexicon_frame(spark) -> DataFrame:
    """The stress lexicon as a table (45 rows: broadcast by its size)."""
    rows = [(k, list(s), i, list(src)) for k, (s, i, src) in latin.LEXICON.items()]
    return spark.createDataFrame(rows, "lookup_key string, syllables array<string>, stress_index int, source_ids array<string>")


def unknown_sources(rows: DataFrame, source_ids: str = "source_ids") -> DataFrame:
    """Rows whose sources aren't all registered, with the strangers."""
    strangers = F.array_except(source_ids, F.array(*[F.lit(s) for s in T.SOURCES]))
    return rows.withColumn("unknown_sources", strangers).filter(F.size("unknown_sources") > 0)
