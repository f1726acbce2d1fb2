"""Every query of the engine by name, with the SQL that checks it where SQL can say it.

The driver's tables stand in for a corpus: documents and turns are texts, events of a user are intervals,
journals or reviews, labels are gold rows, line items are review time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import latin
from cantor.functions import tables as T
from cantor.operators import corpus, events, intervals, pronunciation, report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
GAP_MS = 60_000


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(x):
    return x.cast("long")


_SURFACES = r"regexp_extract_all({0}, '\p{{L}}[\p{{L}}\p{{M}}]*')"


@query(f"SELECT lang, count(*) AS n_tokens, count(DISTINCT s) AS n_surfaces FROM (SELECT lang, unnest({_SURFACES.format('text')}) AS s FROM documents) GROUP BY lang")
def token_counts_by_lang(spark, sf_dir):
    """Two-level: distinct surfaces carry their counts, so the second aggregation is over words, not tokens."""
    words = table(spark, sf_dir, "documents").select("lang", F.explode(C.surfaces(F.col("text"))).alias("s")).groupBy("lang", "s").agg(F.count("*").alias("n"))
    return words.groupBy("lang").agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_surfaces"))


#: A word in lower case, and its key: without acutes, j and v as i and u.
_FOLDED = "replace(lower(s), 'ß', 'ss')"
_KEY = "replace(replace(translate({0}, 'áéíóúý', 'aeiouy'), 'j', 'i'), 'v', 'u')"


@query(f"""
WITH w AS (SELECT lower(s) AS s, count(*) AS n FROM (SELECT unnest({_SURFACES.format('text')}) AS s FROM documents) GROUP BY 1)
SELECT {_KEY.format(_FOLDED)} AS lookup_key, count(*) AS n_surfaces, CAST(sum(n) AS BIGINT) AS n_tokens FROM w GROUP BY 1""")
def lookup_variants(spark, sf_dir):
    words = pronunciation.word_counts(table(spark, sf_dir, "documents"))
    keys = words.select(C.lookup_keys("surface").alias("lookup_key"), F.lower("surface").alias("s"), "n_tokens")
    return keys.groupBy("lookup_key").agg(F.countDistinct("s").alias("n_surfaces"), F.sum("n_tokens").alias("n_tokens"))


_VALUES = ", ".join(f"('{k}', {len(v[0])})" for k, v in latin.LEXICON.items())
_ONSETS = ", ".join(f"'{x}'" for x in sorted(T.ONSETS))
#: Independent of the kernel: vowel groups as capital letters (W glide, J consonantal i, D diphthong; vowels with a
#: diaeresis, which are in no diphthong and no glide, as capitals of their own).
STRESS_SQL = f"""
WITH lex(k, n) AS (VALUES {_VALUES}),
t AS (SELECT s, count(*) AS c FROM (SELECT lower(unnest({_SURFACES.format('text')})) AS s FROM documents) GROUP BY 1),
w AS (SELECT translate({_FOLDED}, 'áéíóúýàèìòùâêîôûäëïöüÿ', 'aeiouyaeiouaeiouAEIOUY') AS s, c, {_KEY.format(_FOLDED)} AS k, regexp_matches(s, '[áéíóúý]') AS marked FROM t),
a AS (SELECT s, c, k, marked, regexp_replace(regexp_replace(s, '(q|ng)u([aeiouyAEIOUY])', '\\1W\\2', 'g'), '(q|ng)u([aeiouyAEIOUY])', '\\1W\\2', 'g') AS g FROM w),
b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(g, '(^|[aeiouyAEIOUYJ])i([aeiouyAEIOUYJ])', '\\1J\\2', 'g'), '(^|[aeiouyAEIOUYJ])i([aeiouyAEIOUYJ])', '\\1J\\2', 'g'), '(^|[aeiouyAEIOUYJ])i([aeiouyAEIOUYJ])', '\\1J\\2', 'g') AS j FROM a),
d AS (SELECT *, regexp_replace(j, 'ae|oe|au|eu|ay', 'D', 'g') AS v FROM b),
e AS (SELECT *, CASE WHEN s = 'hei' THEN 1 ELSE length(regexp_replace(v, '[^aeiouyAEIOUYD]', '', 'g')) END AS n,
        regexp_extract(v, '([aeiouyAEIOUYD])([^aeiouyAEIOUYD]*)[aeiouyAEIOUYD][^aeiouyAEIOUYD]*$', 1) AS pen, regexp_replace(regexp_replace(regexp_extract(v, '([aeiouyAEIOUYD])([^aeiouyAEIOUYD]*)[aeiouyAEIOUYD][^aeiouyAEIOUYD]*$', 2), 'W', 'u', 'g'), 'J', 'i', 'g') AS cl FROM d),
f AS (SELECT e.*, l.n AS ln, EXISTS (SELECT 1 FROM lex b WHERE e.k IN (b.k || 'que', b.k || 'ne', b.k || 've')) AS enc FROM e LEFT JOIN lex l USING (k)),
r AS (SELECT *, CASE WHEN n = 0 THEN 'NO_VOWEL_NUCLEUS' WHEN NOT marked AND ln IS NOT NULL AND ln <> n THEN 'LEXICON_SYLLABLE_MISMATCH' WHEN k NOT IN ('hei', 'mihi', 'nihil', 'nihildum') AND contains(s, 'w') THEN 'UNSUPPORTED_GRAPHEME' END AS err,
        pen = 'D' OR regexp_matches(CASE WHEN right(cl, 2) IN ({_ONSETS}) THEN left(cl, length(cl) - 2) WHEN cl = '' THEN '' ELSE left(cl, length(cl) - 1) END, '[^aeiouyAEIOUY]$') AS heavy FROM f)
SELECT CASE WHEN err IS NOT NULL THEN NULL WHEN marked THEN 'override' WHEN k IN ('hei', 'mihi', 'nihil', 'nihildum') THEN 'exception' WHEN ln IS NOT NULL THEN 'lexicon' WHEN (enc AND n >= 2) OR n <= 2 OR heavy THEN 'rule' ELSE 'candidate' END AS method,
       err AS error_code, count(*) AS n_words, CAST(sum(c) AS BIGINT) AS n_tokens
FROM r GROUP BY 1, 2"""


def _words(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.explode(C.surfaces(F.col("text"))).alias("s"))
    words = rows.groupBy(F.lower("s").alias("surface")).agg(F.count("*").alias("n_tokens"))
    return pronunciation.spread(words).select("n_tokens", C.pronounce("surface").alias("w")).select("n_tokens", "w.*")


@query(STRESS_SQL)
def stress_method_hist(spark, sf_dir):
    """The flagship: words are made distinct before Python sees them."""
    return _words(spark, sf_dir).groupBy("method", "error_code").agg(F.count("*").alias("n_words"), F.sum("n_tokens").alias("n_tokens"))


@query()
def phoneme_hist(spark, sf_dir):
    words = pronunciation.pronounced_counts(table(spark, sf_dir, "documents")).filter("error_code is null")
    return words.select(F.explode("phonemes").alias("phoneme"), "n_tokens").filter(~F.col("phoneme").isin("ˈ", ".")).groupBy("phoneme").agg(F.sum("n_tokens").alias("n"))


@query()
def token_provenance(spark, sf_dir):
    words = pronunciation.pronounced_counts(table(spark, sf_dir, "documents")).filter("error_code is null")
    return words.select(F.explode("rule_ids").alias("rule_id"), "n_tokens").groupBy("rule_id").agg(F.sum("n_tokens").alias("n_tokens"))


@query()
def ipa_words(spark, sf_dir):
    words = pronunciation.pronounced_counts(table(spark, sf_dir, "documents"))
    return words.select("surface", "n_tokens", "normalized", "lookup_key", F.array_join("syllables", "-").alias("syllables"), "stress_index", "ipa", F.array_join("phonemes", " ").alias("phonemes"), "method", "error_code")


@query()
def turn_plans(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("unit", F.concat_ws(":", "conv_id", "turn"))
    plans = pronunciation.analyze(turns, "unit")
    return plans.select("unit", "normalized_text", long(F.size("tokens")).alias("n_tokens"), F.array_join("phrase_phonemes", " ").alias("phonemes"), long(F.size("warnings")).alias("n_warnings"), "error_code")


_RANGES = f"SELECT conv_id, turn, printf('%d-unit-%04d', conv_id, turn) AS unit_id, n, CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS token_end FROM (SELECT conv_id, turn, len({_SURFACES.format('text')}) AS n FROM conversations WHERE text IS NOT NULL)"


def _ranges(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter("text is not null")
    ranged = corpus.token_ranges(turns, "conv_id", "turn")
    return ranged.select("conv_id", "turn", F.format_string("%d-unit-%04d", "conv_id", "turn").alias("unit_id"), "token_start", "token_end")


@query(f"SELECT conv_id, turn, unit_id, token_end - n AS token_start, token_end FROM ({_RANGES})")
def turn_token_ranges(spark, sf_dir):
    return _ranges(spark, sf_dir)


@query("SELECT conv_id, count(*) AS n_bad FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p, len(regexp_extract_all(text, '\\p{L}[\\p{L}\\p{M}]*')) AS n FROM conversations WHERE text IS NOT NULL) WHERE n = 0 OR turn <> coalesce(p, -1) + 1 GROUP BY conv_id".replace("turn <> coalesce(p, -1) + 1", "turn <> rn - 1").replace("lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p", "row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn"))
def turn_range_violations(spark, sf_dir):
    bad = intervals.contiguity_violations(_ranges(spark, sf_dir).withColumn("ordinal", F.col("turn") + 1), "conv_id")
    return bad.groupBy("conv_id").agg(F.count("*").alias("n_bad"))


@query("""
WITH d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS lo, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS hi, median(n_chars) OVER (PARTITION BY source) AS m, count(*) OVER (PARTITION BY source) AS n FROM documents),
mid AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(n_chars - m), n_chars, doc_id) AS r FROM d WHERE lo > 1 AND hi > 1)
SELECT source, 'short' AS slot, doc_id, n_chars FROM d WHERE lo = 1 AND n >= 2 UNION ALL SELECT source, 'long', doc_id, n_chars FROM d WHERE hi = 1 AND n >= 2 UNION ALL SELECT source, 'middle', doc_id, n_chars FROM mid WHERE r = 1""")
def pilot_documents(spark, sf_dir):
    picked = corpus.select_pilot(table(spark, sf_dir, "documents"), ["source"], "doc_id", "n_chars")
    return picked.select("source", "slot", "doc_id", "n_chars")


_US = "epoch_us(ts)"


def _speech(spark, sf_dir):
    """Events are instants: speech of a millisecond each, in microseconds; those within one are merged away."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("user_id", us.alias("start"), (us + 1000).alias("end"), "event_id")


_GAPS = f"SELECT user_id, s + 1000 AS start_us, nx AS end_us, nx - s - 1000 AS gap_us FROM (SELECT user_id, {_US} AS s, lead({_US}) OVER (PARTITION BY user_id ORDER BY {_US}) AS nx FROM events) WHERE nx - s - 1000 > 0 AND (nx - s - 1000) * 1000 >= {GAP_MS * 1_000_000}"


def _user_gaps(spark, sf_dir):
    return intervals.gaps(_speech(spark, sf_dir), "user_id", GAP_MS, 1_000_000)


@query(_GAPS)
def user_gaps(spark, sf_dir):
    return _user_gaps(spark, sf_dir).select("user_id", F.col("start").alias("start_us"), F.col("end").alias("end_us"), (F.col("end") - F.col("start")).alias("gap_us"))


@query(f"SELECT user_id, count(*) AS n_overlaps FROM (SELECT user_id, {_US} AS s, lag({_US}) OVER (PARTITION BY user_id ORDER BY {_US}) AS p FROM events) WHERE p + 1000 > s GROUP BY user_id")
def user_overlaps(spark, sf_dir):
    return intervals.order_violations(_speech(spark, sf_dir), "user_id").groupBy("user_id").agg(F.count("*").alias("n_overlaps"))


@query()
def pause_status(spark, sf_dir):
    rows = intervals.classify_pauses(_user_gaps(spark, sf_dir), "user_id", 1_000_000)
    return rows.groupBy("user_id").agg(F.first("status").alias("status"), F.sum((F.col("kind") == "short").cast("long")).alias("n_short"), F.sum((F.col("kind") == "long").cast("long")).alias("n_long"), F.round(F.first("threshold_s"), 6).alias("threshold_s"))


_LONG = 43_200_000_000


@query(f"""
WITH g AS ({_GAPS}), k AS (SELECT *, gap_us >= {_LONG} AS is_long, CAST(sum(CASE WHEN gap_us >= {_LONG} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS BIGINT) + 1 AS w FROM g),
b AS (SELECT user_id, min({_US}) AS f, max({_US}) + 1000 AS l FROM events GROUP BY user_id),
e AS (SELECT user_id, 1 AS w, f AS a FROM b UNION ALL SELECT user_id, w, start_us + (end_us - start_us) // 2 FROM k WHERE is_long),
x AS (SELECT user_id, w, a, lead(a) OVER (PARTITION BY user_id ORDER BY w) AS z FROM e),
y AS (SELECT x.user_id, x.w, x.a, coalesce(x.z, b.l) AS z FROM x JOIN b USING (user_id))
SELECT y.user_id, CAST(y.w AS BIGINT) AS window_no, y.a AS start_us, y.z AS end_us, count(k.w) AS n_short, min(k.start_us + (k.end_us - k.start_us) // 2) AS first_mid_us
FROM y LEFT JOIN k ON k.user_id = y.user_id AND NOT k.is_long AND y.a <= k.start_us AND k.end_us <= y.z GROUP BY ALL""")
def window_short_pauses(spark, sf_dir):
    """Windows between long pauses (half a day), with the pauses inside: an equi-join on the window's number."""
    pauses = _user_gaps(spark, sf_dir).withColumn("kind", F.when(F.col("end") - F.col("start") >= _LONG, "long").otherwise("short"))
    w = Window.partitionBy("user_id").orderBy("start", "end")
    n = pauses.filter("kind = 'long'").select("user_id", (F.row_number().over(w) + 1).alias("ordinal")).unionByName(_speech(spark, sf_dir).select("user_id").distinct().withColumn("ordinal", F.lit(1)))
    units = n.withColumn("unit_id", F.lit("u")).withColumn("text", F.lit(""))
    rows = intervals.unit_windows(_speech(spark, sf_dir), pauses, units, "user_id")
    first = F.array_min(F.transform("short_pauses", lambda p: C.midpoint(p["start"], p["end"])))
    return rows.select("user_id", long(F.col("ordinal")).alias("window_no"), F.col("start").alias("start_us"), F.col("end").alias("end_us"), long(F.size("short_pauses")).alias("n_short"), first.alias("first_mid_us"))


def _journal(spark, sf_dir):
    """A user's events as a journal: each claims to follow the event type of two events before."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.struct("ts", "event_id").alias("seq"), F.lag("event_type", 2).over(w).alias("previous_state"), F.col("event_type").alias("target_state"))


@query("""
WITH j AS (SELECT user_id, event_id, event_type, lag(event_type, 2) OVER w AS prev, lag(event_type) OVER w AS last FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(*) AS n_events, count(*) FILTER (WHERE last IS NOT NULL AND last IS DISTINCT FROM prev) AS n_breaks FROM j GROUP BY user_id""")
def chain_breaks(spark, sf_dir):
    journal = _journal(spark, sf_dir)
    broken = events.chain_breaks(journal, "user_id").groupBy("user_id").agg(F.count("*").alias("n_breaks"))
    return journal.groupBy("user_id").agg(F.count("*").alias("n_events")).join(broken, "user_id", "left").select("user_id", "n_events", F.coalesce("n_breaks", F.lit(0)).alias("n_breaks"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS final_type, round(arg_max(value, (ts, event_id)), 6) AS final_value, count(*) AS n_changes FROM events GROUP BY user_id")
def replay_final_value(spark, sf_dir):
    order = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", order).alias("final_type"), F.round(F.max_by("value", order), 6).alias("final_value"), F.count("*").alias("n_changes"))


@query("""
WITH j AS (SELECT user_id, event_id, ts, event_type AS after, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, arg_max(after, (ts, event_id)) AS value, count(*) AS n_events, bool_and(CASE WHEN n = 1 THEN after <> 'start' ELSE before IS DISTINCT FROM after END) AS valid FROM j GROUP BY user_id""")
def replay_compare_and_set(spark, sf_dir):
    """Events as changes of one field that starts as 'start'; one that changes nothing is no valid event."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", F.lit("type").alias("field"), F.coalesce(F.lag("event_type").over(w), F.lit("start")).alias("before"), F.col("event_type").alias("after"), F.struct("ts", "event_id").alias("seq"))
    automatic = rows.select("user_id", "field").distinct().withColumn("value", F.lit("start"))
    return events.replay(automatic, rows, ["user_id"]).select("user_id", "value", "n_events", "valid")


_MINIMUMS = {"en": 100, "fr": 100, "de": 40, "es": 1000, "la": 1}


@query("""
WITH g AS (SELECT d.lang, count(*) AS n FROM labels l JOIN documents d USING (doc_id) WHERE l.quality = 1 GROUP BY d.lang),
p(category, minimum) AS (VALUES ('en', 100), ('fr', 100), ('de', 40), ('es', 1000), ('la', 1))
SELECT 'CATEGORY_MINIMUM_NOT_MET' AS code, p.category || ': ' || coalesce(g.n, 0) || ' < ' || p.minimum AS detail FROM p LEFT JOIN g ON g.lang = p.category WHERE coalesce(g.n, 0) < p.minimum
UNION ALL SELECT 'TOTAL_MINIMUM_NOT_MET', CAST(n AS VARCHAR) FROM (SELECT count(*) AS n FROM labels) WHERE n < 100000""")
def label_audit(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    rows = labels.filter("quality = 1").join(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("category")), "doc_id")
    return report.policy_errors(rows.groupBy("category").agg(F.count("*").alias("n")), labels.agg(F.count("*").alias("n")), _MINIMUMS, 100_000)


@query("""
WITH t AS (SELECT l_returnflag, CASE l_returnflag WHEN 'R' THEN 'rejected' ELSE 'approved' END AS decision, l_quantity AS s FROM lineitem),
a AS (SELECT sum(CASE WHEN decision = 'approved' THEN s ELSE 0 END) AS ap, sum(s) AS al FROM t), o AS (SELECT sum(o_totalprice) AS inp FROM orders)
SELECT round(ap / al, 6) AS approved_ratio, round(al / inp, 6) AS review_ratio,
  CASE WHEN ap / al < 0.60 OR al / inp > 6.0 THEN 'not_ready' WHEN ap / al >= 0.80 AND al / inp <= 3.0 THEN 'scalable' ELSE 'optimize' END AS verdict FROM a, o""")
def kpi_report(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem").agg(F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0)).alias("ap"), F.sum("l_quantity").alias("al"))
    one = item.crossJoin(table(spark, sf_dir, "orders").agg(F.sum("o_totalprice").alias("inp")))  # one row each
    approved, review = F.col("ap") / F.col("al"), F.col("al") / F.col("inp")
    return one.select(F.round(approved, 6).alias("approved_ratio"), F.round(review, 6).alias("review_ratio"), report.readiness(F.lit(1.0), F.lit(1.0), review, approved).alias("verdict"))


@query("SELECT doc_id, sha256(text) AS text_sha, 'text-' || left(sha256(source || chr(0) || lang || chr(0) || sha256(text)), 16) AS candidate_id FROM documents WHERE text IS NOT NULL")
def content_ids(spark, sf_dir):
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", sha.alias("text_sha"), C.candidate_id(F.col("source"), F.col("lang"), sha).alias("candidate_id"))


@query(r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS p FROM pages)
SELECT page_id, length(p) > 0 AND NOT contains(p, '\') AND NOT list_has_any(string_split(p, '/'), ['', '.', '..']) AND NOT regexp_matches(p, '^[A-Za-z]:') AS canonical,
  regexp_full_match(string_split(p, '/')[1], '[A-Za-z0-9._-]+') AND string_split(p, '/')[1] NOT IN ('.', '..') AS safe_host FROM p""")
def url_paths(spark, sf_dir):
    path = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select("page_id", C.is_canonical_path(path).alias("canonical"), C.is_safe_component(F.get(F.split(path, "/"), F.lit(0))).alias("safe_host"))


@query("SELECT d.doc_id, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) WHERE l.doc_id IS NULL")
def unlabelled_documents(spark, sf_dir):
    """Misses of a cache keyed by document."""
    return corpus.cache_misses(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id").withColumn("labelled", F.lit(False))


@query("SELECT text AS text_key, count(*) AS n FROM (SELECT sha256(text) AS text FROM documents WHERE text IS NOT NULL) GROUP BY text HAVING count(*) > 1")
def repeated_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").filter("text is not null").select(F.sha2(F.col("text").cast("binary"), 256).alias("text_key"))
    return corpus.duplicates(rows, "text_key")


@query(r"""
WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS ls FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, trim(unnest(ls), ' ' || chr(9) || chr(11) || chr(12)) AS t, generate_subscripts(ls, 1) AS p FROM l)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS ordinal, sha256(t) AS text_sha FROM u WHERE t <> ''""")
def document_units(spark, sf_dir):
    units = corpus.spoken_units(table(spark, sf_dir, "documents"), "doc_id")
    return units.select("doc_id", long(F.col("ordinal")).alias("ordinal"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"))


@query()
def turn_differences(spark, sf_dir):
    """Word differences between the first two turns of each conversation."""
    turns = table(spark, sf_dir, "conversations")
    pairs = turns.filter("turn = 0").select("conv_id", F.col("text").alias("a")).join(turns.filter("turn = 1").select("conv_id", F.col("text").alias("b")), "conv_id")
    return pairs.select("conv_id", long(F.size(C.word_differences("a", "b"))).alias("n_differences"))


@query("""
WITH e AS (SELECT l_orderkey, CAST(l_linenumber * 12 AS BIGINT) AS split, least(l_quantity / 50, 1 - l_discount) AS score, 1 - l_tax AS cover, l_returnflag <> 'R' AS ok FROM lineitem),
n AS (SELECT DISTINCT l_orderkey FROM e),
r AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS ns, lead(cover) OVER w AS nc FROM e WHERE ok WINDOW w AS (PARTITION BY l_orderkey ORDER BY score DESC, cover DESC, split)),
x AS (SELECT o_orderkey AS l_orderkey, r.split, r.score, CASE WHEN n.l_orderkey IS NULL THEN 'TAKE_COUNT_MISMATCH' WHEN r.split IS NULL THEN 'TAKE_TEXT_MISMATCH'
    WHEN ns IS NOT NULL AND ((score = ns AND cover = nc) OR score - ns < 0.02) THEN 'TAKE_COUNT_MISMATCH' WHEN NOT r.split / (100 - r.split) BETWEEN 0.65 AND 1.35 THEN 'TAKE_DURATION_MISMATCH' ELSE 'selected' END AS outcome
  FROM orders LEFT JOIN n ON n.l_orderkey = o_orderkey LEFT JOIN r ON r.l_orderkey = o_orderkey AND r.n = 1)
SELECT l_orderkey, outcome, CASE WHEN outcome = 'selected' THEN split END AS split, round(score, 6) AS score FROM x""")
def choose_turn_split(spark, sf_dir):
    """Each order's lines as candidate splits of its window of 100 units."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 12).cast("long").alias("split"), (F.col("l_quantity") / 50).alias("first_score"), (1 - F.col("l_discount")).alias("second_score"), (F.col("l_returnflag") != "R").alias("word_order_same"), (1 - F.col("l_tax")).alias("coverage"))
    windows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).cast("long").alias("start"), F.lit(100).cast("long").alias("end"))
    return intervals.choose_split(windows, lines, ["l_orderkey"]).select("l_orderkey", "outcome", "split", F.round("score", 6).alias("score"))
