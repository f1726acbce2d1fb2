"""Further queries of the catalog: segments, journals, reviews and set checks around a corpus."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.operators import corpus, events, intervals, pronunciation, report
from cantor.plans.catalog import _SURFACES, _US, ORACLES, QUERIES, _user_gaps, long, query, table

__all__ = ["ORACLES", "QUERIES"]
SEGMENT_US = 600_000_000


@query(f"""
WITH u AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, trim(unnest(ls), ' ' || chr(9) || chr(11) || chr(12)) AS line, generate_subscripts(ls, 1) AS p FROM u),
o AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS ordinal FROM l WHERE line <> ''),
t AS (SELECT doc_id, ordinal, unnest({_SURFACES.format('line')}) AS s FROM o)
SELECT doc_id, ordinal, count(*) AS n_tokens, count(DISTINCT s) AS n_surfaces FROM t GROUP BY doc_id, ordinal""")
def unit_token_counts(spark, sf_dir):
    """Every document's tokens, each looked up in the unit whose range holds it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text is not null")
    units = corpus.token_ranges(corpus.spoken_units(docs, "doc_id"), "doc_id", "ordinal")
    found = corpus.unit_tokens(units.drop("text"), docs, "doc_id")
    return found.groupBy("doc_id", long(F.col("ordinal")).alias("ordinal")).agg(F.count("*").alias("n_tokens"), F.countDistinct("surface").alias("n_surfaces"))


@query("""
WITH p AS (SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS n FROM part)
SELECT p_partkey, f AS frame, f * 512 AS start, least(n, (f + 1) * 512) AS "end" FROM (SELECT p_partkey, n, unnest(range((n - 1) // 512 + 1)) AS f FROM p WHERE n > 0)""")
def frame_windows(spark, sf_dir):
    """Parts as recordings of as many samples as they cost."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.floor("p_retailprice").cast("long").alias("n"))
    return intervals.frame_grid(parts, "p_partkey", "n")


@query(f"""
WITH t AS (SELECT lang, unnest({_SURFACES.format('text')}) AS surface FROM documents),
e AS (SELECT surface, count(*) AS n FROM t WHERE lang = 'en' GROUP BY 1), f AS (SELECT surface, count(*) AS n FROM t WHERE lang = 'fr' GROUP BY 1)
SELECT surface, e.n - coalesce(f.n, 0) AS n FROM e LEFT JOIN f USING (surface) WHERE e.n > coalesce(f.n, 0)""")
def surplus_words(spark, sf_dir):
    """Words that English documents have more often than French ones: a multiset difference."""
    docs = table(spark, sf_dir, "documents")
    words = lambda lang: pronunciation.tokens(docs.filter(F.col("lang") == lang), "doc_id").select("surface")
    return corpus.multiset_difference(words("en"), words("fr"), "surface")


@query("""
SELECT c_custkey AS custkey, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
UNION ALL SELECT DISTINCT o_custkey, 'right' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def customer_set_differences(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return corpus.set_differences(customers, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


@query(f"""
SELECT user_id AS recording_id, count(*) AS n_overlaps FROM (SELECT user_id, {_US} + {SEGMENT_US} AS e, lead({_US}) OVER (PARTITION BY user_id ORDER BY {_US}, event_id) AS nx FROM events)
WHERE nx < e GROUP BY user_id""")
def segment_overlaps(spark, sf_dir):
    """Events as segments of ten minutes that must not run into each other."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    segments = table(spark, sf_dir, "events").select(F.col("user_id").alias("recording_id"), us.alias("source_start_sample"), (us + SEGMENT_US).alias("source_end_sample"), F.col("event_id").alias("segment_id"))
    return corpus.overlapping_segments(segments).groupBy("recording_id").agg(F.count("*").alias("n_overlaps"))


_STATES = ", ".join(f"'{s}'" for s in corpus.STATES)


def _state_events(spark, sf_dir):
    """A customer's orders as a journal: the n-th order reaches the n-th state; after the last one, it begins anew."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    states = F.array(*[F.lit(s) for s in corpus.STATES])
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", n.alias("n"))
    at = lambda i: F.get(states, F.pmod(i, F.lit(len(corpus.STATES))))
    return rows.select(
        F.col("o_custkey").cast("string").alias("recording_id"), F.col("o_orderkey").alias("seq"), F.col("o_orderkey").cast("string").alias("event_id"),
        at(F.col("n")).alias("previous_state"), at(F.col("n") + 1).alias("target_state"), F.array("o_orderstatus").alias("input_sha256s"), F.lit("c").alias("config_sha256"), F.lit("t").alias("tool_versions"),
    )


_STATE_EVENTS = f"""
s AS (SELECT [{_STATES}] AS names),
n AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders),
j AS (SELECT o_custkey, o_orderkey, o_orderstatus, names[n % 10 + 1] AS p, names[(n + 1) % 10 + 1] AS t FROM n, s),
legal(p, t) AS (SELECT names[i], names[i + 1] FROM s, range(1, 8) r(i) UNION ALL VALUES ('REVIEWED', 'APPROVED'), ('REVIEWED', 'REJECTED'))"""


@query(f"""
WITH {_STATE_EVENTS},
c AS (SELECT *, lag(t) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS last FROM j)
SELECT 'ILLEGAL_TRANSITION' AS problem, count(*) AS n FROM j WHERE (p, t) NOT IN (SELECT (p, t) FROM legal) HAVING count(*) > 0
UNION ALL SELECT 'BROKEN_CHAIN', count(*) FROM c WHERE last <> p HAVING count(*) > 0
UNION ALL SELECT 'DUPLICATE_SEMANTICS', count(*) FROM (SELECT 1 FROM j GROUP BY o_custkey, p, t, o_orderstatus HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'DUPLICATE_EVENT_ID', count(*) FROM (SELECT 1 FROM j GROUP BY o_orderkey HAVING count(*) > 1) HAVING count(*) > 0""")
def journal_audit(spark, sf_dir):
    return events.journal_problems(_state_events(spark, sf_dir)).groupBy("problem").agg(F.count("*").alias("n"))


@query(f"""
WITH {_STATE_EVENTS}
SELECT CASE WHEN o_orderstatus <> 'F' THEN 'new' ELSE 'exists' END AS status, count(*) AS n FROM j GROUP BY 1""")
def event_existence(spark, sf_dir):
    """All events proposed to a journal that has those of finished orders, which differ by their inputs."""
    rows = _state_events(spark, sf_dir).dropDuplicates(["event_id"])
    journal = rows.filter(F.get("input_sha256s", F.lit(0)) == "F")
    found = events.event_existence(journal, rows)
    return found.groupBy("status").agg(F.count("*").alias("n"))


@query(f"""
WITH {_STATE_EVENTS}, m AS (SELECT o_custkey, p, t FROM j QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT CAST(m.o_custkey AS VARCHAR) AS recording_id, CASE WHEN l.t IS NULL THEN m.p ELSE m.t END AS state, CASE WHEN l.t IS NULL THEN 'ILLEGAL_TRANSITION' END AS issue
FROM m LEFT JOIN legal l ON l.p = m.p AND l.t = m.t""")
def advanced_states(spark, sf_dir):
    """Each customer's last step, taken where it exists."""
    last = _state_events(spark, sf_dir).groupBy("recording_id").agg(F.max_by(F.struct("previous_state", "target_state"), "seq").alias("e")).select("recording_id", "e.*")
    found = events.advance(last.select("recording_id", F.col("previous_state").alias("state")), last)
    return found.select("recording_id", "state", "issue")


@query("SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'A') THEN 'APPROVED' WHEN bool_and(l_returnflag = 'R') THEN 'REJECTED' END AS state FROM lineitem GROUP BY l_orderkey")
def order_decisions(spark, sf_dir):
    """Line items as takes: A approved, R rejected, N unreviewed."""
    flag = F.col("l_returnflag")
    takes = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(flag == "A", "approved").when(flag == "R", "rejected").otherwise("unreviewed").alias("decision"))
    return events.entity_state(takes, "l_orderkey")


@query("""
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS reason FROM events GROUP BY user_id)
SELECT reason, count(*) AS n FROM l WHERE reason <> 'purchase' GROUP BY reason""")
def last_rejection_reasons(spark, sf_dir):
    """Events as decisions: a purchase approves, all else rejects and is its own reason."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.lit("review_decision").alias("field"), F.when(kind == "purchase", "approved").otherwise("rejected").alias("after"), kind.alias("reason"), F.struct("ts", "event_id").alias("seq"))
    return report.rejection_reasons(rows)


@query("""
WITH v AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS before, arg_max(event_type, (ts, event_id)) AS after FROM events GROUP BY user_id)
SELECT user_id, 'event_type' AS field, before, after FROM v WHERE before <> after""")
def target_changes(spark, sf_dir):
    """The changes that lead from each user's first event type to the last."""
    order = F.struct("ts", "event_id")
    both = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", order).alias("a"), F.max_by("event_type", order).alias("b"))
    side = lambda c: both.select("user_id", F.lit("event_type").alias("field"), F.col(c).alias("value"))
    return events.target_events(side("a"), side("b"), ["user_id"])


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, 'o' || l_orderkey AS r, printf('o%d-unit-%04d', l_orderkey, l_linenumber) AS u, l_extendedprice, l_quantity, l_discount FROM lineitem)
SELECT l_orderkey, l_linenumber, u AS unit_id, u AS group_id, 'segment-' || left(sha256(r || chr(0) || u || chr(0) || CAST(l_linenumber AS VARCHAR)), 24) AS segment_id,
  'review:' || length(r) || ':' || r || ':' || length(u) || ':' || u || ':take:' || l_linenumber AS entity_id,
  CAST(round_even(l_quantity / 4 * 2, 0) AS BIGINT) AS position, round(least(1.0, CASE WHEN l_discount - 0.05 < 0 THEN exp(l_discount - 0.05) ELSE l_discount - 0.05 END), 9) AS probability
FROM k""")
def line_ids(spark, sf_dir):
    """Content-addressed ids, half-even sample positions and clamped scores of line items as takes."""
    recording = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
    unit = C.unit_id(recording, F.col("l_linenumber"))
    group = C.group_id(recording, unit)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", unit.alias("unit_id"), group.alias("group_id"), C.segment_id(recording, group, F.col("l_linenumber")).alias("segment_id"), C.review_entity_id(recording, group, F.col("l_linenumber")).alias("entity_id"),
        C.sample_position(F.col("l_quantity") / 4, F.lit(2)).alias("position"), F.round(C.probability(F.col("l_discount") - 0.05), 9).alias("probability"),
    )


@query("""
SELECT page_id, sha256(replace(replace(replace(html, '\\', '\\\\'), '|', '\\|'), chr(10), ' ')) AS markdown_sha,
  sha256(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS html_sha FROM pages""")
def escaped_pages(spark, sf_dir):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return table(spark, sf_dir, "pages").select("page_id", sha(C.markdown_cell(F.col("html"))).alias("markdown_sha"), sha(C.html_escape(F.col("html"))).alias("html_sha"))


@query("""
WITH w AS (SELECT l_orderkey, l_linenumber, row_number() OVER k AS n, lag(l_linenumber + l_quantity / 25) OVER k AS before, lower(l_returnflag) AS a, lower(l_linestatus) AS b,
    12 * l_discount AS score, l_linenumber AS s, l_linenumber + l_quantity / 25 AS e FROM lineitem WINDOW k AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linenumber + l_quantity / 25, l_returnflag, CASE WHEN l_returnflag = 'N' AND l_linestatus <> 'O' THEN 'x' ELSE l_returnflag END, 12 * l_discount)),
p AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> n THEN 'TOKEN_ORDER' WHEN a = 'n' AND b <> 'o' THEN 'TOKEN_TEXT' WHEN score < 0 OR score > 1 THEN 'SCORE_RANGE' WHEN NOT (s >= 0 AND e > s AND e <= 7) THEN 'TIME_RANGE' WHEN before > s THEN 'OVERLAP' END AS problem FROM w)
SELECT l_orderkey, l_linenumber, problem FROM p WHERE problem IS NOT NULL""")
def alignment_audit(spark, sf_dir):
    """Line items as aligned words: a word's text is its flag, but N that is not open is another word."""
    text = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") != "O"), "x").otherwise(F.col("l_returnflag"))
    words = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("cache_key"), (F.col("l_linenumber") - 1).alias("spoken_token_index"), F.col("l_returnflag").alias("token"), text.alias("text"), (12 * F.col("l_discount")).alias("score"),
        F.col("l_linenumber").cast("double").alias("start_seconds"), (F.col("l_linenumber") + F.col("l_quantity") / 25).alias("end_seconds"), F.lit(7.0).alias("duration"),
    )
    return corpus.alignment_problems(words).select(F.col("cache_key").alias("l_orderkey"), (F.col("spoken_token_index") + 1).alias("l_linenumber"), "problem")


@query(f"""
WITH g AS (SELECT user_id, nx - s - 1000 AS gap FROM (SELECT user_id, {_US} AS s, lead({_US}) OVER (PARTITION BY user_id ORDER BY {_US}) AS nx FROM events) WHERE nx - s - 1000 >= 60000000)
SELECT user_id, count(*) AS n FROM g WHERE gap < 3600000000 GROUP BY user_id""")
def foreign_pauses(spark, sf_dir):
    """Pauses that aren't among the gaps of an hour or more."""
    pauses = _user_gaps(spark, sf_dir)
    found = corpus.foreign_pauses(pauses, pauses.filter(F.col("end") - F.col("start") >= 3_600_000_000), "user_id")
    return found.groupBy("user_id").agg(F.count("*").alias("n"))
