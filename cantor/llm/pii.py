"""Personal data by fixed forms and by bootstrapped contextual extraction, in DataFrame functions only.

Base entities (email, ip, card, phone) are found by their forms. Entities and other seed values induce lexical
patterns: the key and separator that they follow (``token = "..."``), and the one to three words before and
the one or two words behind them in their line (``passport number``). The graph of patterns and the values
they stand with is scored in rounds: a pattern by the mean confidence of its values, a value by the noisy-or
of its patterns. Patterns of high confidence then yield identifiers of unseen forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantor.llm.common import Scratch

#: Forms of the base kinds. Possessive and anchored so that long runs are read once; same matches as the
#: plain forms: a run of local-part characters or digits matches from its start, or where a match has ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
#: Runs of at least 16 digits, from their start: shorter ones are never cards.
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?+){15}[0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
_BYTE = r"(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?))"
#: A key, a separator and a value of any length, to its last letter or digit; seed values besides base entities; what an identifier looks like.
_KEY = r"[A-Za-z][A-Za-z_-]++[ \t]*+[=:#]"
KEYED = rf"(?<![A-Za-z_-]){_KEY}[ \t]*+[\"']?[A-Za-z0-9@._+-]{{3,}}[A-Za-z0-9]"
SEED = r"^[0-9a-f]{32,64}$"
IDENTIFIER = r"^(?=.*[0-9])[A-Za-z0-9@._+-]{6,}$"
#: What may have a context of words: phones, cards, and words of at least six of a value's characters with a digit or @.
CANDIDATE = rf"{PHONE}|{CARD}|(?<![A-Za-z0-9@._+-])(?=[A-Za-z._+-]*+[0-9@])[A-Za-z0-9@._+-]{{5,}}[A-Za-z0-9]"
#: Characters within which the words of a context stand, words before and behind.
CONTEXT_CHARS, BEFORE, BEHIND = 64, 3, 2
KIND = "ident"
ROUNDS, MIN_CONFIDENCE, MIN_SUPPORT = 3, 0.5, 3
#: Patterns of words need more, and their beliefs must make up a share of all occurrences of their rarest word: that
#: identifiers follow "the" is no sign, that they follow "passport" is.
WORDS_CONFIDENCE, WORDS_SUPPORT, WORDS_SHARE = 0.8, 5, 0.1
WORD = r"\p{L}+"
_SPAN = "array<struct<start:long,end:long,hit:string,before:string,behind:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, wherever in it, and in which lambdas, it stands."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, form: str, needed: str | None = None, context: bool = False) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit, before, behind), in code points.

    The text between matches and the matches, in turn, make up the text: their lengths give the places. They
    are summed in blocks of about the root of their number, so that no array grows match by match. before
    and behind, the nearest characters up to the next matches, are only there with ``context``.
    """

    def pair(gap: Column, hit: Column) -> Column:
        before = F.substring(gap, -CONTEXT_CHARS, CONTEXT_CHARS) if context else F.lit(None).cast("string")
        return F.struct(F.length(gap).cast("long").alias("gap"), F.length(hit).cast("long").alias("chars"), hit.alias("hit"), before.alias("before"))

    def beside(p: Column, gap: Column) -> Column:
        behind = F.substring(gap, 1, CONTEXT_CHARS) if context else F.lit(None).cast("string")
        return F.struct(p["gap"].alias("gap"), p["chars"].alias("chars"), p["hit"].alias("hit"), p["before"].alias("before"), behind.alias("behind"))

    def within(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + x["chars"]
            span = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["before"].alias("before"), x["behind"].alias("behind"))
            return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

        return F.aggregate(block, start, step)

    def moved(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"), F.array_append(acc["blocks"], F.struct(acc["at"].alias("base"), x["spans"].alias("spans"))).alias("blocks"))

    def shifted(b: Column) -> Column:
        return F.transform(b["spans"], lambda s: F.struct((b["base"] + s["start"]).alias("start"), (b["base"] + s["end"]).alias("end"), s["hit"].alias("hit"), s["before"].alias("before"), s["behind"].alias("behind")))

    def placed(pairs: Column, width: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(pairs) / width).cast("int") - 1), lambda b: within(F.slice(pairs, b * width + 1, width)))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<struct<base:long,spans:{_SPAN}>>").alias("blocks"))
        return F.flatten(F.transform(F.aggregate(blocks, start, moved)["blocks"], shifted))

    def of(x: Column) -> Column:
        n = F.size(x["found"])
        pairs = F.zip_with(F.zip_with(F.slice(x["between"], 1, n), x["found"], pair), F.slice(x["between"], 2, n), beside)
        spans = _let(pairs, lambda p: _let(F.ceil(F.sqrt(n)).cast("int"), lambda width: placed(p, width)))
        return F.when(n > 0, spans).otherwise(F.array().cast(_SPAN))

    spans = _let(F.struct(F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("found"), F.split(text, form, -1).alias("between")), of)
    return spans if needed is None else F.when(F.contains(text, F.lit(needed)), spans).otherwise(F.array().cast(_SPAN))


def luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind; matches that fail a kind's condition are dropped and not tried again."""

    def card(s: Column) -> Column:
        digits = _digits(s["hit"])
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)

    return {
        "email": _spans(text, EMAIL, "@"),
        "ip": F.filter(_spans(text, IP, "."), lambda s: s["hit"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": F.filter(_spans(text, CARD), card),
        "phone": F.filter(_spans(text, PHONE, "+"), lambda s: F.length(_digits(s["hit"])).between(8, 15)),
    }


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def keyed_values(text: Column) -> Column:
    """(pattern, value, start, end) of each keyed value."""
    def one(s: Column) -> Column:
        found = F.regexp_replace(s["hit"], rf"^{_KEY}[ \t]*+[\"']?", "")
        key = F.regexp_replace(F.lower(F.regexp_extract(s["hit"], rf"^{_KEY}", 0)), r"[ \t]", "")
        return F.struct(key.alias("pattern"), found.alias("value"), (s["end"] - F.length(found)).alias("start"), s["end"].alias("end"))

    spans = F.transform(_spans(text, KEYED), one)
    return F.when(text.rlike("[=:#]"), spans).otherwise(F.array().cast("array<struct<pattern:string,value:string,start:long,end:long>>"))


def word_contexts(text: Column) -> Column:
    """(patterns, value, start, end) of each candidate: the words before and behind it in its line.

    Words are runs of letters, in lower case.
    """

    def words(x: Column) -> Column:
        return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(WORD), F.lit(0))

    def one(s: Column) -> Column:
        left, right = words(F.regexp_extract(s["before"], r"[^\n]*$", 0)), words(F.regexp_extract(s["behind"], r"^[^\n]*", 0))
        before = [F.when(F.size(left) >= n, F.concat(F.lit("<"), F.array_join(F.slice(left, -n, n), " "))) for n in range(1, BEFORE + 1)]
        behind = [F.when(F.size(right) >= n, F.concat(F.lit(">"), F.array_join(F.slice(right, 1, n), " "))) for n in range(1, BEHIND + 1)]
        patterns = F.array_compact(F.array(*before, *behind))
        return F.struct(patterns.alias("patterns"), s["hit"].alias("value"), s["start"].alias("start"), s["end"].alias("end"))

    spans = F.transform(_spans(text, CANDIDATE, context=True), one)
    return F.when(text.rlike("[0-9@]"), spans).otherwise(F.array().cast("array<struct<patterns:array<string>,value:string,start:long,end:long>>"))


def score_patterns(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence, support) from distinct edges (pattern, value, seed).

    Aggregations combine before they shuffle, so a pattern that a third of all values follow is no hot spot.
    """
    edges = scratch.save(edges.withColumn("belief", F.col("seed").cast("double")), "edges0")
    for turn in range(1, rounds + 1):
        patterns = edges.groupBy("pattern").agg(F.avg("belief").alias("confidence"), F.sum("belief").alias("support"))
        if turn == rounds:
            return scratch.save(patterns, "patterns")
        worth = patterns.select("pattern", F.when(F.col("support") >= MIN_SUPPORT, F.col("confidence")).otherwise(0.0).alias("worth"))
        doubt = edges.join(worth, "pattern").groupBy("value").agg(F.exp(F.sum(F.ln(F.greatest(1 - F.col("worth"), F.lit(1e-6))))).alias("doubt"))
        edges = scratch.save(edges.join(doubt, "value").select("pattern", "value", "seed", F.when(F.col("seed"), 1.0).otherwise(1 - F.col("doubt")).alias("belief")), f"edges{turn}")
    raise ValueError("rounds must be at least 1")


def striking_patterns(likely: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(pattern) of the word patterns (pattern, support) whose rarest word seldom stands elsewhere in ``docs``."""
    words = scratch.save(likely.select("pattern", "support", F.explode(F.split(F.substring("pattern", 2, 10_000), " ")).alias("word")), "words")
    wanted = scratch.save(words.select("word").distinct(), "wanted")
    spoken = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(WORD), F.lit(0))).alias("word"))
    counts = spoken.join(wanted, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = words.join(counts, "word").groupBy("pattern").agg(F.first("support").alias("support"), F.min("n").alias("n"))
    return scratch.save(rarest.filter(F.col("support") >= WORDS_SHARE * F.col("n")).select("pattern"), "striking")


def find_private(docs: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, words_confidence: float = WORDS_CONFIDENCE) -> DataFrame:
    """doc_id, counts of base kinds, base_sha256, spans, and n_ident, for each row of ``docs`` (doc_id, text).

    Spans are ``kind:start:end`` in code points, end exclusive, by kind (base kinds, then ident) and start.
    A null or empty text has none: counts 0, the digest of the empty string, empty spans. An identifier that
    overlaps a base span isn't added. Repeated rows get equal results.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", text).alias("key"), text.alias("text"))
    base = {k: F.transform(v, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k, v in base_spans(F.col("text")).items()}
    keyed = keyed_values(F.col("text")).alias("keyed")
    rows = scratch.save(rows.select("doc_id", "key", *base.values(), keyed, word_contexts(F.col("text")).alias("worded")), "rows")

    one = F.transform("keyed", lambda k: F.struct(F.array(k["pattern"]).alias("patterns"), k["value"].alias("value"), k["start"].alias("start"), k["end"].alias("end")))
    bases = F.transform(F.concat(*KINDS), lambda s: F.struct(F.lit(None).cast("array<string>").alias("patterns"), F.lit(None).cast("string").alias("value"), s["start"].alias("start"), s["end"].alias("end")))
    values = rows.filter((F.size("keyed") > 0) | (F.size("worded") > 0)).dropDuplicates(["key"]).select("key", F.explode(F.concat(one, "worded", bases)).alias("k")).select("key", "k.*")
    # a value crosses a base span that starts no later and ends behind its start, or one that starts within it
    rising, falling = (Window.partitionBy("key").orderBy(x).rangeBetween(Window.unboundedPreceding, 0) for x in (F.col("start"), F.col("start").desc()))
    is_base = F.col("value").isNull()
    before = F.max(F.when(is_base, F.col("end"))).over(rising)
    behind = F.min(F.when(is_base, F.col("start"))).over(falling)
    crosses = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(behind < F.col("end"), F.lit(False))
    values = values.withColumn("base", crosses).filter("value is not null").withColumn("seed", F.col("base") | F.col("value").rlike(SEED)).select("key", "value", "start", "end", "base", "seed", F.explode("patterns").alias("pattern"))
    edges = values.select("pattern", F.xxhash64(F.lower("value")).alias("value"), "seed").groupBy("pattern", "value").agg(F.bool_or("seed").alias("seed"))
    in_words = F.col("pattern").rlike("^[<>]")
    scored = score_patterns(edges, scratch, rounds)
    keys = scored.filter(~in_words & (F.col("confidence") >= min_confidence) & (F.col("support") >= MIN_SUPPORT)).select("pattern")
    likely = scored.filter(in_words & (F.col("confidence") >= words_confidence) & (F.col("support") >= WORDS_SUPPORT))
    patterns = keys.unionByName(striking_patterns(likely, docs, scratch))
    found = values.filter(~F.col("base") & F.col("value").rlike(IDENTIFIER)).join(patterns.select("pattern"), "pattern", "left_semi")
    found = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ident")).withColumnRenamed("key", "_key")
    rows = rows.join(found, F.col("key") == F.col("_key"), "left").withColumn("ident", F.coalesce("ident", F.array().cast("array<struct<start:long,end:long>>")))
    whole = F.concat(*[_named(k, F.col(k)) for k in KINDS])
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(F.array_join(whole, ","), 256).alias("base_sha256"), F.array_join(F.concat(whole, _named(KIND, F.col("ident"))), ",").alias("spans"), F.size("ident").cast("long").alias("n_ident"))
