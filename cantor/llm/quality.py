"""Quality rules, lines first.

Each line is judged by punctuation, navigation and boilerplate rules; failing lines go; then documents that
lose too much of their text, or that fail the base rules on words and repetition, are rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.llm.common import SPACES, portions

#: Fixed values of the line rules: boilerplate phrases in English, German, French and Spanish.
BOILERPLATE = ("lorem ipsum", "enable javascript", "accept cookies", "use of cookies", "terms of use", "terms of service", "privacy policy", "all rights reserved", "click here", "read more", "sign up", "log in",
               "alle rechte vorbehalten", "cookies akzeptieren", "verwendung von cookies", "datenschutzerklärung", "nutzungsbedingungen", "javascript aktivieren", "hier klicken", "jetzt anmelden",
               "tous droits réservés", "accepter les cookies", "utilisation de cookies", "politique de confidentialité", "conditions d'utilisation", "activer javascript", "cliquez ici", "lire la suite", "s'inscrire",
               "todos los derechos reservados", "aceptar cookies", "uso de cookies", "política de privacidad", "términos de uso", "condiciones de uso", "haga clic aquí", "leer más", "iniciar sesión")
SEPARATORS = "|»›•·"
TERMINAL = (".", "!", "?", "…", ":", ";", '"', "'", ")", "”", "»")
SYMBOLS = "#*$%&|<>"
#: Most words of a line that a boilerplate phrase condemns.
BOILERPLATE_WORDS = 30
#: Words beyond which repeated windows are counted by sorting numbers, in less memory than by hashing tuples; counts are the same.
SORT_WORDS = 50_000
#: Share of a document's words that may be lost with its failing lines.
MOST_LOST = 0.5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_words long, failed_rules string, clean_text string"


def repeated_words(words: list) -> int:
    """Words that stand in a 5-word window that occurs at least twice, its first occurrence included."""
    n = len(words) - 4
    if n < 2:
        return 0
    if n > SORT_WORDS:
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        pair = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1].astype(np.int64)
        four = np.unique(pair[:-2] * (pair.max() + 1) + pair[2:], return_inverse=True)[1].astype(np.int64)
        _, which, count = np.unique(four[:-1] * (ids.max() + 1) + ids[4:], return_inverse=True, return_counts=True)
        twice = count[which] > 1
    else:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        if len(set(windows)) == n:
            return 0
        count = Counter(windows)
        twice = np.fromiter((count[w] > 1 for w in windows), bool, n)
    covered = np.zeros(n + 4, bool)
    for i in range(5):
        covered[i : i + n] |= twice
    return int(covered.sum())


def base_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            duplicates += line in seen
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words)


def line_rule(line: str) -> str | None:
    """The first rule that a line with words fails, or None."""
    words = line.encode("utf-8", "surrogatepass").split()
    n, lower = len(words), line.lower()
    bars = sum(map(line.count, SEPARATORS))
    if bars >= 3 and 5 * bars >= n:
        return "navigation"
    if n <= 2 and not line.rstrip(SPACES).endswith(TERMINAL) and not any("0" <= c <= "9" for c in line):
        return "fragment"
    symbols = sum(map(line.count, SYMBOLS))
    if symbols >= 3 and 2 * symbols >= n:
        return "symbols"
    if n >= 5 and 2 * (line.count("!") + line.count("?")) >= n:
        return "shouting"
    if n >= 10 and 3 * len(set(words)) <= n:
        return "repetition"
    if n <= BOILERPLATE_WORDS and any(phrase in lower for phrase in BOILERPLATE):
        return "boilerplate"
    return None


def judge(text: str, most_lost: float = MOST_LOST) -> dict:
    """Base counts, the verdict and the cleaned text of one text."""
    stats = dict(zip(STATS, base_stats(text), strict=True))
    kept_lines, failed, lost, n_lines = [], Counter(), 0, 0
    for line in text.split("\n"):
        if not line.strip(SPACES):
            kept_lines.append(line)
            continue
        n_lines += 1
        if rule := line_rule(line):
            failed[rule] += 1
            lost += len(line.encode("utf-8", "surrogatepass").split())
        else:
            kept_lines.append(line)
    bad = stats["n_words"] < 10 or 100 * stats["n_repeat_words"] > 20 * stats["n_words"]
    kept = not bad and lost <= most_lost * stats["n_words"] and stats["n_words"] - lost >= 5
    return stats | {"base_failed": bad, "kept": kept, "n_lines": n_lines, "n_failed_lines": sum(failed.values()), "lost_words": lost, "failed_rules": ",".join(sorted(failed)), "clean_text": "\n".join(kept_lines)}


def quality_rules(docs: DataFrame, most_lost: float = MOST_LOST, with_text: bool = True) -> DataFrame:
    """Judges each row of ``docs`` (doc_id, text) by itself: columns of JUDGED, or all but clean_text.

    A null or empty text has no words and fails the base rules. Repeated rows are judged alike.
    """
    schema = JUDGED if with_text else JUDGED.rsplit(",", 1)[0]
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    kinds = [arrow[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = [judge(t or "", most_lost) | {"doc_id": d} for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def reject_documents(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """The documents that pass, their failing lines removed and n_chars counted anew; columns of ``docs``."""
    names = docs.columns
    extra = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            judged = [judge(t or "", most_lost) for t in batch.column(at).to_pylist()]
            batch = batch.set_column(at, names[at], pa.array([j["clean_text"] for j in judged], pa.string()))
            if count is not None:
                batch = batch.set_column(count, names[count], pa.array([len(j["clean_text"]) for j in judged], batch.schema.field(count).type))
            yield batch.filter(pa.array([j["kept"] for j in judged], pa.bool_()))

    return docs.mapInArrow(run, extra)
