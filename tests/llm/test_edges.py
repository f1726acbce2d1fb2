"""Registered queries on awkward tables, and what the operators do with rows that aren't clean."""

import collections
import hashlib
import json
import os
import time
import zlib

import numpy as np
import pytest
from test_operators import AWKWARD, WORD, _base

from cantor.llm import chat, jaccard, linededup, media, mixing, packing, pii, queries, toxicity, warc
from cantor.llm.common import Scratch


@pytest.fixture(scope="module")
def awkward_dir(spark, sf_dir, tmp_path_factory):
    """A folder of tables whose documents are awkward, with ids that repeat or are missing and a further column."""
    root = str(tmp_path_factory.mktemp("awkward"))
    rows = [(i, t, f"src{i % 3}" if i % 4 else None, "en" if i % 2 else None, i) for i, t in enumerate(AWKWARD)]
    rows += [(3, AWKWARD[3], "src1", "en", 0), (None, "no id here at all, no", "s", None, None), (None, None, None, None, None), (50, "plain words that stand here for ten or so more words " * 3, "s", "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").selectExpr("*", "'x' as _key", "1 as n_lines", "'y' as _source")
    docs.coalesce(2).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(10)] + [(None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def awkward_rows(spark, awkward_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{awkward_dir}/documents.parquet").collect()]


def test_query_op1(spark, awkward_dir, awkward_rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    want = collections.Counter()
    for d, x in awkward_rows:
        ids = plain.encode(x or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[(d, k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in queries.op1_best_fit_packing(spark, awkward_dir).collect()) == want


def test_query_op4_verdict(spark, awkward_dir, awkward_rows):
    got = queries.op4_quality_rules(spark, awkward_dir).collect()
    assert collections.Counter((r.doc_id, r.n_words) for r in got) == collections.Counter((d, len(WORD.findall(x or ""))) for d, x in awkward_rows)
    assert all(not (r.kept and r.base_failed) for r in got)
    for r in got:
        assert r.kept == (not r.base_failed and 2 * r.lost_words <= r.n_words and r.n_words - r.lost_words >= 5)


def test_query_op5(spark, awkward_dir, awkward_rows):
    """The stored form is held too: it is read from the archives with zipfile."""
    import io
    import zipfile

    scratch = Scratch(spark, "t")
    manifest = media.write_archives(spark.read.parquet(f"{awkward_dir}/documents.parquet"), scratch.root)
    stored = collections.Counter()
    for r in spark.read.parquet(manifest).collect():
        fs, path = media.open_uri(r.archive)
        with fs.open_input_file(path) as f, zipfile.ZipFile(io.BytesIO(f.read())) as z:
            for name in z.namelist():
                data = z.read(name)
                stored[(name.partition("-")[2], len(data), hashlib.sha256(data).hexdigest())] += 1
    got = queries.op5_media_columns(spark, awkward_dir).collect()
    assert collections.Counter((f"{'null' if r.doc_id is None else r.doc_id}.png", r.media_bytes, r.media_sha256) for r in got) == stored
    for d, x in awkward_rows:
        body = (x or "").encode()
        samples = np.frombuffer(body + b"\xff" * (max(576, -(-len(body) // 576) * 576) - len(body)), np.uint8)
        share = np.bincount(samples, minlength=256) / len(samples)
        share = share[share > 0]
        mine = [r for r in got if r.doc_id == d and r.payload_sha256 == hashlib.sha256(samples.tobytes()).hexdigest()]
        assert mine and all(f"mean={samples.mean():.4f};sd={samples.std():.4f};entropy={-float(share @ np.log2(share)) + 0.0:.4f}" in r.feature for r in mine)


def test_media_unreadable_member_fails_the_query(spark, awkward_dir):
    scratch = Scratch(spark, "t")
    manifest = media.write_archives(spark.read.parquet(f"{awkward_dir}/documents.parquet"), scratch.root)
    path = spark.read.parquet(manifest).first().archive.removeprefix("file:").replace("///", "/")
    with open(path, "r+b") as f:
        f.seek(90)
        f.write(b"\x00\x01\x02\x03")
    read = media.read_archives(spark, manifest, retries=0)
    assert read.filter("error is not null and media is null").count() == 1
    with pytest.raises(Exception, match="checksum"):
        media.media_features(read).collect()


def test_query_op7(spark, awkward_dir, awkward_rows):
    got = queries.op7_pii(spark, awkward_dir).collect()
    want = collections.Counter()
    for d, x in awkward_rows:
        found = _base(x or "")
        joined = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in found[k]]
        want[(d, *(len(found[k]) for k in pii.KINDS), hashlib.sha256(",".join(joined).encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r)[:6] for r in got) == want


def test_query_op8(spark, awkward_dir, awkward_rows):
    got = queries.op8_toxicity(spark, awkward_dir).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(d for d, _ in awkward_rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    none = spark.read.parquet(f"{awkward_dir}/documents.parquet").limit(0)
    labels = spark.read.parquet(f"{awkward_dir}/labels.parquet")
    assert toxicity.score_documents(none, toxicity.train_on(none, labels)).count() == 0


def test_toxicity_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"you idiot {i} " if i % 2 else f"all well {i} ") for i in range(40)] + [(1, "you idiot again ")] * 200, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.train_on(docs, labels).weights
    assert not toxicity.train_on(docs, labels, max_chars=20).weights  # one document fits: no two labels


def _mixed(rows, budget=mixing.BUDGET):
    """Probabilities of (source, lang, topic, tokens) cells by plain fitting."""
    w = np.array([c[3] for c in rows], float)
    tokens, w = w.copy(), w / w.sum()
    for _ in range(400):
        for k, name in enumerate(mixing.DIMENSIONS):
            goal = {v: sum(c[3] for c in rows if c[k] == v) ** mixing.TEMPER[name] for v in {c[k] for c in rows}}
            for v in goal:
                at = [i for i, c in enumerate(rows) if c[k] == v]
                if w[at].sum():
                    w[at] *= goal[v] / sum(goal.values()) / w[at].sum()
    return {c[:3]: min(1.0, w[i] / tokens[i] * budget * tokens.sum()) if tokens[i] else 0.0 for i, c in enumerate(rows)}


@pytest.mark.parametrize("one_task", [True, False])
def test_query_op9(spark, awkward_dir, monkeypatch, one_task):
    if not one_task:
        monkeypatch.setattr(mixing, "ONE_TASK_CELLS", 0)
        monkeypatch.setattr(mixing, "ROUNDS", 12)
    got = queries.op9_mixing(spark, awkward_dir).collect()
    cells = collections.Counter()
    for r in got:
        cells[(r.source, r.lang, r.topic)] += r.n_tokens
    want = _mixed([(*c, n) for c, n in cells.items()])
    assert all(abs(r.probability - want[(r.source, r.lang, r.topic)]) < (1e-5 if one_task else 1e-2) for r in got)


def test_mixing_keeps_by_a_hash(spark, awkward_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{awkward_dir}/documents.parquet")
    many = docs.limit(0).unionByName(spark.range(3000).selectExpr("case when id % 3 = 0 then null else id end doc_id", "concat('word number ', id) text", "case when id % 2 = 0 then 's' end source", "'en' lang", "1L n_chars", "'k' _key", "1 n_lines", "'y' _source"))
    mixed = mixing.mix(many, targets={"source": {"s": 0.2}})
    assert set(docs.columns) <= set(mixed.columns)
    rows = mixed.select("doc_id", "source", "probability", "kept").collect()
    for ids in (True, False):
        share = [r for r in rows if (r.doc_id is None) != ids and r.source == "s"]
        expected = np.mean([r.probability for r in share])
        assert abs(np.mean([r.kept for r in share]) - expected) < 0.06 and abs(expected - 0.2 * mixing.BUDGET * 2) < 0.06
    again = {r.doc_id: r.kept for r in mixed.filter("doc_id is not null").select("doc_id", "kept").collect()}
    assert again == {r.doc_id: r.kept for r in rows if r.doc_id is not None}
    assert mixed.filter(F.col("_source") == "y").count() == 3000


def test_packing_ids_of_every_low_character():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    texts = [form.replace("#", chr(c)) for c in range(0x250) for form in ("a#b", "#", "it's #Word.#", "x ## 1#2 'll#", "#, É#é")]
    texts += ["a <|endoftext|> b", "<|startoftext|>", "<|END|> <|endoftext|", "’s c'est l'été, it'S"]
    got = packing.encode_texts(texts, queries.tokenizer_path())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_with_another_tokenizer(tmp_path):
    from tokenizers import Tokenizer

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        form = json.load(f)
    form["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}]+|[\p{N}]+|[^\s\p{L}\p{N}]"
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(form, f)
    texts = ["it's 1234 (well), ok", ""]
    got = packing.encode_texts(texts, path)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert got != packing.encode_texts(texts, queries.tokenizer_path())


@pytest.mark.parametrize(
    "parts, body, kinds",
    [
        ("not json", "not json", []),
        ('"just text"', "just text", []),
        ('[1, "two", null, {"type": "text", "text": 5}]', "1two5", []),
        ('{"type": "image", "width": "56", "height": 28}', "<|image|>", [("image", 2)]),
        ('[{"type": "audio", "seconds": "x"}, {"type": "image", "width": -5, "height": 1e999}, {"type": 7, "uri": {"a": 1}}]', "<|audio|><|image|><|document|>", [("audio", 0), ("image", 0), ("document", 0)]),
        ('[{"type": "text", "text": "\\ud800<|image|>"}]', "�<\\|image|>", []),
    ],
)
def test_chat_awkward_parts(parts, body, kinds):
    got, attached = chat.flatten(0, "unused", parts)
    assert got == body and [(a["kind"], a["tokens"]) for a in attached] == kinds


def test_chat_parts_column(spark):
    parts = json.dumps([{"type": "text", "text": "see <|image|> \\"}, {"type": "image", "uri": "u", "width": 28, "height": 28}, {"type": "text", "text": "end"}])
    rows = [(1, 0, "user", "unused", parts), (1, 1, "assistant", "fine", None), (1, 2, "assistant", None, "{broken")]
    stored = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string")).collect()
    assert len(stored) == 1 and [(a.turn, a.kind, a.uri, a.tokens) for a in stored[0].attachments] == [(0, "image", "u", 1)]
    turns, loss = chat.read_back(stored[0].formatted, [s.asDict() for s in stored[0].loss])
    assert [t[0] for t in turns] == ["user", "assistant", "assistant"] and loss == ["fine", "{broken"]
    first = stored[0].formatted.partition("\n")[2].partition(chat.STOP)[0]
    assert chat.read_parts(first) == [("text", "see <|image|> \\"), ("image", ""), ("text", "end")]


def test_line_dedup_with_clashing_columns(spark):
    rows = [(i, f"own line number {i} stands here\nthe line of every site in the land\nshort one", f"s{i}", 7, "k", True) for i in range(13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines int, _key string, _flagged boolean")
    got = linededup.remove_boilerplate(docs)
    assert got.columns == [*docs.columns, "n_boilerplate", "n_removed", "mostly_boilerplate"]
    assert {(r.text, r.n_lines, r._key, r._flagged, r.n_removed, r.mostly_boilerplate) for r in got.collect()} == {(f"own line number {i} stands here", 3, "k", True, 2, True) for i in range(13)}
    few = linededup.remove_boilerplate(docs.filter("doc_id < 11")).first()  # short lines need more sites
    assert few.n_removed == 1 and few.text.endswith("short one")


def test_warc_of_other_writers(spark, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:77>\r\nContent-Length: 4\r\n\r\nsoft\r\n\r\n"
    visit = b"WARC/1.0\r\nWARC-Type: revisit\r\nwarc-record-id: <urn:uuid:78>\r\nWARC-Payload-Digest: md5:abc\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    ours = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nWARC-Payload-Digest: sha1:WRONG\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    os.mkdir(tmp_path / "w")
    (tmp_path / "w" / "a.warc").write_bytes(info + visit + ours)
    got = {r.record_type: tuple(r)[:5] + (r.digest_ok,) for r in warc.read_warc(spark, str(tmp_path / "w"), 100).collect()}
    soft, ab = (__import__("base64").b32encode(hashlib.sha1(x).digest()).decode() for x in (b"soft", b"ab"))
    assert got == {"warcinfo": (None, 4, soft, "warcinfo", None, None), "revisit": (None, None, None, "revisit", None, None), "response": (5, 2, ab, "response", None, False)}
    (tmp_path / "w" / "b.warc.gz").write_bytes(b"x")
    with pytest.raises(ValueError, match="gzipped"):
        warc.read_warc(spark, str(tmp_path / "w"))


def test_pii_learns_contexts_of_words(spark):
    rows = [(i, f"Please write to user{i}@mail{i}.org today. We were {i}00 and some more people here") for i in range(12)]
    rows += [(20 + i, f"His passport number {i}AB{i:05d}X is new, and token = \"{i:032x}\"") for i in range(4)]
    rows += [(30 + i, f"Her passport number {i:032x} is old") for i in range(9)]
    rows += [(40, "Please write to box-77.99.here today, or read volume 1234567 of it"), (41, "They found 1234567 stones and 7654321 more")]
    got = {r.doc_id: r.spans for r in pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(f"ident:20:{20 + len(f'{i}AB{i:05d}X')}" in got[20 + i] for i in range(4))
    assert got[40] == "ident:16:30" and got[41] == ""


def test_pii_many_matches(spark):
    """Places are found in about linear time."""
    one = "on 10.0.0.1 and a@b.co key = 12345678 then 4111111111111111 stand "
    took = []
    for n in (2_000, 16_000):
        text = one * n
        began = time.time()
        got = pii.find_private(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        took.append(time.time() - began)
        assert (got.n_ip, got.n_email, got.n_card) == (n, n, n)
        spans = got.spans.split(",")
        assert spans[n - 1] == f"email:{len(one) * (n - 1) + 16}:{len(one) * (n - 1) + 22}"
    assert took[1] < 8 * took[0] + 20


def test_keep_one_of_repeated_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a"), (1, text, "a"), (1, text, "b"), (2, text, "c"), (3, "other words are here now", "d"), (None, text, "e"), (None, text, "e"), (4, None, "f"), (4, None, "f")]
    kept = jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _named string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, text), (3, rows[4][1]), (0, text), (0, text), (4, "")])


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_on_awkward_documents(spark, awkward_dir, empty):
    import corpus_pipeline

    docs = spark.read.parquet(f"{awkward_dir}/documents.parquet")
    docs = docs.limit(0) if empty else docs
    names, scratch = docs.columns, Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, awkward_dir), name)
        assert docs.columns == names
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, awkward_dir)
    assert pieces.count() >= docs.count() and (not empty or not docs.count())


def _private_by_hand(rows):
    """Added spans by row, in plain Python: contexts, scores, striking patterns, identifiers."""
    import math
    import re

    import regex

    found, spoken = [], collections.Counter()
    for d, text in rows:
        text = text or ""
        spoken.update(regex.findall(r"\p{L}+", text.lower()))
        base = [s for spans in _base(text).values() for s in spans]
        hits = list(re.finditer(pii.CANDIDATE, text)) if re.search("[0-9@]", text) else []
        for i, m in enumerate(hits):
            lo, hi = hits[i - 1].end() if i else 0, hits[i + 1].start() if i + 1 < len(hits) else len(text)
            before = text[max(lo, m.start() - pii.CONTEXT_CHARS) : m.start()].rpartition("\n")[2]
            behind = text[m.end() : min(hi, m.end() + pii.CONTEXT_CHARS)].partition("\n")[0]
            left, right = (regex.findall(r"\p{L}+", x.lower()) for x in (before, behind))
            patterns = ["<" + " ".join(left[-n:]) for n in range(1, pii.BEFORE + 1) if len(left) >= n] + [">" + " ".join(right[:n]) for n in range(1, pii.BEHIND + 1) if len(right) >= n]
            found += [(d, text, p, m[0], m.span()) for p in patterns]
        for m in re.finditer(pii.KEYED, text):
            key = re.match(pii._KEY, m[0])[0]
            value = re.sub(rf"^{pii._KEY}[ \t]*+[\"']?", "", m[0])
            found.append((d, text, re.sub(r"[ \t]", "", key.lower()), value, (m.end() - len(value), m.end())))
    cross = lambda text, span: any(a < span[1] and span[0] < b for spans in _base(text).values() for a, b in spans)
    edges = collections.defaultdict(bool)
    for _, text, p, value, span in found:
        edges[(p, value.lower())] |= cross(text, span) or bool(re.match(pii.SEED, value))
    belief = {e: float(seed) for e, seed in edges.items()}
    for turn in range(1, pii.ROUNDS + 1):
        by = collections.defaultdict(list)
        for (p, _), b in belief.items():
            by[p].append(b)
        score = {p: (sum(b) / len(b), sum(b)) for p, b in by.items()}
        if turn < pii.ROUNDS:
            doubt = collections.defaultdict(float)
            for p, v in edges:
                doubt[v] += math.log(max(1 - (score[p][0] if score[p][1] >= pii.MIN_SUPPORT else 0.0), 1e-6))
            belief = {(p, v): 1.0 if seed else 1 - math.exp(doubt[v]) for (p, v), seed in edges.items()}
    good = set()
    for p, (confidence, support) in score.items():
        if p[0] in "<>":
            rarest = min(spoken[w] for w in p[1:].split(" "))
            if confidence >= pii.WORDS_CONFIDENCE and support >= pii.WORDS_SUPPORT and support >= pii.WORDS_SHARE * rarest:
                good.add(p)
        elif confidence >= pii.MIN_CONFIDENCE and support >= pii.MIN_SUPPORT:
            good.add(p)
    out = collections.defaultdict(set)
    for d, text, p, value, span in found:
        if p in good and not cross(text, span) and re.match(pii.IDENTIFIER, value):
            out[(d, text)].add(span)
    return {k: [f"ident:{a}:{b}" for a, b in sorted(v)] for k, v in out.items()}


def test_pii_bootstrapping_equals_plain_python(spark, awkward_rows):
    rng = np.random.default_rng(4)
    words = ["passport", "number", "call", "at", "write", "to", "the", "of", "ticket", "Nr."]
    values = ["me@x.org", "10.0.0.7", "+49 30 1234567", "QX-99-1234", "0123456789abcdef0123456789abcdef", "AB1234567", "77.88.99.zz", "v2beta9", "4111 1111 1111 1111"]
    rows = [r for r in awkward_rows if r[0] is not None]
    for i in range(160):
        parts = []
        for _ in range(int(rng.integers(1, 9))):
            value = values[int(rng.integers(0, len(values)))]
            value = value.replace("99", str(int(rng.integers(10, 99)))).replace("me", f"me{int(rng.integers(0, 60))}")
            parts += [words[int(k)] for k in rng.integers(0, len(words), 3)] + [("id = " if rng.random() < 0.2 else "passport number " if rng.random() < 0.5 else "") + value, "\n" if rng.random() < 0.2 else "ok,"]
        rows.append((1000 + i, " ".join(parts)))
    want = _private_by_hand(rows)
    got = {(r.doc_id, t): [s for s in (r.spans or "").split(",") if s.startswith("ident:")] for r, t in ((r, dict(rows)[r.doc_id] or "") for r in pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect())}
    assert {k: v for k, v in got.items() if v} == want and len(want) > 20
