"""Operators against brute force, on the small tables and on awkward rows."""

import base64
import binascii
import collections
import hashlib
import io
import re
import zlib

import numpy as np
import pytest

from cantor.llm import chat, jaccard, linededup, media, mixing, packing, pii, quality, queries, toxicity, warc
from cantor.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " \n\t ", "one", "two words", "x" * 5000, "a b c d " * 40, "mail a@b.co a@b.c_x@d.e 1.2.3.4.5.6.7.8 4111 1111 1111 1111 +49 (30) 123-4567",
           "token = \"ABCDEF0123456789\" token = \"0123456789abcdef0123456789abcdef\" é漢字 <|im_end|> \\ <\\|", "line\nline\nline\n\nline of some more words here\r\nÉcole À la", "İstanbul ǅ ﬁ \x1f   x"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(10_000 + i, t, None if i % 3 else "src0", "en", 1) for i, t in enumerate(AWKWARD)] + [(None, "no id here at all, no", "s", None, None), (10_007, AWKWARD[7], "src1", "en", 3)]
    return real.unionByName(spark.createDataFrame(rows, real.schema))


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_packing(spark, docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    got = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    want = collections.Counter()
    total = 0
    for d, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            want[(d, k, s, len(part), binascii.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-total // 4096) * 1.05 + 1


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted(rng.integers(1, 50, 300).tolist(), reverse=True)
    gaps = []
    for n in lengths:
        fits = [g for g in gaps if g >= n]
        if fits:
            g = min(fits)
            gaps.remove(g)
            gaps.append(g - n)
        else:
            gaps.append(50 - n)
    runs, opened = packing.best_fit_runs(dict(collections.Counter(lengths)), 50)
    assert opened == len(gaps)
    used = collections.Counter()
    for i, (rank, length, each, first, place) in enumerate(runs.tolist()):
        end = runs[i + 1][0] if i + 1 < len(runs) else len(lengths)
        for nth in range(end - rank):
            assert lengths[rank + nth] == length
            s = first + nth // each
            assert used[s] == place + nth % each * length
            used[s] += length
    assert max(used.values()) <= 50 and sorted(50 - v for v in used.values()) == sorted(gaps)


def test_packing_by_join(spark, docs, monkeypatch):
    pieces = packing.tokenize_pieces(docs, queries.tokenizer_path())
    a = packing.pack_pieces(pieces).collect()
    monkeypatch.setattr(packing, "BROADCAST_RUNS", 0)
    b = packing.pack_pieces(pieces).collect()
    key = lambda rows: sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert key(a) == key(b)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0
    assert jaccard.ngram_jaccard_join(none).count() == 0
    assert pii.find_private(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert linededup.remove_boilerplate(none).count() == 0
    assert quality.quality_rules(none).count() == 0
    manifest = media.write_archives(none, Scratch(spark, "t").root)
    assert media.media_features(media.read_archives(spark, manifest)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = Scratch(spark, "t").path("w")
    warc.write_warc(pages, path)
    assert warc.read_warc(spark, path).count() == 0
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


@pytest.mark.parametrize("range_bytes", [200, 3000, 1 << 20])
def test_warc(spark, range_bytes):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    html = [None, "", "é" * 300, fake, "pre " + fake * 3, "dup", "dup", "dup", "WARC/1.0\r\n" * 30, "z" * 2000]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://x/{i} a\r\nb", h, 1) for i, h in enumerate(html)] + [(6, "u", "dup", 1), (None, "u", "alone", 1)], "page_id long, url string, html string, digest int")
    path = Scratch(spark, "t").path("w")
    warc.write_warc(pages, path)
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, path, range_bytes).collect())
    want = collections.Counter()
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    for i, p in rows:
        first = min((j for j, q in rows if q == p and j is not None), default=None)
        same = first is None or i == first
        want[(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if same else "revisit", None if same else first)] += 1
    assert got == want


def test_warc_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    path = Scratch(spark, "t").path("w")
    warc.write_warc(pages, path, min_revisit_bytes=4)
    assert {r.page_id: r.record_type for r in warc.read_warc(spark, path).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def _chat_expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r[2]}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("row_chars", [1, 60, 1 << 20])
def test_chat(spark, monkeypatch, row_chars):
    monkeypatch.setattr(chat, "ROW_CHARS", row_chars)
    rows = [(c, t, ("user", "assistant", "a\nb<|im_start|>\\n")[t % 3], AWKWARD[(c + t) % len(AWKWARD)]) for c in range(6) for t in range(9)] + [(-1, 0, "user", queries.FORGED), (-1, 1, "assistant", queries.FORGED)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = [r for b in chat._format_sorted(df.select("conv_id", "role", "text").selectExpr("conv_id", "role", "coalesce(text, '') text", "cast(null as string) p").toArrow().to_batches()) for r in b.to_pylist()]
    got = [r for b in chat._digest_sorted([__import__("pyarrow").RecordBatch.from_pylist(formatted)]) for r in b.to_pylist()]
    want = _chat_expected(rows)
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want
    spark_rows = chat.conversation_digests(chat.format_conversations(df)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in spark_rows} == want


def test_chat_parts():
    body, attached = chat.flatten(3, None, '[{"type":"text","text":"see <|"},{"type":"image","uri":"i","width":56,"height":29},{"type":"audio","uri":"a","seconds":2.01},{"type":"document","uri":"d","pages":2},{"type":"text","text":"end"}]')
    assert body == "see <\\|<|image|><|audio|><|document|>end"
    assert [(a["kind"], a["uri"], a["tokens"], a["turn"]) for a in attached] == [("image", "i", 4, 3), ("audio", "a", 51, 3), ("document", "d", 1024, 3)]


def test_quality(docs, texts):
    got = collections.Counter(tuple(r)[:7] for r in quality.quality_rules(docs, with_text=False).collect())
    want = collections.Counter()
    for d, x in texts:
        x = x or ""
        w = WORD.findall(x)
        seen, dup = set(), 0
        for line in x.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        want[(d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))] += 1
    assert got == want


def test_repeated_words_by_sorting(monkeypatch):
    rng = np.random.default_rng(3)
    for n in (5, 6, 50, 400):
        words = [b"w%d" % x for x in rng.integers(0, 3, n)]
        plain = quality.repeated_words(words)
        monkeypatch.setattr(quality, "SORT_WORDS", 0)
        assert quality.repeated_words(words) == plain
        monkeypatch.setattr(quality, "SORT_WORDS", 50_000)


def test_quality_keeps_clean_and_rejects_junk(spark, sf_dir):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = quality.quality_rules(d, with_text=False).join(d.select("doc_id", "quality"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 10]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.85 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_media(spark, docs, texts):
    manifest = media.write_archives(docs, Scratch(spark, "t").root, archive_bytes=50_000)
    stored = media.read_archives(spark, manifest, range_bytes=20_000, batch_bytes=5000)
    got = collections.Counter(tuple(r)[:5] for r in media.media_features(stored).collect())
    want = collections.Counter()
    for d, x in texts:
        b = (x or "").encode()
        p = b + b"\xff" * (max(576, -(-len(b) // 576) * 576) - len(b))
        want[(d, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))] += 1
    assert got == want


def test_media_is_a_png_and_damage_is_seen():
    payload = media.to_payload("abc é")
    png = media.encode_png(payload, 6)
    assert media.decode_png(png) == (payload, 6)
    broken = bytearray(png)
    broken[60] ^= 1
    with pytest.raises(Exception):  # noqa: B017
        media.decode_png(bytes(broken))


def test_media_retries_by_offset(tmp_path):
    import zipfile

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("0-5.png", b"x" * 100)
    reader = media.MediaArchiveReader({"path": "unused", "retries": "1"})
    info = zipfile.ZipFile(path).infolist()[0]
    fs, name = media.open_uri(f"file://{path}")
    assert reader._member(fs, name, info, io.BytesIO(b"")) == b"x" * 100
    info.CRC ^= 1
    with pytest.raises(ValueError):
        reader._member(fs, name, info, fs.open_input_file(name))


def test_line_dedup(docs):
    got = linededup.remove_boilerplate(docs, short_sites=6)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = docs.collect()
    sites = collections.defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            bare = line.strip(" \t\x0b\x0c\r")
            if r.source is not None and (len(bare) >= linededup.MIN_CHARS or re.search(r"[ \t\x0b\x0c\r]", bare)):
                sites[bare].add(r.source)
    bad = {k for k, v in sites.items() if len(v) >= (linededup.MIN_SITES if len(k) >= linededup.MIN_CHARS else 6)}
    want = collections.Counter((r.doc_id, None if r.text is None else "\n".join(x for x in r.text.split("\n") if x.strip(" \t\x0b\x0c\r") not in bad)) for r in rows)
    assert bad and collections.Counter((r.doc_id, r.text) for r in got.collect()) == want


def test_line_dedup_with_coarse_sketches(spark):
    rows = [(i, f"a common line of many words\nline {i % 7} is on some sites only", f"s{i % (3 + i % 40)}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = linededup.document_lines(docs, "source", min_sites=30)
    exact = {r.hash: r.n for r in lines.selectExpr("hash", "site").distinct().groupBy("hash").count().withColumnRenamed("count", "n").collect()}
    got = {r.hash for r in linededup.boilerplate_lines(lines, lg_k=4).collect()}
    assert got == {h for h, n in exact.items() if n >= 30}


def _base(text):
    def luhn(s):
        d = [int(c) for c in reversed(s)]
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0

    out = {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and luhn(d)]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


def test_pii(docs, texts):
    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find_private(docs).collect())
    want = collections.Counter()
    for d, x in texts:
        found = _base(x or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in found[k])
        want[(d, *(len(found[k]) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert got == want


def test_pii_bootstraps_unseen_identifiers(spark):
    seeds = [(i, f"x token = \"{i:032x}\" y") for i in range(5)]
    docs = spark.createDataFrame(seeds + [(9, 'here TOKEN = "QX99-1234-ZZ" and size = 120000px'), (10, "size = 333333px " * 5)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_private(docs).collect()}
    assert got[9] == "ident:14:26" and got[10] == "" and got[0] == "ident:11:43"


@pytest.mark.parametrize("text", ["9" * 20000, "a" * 100_000, "1 " * 20000, "a@" * 3000, "1.2.3.4." * 2000, "+1 " * 3000, "a.b@c.d" * 500])
def test_pii_long_runs(spark, text):
    got = pii.find_private(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(got[1:5]) == tuple(len(_base(text)[k]) for k in pii.KINDS)


def test_toxicity_held_out(spark):
    import pandas as pd

    sf = "/root/testdata/sf0.1"
    rows = queries.op8_toxicity(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = rows[rows.held_out]
    order = held.score.rank()
    pos = held.toxic == 1
    auc = (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    hit = held[held.predicted == 1]
    print("auc", auc, "precision", hit.toxic.mean(), "recall", (held[pos].predicted == 1).mean())
    assert auc > 0.85 and hit.toxic.mean() > 0.85


def test_toxicity_finds_the_sentence(spark):
    texts = [f"Some words here {i}. You are an idiot. More of the words" for i in "abcdefghij"] + [f"Some words here {i}. All is well. More of the words" for i in "klmnopqrst"]
    model = toxicity.train(texts, [1] * 10 + [0] * 10)
    score, n, spans = model.score(texts[0])
    assert score > 0.7 and n == 3 and [texts[0][a:b] for a, b, _ in spans] == [" You are an idiot"]
    assert model.score(texts[-1])[0] < 0.3 and model.score("") == (0.0, 0, [])


def test_mixing_meets_marginals(spark, docs):
    tempered = {"source": 0.8, "lang": 0.9, "topic": 0.9}
    cells = [("a", "x", "t", 100), ("a", "y", "t", 50), ("b", "x", "u", 30), ("b", "y", "t", 70), ("c", "y", "u", 5), ("c", "x", "t", 0)]
    got = {tuple(r[:3]): r.weight for r in mixing.rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")).collect()}
    w = np.array([c[3] for c in cells], float)
    w /= w.sum()
    for _ in range(500):
        for k, name in enumerate(("source", "lang", "topic")):
            goal = {v: sum(c[3] for c in cells if c[k] == v) ** tempered[name] for v in {c[k] for c in cells}}
            total = sum(goal.values())
            for v in goal:
                at = [i for i, c in enumerate(cells) if c[k] == v]
                w[at] *= goal[v] / total / w[at].sum()
    assert np.allclose([got[c[:3]] for c in cells], w, atol=2e-6)
    mixed = mixing.mix(docs)
    assert mixed.count() == docs.count() and mixed.filter("probability < 0 or probability > 1.0000001 or probability is null").count() == 0


def _links(texts):
    sets = {}
    for d, x in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets[d] = frozenset(zip(w, w[1:], w[2:], w[3:])) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(d for d in sets if d is not None)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(s), find(d) if d is not None else None) for d, s in sets.items()}


def test_jaccard(docs, texts):
    want = _links(texts)
    got = jaccard.ngram_jaccard_join(docs).collect()
    assert len(got) == len(texts) and all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)


@pytest.mark.parametrize("small", [True, False])
def test_jaccard_crowds(spark, monkeypatch, small):
    if small:
        for name, value in {"FREQUENT": 3, "BLOCK": 5, "BROADCAST_IDS": 0, "HOT_TOKENS": 50, "FLAT": 2, "LEAF": 8, "SPLIT": 16}.items():
            monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    shared = " ".join(f"p{x}" for x in range(60))
    texts = []
    for i in range(400):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 5))):
            words[at] = f"z{rng.integers(0, 1000)}"
        texts.append(" ".join(words) if i % 2 else " ".join(f"u{x}" for x in rng.integers(0, 10**6, 40)) + " " + shared)
    rows = list(enumerate(texts + ["A b C", "a B c", "a b c d"]))
    want = _links(rows)
    got = jaccard.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_prefix_length():
    for n in range(1, 500):
        assert jaccard.prefix_length(n) == n - -(-85 * n // 100) + 1


def test_keep_one_of_each(docs, texts):
    want = _links(texts)
    kept = [r.doc_id for r in jaccard.keep_one_of_each(docs).collect()]
    assert set(kept) == {d for d, (_, c) in want.items() if c == d or d is None}


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    scratch = Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = scratch.save(stage(spark, docs, sf_dir), name)
        assert after.columns == names and 0 < after.count() <= docs.count()
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").distinct().count() == docs.count()


def _linked(texts, words, percent):
    """Pairs of doc ids whose sets of word n-grams link, by brute force."""
    sets = {}
    for d, x in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets[d] = frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()
    ids = sorted(d for d in sets if d is not None)
    both = ((a, b, len(sets[a] & sets[b])) for i, a in enumerate(ids) for b in ids[i + 1 :])
    return {(a, b) for a, b, n in both if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)}


def _firsts(ids, links):
    """The smallest id of each component."""
    up = {d: d for d in ids}
    for _ in ids:
        before = dict(up)
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
        if up == before:
            break
    return {d for d in ids if up[d] == d}


def test_pipeline_near_copies_at_five_words(spark, docs, texts, sf_dir):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    close = []
    for i in range(40):
        words = [f"v{x}" for x in rng.integers(0, 10**6, 150)]
        other = list(words)
        for at in np.linspace(9, 140, 1 + i % 5).astype(int):  # 1 to 5 words differ: 0.94 to 0.71 at five words
            other[at] = "changed"
        close += [(20_000 + 2 * i, " ".join(words)), (20_001 + 2 * i, " ".join(other))]
    rows = texts + close
    links = _linked(rows, 5, 80)
    assert links - _linked(rows, 4, 85)
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(close, "doc_id long, text string"))
    kept = [r.doc_id for r in corpus_pipeline.ngram_jaccard(spark, more, sf_dir).collect()]
    assert {d for d in kept if d is not None} == _firsts({d for d, _ in rows if d is not None}, links)


def test_mixing_keeps_its_share_beside_rare_cells(spark):
    """A rare source must not set how much of the corpus is kept; rates follow the weights at the budget."""
    rows = [(i, "w " * (20 + i % 7) + ("= " if i % 3 else ""), f"s{int(i**0.5) // 9}", "en" if i % 5 else "la") for i in range(2000)]
    odd = [(5000, "five words stand right here", "lone", "en"), (5001, "five words stand right here", None, None)]
    schema, share = "doc_id long, text string, source string, lang string", []
    for extra in ([], odd):
        mixed = mixing.mix(spark.createDataFrame(rows + extra, schema)).collect()
        total = sum(r.n_tokens for r in mixed)
        share.append(sum(r.n_tokens * r.probability for r in mixed) / total)
        cells = collections.Counter()
        for r in mixed:
            cells[(r.source, r.lang, r.topic)] += r.n_tokens
        keyed = [tuple(mixing.NONE if x is None else x for x in c) + (n,) for c, n in cells.items()]
        raked = {tuple(r[:3]): r.weight for r in mixing.rake(spark.createDataFrame(keyed, "source string, lang string, topic string, tokens long")).collect()}
        for r in mixed:
            c = (r.source, r.lang, r.topic)
            want = min(1.0, raked[tuple(mixing.NONE if x is None else x for x in c)] * mixing.BUDGET * total / cells[c])
            assert abs(r.probability - want) < 1e-6
    assert share[0] > 0.7 and abs(share[0] - share[1]) < 0.01


def test_pipeline_line_dedup_leaves_only_copies_whole(spark, sf_dir):
    import corpus_pipeline

    footer = "\n".join(f"shared footer line number {i} of every site" for i in range(6))
    article = "\n".join(f"article sentence {i} with words {i * 7} and {i * 11} in it" for i in range(8))
    own = [f"own page {i} " + " ".join(f"o{i}x{k}" for k in range(18)) for i in range(5)]
    lone = "alone " + " ".join(f"a{k}" for k in range(18))
    rows = [(i, f"{own[i]}\n{footer}", f"s{i}") for i in range(5)]  # thin pages: over half would go
    rows += [(10 + i, article + (f"\nread on site {i}" if i % 2 else ""), f"s{i}") for i in range(5)]  # copies and near copies
    rows += [(20, footer, "s9"), (21, f"{footer}\n{footer}\n{lone}", "s9"), (22, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, sf_dir).collect()}
    assert [got[i] for i in range(5)] == own
    assert [got[10 + i] for i in range(5)] == [r[1] for r in rows[5:10]]
    assert got[22] is None and got[20] == "" and got[21] == lone


def test_pii_long_values_and_keys(spark):
    long, name = "aB3." * 150 + "Z9", "session_key_of_" + "very_" * 8 + "long_name"
    rows = [(i, f'x token = "{i:032x}" y {name}: {i:040x}') for i in range(5)]
    rows += [(9, f'here token = "{long}..." and'), (10, f"now {name}: QX-99-1234-ZZ."), (11, f"token = {'k' * 50_000} {'k' * 50_000} = 1{'.' * 50_000}")]
    got = {r.doc_id: r.spans for r in pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9] == f"ident:14:{14 + len(long)}" and got[10] == f"ident:{6 + len(name)}:{19 + len(name)}" and got[11] == ""


@pytest.mark.parametrize("range_bytes", [3000, 1 << 20])
def test_warc_long_urls(spark, range_bytes):
    rows = [(1, "http://x/1", "first"), (2, "data:," + "q" * 70_000, "long"), (3, "http://x/3?" + "r" * 300_000, "longer"), (4, "http://x/4", "last")]
    path = Scratch(spark, "t").path("w")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    got = warc.read_warc(spark, path, range_bytes).collect()
    assert sorted((r.page_id, r.payload_bytes, r.digest_ok) for r in got) == [(i, len(h), True) for i, _, h in rows]


def test_warc_broken_chain_is_an_error(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame([(i, "u", f"page {i}") for i in range(3)], "page_id long, url string, html string").coalesce(1), path)
    (part,) = (tmp_path / "w").glob("part-*")
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(part.read_bytes().replace(b"Content-Length: 6\r\n\r\npage 1", b"Content-Length: 7\r\n\r\npage 1"))
    with pytest.raises(ValueError, match="end at its length"):
        warc.read_warc(spark, str(tmp_path / "cut"))
