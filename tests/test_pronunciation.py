"""Documented words, rule cases and the plan pipeline."""

import re

import pytest
from pyspark.sql import functions as F

from cantor.functions import columns as C
from cantor.functions import latin
from cantor.functions import tables as T
from cantor.operators import pronunciation
from cantor.plans.reader_catalog import QUERIES

SYLLABLES_IPA = """
amor a-mor ˈa.mor; ager a-ger ˈa.d͡ʒer; locus lo-cus ˈlo.kus; novus no-vus ˈno.vus; sacrum sa-crum ˈsa.krum; patrem pa-trem ˈpa.trem;
agrum a-grum ˈa.ɡrum; libra li-bra ˈli.bra; aegra ae-gra ˈe.ɡra; abbas ab-bas ˈab.bas; cella cel-la ˈt͡ʃel.la; peccat pec-cat ˈpek.kat;
stella stel-la ˈstel.la; sanctus sanc-tus ˈsank.tus; punctum punc-tum ˈpunk.tum; templum tem-plum ˈtem.plum; scriptum scrip-tum ˈskrip.tum;
monstrum mons-trum ˈmons.trum; quia qui-a ˈkwi.a; eius e-ius ˈe.jus; equus e-quus ˈe.kwus; et et ˈet; cum cum ˈkum; salve sal-ve ˈsal.ve;
pacis pa-cis ˈpa.t͡ʃis; amoenus a-moe-nus aˈme.nus; tropaeum tro-pae-um troˈpe.um; Nicaea ni-cae-a niˈt͡ʃe.a; Judaea ju-dae-a juˈde.a;
Galilaea ga-li-lae-a ɡa.liˈle.a; Hebraei he-brae-i eˈbre.i; Chaldaei chal-dae-i kalˈde.i; Pharisaeus pha-ri-sae-us fa.riˈse.us;
amīca a-mī-ca aˈmi.ka; fidēlis fi-dē-lis fiˈde.lis; doctrīna doc-trī-na dokˈtri.na; adventus ad-ven-tus adˈven.tus; confessor con-fes-sor konˈfes.sor;
anima a-ni-ma ˈa.ni.ma; saeculum sae-cu-lum ˈse.ku.lum; discipulus dis-ci-pu-lus diˈʃi.pu.lus; angelus an-ge-lus ˈan.d͡ʒe.lus; familia fa-mi-li-a faˈmi.li.a;
maximus ma-xi-mus ˈma.ksi.mus; humilitas hu-mi-li-tas uˈmi.li.tas; veritas ve-ri-tas ˈve.ri.tas; victima vic-ti-ma ˈvik.ti.ma
"""
VARIANTS = """
aetas aetas aetas ˈe.tas; ætas aetas aetas ˈe.tas; lætum laetum laetum ˈle.tum; pœnas poenas poenas ˈpe.nas; fœtus foetus foetus ˈfe.tus;
Joseph joseph ioseph ˈjo.sef; Joannes joannes ioannes joˈan.nes; judex judex iudex ˈju.deks; ejus ejus eius ˈe.jus; cujus cujus cuius ˈku.jus;
Troia troia troia ˈtro.ja; servus servus seruus ˈser.vus; vivus vivus uiuus ˈvi.vus; vox vox uox ˈvoks; nihildum nihildum nihildum niˈkil.dum;
herba herba herba ˈer.ba; traho traho traho ˈtra.o; honor honor honor ˈo.nor
"""
LITURGICAL = """
eleison eˈle.i.son; Christe ˈkris.te; laudamus lau̯ˈda.mus; omnipotens omˈni.po.tens; suscipe ˈsu.ʃi.pe; mulieribus mu.liˈe.ri.bus; nostrae ˈnos.tre;
caelis ˈt͡ʃe.lis; sanctificetur sank.ti.fiˈt͡ʃe.tur; quotidianum kwo.ti.diˈa.num; magnam ˈma.ɲam; vobiscum voˈbis.kum; Confiteor konˈfi.te.or; omnipotenti om.ni.poˈten.ti; est ˈest
"""


def rows(text):
    return [r.split() for r in text.replace("\n", " ").split(";") if r.strip()]


@pytest.mark.parametrize(("word", "syllables", "ipa"), rows(SYLLABLES_IPA))
def test_documented_words(word, syllables, ipa):
    got = latin.analyze_word(word)
    assert ("-".join(got["syllables"]), got["ipa"]) == (syllables, ipa)


@pytest.mark.parametrize(("word", "normalized", "key", "ipa"), rows(VARIANTS))
def test_variants(word, normalized, key, ipa):
    got = latin.analyze_word(word)
    assert (got["normalized"], got["lookup_key"], got["ipa"]) == (normalized, key, ipa)


@pytest.mark.parametrize(("word", "ipa"), rows(LITURGICAL))
def test_liturgical(word, ipa):
    assert latin.analyze_word(word)["ipa"] == ipa


@pytest.mark.parametrize("case", "ave a-ve; gratia gra-ti-a; patris pa-tris; caelum cae-lum; alleluia al-le-lu-ia; cui cu-i; qui qui; poëta po-ë-ta; qüi qü-i; hei hei; mei me-i; heï he-ï; sequi se-qui; qüia qü-ia; aēlum aē-lum".split("; "))
def test_syllables(case):
    word, want = case.split()
    assert "-".join(latin.syllabify(word)) == want


def test_no_vowel():
    with pytest.raises(latin.WordError):
        latin.syllabify("brrr")


G2P = [
    ("caelum", "cae lum", 0, "ˈt͡ʃe.lum"), ("ecce", "ec ce", 0, "ˈet.t͡ʃe"), ("descendit", "de scen dit", 1, "deˈʃen.dit"), ("ascendit", None, 1, "aˈʃen.dit"), ("regina", "re gi na", 1, "reˈd͡ʒi.na"),
    ("regnum", "re gnum", 0, "ˈre.ɲum"), ("mihi", "mi hi", 0, "ˈmi.ki"), ("gratia", "gra ti a", 0, "ˈɡra.t͡si.a"), ("excelsis", "ex cel sis", 1, "ekˈʃel.sis"), ("poëta", "po ë ta", 1, "poˈe.ta"),
    ("aüla", "a ü la", 0, "ˈa.u.la"), ("qüi", "qü i", 0, "ˈku.i"), ("sangüis", "san gü is", 0, "ˈsan.ɡu.is"), ("aïa", "a ï a", 0, "ˈa.i.a"), ("hostia", "hos ti a", 0, "ˈos.ti.a"), ("mixtio", "mix ti o", 0, "ˈmiks.ti.o"),
    ("attia", "at ti a", 0, "ˈat.ti.a"), ("chorus", "cho rus", 0, "ˈko.rus"), ("thoma", "tho ma", 0, "ˈto.ma"), ("qüia", None, 0, "ˈku.ja"), ("cui", None, 0, "ˈku.i"), ("sanguis", "san guis", 0, "ˈsaŋ.ɡwis"),
    ("lauda", "lau da", 0, "ˈlau̯.da"), ("euge", "eu ge", 0, "ˈeu̯.d͡ʒe"), ("ay", "ay", 0, "ˈai̯"), ("q", "q", 0, "ˈk"), ("nihildum", "ni hil dum", 1, "niˈkil.dum"),
]


@pytest.mark.parametrize(("word", "syllables", "stressed", "ipa"), G2P)
def test_g2p(word, syllables, stressed, ipa):
    assert latin.g2p(word, syllables.split() if syllables else latin.syllabify(word), stressed)[0] == ipa


def test_model_phonemes():
    assert " ".join(latin.g2p("ecce", ["ec", "ce"], 0)[1]) == "ˈ e t . t͡ʃ e"
    assert " ".join(latin.g2p("excelsis", ["ex", "cel", "sis"], 1)[1]) == "e k . ˈ ʃ e l . s i s"


STRESS = [
    ("dominus", "do mi nus", {"override": 1, "explicit": 2}, 1, "override", "override-stress"), ("dominus", "do mi nus", {"explicit": 1}, 1, "override", "explicit-stress"), ("dominus", "do mi nus", {}, 0, "lexicon", "stress-lexicon"),
    ("fabula", "fa bu la", {"lexicon": {"fabula": (("fa", "bu", "la"), 1, ("x",), True)}}, 1, "exception", "stress-exception"), ("dominusque", "do mi nus que", {}, 2, "rule", "enclitic-stress"),
    ("fabulaque", "fa bu la que", {"lexicon": {}}, 1, "candidate", "candidate-antepenult-stress"), ("pax", "pax", {}, 0, "rule", "monosyllable-stress"), ("sanctus", "sanc tus", {}, 0, "rule", "disyllable-stress"),
    ("unlisted", "a mā re", {}, 1, "rule", "heavy-penult-stress"), ("unlisted", "a aē re", {}, 1, "rule", "heavy-penult-stress"), ("unlisted", "a dic re", {}, 1, "rule", "heavy-penult-stress"), ("unlisted", "a aë re", {}, 0, "candidate", "candidate-antepenult-stress"),
]


@pytest.mark.parametrize(("key", "syllables", "more", "index", "method", "rule"), STRESS)
def test_stress(key, syllables, more, index, method, rule):
    got = latin.stress(key, syllables.split(), more.get("explicit"), more.get("override"), more.get("lexicon"))
    assert got[:3] == (index, method, [rule]) and got[4] == (method == "candidate")


def test_normalization():
    assert latin.tokenize("Cælum et cœli") == [("Cælum", 0, 5), ("et", 6, 8), ("cœli", 9, 13)]
    assert [(a, b) for _, a, b in latin.tokenize("Ave, cælum!")] == [(0, 3), (5, 10)] and latin.tokenize("́a1b") == [("a", 1, 2), ("b", 3, 4)]
    assert latin.normalize_word("Dóminus")[::2] == ("dominus", 1) and latin.normalize_word("ǽ")[::2] == ("ae", 1) and latin.normalize_word("ǣ")[::2] == ("aē", None)
    assert latin.normalize_word("œ̈")[0] == "oë" and latin.normalize_word("Cælum")[3] == ["casefold", "expand-ae-ligature"]
    assert latin.normalize_word("jam")[0] != latin.normalize_word("iam")[0] and latin.lookup_key("jam") == latin.lookup_key("iam") and latin.lookup_key("aër") == "aër"
    assert latin.normalize_phrase("  Ave\tMaria,\n  gratia. ") == "Ave Maria, gratia."


def test_tables():
    assert len(latin.LEXICON) == 45 and len(T.PHONEMES) == 29 and len(T.RULE_IDS) == 45 and len(T.SOURCES) == 8 and len(T.RULES) == 18


def test_overrides():
    a = latin.analyze_word
    assert a("Dominus", {"stress_index": 1})["ipa"] == "doˈmi.nus" and a("Domínus", {"stress_index": 2})["stress_index"] == 2
    assert a("Domínus")["ipa"] == "doˈmi.nus" and a("Domínus")["rule_ids"][0] == "explicit-stress"
    assert a("Dominus", {"ipa": "doˈmi.nus", "phonemes": "d o . ˈ m i . n u s".split()})["error_code"] == "OVERRIDE_STRESS_DIFFERS"
    full = a("Ave", {"ipa": "ˈo.i", "phonemes": ["ˈ", "o", ".", "i"]})
    assert full["rule_ids"] == ["disyllable-stress"] and full["method"] == "override" and full["ipa"] == "ˈo.i"
    assert a("Ave", {})["error_code"] == "EMPTY_OVERRIDE" and a("Ave", {"ipa": "x"})["error_code"] == "OVERRIDE_IPA_WITHOUT_PHONEMES"
    assert a("Ave", {"ipa": "ˈo.i", "phonemes": ["ˈ", "o", ".", "w!"]})["error_code"] == "OVERRIDE_UNKNOWN_PHONEME"
    assert a("www")["error_code"] == "NO_VOWEL_NUCLEUS" and a("wave")["error_code"] == "UNSUPPORTED_GRAPHEME"


def test_plans(spark):
    docs = spark.createDataFrame([(1, "Ave  Maria, gratia."), (2, ""), (3, None), (4, "fabulas wa amet"), (5, "Dominus")], "id long, text string")
    fixes = spark.createDataFrame([(5, 0, 1, None, None), (2, 0, 1, None, None)], "id long, token_index int, stress_index int, ipa string, phonemes array<string>")
    got = {r.id: r for r in pronunciation.analyze(docs, "id", overrides=fixes).collect()}
    assert " ".join(got[1].phrase_phonemes) == "ˈ a . v e | m a . ˈ r i . a | ˈ ɡ r a . t͡s i . a" and got[1].normalized_text == "Ave Maria, gratia."
    assert [(t.surface, t.start, t.end) for t in got[1].tokens] == [("Ave", 0, 3), ("Maria", 5, 10), ("gratia", 12, 18)]
    assert got[2].tokens == [] and got[2].error_code == "OVERRIDE_UNKNOWN_TOKEN" and got[3].tokens == [] and got[3].error_code is None
    assert got[4].error_code == "UNSUPPORTED_GRAPHEME" and [w.token_index for w in got[4].warnings] == [0]
    assert got[5].tokens[0].ipa == "doˈmi.nus" and got[5].tokens[0].method == "override"
    stored = pronunciation.seven_fields(pronunciation.analyze(docs, "id"), "id")
    assert len(stored.columns) == 8 and len(stored.schema["tokens"].dataType.elementType) == 10
    with pytest.raises(Exception, match="UNSUPPORTED_GRAPHEME"):
        pronunciation.analyze(docs, "id", strict=True).collect()
    assert pronunciation.unknown_sources(pronunciation.lexicon_frame(spark)).count() == 0


def test_surfaces_agree_with_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(100)
    a = pronunciation.tokens(docs, "doc_id").collect()
    b = pronunciation.tokens(docs, "doc_id", spans=True).select("doc_id", "token_index", "surface").collect()
    assert sorted(a) == sorted(b) and a and not re.search(r"\d", a[0].surface)


def test_offsets_of_many_words_fit_a_small_worker(spark, tmp_path, monkeypatch):
    # A batch of 10,000 texts, 4 million words: with an object for each word they would take over 1 GB
    n = 400
    spark.range(0, 10_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("verbum "), n).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setitem(spark.sparkContext.environment, "PYSPARK_EXECUTOR_MEMORY_MB", "1500")
    found = QUERIES["token_offsets"](spark, str(tmp_path)).groupBy("n_tokens", "n_right").count().collect()
    assert list(map(tuple, found)) == [(n, n, 10_000)]


@pytest.mark.parametrize("word", ["verbum ", "v\u00e9rbum "])
def test_offsets_of_one_long_text_fit_a_small_worker(spark, tmp_path, monkeypatch, word):
    # Half a million words, whose places can't each be counted from the text's start
    n = 500_000
    spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit(word), n).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setitem(spark.sparkContext.environment, "PYSPARK_EXECUTOR_MEMORY_MB", "1500")
    assert list(map(tuple, QUERIES["token_offsets"](spark, str(tmp_path)).collect())) == [(0, n, n)]


def test_offsets_count_code_points(spark):
    texts = ["a e\u0301\u0301b \U0001f600x\U0001d49cy \u03a9mega9z", None, "", "123 --", "plain text's end", "xxx\0\u00e9"]
    spans = C.word_spans(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    rows = spans.select("id", "text", "spans", C.words_in_place("text", "spans").alias("n")).collect()
    assert [[(w.surface, w.start, w.end) for w in r.spans] for r in sorted(rows)] == [latin.tokenize(t or "") for t in texts]
    assert [r.n for r in sorted(rows)] == [5, 0, 0, 0, 4, 2]
    moved = spans.withColumn("spans", F.transform("spans", lambda s: F.struct(s["surface"], s["start"] + 1, s["end"] + 1).cast("struct<surface:string,start:int,end:int>")))
    assert {r.n for r in moved.select(C.words_in_place("text", "spans").alias("n")).collect()} == {0}
