"""Fixed values of the pronunciation rules: they must equal the published ones for right results."""

from __future__ import annotations

RULE_VERSION = "ecclesiastical-roman-v1"

# Stress lexicon by lookup key: syllables, stressed syllable, sources.
LEXICON = {
    "dominus": (("do", "mi", "nus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "regina": (("re", "gi", "na"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "maria": (("ma", "ri", "a"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "gratia": (("gra", "ti", "a"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "gloria": (("glo", "ri", "a"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "kyrie": (("ky", "ri", "e"), 0, ("liber-usualis-1962",)),
    "caelum": (("cae", "lum"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "alleluia": (("al", "le", "lu", "ia"), 2, ("perseus-lewis-short", "liber-usualis-1962", "allen-greenough-accents")),
    "magnificat": (("ma", "gni", "fi", "cat"), 1, ("perseus-lewis-short", "liber-usualis-1962", "allen-greenough-accents")),
    "misericordia": (("mi", "se", "ri", "cor", "di", "a"), 3, ("perseus-lewis-short", "liber-usualis-1962", "allen-greenough-accents")),
    "benedictus": (("be", "ne", "dic", "tus"), 2, ("perseus-lewis-short", "allen-greenough-accents")),
    "excelsis": (("ex", "cel", "sis"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "anima": (("a", "ni", "ma"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "animus": (("a", "ni", "mus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "spiritus": (("spi", "ri", "tus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "oculus": (("o", "cu", "lus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "saeculum": (("sae", "cu", "lum"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "discipulus": (("dis", "ci", "pu", "lus"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "angelus": (("an", "ge", "lus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "opera": (("o", "pe", "ra"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "familia": (("fa", "mi", "li", "a"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "femina": (("fe", "mi", "na"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "formula": (("for", "mu", "la"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "tabula": (("ta", "bu", "la"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "epistula": (("e", "pis", "tu", "la"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "caritas": (("ca", "ri", "tas"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "ueritas": (("ve", "ri", "tas"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "unitas": (("u", "ni", "tas"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "uictima": (("vic", "ti", "ma"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "maximus": (("ma", "xi", "mus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "optimus": (("op", "ti", "mus"), 0, ("perseus-lewis-short", "allen-greenough-accents")),
    "humilitas": (("hu", "mi", "li", "tas"), 1, ("perseus-lewis-short", "allen-greenough-accents")),
    "eleison": (("e", "le", "i", "son"), 1, ("liber-usualis-1961-full-scan",)),
    "laudamus": (("lau", "da", "mus"), 1, ("liber-usualis-1961-full-scan",)),
    "adoramus": (("a", "do", "ra", "mus"), 2, ("liber-usualis-1961-full-scan",)),
    "omnipotens": (("om", "ni", "po", "tens"), 1, ("liber-usualis-1961-full-scan",)),
    "peccata": (("pec", "ca", "ta"), 1, ("liber-usualis-1961-full-scan",)),
    "suscipe": (("sus", "ci", "pe"), 0, ("liber-usualis-1961-full-scan",)),
    "mulieribus": (("mu", "li", "e", "ri", "bus"), 2, ("liber-usualis-1961-full-scan",)),
    "peccatoribus": (("pec", "ca", "to", "ri", "bus"), 2, ("liber-usualis-1961-full-scan",)),
    "sanctificetur": (("sanc", "ti", "fi", "ce", "tur"), 3, ("liber-usualis-1961-full-scan",)),
    "quotidianum": (("quo", "ti", "di", "a", "num"), 3, ("liber-usualis-1961-full-scan",)),
    "spiritu": (("spi", "ri", "tu"), 0, ("liber-usualis-1961-full-scan",)),
    "oremus": (("o", "re", "mus"), 1, ("liber-usualis-1961-full-scan",)),
    "confiteor": (("con", "fi", "te", "or"), 1, ("liber-usualis-1961-full-scan",)),
}
STRESS_SOURCES = ("allen-greenough-accents",)
ENCLITICS = ("que", "ne", "ve")

# Words with phonemes of their own.
G2P_EXCEPTIONS = {
    "hei": ((("e", "i̯"),), ("hei-ei-diphthong",), ("liber-usualis-1962",)),
    "mihi": ((("m", "i"), ("k", "i")), ("h-mihi-nihil",), ("liber-usualis-1962",)),
    "nihil": ((("n", "i"), ("k", "i", "l")), ("h-mihi-nihil",), ("liber-usualis-1962",)),
    "nihildum": ((("n", "i"), ("k", "i", "l"), ("d", "u", "m")), ("h-mihi-nihil",), ("liber-usualis-1962", "perseus-lewis-short")),
}

# Registered sources and their ranks.
SOURCES = {
    "liber-usualis-1962": 1,
    "liber-usualis-1961-full-scan": 1,
    "ewtn-ecclesiastical-latin": 2,
    "iveson-roman-pronunciation-1964": 2,
    "allen-greenough-accents": 2,
    "perseus-lewis-short": 2,
    "wikimedia-ecclesiastical-pronunciation": 3,
    "librivox-public-domain": 4,
}

# Rules by precedence: id, form, phonemes, places (from the match's start) that decide the syllable.
# Forms are over folded letters; a capital is a letter with a diaeresis, which breaks vowel groups.
V, FRONT, GROUP = "[aeiouyAEIOUY]", "(?=[eiyEIY]|[aAoO][eE])", "(?=[aeiouyAEIOUY])"
RULES = (
    ("xc-before-front-vowel", f"[xX]c{FRONT}", "k ʃ", (0, 1)),
    ("cc-before-front-vowel", f"cc{FRONT}", "t t͡ʃ", (0, 1)),
    ("sc-before-front-vowel", f"sc{FRONT}", "ʃ", (1,)),
    ("gn-palatal", "gn", "ɲ", (0,)),
    ("ti-before-vowel", f"(?<![sxtXT])[tT][iI]{GROUP}", "t͡s i", (0, 1)),
    ("ch-hard", "c[hH]", "k", (0,)),
    ("ph-f", "p[hH]", "f", (0,)),
    ("th-t", "[tT][hH]", "t", (0,)),
    ("qu-before-vowel", f"qu{GROUP}", "k w", (0, 1)),
    ("ngu-before-vowel", f"ngu{GROUP}", "ŋ ɡ w", (0, 1, 2)),
    ("ae-e", "ae", "e", (0,)),
    ("oe-e", "oe", "e", (0,)),
    ("au-diphthong", "au", "a u̯", (0, 1)),
    ("eu-diphthong", "eu", "e u̯", (0, 1)),
    ("ay-diphthong", "ay", "a i̯", (0, 1)),
    ("i-consonantal", f"(?<![^aeiouyAEIOUY])(?<!qu)(?<!ngu)i{GROUP}", "j", (0,)),
    ("c-before-front-vowel", f"c{FRONT}", "t͡ʃ", (0,)),
    ("g-before-front-vowel", f"g{FRONT}", "d͡ʒ", (0,)),
)
RULE_SOURCES = {"ph-f": ("iveson-roman-pronunciation-1964",)}
LETTER_SOURCES = ("liber-usualis-1962",)

# Letters with phonemes or rule ids other than their own ("simple-a" and so on).
LETTERS = {c: (c,) for c in "abdefijklmnoprstuv"} | {"c": ("k",), "g": ("ɡ",), "h": (), "q": ("k",), "x": ("k", "s"), "y": ("i",), "z": ("d͡z",)}
LETTER_RULES = {c: f"simple-{c}" for c in LETTERS} | {"c": "c-hard", "g": "g-hard", "h": "h-muted", "j": "j-consonantal", "q": "q-hard", "x": "x-ks", "y": "y-as-i", "z": "z-dz"}
PHONEMES = frozenset(p for _, _, out, _ in RULES for p in out.split()) | frozenset(p for out in LETTERS.values() for p in out)
RULE_IDS = frozenset(r[0] for r in RULES) | frozenset(LETTER_RULES.values()) | {"h-mihi-nihil", "hei-ei-diphthong"}

# Consonant pairs that begin a syllable together, and vowel groups.
ONSETS = frozenset("bl br cl cr dr fl fr gl gr pl pr tr qu gu ch ph th gn".split())
DIPHTHONGS = ("ae", "oe", "au", "eu", "ay")
MACRONS = "āēīōūȳ"
