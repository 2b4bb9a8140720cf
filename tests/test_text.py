import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from folio.evaluation.descriptive import preprocess
from folio.functions import text as tx
from folio.functions.stem import stem_es
from folio.functions.stopwords import STOPWORDS_ES, STOPWORDS_ES_PLAIN


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


TEXTS = [
    None,
    "",
    "   \t\n",
    "Y a o u",
    "El <b>Niño</b> comió pan 123",
    "tag <a\nhref='x'>text</a> and < unclosed",
    "de la que por",
    "Café con piña",
    "QUÉ TAL ¿Señor?",
    "ﬁn Ångström Ω ½ “quoted” …",
    "a b c d\x1ce",
]


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def expected_clean(text, lowercase=True, html=True, punct=True, stop=True, accents=False):
    if html:
        text = re.sub(r"<[^>]+>", " ", text)
    text = unicodedata.normalize("NFC", text)
    if lowercase:
        text = text.lower()
    if accents:
        text = plain(text)
    if punct:
        text = re.sub(r"[^a-záéíóúüñ\s]", " ", text)
    return " ".join(t for t in text.split() if not (stop and t in STOPWORDS_ES))


def test_nfc_and_accents_match_unicodedata(spark):
    assert apply(spark, TEXTS, tx.normalize_nfc) == [
        None if t is None else unicodedata.normalize("NFC", t) for t in TEXTS
    ]
    assert apply(spark, TEXTS, tx.remove_accents) == [None if t is None else plain(t) for t in TEXTS]


def test_nfc_guard_covers_every_unstable_character():
    stable = re.compile(f"[{tx.NFC_STABLE}]")
    composing = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            composing.add(chr(int(parts[1], 16)))
    for code in [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]:
        char = chr(code)
        if stable.match(char):
            assert unicodedata.normalize("NFC", char) == char, hex(code)
            assert unicodedata.combining(char) == 0, hex(code)
            assert char not in composing, hex(code)


def test_nfkd_guard_is_exact():
    simple = re.compile(f"[{tx._NFKD_SIMPLE}]")
    table = dict(zip(tx._ACCENTED, tx._PLAIN))
    for code in [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]:
        char = chr(code)
        if simple.match(char):
            assert plain(char) == table.get(char, char), hex(code)


@pytest.mark.parametrize(
    "flags,python",
    [
        ({}, {}),
        ({"stopwords": None}, {"stop": False}),
        ({"lowercase": False}, {"lowercase": False}),
        ({"strip_accents": True}, {"accents": True}),
        ({"remove_punct": False}, {"punct": False}),
        ({"strip_html": False}, {"html": False}),
    ],
)
def test_clean_text_matches_python(spark, flags, python):
    want = [None if t is None else expected_clean(t, **python) for t in TEXTS]
    assert apply(spark, TEXTS, lambda c: tx.clean_text(c, **flags)) == want


def test_keep_letters_drops_capitals(spark):
    assert apply(spark, ["Ab1"], tx.keep_letters) == [" b "]


def test_preprocess_counts(spark):
    rows = preprocess(spark.createDataFrame([(1, None), (2, "Sol y luna"), (3, "de la")], "id int, body string"))
    got = {r.id: (r.text_clean, r.n_tokens, r.n_chars) for r in rows.collect()}
    # one-letter tokens count here but never enter a vocabulary
    assert got == {1: ("", 0, 0), 2: ("sol y luna", 3, 10), 3: ("", 0, 0)}


def test_stopword_lists():
    assert len(STOPWORDS_ES) == len(set(STOPWORDS_ES)) > 150
    assert "algún" in STOPWORDS_ES and "por qué" in STOPWORDS_ES and "y" not in STOPWORDS_ES
    assert "tambien" in STOPWORDS_ES_PLAIN and "ese" in STOPWORDS_ES_PLAIN


def test_stems_of_the_published_samples(spark):
    pairs = {
        "chicharrones": "chicharron", "cheque": "chequ", "chica": "chic", "chilena": "chilen",
        "torre": "torr", "torneo": "torne", "torturadas": "tortur", "toreándolo": "tor",
        "trabajando": "trabaj", "rápidamente": "rapid", "naciones": "nacion", "nación": "nacion",
        "políticas": "polit", "economía": "econom", "habilidad": "habil", "biología": "biolog",
        "constitución": "constitu", "comérselas": "com", "construyeron": "constru", "sol": "sol", "": "",
        "pague": "pag", "tenencia": "tenenci", "existencia": "existent",
    }
    got = dict(zip(pairs, apply(spark, list(pairs), stem_es)))
    assert got == pairs


def test_regex_tokens(spark):
    assert apply(spark, ["a ab Ñandú x1 9z é"], tx.tokenize_regex) == [["ab", "Ñandú", "x1"]]
    assert apply(spark, ["A Bc ñu"], tx.tokenize_min2) == [["bc", "ñu"]]


def test_embed_text_keeps_separators(spark):
    df = spark.createDataFrame([(None, "", "x" * 300)], "a string, b string, c string")
    assert df.select(tx.embed_text(F.col("a"), F.col("b"), F.col("c"))).first()[0] == ". . " + "x" * 200
