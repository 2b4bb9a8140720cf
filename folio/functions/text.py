"""Text normalisation as column expressions.

Only Unicode composition (NFC) and compatibility decomposition (NFKD) lack a
built-in. Both run in an Arrow pandas UDF that receives null for every text a
regular expression proves unaffected, so ordinary text never crosses to Python.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.stem import stem_tokens
from folio.functions.stopwords import STOPWORDS_ES

TAG_PATTERN = r"<[^>]+>"
# The letters that survive cleaning, and the legacy token pattern.
LETTERS = "a-záéíóúüñ"
LEGACY_TOKEN = (
    "[a-zA-ZâáàãõáêéíóôõúüÁÉÍÓÚñÑçÇ]"
    "[0-9a-zA-ZâáàãõáêéíóôõúüÁÉÍÓÚñÑçÇ]+"
)

# White space as Python's str.split and re see it (Java's \s is ASCII only).
SPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0"
    r"\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)
SPACES = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
    + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# Code points that NFC leaves alone and that never combine with a neighbour.
NFC_STABLE = (
    r"\x00-\u02FF\u0400-\u0482\u2002-\u20CF\u2100-\u2125"
    r"\u3041-\u3096\u30A1-\u30F6\u4E00-\u9FFF"
)


def _accent_table() -> tuple[str, str, str]:
    """Letters whose accents drop to one plain character, their images, and all unaffected ones."""
    source, target, same = [], [], []
    for code in range(0x80, 0x250):
        char = chr(code)
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if plain == char:
            same.append(char)
        elif len(plain) == 1:
            source.append(char)
            target.append(plain)
    return "".join(source), "".join(target), "".join(same)


def _ranges(chars: str) -> str:
    """Character class body of the characters, runs merged to ranges."""
    codes = sorted(map(ord, chars))
    starts = [c for c in codes if c - 1 not in set(codes)]
    ends = [c for c in codes if c + 1 not in set(codes)]
    return "".join(f"\\u{a:04X}-\\u{b:04X}" for a, b in zip(starts, ends))


_ACCENTED, _PLAIN, _UNACCENTED = _accent_table()
# ASCII, the letters of the table, and dashes, quotes, bullets that NFKD keeps
_NFKD_SIMPLE = (
    r"\x00-\x7F\u2010\u2012-\u2016\u2018-\u201F\u2020-\u2023\u2030-\u2032\u20AC"
    + _ranges(_ACCENTED + _UNACCENTED)
)

# One-range tests that clear most texts before the exact classes are tried.
_BEYOND_LATIN = r"[\u0300-\x{10FFFF}]"
_BEYOND_LATIN1 = r"[\xBC-\xBE\u0100-\x{10FFFF}]"


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def _nfkd_plain(texts: pd.Series) -> pd.Series:
    def plain(text: str) -> str:
        return "".join(
            c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)
        )

    return texts.map(plain, na_action="ignore")


def trim_spaces(text: Column) -> Column:
    """Strip every kind of Unicode white space (``trim`` strips blanks only)."""
    return F.btrim(text, F.lit(SPACES))


def strip_html_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG_PATTERN, " ")


def normalize_nfc(text: Column) -> Column:
    unstable = text.rlike(_BEYOND_LATIN) & text.rlike(f"[^{NFC_STABLE}]")
    return F.coalesce(_nfc(F.when(unstable, text)), text)


def lowercase(text: Column) -> Column:
    return F.lower(text)


def remove_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks (ñ becomes n)."""
    special = F.when(text.rlike(_BEYOND_LATIN1) & text.rlike(f"[^{_NFKD_SIMPLE}]"), text)
    return F.coalesce(_nfkd_plain(special), F.translate(text, _ACCENTED, _PLAIN))


def keep_letters(text: Column) -> Column:
    """Everything but lower-case Spanish letters and white space becomes a blank."""
    return F.regexp_replace(text, rf"[^{LETTERS}{SPACE_CLASS}]", " ")


def _non_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def tokenize_ws(text: Column) -> Column:
    return _non_empty(F.split(text, f"[{SPACE_CLASS}]+"))


def drop_stopwords(tokens: Column, stopwords: Sequence[str] = STOPWORDS_ES) -> Column:
    words = list(stopwords)
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def tokenize_regex(text: Column, pattern: str = LEGACY_TOKEN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def tokenize_min2(text: Column) -> Column:
    """Vectoriser tokens of any text: lower case, word runs of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def clean_tokens(
    text: Column,
    *,
    lowercase: bool = True,
    strip_html: bool = True,
    remove_punct: bool = True,
    stopwords: Sequence[str] | None = STOPWORDS_ES,
    stem: bool = False,
    strip_accents: bool = False,
    nfc: bool = True,
) -> Column:
    """The cleaning chain up to its token array; ``stopwords=None`` keeps all tokens.

    ``nfc=False`` skips composition for text known to be composed already.
    """
    if strip_html:
        text = strip_html_tags(text)
    if nfc:
        text = normalize_nfc(text)
    if lowercase:
        text = F.lower(text)
    if strip_accents:
        text = remove_accents(text)
    if remove_punct:
        # white space and dropped characters both only separate tokens: one pass does for both
        tokens = _non_empty(F.split(F.regexp_replace(text, f"[^{LETTERS}]+", " "), " "))
    else:
        tokens = tokenize_ws(text)
    if stopwords:
        tokens = drop_stopwords(tokens, stopwords)
    if stem:
        tokens = stem_tokens(tokens)
    return tokens


def clean_text(text: Column, **flags) -> Column:
    return F.array_join(clean_tokens(text, **flags), " ")


def vectorizer_terms(tokens: Column) -> Column:
    """The vectoriser's view of cleaned tokens: one-letter tokens never enter a vocabulary."""
    return F.filter(tokens, lambda t: F.length(t) >= 2)


def first_non_blank(*values: Column) -> Column:
    """First value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def embed_text(title: Column, subtitle: Column, body: Column, body_chars: int = 200) -> Column:
    """Short text for sentence encoders; empty parts still leave their separators."""
    blank = F.lit("")
    return trim_spaces(
        F.concat(
            F.coalesce(title, blank),
            F.lit(". "),
            F.coalesce(subtitle, blank),
            F.lit(". "),
            F.left(F.coalesce(body, blank), F.lit(body_chars)),
        )
    )
