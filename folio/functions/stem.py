"""Spanish Snowball stemming, as a column expression and for whole token arrays.

The published algorithm (snowballstem.org) in terms of regular expressions: the
regions are suffix positions found by a pattern, each step removes the longest
listed ending that lies inside its region. ``stem_es`` runs no Python and suits
columns of distinct words. The tokens of running text repeat, so ``stem_tokens``
takes them by Arrow batches and works out each distinct word of a batch once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.arrays import let

# Vowels and endings of the published algorithm.
VOWELS = "aeiouáéíóúü"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
STANDARD = """
anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas
amiento amientos imiento imientos
"""
WITH_IC = "adora ador ación acion adoras adores aciones ante antes ancia ancias"
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
GU_VERBS = "en es éis emos"
VERBS = """
arían arías arán arás aríais aría aréis aríamos aremos ará aré
erían erías erán erás eríais ería eréis eríamos eremos erá eré
irían irías irán irás iríais iría iréis iríamos iremos irá iré
aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron
ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais
íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos
iésemos ásemos
"""
RESIDUAL = "os a o á í ó"


def _any(endings: str) -> str:
    """Alternation that tries longer endings first."""
    return "|".join(sorted(endings.split(), key=len, reverse=True))


def _ending(word: Column, endings: str) -> Column:
    """The longest listed ending of the word, or the empty string."""
    longest = sorted(endings.split(), key=len, reverse=True)
    return F.regexp_extract(word, rf"^.*?({'|'.join(longest)})$", 1)


def _cut(word: Column, n: Column | int) -> Column:
    count = F.lit(n) if isinstance(n, int) else n
    return F.left(word, F.length(word) - count)


def _region_size(word: Column, pattern: str) -> Column:
    """Length of what follows the pattern's match at the start of the word (0 without one)."""
    return F.length(F.regexp_extract(word, f"^(?:{pattern})(.*)$", 1))


_R1 = f".*?[{VOWELS}][^{VOWELS}]"
_R2 = f"{_R1}.*?[{VOWELS}][^{VOWELS}]"
_RV = (
    f".[^{VOWELS}].*?[{VOWELS}]"
    f"|[{VOWELS}]{{2}}.*?[^{VOWELS}]"
    f"|[^{VOWELS}][{VOWELS}]."
)


def _drop_pronoun(word: Column, rv: Column) -> Column:
    pronoun = _any(PRONOUNS)
    accented = F.regexp_extract(word, rf"^.*?(iéndo|ándo|ár|ér|ír)(?:{pronoun})$", 1)
    plain = F.regexp_extract(word, rf"^.*?(ando|iendo|ar|er|ir)(?:{pronoun})$", 1)
    after_u = F.regexp_extract(word, rf"^.*?u(yendo)(?:{pronoun})$", 1)
    found = _ending(word, PRONOUNS)

    def inside(stem_part: Column) -> Column:
        return (stem_part != "") & (F.length(stem_part) + F.length(found) <= rv)

    bare = _cut(word, F.length(found))
    return (
        F.when(
            inside(accented),
            F.concat(
                _cut(bare, F.length(accented)), F.translate(accented, "áéí", "aei")
            ),
        )
        .when(inside(plain) | inside(after_u), bare)
        .otherwise(word)
    )


def _standard_suffix(word: Column, r1: Column, r2: Column) -> Column:
    every = " ".join(
        [STANDARD, WITH_IC, "logía logías ución uciones encia encias"]
        + ["amente mente idad idades iva ivo ivas ivos"]
    )

    def cut_found(found: Column) -> Column:
        size = F.length(found)
        in_r2 = size <= r2
        bare = _cut(word, size)

        def then_drop(pattern: str) -> Column:
            """The bare word without a second ending that also lies in R2."""
            second = F.regexp_extract(bare, f"({pattern})$", 1)
            return F.when(
                (second != "") & (size + F.length(second) <= r2), _cut(bare, F.length(second))
            ).otherwise(bare)

        # after -amente: iv (and then at), or one of os, ic, ad
        iv = bare.endswith("iv") & (size + 2 <= r2)
        amente = (
            F.when(iv & bare.endswith("ativ") & (size + 4 <= r2), _cut(bare, 4))
            .when(iv, _cut(bare, 2))
            .otherwise(then_drop("os|ic|ad"))
        )
        return (
            F.when(found == "", word)
            .when(found == "amente", F.when(size <= r1, amente).otherwise(word))
            .when(~in_r2, word)
            .when(found.isin(*WITH_IC.split()), then_drop("ic"))
            .when(found.isin("logía", "logías"), F.concat(bare, F.lit("log")))
            .when(found.isin("ución", "uciones"), F.concat(bare, F.lit("u")))
            .when(found.isin("encia", "encias"), F.concat(bare, F.lit("ente")))
            .when(found == "mente", then_drop("ante|able|ible"))
            .when(found.isin("idad", "idades"), then_drop("abil|ic|iv"))
            .when(found.isin("iva", "ivo", "ivas", "ivos"), then_drop("at"))
            .otherwise(bare)
        )

    return let(_ending(word, every), cut_found)


def _verb_suffix(word: Column, rv: Column) -> Column:
    region = F.when(rv > 0, F.right(word, rv)).otherwise(F.lit(""))
    y_end = _ending(region, Y_VERBS)
    verb = _ending(region, f"{VERBS} {GU_VERBS}")
    y_cut = _cut(word, F.length(y_end))
    cut = _cut(word, F.length(verb))
    return (
        F.when((y_end != "") & y_cut.endswith("u"), y_cut)
        .when(verb == "", word)
        .when(verb.isin(*GU_VERBS.split()) & cut.endswith("gu"), _cut(cut, 1))
        .otherwise(cut)
    )


def _residual_suffix(word: Column, rv: Column) -> Column:
    region = F.when(rv > 0, F.right(word, rv)).otherwise(F.lit(""))
    ending = _ending(region, RESIDUAL)
    bare = _cut(word, 1)
    return (
        F.when(ending != "", _cut(word, F.length(ending)))
        .when(region.rlike("[eé]$"), F.when(bare.endswith("gu") & (rv >= 2), _cut(bare, 1)).otherwise(bare))
        .otherwise(word)
    )


def stem_es(token: Column) -> Column:
    """Stem of one Spanish word."""

    def with_regions(word: Column) -> Column:
        def steps(sizes: Column) -> Column:
            r1, r2, rv = sizes["r1"], sizes["r2"], sizes["rv"]
            total = F.length(word)

            def left_in(region: Column, current: Column) -> Column:
                """What is still left of a region after endings were cut."""
                return F.greatest(region - (total - F.length(current)), F.lit(0))

            def after_pronoun(w0: Column) -> Column:
                def after_standard(w1: Column) -> Column:
                    w2 = F.when(w1 != w0, w1).otherwise(_verb_suffix(w0, left_in(rv, w0)))
                    return let(w2, lambda w: _residual_suffix(w, left_in(rv, w)))

                return let(
                    _standard_suffix(w0, left_in(r1, w0), left_in(r2, w0)), after_standard
                )

            return let(_drop_pronoun(word, rv), after_pronoun)

        sizes = F.struct(
            _region_size(word, _R1).alias("r1"),
            _region_size(word, _R2).alias("r2"),
            _region_size(word, _RV).alias("rv"),
        )
        return let(sizes, steps)

    return F.translate(let(F.lower(token), with_regions), "áéíóú", "aeiou")


# ---------------------------------------------------------------- the same steps on one Python string

CACHED_WORDS = 1 << 18  # stems a Python worker remembers


def _pattern_size(pattern: str):
    found = re.compile(f"(?:{pattern})(.*)$")

    def size(word: str) -> int:
        match = found.match(word)
        return len(match[1]) if match else 0

    return size


def _longest(endings: str):
    by_size = sorted(set(endings.split()), key=len, reverse=True)
    listed, sizes = frozenset(by_size), sorted({len(e) for e in by_size}, reverse=True)
    return lambda word: next((word[-n:] for n in sizes if n <= len(word) and word[-n:] in listed), "")


_SIZES = tuple(_pattern_size(p) for p in (_R1, _R2, _RV))
_PRONOUN = _longest(PRONOUNS)
_ACCENTED_FORM = re.compile(rf"^.*?(iéndo|ándo|ár|ér|ír)(?:{_any(PRONOUNS)})$")
_PLAIN_FORM = re.compile(rf"^.*?(ando|iendo|ar|er|ir)(?:{_any(PRONOUNS)})$")
_U_FORM = re.compile(rf"^.*?u(yendo)(?:{_any(PRONOUNS)})$")
_SUFFIX = _longest(
    " ".join(
        [STANDARD, WITH_IC, "logía logías ución uciones encia encias"]
        + ["amente mente idad idades iva ivo ivas ivos"]
    )
)
_IC, _YVERB, _VERB, _RESIDUE = frozenset(WITH_IC.split()), _longest(Y_VERBS), _longest(f"{VERBS} {GU_VERBS}"), _longest(RESIDUAL)
_PLAIN_VOWELS = str.maketrans("áéíóú", "aeiou")


def _short(word: str, n: int) -> str:
    return word[: max(len(word) - n, 0)]


def _pronoun_step(word: str, rv: int) -> str:
    found = _PRONOUN(word)
    bare = _short(word, len(found))
    accented, plain, after_u = ((m[1] if (m := form.match(word)) else "") for form in (_ACCENTED_FORM, _PLAIN_FORM, _U_FORM))
    if accented and len(accented) + len(found) <= rv:
        return _short(bare, len(accented)) + accented.translate(_PLAIN_VOWELS)
    if any(part and len(part) + len(found) <= rv for part in (plain, after_u)):
        return bare
    return word


def _suffix_step(word: str, r1: int, r2: int) -> str:
    found = _SUFFIX(word)
    size = len(found)
    bare = _short(word, size)

    def then_drop(*endings: str) -> str:
        second = max((e for e in endings if bare.endswith(e)), key=len, default="")
        return _short(bare, len(second)) if second and size + len(second) <= r2 else bare

    if not found:
        return word
    if found == "amente":
        if size > r1:
            return word
        if bare.endswith("iv") and size + 2 <= r2:
            return _short(bare, 4 if bare.endswith("ativ") and size + 4 <= r2 else 2)
        return then_drop("os", "ic", "ad")
    if size > r2:
        return word
    if found in _IC:
        return then_drop("ic")
    if found in ("logía", "logías"):
        return bare + "log"
    if found in ("ución", "uciones"):
        return bare + "u"
    if found in ("encia", "encias"):
        return bare + "ente"
    if found == "mente":
        return then_drop("ante", "able", "ible")
    if found in ("idad", "idades"):
        return then_drop("abil", "ic", "iv")
    if found in ("iva", "ivo", "ivas", "ivos"):
        return then_drop("at")
    return bare


def _verb_step(word: str, rv: int) -> str:
    region = word[-rv:] if rv > 0 else ""
    y_end, verb = _YVERB(region), _VERB(region)
    y_cut, cut = _short(word, len(y_end)), _short(word, len(verb))
    if y_end and y_cut.endswith("u"):
        return y_cut
    if not verb:
        return word
    return _short(cut, 1) if verb in GU_VERBS.split() and cut.endswith("gu") else cut


def _residual_step(word: str, rv: int) -> str:
    region = word[-rv:] if rv > 0 else ""
    ending, bare = _RESIDUE(region), _short(word, 1)
    if ending:
        return _short(word, len(ending))
    if region.endswith(("e", "é")):
        return _short(bare, 1) if bare.endswith("gu") and rv >= 2 else bare
    return word


@lru_cache(CACHED_WORDS)
def stem_word(token: str) -> str:
    """Stem of one Spanish word; what ``stem_es`` gives."""
    word = token.lower()
    r1, r2, rv = (size(word) for size in _SIZES)

    def left_in(region: int, current: str) -> int:
        return max(region - (len(word) - len(current)), 0)

    w0 = _pronoun_step(word, rv)
    w1 = _suffix_step(w0, left_in(r1, w0), left_in(r2, w0))
    w2 = w1 if w1 != w0 else _verb_step(w0, left_in(rv, w0))
    return _residual_step(w2, left_in(rv, w2)).translate(_PLAIN_VOWELS)


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stems of an array of tokens."""
    words = tokens.flatten().dictionary_encode()
    stems = pa.array([None if w is None else stem_word(w) for w in words.dictionary.to_pylist()], pa.string())
    offsets = pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int32()), tokens.value_lengths().fill_null(0)]))
    return pa.ListArray.from_arrays(offsets, stems.take(words.indices), mask=tokens.is_null() if tokens.null_count else None)
