"""Text scalars as column expressions; none needs a Python worker but those marked."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Shapes of lines that only number pages.
PAGE_NOISE = (
    r"^[\s\-–—_.]*\d+[\s\-–—_.]*$",
    r"^p[aá]g(?:ina)?\.?\s*\d+(?:\s*(?:de|of|/)\s*\d+)?$",
    r"^page\s*\d+(?:\s*(?:of|/)\s*\d+)?$",
    r"^\d+\s*/\s*\d+$",
)
#: Shapes of values that say nothing even beside their column.
OPAQUE = (
    r"^(?:https?://|www\.)\S+$",
    r"^\S+@\S+\.\S+$",
    r"^[0-9a-f]{16,}$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^\S*/\S*\.\w{2,5}$",
)
#: Further shapes of values that are no text when they stand alone.
NOT_TEXT = OPAQUE + (
    r"^10\.\d{4,9}/\S+$",
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?(?:Z|[+-]\d{2}:?\d{2})?)?$",
    r"^[\d\s.,:%+\-/()]*$",
    r"^\W+$",
)
#: Function words by language, in the order that breaks ties.
FUNCTION_WORDS = {
    "es": "el la los las un una unos unas de del que y en por con para se su sus al lo como más pero ya este esta estos estas entre cuando muy sin sobre también hasta hay donde desde todo todos nos ni contra ese esa eso antes después mientras porque aunque cada otro otra otros otras fue son ser está están había",
    "en": "the of and to in a is that for it with as was on are by this from or an which you have has not but at were their they we can all been more when there if no one its also over last three years during each other than then them these those",
    "pt": "o a os as um uma uns umas de do da dos das que e em no na nos nas por com para se ao aos à às não mais mas como ou pelo pela pelos pelas seu sua seus suas foi são ser está estão havia entre quando muito sem sobre também até onde desde cada",
}
#: Least length for a language guess, words to tokens, default language.
LEAST_FOR_LANGUAGE, TOKENS_PER_WORD, DEFAULT_LANGUAGE = 20, 1.6, "es"
#: Articles that a name loses, and the marks at its ends.
ARTICLES = "el la los las un una unos unas o a os as um uma the an".split()
NAME_EDGES = "\"'“”‘’()[]{}.,;:!¡?¿-–—…«»|/\\ \t\n"


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once a row, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _compositions() -> tuple[str, str, str]:
    """By rule from the character database: pairs that compose, as JSON; characters that stand for another one, and those."""
    pairs, old, new = {}, "", ""
    for code in range(0xC0, 0x3000):
        c = chr(code)
        parts = unicodedata.decomposition(c).split()
        if not parts or parts[0].startswith("<"):
            continue
        if len(parts) == 1:
            old, new = old + c, new + unicodedata.normalize("NFC", c)
        elif unicodedata.normalize("NFC", c) == c:
            pairs["".join(chr(int(x, 16)) for x in parts)] = c
    return json.dumps(pairs), old, new


def _among(chars: str, also: str = "", since: int = 0) -> str:
    """A class of characters and of classes ``also``, none below ``since``: most characters are done with one comparison."""
    return rf"[\x{{{since or min(map(ord, chars)):x}}}-\x{{10ffff}}&&[{also}{chars}]]"


_PAIRS, _SINGLE, _SINGLE_NEW = _compositions()
_COMPOSABLE = _among(_SINGLE, r"\p{M}", 0x300)  # the first mark


def composed(text: Column) -> Column:
    """NFC of letters and marks below U+3000 in their usual order; three marks on one letter at most.

    Each distinct pair of a text is looked up once. Spark has no such function, and
    calls by reflection count as random. Conjoining jamo stay apart.
    """
    table = F.from_json(F.lit(_PAIRS), "map<string,string>")  # folded to a literal
    met = lambda t: F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?s)(.\p{M})"), F.lit(1)))
    step = lambda t: F.aggregate(met(t), t, lambda done, pair: F.replace(done, pair, F.coalesce(F.element_at(table, pair), pair)))
    return once(F.translate(text, _SINGLE, _SINGLE_NEW), lambda t: once(step(t), lambda u: once(step(u), step)))


def normalised(text: Column) -> Column:
    """Canonical text: any white space to one space, controls and invisibles out, trimmed, NFC.

    Null stays null. Texts without marks and without characters that stand for
    another one are composed as they are and skip that step.
    """
    # Plain spaces and runs of one match nothing, so most texts are scanned and left as they are.
    spaced = F.regexp_replace(text, r"[\t\n\r\f\x0B\p{Zs}\p{Zl}\p{Zp}&&[^ ]]", " ")
    clean = F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[\p{Cc}\p{Cf}]", ""), "  +", " "))
    return F.when(text.rlike(_COMPOSABLE), composed(clean)).otherwise(clean)


def is_short(text: Column, least: int) -> Column:
    """Whether a text has under ``least`` characters once normalised; a null one is empty.

    No letter or digit goes by normalising, so texts that have enough of them near
    their start are done with that.
    """
    enough = F.substring(text, 1, 16 * least).rlike(rf"(?:[\p{{L}}\p{{N}}][^\p{{L}}\p{{N}}]*+){{{least}}}")
    return F.when(enough, F.lit(False)).otherwise(F.length(F.coalesce(normalised(text), F.lit(""))) < least)


@F.pandas_udf(StringType())
def document_id(source: pd.Series) -> pd.Series:
    """The 64-bit BLAKE2b of a source name in hex, in Python workers."""
    return source.map(lambda s: None if s is None else hashlib.blake2b(s.encode(), digest_size=8).hexdigest())


def _any(text: Column, patterns: tuple[str, ...], flags: str) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | text.rlike(flags + p)
    return out


def is_useful(text: Column) -> Column:
    return F.coalesce(F.length(normalised(text)) > 0, F.lit(False))


def is_page_noise(text: Column) -> Column:
    """Empty once normalised, or a page number by shape."""
    return once(F.coalesce(normalised(text), F.lit("")), lambda clean: (clean == "") | _any(clean, PAGE_NOISE, "(?iuU)"))


def is_natural(text: Column) -> Column:
    """Has a letter and none of the shapes of lone identifiers."""
    return once(F.coalesce(normalised(text), F.lit("")), lambda clean: clean.rlike(r"\p{L}") & ~_any(clean, NOT_TEXT, "(?iuU)"))


def is_opaque(value: Column) -> Column:
    """Says nothing even with its column name; numbers and dates do."""
    return once(F.coalesce(normalised(value), F.lit("")), lambda clean: (clean == "") | _any(clean, OPAQUE, "(?iuU)"))


def serialised(*columns: tuple[str, Column]) -> Column:
    """A row as ``name: value | name: value``, without opaque values and empty names."""
    pairs = [F.when(~is_opaque(v), F.concat(F.lit(" ".join(n.split()) + ": "), normalised(v))) for n, v in columns if n.strip()]
    return F.concat_ws(" | ", *pairs)


def word_count(text: Column) -> Column:
    """Words of a normalised text; 0 for an empty or null one. Runs of spaces part words, as one does."""
    single = F.regexp_replace(text, "  +", " ")
    gaps = once(single, lambda t: F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))))
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(gaps + 1).cast("long")


def estimated_tokens(words: Column) -> Column:
    return F.ceil(words * F.lit(TOKENS_PER_WORD)).cast("long")


def fragment_id(doc: Column, position: Column) -> Column:
    return F.concat(doc.cast("string"), F.lit("-c"), F.format_string("%04d", position.cast("long")))


def document_of_fragment(fragment: Column) -> Column:
    """The document of a fragment id; raises on another form."""
    found = F.regexp_extract(fragment, r"^(.+)-c\d{4,}$", 1)
    return F.when(found == "", F.raise_error(F.concat(F.lit("not a fragment id: "), fragment))).otherwise(found)


def function_word_language(text: Column, default: str = DEFAULT_LANGUAGE) -> Column:
    """The language with most function words; ties in stated order; none: the default."""

    def picked(clean: Column, hits: Column) -> Column:
        most = F.greatest(*(hits[k] for k in FUNCTION_WORDS))
        pick = F.when((most == 0) | (F.length(clean) < LEAST_FOR_LANGUAGE), F.lit(default))
        for k in FUNCTION_WORDS:
            pick = pick.when(hits[k] == most, F.lit(k))
        return F.coalesce(pick, F.lit(default))

    def counted(words: Column) -> Column:
        among = lambda v: F.size(F.filter(words, lambda w: w.isin(sorted(set(v.split())))))
        return F.struct(*(among(v).alias(k) for k, v in FUNCTION_WORDS.items()))

    def judged(clean: Column) -> Column:
        words = F.regexp_extract_all(F.lower(clean), F.lit(r"([\p{L}]+)"), F.lit(1))
        return once(once(words, counted), lambda hits: picked(clean, hits))

    return F.coalesce(once(normalised(text), judged), F.lit(default))


def _accents() -> tuple[str, str]:
    """Every Latin letter that decomposes into a letter and marks, and that letter."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def without_accents(text: Column) -> Column:
    """Latin letters without their marks; combining marks are dropped."""
    return F.regexp_replace(F.translate(text, *_accents()), r"\p{Mn}", "")


def entity_name(name: Column) -> Column:
    """A name without marks at its ends and without a leading article."""
    edges = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in NAME_EDGES) + "]+"
    clean = F.regexp_replace(F.trim(F.regexp_replace(name, r"(?U)\s+", " ")), f"^{edges}|{edges}$", "")
    first = F.lower(F.substring_index(clean, " ", 1))
    rest = F.regexp_replace(clean, "^[^ ]* ", "")
    return F.trim(F.when(clean.contains(" ") & first.isin(ARTICLES), rest).otherwise(clean))


def _foldings() -> tuple[str, str, dict[str, str]]:
    """By rule from the character database: lower-case characters that fold to another one, those, and what others become."""
    one, to, more = "", "", {}
    for code in range(0x80, 0x10000):
        low = chr(code).lower()
        fold = low.casefold()
        if len(low) != 1 or fold == low or 0xD800 <= code < 0xE000:
            continue
        if len(fold) == 1:
            one, to = one + low, to + fold
        else:
            more[low] = fold
    return one, to, more


_FOLD, _FOLD_NEW, _FOLD_MORE = _foldings()
_FOLDABLE = _among("".join(_FOLD_MORE))


def casefolded(text: Column) -> Column:
    """Full case folding: sharp s is ss, final sigma is sigma; few texts have characters that become several."""
    table = F.create_map(*(F.lit(x) for p in _FOLD_MORE.items() for x in p))
    several = lambda t: F.aggregate(F.array_distinct(F.regexp_extract_all(t, F.lit(f"({_FOLDABLE})"), F.lit(1))), t, lambda done, c: F.replace(done, c, F.element_at(table, c)))
    return once(F.translate(F.lower(text), _FOLD, _FOLD_NEW), lambda t: F.when(t.rlike(_FOLDABLE), several(t)).otherwise(t))


def entity_key(name: Column) -> Column:
    return casefolded(without_accents(name))


def has_doubled_glyphs(name: Column) -> Column:
    doubled = F.regexp_count(name, F.lit(r"([A-Za-zÁÉÍÓÚÑáéíóúñ])\1"))
    return (F.length(name) >= 8) & (doubled * 3 > F.length(F.replace(name, F.lit(" "), F.lit(""))))


def has_repeated_words(name: Column) -> Column:
    return name.rlike(r"(?iuU)(?<!\S)(\S+)\s+\1(?!\S)")


def context_prefix(observatory: Column, title: Column, section: Column) -> Column:
    """``observatory · title · a > b`` without its empty parts; may be empty."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.concat_ws(" · ", blank(observatory), blank(title), blank(F.array_join(section, " > ")))


def token_budget(prefix: Column, most: int = 450) -> Column:
    return F.when(prefix == "", F.lit(most)).otherwise(F.greatest(F.lit(1), F.lit(most) - estimated_tokens(word_count(prefix)))).cast("long")


def tile_bounds(zoom: Column, x: Column, y: Column) -> Column:
    """(west, south, east, north) of a web map tile in degrees, rounded to 6 places."""
    n = F.pow(F.lit(2.0), zoom)
    lon = lambda v: v / n * 360.0 - 180.0
    lat = lambda v: F.degrees(F.atan(F.sinh(F.lit(3.141592653589793) * (1.0 - 2.0 * v / n))))
    return F.struct(*(F.round(c, 6).alias(k) for k, c in (("west", lon(x)), ("south", lat(y + 1)), ("east", lon(x + 1)), ("north", lat(y)))))
