"""Sentence splitting by rules, as array expressions without loss.

A normalised text is cut at white space after closing punctuation; cuts after
abbreviations, initials and dotted acronyms are mended. Joined with a space, the
sentences give the text again; were that ever to fail, the text is one sentence.
"""

from __future__ import annotations

from functools import lru_cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import once

#: Abbreviations that never end a sentence (all languages, then each).
COMMON = "cf. vs. Vs. e.g. E.g. i.e. I.e. Ph.D. PhD. et. Fig. fig. Figs. figs. Tab. tab. Ref. ref. Refs. op. cit. loc. p. pp. ed. eds. Ed. vol. Vol. vols. cap. caps. núm. no. No. nº. n. Dr. Dra. Drs. Prof. Profa. Sr. Sra. St. Univ. Dept. Corp."
OWN = {
    "es": "Art. art. arts. Arts. Núm. nro. Nro. pág. págs. Pág. Sres. Srta. Dres. Ing. Lic. Mtro. Mtra. Av. Avda. Ud. Uds. Vd. Vds. máx. mín. aprox. ss. sig. sigs. ej. p.ej. EE.UU. RR.HH. Gral. Cnel. Cap. izq. der. Ltda. Cía. admón. dcha.",
    "en": "Mr. Mrs. Ms. Jr. Gen. Col. Lt. Sen. Rep. Gov. Adm. Capt. Ave. Rd. Blvd. Jan. Feb. Mar. Apr. Jun. Jul. Aug. Sep. Sept. Oct. Nov. Dec. U.S. U.K. U.N. E.U. approx. est. esp. incl. min. max. Eq. Sec. Ch. Chap.",
    "pt": "Art. art. arts. Arts. n.º nº núm. pág. págs. Pág. séc. sécs. Séc. Eng. Engª. Engo. Av. Avª. Ex. ex. p.ex. Ltda. Cia. Cª. E.U.A. U.E. aprox. máx. mín. ed. Exmo. Exma. Prof.ª refª.",
}
#: Abbreviations that may end one, where an upper-case letter follows.
AMBIGUOUS = "etc. al. Inc. Ltd. Ltda. Co. Cia. Cía. S.A. Corp."

#: After closing punctuation; after a closing mark behind it only before an upper-case letter or an opening mark.
_CUT = r"(?<=[.!?…])\s+|(?<=[.!?…][\"'»”’\)\]])\s+(?=[\p{Lu}¿¡«\"“‘])"
#: Stands between sentences while they are one string; normalised text has no controls.
_MARK = "\x01"


def pieces(clean: Column) -> Column:
    """The stretches between raw cuts."""
    return F.filter(F.split(clean, _CUT), lambda p: p != "")


def is_false_cut(left: Column, right: Column, language: str = "es") -> Column:
    """Whether the text between the piece ``left`` and the next one, ``right``, runs on."""
    never = sorted(set(f"{COMMON} {OWN.get(language, OWN['es'])}".split()) - set(AMBIGUOUS.split()))
    lower, upper = right.rlike(r"^\p{Ll}"), right.rlike(r"^\p{Lu}")

    def judged(last: Column) -> Column:
        return (
            last.isin(never)
            | last.rlike(r"^(?:[A-ZÁÉÍÓÚÑÜÇ]{1,3}\.){2,}$|^[A-ZÁÉÍÓÚÑÜÇ]\.$")
            | F.when(last.isin(AMBIGUOUS.split()), ~upper).otherwise(lower & (~last.rlike(r"[.!?…][\"'»”’\)\]]*$") | last.rlike(r"(?:\.\.\.|…)[\"'»”’\)\]]*$")))
        )

    return once(F.substring_index(left, " ", -1), judged)


def sentences(clean: Column, language: str = "es") -> Column:
    """Sentences of a normalised text; null gives null, an empty text none.

    Each cut is judged by its two neighbours alone, so all are judged in one pass
    and the pieces are joined and cut again: linear in the text.
    """
    gap = lambda left, right: F.when(right.isNull(), F.lit("")).when(is_false_cut(left, right, language), F.lit(" ")).otherwise(F.lit(_MARK))

    def joined(p: Column) -> Column:
        return F.array_join(F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.concat(a, gap(a, b))), "")

    def cut(text: Column, marked: Column) -> Column:
        whole = F.translate(marked, _MARK, " ") == text
        return F.when(text.isNull(), F.lit(None)).when(text == "", F.array().cast("array<string>")).when(whole, F.split(marked, _MARK)).otherwise(F.array(text))

    return once(clean, lambda text: once(once(pieces(text), joined), lambda marked: cut(text, marked)))


_SPLIT = regex.compile(_CUT)
_SHAPE = regex.compile(r"^(?:[A-ZÁÉÍÓÚÑÜÇ]{1,3}\.){2,}$|^[A-ZÁÉÍÓÚÑÜÇ]\.$")
_ENDS, _TRAILS = regex.compile(r"[.!?…][\"'»”’\)\]]*$"), regex.compile(r"(?:\.\.\.|…)[\"'»”’\)\]]*$")


@lru_cache
def _never(language: str) -> frozenset[str]:
    return frozenset(f"{COMMON} {OWN.get(language, OWN['es'])}".split()) - frozenset(AMBIGUOUS.split())


def _runs_on(left: str, right: str, language: str) -> bool:
    """:func:`is_false_cut` of two pieces, for Python workers."""
    last = left.rpartition(" ")[2]
    if last in _never(language) or _SHAPE.search(last):
        return True
    if last in AMBIGUOUS.split():
        return not regex.match(r"\p{Lu}", right)
    return bool(regex.match(r"\p{Ll}", right)) and (not _ENDS.search(last) or bool(_TRAILS.search(last)))


def sentences_of(clean: str, language: str = "es") -> list[str]:
    """:func:`sentences` of one normalised text, for Python workers."""
    parts = [p for p in _SPLIT.split(clean) if p]
    out: list[list[str]] = []
    for k, p in enumerate(parts):
        if k and _runs_on(parts[k - 1], p, language):
            out[-1].append(p)
        else:
            out.append([p])
    made = [" ".join(p) for p in out]
    return made if " ".join(made) == clean else [clean]
