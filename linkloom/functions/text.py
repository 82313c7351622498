"""Name, markup and accent normalisation."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.regex import strip, swap_all

# Fixed patterns: these decide the cleaned text and must not change.
ACCENT_IDIOM = (r"[{].*?[(](.*?)[)].*?[}]", "$1")  # {UMLAUT OVER (A)} becomes A
BRACKETED = (r"[(].*?[)]|[{].*?[}]", "")
NAME_PUNCTUATION = (r"[|!@#$%^&*.,(){}\"'+=_]", "")
ASSIGNEE_PUNCTUATION = (r"[-!@#$%^&*.,(){}\"']", "")
PLACE_RULES = [
    ACCENT_IDIOM,
    (r"\b[A-Z]{1,5}[-]{0,2}[0-9]+\b|\b[0-9]+?[-]{0,2}[A-Z]{1,5}\b", ""),
    (r"\b[A-Z]{1,5} ?[-]{1,2} ?[0-9]+\b|\b[0-9]+? ?[-]{1,2} ?[A-Z]{1,5}\b", ""),
    (r"[0-9]", ""),
    (r"\b[A-Z]+?[,]? +?[I]?OF ", ""),
    (r"[(].*?[)]", ""),
    (r"[.()`'#\"&]|[-]{2,}|[/][-]", ""),
    (r" *?([,|-]) *?", "$1"),
    (r"([ ,|-])[ ,|-]+", "$1"),
    (r"^[,|-]", ""),
]
ESCAPE_RUN = r"[\r\n\t\x0B\x08\f\x07 ]+"
UNDERSCORE_IDIOMS = ["<sub>&#x2014;</sub>", "<sub>-</sub>", "<sub>—</sub>"]

# Fixed patterns: what the subscript-keeping escape leaves alone.
BARE_AMPERSAND = r"(?i)&(?!(amp;|lt;|gt;))"
OPENING_OUTSIDE_SUB = r"(?i)<(?!/?sub>)"
CLOSING_OUTSIDE_SUB = r"(?i)(?<!sub)>"

# Sharp s has no capital in the rules' upper-casing.
_SHARP_S = "ß"


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition to ASCII: one-letter pairs and the longer rest."""
    source, target, longer = [], [], {}
    for point in range(128, sys.maxunicode + 1):
        letter = chr(point)
        if 0xD800 <= point <= 0xDFFF or not unicodedata.decomposition(letter):
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", letter) if ord(c) < 128)
        if len(folded) == 1:
            source.append(letter)
            target.append(folded)
        elif folded:
            longer[letter] = folded
    return "".join(source), "".join(target), longer


def _ranges(letters: str) -> str:
    """A character class of the letters as code-point ranges."""
    points = sorted(map(ord, letters))
    spans: list[list[int]] = []
    for point in points:
        if spans and point == spans[-1][1] + 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in spans)


def fold_ascii(col: Column) -> Column:
    """NFKD, then drop what is not ASCII; plain ASCII values skip the work."""
    source, target, longer = _fold_tables()
    table = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    # the intersection keeps ASCII letters from being tried against every range
    rare = rf"[\x{{80}}-\x{{10FFFF}}&&[{_ranges(''.join(longer))}]]"

    def fold(singles: Column) -> Column:
        spelled = F.array_join(
            F.transform(
                F.split(singles, ""),
                lambda c: F.when(c.rlike(r"[^\x00-\x7F]"), F.coalesce(F.element_at(table, c), c)).otherwise(c),
            ),
            "",
        )
        whole = F.when(singles.rlike(rare), spelled).otherwise(singles)
        return F.regexp_replace(whole, r"[^\x00-\x7F]+", "")

    # a lambda names the translated text, which is then computed once
    folded = F.get(F.transform(F.array(F.translate(col, source, target)), fold), F.lit(0))
    return F.when(col.rlike(r"[^\x00-\x7F]"), folded).otherwise(col)


def upper_keeping_sharp_s(col: Column) -> Column:
    """Upper-case without turning one letter into two."""
    pieces = F.array_join(F.transform(F.split(col, _SHARP_S), F.upper), _SHARP_S)
    return F.when(col.contains(_SHARP_S), pieces).otherwise(F.upper(col))


@lru_cache(maxsize=1)
def _compositions() -> dict[str, str]:
    """Letters that canonical composition makes of a letter and its marks."""
    found = {}
    for point in range(128, sys.maxunicode + 1):
        letter = chr(point)
        if 0xD800 <= point <= 0xDFFF:
            continue
        apart = unicodedata.normalize("NFD", letter)
        if len(apart) > 1 and unicodedata.normalize("NFC", apart) == letter and all(unicodedata.combining(c) for c in apart[1:]):
            found[apart] = letter
            # the marks of two steps may come with the first step composed already
            for cut in range(2, len(apart)):
                found[unicodedata.normalize("NFC", apart[:cut]) + apart[cut:]] = letter
    return found


def composed(col: Column) -> Column:
    """Canonical composition (NFC) of letters followed by their combining marks; texts without marks skip the work."""
    table = F.create_map(*[F.lit(x) for pair in _compositions().items() for x in pair])
    letters = F.split(col, r"(?=\P{M})")
    joined = F.array_join(F.transform(letters, lambda c: F.when(c.rlike(r"\p{M}"), F.coalesce(F.element_at(table, c), c)).otherwise(c)), "")
    return F.when(col.rlike(r"\p{M}"), joined).otherwise(col)


def clean_name(col: Column, strict: bool = True) -> Column:
    """Resolve the accent idiom; when strict drop brackets and punctuation (hyphens stay)."""
    rules = [ACCENT_IDIOM] + ([BRACKETED, NAME_PUNCTUATION] if strict else [])
    return strip(swap_all(col, rules))


def clean_assignee(col: Column) -> Column:
    """As ``clean_name`` but hyphens go and ``|+=_`` stay."""
    return strip(swap_all(col, [ACCENT_IDIOM, BRACKETED, ASSIGNEE_PUNCTUATION]))


def clean_place(col: Column) -> Column:
    """Upper-case a place, drop postal codes, digits and punctuation, fold to ASCII."""
    text = swap_all(upper_keeping_sharp_s(col), PLACE_RULES)

    def trim_edge(text: Column) -> Column:
        bare = strip(F.regexp_replace(text, "[,|-]", " "))
        # an edge separator or edge blank costs the value its last character
        return fold_ascii(F.when(F.length(text) > F.length(bare), _drop_last(text)).otherwise(text))

    # a lambda names the cleaned text, which is then computed once
    return F.get(F.transform(F.array(text), trim_edge), F.lit(0))


def _drop_last(col: Column) -> Column:
    return F.regexp_replace(col, r"(?s).\z", "")


def clean_markup(col: Column) -> Column:
    """Composed letters, one blank per white-space run, the subscript dash as ``_``, HTML-escaped, upper-cased."""
    text = F.lower(F.regexp_replace(composed(col), ESCAPE_RUN, " "))
    for idiom in UNDERSCORE_IDIOMS:
        text = F.replace(text, F.lit(idiom), F.lit("_"))
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return upper_keeping_sharp_s(text)


def escape_outside_sub(col: Column) -> Column:
    """Escape ``& < >`` but leave ``<sub>`` and known entities alone."""
    text = F.regexp_replace(col, BARE_AMPERSAND, "&amp;")
    text = F.regexp_replace(text, OPENING_OUTSIDE_SUB, "&lt;")
    return F.regexp_replace(text, CLOSING_OUTSIDE_SUB, "&gt;")


def valid_text(col: Column) -> Column:
    """Bytes as UTF-8 text, blank where they are not valid."""
    return F.coalesce(F.try_validate_utf8(col.cast("string")), F.lit(""))


def title_case(col: Column) -> Column:
    return F.initcap(col)


def segment(col: Column, index: int) -> Column:
    """The index-th piece between ``,`` or ``|``; -1 is the whole, beyond the end is ''."""
    if index == -1:
        return col
    return F.coalesce(F.get(F.split(col, r" *?[,|] *"), F.lit(index)), F.lit(""))


def separator_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit("[,|]"))


def without_spaces(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def prefix(col: Column, size: int) -> Column:
    return F.substring(col, 1, size)


def suffix(col: Column, size: int) -> Column:
    return F.when(F.length(col) <= size, col).otherwise(F.substring(col, -size, size))

