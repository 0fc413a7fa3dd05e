"""Participant and group name normalizers.

Three variants exist on purpose and are not interchangeable: feature tables key on
the *entity* form, market tables on the *quote* form, and slates store the *slate*
form for display.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyline.functions.numeric import strip


_PLANE = [chr(code) for code in range(0x80, 0x10000) if not 0xD800 <= code < 0xE000]


def _folded() -> dict[str, str]:
    """What is left of each letter, in any script, when it is taken apart and its marks are
    dropped; built from Unicode itself. Marks themselves leave nothing."""
    apart = {ch: "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)) for ch in _PLANE}
    return {ch: left for ch, left in apart.items() if left != ch}


def _accents() -> str:
    """A pattern of the marks with a combining class. Others, such as the vowel signs of
    Indic scripts, are letters of a name and stay."""
    marks = [ord(ch) for ch in _PLANE if unicodedata.combining(ch)]
    spans: list[list[int]] = []
    for code in marks:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\u{a:04X}-\\u{b:04X}" for a, b in spans) + "]+"


_LEFT = _folded()
# Letters that fold to one; behind them those that leave nothing, for which translate finds
# no letter to put.
_TO_ONE = {ch: left for ch, left in _LEFT.items() if len(left) == 1}
_FOLDED, _BASE = "".join(_TO_ONE) + "".join(ch for ch, left in _LEFT.items() if not left), "".join(_TO_ONE.values())
# Ligatures, syllables and the like, by the number of letters that they fold to.
_LONGER: dict[int, dict[str, str]] = {}
for _letter, _letters in _LEFT.items():
    if len(_letters) > 1:
        _LONGER.setdefault(len(_letters), {})[_letter] = _letters
_ALL_LONGER = "".join(ch for group in _LONGER.values() for ch in group)
_ACCENTS = _accents()


@F.pandas_udf(StringType())
def _fold_nfkd(names: pd.Series) -> pd.Series:
    """Full compatibility decomposition; Spark has no built-in for it."""
    return names.str.normalize("NFKD").str.replace(_ACCENTS, "", regex=True)


def _taken_apart(c: Column) -> Column:
    """Ligatures and syllables as their letters, letter by letter of the text: place by place,
    each a translation of its own."""

    def letters(ch: Column) -> Column:
        out = ch
        for size, group in _LONGER.items():
            source = "".join(group)
            parts = [F.translate(ch, source, "".join(left[i] for left in group.values())) for i in range(size)]
            out = F.when(F.contains(F.lit(source), ch), F.concat(*parts)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(c, ""), letters), "")


def fold_accents(c: Column, *, exact: bool = False) -> Column:
    """Drop accents, and take ligatures and syllables apart, in any script of the basic plane.
    The default stays in the JVM; ``exact`` also folds letters beyond that plane, through an
    Arrow-batched UDF. Neither drops a mark without a combining class, so names that differ
    in more than accents stay apart."""
    if exact:
        return _fold_nfkd(c)
    # A text as long in bytes as in characters holds nothing to fold, and few hold a letter
    # that folds to several.
    plain = F.octet_length(c) == F.length(c)
    longer = F.length(F.translate(c, _ALL_LONGER, "")) < F.length(c)
    whole = F.when(longer, _taken_apart(c)).otherwise(c)
    return F.when(plain, c).otherwise(F.translate(whole, _FOLDED, _BASE))


def entity_name(c: Column, *, exact: bool = False) -> Column:
    """"Last, First" is turned round, accents dropped, blanks collapsed, lower case."""
    text = strip(F.coalesce(c, F.lit("")))
    turned = F.regexp_replace(text, r"(?s)^([^,]*),(.*)$", "$2 $1")
    folded = fold_accents(turned, exact=exact)
    return F.lower(strip(F.regexp_replace(folded, r"(?U)\s+", " ")))


def quote_name(c: Column) -> Column:
    """Lower case without dots and apostrophes, hyphens as blanks; accents stay."""
    return F.coalesce(strip(F.translate(F.lower(c), "-.'", " ")), F.lit(""))


def slate_name(c: Column) -> Column:
    """Like :func:`quote_name`, but the case is kept."""
    return F.coalesce(F.translate(strip(c), "-.'", " "), F.lit(""))


def canonical_name(c: Column, *, exact: bool = False) -> Column:
    """One key for both sides of a forecast-to-quote join: the entity form of the
    quote form, so that accents and "Last, First" spellings meet."""
    return entity_name(F.translate(c, "-.'", " "), exact=exact)


def group_code(c: Column) -> Column:
    return F.coalesce(F.upper(strip(c)), F.lit(""))


def collapsed_lower(c: Column) -> Column:
    return F.lower(strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))
