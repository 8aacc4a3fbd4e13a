"""Text folding: transliterate to ASCII, then upper-case.

The translation is derived by rule from Unicode's own data, so results do not
depend on the platform's locale: a letter folds to the ASCII letters of its
decomposition, combining marks go, and a Latin letter without a decomposition
folds to the first letter that its Unicode name gives.  What is left to choose stands
below as fixed values.  Letters of other scripts stay as they are.
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that fold to more than one ASCII character and are
# common in texts.  They are replaced before upper-casing (upper('ß') is not 'SS'
# in every engine).
MULTI_LETTER_FOLDS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
    "Þ": "TH", "þ": "th", "Ĳ": "IJ", "ĳ": "ij", "…": "...", "«": "<<", "»": ">>",
}

# Single characters without a Unicode decomposition to ASCII,
# including the ordinal indicators and punctuation common in Spanish forms.
SINGLE_LETTER_FOLDS = {
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d",
    "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t",
    "º": "o", "ª": "a", "¿": "?", "¡": "!", "\u00a0": " ",
    "\u2013": "-", "\u2014": "-", "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"',
}

# Letters whose names begin with another letter than they stand for.
NAMED_LETTERS = {"ENG": "N", "EZH": "Z", "SCHWA": "E", "ETH": "D", "KRA": "Q"}


def _letters_of(ch: str) -> str | None:
    """ASCII letters or digits that a non-ASCII letter or digit stands for; None if there are none."""
    base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    if base != ch and base and all(c.isascii() and c.isalnum() for c in base):
        return base
    name = unicodedata.name(ch, "")
    if not name.startswith("LATIN "):
        return None
    if base != ch and len(base) == 1 and not base.isascii():
        return _letters_of(base)  # an accent on a letter that does not decompose
    word = re.sub(r" WITH .*| DIGRAPH", "", name).split()[-1]
    letter = NAMED_LETTERS.get(word, word[0])
    return letter.upper() if " CAPITAL " in name and " SMALL CAPITAL " not in name else letter.lower()


def _derived_folds() -> dict[str, str]:
    out = {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd"):
            if letters := _letters_of(ch):
                out[ch] = letters
    return out


_FOLDS = {**_derived_folds(), **SINGLE_LETTER_FOLDS, **MULTI_LETTER_FOLDS}
SINGLE_FOLDS: dict[str, str] = {c: f for c, f in _FOLDS.items() if len(f) == 1}
_FROM = "".join(SINGLE_FOLDS)
_TO = "".join(SINGLE_FOLDS.values())
SEVERAL_FOLDS: dict[str, str] = {c: f for c, f in _FOLDS.items() if len(f) > 1}
_SEVERAL = "[\\p{Mn}" + "".join(SEVERAL_FOLDS) + "]"


def fold_text(col: Column | str) -> Column:
    """ASCII-transliterate and upper-case; NULL stays NULL.

    A text of one-byte characters only needs its upper case.  Combining marks and
    letters that become several are handled, in a loop over their short table, only
    in texts that have any.
    """
    c = F.col(col) if isinstance(col, str) else col
    plain = F.replace(c, F.lit("ß"), F.lit("ss"))  # the most frequent of them
    table = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in SEVERAL_FOLDS.items()])
    several = F.aggregate(table, F.regexp_replace(plain, r"\p{Mn}+", ""), lambda t, f: F.replace(t, f["a"], f["b"]))
    single = F.when(plain.rlike(_SEVERAL), several).otherwise(plain)
    return F.when(F.octet_length(c) == F.char_length(c), F.upper(c)).otherwise(F.upper(F.translate(single, _FROM, _TO)))


def fold_py(text: str | None) -> str | None:
    """Pure-Python twin of :func:`fold_text`, for tests."""
    if text is None:
        return None
    kept = "".join(_FOLDS.get(c, c) for c in text if unicodedata.category(c) != "Mn")
    return kept.upper()
