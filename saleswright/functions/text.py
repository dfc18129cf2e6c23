"""Text clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the edge of a text.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"

# U+FDD0 is a noncharacter set aside for internal use, so no text contains it.
_SEAM = "\ufdd0 "

# A single ASCII word, with digits and signs after its letters only.
_WORD = r"^[A-Za-z]++[!-@]*+\z"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(c, F.lit(WHITESPACE))


def title_case(c: Column) -> Column:
    """Capital after anything that is not a cased letter, lower case elsewhere.

    ``initcap`` only starts a word after a blank, so a seam ending in a blank is
    put between every other non-letter and the letter after it, and taken out
    again. This stays inside generated code, unlike a lambda over word pieces.
    """
    seamed = F.regexp_replace(c, f"([^{_CASED} ])(?=[{_CASED}])", f"$1{_SEAM}")
    return F.replace(F.initcap(seamed), F.lit(_SEAM), F.lit(""))


def normalize(c: Column) -> Column:
    """Stripped title case; single words, the usual label, go a shorter way."""
    word = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))
    return F.when(c.rlike(_WORD), word).otherwise(title_case(strip(c)))
