"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings a CSV reader treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Every Unicode white-space character, U+00A0 included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space; blank becomes NULL.

    ``btrim`` looks only at the ends of the text; a regular expression would scan all of it.
    """
    return F.nullif(F.btrim(text, F.lit(WHITE_SPACE)), F.lit(""))


def title_case(text: Column) -> Column:
    """Capital after every non-letter: ``o'brien`` -> ``O'Brien``, ``mary-jane`` -> ``Mary-Jane``."""
    letters = r"[\p{Lu}\p{Ll}\p{Lt}]+"
    runs = F.regexp_extract_all(text, F.lit(rf"({letters}|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)"), F.lit(1))
    # initcap starts a word only after a blank, so each run of letters is capitalised on its own
    return F.array_join(F.transform(runs, F.initcap), "")


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def mask_local_part(email: Column) -> Column:
    return F.regexp_replace(email, "^[^@]+", "*****")


def number(text: Column, kind: str) -> Column:
    """Numeric text as a decimal; anything else, ``NaN`` included, becomes NULL."""
    return text.try_cast(kind)
