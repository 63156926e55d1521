"""Place-name, identifier and label cleaning."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

EXTERNAL_ZONE = "externo"


@cache
def _accent_table() -> tuple[str, str]:
    """Characters to replace and their bases, from Unicode decomposition of every code point.

    The combining marks come last: ``translate`` deletes what has no counterpart.
    """
    accented, plain = [], []
    for char in map(chr, range(0x00C0, 0x10000)):
        if not unicodedata.decomposition(char) or unicodedata.decomposition(char).startswith("<"):
            continue
        base = "".join(
            c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c)
        )
        if len(base) == 1 and base != char:
            accented.append(char)
            plain.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(accented + marks), "".join(plain)


def strip_accents(text: Column) -> Column:
    accented, plain = _accent_table()
    return F.translate(text, accented, plain)


def trim_spaces(text: Column) -> Column:
    """Trim every Unicode space separator, not only U+0020."""
    return F.regexp_replace(text, r"^\p{Zs}+|\p{Zs}+$", "")


def label_token(label: Column, position: int) -> Column:
    """The n-th dot-separated part of a series label, trimmed and in lower case."""
    return F.lower(trim_spaces(F.split_part(label, F.lit("."), F.lit(position))))


def normalise_name(label: Column) -> Column:
    """Join key of a place name.

    Takes what precedes the first dot; of a bilingual ``A/B`` name the second form, if there is
    one; then trims, drops accents, lowers the case and turns hyphens into spaces.
    """
    place = F.split_part(label, F.lit("."), F.lit(1))
    second = F.nullif(F.split_part(place, F.lit("/"), F.lit(2)), F.lit(""))
    first = F.split_part(place, F.lit("/"), F.lit(1))
    chosen = trim_spaces(F.coalesce(second, first))
    return F.replace(F.lower(strip_accents(chosen)), F.lit("-"), F.lit(" "))


def clean_id(identifier: Column) -> Column:
    """Trim and drop the ``.0`` a float-typed reader leaves behind."""
    return F.regexp_replace(F.trim(identifier), r"\.0$", "")


def clean_population(text: Column) -> Column:
    """Thousands-dotted count to a number; what is not a number counts as 0.

    The ``.0`` suffix goes before the dots do, so ``1234.0`` is 1234 and ``1.234`` is 1234.
    """
    digits = F.replace(clean_id(text), F.lit("."), F.lit(""))
    return F.coalesce(digits.try_cast("double"), F.lit(0.0)).cast("long")
