"""Column helpers that turn dirty source values into typed ones.

All are built-in Catalyst expressions, so they stay inside generated code.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as words

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    """Amount with two decimals, null when the value is not a number."""
    return value.try_cast(MONEY)


def whole(value: Column) -> Column:
    """Integer, null when the value is not one."""
    return value.try_cast("int")


def decimal(value: Column, precision: int, scale: int) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast(MONEY))


def parse_date(value: Column, formats: Iterable[str] = ("yyyyMMdd",)) -> Column:
    """Date of a date, a timestamp or a text; null when it cannot be read.

    ISO-like text is read by the cast. `formats` are tried after it, for texts
    the cast does not know; day/month orders that depend on a server's language
    are left out unless asked for.
    """
    readings = [value.try_cast("date")]
    readings += [F.try_to_timestamp(value.cast("string"), F.lit(f)).cast("date") for f in formats]
    return F.coalesce(*readings)


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def key_month(key: Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def trimmed(value: Column) -> Column:
    return F.trim(value)


def text(value: Column) -> Column:
    """Text form, whole: the products have no column widths."""
    return value.cast("string")


def spelled(value: Column, spellings: Iterable[str]) -> Column:
    """Whether the text is one of `spellings`; trailing blanks do not count.

    Never null: an absent value is not one of them.
    """
    forms = [form for word in spellings for form in _unicode_forms(word)]
    return F.coalesce(F.rtrim(value).isin(*forms), F.lit(False))


def flag(value: Column) -> Column:
    """Boolean of a flag that may arrive as text, number or boolean."""
    return spelled(F.trim(text(value)), words.TRUE_TEXT)


def mentions(value: Column, parts: Iterable[str]) -> Column:
    """Whether the text contains one of `parts`, whatever the case. Never null."""
    folded = F.lower(value)
    found = F.lit(False)
    for part in parts:
        for form in _unicode_forms(part.lower()):
            found = found | folded.contains(form)
    return F.coalesce(found, F.lit(False))


def same_text(value: Column, word: str) -> Column:
    """Whether the text is `word`, whatever the case. Never null."""
    return spelled(F.lower(value), [word.lower()])


def is_code(value: Column, code: int) -> Column:
    """Whether a status code has this value. Never null."""
    return F.coalesce(value == code, F.lit(False))


def joined_text(first: Column, second: Column, separator: str) -> Column:
    """Both texts with a separator between; an absent one counts as empty."""
    blank = F.lit("")
    return F.concat(F.coalesce(first, blank), F.lit(separator), F.coalesce(second, blank))


def _unicode_forms(word: str) -> list[str]:
    """Composed and decomposed spelling; one entry when they are the same."""
    return list(dict.fromkeys(unicodedata.normalize(form, word) for form in ("NFC", "NFD")))
