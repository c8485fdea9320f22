"""Text cleaning and text-to-number expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes, found by rule (the last is U+3000).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends (no regex: long inner runs stay linear).

    Only a text that begins or ends with whitespace is trimmed: its first and last character are looked up in a set,
    while trimming looks each character up in a list and measures the whole text.
    """
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    return F.when(first.isin(*WHITESPACE) | last.isin(*WHITESPACE), F.trim(c, F.lit(WHITESPACE))).otherwise(c)


def null_if_in(c: Column, tokens) -> Column:
    """NULL where the text equals one of ``tokens``, else the text itself."""
    return F.when(~c.isin(*sorted(tokens)), c)


def to_decimal(c: Column, dtype: str, on_error: str = "null", source: Column | None = None) -> Column:
    """Cast text to a decimal type.

    ``on_error="null"`` yields NULL for text that is no number or does not fit;
    ``"fail"`` stops the job on it, in ANSI mode or not.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    number = c.try_cast(dtype)
    if on_error == "null":
        return number
    shown = c if source is None else source
    message = F.concat(F.lit("not a number: "), shown)
    return F.when(c.isNotNull() & number.isNull(), F.raise_error(message).cast(dtype)).otherwise(number)


def phrase_number(c: Column, phrases: Mapping[str, int], dtype: str, on_error: str = "null") -> Column:
    """Number from text in which some fixed phrases stand for numbers."""
    number = to_decimal(F.when(~c.isin(*phrases), c), dtype, on_error, source=c)
    out = None
    for phrase, value in phrases.items():
        test, result = c == phrase, F.lit(value).cast(dtype)
        out = F.when(test, result) if out is None else out.when(test, result)
    return number if out is None else out.otherwise(number)


_EXPONENT_FORM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+\z"


def money_number(c: Column, dtype: str, on_error: str = "null") -> Column:
    """Number from currency text: keep digits and dots, then cast; nothing left is NULL.

    Signs and thousands separators are dropped with the rest, so '-5' is 5. A text that is
    wholly a number in exponent form is that number without its sign ('1e5' is 100000): its
    digits alone would be another, plausible number. One that does not fit is no number.
    """
    digits = F.nullif(F.regexp_replace(c, "[^0-9.]", ""), F.lit(""))
    kept = F.when(c.rlike(_EXPONENT_FORM), F.regexp_replace(c, "^[+-]", "")).otherwise(digits)
    return to_decimal(kept, dtype, on_error, source=c)


def expand_exponent(c: Column) -> Column:
    """Write a number in exponent form ('1e5') out in full; other text, and a number that does not fit, stays."""
    plain = F.regexp_replace(c.try_cast("decimal(38,10)").cast("string"), r"\.0+\z", "")
    return F.when(c.rlike(_EXPONENT_FORM), F.coalesce(plain, c)).otherwise(c)


def mentions(text_lower: Column, item: Column) -> Column:
    """``text ILIKE '%item%'`` with NULL as false; ``text_lower`` is the lowered text.

    An item without LIKE wildcards is a plain substring search. Only items that
    hold ``%``, ``_`` or a backslash pay for a pattern compiled per row; for those
    a backslash before an ordinary character is dropped, as LIKE reads it.
    """
    item_lower = F.lower(item)
    special = item.contains("%") | item.contains("_") | item.contains("\\")
    pattern = F.concat(F.lit("%"), item_lower, F.lit("%"))
    pattern = F.regexp_replace(pattern, r"(?s)(\\[%_\\])|\\(.)", "$1$2")
    hit = F.when(special, F.like(text_lower, pattern)).otherwise(F.contains(text_lower, item_lower))
    return F.coalesce(hit, F.lit(False))
