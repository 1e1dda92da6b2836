"""Text, number and date expressions for raw source columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's notion of white space: Unicode space (one property test per character) plus the four ASCII separators.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Texts that stand for a missing value.
NULL_TEXTS = ["", "nan", "None", "<NA>"]

# Date layouts tried after ISO, each behind the shape it needs so that hopeless texts are never handed to a parser.
DATE_FORMATS = {
    "dd.MM.yyyy": r"^\d{2}\.\d{2}\.\d{4}$",
    "dd.MM.yyyy HH:mm": r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}$",
    "dd.MM.yyyy HH:mm:ss": r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "yyyy/MM/dd HH:mm:ss": r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$",
}


def _fold_table() -> dict[str, str]:
    """Characters outside ASCII whose compatibility decomposition holds exactly one ASCII letter or digit.

    The few signs that would unfold to several (ligatures, fractions, circled numbers) are not letters of any name and
    are removed like punctuation.
    """
    folded = {"Ł": "l", "ł": "l"}
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        flat = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if c.isascii() and c.isalnum())
        if len(flat) == 1:
            folded.setdefault(chr(code), flat.lower())
    return folded


_FOLDED = _fold_table()
_UPPER = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
_DROP = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
# Characters at the end of the first text without a partner in the second are deleted by translate().
_FROM, _TO = _UPPER + "".join(_FOLDED) + _DROP, _UPPER.lower() + "".join(_FOLDED.values())


def token(c: Column) -> Column:
    """Case-, accent- and punctuation-free key; NULL stays NULL.

    One table look-up per character; the pattern then only has to remove other scripts, so it rarely matches at all.
    """
    return F.regexp_replace(F.translate(c, _FROM, _TO), "[^a-z0-9]+", "")


def py_token(value: object) -> str:
    """The same key for a handful of header names on the driver."""
    table = {ord(k): v for k, v in zip(_FROM, _TO)}
    return "".join(c for c in str(value).translate(table) if c.isascii() and c.isalnum())


def clean_text(c: Column) -> Column:
    """White space trimmed and collapsed to single blanks; texts that stand for a missing value become NULL."""
    text = F.trim(F.regexp_replace(c.cast("string"), _SPACES, " "))
    return F.when(~text.isin(NULL_TEXTS), text)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def number(c: Column, dtype: str = "string") -> Column:
    """Locale-tolerant number: blanks and NBSP dropped, decimal comma accepted, anything else NULL (never NaN).

    `dtype` is the column's Spark type; numbers that are numbers already are only cast.
    """
    if dtype.startswith(_NUMERIC):
        plain = c.cast("double")
        return F.when(~F.isnan(plain), plain)
    # Comma to dot; blank and NBSP have no partner and are deleted.
    text = F.translate(c.cast("string"), ",\u00a0 ", ".")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def first_int(c: Column, dtype: str = "string") -> Column:
    """First run of digits, e.g. an hour written as '8', '8.0' or 'H08'."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return F.abs(c).try_cast("int")
    text = c.cast("string")
    return F.when(text.rlike(r"^\d{1,9}$"), text.try_cast("int")).otherwise(
        F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")
    )


def to_local(c: Column, dtype: str = "string", formats: dict[str, str] | None = None) -> Column:
    """Wall-clock timestamp from ISO text or one of `formats`; unreadable text becomes NULL.

    Typed columns are only cast, so that a filter on them still reaches the file scan.
    """
    if dtype == "timestamp_ntz":
        return c
    if dtype in ("date", "timestamp"):
        return c.cast("timestamp_ntz")
    text = F.trim(c.cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    for layout, shape in (formats or DATE_FORMATS).items():
        tries.append(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout))).cast("timestamp_ntz"))
    return F.coalesce(*tries)


def to_day(c: Column, dtype: str = "string", formats: dict[str, str] | None = None) -> Column:
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return c.cast("date")
    return F.coalesce(F.trim(c.cast("string")).try_cast("date"), to_local(c, dtype, formats).cast("date"))


def to_instant(c: Column, dtype: str = "string", formats: dict[str, str] | None = None) -> Column:
    """UTC instant; text without an offset is read as UTC."""
    if dtype == "timestamp":
        return c
    if dtype in ("date", "timestamp_ntz"):
        return c.cast("timestamp")
    text = F.trim(c.cast("string"))
    tries = [text.try_cast("timestamp")]
    for layout, shape in (formats or DATE_FORMATS).items():
        tries.append(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout))))
    return F.coalesce(*tries)
