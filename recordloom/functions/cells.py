"""Coercion of single values, as column expressions.

``*_cell`` functions take a variant cell (its JSON type is known), ``*_text``
functions take a string column. None of them raises: a value that cannot be
converted becomes NULL in its own field and the row is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The strings (any case, untrimmed) that count as a ticked box.
TICKED = ("true", "yes", "1", "t")

# Characters a number may be padded with.
_PAD = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
# Digits, with single underscores allowed between them.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
# The sign of a NaN carries no meaning and is left out of the captured group.
_NUMBER = (
    rf"^{_PAD}(?:[+-](?=[nN]))?("
    rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|[+-]?(?i:inf(?:inity)?)"
    r"|(?i:nan)"
    rf"){_PAD}\z"
)
# What most numbers look like, and what a cast reads without further ado.
_PLAIN_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_WHOLE_DECIMAL = r"^DECIMAL\((?:[1-9]|1[0-8]),0\)$"


@dataclass(frozen=True)
class Cell:
    """A variant cell with what every conversion asks of it.

    ``kind`` is ``STRING``, ``BOOLEAN``, ``BIGINT``, ``DECIMAL(p,s)``, ``OBJECT<..>`` ...,
    ``text`` the string itself or else its JSON.
    """

    variant: Column
    kind: Column
    text: Column

    @classmethod
    def of(cls, variant: Column) -> Cell:
        text = F.try_variant_get(variant, "$", "string")
        return cls(variant, F.schema_of_variant(variant), text)


def number_from_text(text: Column) -> Column:
    """Text to double; junk, hexadecimal, type suffixes and thousands commas give NULL.

    Text that is no number never reaches the cast, which would build an exception for it.
    """
    digits = F.replace(F.regexp_extract(text, _NUMBER, 1), F.lit("_"), F.lit(""))
    number = F.when(text.rlike(_PLAIN_NUMBER), text).when(text.rlike(_NUMBER), digits)
    return number.try_cast("double")


def number_from_cell(cell: Cell) -> Column:
    """JSON numbers as they are, booleans as 1 and 0, strings by ``number_from_text``."""
    return F.when(cell.kind == "STRING", number_from_text(cell.text)).otherwise(
        F.try_variant_get(cell.variant, "$", "double")
    )


def long_from_text(text: Column) -> Column:
    """Text to double, then cut towards zero."""
    return number_from_text(text).try_cast("bigint")


def long_from_cell(cell: Cell) -> Column:
    return number_from_cell(cell).try_cast("bigint")


def checkbox_from_text(text: Column) -> Column:
    """Ticked words give true; every other string gives false, only NULL stays NULL."""
    return F.lower(text).isin(*TICKED)


def checkbox_from_cell(cell: Cell) -> Column:
    """Strings by ``checkbox_from_text``; zero and empty values are false, others true."""
    nested = cell.kind.startswith("OBJECT") | cell.kind.startswith("ARRAY")
    return (
        F.when(cell.kind == "STRING", checkbox_from_text(cell.text))
        .when(nested, ~cell.text.isin("{}", "[]"))
        .otherwise(F.try_variant_get(cell.variant, "$", "boolean"))
    )


def text_from_cell(cell: Cell) -> Column:
    """Strings as they are, ``True``/``False``, fractions with their ``.0``, JSON otherwise."""
    return (
        F.when(cell.kind == "STRING", cell.text)
        .when(cell.kind == "BOOLEAN", F.initcap(cell.text))
        # A fraction such as 5.0 is held as the decimal 5; beyond 18 digits a
        # scale of zero means a large integer instead.
        .when(cell.kind.rlike(_WHOLE_DECIMAL), F.concat(cell.text, F.lit(".0")))
        .otherwise(cell.text)
    )


def coerce_cell(cell: Cell, target: T.DataType) -> Column:
    """The conversion for a schema type; a type without one of its own becomes text."""
    if isinstance(target, T.DoubleType):
        return number_from_cell(cell)
    if isinstance(target, T.LongType):
        return long_from_cell(cell)
    if isinstance(target, T.BooleanType):
        return checkbox_from_cell(cell)
    return text_from_cell(cell)
