"""Column names and type names as column expressions, for metadata held in a table."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metadata type names with a type of their own. All others are text.
SQL_TYPES = {"number": "double", "text": "string", "checkbox": "boolean"}


def sql_type(type_name: Column) -> Column:
    """Metadata type name, in any case, to the Spark SQL type name."""
    lowered = F.lower(type_name)
    known = F.create_map(*(F.lit(part) for pair in SQL_TYPES.items() for part in pair))
    return F.coalesce(F.try_element_at(known, lowered), F.lit("string"))


def name_or_default(name: Column, position: Column) -> Column:
    """A missing or empty name becomes ``col_<position>``."""
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("col_"), position))


@cache
def _other_letters() -> str:
    """A character class of the letters and digits beyond ASCII, by the rule of ``str.isalnum``.

    Ranges are found by asking for each code point, so the class is that of the schema builder, whatever
    Unicode the JVM knows.
    """
    edges, inside = [], False
    for code in range(128, sys.maxunicode + 1):
        if chr(code).isalnum() != inside:
            inside = not inside
            edges.append(code)
    if inside:
        edges.append(sys.maxunicode + 1)
    return "".join(rf"\x{{{a:x}}}-\x{{{b - 1:x}}}" for a, b in zip(edges[::2], edges[1::2]))


def clean_name(name: Column) -> Column:
    """Every character that is no letter, digit or underscore becomes an underscore.

    What counts as a letter or digit is the same as in ``build_schema``. Names in ASCII, nearly all,
    are cleaned by a short class.
    """
    ascii_name = F.octet_length(name) == F.length(name)
    return F.when(ascii_name, F.regexp_replace(name, "[^A-Za-z0-9_]", "_")).otherwise(
        F.regexp_replace(name, f"[^A-Za-z0-9_{_other_letters()}]", "_")
    )
