"""String expressions shared by the layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(c: Column) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Trim spaces at both ends; nothing left means NULL."""
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def join_present(separator: str, parts: Iterable[Column]) -> Column:
    """Join the parts that are neither NULL nor empty."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), separator)


def strip_whitespace(c: Column) -> Column:
    """Remove every kind of white space at both ends, not only spaces."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def lookup(c: Column, table: Mapping[str, str], default: str) -> Column:
    """Literal map lookup with a default; the table is code-sized by construction."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, c), F.lit(default))


def first_hit(cases: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """Text of the first condition that is true; NULL conditions do not hit."""
    return F.coalesce(*[F.when(cond, F.lit(text)) for cond, text in cases], F.lit(otherwise))
