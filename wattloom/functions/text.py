"""Names and text: column references, slugs, sector prefixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` in backticks, so that dots are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a top-level column whose name may hold dots (``in.state``)."""
    return F.col(quoted(name))


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def slug(text: Column) -> Column:
    """Lower case with every run of other characters turned into one ``_``."""
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"))


def sector_of(measure: Column) -> Column:
    """Sector from a measure's first word: ``(C)`` or ``Gap`` com, ``(R)`` res."""
    first = F.split(measure, " ").getItem(0)
    return F.when(first.contains("(C)") | first.contains("Gap"), F.lit("com")).when(
        first.contains("(R)"), F.lit("res")
    )
