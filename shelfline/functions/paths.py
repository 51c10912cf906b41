"""Taxonomy paths: bracketed, comma-separated texts from root to node."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_parts(path: Column, separator: str = ", ") -> Column:
    return F.split(F.regexp_replace(path, r"^\[|\]$", ""), separator)


def first_part(path: Column, separator: str = ", ") -> Column:
    return path_parts(path, separator)[0]


def tail(path: Column, separator: str = ", ") -> Column:
    """The path without its first element; null when nothing is left."""
    parts = path_parts(path, separator)
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(F.size(parts) > 1, F.array_join(rest, separator))


def ancestor_paths(parts: Column, separator: str) -> Column:
    """Every prefix of the path, the path itself last."""
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), separator)
    )


def as_item(text: Column) -> Column:
    return F.concat(F.lit("<item>"), text, F.lit("</item>"))
