"""Map columns: rename keys, filter entries, defaults, typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keys_cased(m: Column, upper: bool = False) -> Column:
    return F.transform_keys(m, lambda k, _: F.upper(k) if upper else F.lower(k))


def values_cased(m: Column, upper: bool = False) -> Column:
    return F.transform_values(m, lambda _, v: F.upper(v) if upper else F.lower(v))


def with_key_copies(m: Column, prefix: str = "", suffix: str = "") -> Column:
    """The map plus a copy of each entry under a prefixed or suffixed key."""
    copies = F.transform_keys(m, lambda k, _: F.concat(F.lit(prefix), k, F.lit(suffix)))
    return merged(m, copies)


def merged(base: Column, over: Column) -> Column:
    """Entries of both maps; on a shared key the second one wins, also with a null value."""
    boxed = F.transform_values(over, lambda _, v: F.struct(v.alias("v")))
    return F.map_zip_with(base, boxed, lambda _, b, o: F.when(o.isNull(), b).otherwise(o["v"]))


def keep_keys(m: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: k.isin(*keys))


def drop_keys(m: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(*keys))


def keep_keys_matching(m: Column, pattern: str) -> Column:
    """Keys matching the whole pattern."""
    return F.map_filter(m, lambda k, _: k.rlike(f"^(?:{pattern})$"))


def keep_values(m: Column, values: Sequence) -> Column:
    return F.map_filter(m, lambda _, v: v.isin(*values))


def drop_null_values(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v.isNotNull())


def with_defaults(m: Column, defaults: Column) -> Column:
    """Missing keys taken from the defaults; present keys stay, also with a null value."""
    return merged(defaults, F.coalesce(m, F.from_json(F.lit("{}"), "map<string,string>")))


def map_levels(kind: T.DataType) -> int:
    """How many maps lie inside each other in a column type."""
    return 1 + map_levels(kind.valueType) if isinstance(kind, T.MapType) else 0


def with_nested_defaults(m: Column, defaults: Column, levels: int) -> Column:
    """Missing keys taken from the defaults in a map of maps, down to its `levels`-th level.

    A present key stays, also with a null value; where both sides hold a map, the maps are completed.
    """
    if levels == 1:
        return F.coalesce(merged(defaults, m), m, defaults)
    completed = F.transform_values(
        m, lambda k, v: F.when(v.isNotNull(), with_nested_defaults(v, F.try_element_at(defaults, k), levels - 1)))
    return F.coalesce(merged(defaults, completed), completed, defaults)


def as_text(m: Column) -> Column:
    """key=value;… in key order."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")


# A failed try_cast raises and catches inside the task, many times the price of a pattern,
# so values are tested first and only readable ones are cast.
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def as_integer(text: Column) -> Column:
    """Integer value of a text, or null (also where it does not fit 64 bits)."""
    return F.when(text.rlike(INTEGER), F.trim(text).try_cast("bigint"))


def as_number(text: Column) -> Column:
    """Decimal value of a text, or null."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def typed_rungs(text: Column) -> dict[str, Column]:
    """The narrowest reading of a text value: boolean, integer, double, else text."""
    low = F.lower(F.trim(text))
    as_bool = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    as_int = as_integer(text)
    as_float = F.when(as_int.isNull(), as_number(text))
    kind = (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(as_bool.isNotNull(), "bool")
        .when(as_int.isNotNull(), "int")
        .when(as_float.isNotNull(), "float")
        .otherwise("text")
    )
    return {"kind": kind, "as_bool": as_bool, "as_int": as_int, "as_float": as_float}
