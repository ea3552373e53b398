"""Enum code <-> member name as literal maps (no UDF, no join)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..enums import ENUMS


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def code_to_name(code: str | Column, enum_key: str) -> Column:
    """Integer code -> member name; unknown codes give null."""
    m = ENUMS[enum_key]
    lookup = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(lookup, _c(code).cast("int"))


def name_to_code(name: str | Column, enum_key: str, unknown: Column | None = None) -> Column:
    """Member name -> integer code; unknown names give ``unknown`` (null)."""
    m = ENUMS[enum_key]
    lookup = F.create_map(*[x for k, v in m.items() for x in (F.lit(v), F.lit(k))])
    v = F.try_element_at(lookup, _c(name))
    return v if unknown is None else F.coalesce(v, unknown)
