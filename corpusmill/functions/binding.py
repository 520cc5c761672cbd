"""Give an intermediate value a name inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Without it, a value used inside a lambda is computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a small constant table; null for an unknown key."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def whole_part(value: Column, divisor: int) -> Column:
    """Integer quotient; exact also beyond the precision of a double."""
    return F.call_function("div", value.cast("bigint"), F.lit(divisor).cast("bigint"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn(name, value)`` for a costly value that is filtered on later.

    The optimizer moves a filter below the projection and then computes the value for
    the filter and again for the output. It does not do so across a generator.
    """
    once = F.explode(F.array(value)).alias(name)
    if name not in df.columns:
        return df.select("*", once)
    return df.select(*[once if c == name else F.col(c) for c in df.columns])
