"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    Written out, an expression used in several places inside a lambda is evaluated at
    each of them; a one-element array carries it instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
