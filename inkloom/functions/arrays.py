"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is evaluated once however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)
