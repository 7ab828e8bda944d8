"""Small helpers for higher-order array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once.

    An expression used inside a lambda is evaluated again for every element; a lambda variable is
    not. The one-element array turns the value into such a variable.
    """
    return F.transform(F.array(value), body)[0]
