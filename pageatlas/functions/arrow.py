"""Arrow functions that are built when they are called, so that importing a module needs no session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_function(returns: str) -> Callable[[Callable], Callable[..., Column]]:
    """Like ``pandas_udf``, but lazily: the decorated function takes columns and gives a column."""

    def decorate(f: Callable) -> Callable[..., Column]:
        def call(*columns) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        return call

    return decorate
