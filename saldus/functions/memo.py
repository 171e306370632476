"""Column expressions that depend on no table, made once."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from functools import wraps
from typing import TypeVar

from pyspark import SparkContext

T = TypeVar("T")


def made_once(f: Callable[..., T]) -> Callable[..., T]:
    """f, whose result for the same plain arguments is made once for each JVM.

    Each operation on a column is a call to the JVM, and PySpark notes where in the program it was made; a bank of rules is some hundreds of them, more than
    Spark then takes to plan a query. Columns that only name other columns can be used again in any query.
    """
    made: dict[Hashable, T] = {}
    jvm: list[object] = [None]

    @wraps(f)
    def run(*args: Hashable) -> T:
        now = SparkContext._gateway
        if jvm[0] is not now:
            made.clear()
            jvm[0] = now
        if args not in made:
            made[args] = f(*args)
        return made[args]

    return run
