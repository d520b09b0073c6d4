"""Column-to-column functions; all of them run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Length that takes a text to its end.
WHOLE = 2**31 - 1


def where_found(mark: str, step: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """The step, for texts that hold ``mark``; a byte search spares the others a regex."""
    return lambda held: F.when(held.contains(mark), step(held)).otherwise(held)


def chain(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """Apply the steps in turn, each on the finished result of the one before.

    A column used twice in an expression is an expression evaluated twice. As
    the variable of a lambda it is a value, so long texts are cleaned once.
    """
    held = F.array(value)
    for step in steps:
        held = F.transform(held, step)
    return F.get(held, F.lit(0))
