"""Evaluate an expensive expression once per row.

Predicate pushdown substitutes a projected expression into every filter condition
that uses it, so a parse referenced by ten conditions would run ten times. A
one-element ``explode_outer`` is a generator: conditions on its output stay above
it, and the expression runs once per row. Only one generator is allowed per select.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expr: Column) -> Column:
    return F.explode_outer(F.array(expr))
