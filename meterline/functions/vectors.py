"""Values out of vector columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def class_confidence(probability: str = "probability", position: int = 1, digits: int | None = 4) -> Column:
    """Probability of one class as a double; by default of the positive class."""
    value = vector_to_array(F.col(probability))[position]
    return value if digits is None else F.round(value, digits)


# Positions of a vector that its likeness looks at, at most.
LIKENESS_BITS = 62


def likeness(vector: str) -> Column:
    """A number by which similar scaled vectors sort next to each other: which positions lie above their mean.

    Folding over the values keeps the generated code small however many there are.
    """
    values = F.slice(vector_to_array(vector), 1, LIKENESS_BITS)
    return F.aggregate(values, F.lit(0).cast("long"), lambda bits, x: bits * 2 + F.when(x > 0, 1).otherwise(0))
