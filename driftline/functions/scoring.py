"""Label, confidence and margin of a probability array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_column


def top_class(probabilities: str | Column, classes: list[str]) -> Column:
    """Most probable class; the lowest class index wins a tie."""
    probs = as_column(probabilities)
    index = F.array_position(probs, F.array_max(probs)).cast("int")
    return F.try_element_at(F.array(*[F.lit(c) for c in classes]), index)


def confidence(probabilities: str | Column) -> Column:
    return F.array_max(as_column(probabilities))


def margin(probabilities: str | Column) -> Column:
    """Gap between the best and the second best; the second is 0 for one class."""
    probs = as_column(probabilities)
    ranked = F.sort_array(probs, asc=False)
    return F.try_element_at(ranked, F.lit(1)) - F.coalesce(
        F.try_element_at(ranked, F.lit(2)), F.lit(0.0)
    )
