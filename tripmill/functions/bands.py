"""Ordered labels for CASE-style groupings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bands:
    """A list of labels in display order.

    Grouping uses the band number, an int: cheaper to hash than the label and already the
    sort key. The label is looked up afterwards, once per group.
    """

    def __init__(self, *labels: str) -> None:
        self.labels = labels

    def number(self, *tests: Column) -> Column:
        """Number of the first test that holds; the last label takes the rest."""
        if len(tests) != len(self.labels) - 1:
            raise ValueError(f"{len(self.labels)} labels need {len(self.labels) - 1} tests")
        chosen = F.when(tests[0], F.lit(1))
        for i, test in enumerate(tests[1:], start=2):
            chosen = chosen.when(test, F.lit(i))
        return chosen.otherwise(F.lit(len(self.labels)))

    def below(self, value: Column, limits: Sequence[float]) -> Column:
        """Band number for ascending, exclusive upper limits."""
        return self.number(*[value < F.lit(float(limit)) for limit in limits])

    def label(self, number: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in self.labels]), number)
