"""Value bands: upper-inclusive bins and score bands."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges (upper-inclusive) and labels; the last label is everything above the last edge.
DISTANCE_BINS = ((3, 5), ("0 - 3 km", "3 - 5 km", "5+ km"))
TRAVEL_BINS = ((15, 30, 45), ("0 - 15 mins", "15 - 30 mins", "30 - 45 mins", "45+ mins"))
PREP_BINS = (
    (15, 30, 45, 60),
    ("0 - 15 mins", "15 - 30 mins", "30 - 45 mins", "45 - 60 mins", "60+ mins"),
)
ACTUAL_BINS = (
    (30, 45, 55, 65),
    ("0 - 30 mins", "30 - 45 mins", "45 - 55 mins", "55 - 65 mins", "65+ mins"),
)


def bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """NULL stays NULL."""
    expr = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(value <= F.lit(edge), label)
    return expr.otherwise(labels[-1])


def band(score: Column, bands: Sequence[tuple], pick: int = 0) -> Column:
    """The band (id, name, lowest, highest) that holds the score, as a CASE: both ends belong to the band.

    The bands are a handful of seeded rows, so a CASE replaces the range join and adds no exchange.
    Id 0 is the unknown band and never matches; scores between or outside bands give NULL.
    """
    expr = F.when(score.isNull(), F.lit(None))
    for entry in bands:
        if entry[0] != 0:
            expr = expr.when(score.between(_exact(entry[2]), _exact(entry[3])), F.lit(entry[pick]))
    return expr


def _exact(value: str) -> Column:
    return F.lit(Decimal(value))
