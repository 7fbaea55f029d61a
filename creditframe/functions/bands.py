"""Named band sets and the expression that applies one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Band edges and one label more than edges.

    ``closed`` says which band an edge value belongs to: "left" means the edge opens the upper band
    (value < edge is below), "right" means it closes the lower one (value <= edge is below).
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    closed: str = "left"


# Band edges and labels of the risk reports.
FICO_REPORT = Bands(
    (620, 660, 700, 740, 780),
    ("1:<620", "2:620-659", "3:660-699", "4:700-739", "5:740-779", "6:780+"),
)
LTV_REPORT = Bands((60, 80, 90), ("1:<=60", "2:61-80", "3:81-90", "4:91+"), closed="right")
# Band edges and labels of the loss marts.
FICO_MART = Bands(
    (620, 660, 700, 740, 780),
    ("<620", "620-659", "660-699", "700-739", "740-779", "780+"),
)
LTV_MART = Bands(
    (60, 70, 80, 90), ("<=60", "61-70", "71-80", "81-90", "91+"), closed="right"
)
# Worst-status labels; a NULL status is unknown.
WORST_STATUS = Bands(
    (1, 3, 6), ("0: current", "1: 30-60 dpd", "2: 90-150 dpd", "3: 180+ dpd (default)")
)
WORST_STATUS_UNKNOWN = "4: unknown"


def band(value: Column, bands: Bands) -> Column:
    """Label of the band the value falls in; NULL falls in the top band."""
    below = (lambda edge: value < edge) if bands.closed == "left" else (lambda edge: value <= edge)
    expr = F
    for edge, label in zip(bands.edges, bands.labels):
        expr = expr.when(below(F.lit(edge)), F.lit(label))
    return expr.otherwise(F.lit(bands.labels[-1]))


def band_rank(label: Column, bands: Bands) -> Column:
    """Position of a label in its band set, for report ordering."""
    return F.array_position(F.array(*[F.lit(x) for x in bands.labels]), label)
