"""Spend bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper limits (exclusive) and names, spelling kept.
BANDS = (
    (0, "minus"),
    (20, "very low"),
    (40, "low"),
    (70, "middle-low"),
    (100, "middle"),
    (150, "middle-high"),
    (200, "almost"),
    (250, "high"),
    (270, "higgh"),
    (300, "hiigh"),
    (325, "veeery high"),
    (350, "very high"),
    (500, "very hiigh"),
    (1000, "super high"),
)
TOP_BAND = "epic high"


def spend_band(average: Column) -> Column:
    """Band of an average monthly spend; limits are right-open."""
    band = F.when(average < BANDS[0][0], BANDS[0][1])
    for limit, name in BANDS[1:]:
        band = band.when(average < limit, name)
    return F.when(average.isNotNull(), band.otherwise(TOP_BAND))
