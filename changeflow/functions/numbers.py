"""Exact rates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.schemas import RATE


def rate(part: Column, total: Column) -> Column:
    """``part / total`` in exact decimals, half away from zero at four digits; NULL if the total is zero."""
    whole = F.nullif(total.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(part.cast("decimal(20,0)") / whole, 4).cast(RATE)
