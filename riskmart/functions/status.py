"""Traffic lights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def high_is_bad(value: Column, lights) -> Column:
    """green up to amber, amber up to red, red above; info when there is no value."""
    amber, red = lights
    return (
        F.when(value.isNull() | F.isnan(value), "info")
        .when(value > red, "red")
        .when(value > amber, "amber")
        .otherwise("green")
    )


def red_above(value: Column, limit: float) -> Column:
    """Two lights only: red above the limit, otherwise (also when unknown) green."""
    return F.when(value > limit, "red").otherwise("green")
