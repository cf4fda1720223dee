"""Running demand per SKU."""

from pyspark.sql import Window
from pyspark.sql import functions as F

SKU = ["store_id", "product_id"]


def running_demand(forecast):
    """Running demand and row numbers per SKU over the forecast horizon.

    Equal forecast rows of one SKU are first folded into one row with a ``copies`` count, so
    the shuffle into the windows carries one row per distinct (SKU, day, demand) however often
    a row repeats. ``running_total`` covers all rows up to the day (rows of one day share it);
    the folded rows take the row numbers ``first_rn`` to ``last_rn``, ordered by day and then
    demand.
    """
    day = F.col("full_date").asc_nulls_last()
    demand = F.col("demand_forecast").asc_nulls_last()
    up_to_day = (
        Window.partitionBy(*SKU).orderBy(day).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    up_to_row = (
        Window.partitionBy(*SKU)
        .orderBy(day, demand)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    folded = forecast.groupBy(*SKU, "full_date", "demand_forecast").agg(F.count("*").alias("copies"))
    return (
        folded.withColumn("last_rn", F.sum("copies").over(up_to_row))
        .withColumn("first_rn", F.col("last_rn") - F.col("copies") + 1)
        .withColumn(
            "running_total",
            F.sum(F.col("demand_forecast") * F.col("copies")).over(up_to_day).cast("decimal(18,2)"),
        )
    )


def unfolded(demand):
    """One row per forecast row again, numbered ``rn``, of what :func:`running_demand` folded."""
    numbers = F.sequence(F.col("first_rn"), F.col("last_rn"))
    return demand.withColumn("rn", F.explode(numbers)).drop("first_rn", "last_rn", "copies")


def is_short(effective_inventory, running_total):
    """TRUE where stock does not cover the running demand; unknown counts as FALSE."""
    return F.coalesce(effective_inventory < running_total, F.lit(False))
