"""Constraint checks: each returns the violations or their count, so an empty result is good."""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfline.operators.windows import SKU, is_short, running_demand


def _stack_counts(df, checks):
    """One pass over the table: a row per named condition with its number of violations."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check"), F.col(name).alias("violations")) for name in checks]
    )
    return counted.select(F.inline(pairs))


def null_counts(df, columns):
    return _stack_counts(df, {name: F.col(name).isNull() for name in columns})


def duplicate_keys(df, keys):
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def too_long_counts(df, limits):
    return _stack_counts(df, {name: F.length(name) > limit for name, limit in limits.items()})


def orphans(df, key, dimension):
    """Rows whose key has no member in the dimension."""
    return df.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")


def lost_skus(facts, forecast, horizon=7):
    """SKUs that the stock-health mart drops: no forecast, or never short on a short horizon."""
    demand = running_demand(forecast).select(*SKU, "running_total", "last_rn")
    on_hand = facts.select(
        *SKU, (F.col("inventory_level") + F.col("units_ordered")).alias("effective_inventory")
    )
    short = is_short(F.col("effective_inventory"), F.col("running_total"))
    return (
        on_hand.join(demand, SKU, "left")
        .groupBy(*SKU)
        .agg(
            F.coalesce(F.max("last_rn"), F.lit(0)).alias("forecast_rows"),
            F.max(short).alias("_ever_short"),
        )
        .where((F.col("forecast_rows") < horizon) & ~F.col("_ever_short"))
        .select(
            *SKU,
            "forecast_rows",
            F.when(F.col("forecast_rows") == 0, "no forecast").otherwise("short horizon").alias("reason"),
        )
    )


def negative_counts(df, columns):
    return _stack_counts(df, {name: F.col(name) < 0 for name in columns})


def observe_rows(df, step):
    """The frame plus an observation that holds its row count once it has been written."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def enforced(df, required=(), max_lengths=None):
    """The same rows; writing them fails on a NULL in a required column or an overlong text.

    The tests run inside the write itself, so they cost no pass of their own.
    """

    def guarded(name):
        column = F.col(name)
        if name in required:
            missing = F.raise_error(F.lit(f"{name} must not be NULL")).cast(df.schema[name].dataType)
            column = F.coalesce(column, missing)
        limit = (max_lengths or {}).get(name)
        if limit is not None:
            too_long = F.raise_error(F.lit(f"{name} is longer than {limit}")).cast("string")
            column = F.when(F.length(column) > limit, too_long).otherwise(column)
        return column.alias(name)

    return df.select(*[guarded(name) for name in df.columns])


def all_violations(checks):
    """Union of (check, violations) frames."""
    return reduce(lambda left, right: left.unionByName(right), checks)
