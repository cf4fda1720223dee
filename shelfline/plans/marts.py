"""Reporting marts as functions of the star schema and the forecast snapshot."""

from pyspark.sql import functions as F

from shelfline.functions.arithmetic import (
    at_least_zero,
    effective_inventory,
    exact_ratio,
    rounded_ratio,
    units_deviation,
    whole_division,
)
from shelfline.functions.cleaning import trimmed
from shelfline.functions.rules import accuracy_flag, health_status, recommended_action, severity_level
from shelfline.operators.aggregates import monthly_stock
from shelfline.operators.filters import short_or_covered
from shelfline.operators.joins import latest_facts, star_join, with_forecast
from shelfline.operators.windows import SKU, is_short, running_demand, unfolded

HORIZON = 7


def inventory_daily_snapshot(star):
    """One flat row per fact."""
    return star_join(star).select(
        "full_date",
        "store_id",
        "region",
        "product_id",
        "category",
        "units_sold",
        "inventory_level",
        "units_ordered",
        "demand_forecast",
        "selling_price",
        "discount_applied",
        "weather_condition",
        "is_promotion_active",
    )


def inventory_turnover_monthly(star, exact=False, unique_days=True):
    """Turnover per month and SKU.

    By default both divisions drop the fraction, as whole-number columns do; ``exact=True``
    divides decimals and rounds to two places.
    """
    return turnover_of(monthly_stock(star.fact, star.dim_date, unique_days), star, exact)


def turnover_of(sums, star, exact=False):
    """:func:`inventory_turnover_monthly` from units, stock and days per month and SKU."""
    stock, days = F.col("total_inventory_sum"), F.col("days_observed")
    sold = F.col("total_units_sold")
    if exact:
        held = F.round(exact_ratio(stock, days), 0)
        turnover = rounded_ratio(sold * days, stock, 2)
    else:
        held = whole_division(stock, days)
        turnover = whole_division(sold, held)
    return (
        sums.join(star.dim_store.select("store_key", "store_id"), "store_key")
        .join(star.dim_product.select("product_key", "product_id", "category"), "product_key")
        .select(
            "year",
            "month",
            "store_id",
            "product_id",
            "category",
            "total_units_sold",
            held.cast("decimal(20,0)").alias("avg_inventory_held"),
            turnover.cast("decimal(20,2)").alias("turnover_ratio"),
        )
    )


def demand_outlook(star, forecast, latest=None):
    """:func:`folded_outlook` with one row per forecast row, numbered ``rn``."""
    return unfolded(folded_outlook(star, forecast, latest))


def outlook_facts(star, latest=None):
    """What stock health needs of the facts: one row per SKU of the latest fact date."""
    return latest_facts(star, latest).select(
        "full_date",
        "store_id",
        "region",
        "product_id",
        "category",
        "inventory_level",
        "units_ordered",
        "selling_price",
    )


def folded_outlook(star, forecast, latest=None):
    """Cumulative forecast demand against effective inventory on the latest fact date.

    Equal forecast rows are folded as in :func:`running_demand`.

    The windows run on the forecast before the join. A SKU has one fact row per date, so the
    numbers are the same as after the join and the joined rows keep the windows' partitioning.
    """
    return outlook_of(outlook_facts(star, latest), forecast)


def outlook_of(facts, forecast):
    """:func:`folded_outlook` of :func:`outlook_facts`; no shuffle if both are bucketed by SKU."""
    stock = effective_inventory(F.col("inventory_level"), F.col("units_ordered"))
    demand = running_demand(forecast).withColumnRenamed("full_date", "forecasted_for")
    return with_forecast(facts.withColumn("effective_inventory", stock), demand).withColumn(
        "is_less_than_demand", is_short(F.col("effective_inventory"), F.col("running_total"))
    )


def _contains_row(number):
    return (F.col("first_rn") <= number) & (F.col("last_rn") >= number)


def days_of_supply_candidate():
    """Days of supply that one row of :func:`folded_outlook` stands for, NULL if none.

    Among folded copies of a forecast row the first one gives the smallest value, except that
    the very first row of a SKU is rated by its own demand alone, so its second copy counts too.
    """
    stock, demand = F.col("effective_inventory"), F.col("demand_forecast")
    total, first = F.col("running_total"), F.col("first_rn")
    covered_before = stock - (total - demand)

    def partial_day(row_number):
        full_days = (row_number - 1).cast("decimal(18,0)")
        return F.round(full_days + exact_ratio(at_least_zero(covered_before), demand), 1)

    opening = rounded_ratio(stock, demand, 1)
    tail = F.round(HORIZON + exact_ratio(HORIZON * (stock - total), total), 2)
    short = F.col("is_less_than_demand")
    return (
        F.when(
            short & (first == 1) & (F.col("copies") > 1), F.least(opening, partial_day(F.lit(2)))
        )
        .when(short & (first == 1), opening)
        .when(short, partial_day(first))
        .when(_contains_row(HORIZON), tail)
    )


def sku_outlook(star, forecast, latest=None):
    """One row per SKU of the latest date: stock, days of supply and demand milestones."""
    return outlook_per_sku(folded_outlook(star, forecast, latest))


def outlook_per_sku(outlook):
    """:func:`sku_outlook` of :func:`folded_outlook` rows.

    Grouping keys start with the window's partitioning keys, so no further shuffle occurs and
    nothing has to be joined back.
    """
    decides = short_or_covered(F.col("is_less_than_demand"), _contains_row(HORIZON))

    def demand_until(row_number):
        return F.max(F.when(_contains_row(row_number), F.col("running_total")))

    return (
        outlook.groupBy(
            *SKU,
            "full_date",
            "region",
            "category",
            "inventory_level",
            "units_ordered",
            "effective_inventory",
            "selling_price",
        )
        .agg(
            F.round(F.min(F.when(decides, days_of_supply_candidate())), 2)
            .cast("decimal(20,2)")
            .alias("dos"),
            demand_until(1).alias("next_day_demand"),
            demand_until(4).alias("four_day_demand"),
            F.max(decides).alias("_rated"),
        )
        .where("_rated")
        .drop("_rated")
    )


def with_alerts(skus):
    """Status, action and severity of :func:`sku_outlook` rows."""
    on_hand, on_order = F.col("inventory_level"), F.col("units_ordered")
    demand, dos = F.col("next_day_demand"), F.col("dos")
    return skus.withColumns(
        {
            "inventory_health_status": health_status(on_hand, demand, dos),
            "inventory_action_required": recommended_action(on_hand, on_order, demand, dos),
            "severity_level": severity_level(on_hand, demand, dos),
        }
    )


def inventory_health(star, forecast, latest=None):
    """Stock status, recommended action and severity per SKU on the latest fact date."""
    return health_of(sku_outlook(star, forecast, latest))


def health_of(skus):
    """:func:`inventory_health` of :func:`sku_outlook` rows."""
    return with_alerts(skus).select(
        "full_date",
        "store_id",
        "region",
        "product_id",
        "category",
        "inventory_level",
        "units_ordered",
        "effective_inventory",
        "dos",
        "next_day_demand",
        "inventory_health_status",
        "inventory_action_required",
        "severity_level",
    )


def forecast_deviation(star):
    """Forecast against sold units with an accuracy flag (``seaonality`` is the given name)."""
    sold, forecast = F.col("units_sold"), F.col("demand_forecast")
    return star_join(star).select(
        "full_date",
        *trimmed("store_id", "product_id", "category"),
        "units_sold",
        F.round(forecast, 2).alias("demand_forecast"),
        units_deviation(forecast, sold).alias("units_deviation"),
        F.col("selling_price").alias("price"),
        F.col("discount_applied").alias("discount"),
        "is_promotion_active",
        "weather_condition",
        F.col("season").alias("seaonality"),
        "competitor_price",
        accuracy_flag(forecast, sold).alias("forecast_accuracy_flag"),
    )


def next_7d_demand(forecast):
    """The forecast snapshot with trimmed text."""
    texts = {name: F.trim(name) for name in ("store_id", "product_id", "category", "region")}
    return forecast.withColumns(texts)


def reporting_marts(star, forecast, latest=None):
    """All marts by the name they are exported under."""
    return {
        "inventory_daily_snapshot": inventory_daily_snapshot(star),
        "inventory_turnover_monthly": inventory_turnover_monthly(star),
        "inventory_health": inventory_health(star, forecast, latest),
        "forecast_deviation": forecast_deviation(star),
        "next_7d_demand": next_7d_demand(forecast),
    }


# Columns that order each exported mart.
EXPORT_ORDER = {
    "forecast_deviation": ["full_date", "store_id", "product_id"],
    "next_7d_demand": ["full_date", "store_id", "product_id"],
}

# Columns that split an exported mart into folders; the others are snapshots.
EXPORT_PARTS = {
    "inventory_daily_snapshot": ["full_date"],
    "forecast_deviation": ["full_date"],
    "inventory_turnover_monthly": ["year", "month"],
}


def define_views(marts):
    """Make the marts readable by name in Spark SQL."""
    for name, mart in marts.items():
        mart.createOrReplaceTempView(name)
    return sorted(marts)
