"""Business KPIs over the marts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfline.functions.arithmetic import at_least_zero, rounded_ratio, zero_to_null
from shelfline.functions.rules import FOUR_DAYS, TWO_DAYS
from shelfline.operators.aggregates import (
    breakdown,
    drill_down,
    quantile_cuts,
    share_below,
)
from shelfline.operators.filters import dashboard_filter
from shelfline.operators.joins import Star, latest_facts
from shelfline.plans.marts import inventory_daily_snapshot, sku_outlook, with_alerts
from shelfline.session import scratch_dir

RATIO_PLACES = 6
KLL_K = 400
KLL_RANK_ERROR = 0.01  # of quantile sketches with k = 400 (published bound: 0.66 % for one rank, 99 % confidence)
AMOUNT = "decimal(28,4)"


def stockout_loss():
    """Revenue at risk tomorrow for one SKU: demand beyond stock on hand, at its price."""
    missing = at_least_zero(F.col("next_day_demand") - F.col("inventory_level"))
    return (F.coalesce(missing, F.lit(0)).cast("decimal(17,2)") * F.col("selling_price")).cast(AMOUNT)


def overstock_capital():
    """Capital of one SKU in stock beyond four days of demand, if its supply exceeds four days."""
    surplus = (F.col("effective_inventory") - F.col("four_day_demand")).cast("decimal(17,2)")
    return F.when(F.col("dos") > FOUR_DAYS, surplus * F.col("selling_price")).cast(AMOUNT)


def sku_risks(star, forecast, latest=None):
    """One row per SKU of the latest date: alerts, revenue at risk and locked capital."""
    return risks_of(sku_outlook(star, forecast, latest))


def risks_of(skus):
    """:func:`sku_risks` of :func:`sku_outlook` rows."""
    return with_alerts(skus).withColumns(
        {
            "projected_stockout_loss": stockout_loss(),
            "capital_locked": F.coalesce(overstock_capital(), F.lit(0)).cast(AMOUNT),
        }
    )


def _count_where(condition):
    return F.when(F.coalesce(condition, F.lit(False)), 1).otherwise(0)


def _share(part, whole):
    """A count over another as a rounded share."""
    exact = F.col(part).cast("decimal(18,0)") / zero_to_null(F.col(whole).cast("decimal(18,0)"))
    return F.round(exact, RATIO_PLACES)


def risk_measures():
    return {
        "skus": F.lit(1),
        "projected_stockout_loss": F.col("projected_stockout_loss"),
        "_low": _count_where(F.col("dos") < TWO_DAYS),
        "capital_locked": F.col("capital_locked"),
    }


def risk_totals():
    return [
        "skus",
        F.col("projected_stockout_loss").cast(AMOUNT).alias("projected_stockout_loss"),
        _share("_low", "skus").alias("low_inventory_share"),
        F.col("capital_locked").cast(AMOUNT).alias("capital_locked"),
    ]


def projected_stockout_loss(risks):
    total = F.sum("projected_stockout_loss").cast(AMOUNT).alias("projected_stockout_loss")
    return risks.agg(total, F.count_if(F.col("projected_stockout_loss") > 0).alias("skus_at_risk"))


def low_inventory_share(risks, days=TWO_DAYS):
    return risks.agg(
        F.count("*").alias("skus"),
        F.count_if(F.col("dos") < days).alias("low_skus"),
        F.round(share_below(F.col("dos"), days), RATIO_PLACES).alias("low_inventory_share"),
    )


def capital_locked(risks):
    return risks.agg(
        F.sum("capital_locked").cast(AMOUNT).alias("capital_locked"),
        F.count_if(F.col("dos") > FOUR_DAYS).alias("overstocked_skus"),
    )


def sku_turnover(snapshot, *more):
    """Exact turnover per SKU: units sold over average stock held, as decimals; ``more`` are attributes of a SKU to keep."""
    sold, stock = F.sum("units_sold"), F.sum("inventory_level")
    turnover = rounded_ratio(sold * F.count("full_date"), stock, RATIO_PLACES)
    return snapshot.groupBy("store_id", "product_id", *more).agg(
        sold.alias("units_sold"), turnover.cast("decimal(18,6)").alias("turnover")
    )


def recent_snapshot(star, days=30, newest=None):
    """The snapshot of the last ``days`` calendar days up to the newest date key.

    The bound is put on the fact's date key before the joins, so only those partitions are read.
    ``newest`` is the key where the caller knows it (``max(warehouse.fact_dates())``); else one
    pass over that column finds it.
    """
    if newest is None:
        newest = star.fact.agg(F.max("date_key")).first()[0]
    if newest is None:
        return inventory_daily_snapshot(star)
    end = datetime.strptime(str(newest), "%Y%m%d").date()
    first = int(f"{end - timedelta(days=days - 1):%Y%m%d}")
    fact = star.fact.where((F.col("date_key") >= first) & (F.col("date_key") <= newest))
    return inventory_daily_snapshot(Star(fact, *star[1:]))


def velocity_measures():
    known = F.col("turnover").isNotNull()
    return {
        "_weighted": (F.col("turnover") * F.col("units_sold")).cast("decimal(30,6)"),
        "_units": F.when(known, F.col("units_sold")),
    }


def velocity_totals(days):
    turnover = F.round(
        F.col("_weighted").cast("decimal(30,6)") / zero_to_null(F.col("_units").cast("decimal(18,0)")), RATIO_PLACES
    ).cast("decimal(18,6)")
    shelf = F.round(F.lit(days).cast("decimal(5,0)") / zero_to_null(turnover), 2)
    return [turnover.alias("turnover"), shelf.alias("avg_shelf_days")]


def _summed(measures):
    return [F.sum(value).alias(name) for name, value in measures.items()]


def inventory_velocity(recent, days=30):
    """Turnover weighted by units sold over :func:`recent_snapshot`, and the average life on the shelf."""
    return sku_turnover(recent).agg(*_summed(velocity_measures())).select(*velocity_totals(days))


def velocity_drill_down(recent, days=30, **filters):
    """Turnover and life on the shelf for the portfolio, its stores and its SKUs."""
    turnover = sku_turnover(dashboard_filter(recent, **filters))
    return drill_down(turnover, velocity_measures(), velocity_totals(days), one_row_per_sku=True)


def reliability_measures():
    sold, error = F.col("units_sold"), F.abs(F.col("demand_forecast") - F.col("units_sold"))
    over = F.col("demand_forecast") > F.col("units_sold")
    under = F.col("demand_forecast") < F.col("units_sold")
    measures = {"observations": F.lit(1), "_error": error, "_sold": sold}
    for direction, when in (("over", over), ("under", under)):
        measures[f"_error_{direction}"] = F.when(when, error).otherwise(F.lit(0))
        measures[f"_sold_{direction}"] = F.when(when, sold).otherwise(F.lit(0))
        measures[f"_{direction}"] = _count_where(when)
    return measures


def reliability_totals():
    def wape(suffix):
        return rounded_ratio(F.col(f"_error{suffix}"), F.col(f"_sold{suffix}"), RATIO_PLACES)

    return [
        "observations",
        wape("").alias("wape"),
        wape("_over").alias("wape_over"),
        wape("_under").alias("wape_under"),
        _share("_over", "observations").alias("freq_over"),
        _share("_under", "observations").alias("freq_under"),
    ]


def forecast_reliability(deviations, *by):
    """WAPE of the portfolio and of each error direction, and how often each direction occurs.

    A SKU's WAPE is its summed absolute error over its units sold, so weighting by units sold
    gives the summed error over the summed units.
    """
    return deviations.groupBy(*by).agg(*_summed(reliability_measures())).select(*by, *reliability_totals())


def reliability_drill_down(deviations, **filters):
    """WAPE and error frequencies for the portfolio, its stores and its SKUs."""
    return drill_down(dashboard_filter(deviations, **filters), reliability_measures(), reliability_totals())


def inventory_overview(star, latest=None):
    """On-hand, on-order and total units per category and overall on the latest date."""
    on_hand, on_order = F.sum("inventory_level"), F.sum("units_ordered")
    return (
        latest_facts(star, latest)
        .rollup("category")
        .agg(on_hand.alias("on_hand"), on_order.alias("on_order"), (on_hand + on_order).alias("total"), F.grouping("category").alias("_total"))
        .withColumn("category", F.when(F.col("_total") == 1, "All").otherwise(F.col("category")))
        .drop("_total")
    )


def working_capital_trend(snapshot):
    value = F.col("inventory_level").cast("decimal(12,0)") * F.col("selling_price")
    return breakdown(snapshot, "full_date", F.sum(value).cast(AMOUNT).alias("working_capital"))


def turnover_matrix(turnover, stores):
    """Products as rows, the listed stores as columns; a store outside the list is an error.

    For many stores use the long form, :func:`sku_turnover` itself.
    """
    listed = F.col("store_id").isin(list(stores))
    unlisted = F.raise_error(F.concat(F.lit("not a listed store: "), F.coalesce("store_id", F.lit("NULL"))))
    turnover = turnover.withColumn("store_id", F.when(listed, F.col("store_id")).otherwise(unlisted.cast("string")))
    return turnover.groupBy("product_id").pivot("store_id", list(stores)).agg(F.max("turnover"))


def mover_segments(turnover, slow=0.25, fast=0.75):
    """Fast, medium and slow movers by exact turnover quantiles.

    The turnover, one row per SKU, is written once to the shared scratch folder, so the passes
    that narrow the quantiles do not repeat the work below it.
    """
    spark = turnover.sparkSession
    path = scratch_dir(spark, "turnover")
    turnover.write.parquet(path)
    turnover = spark.read.schema(turnover.schema).parquet(path)
    low, high = quantile_cuts(turnover, "turnover", [slow, fast]).first()
    value = F.col("turnover")
    return turnover.withColumn(
        "segment",
        F.when(value >= high, "Fast mover").when(value <= low, "Slow mover").otherwise("Medium mover"),
    )


def segment_sketches(turnover, group=("store_id", "category"), k=KLL_K):
    """One mergeable quantile sketch of the turnover per group, of a size bounded by ``k``.

    Sketches of parts (regions, deliveries, days) merge without their rows: see :func:`merged_sketches`.
    """
    value = F.col("turnover").cast("double")
    rows = turnover.where(F.col("turnover").isNotNull())
    return rows.groupBy(*group).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def merged_sketches(sketches, *group, k=KLL_K):
    """The sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def segment_cuts(sketches, slow=0.25, fast=0.75):
    """Quantile cuts per group; a cut's rank is within :data:`KLL_RANK_ERROR` of its share, with 99 % confidence."""
    cuts = [F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in (("slow", slow), ("fast", fast))]
    return sketches.select(*[name for name in sketches.columns if name != "sketch"], *cuts)


def group_segments(turnover, group=("store_id", "category"), slow=0.25, fast=0.75, k=KLL_K):
    """Fast, medium and slow movers within each store and category, by the cuts of their sketches.

    :func:`mover_segments` gives exact cuts of all SKUs; here every group has cuts of its own, found in
    one pass whatever the number of groups.
    """
    cuts = segment_cuts(segment_sketches(turnover, group, k), slow, fast)
    value = F.col("turnover").cast("double")
    named = F.when(value >= F.col("fast"), "Fast mover").when(value <= F.col("slow"), "Slow mover").otherwise("Medium mover")
    return turnover.join(cuts, list(group)).withColumn("segment", named).drop("slow", "fast")


def alert_counts(health):
    return health.groupBy("store_id", "inventory_health_status").agg(F.count("*").alias("skus"))


def risk_drill_down(risks, **filters):
    """Risk KPIs for the portfolio, its stores and its SKUs after the dashboard filters."""
    return drill_down(dashboard_filter(risks, **filters), risk_measures(), risk_totals(), one_row_per_sku=True)
