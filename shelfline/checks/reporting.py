"""Reporting marts and KPIs."""

from pyspark.sql import functions as F

from shelfline.checks import sql
from shelfline.checks.registry import query
from shelfline.checks.relational import folded_star, outlook, skus
from shelfline.operators.aggregates import drill_down
from shelfline.operators.filters import dashboard_filter
from shelfline.operators.windows import SKU
from shelfline.plans import kpis, marts
from shelfline.sources import driver_tables as D

STORES = [f"S{number:03d}" for number in range(25)]


def snapshot(spark, sf_dir):
    return marts.inventory_daily_snapshot(D.star(spark, sf_dir))


def deviation(spark, sf_dir):
    return marts.forecast_deviation(D.star(spark, sf_dir))


def health(spark, sf_dir):
    return marts.inventory_health(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))


def risks(spark, sf_dir):
    return kpis.sku_risks(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))


# Marts

SNAPSHOT_SQL = f"""
SELECT {sql.text()}, store_id, region, product_id, category, units_sold, inventory_level, units_ordered,
       {sql.cents('demand_c', 'demand_forecast')}, {sql.cents('price_c', 'selling_price')},
       CAST(disc AS DOUBLE) AS discount_applied, weather AS weather_condition, promo AS is_promotion_active"""


@query("m1_inventory_daily_snapshot", sql.long(SNAPSHOT_SQL + " FROM flat"))
def inventory_daily_snapshot(spark, sf_dir):
    return snapshot(spark, sf_dir)


MONTHLY = """monthly AS (
  SELECT CAST(year(full_date) AS BIGINT) AS year, CAST(month(full_date) AS BIGINT) AS month, store_id,
         product_id, category, CAST(SUM(units_sold) AS BIGINT) AS total_units_sold,
         CAST(SUM(inventory_level) AS BIGINT) AS stock, COUNT(*) AS days
  FROM flat GROUP BY ALL)"""


@query(
    "m2_inventory_turnover_monthly",
    sql.long(
        """SELECT year, month, store_id, product_id, category, total_units_sold,
                  CAST(stock // days AS DOUBLE) AS avg_inventory_held,
                  CAST(total_units_sold // NULLIF(stock // days, 0) AS DOUBLE) AS turnover_ratio FROM monthly""",
        MONTHLY,
    ),
)
def inventory_turnover_monthly(spark, sf_dir):
    return marts.inventory_turnover_monthly(D.star(spark, sf_dir))


@query(
    "m2_inventory_turnover_monthly_exact",
    sql.long(
        f"""SELECT year, month, store_id, product_id, category, total_units_sold,
                   {sql.half_up('stock', 'days', 0)} AS avg_inventory_held,
                   {sql.half_up('total_units_sold * days', 'stock', 2)} AS turnover_ratio FROM monthly""",
        MONTHLY,
    ),
)
def inventory_turnover_monthly_exact(spark, sf_dir):
    return marts.inventory_turnover_monthly(D.star(spark, sf_dir), exact=True)


@query(
    "m3a_demand_outlook",
    sql.outlook(
        f"""SELECT {sql.text()}, store_id, region, product_id, category, inventory_level, units_ordered,
                   inventory_level + units_ordered AS effective_inventory, {sql.text('forecasted_for')},
                   {sql.cents('d', 'demand_forecast')}, {sql.cents('rt', 'running_total')},
                   CAST(rn AS BIGINT) AS rn, short AS is_less_than_demand FROM outlook"""
    ),
)
def demand_outlook(spark, sf_dir):
    return outlook(spark, sf_dir).drop("selling_price")


@query(
    "m3b_days_of_supply",
    sql.outlook(f"SELECT store_id, product_id, {sql.cents('dos_h', 'dos')} FROM risk"),
)
def days_of_supply(spark, sf_dir):
    return skus(spark, sf_dir).select(*SKU, "dos")


@query(
    "m3c_health_status",
    sql.outlook("SELECT store_id, product_id, status AS inventory_health_status FROM health"),
)
def health_status(spark, sf_dir):
    return marts.with_alerts(skus(spark, sf_dir)).select(*SKU, "inventory_health_status")


@query(
    "m3d_recommended_action",
    sql.outlook("SELECT store_id, product_id, action AS inventory_action_required FROM health"),
)
def recommended_action(spark, sf_dir):
    return marts.with_alerts(skus(spark, sf_dir)).select(*SKU, "inventory_action_required")


@query(
    "m3e_severity_level",
    sql.outlook("SELECT store_id, product_id, CAST(band AS BIGINT) AS severity_level FROM health"),
)
def severity_level(spark, sf_dir):
    return marts.with_alerts(skus(spark, sf_dir)).select(*SKU, "severity_level")


HEALTH_SQL = f"""
SELECT {sql.text()}, store_id, region, product_id, category, inventory_level, units_ordered,
       inventory_level + units_ordered AS effective_inventory, {sql.cents('dos_h', 'dos')},
       {sql.cents('next_c', 'next_day_demand')}, status AS inventory_health_status,
       action AS inventory_action_required, CAST(band AS BIGINT) AS severity_level FROM health"""


@query("m3_inventory_health", sql.outlook(HEALTH_SQL))
def inventory_health(spark, sf_dir):
    return health(spark, sf_dir)


DEVIATION_SQL = f"""
SELECT {sql.text()}, store_id, product_id, category, units_sold, {sql.cents('demand_c', 'demand_forecast')},
       CAST(demand_c - 100 * units_sold AS DOUBLE) / 100 AS units_deviation, {sql.cents('price_c', 'price')},
       CAST(disc AS DOUBLE) AS discount, promo AS is_promotion_active, weather AS weather_condition,
       season AS seaonality, {sql.cents('competitor_c', 'competitor_price')},
       {sql.flag()} AS forecast_accuracy_flag"""


@query("m4_forecast_deviation", sql.long(DEVIATION_SQL + " FROM flat"))
def forecast_deviation(spark, sf_dir):
    return deviation(spark, sf_dir)


@query(
    "m4a_accuracy_flag",
    sql.folded(
        f"""SELECT store_id, {sql.flag()} AS forecast_accuracy_flag, COUNT(*) AS row_count
            FROM facts GROUP BY 1, 2"""
    ),
)
def accuracy_flag(spark, sf_dir):
    flagged = marts.forecast_deviation(folded_star(spark, sf_dir))
    return flagged.groupBy("store_id", "forecast_accuracy_flag").agg(F.count("*").alias("row_count"))


FORECAST_SQL = f"""
SELECT '1995-01-28' AS forecasted_on, {sql.text()}, store_id, product_id, category, region,
       {sql.cents('price_c', 'selling_price')}, CAST(disc AS DOUBLE) AS discount_applied,
       weather AS weather_condition, promo AS is_promotion_active,
       {sql.cents('competitor_c', 'competitor_price')}, season, {sql.cents('demand_c', 'demand_forecast')}
FROM forecast"""


@query("m5_next_7d_demand", sql.folded(FORECAST_SQL))
def next_7d_demand(spark, sf_dir):
    return marts.next_7d_demand(D.folded_forecast(spark, sf_dir))


# KPIs


@query(
    "k1_projected_stockout_loss",
    sql.outlook(
        """SELECT CAST(SUM(loss) AS DOUBLE) / 10000 AS projected_stockout_loss,
                  COUNT(*) FILTER (loss > 0) AS skus_at_risk FROM health"""
    ),
)
def projected_stockout_loss(spark, sf_dir):
    return kpis.projected_stockout_loss(risks(spark, sf_dir))


@query(
    "k2_low_inventory_share",
    sql.outlook(
        f"""SELECT COUNT(*) AS skus, COUNT(*) FILTER (dos_h < 200) AS low_skus,
                   {sql.half_up('COUNT(*) FILTER (dos_h < 200)', 'COUNT(*)', 6)} AS low_inventory_share FROM health"""
    ),
)
def low_inventory_share(spark, sf_dir):
    return kpis.low_inventory_share(risks(spark, sf_dir))


@query(
    "k3_capital_locked",
    sql.outlook(
        """SELECT CAST(SUM(locked) AS DOUBLE) / 10000 AS capital_locked,
                  COUNT(*) FILTER (dos_h > 400) AS overstocked_skus FROM health"""
    ),
)
def capital_locked(spark, sf_dir):
    return kpis.capital_locked(risks(spark, sf_dir))


def _micro(numerator, denominator):
    """Quotient in millionths, rounded half up, as a whole number."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(2000000 * {n} + {d}) // (2 * {d})"


_TURNOVER = f"""turnover AS (
  SELECT store_id, product_id, SUM(units_sold) AS sold,
         {_micro('SUM(units_sold) * COUNT(*)', 'SUM(inventory_level)')} AS micro FROM {{source}} GROUP BY 1, 2)"""


@query(
    "k4_inventory_velocity",
    sql.long(
        """SELECT CAST(t AS DOUBLE) / 1000000 AS turnover,
                  CAST((2 * 3000000000 + t) // (2 * t) AS DOUBLE) / 100 AS avg_shelf_days
           FROM (SELECT (2 * SUM(micro * sold) + SUM(sold)) // (2 * SUM(sold)) AS t FROM turnover)""",
        """recent AS (SELECT * FROM flat
           WHERE full_date > (SELECT MAX(full_date) FROM flat) - 30)""",
        _TURNOVER.format(source="recent"),
    ),
)
def inventory_velocity(spark, sf_dir):
    return kpis.inventory_velocity(kpis.recent_snapshot(D.star(spark, sf_dir)))


_ERROR = "abs(demand_c - 100 * units_sold)"
_RELIABILITY = {
    "wape": sql.half_up(f"SUM({_ERROR})", "100 * SUM(units_sold)", 6),
    "wape_over": sql.half_up(
        f"SUM({_ERROR}) FILTER (demand_c > 100 * units_sold)",
        "100 * SUM(units_sold) FILTER (demand_c > 100 * units_sold)",
        6,
    ),
    "wape_under": sql.half_up(
        f"SUM({_ERROR}) FILTER (demand_c < 100 * units_sold)",
        "100 * SUM(units_sold) FILTER (demand_c < 100 * units_sold)",
        6,
    ),
    "freq_over": sql.half_up("COUNT(*) FILTER (demand_c > 100 * units_sold)", "COUNT(*)", 6),
    "freq_under": sql.half_up("COUNT(*) FILTER (demand_c < 100 * units_sold)", "COUNT(*)", 6),
}


def _reliability_sql(*names):
    columns = ", ".join(f"{_RELIABILITY[name]} AS {name}" for name in names)
    return sql.long(f"SELECT store_id, {columns} FROM flat GROUP BY 1")


def _reliability(spark, sf_dir, *names):
    return kpis.forecast_reliability(deviation(spark, sf_dir), "store_id").select("store_id", *names)


@query(
    "k5_portfolio_wape",
    sql.long(f"SELECT COUNT(*) AS observations, {_RELIABILITY['wape']} AS wape FROM flat"),
)
def portfolio_wape(spark, sf_dir):
    return kpis.forecast_reliability(deviation(spark, sf_dir)).select("observations", "wape")


@query("k6_directional_wape", _reliability_sql("wape_over", "wape_under"))
def directional_wape(spark, sf_dir):
    return _reliability(spark, sf_dir, "wape_over", "wape_under")


@query("k7_error_frequency", _reliability_sql("freq_over", "freq_under"))
def error_frequency(spark, sf_dir):
    return _reliability(spark, sf_dir, "freq_over", "freq_under")


@query(
    "k8_inventory_overview",
    sql.outlook(
        """SELECT COALESCE(category, 'All') AS category, CAST(SUM(inventory_level) AS BIGINT) AS on_hand,
                  CAST(SUM(units_ordered) AS BIGINT) AS on_order,
                  CAST(SUM(inventory_level + units_ordered) AS BIGINT) AS total
           FROM today GROUP BY ROLLUP (category)"""
    ),
)
def inventory_overview(spark, sf_dir):
    return kpis.inventory_overview(folded_star(spark, sf_dir))


@query(
    "k9_working_capital_trend",
    sql.long(
        f"""SELECT {sql.text()}, CAST(SUM(inventory_level * price_c) AS DOUBLE) / 100 AS working_capital
            FROM flat GROUP BY flat.full_date"""
    ),
)
def working_capital_trend(spark, sf_dir):
    return kpis.working_capital_trend(snapshot(spark, sf_dir))


@query(
    "k10_turnover_matrix",
    sql.long(
        "SELECT product_id, "
        + ", ".join(
            f"CAST(MAX(micro) FILTER (store_id = '{store}') AS DOUBLE) / 1000000 AS {store}" for store in STORES
        )
        + " FROM turnover GROUP BY 1",
        _TURNOVER.format(source="flat"),
    ),
)
def turnover_matrix(spark, sf_dir):
    return kpis.turnover_matrix(kpis.sku_turnover(snapshot(spark, sf_dir)), STORES)


@query(
    "k11_mover_segments",
    sql.long(
        """SELECT store_id, product_id, CAST(micro AS DOUBLE) / 1000000 AS turnover,
                  CASE WHEN micro >= (SELECT MIN(micro) FROM ranked WHERE 4 * r >= 3 * n) THEN 'Fast mover'
                       WHEN micro <= (SELECT MIN(micro) FROM ranked WHERE 4 * r >= n) THEN 'Slow mover'
                       ELSE 'Medium mover' END AS segment
           FROM turnover""",
        _TURNOVER.format(source="flat"),
        """ranked AS (SELECT micro, ROW_NUMBER() OVER (ORDER BY micro) AS r, COUNT(*) OVER () AS n
           FROM turnover)""",
    ),
)
def mover_segments(spark, sf_dir):
    segments = kpis.mover_segments(kpis.sku_turnover(snapshot(spark, sf_dir)))
    return segments.select(*SKU, "turnover", "segment")


@query(
    "k11_group_segments",
    sql.long(
        """SELECT store_id, product_id, category, CAST(micro AS DOUBLE) / 1000000 AS turnover,
                  CASE WHEN micro >= fast THEN 'Fast mover' WHEN micro <= slow THEN 'Slow mover' ELSE 'Medium mover' END AS segment
           FROM ranked JOIN (
             SELECT store_id, category, MIN(micro) FILTER (4 * r >= 3 * n) AS fast, MIN(micro) FILTER (4 * r >= n) AS slow
             FROM ranked GROUP BY 1, 2) USING (store_id, category)""",
        _TURNOVER.format(source="flat"),
        """ranked AS (SELECT store_id, product_id, category, micro,
             ROW_NUMBER() OVER (PARTITION BY store_id, category ORDER BY micro) AS r, COUNT(*) OVER (PARTITION BY store_id, category) AS n
           FROM turnover JOIN (SELECT DISTINCT product_id, category FROM flat) USING (product_id) WHERE micro IS NOT NULL)""",
    ),
)
def group_segments(spark, sf_dir):
    """Segments within each store and category by quantile sketches, which are exact for groups this small."""
    days = snapshot(spark, sf_dir)
    return kpis.group_segments(kpis.sku_turnover(days, "category")).select(*SKU, "category", "turnover", "segment")


@query(
    "k12_alert_counts",
    sql.outlook(
        """SELECT store_id, status AS inventory_health_status, COUNT(*) AS skus FROM health GROUP BY 1, 2"""
    ),
)
def alert_counts(spark, sf_dir):
    return kpis.alert_counts(health(spark, sf_dir))


_LEVELS = """CASE WHEN GROUPING(store_id) = 1 THEN 'portfolio' WHEN GROUPING(product_id) = 1 THEN 'store'
                  ELSE 'sku' END AS level, store_id, product_id"""
_RISK_TOTALS = f"""COUNT(*) AS skus, CAST(SUM(loss) AS DOUBLE) / 10000 AS projected_stockout_loss,
       {sql.half_up('COUNT(*) FILTER (dos_h < 200)', 'COUNT(*)', 6)} AS low_inventory_share,
       CAST(SUM(locked) AS DOUBLE) / 10000 AS capital_locked"""


@query(
    "k13_risk_drill_down",
    sql.outlook(f"SELECT {_LEVELS}, {_RISK_TOTALS} FROM health GROUP BY ROLLUP (store_id, product_id)"),
)
def risk_drill_down(spark, sf_dir):
    return kpis.risk_drill_down(risks(spark, sf_dir))


@query(
    "k13_risk_drill_down_filtered",
    sql.outlook(
        f"""SELECT {_LEVELS}, {_RISK_TOTALS} FROM health
            WHERE full_date BETWEEN DATE '1995-01-20' AND DATE '1995-01-31' AND category IN ('C0', 'C2')
            GROUP BY ROLLUP (store_id, product_id)"""
    ),
)
def risk_drill_down_filtered(spark, sf_dir):
    return kpis.risk_drill_down(
        risks(spark, sf_dir), start="1995-01-20", end="1995-01-31", categories=["C0", "C2"]
    )


@query(
    "k13_working_capital_drill_down",
    sql.long(
        f"""SELECT {_LEVELS}, CAST(SUM(inventory_level * price_c) AS DOUBLE) / 100 AS working_capital FROM flat
            WHERE full_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
            GROUP BY ROLLUP (store_id, product_id)"""
    ),
)
def working_capital_drill_down(spark, sf_dir):
    kept = dashboard_filter(snapshot(spark, sf_dir), start="1997-01-01", end="1998-12-31")
    value = F.col("inventory_level").cast("decimal(12,0)") * F.col("selling_price")
    total = F.col("working_capital").cast(kpis.AMOUNT).alias("working_capital")
    return drill_down(kept, {"working_capital": value}, [total])


@query(
    "k13_reliability_drill_down",
    sql.long(
        f"""SELECT {_LEVELS}, COUNT(*) AS observations, {', '.join(f'{part} AS {name}' for name, part in _RELIABILITY.items())}
            FROM flat GROUP BY ROLLUP (store_id, product_id)"""
    ),
)
def reliability_drill_down(spark, sf_dir):
    return kpis.reliability_drill_down(deviation(spark, sf_dir))


@query(
    "k13_velocity_drill_down",
    sql.long(
        """SELECT level, store_id, product_id, CAST(t AS DOUBLE) / 1000000 AS turnover,
                  CAST((2 * 3000000000 + t) // (2 * t) AS DOUBLE) / 100 AS avg_shelf_days
           FROM (SELECT """
        + _LEVELS
        + """, (2 * SUM(micro * sold) + SUM(sold)) // (2 * SUM(sold)) AS t
           FROM turnover GROUP BY ROLLUP (store_id, product_id))""",
        """recent AS (SELECT * FROM flat
           WHERE full_date > (SELECT MAX(full_date) FROM flat) - 30)""",
        _TURNOVER.format(source="recent"),
    ),
)
def velocity_drill_down(spark, sf_dir):
    return kpis.velocity_drill_down(kpis.recent_snapshot(D.star(spark, sf_dir)))


@query("k10_turnover_long", sql.long("SELECT store_id, product_id, CAST(micro AS DOUBLE) / 1000000 AS turnover FROM turnover", _TURNOVER.format(source="flat")))
def turnover_long(spark, sf_dir):
    return kpis.sku_turnover(snapshot(spark, sf_dir)).select(*SKU, "turnover")
