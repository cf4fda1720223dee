"""Filters, joins, aggregations, windows and ordering."""

from pyspark.sql import functions as F

from shelfline.checks import sql
from shelfline.checks.registry import query
from shelfline.functions.arithmetic import effective_inventory
from shelfline.functions.rules import accuracy_flag
from shelfline.operators import aggregates, filters, joins, ordering
from shelfline.operators.windows import SKU, is_short, running_demand, unfolded
from shelfline.plans import kpis, marts
from shelfline.sources import driver_tables as D

SKU_DAY = ["full_date", *SKU]
LABELS = ["accurate", "over-forecast", "under-forecast"]


def folded_star(spark, sf_dir):
    return D.star(spark, sf_dir, folded=True)


def outlook(spark, sf_dir):
    return marts.demand_outlook(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))


def skus(spark, sf_dir):
    return marts.sku_outlook(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))


# Filters


@query(
    "c1_latest_date",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, units_sold FROM flat
            WHERE full_date = (SELECT MAX(full_date) FROM flat)"""
    ),
)
def latest_date(spark, sf_dir):
    return filters.at_latest(D.inventory(spark, sf_dir), "full_date").select(*SKU_DAY, "units_sold")


@query(
    "c2_key_not_null",
    """SELECT o_orderstatus AS store_id, COUNT(*) AS row_count FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def key_not_null(spark, sf_dir):
    store = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("store_id")
    keyed = filters.with_key(D.table(spark, sf_dir, "orders").select(store), "store_id")
    return keyed.groupBy("store_id").agg(F.count("*").alias("row_count"))


@query(
    "c3_short_or_covered",
    sql.outlook(
        """SELECT store_id, product_id, CAST(rn AS BIGINT) AS rn, short FROM outlook
           WHERE short OR (rn = 7 AND NOT short)"""
    ),
)
def short_or_covered(spark, sf_dir):
    short, last = F.col("is_less_than_demand"), F.col("rn") == marts.HORIZON
    kept = outlook(spark, sf_dir).where(filters.short_or_covered(short, last))
    return kept.select(*SKU, "rn", short.alias("short"))


@query(
    "c4_first_row_per_sku",
    sql.outlook(
        f"""SELECT store_id, product_id, {sql.text('forecasted_for')}, {sql.cents('rt', 'running_total')}
            FROM outlook WHERE rn = 1"""
    ),
)
def first_row_per_sku(spark, sf_dir):
    first = outlook(spark, sf_dir).where(F.col("rn") == 1)
    return first.select(*SKU, "forecasted_for", "running_total")


@query(
    "c5_dashboard_filters",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, category, units_sold FROM flat
            WHERE full_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30' AND category IN ('C1', 'C3')
              AND product_id IN ('P0001', 'P0003', 'P0004', 'P0011')"""
    ),
)
def dashboard_filters(spark, sf_dir):
    kept = filters.dashboard_filter(
        D.inventory(spark, sf_dir),
        start="1996-03-01",
        end="1999-06-30",
        categories=["C1", "C3"],
        products=["P0001", "P0003", "P0004", "P0011"],
    )
    return kept.select(*SKU_DAY, "category", "units_sold")


# Joins


@query(
    "d1_key_lookup",
    sql.folded(
        """SELECT store_id, product_id, COUNT(*) AS facts, CAST(SUM(units_sold) AS BIGINT) AS units_sold
           FROM facts GROUP BY 1, 2"""
    ),
)
def key_lookup(spark, sf_dir):
    star = folded_star(spark, sf_dir)
    by_key = star.fact.groupBy("store_key", "product_key").agg(
        F.count("*").alias("facts"), F.sum("units_sold").alias("units_sold")
    )
    named = by_key.join(star.dim_store, "store_key").join(star.dim_product, "product_key")
    return named.select(*SKU, "facts", "units_sold")


@query(
    "d2_star_join",
    sql.long(
        """SELECT CAST(year(full_date) AS BIGINT) AS year, season, region, category, COUNT(*) AS facts,
                  CAST(SUM(inventory_level) AS BIGINT) AS inventory_level
           FROM flat GROUP BY 1, 2, 3, 4"""
    ),
)
def star_join(spark, sf_dir):
    return (
        joins.star_join(D.star(spark, sf_dir))
        .groupBy("year", "season", "region", "category")
        .agg(F.count("*").alias("facts"), F.sum("inventory_level").alias("inventory_level"))
    )


@query(
    "d3_latest_facts",
    sql.folded(
        f"""SELECT {sql.text()}, store_id, product_id, region, category, inventory_level FROM facts
            WHERE full_date = (SELECT MAX(full_date) FROM facts)"""
    ),
)
def latest_facts(spark, sf_dir):
    latest = joins.latest_facts(folded_star(spark, sf_dir))
    return latest.select(*SKU_DAY, "region", "category", "inventory_level")


@query(
    "d4_forecast_fan_out",
    sql.outlook(
        f"""SELECT store_id, product_id, {sql.text('forecasted_for')}, inventory_level, {sql.cents('d', 'demand')}
            FROM outlook"""
    ),
)
def forecast_fan_out(spark, sf_dir):
    facts = joins.latest_facts(folded_star(spark, sf_dir)).select(*SKU, "inventory_level")
    forecast = D.folded_forecast(spark, sf_dir).select(
        *SKU, F.col("full_date").alias("forecasted_for"), F.col("demand_forecast").alias("demand")
    )
    return joins.with_forecast(facts, forecast)


@query(
    "d5_aggregate_with_detail",
    sql.outlook(
        f"""SELECT store_id, product_id, inventory_level, units_ordered, {sql.cents('dos_h', 'dos')},
                   {sql.cents('next_c', 'next_day_demand')} FROM risk"""
    ),
)
def aggregate_with_detail(spark, sf_dir):
    return skus(spark, sf_dir).select(*SKU, "inventory_level", "units_ordered", "dos", "next_day_demand")


@query(
    "d6_insert_if_absent",
    sql.folded(
        f"""SELECT {sql.text()}, store_id, product_id, units_sold FROM facts
            WHERE full_date = DATE '1995-01-28'"""
    ),
)
def insert_if_absent(spark, sf_dir):
    incoming = D.folded_facts(spark, sf_dir).select(*SKU_DAY, "units_sold")
    loaded = incoming.where(F.col("full_date") < F.lit("1995-01-28").cast("date"))
    return joins.insert_if_absent(loaded, incoming, SKU_DAY)


@query(
    "d7_upsert_members",
    """SELECT product_id, category, category <> 'C3' AS was_known,
              CASE WHEN category IN ('C2', 'C4') AND NOT seen THEN 'Inactive'
                   WHEN category = 'C1' THEN 'active' ELSE 'Active' END AS product_status
       FROM (SELECT printf('P%04d', n) AS product_id, 'C' || CAST(n % 5 AS VARCHAR) AS category, n % 5 <> 4 AS seen
             FROM (SELECT DISTINCT p_partkey // 80 AS n FROM part))""",
)
def upsert_members(spark, sf_dir):
    """Known members: all but C3; C2 and C4 are inactive; the batch brings all but C4."""
    category = F.col("category")
    members = D.products(spark, sf_dir)
    status = F.when(category.isin("C2", "C4"), "Inactive").when(category == "C1", "active").otherwise("Active")
    known = joins.assign_keys(
        members.where(category != "C3").withColumn("product_status", status), "product_id", "product_key"
    )
    batch = members.where(category != "C4").withColumn("product_status", F.lit("Active"))
    merged = joins.upsert_members(
        known, batch, "product_id", "product_key", "product_status", "Active", "Inactive"
    )
    was_known = F.col("product_key") <= known.agg(F.max("product_key")).scalar()
    return merged.select("product_id", "category", "product_status", was_known.alias("was_known"))


@query(
    "d8_horizon_grid",
    sql.folded(
        """SELECT store_id, product_id, CAST(DATE '1995-01-29' + CAST(o AS INTEGER) AS VARCHAR) AS full_date
           FROM (SELECT DISTINCT store_id, product_id FROM facts), range(7) AS days(o)"""
    ),
)
def horizon_grid(spark, sf_dir):
    assortment = D.folded_facts(spark, sf_dir).select(*SKU).distinct()
    return joins.horizon_grid(assortment, F.lit("1995-01-29").cast("date"))


# Aggregations


@query("e1_distinct_members", sql.long("SELECT DISTINCT store_id, region, category FROM flat"))
def distinct_members(spark, sf_dir):
    return D.inventory(spark, sf_dir).select("store_id", "region", "category").distinct()


@query("e2_latest", sql.long(f"SELECT {sql.text()} FROM (SELECT MAX(full_date) AS full_date FROM flat)"))
def latest(spark, sf_dir):
    return aggregates.latest(D.inventory(spark, sf_dir), "full_date")


@query(
    "e3_monthly_stock",
    sql.long(
        """SELECT CAST(year(full_date) AS BIGINT) AS year, CAST(month(full_date) AS BIGINT) AS month, store_id,
                  product_id, CAST(SUM(units_sold) AS BIGINT) AS total_units_sold,
                  CAST(SUM(inventory_level) AS BIGINT) AS total_inventory_sum,
                  COUNT(DISTINCT full_date) AS days_observed
           FROM flat GROUP BY 1, 2, 3, 4"""
    ),
)
def monthly_stock(spark, sf_dir):
    star = D.star(spark, sf_dir)
    stock = aggregates.monthly_stock(star.fact, star.dim_date, unique_days=False)
    named = stock.join(star.dim_store, "store_key").join(star.dim_product, "product_key")
    return named.select("year", "month", *SKU, "total_units_sold", "total_inventory_sum", "days_observed")


@query(
    "e4_smallest_cover",
    sql.outlook(f"SELECT store_id, product_id, {sql.cents('dos_h', 'dos')} FROM risk"),
)
def smallest_cover(spark, sf_dir):
    decides = filters.short_or_covered(F.col("is_less_than_demand"), F.col("last_rn") >= marts.HORIZON)
    return (
        marts.folded_outlook(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))
        .where(decides)
        .groupBy(*SKU)
        .agg(F.min(marts.days_of_supply_candidate()).alias("dos"))
    )


@query(
    "e5_weighted_mean",
    sql.long(
        f"""SELECT category, {sql.half_up('SUM(price_c * units_sold)', '100 * SUM(units_sold)', 4)} AS price
            FROM flat GROUP BY 1"""
    ),
)
def weighted_mean(spark, sf_dir):
    mean = aggregates.weighted_mean(F.col("selling_price"), F.col("units_sold"))
    prices = D.inventory(spark, sf_dir).groupBy("category").agg(mean.alias("price"))
    return prices.withColumn("price", F.round("price", 4))


@query(
    "e6_conditional_sums",
    sql.long(
        f"""SELECT category, CAST(SUM(CASE WHEN promo THEN units_sold ELSE 0 END) AS BIGINT) AS promoted_units,
                   {sql.half_up('COUNT(*) FILTER (promo)', 'COUNT(*)', 6)} AS promotion_frequency
            FROM flat GROUP BY 1"""
    ),
)
def conditional_sums(spark, sf_dir):
    promoted = F.col("is_promotion_active")
    return (
        D.inventory(spark, sf_dir)
        .groupBy("category")
        .agg(
            aggregates.sum_where(promoted, F.col("units_sold")).alias("promoted_units"),
            F.round(aggregates.frequency(promoted), 6).alias("promotion_frequency"),
        )
    )


@query(
    "e7_share_below",
    sql.outlook(
        f"SELECT region, {sql.half_up('COUNT(*) FILTER (dos_h < 200)', 'COUNT(*)', 6)} AS share FROM risk GROUP BY 1"
    ),
)
def share_below(spark, sf_dir):
    low = aggregates.share_below(F.col("dos"), 2)
    return skus(spark, sf_dir).groupBy("region").agg(F.round(low, 6).alias("share"))


@query(
    "e8_drill_down",
    sql.long(
        """SELECT CASE WHEN GROUPING(store_id) = 1 THEN 'portfolio' WHEN GROUPING(product_id) = 1 THEN 'store'
                       ELSE 'sku' END AS level, store_id, product_id,
                  CAST(SUM(units_sold) AS BIGINT) AS units_sold
           FROM flat GROUP BY ROLLUP (store_id, product_id)"""
    ),
)
def drill_down(spark, sf_dir):
    return aggregates.drill_down(D.inventory(spark, sf_dir), {"units_sold": F.col("units_sold")})


@query(
    "e9_category_breakdown",
    sql.long(
        """SELECT category, CAST(SUM(inventory_level) AS BIGINT) AS on_hand,
                  CAST(SUM(units_ordered) AS BIGINT) AS on_order FROM flat GROUP BY 1"""
    ),
)
def category_breakdown(spark, sf_dir):
    return aggregates.breakdown(
        D.inventory(spark, sf_dir),
        "category",
        F.sum("inventory_level").alias("on_hand"),
        F.sum("units_ordered").alias("on_order"),
    )


@query(
    "e10_count_matrix",
    sql.long(
        f"""SELECT forecast_accuracy_flag, COUNT(*) FILTER (strict = 'accurate') AS "accurate",
                   COUNT(*) FILTER (strict = 'over-forecast') AS "over-forecast",
                   COUNT(*) FILTER (strict = 'under-forecast') AS "under-forecast"
            FROM (SELECT {sql.flag(10)} AS forecast_accuracy_flag, {sql.flag(5)} AS strict FROM flat) GROUP BY 1"""
    ),
)
def count_matrix(spark, sf_dir):
    forecast, sold = F.col("demand_forecast"), F.col("units_sold")
    pairs = D.inventory(spark, sf_dir).select(
        accuracy_flag(forecast, sold).alias("forecast_accuracy_flag"),
        accuracy_flag(forecast, sold, "0.05").alias("strict"),
    )
    return aggregates.count_matrix(pairs, "forecast_accuracy_flag", "strict", LABELS)


# Windows


def numbered(spark, sf_dir):
    return unfolded(running_demand(D.folded_forecast(spark, sf_dir)))


@query(
    "f1_running_sum",
    sql.outlook(
        f"SELECT store_id, product_id, {sql.text('forecasted_for')}, {sql.cents('rt', 'running_total')} FROM numbered"
    ),
)
def running_sum(spark, sf_dir):
    return numbered(spark, sf_dir).select(*SKU, F.col("full_date").alias("forecasted_for"), "running_total")


@query(
    "f2_row_number",
    sql.outlook(
        f"SELECT store_id, product_id, {sql.text('forecasted_for')}, CAST(rn AS BIGINT) AS rn FROM numbered"
    ),
)
def row_number(spark, sf_dir):
    rows = numbered(spark, sf_dir)
    return rows.select(*SKU, F.col("full_date").alias("forecasted_for"), "rn")


@query(
    "f3_shortfall_flag",
    sql.outlook(
        f"""SELECT store_id, product_id, {sql.text('forecasted_for')}, short AS is_less_than_demand
            FROM outlook"""
    ),
)
def shortfall_flag(spark, sf_dir):
    stock = joins.latest_facts(folded_star(spark, sf_dir)).select(
        *SKU, effective_inventory(F.col("inventory_level"), F.col("units_ordered")).alias("stock")
    )
    short = is_short(F.col("stock"), F.col("running_total"))
    joined = joins.with_forecast(stock, numbered(spark, sf_dir))
    return joined.select(*SKU, F.col("full_date").alias("forecasted_for"), short.alias("is_less_than_demand"))


# Ordering and bags


@query(
    "g1_export_order",
    sql.long(f"SELECT {sql.text()}, store_id, product_id, units_sold FROM flat"),
)
def export_order(spark, sf_dir):
    flat = D.inventory(spark, sf_dir).select(*SKU_DAY, "units_sold")
    return ordering.export_order(flat, *SKU_DAY)


@query(
    "g2_observed_dates",
    sql.long(f"SELECT DISTINCT {sql.text()}, season FROM flat ORDER BY full_date"),
)
def observed_dates(spark, sf_dir):
    """The order inside the source's derived table cannot be observed, so none is made."""
    return D.inventory(spark, sf_dir).select("full_date", "season").distinct()


@query(
    "g3_bag_append",
    sql.folded(
        """SELECT store_id, COUNT(*) AS row_count, CAST(SUM(demand_c) AS DOUBLE) / 100 AS demand
           FROM (SELECT store_id, demand_c FROM facts UNION ALL SELECT store_id, demand_c FROM forecast
                 UNION ALL SELECT store_id, demand_c FROM forecast) GROUP BY 1"""
    ),
)
def bag_append(spark, sf_dir):
    facts = D.folded_facts(spark, sf_dir).select("store_id", "demand_forecast")
    forecast = D.folded_forecast(spark, sf_dir).select("store_id", "demand_forecast")
    stacked = ordering.stack(facts, forecast, forecast)
    return stacked.groupBy("store_id").agg(
        F.count("*").alias("row_count"), F.sum("demand_forecast").alias("demand")
    )


@query(
    "g4_priority_list",
    sql.outlook(
        """SELECT store_id, product_id, CAST(band AS BIGINT) AS severity_level,
                  CAST(loss AS DOUBLE) / 10000 AS projected_stockout_loss
           FROM health ORDER BY band NULLS LAST, loss DESC, store_id, product_id LIMIT 20"""
    ),
)
def priority_list(spark, sf_dir):
    risks = kpis.sku_risks(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))
    top = ordering.priority_list(risks, 20)
    return top.select(*SKU, "severity_level", "projected_stockout_loss")
