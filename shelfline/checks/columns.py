"""Projections and scalar expressions over all rows of their tables."""

from pyspark.sql import functions as F

from shelfline.checks import sql
from shelfline.checks.registry import query
from shelfline.functions import arithmetic, casts, cleaning, dates, rules
from shelfline.plans import loads
from shelfline.sources import driver_tables as D

SQL_SHIP_DAY = "CAST(l_shipdate AS DATE)"
SQL_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


def ship_day():
    return F.col("l_shipdate").cast("date")


def quantity():
    return F.col("l_quantity").cast("long")


def price_cents():
    return F.round(F.col("l_extendedprice") * 100).cast("long")


def lineitem(spark, sf_dir):
    return D.table(spark, sf_dir, "lineitem")


def tally(df, *columns):
    return df.groupBy(*columns).agg(F.count("*").alias("row_count"))


@query(
    "b1_parse_short_date",
    f"SELECT CAST({SQL_SHIP_DAY} AS VARCHAR) AS full_date, COUNT(*) AS row_count FROM lineitem GROUP BY 1",
)
def parse_short_date(spark, sf_dir):
    text = dates.short_date_text(ship_day())
    return tally(lineitem(spark, sf_dir).select(dates.parse_short_date(text).alias("full_date")), "full_date")


@query(
    "b2_date_key",
    f"""SELECT CAST(strftime({SQL_SHIP_DAY}, '%Y%m%d') AS BIGINT) AS date_key, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1""",
)
def date_key(spark, sf_dir):
    return tally(lineitem(spark, sf_dir).select(dates.date_key(ship_day()).alias("date_key")), "date_key")


@query(
    "b3_month_year",
    f"""SELECT CAST(year({SQL_SHIP_DAY}) AS BIGINT) AS year, CAST(month({SQL_SHIP_DAY}) AS BIGINT) AS month,
               COUNT(*) AS row_count FROM lineitem GROUP BY 1, 2""",
)
def month_year(spark, sf_dir):
    days = lineitem(spark, sf_dir).select(F.year(ship_day()).alias("year"), F.month(ship_day()).alias("month"))
    return tally(days, "year", "month")


@query(
    "b4_weekday_name",
    f"""SELECT dayname({SQL_SHIP_DAY}) AS weekday_name,
               rpad(dayname({SQL_SHIP_DAY}), 9, ' ') || '|' AS padded, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1, 2""",
)
def weekday_name(spark, sf_dir):
    names = lineitem(spark, sf_dir).select(
        dates.weekday_name(ship_day()).alias("weekday_name"),
        F.concat(dates.weekday_name(ship_day(), padded=True), F.lit("|")).alias("padded"),
    )
    return tally(names, "weekday_name", "padded")


@query(
    "b5_text_to_count",
    """SELECT CAST(l_quantity AS BIGINT) AS units, COUNT(*) AS row_count FROM lineitem GROUP BY 1""",
)
def text_to_count(spark, sf_dir):
    text = quantity().cast("string")
    return tally(lineitem(spark, sf_dir).select(casts.to_count(text).alias("units")), "units")


@query(
    "b6_text_to_money",
    f"""SELECT l_returnflag, CAST(CAST(SUM(({SQL_CENTS} * 10 + l_orderkey % 10 + 5) // 10) AS BIGINT) AS DOUBLE)
               / 100 AS amount, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1""",
)
def text_to_money(spark, sf_dir):
    mills = price_cents() * 10 + F.col("l_orderkey") % 10
    text = F.format_string("%d.%03d", F.call_function("div", mills, F.lit(1000)), mills % 1000)
    typed = lineitem(spark, sf_dir).select("l_returnflag", casts.to_money(text).alias("amount"))
    return typed.groupBy("l_returnflag").agg(
        F.sum("amount").alias("amount"), F.count("*").alias("row_count")
    )


@query(
    "b7_text_to_money_or_null",
    f"""SELECT l_returnflag, CAST(CAST(SUM(CASE WHEN l_linenumber > 1 THEN {SQL_CENTS} END) AS BIGINT) AS DOUBLE)
               / 100 AS amount,
               COUNT(*) FILTER (l_linenumber > 1) AS known, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1""",
)
def text_to_money_or_null(spark, sf_dir):
    text = F.when(F.col("l_linenumber") > 1, (price_cents().cast("decimal(18,0)") / 100).cast("string")).otherwise("")
    typed = lineitem(spark, sf_dir).select("l_returnflag", casts.to_money_or_null(text).alias("amount"))
    return typed.groupBy("l_returnflag").agg(
        F.sum("amount").alias("amount"),
        F.count("amount").alias("known"),
        F.count("*").alias("row_count"),
    )


@query(
    "b8_is_one",
    """SELECT l_returnflag, l_returnflag = 'R' AS is_promotion_active, COUNT(*) AS row_count
       FROM lineitem GROUP BY 1, 2""",
)
def is_one(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "0")
    flagged = lineitem(spark, sf_dir).select("l_returnflag", casts.is_one(text).alias("is_promotion_active"))
    return tally(flagged, "l_returnflag", "is_promotion_active")


@query(
    "b9_zero_to_null",
    """SELECT l_returnflag, COUNT(*) FILTER (l_linenumber <> 1) AS usable,
              CAST(SUM(l_linenumber - 1) AS BIGINT) AS total, COUNT(*) AS row_count
       FROM lineitem GROUP BY 1""",
)
def zero_to_null(spark, sf_dir):
    divisor = arithmetic.zero_to_null(F.col("l_linenumber") - 1)
    return (
        lineitem(spark, sf_dir)
        .select("l_returnflag", divisor.alias("divisor"))
        .groupBy("l_returnflag")
        .agg(
            F.count("divisor").alias("usable"),
            F.sum("divisor").alias("total"),
            F.count("*").alias("row_count"),
        )
    )


@query(
    "b10_whole_division",
    """SELECT l_linenumber, CAST(SUM(l_partkey // CAST(l_quantity AS BIGINT)) AS BIGINT) AS up,
              CAST(-SUM(l_partkey // CAST(l_quantity AS BIGINT)) AS BIGINT) AS down,
              CAST(SUM(CASE WHEN l_linenumber > 1 THEN l_partkey // (l_linenumber - 1) END) AS BIGINT) AS guarded
       FROM (SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity FROM lineitem)
       GROUP BY 1""",
)
def whole_division(spark, sf_dir):
    part = F.col("l_partkey")
    guarded = arithmetic.whole_division(part, F.col("l_linenumber") - 1)
    return (
        lineitem(spark, sf_dir)
        .groupBy("l_linenumber")
        .agg(
            F.sum(arithmetic.whole_division(part, quantity())).alias("up"),
            F.sum(arithmetic.whole_division(-part, quantity())).alias("down"),
            F.sum(guarded).alias("guarded"),
        )
    )


def _rounded_sum(places):
    scale = 10**places
    value = f"({2 * scale} * {SQL_CENTS} + 100 * q) // (200 * q)"
    return f"CAST(CAST(SUM({value}) AS BIGINT) AS DOUBLE) / {scale} AS places_{places}"


@query(
    "b11_rounded_ratio",
    f"""SELECT l_returnflag, {_rounded_sum(0)}, {_rounded_sum(1)}, {_rounded_sum(2)}
        FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY 1""",
)
def rounded_ratio(spark, sf_dir):
    amount = price_cents().cast("decimal(18,0)") / 100
    return (
        lineitem(spark, sf_dir)
        .groupBy("l_returnflag")
        .agg(
            *[
                F.sum(arithmetic.rounded_ratio(amount, quantity(), places)).alias(f"places_{places}")
                for places in (0, 1, 2)
            ]
        )
    )


@query(
    "b12_clamp_at_zero",
    sql.long(
        """SELECT store_id, CAST(SUM(greatest(units_ordered - units_sold, 0)) AS DOUBLE) AS excess
           FROM flat GROUP BY 1"""
    ),
)
def clamp_at_zero(spark, sf_dir):
    excess = arithmetic.at_least_zero(F.col("units_ordered") - F.col("units_sold"))
    return D.inventory(spark, sf_dir).groupBy("store_id").agg(F.sum(excess).alias("excess"))


@query(
    "b13_label_ladder",
    sql.long(
        """SELECT CASE WHEN out THEN 'Critical' WHEN tenths > 40 THEN 'Overstocked'
                       WHEN tenths >= 20 THEN 'Healthy' WHEN tenths >= 10 THEN 'Low' END AS status,
                  CASE WHEN out AND tenths < 10 THEN 'Order more and delivery by tomorrow'
                       WHEN out THEN 'Delivery by tomorrow'
                       WHEN tenths > 40 AND units_ordered > 0 THEN 'Cancel existing order and apply discount'
                       WHEN tenths > 40 THEN 'Apply discount' WHEN tenths >= 20 THEN 'No action required'
                       WHEN tenths >= 10 THEN 'Order more' ELSE 'No action required' END AS action,
                  CAST(CASE WHEN out AND tenths < 10 THEN 1 WHEN out THEN 2 WHEN tenths > 40 THEN 4
                       WHEN tenths >= 20 THEN 5 WHEN tenths >= 10 THEN 3 END AS BIGINT) AS severity,
                  COUNT(*) AS row_count
           FROM rated GROUP BY 1, 2, 3""",
        """rated AS (
             SELECT *, (20 * (inventory_level + units_ordered) + units_sold) // (2 * units_sold) AS tenths,
                    demand_c > 100 * inventory_level AS out FROM flat)""",
    ),
)
def label_ladder(spark, sf_dir):
    flat = D.inventory(spark, sf_dir)
    on_hand, on_order, demand = (F.col(n) for n in ("inventory_level", "units_ordered", "demand_forecast"))
    cover = arithmetic.rounded_ratio(
        arithmetic.effective_inventory(on_hand, on_order), F.col("units_sold"), 1
    )
    labels = flat.select(
        rules.health_status(on_hand, demand, cover).alias("status"),
        rules.recommended_action(on_hand, on_order, demand, cover).alias("action"),
        rules.severity_level(on_hand, demand, cover).alias("severity"),
    )
    return tally(labels, "status", "action", "severity")


@query("b14_trim", "SELECT p_partkey, trim(p_name) AS p_name FROM part")
def trim(spark, sf_dir):
    padded = D.table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name")
    )
    return padded.select("p_partkey", *cleaning.trimmed("p_name"))


@query(
    "b15_constant_columns",
    """SELECT DISTINCT printf('P%04d', p_partkey // 80) AS product_id, 'Active' AS product_status,
              FALSE AS is_holiday FROM part""",
)
def constant_columns(spark, sf_dir):
    return D.products(spark, sf_dir).select(
        "product_id", F.lit(loads.ACTIVE).alias("product_status"), F.lit(False).alias("is_holiday")
    )


_RAW_FORECAST_VALUES = f"""
    '28/01/95' AS forecasted_on, {sql.short_text()} AS full_date, store_id, product_id, category, region,
    {sql.money_text('price_c')} AS selling_price, CAST(disc AS VARCHAR) || '.00' AS discount_applied,
    weather AS weather_condition, CASE WHEN promo THEN '1' ELSE '0' END AS is_promotion_active,
    {sql.money_text('competitor_c')} AS competitor_price, season, {sql.money_text('demand_c')} AS demand_forecast"""


@query("b16_rename_columns", sql.folded(f"SELECT {_RAW_FORECAST_VALUES} FROM forecast"))
def rename_columns(spark, sf_dir):
    raw = D.raw_forecast(D.folded_forecast(spark, sf_dir))
    return raw.withColumnsRenamed(loads.FORECAST_NAMES)


@query(
    "b17_effective_inventory",
    sql.long(
        "SELECT store_id, CAST(SUM(inventory_level + units_ordered) AS BIGINT) AS effective FROM flat GROUP BY 1"
    ),
)
def effective_inventory(spark, sf_dir):
    effective = arithmetic.effective_inventory(F.col("inventory_level"), F.col("units_ordered"))
    return D.inventory(spark, sf_dir).groupBy("store_id").agg(F.sum(effective).alias("effective"))


@query(
    "b18_units_deviation",
    sql.long(
        """SELECT store_id, CAST(CAST(SUM(demand_c - 100 * units_sold) AS BIGINT) AS DOUBLE) / 100 AS net,
                  CAST(CAST(SUM(abs(demand_c - 100 * units_sold)) AS BIGINT) AS DOUBLE) / 100 AS gross
           FROM flat GROUP BY 1"""
    ),
)
def units_deviation(spark, sf_dir):
    deviation = arithmetic.units_deviation(F.col("demand_forecast"), F.col("units_sold"))
    return (
        D.inventory(spark, sf_dir)
        .groupBy("store_id")
        .agg(F.sum(deviation).alias("net"), F.sum(F.abs(deviation)).alias("gross"))
    )


@query(
    "b19_relative_gap",
    sql.long(
        """SELECT store_id, CAST(CASE WHEN 10 * demand_c > 1100 * units_sold THEN 1
                  WHEN 10 * demand_c < 900 * units_sold THEN -1 ELSE 0 END AS BIGINT) AS gap,
                  COUNT(*) AS row_count FROM flat GROUP BY 1, 2"""
    ),
)
def relative_gap(spark, sf_dir):
    gap = rules.relative_gap(F.col("demand_forecast"), F.col("units_sold"))
    return tally(D.inventory(spark, sf_dir).select("store_id", gap.alias("gap")), "store_id", "gap")


@query("b20_season", sql.long("SELECT season, COUNT(*) AS row_count FROM flat GROUP BY 1"))
def season(spark, sf_dir):
    flat = D.inventory(spark, sf_dir)
    return tally(flat.select(dates.season_of(F.month("full_date")).alias("season")), "season")


@query(
    "b21_baseline_demand",
    sql.folded(
        """SELECT full_date, store_id, product_id, CAST(
             (greatest(10, 200000 // (price_c // 20)) * CASE WHEN promo THEN 13 ELSE 10 END
              * CASE WHEN weather = 'Rainy' AND category = 'C0' THEN 11 ELSE 10 END
              * CASE WHEN season = 'Winter' AND category = 'C1' THEN 12 ELSE 10 END + 5) // 10 AS DOUBLE) / 100
             AS baseline
           FROM (SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM flat)"""
    ),
)
def baseline_demand(spark, sf_dir):
    price = (F.call_function("div", (F.col("selling_price") * 100).cast("long"), F.lit(20)).cast("decimal(12,0)"))
    return D.inventory(spark, sf_dir, folded=True).select(
        "full_date",
        "store_id",
        "product_id",
        arithmetic.baseline_demand(
            price / 100,
            F.col("is_promotion_active"),
            (F.col("weather_condition") == "Rainy") & (F.col("category") == "C0"),
            (F.col("season") == "Winter") & (F.col("category") == "C1"),
        ).alias("baseline"),
    )


@query(
    "b22_date_texts",
    f"""SELECT strftime({SQL_SHIP_DAY}, '%d/%m/%y') AS short_date, strftime({SQL_SHIP_DAY}, '%Y%m%d') AS token,
               COUNT(*) AS row_count FROM lineitem GROUP BY 1, 2""",
)
def date_texts(spark, sf_dir):
    texts = lineitem(spark, sf_dir).select(
        dates.short_date_text(ship_day()).alias("short_date"), dates.file_token(ship_day()).alias("token")
    )
    return tally(texts, "short_date", "token")


@query(
    "b23_lower_text",
    "SELECT lower(o_orderpriority) AS priority, COUNT(*) AS row_count FROM orders GROUP BY 1",
)
def lower_text(spark, sf_dir):
    orders = D.table(spark, sf_dir, "orders")
    return tally(orders.select(cleaning.lower_text(F.col("o_orderpriority")).alias("priority")), "priority")


@query(
    "b24_yes_no_to_digit",
    """SELECT CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' ELSE 'maybe' END AS promotion,
              COUNT(*) AS row_count FROM lineitem GROUP BY 1""",
)
def yes_no_to_digit(spark, sf_dir):
    answer = (
        F.when(F.col("l_returnflag") == "R", "yes").when(F.col("l_returnflag") == "A", "no").otherwise("maybe")
    )
    return tally(
        lineitem(spark, sf_dir).select(cleaning.yes_no_to_digit(answer).alias("promotion")), "promotion"
    )


@query(
    "b25_known_or_first",
    sql.long(
        """SELECT CASE WHEN weather = 'Snowy' THEN 'Cloudy' ELSE weather END AS weather, COUNT(*) AS row_count
           FROM flat GROUP BY 1"""
    ),
)
def known_or_first(spark, sf_dir):
    known = ["Cloudy", "Rainy", "Sunny"]
    weather = cleaning.known_or_first(F.col("weather_condition"), known)
    return tally(D.inventory(spark, sf_dir).select(weather.alias("weather")), "weather")
