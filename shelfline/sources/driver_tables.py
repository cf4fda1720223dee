"""The TPC-H-like tables shaped into inventory data.

A store is a nation, a product is a run of 80 parts, so the number of SKUs grows with the
data while each SKU stays equally busy. Two calendars are offered: ``long`` keeps the true
ship dates; ``folded`` maps every row onto 35 days, of which days 0-27 are facts and days
28-34 the forecast horizon, so that every SKU has a current position and a forecast.
"""

import os

from pyspark.sql import functions as F

from shelfline.functions.dates import date_key, season_of, short_date_text, weekday_name
from shelfline.operators.joins import Star, lookup_keys
from shelfline.operators.keys import assign_keys
from shelfline.schemas import FACT, MONEY, RAW_FORECAST_COLUMNS, RAW_INVENTORY_COLUMNS

# Fixed values of the shaping, repeated in the comparison SQL.
PARTS_PER_PRODUCT = 80
CATEGORIES = 5
FIRST_DAY = "1995-01-01"
FOLD_DAYS = 35
FACT_DAYS = 28
WEATHER = ["Sunny", "Rainy", "Cloudy", "Snowy"]


# Columns used here, by table; stated so that no job has to read file footers for them.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "part": "p_partkey long, p_name string, p_type string",
    "orders": "o_orderkey long, o_orderstatus string, o_orderpriority string",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz""",
}


def table(spark, sf_dir, name):
    return spark.read.schema(COLUMNS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def product_number(partkey):
    return F.call_function("div", partkey, F.lit(PARTS_PER_PRODUCT).cast("long"))


def store_id(nationkey):
    return F.format_string("S%03d", nationkey)


def product_id(number):
    """'P' and at least four digits."""
    digits = number.cast("string")
    return F.concat(F.lit("P"), F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0")))


def category(number):
    return F.concat(F.lit("C"), (number % CATEGORIES).cast("string"))


def stores(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", store_id(F.col("n_nationkey")).alias("store_id"), F.col("r_name").alias("region")
    )


def products(spark, sf_dir):
    number = F.col("number")
    return (
        table(spark, sf_dir, "part")
        .select(product_number(F.col("p_partkey")).alias("number"))
        .distinct()
        .select(product_id(number).alias("product_id"), category(number).alias("category"))
    )


def _ship_day(folded):
    day = F.col("l_shipdate").cast("date")
    if not folded:
        return day
    first = F.lit(FIRST_DAY).cast("date")
    return F.date_add(first, F.pmod(F.datediff(day, first), F.lit(FOLD_DAYS)))


def inventory(spark, sf_dir, folded=False):
    """Daily position per store and product with all natural-key columns (flat)."""
    # amounts have two places, so adding a half and cutting is exact and stays in double arithmetic
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    quantity = F.col("l_quantity").cast("long")
    lines = table(spark, sf_dir, "lineitem").select(
        _ship_day(folded).alias("full_date"),
        "l_suppkey",
        product_number(F.col("l_partkey")).alias("number"),
        quantity.alias("quantity"),
        (quantity + F.col("l_partkey") % 50).alias("stock"),
        (F.col("l_orderkey") % 90).alias("ordered"),
        (quantity * (80 + F.col("l_orderkey") % 41)).alias("demand_cents"),
        F.call_function("div", cents, quantity).alias("price_cents"),
        F.floor(F.col("l_discount") * 100 + 0.5).alias("discount"),
        (F.col("l_returnflag") == "R").alias("promotion"),
        (F.col("l_suppkey") % len(WEATHER)).alias("weather"),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    def from_cents(name):
        return (F.col(name).cast("decimal(18,0)") / 100).cast(MONEY)

    daily = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("full_date", "s_nationkey", "number")
        .agg(
            F.sum("stock").cast("int").alias("inventory_level"),
            F.sum("quantity").cast("int").alias("units_sold"),
            F.sum("ordered").cast("int").alias("units_ordered"),
            F.sum("demand_cents").alias("demand_cents"),
            F.min("price_cents").alias("price_cents"),
            F.max("price_cents").alias("competitor_cents"),
            F.max("discount").alias("discount"),
            F.max("promotion").alias("is_promotion_active"),
            F.min("weather").alias("weather"),
        )
    )
    names = F.array(*[F.lit(name) for name in WEATHER])
    return daily.join(stores(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "full_date",
        "store_id",
        product_id(F.col("number")).alias("product_id"),
        category(F.col("number")).alias("category"),
        "region",
        "inventory_level",
        "units_sold",
        "units_ordered",
        from_cents("demand_cents").alias("demand_forecast"),
        from_cents("price_cents").alias("selling_price"),
        F.col("discount").cast(MONEY).alias("discount_applied"),
        F.get(names, F.col("weather").cast("int")).alias("weather_condition"),
        "is_promotion_active",
        from_cents("competitor_cents").alias("competitor_price"),
        season_of(F.month("full_date")).alias("season"),
    )


def _last_fact_day():
    return F.date_add(F.lit(FIRST_DAY).cast("date"), FACT_DAYS - 1)


def folded_facts(spark, sf_dir):
    return inventory(spark, sf_dir, folded=True).where(F.col("full_date") <= _last_fact_day())


def folded_forecast(spark, sf_dir):
    """The seven days after the last fact day, in the shape of the forecast snapshot."""
    return (
        inventory(spark, sf_dir, folded=True)
        .where(F.col("full_date") > _last_fact_day())
        .select(
            _last_fact_day().alias("forecasted_on"),
            "full_date",
            "store_id",
            "product_id",
            "category",
            "region",
            "selling_price",
            "discount_applied",
            "weather_condition",
            "is_promotion_active",
            "competitor_price",
            "season",
            "demand_forecast",
        )
    )


def date_members(days):
    """dim_date rows for a frame with one ``full_date`` column."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        season_of(F.month(day)).alias("season"),
        F.lit(False).alias("is_holiday"),
        weekday_name(day).alias("weekday_name"),
    )


def dimensions(spark, sf_dir, folded=False):
    """The three dimensions straight from the source tables."""
    days = table(spark, sf_dir, "lineitem").select(_ship_day(folded).alias("full_date")).distinct()
    dim_store = assign_keys(
        stores(spark, sf_dir).select("store_id", "region", F.lit("Active").alias("store_status")),
        "store_id",
        "store_key",
    )
    dim_product = assign_keys(
        products(spark, sf_dir).withColumn("product_status", F.lit("Active")),
        "product_id",
        "product_key",
    )
    return date_members(days), dim_store, dim_product


def star(spark, sf_dir, folded=False):
    """The shaped data as fact and dimensions."""
    dim_date, dim_store, dim_product = dimensions(spark, sf_dir, folded)
    flat = folded_facts(spark, sf_dir) if folded else inventory(spark, sf_dir)
    fact = lookup_keys(
        flat.withColumn("date_key", date_key(F.col("full_date"))), dim_store, dim_product
    ).select(*FACT.fieldNames())
    return Star(fact, dim_date, dim_store, dim_product)


def raw_inventory(flat, *keep):
    """Flat inventory as the text columns of the daily input file, and the columns to ``keep``."""
    values = [
        short_date_text(F.col("full_date")),
        *[F.col(name) for name in ("store_id", "product_id", "category", "region")],
        *[F.col(name).cast("string") for name in ("inventory_level", "units_sold", "units_ordered")],
        *[F.col(name).cast("string") for name in ("demand_forecast", "selling_price", "discount_applied")],
        F.col("weather_condition"),
        F.col("is_promotion_active").cast("int").cast("string"),
        F.col("competitor_price").cast("string"),
        F.col("season"),
    ]
    return flat.select(*[v.alias(name) for v, name in zip(values, RAW_INVENTORY_COLUMNS)], *keep)


def raw_forecast(forecast):
    """Forecast snapshot as the text columns of the forecast input file."""
    values = [
        short_date_text(F.col("forecasted_on")),
        short_date_text(F.col("full_date")),
        *[F.col(name) for name in ("store_id", "product_id", "category", "region")],
        *[F.col(name).cast("string") for name in ("selling_price", "discount_applied")],
        F.col("weather_condition"),
        F.col("is_promotion_active").cast("int").cast("string"),
        F.col("competitor_price").cast("string"),
        F.col("season"),
        F.col("demand_forecast").cast("string"),
    ]
    return forecast.select(*[v.alias(name) for v, name in zip(values, RAW_FORECAST_COLUMNS)])
