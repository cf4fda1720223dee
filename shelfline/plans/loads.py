"""Warehouse loads: first load from history, daily batches and the forecast snapshot."""

from pyspark.sql import functions as F

from shelfline.functions.casts import is_one, to_count, to_money, to_money_or_null
from shelfline.functions.dates import date_key, parse_short_date, weekday_name
from shelfline.operators.aggregates import first_wins, unique_members
from shelfline.operators.filters import at_latest, with_key
from shelfline.operators.joins import insert_if_absent, lookup_keys, member_changes, upsert_members
from shelfline.operators.keys import assign_keys
from shelfline.schemas import FACT, FACT_KEY, FORECAST, FOREIGN_KEYS, NON_NEGATIVE

# Member states. The first load spells the product state in lower case.
HISTORY_PRODUCT_STATUS = "active"
ACTIVE, INACTIVE = "Active", "Inactive"

# Warehouse names of the input files' columns.
INVENTORY_NAMES = {
    "Date": "full_date",
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Category": "category",
    "Region": "region",
    "Inventory Level": "inventory_level",
    "Units Sold": "units_sold",
    "Units Ordered": "units_ordered",
    "Demand Forecast": "demand_forecast",
    "Price": "selling_price",
    "Discount": "discount_applied",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "is_promotion_active",
    "Competitor Pricing": "competitor_price",
    "Seasonality": "season",
}
FORECAST_NAMES = {
    "Forecasted On": "forecasted_on",
    "Date": "full_date",
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Category": "category",
    "Region": "region",
    "Price": "selling_price",
    "Discount": "discount_applied",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "is_promotion_active",
    "Competitor Pricing": "competitor_price",
    "Seasonality": "season",
    "Demand Forecast": "demand_forecast",
}

KEYED = ["store_key", "product_key"]
NATURAL = ["store_id", "product_id"]


def with_dates(raw):
    """Raw inventory with its parsed date."""
    return raw.withColumn("full_date", parse_short_date(F.col("Date")))


def latest_batch(raw):
    """Rows of the newest date in raw."""
    return at_latest(with_dates(raw), "full_date").drop("full_date")


def not_older_than(raw, newest_loaded):
    """Rows dated on or after an already loaded date key; all rows if there is none."""
    if newest_loaded is None:
        return raw
    return raw.where(date_key(parse_short_date(F.col("Date"))) >= newest_loaded)


def store_members(raw):
    stores = raw.select(F.col("Store ID").alias("store_id"), F.col("Region").alias("region"))
    return unique_members(stores, "store_id", "region")


def product_members(raw):
    products = raw.select(F.col("Product ID").alias("product_id"), F.col("Category").alias("category"))
    return unique_members(products, "product_id", "category")


def observed_dates(raw):
    """Distinct dates with their seasons; a text is parsed once, not once a row."""
    seen = raw.select("Date", "Seasonality").distinct()
    return seen.select(parse_short_date(F.col("Date")).alias("full_date"), F.col("Seasonality").alias("season"))


def date_rows(dates, padded=False):
    """dim_date columns for (full_date, season) rows."""
    day = F.col("full_date")
    return dates.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        "season",
        F.lit(False).alias("is_holiday"),
        weekday_name(day, padded).alias("weekday_name"),
    )


def typed_facts(raw):
    """Raw text to typed measures under their warehouse names, natural keys kept."""
    counts = ("inventory_level", "units_sold", "units_ordered")
    money = ("demand_forecast", "selling_price", "discount_applied", "competitor_price")
    return (
        raw.withColumnsRenamed(INVENTORY_NAMES)
        .withColumns({name: to_count(F.col(name)) for name in counts})
        .withColumns({name: to_money(F.col(name)) for name in money})
        .withColumn("is_promotion_active", is_one(F.col("is_promotion_active")))
        .withColumn("date_key", date_key(parse_short_date(F.col("full_date"))))
        .select("store_id", "product_id", *[name for name in FACT.fieldNames() if name not in KEYED])
    )


# First load


def history_products(raw, dim_product=None):
    members = product_members(raw).withColumn("product_status", F.lit(HISTORY_PRODUCT_STATUS))
    if dim_product is None or dim_product.isEmpty():
        return assign_keys(members, "product_id", "product_key")
    return upsert_members(
        dim_product, members, "product_id", "product_key", "product_status", HISTORY_PRODUCT_STATUS, INACTIVE
    )


def history_stores(raw, dim_store=None):
    members = store_members(raw).withColumn("store_status", F.lit(ACTIVE))
    if dim_store is None or dim_store.isEmpty():
        return assign_keys(members, "store_id", "store_key")
    return upsert_members(dim_store, members, "store_id", "store_key", "store_status", ACTIVE, INACTIVE)


def history_dates(raw, padded=False, dim_date=None):
    """Raises where one date carries two seasons; known dates stay as they are."""
    rows = date_rows(unique_members(observed_dates(raw), "full_date", "season"), padded)
    if dim_date is None or dim_date.isEmpty():
        return rows
    return dim_date.unionByName(insert_if_absent(dim_date, rows, ["date_key"]).select(*dim_date.columns))


# Daily load


def batch_stores(batch):
    return store_members(with_key(batch, "Store ID")).withColumn("store_status", F.lit(ACTIVE))


def batch_products(batch):
    return product_members(with_key(batch, "Product ID")).withColumn("product_status", F.lit(ACTIVE))


def sync_stores(dim_store, batch):
    return upsert_members(
        dim_store, batch_stores(batch), "store_id", "store_key", "store_status", ACTIVE, INACTIVE
    )


def sync_products(dim_product, batch):
    return upsert_members(
        dim_product,
        batch_products(batch),
        "product_id",
        "product_key",
        "product_status",
        ACTIVE,
        INACTIVE,
    )


def changed_stores(dim_store, batch):
    return member_changes(dim_store, batch_stores(batch), "store_id", "store_status", INACTIVE)


def changed_products(dim_product, batch):
    return member_changes(
        dim_product, batch_products(batch), "product_id", "product_status", INACTIVE
    )


def new_dates(dim_date, batch, padded=False):
    """Dates of the batch that are not known yet, with the first season seen."""
    seasons = first_wins(observed_dates(batch).distinct(), ["full_date"])
    return insert_if_absent(dim_date, date_rows(seasons, padded), ["date_key"])


def sync_dates(dim_date, batch, padded=False):
    """Existing dates stay as they are; new ones are added."""
    return dim_date.unionByName(new_dates(dim_date, batch, padded).select(*dim_date.columns))


def touched_partitions(fact, rows):
    """The part of the fact on the dates of the batch, however far apart these are.

    The join on the batch's distinct dates prunes partitions while the query runs, so a late row adds
    the one partition of its date. A batch has few dates (one row each is broadcast); the condition on
    them is what makes Spark consider the pruning.
    """
    days = F.broadcast(rows.select("date_key").where("date_key > 0").distinct())
    return fact.join(days, "date_key", "left_semi").select(*fact.columns)


def checked_facts(batch, dim_date, dim_store, dim_product):
    """Typed rows with their keys and the first rule they break, NULL if none.

    Rules come from the schema: a key without a member of its dimension, a negative measure.
    """
    members = {
        "date_key": dim_date.select("date_key", F.lit(True).alias("_date")),
        "store_key": dim_store.select("store_id", "store_key"),
        "product_key": dim_product.select("product_id", "product_key"),
    }
    rows = (
        typed_facts(batch)
        .join(members["date_key"], "date_key", "left")
        .join(members["store_key"], "store_id", "left")
        .join(members["product_key"], "product_id", "left")
    )
    rule = F.lit(None).cast("string")
    for name in reversed(NON_NEGATIVE):
        rule = F.when(F.col(name) < 0, f"{name} is negative").otherwise(rule)
    for key, dimension in reversed(FOREIGN_KEYS.items()):
        found = F.col("_date") if key == "date_key" else F.col(key)
        rule = F.when(found.isNull(), f"{key} is not in {dimension}").otherwise(rule)
    return rows.withColumn("rule", rule).drop("_date")


def first_rows(checked):
    """The first row per rule and primary key, and how many (``copies``) there are of it.

    A whole row as minimum makes the grouping sort, on both sides of its shuffle. A sort compares the first
    eight bytes of its first key before it looks at a row; so the product comes first, of which there are
    many, and the rule, NULL in nearly all rows, last. The append sorts by product, too.
    """
    rest = [name for name in FACT.fieldNames() if name not in FACT_KEY]
    first = checked.groupBy(*FACT_KEY[::-1], *NATURAL, "rule").agg(F.min(F.struct(*rest)).alias("_row"), F.count("*").alias("copies"))
    return first.select("rule", *NATURAL, *FACT_KEY, "_row.*", "copies")


def good_rows(first):
    """Facts of :func:`first_rows` without a broken rule."""
    return first.where(F.col("rule").isNull()).select(*FACT.fieldNames())


def rejected_rows(first):
    """Rows (rule, date_key, store_id, product_id, row_count) of all broken rules, repeated keys included.

    Of several good rows with one primary key the first is loaded, the others are counted here.
    """
    names = ["date_key", *NATURAL]
    broken = first.where(F.col("rule").isNotNull()).groupBy("rule", *names).agg(F.sum("copies").alias("row_count"))
    repeated = first.where("rule is null and copies > 1").select(
        F.lit("primary key is repeated").alias("rule"), *names, (F.col("copies") - 1).alias("row_count")
    )
    return broken.unionByName(repeated)


def missing_facts(fact, rows):
    """Rows whose key is not loaded yet; only the partitions of their dates are read.

    The product leads the join's sort: there are far more products than dates in a batch.
    """
    return insert_if_absent(touched_partitions(fact, rows), rows, FACT_KEY[::-1]).select(*FACT.fieldNames())


def typed_forecast(raw):
    """Forecast text to the typed snapshot; empty numbers become NULL."""
    renamed = raw.withColumnsRenamed(FORECAST_NAMES)
    dates = {name: parse_short_date(F.col(name)) for name in ("forecasted_on", "full_date")}
    money = ("selling_price", "discount_applied", "competitor_price", "demand_forecast")
    amounts = {name: to_money_or_null(F.col(name)) for name in money}
    promotion = {"is_promotion_active": is_one(F.col("is_promotion_active"))}
    return renamed.withColumns({**dates, **amounts, **promotion}).select(*FORECAST.fieldNames())


def newest_snapshot(raw_forecast):
    """With several forecast files only the one forecasted last stays."""
    made_on = raw_forecast.withColumn("made_on", parse_short_date(F.col("Forecasted On")))
    return at_latest(made_on, "made_on").drop("made_on")


def forecast_date(raw_forecast):
    """The newest date the rows were forecasted on, None without rows."""
    return raw_forecast.agg(F.max(parse_short_date(F.col("Forecasted On")))).first()[0]
