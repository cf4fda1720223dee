"""Row filters."""

from functools import reduce

from pyspark.sql import functions as F

from shelfline.functions.dates import date_key

MOST_KEYS = 100


def at_latest(df, column):
    """Rows whose ``column`` equals its overall maximum, as an uncorrelated scalar subquery.

    On a table partitioned by ``column`` the subquery result becomes a partition filter.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def with_key(df, column):
    return df.where(F.col(column).isNotNull())


def short_or_covered(short, reaches_last_day):
    """Forecast rows that decide the days of supply."""
    return short | (reaches_last_day & ~short)


def dashboard_star(star, start=None, end=None, categories=None, products=None, most_keys=MOST_KEYS):
    """The star with only those facts that pass the dashboard filters.

    Dates bound the date key, which prunes partitions. Categories and products are looked up in the
    product dimension first: up to ``most_keys`` keys become a list, which Parquet checks against the
    Bloom filters and page bounds of the product key, so row groups and pages without them are not
    read; more keys filter by a join.
    """
    fact, products_seen = star.fact, star.dim_product
    if start is not None:
        fact = fact.where(F.col("date_key") >= date_key(F.lit(start).cast("date")))
    if end is not None:
        fact = fact.where(F.col("date_key") <= date_key(F.lit(end).cast("date")))
    if categories is None and products is None:
        return star._replace(fact=fact)
    products_seen = dashboard_filter(products_seen, categories=categories, products=products)
    keys = [row["product_key"] for row in products_seen.select("product_key").limit(most_keys + 1).collect()]
    if len(keys) > most_keys:
        fact = fact.join(products_seen.select("product_key"), "product_key", "left_semi").select(*fact.columns)
    else:
        fact = fact.where(reduce(lambda a, b: a | b, [F.col("product_key") == key for key in sorted(keys)], F.lit(False)))
    return star._replace(fact=fact, dim_product=products_seen)


def dashboard_filter(df, start=None, end=None, categories=None, products=None):
    """Optional date range, category and product filters; all push down to Parquet."""
    if start is not None:
        df = df.where(F.col("full_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("full_date") <= F.lit(end).cast("date"))
    if categories is not None:
        df = df.where(F.col("category").isin(list(categories)))
    if products is not None:
        df = df.where(F.col("product_id").isin(list(products)))
    return df
