"""Joins of the star schema.

None carries a broadcast hint: Spark broadcasts a dimension while it is below the session's
threshold and otherwise shuffles on the key, with AQE splitting skewed partitions.
"""

from collections import namedtuple

from pyspark.sql import functions as F

from shelfline.operators.filters import at_latest
from shelfline.operators.keys import assign_keys

Star = namedtuple("Star", "fact dim_date dim_store dim_product")


def lookup_keys(rows, dim_store, dim_product):
    """Replace natural keys by surrogate keys; rows without a member are dropped."""
    return (
        rows.join(dim_store.select("store_id", "store_key"), "store_id")
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .drop("store_id", "product_id")
    )


def star_join(star, fact=None):
    """The fact with the attributes of its date, store and product."""
    fact = star.fact if fact is None else fact
    return (
        fact.join(star.dim_date, "date_key")
        .join(star.dim_store, "store_key")
        .join(star.dim_product, "product_key")
    )


def latest_facts(star, latest=None):
    """Star join of the latest fact date only; the filter runs before the joins.

    ``latest`` is the date key where the caller knows it (from the partition folders), which
    prunes partitions while planning; otherwise a scalar subquery finds it.
    """
    if latest is None:
        return star_join(star, at_latest(star.fact, "date_key"))
    return star_join(star, star.fact.where(F.col("date_key") == latest))


def with_forecast(facts, forecast):
    """Each fact row with all forecast rows of its SKU."""
    return facts.join(forecast, ["store_id", "product_id"])


def insert_if_absent(target, rows, keys):
    """Rows whose key is not in the target yet."""
    return rows.join(target.select(*keys), keys, "left_anti")


def member_changes(target, members, natural_key, status, inactive):
    """Batch members that are new, or known but inactive; empty if the target may stay as it is."""
    unchanged = target.where(F.coalesce(F.col(status) != inactive, F.lit(True)))
    return insert_if_absent(unchanged, members, [natural_key])


def upsert_members(target, members, natural_key, surrogate_key, status, active, inactive):
    """New members get a key; members marked inactive become active; others stay as they are."""
    seen = members.select(natural_key, F.lit(True).alias("_seen"))
    kept = (
        target.join(seen, natural_key, "left")
        .withColumn(
            status,
            F.when(F.col("_seen") & (F.col(status) == inactive), active).otherwise(F.col(status)),
        )
        .select(*target.columns)
    )
    fresh = assign_keys(
        insert_if_absent(target, members, [natural_key]),
        natural_key,
        surrogate_key,
        above=target.agg(F.max(surrogate_key)).scalar(),
    )
    return kept.unionByName(fresh.select(*target.columns))


def horizon_grid(assortment, start, days=7):
    """One row per listed (store, product) and day of the horizon starting at ``start``."""
    horizon = F.sequence(start, F.date_add(start, days - 1))
    return assortment.select("*", F.explode(horizon).alias("full_date"))
