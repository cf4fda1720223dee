"""Ordering for exports and top lists."""

from pyspark.sql import functions as F


def export_order(df, *columns):
    """Ascending with NULLs last; a range-partitioned sort, for exported files only."""
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in columns])


def priority_list(skus, k, severity="severity_level", loss="projected_stockout_loss"):
    """The ``k`` most urgent SKUs: severity first, then revenue at risk."""
    return skus.orderBy(
        F.col(severity).asc_nulls_last(), F.col(loss).desc_nulls_last(), "store_id", "product_id"
    ).limit(k)


def stack(first, *others):
    """Bag union by column name."""
    for other in others:
        first = first.unionByName(other)
    return first
