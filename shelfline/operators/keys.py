"""Surrogate keys without a global order."""

from pyspark.sql import Window
from pyspark.sql import functions as F

BUCKETS = 1024


def assign_keys(members, natural_key, key_name, above=None, buckets=BUCKETS):
    """Unique BIGINT keys for distinct members, all above the ``above`` column (default 0).

    Members are hashed into buckets and numbered inside each; bucket ``b`` hands out
    ``b + 1, b + 1 + buckets, ...``. Keys are the same on every recomputation, no task sees
    more than its share of members, and gaps are allowed because keys are opaque.
    """
    bucket = F.pmod(F.xxhash64(natural_key), F.lit(buckets))
    start = F.coalesce(above, F.lit(0)).cast("long") if above is not None else F.lit(0).cast("long")
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    return (
        members.withColumn("_bucket", bucket)
        .withColumn(key_name, start + (within - 1).cast("long") * buckets + F.col("_bucket") + 1)
        .drop("_bucket")
        .select(key_name, *members.columns)
    )
