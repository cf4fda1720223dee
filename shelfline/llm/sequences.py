"""Order over a whole table: rows in order, running totals and neighbours, with no task for all rows.

``in_order`` range-partitions and sorts the rows once and writes them with their place. All else works
part by part; what crosses the border of two parts is one small row per part. Parts are cut by sampled
bounds of all order columns, with the row's place in the source last, so rows of one key, and even equal
rows, spread over several parts.

Row tables of one row per part go through one task and are broadcast: as many rows as shuffle partitions.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.common import stage

PLACE = "__place"
PART = "__part"


def in_order(rows, order):
    """``rows`` staged in the given order, with ``__place`` (unique, ascending) and ``__part``."""
    marked = rows.withColumn("__source", F.monotonically_increasing_id())
    placed = marked.repartitionByRange(*order, "__source").sortWithinPartitions(*order, "__source").drop("__source")
    placed = stage(placed.withColumn(PLACE, F.monotonically_increasing_id()), "in-order")
    return placed.withColumn(PART, F.shiftright(PLACE, 33))


def running(placed, values, keys=(), how="sum"):
    """``placed`` with the running total of each named expression, up to and with the row; staged.

    ``keys`` are leading order columns: totals begin anew with each key. ``how`` is "sum" or "xor".
    """
    keys, names = list(keys), list(values)
    fold = F.bit_xor if how == "xor" else F.sum
    rows = placed.withColumns({f"__v_{name}": value for name, value in values.items()})
    within = Window.partitionBy(PART, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({name: fold(f"__v_{name}").over(within) for name in names})
    local = stage(local.drop(*[f"__v_{name}" for name in names]), "running")

    def edge(pick, columns):
        return pick(F.struct(*columns), PLACE)

    first, last = edge(F.min_by, [F.lit(0).alias("_"), *keys]), edge(F.max_by, [F.lit(0).alias("_"), *keys, *names])
    ends = local.groupBy(PART).agg(first.alias("first"), last.alias("last"))
    nothing = [F.lit(None).cast(local.schema[name].dataType).alias(name) for name in names]
    heads = ends.select(PART, F.lit(0).alias("kind"), *[F.col(f"first.{key}").alias(key) for key in keys], *nothing)
    tails = ends.select(PART, F.lit(1).alias("kind"), *[F.col(f"last.{name}").alias(name) for name in [*keys, *names]])
    earlier = Window.partitionBy(*keys).orderBy(PART, "kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.unionByName(tails).withColumns({f"__c_{name}": fold(name).over(earlier) for name in names})
    carried = carried.where("kind = 0").select(F.col(PART).alias("__p"), *[F.col(key).alias(f"__k_{key}") for key in keys], *[f"__c_{name}" for name in names])
    match = F.col(PART) == F.col("__p")
    for key in keys:
        match &= F.col(key).eqNullSafe(F.col(f"__k_{key}"))
    joined = local.join(F.broadcast(carried), match, "left")
    zero = F.lit(0)
    totals = [
        (F.col(name).bitwiseXOR(F.coalesce(f"__c_{name}", zero)) if how == "xor" else F.col(name) + F.coalesce(f"__c_{name}", zero)).alias(name)
        for name in names
    ]
    return joined.select(*[F.col(name) for name in placed.columns], *totals)


def neighbours(placed, columns):
    """``placed`` with structs ``before`` and ``after``: the columns of the rows next to each row, NULL at the ends."""
    row = F.struct(*columns)
    within = Window.partitionBy(PART).orderBy(PLACE)
    local = placed.withColumns({"before": F.lag(row).over(within), "after": F.lead(row).over(within)})
    ends = placed.groupBy(F.col(PART).alias("__p")).agg(F.min_by(row, PLACE).alias("first"), F.max_by(row, PLACE).alias("last"))
    parts = Window.orderBy("__p")
    ends = ends.select("__p", F.lag("last").over(parts).alias("__b"), F.lead("first").over(parts).alias("__a"))
    joined = local.join(F.broadcast(ends), F.col(PART) == F.col("__p"), "left")
    return joined.withColumns({"before": F.coalesce("before", "__b"), "after": F.coalesce("after", "__a")}).drop("__p", "__a", "__b")
