"""Aggregations; all combine on the map side, so a hot key costs no extra shuffle."""

from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.functions.arithmetic import zero_to_null
from shelfline.session import scratch_dir


def first_wins(rows, keys):
    """One whole row per key: the smallest by its remaining columns.

    The source has no arrival order within a batch, so the smallest row stands for the first
    one, which gives the same answer on every run.
    """
    rest = [name for name in rows.columns if name not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*rows.columns)
    )


def unique_members(rows, key, attribute):
    """One row per key; raises where a key carries two attribute values or none.

    The distinct pairs are formed first: that step hashes and combines on the map side, so
    only members, not rows, reach the check.
    """
    pairs = rows.select(key, attribute).distinct()
    clash = F.raise_error(
        F.concat(F.lit(f"{key} has no single {attribute}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    ).cast("string")
    single = F.col(key).isNotNull() & F.col(attribute).isNotNull() & (F.col("_values") == 1)
    return (
        pairs.groupBy(key)
        .agg(F.min(attribute).alias(attribute), F.count("*").alias("_values"))
        .select(key, F.when(single, F.col(attribute)).otherwise(clash).alias(attribute))
    )


def latest(df, column):
    return df.agg(F.max(column).alias(column))


def monthly_stock(fact, dim_date, unique_days=True):
    """Units sold, summed inventory and days observed per month, store and product.

    Grouping happens on the surrogate keys before the store and product joins, so those see
    one row per month and SKU. With the fact key checked by the load each row is a day of its
    own and a plain count equals the distinct count; pass ``unique_days=False`` otherwise.
    """
    days = F.count("date_key") if unique_days else F.count_distinct("date_key")
    return (
        fact.join(dim_date.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month", "store_key", "product_key")
        .agg(
            F.sum("units_sold").alias("total_units_sold"),
            F.sum("inventory_level").alias("total_inventory_sum"),
            days.alias("days_observed"),
        )
    )


def weighted_mean(value, weight):
    return F.sum(value * weight) / zero_to_null(F.sum(weight))


def sum_where(condition, value):
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def frequency(condition):
    """Share of rows that meet the condition."""
    return F.count_if(condition).cast("decimal(18,0)") / zero_to_null(F.count("*")).cast("decimal(18,0)")


def share_below(value, threshold):
    """Share of rows below a threshold; unknown values count as not below."""
    return frequency(F.coalesce(value < threshold, F.lit(False)))


def drill_down(df, measures, totals=None, levels=("store_id", "product_id"), one_row_per_sku=False):
    """Totals for the portfolio, each store and each SKU; ``level`` tells them apart.

    ``measures`` are row expressions by name. They are summed per SKU first, so the rollup
    multiplies one row per SKU and not every row; with ``one_row_per_sku`` the caller says that
    there is nothing to sum. ``totals`` are columns over the summed measures, by default the sums
    themselves.
    """
    depth = F.grouping_id()
    # grouping_id is 3 for the portfolio, 1 for a store and 0 for a SKU
    level = F.when(depth == 0, "sku").when(depth == 1, "store").otherwise("portfolio")
    if one_row_per_sku:
        skus = df.select(*levels, *[value.alias(name) for name, value in measures.items()])
    else:
        skus = df.groupBy(*levels).agg(*[F.sum(value).alias(name) for name, value in measures.items()])
    rolled = skus.rollup(*levels).agg(level.alias("level"), *[F.sum(name).alias(name) for name in measures])
    return rolled.select("level", *levels, *(totals or measures))


def breakdown(df, by, *aggregates):
    return df.groupBy(by).agg(*aggregates)


def _interval(value, spans, bins):
    """(begin, bin) of the one of the sorted, disjoint ``spans`` that holds a value, or NULL."""
    if len(spans) > 1:
        middle = len(spans) // 2
        return F.when(value < spans[middle][0], _interval(value, spans[:middle], bins)).otherwise(
            _interval(value, spans[middle:], bins)
        )
    begin, end = spans[0]
    part = F.call_function("div", value - F.lit(begin).cast("long"), F.lit(-(-(end - begin + 1) // bins)).cast("long"))
    return F.when(value.between(begin, end), F.struct(F.lit(begin).cast("long").alias("begin"), part.alias("bin")))


def quantile_cuts(df, value, shares, bins=1024):
    """One row with the exact quantiles ``cut_0, cut_1, ...`` of a decimal column.

    A quantile is the smallest value with at least ``share`` of all values at or below it. Each
    pass counts the values of the intervals still open in ``bins`` equal parts and narrows every
    interval to the part that holds its quantile, until a part is one value wide; so a pass
    returns at most ``bins`` counts per quantile, and nothing is ordered or gathered. Two open
    intervals are the same or share no value, so a value is counted once a pass, whatever the
    number of quantiles. The values are written once as whole numbers, which every pass reads.
    """
    kind = df.schema[value].dataType
    step = 10**kind.scale
    path = scratch_dir(df.sparkSession, "quantile-values")
    df.where(F.col(value).isNotNull()).select((F.col(value) * step).cast("long").alias("v")).write.parquet(path)
    values = df.sparkSession.read.schema("v long").parquet(path)
    ends = values.agg(F.min("v"), F.max("v"), F.count("*")).first()
    low, high, n = ends
    if not n:
        nothing = F.lit(None).cast(kind)
        return df.sparkSession.range(1).select(*[nothing.alias(f"cut_{i}") for i in range(len(shares))])
    open_parts = [(low, high, 0, share * n) for share in shares]
    while any(begin < end for begin, end, _, _ in open_parts):
        spans = sorted({(begin, end) for begin, end, _, _ in open_parts if begin < end})
        inside = _interval(F.col("v"), spans, bins)
        seen = values.select(inside.alias("p")).where("p is not null").groupBy("p.begin", "p.bin").agg(F.count("*").alias("n"))
        by_begin = {}
        for row in seen.collect():
            by_begin.setdefault(row["begin"], []).append((row["bin"], row["n"]))
        narrowed = []
        for begin, end, before, rank in open_parts:
            if begin < end:
                width = -(-(end - begin + 1) // bins)
                for part, size in sorted(by_begin[begin]):
                    if before + size >= rank:
                        begin, end = begin + part * width, min(end, begin + (part + 1) * width - 1)
                        break
                    before += size
            narrowed.append((begin, end, before, rank))
        open_parts = narrowed
    cuts = [Decimal(begin).scaleb(-kind.scale) for begin, _, _, _ in open_parts]
    return df.sparkSession.range(1).select(*[F.lit(c).cast(kind).alias(f"cut_{i}") for i, c in enumerate(cuts)])


def count_matrix(pairs, actual, predicted, labels):
    """Counts of predicted labels (columns) per actual label (rows)."""
    return pairs.groupBy(actual).pivot(predicted, list(labels)).count().na.fill(0)
