"""Rows of a delivery are computed as often as a load needs them, and no more."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import builders
from shelfline.plans import daily, loads
from shelfline.schemas import FACT
from shelfline.session import scratch_dir
from shelfline.sources.warehouse import Warehouse
from shelfline.streaming import feed


def counted(spark, rows, column):
    """``rows`` and an accumulator of how many values of ``column`` have been computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    return rows.withColumn(column, F.udf(count, "string").asNondeterministic()(F.col(column))), seen


def test_a_forecast_is_read_once(spark):
    rows = builders.raw_forecast(spark, builders.raw_forecast_row(made="09/03/24"), builders.raw_forecast_row(made="10/03/24"))
    rows, seen = counted(spark, rows, "Forecasted On")
    assert daily.load_snapshot(Warehouse(spark, scratch_dir(spark, "once")), rows) == 1
    assert seen.value == 2


def test_a_batch_is_read_once_for_its_stores_and_once_for_its_facts(spark):
    warehouse = Warehouse(spark, scratch_dir(spark, "once"))
    rows, seen = counted(spark, builders.raw(spark, builders.raw_row(), builders.raw_row(), builders.raw_row(product="P2")), "Store ID")
    daily.load_batch(warehouse, rows)
    assert seen.value == 6
    assert [(r.rule, r.row_count) for r in warehouse.read("dwh/rejected_facts").collect()] == [("primary key is repeated", 1)]


def test_first_rows_read_their_files_once(spark):
    folder = scratch_dir(spark, "once")
    for product in ("P1", "P2"):
        rows, seen = counted(spark, builders.raw(spark, builders.raw_row(), builders.raw_row(product=product)), "Date")
        feed.FirstRows(spark, folder).land(rows, product)
        assert seen.value == 2
    assert feed.landed(spark, folder).count() == 2


def test_first_rows_are_sorted_by_product_first(spark):
    schema = StructType([*FACT, *[StructField(name, StringType()) for name in ("store_id", "product_id", "rule")]])

    def row(date, product, sold, rule=None):
        return (date, 1, product, 5, sold, 0, None, None, None, None, "Sunny", True, "S1", f"P{product}", rule)

    rows = [row(20240309, 1, 7), row(20240309, 1, 3), row(20240309, 1, 3), row(20240310, 1, 9), row(None, None, 2, "date_key is not in dim_date")]
    first = loads.first_rows(spark.createDataFrame(rows, schema))
    found = {(r.date_key, r.product_id, r.rule): (r.units_sold, r.copies) for r in first.collect()}
    assert found == {(20240309, "P1", None): (3, 3), (20240310, "P1", None): (9, 1), (None, "PNone", rows[-1][-1]): (2, 1)}
    sorts = [line for line in first._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in line]
    assert sorts and all("Sort [product_key" in line for line in sorts)
