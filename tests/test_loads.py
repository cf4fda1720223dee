import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import builders
from shelfline.operators import filters, joins, quality
from shelfline.operators.aggregates import first_wins, quantile_cuts, unique_members
from shelfline.operators.keys import assign_keys
from shelfline.plans import daily, health_tables, loads, marts, turnover
from shelfline.session import scratch_dir
from shelfline.sources import files
from shelfline.sources.warehouse import Warehouse


def facts_of(warehouse):
    return sorted(map(tuple, marts.inventory_daily_snapshot(warehouse.star()).collect()))


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch_dir(spark, "warehouse"))


def test_keys_are_unique_above_known_and_repeatable(spark):
    members = spark.range(5000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"))
    keyed = assign_keys(members, "product_id", "product_key", above=F.lit(70), buckets=16)
    again = assign_keys(members.repartition(7), "product_id", "product_key", above=F.lit(70), buckets=16)
    seen = keyed.agg(F.count_distinct("product_key"), F.min("product_key")).first()
    assert seen[0] == 5000 and seen[1] > 70
    assert keyed.exceptAll(again).isEmpty()


def test_first_row_wins_is_one_whole_row(spark):
    rows = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (2, None, "c")], "k int, a int, b string")
    assert sorted(map(tuple, first_wins(rows, ["k"]).collect())) == [(1, 4, "z"), (2, None, "c")]


@pytest.mark.parametrize("rows", [[("P1", "Toys"), ("P1", "Food")], [("P1", None)], [(None, "Toys")]])
def test_members_need_one_attribute(spark, rows):
    members = unique_members(spark.createDataFrame(rows, "id string, attribute string"), "id", "attribute")
    with pytest.raises(Exception, match="no single attribute"):
        members.collect()


def test_history_spells_product_status_in_lower_case(spark):
    raw = builders.raw(spark, builders.raw_row(), builders.raw_row(product="P2"))
    assert {r.product_status for r in loads.history_products(raw).collect()} == {"active"}
    assert {r.store_status for r in loads.history_stores(raw).collect()} == {"Active"}


def test_two_seasons_for_a_date(spark):
    raw = builders.raw(spark, builders.raw_row(), builders.raw_row(product="P2", Seasonality="Summer"))
    with pytest.raises(Exception, match="no single season"):
        loads.history_dates(raw).collect()
    empty = loads.history_dates(raw.limit(0))
    assert [r.season for r in loads.sync_dates(empty, raw).collect()] == ["Spring"]


def test_upsert_changes_the_inactive_status_only(spark):
    known = spark.createDataFrame(
        [(1, "S1", "East", "Inactive"), (2, "S2", "West", "closed"), (3, "S3", "West", "Inactive")],
        "store_key long, store_id string, region string, store_status string",
    )
    batch = builders.raw(
        spark,
        builders.raw_row(store="S1", Region="North"),
        builders.raw_row(store="S2", Region="West"),
        builders.raw_row(store="S9", Region="South"),
        builders.raw_row(store=None, Region="South"),
    )
    rows = {r.store_id: r for r in loads.sync_stores(known, batch).collect()}
    assert (rows["S1"].region, rows["S1"].store_status, rows["S1"].store_key) == ("East", "Active", 1)
    assert (rows["S2"].store_status, rows["S3"].store_status) == ("closed", "Inactive")
    assert rows["S9"].store_status == "Active" and rows["S9"].store_key > 3
    assert len(rows) == 4


def test_latest_batch_skips_older_dates(spark):
    raw = builders.raw(spark, builders.raw_row(day="8/3/24"), builders.raw_row(day="09/03/24"))
    assert [r["Date"] for r in loads.latest_batch(raw).collect()] == ["09/03/24"]


def test_forecast_numbers_may_be_empty(spark):
    raw = builders.raw_forecast(
        spark, builders.raw_forecast_row(**{"Price": "", "Demand Forecast": "", "Holiday/Promotion": "1"})
    )
    row = loads.typed_forecast(raw).first()
    assert (row.selling_price, row.demand_forecast, row.is_promotion_active) == (None, None, True)


def test_newest_forecast_wins(spark):
    raw = builders.raw_forecast(
        spark, builders.raw_forecast_row(made="09/03/24"), builders.raw_forecast_row(made="10/03/24")
    )
    assert [r["Forecasted On"] for r in loads.newest_snapshot(raw).collect()] == ["10/03/24"]


def test_loading_a_batch_twice_changes_nothing(spark, warehouse):
    daily.load_history(warehouse, builders.raw(spark, builders.raw_row(day="8/3/24")))
    batch = builders.raw(
        spark,
        builders.raw_row(),
        builders.raw_row(**{"Units Sold": "77"}),
        builders.raw_row(product="P2"),
        builders.raw_row(day="8/3/24", **{"Units Sold": "66"}),
    )
    daily.load_batch(warehouse, batch)
    once = facts_of(warehouse)
    daily.load_batch(warehouse, batch)
    assert facts_of(warehouse) == once
    sold = {(str(row[0]), row[3]): row[5] for row in once}
    assert sold == {("2024-03-08", "P1"): 20, ("2024-03-09", "P1"): 20, ("2024-03-09", "P2"): 20}
    assert warehouse.fact_dates() == [20240308, 20240309]


def test_dimensions_are_written_only_for_changes(spark, warehouse):
    def versions(name):
        return warehouse._committed(f"dwh/{name}")

    batch = builders.raw(spark, builders.raw_row())
    daily.load_batch(warehouse, batch)
    daily.load_batch(warehouse, batch)
    daily.load_batch(warehouse, builders.raw(spark, builders.raw_row(day="10/3/24")))
    assert (len(versions("dim_store")), len(versions("dim_product")), len(versions("dim_date"))) == (1, 1, 2)
    inactive = warehouse.read("dwh/dim_store").withColumn("store_status", F.lit("Inactive"))
    warehouse.replace("dwh/dim_store", inactive)
    daily.load_batch(warehouse, batch)
    assert warehouse.read("dwh/dim_store").first().store_status == "Active"
    assert len(versions("dim_store")) == 3
    warehouse.expire("dwh/dim_store", keep=1)
    assert len(versions("dim_store")) == 1
    assert warehouse.read("dwh/dim_store").first().store_status == "Active"


def test_batch_reads_only_its_own_dates(spark, warehouse):
    for number in range(1, 5):
        daily.load_batch(warehouse, builders.raw(spark, builders.raw_row(day=f"{number}/3/24")))
    rows = spark.createDataFrame([(20240303,)], "date_key int")
    touched = loads.touched_partitions(warehouse.read("dwh/fct_inventory_daily"), rows)
    assert touched.count() == 1
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date_key" in filters and "Subquery" in plan


def test_turnover_by_deltas_equals_the_full_mart(spark, warehouse):
    def both():
        full = sorted(map(tuple, marts.inventory_turnover_monthly(warehouse.star()).collect()))
        return full, sorted(map(tuple, turnover.turnover_from_sums(warehouse).collect()))

    daily.load_history(warehouse, builders.raw(spark, *[builders.raw_row(day=f"{n}/{m}/24") for n in (1, 2) for m in (1, 2, 3)]))
    batches = [
        [builders.raw_row(), builders.raw_row(product="P2", **{"Units Sold": "70"})],
        [builders.raw_row(day="3/2/24"), builders.raw_row(day="2/2/24"), builders.raw_row(day="1/12/19")],
        [builders.raw_row()],
    ]
    for rows in batches:
        for _ in range(2):
            daily.load_batch(warehouse, builders.raw(spark, *rows))
        full, kept = both()
        assert full == kept
    assert sorted(turnover.versions(warehouse)) == [201912, 202401, 202402, 202403]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(warehouse.path(turnover.TABLE))
    hadoop.getFileSystem(warehouse._hadoop_conf()).delete(hadoop, True)
    daily.load_batch(warehouse, builders.raw(spark, builders.raw_row(day="10/3/24")))
    full, kept = both()
    assert full == kept and len(full) == 5


def test_a_late_row_reads_two_partitions(spark, warehouse):
    """One row five years old opens the partition of its own date, none in between."""
    days = ["9/3/19", "10/3/20", "11/3/21", "12/3/22", "8/3/24", "9/3/24"]
    daily.load_batch(warehouse, builders.raw(spark, *[builders.raw_row(day=day) for day in days]))
    path = scratch_dir(spark, "batch")
    spark.createDataFrame([(20190309,), (20240309,), (20240309,)], "date_key int").write.parquet(path)
    touched = loads.touched_partitions(warehouse.read("dwh/fct_inventory_daily"), spark.read.parquet(path))
    assert sorted(row.date_key for row in touched.collect()) == [20190309, 20240309]
    node, scans = touched._jdf.queryExecution().executedPlan(), []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "store_key" in plan.toString():
            scans.append(plan)
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "BroadcastQueryStageExec": "plan", "ShuffleQueryStageExec": "plan", "ResultQueryStageExec": "plan"}
        if name in inner:
            walk(getattr(plan, inner[name])())
        for i in range(plan.children().length()):
            walk(plan.children().apply(i))

    walk(node)
    assert scans and scans[0].metrics().apply("numPartitions").value() == 2


def test_a_large_date_is_exported_in_ordered_files(spark):
    rows = spark.range(20_000).selectExpr("date'2024-03-09' as full_date", "concat('S', id % 7) as store_id", "concat('P', lpad(id, 5, '0')) as product_id")
    folder = scratch_dir(spark, "export")
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        files.export_marts({"forecast_deviation": rows}, folder, marts.EXPORT_ORDER, marts.EXPORT_PARTS)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    date_folder = os.path.join(folder, "forecast_deviation", "full_date=2024-03-09")
    parts = sorted(name for name in os.listdir(date_folder) if name.startswith("part-"))
    counts, lines = [], []
    for name in parts:
        with open(os.path.join(date_folder, name)) as source:
            body = source.read().splitlines()[1:]
        counts.append(len(body))
        lines += [tuple(line.split(",")) for line in body]
    assert len(parts) == 8 and max(counts) < 5_000 and sum(counts) == 20_000
    assert lines == sorted(lines)


def test_headers_are_the_only_lines_read_twice(spark, monkeypatch):
    """The layout of a folder comes from first lines; compressed files and a byte order mark are read, too."""
    path = scratch_dir(spark, "layouts")
    rows = builders.raw(spark, *[builders.raw_row(product=f"P{i}") for i in range(50)])
    files.write_csv(rows.repartition(3), os.path.join(path, "plain"))
    turned = rows.select(*[f"`{name}`" for name in reversed(rows.columns)])
    turned.coalesce(1).write.option("header", True).option("compression", "gzip").csv(os.path.join(path, "packed"))
    found = files.layouts(spark, path, files.RAW_INVENTORY)
    assert sorted(len(paths) for paths in found.values()) == [1, 3]
    assert files.read_inventory_csv(spark, path).count() == 100
    scans = files.read_inventory_csv(spark, path)._jdf.queryExecution().toString()
    assert "FileScan text" not in scans


def test_stock_health_of_buckets_shuffles_nothing(spark, warehouse):
    rows = [builders.raw_row(product=f"P{i}") for i in range(40)]
    daily.load_batch(warehouse, builders.raw(spark, *rows))
    made = [builders.raw_forecast_row(day=f"{10 + d}/3/24", product=f"P{i}") for i in range(40) for d in range(7)]
    daily.load_snapshot(warehouse, builders.raw_forecast(spark, *made))
    for _ in range(2):
        health_tables.refresh(warehouse, 20240309)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        health = health_tables.inventory_health(warehouse)
        plan = health._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(tuple, health.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert found == sorted(map(tuple, marts.inventory_health(warehouse.star(), warehouse.forecast()).collect()))
    assert len(found) == 40 and health_tables.sku_risks(warehouse).count() == 40


def test_product_filters_reach_the_scan(spark, warehouse):
    """Of 200,000 rows of a date those of two products are read by pages; many keys filter by a join."""
    fact = spark.range(200_000).selectExpr(
        "20240309 as date_key", "cast(id % 100 as long) as store_key", "cast(id div 100 as long) as product_key", "1 as inventory_level", "1 as units_sold",
        "1 as units_ordered", "cast(1 as decimal(10,2)) as demand_forecast", "cast(1 as decimal(10,2)) as selling_price",
        "cast(1 as decimal(10,2)) as discount_applied", "cast(1 as decimal(10,2)) as competitor_price", "'Sunny' as weather_condition", "true as is_promotion_active",
    )
    warehouse.append_fact(fact.repartition(4))
    products = spark.range(2000).selectExpr("id as product_key", "concat('P', id) as product_id", "concat('C', id % 5) as category", "'Active' as product_status")
    warehouse.replace("dwh/dim_product", products)

    def read(**chosen):
        filtered = filters.dashboard_star(warehouse.star(), start="2024-03-01", end="2024-03-31", **chosen).fact
        rows = filtered.count()
        plan = filtered.groupBy().count()
        plan.collect()
        return rows, filtered._jdf.queryExecution().executedPlan().toString()

    rows, plan = read(products=["P7", "P1999", "P5000"])
    assert rows == 200 and "PushedFilters: [Or(EqualTo(product_key,7),EqualTo(product_key,1999))]" in plan
    rows, plan = read(categories=["C1"])
    assert rows == 40_000 and "LeftSemi" in plan
    assert read(products=["P5000"])[0] == 0
    files_read = warehouse.read("dwh/fct_inventory_daily").where("product_key = 7")
    files_read.collect()
    scan = files_read._jdf.queryExecution().executedPlan()
    while scan.children().length():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 100_000


def test_writes_enforce_constraints(spark, warehouse):
    too_long = builders.raw(spark, builders.raw_row(store="S" * 11))
    with pytest.raises(Exception, match="store_id is longer than 10"):
        warehouse.replace("dwh/dim_store", loads.history_stores(too_long))
    missing = spark.createDataFrame(
        [(1, "S1", None, "Active")],
        "store_key long, store_id string, region string, store_status string",
    )
    with pytest.raises(Exception, match="region must not be NULL"):
        warehouse.replace("dwh/dim_store", missing)
    assert warehouse.read("dwh/dim_store").isEmpty()


def test_daily_run(spark, warehouse):
    base = scratch_dir(spark, "incoming")
    export = scratch_dir(spark, "export")
    os.makedirs(os.path.join(base, "empty"))
    assert daily.run_daily(spark, warehouse, os.path.join(base, "empty")) is None
    first = os.path.join(base, "first")
    files.write_csv(
        builders.raw(spark, builders.raw_row(), builders.raw_row(day="8/3/24")),
        os.path.join(first, "20240309.csv"),
    )
    forecast = [builders.raw_forecast_row(day=f"{10 + i}/3/24") for i in range(7)]
    files.write_csv(
        builders.raw_forecast(spark, *forecast), os.path.join(first, "forecast_batch_20240309.csv")
    )
    archive = os.path.join(base, "archive")
    counts = daily.run_daily(spark, warehouse, first, "2024-03-09", export, archive)
    assert counts[0] == {"inventory_dump": 2, "demand_forecast_7d": 7}
    assert counts[1] == [20240308, 20240309] == warehouse.fact_dates()
    health = spark.table("inventory_health").collect()
    assert [(r.product_id, r.effective_inventory, r.dos) for r in health] == [("P1", 55, Decimal("2.60"))]
    exported = spark.read.option("header", True).csv(os.path.join(export, "inventory_health"))
    assert exported.first()["inventory_health_status"] == "Healthy"
    assert daily.run_daily(spark, warehouse, first, "2024-03-10", export, archive) is None
    assert os.listdir(archive) == ["20240309"]

    late = os.path.join(base, "late")
    files.write_csv(builders.raw(spark, builders.raw_row(day="7/3/24")), os.path.join(late, "20240307.csv"))
    counts, touched = daily.run_daily(spark, warehouse, late, latest_only=True)
    assert (counts["left_out"], touched) == (1, [])
    _, touched = daily.run_daily(spark, warehouse, late, export_folder=export)
    assert touched == [20240307] and warehouse.fact_dates() == [20240307, 20240308, 20240309]
    days = spark.read.option("header", True).csv(os.path.join(export, "inventory_daily_snapshot"))
    assert sorted(str(r.full_date) for r in days.collect()) == ["2024-03-07", "2024-03-08", "2024-03-09"]


def test_export_reads_only_touched_dates(spark, warehouse):
    for number in range(1, 5):
        daily.load_batch(warehouse, builders.raw(spark, builders.raw_row(day=f"{number}/3/24")))
    exported = daily.touched_marts(warehouse, [20240303], 20240304)
    monthly = exported["inventory_turnover_monthly"]
    assert "fct_inventory_daily" not in monthly._jdf.queryExecution().executedPlan().toString()
    assert monthly.first().total_units_sold == 80
    for name in ("inventory_daily_snapshot", "forecast_deviation"):
        plan = exported[name]._jdf.queryExecution().executedPlan().toString()
        assert "20240303" in plan.split("PartitionFilters: [")[1].split("]")[0], name
        assert exported[name].count() == 1


def test_columns_are_taken_by_header_name(spark):
    path = scratch_dir(spark, "orders")
    row = builders.raw(spark, builders.raw_row(**{"Inventory Level": "100", "Units Sold": "7"}))
    files.write_csv(row, os.path.join(path, "a"))
    files.write_csv(row.select(*[f"`{name}`" for name in reversed(row.columns)]), os.path.join(path, "b"))
    read = files.read_inventory_csv(spark, path)
    assert [(r["Inventory Level"], r["Units Sold"]) for r in read.collect()] == [("100", "7")] * 2
    files.write_csv(row.drop("Units Sold"), os.path.join(path, "c"))
    with pytest.raises(ValueError, match="its columns are"):
        files.read_inventory_csv(spark, path)


def test_routes_follow_one_rule(spark):
    base = scratch_dir(spark, "routes")
    files.write_csv(builders.raw(spark, builders.raw_row()), os.path.join(base, "store_20240101.csv"))
    made = builders.raw_forecast(spark, builders.raw_forecast_row())
    files.write_csv(made, os.path.join(base, "part-north_forecast_batch_20240101.csv"))
    assert sorted(tuple(r) for r in files.incoming_batches(spark, base).collect()) == [
        ("part-north_forecast_batch_20240101.csv", "forecast", 1),
        ("store_20240101.csv", "inventory", 1),
    ]


def test_history_may_be_loaded_again(spark, warehouse):
    history = builders.raw(spark, builders.raw_row(day="8/3/24"))
    daily.load_history(warehouse, history)
    daily.load_batch(warehouse, builders.raw(spark, builders.raw_row(product="P2"), builders.raw_row(product="P3")))
    keys = sorted(map(tuple, warehouse.read("dwh/dim_product").collect()))
    once = facts_of(warehouse)
    daily.load_history(warehouse, history)
    assert sorted(map(tuple, warehouse.read("dwh/dim_product").collect())) == keys
    assert facts_of(warehouse) == once
    assert warehouse.read("raw/inventory_dump").count() == 1


def test_bad_rows_are_rejected_and_marts_still_read(spark, warehouse):
    batch = builders.raw(
        spark,
        builders.raw_row(),
        builders.raw_row(product="P2", **{"Demand Forecast": "-5.0", "Units Sold": "0"}),
        builders.raw_row(product="P3"),
        builders.raw_row(product="P3"),
    )
    daily.load_batch(warehouse, batch, "b1")
    daily.load_batch(warehouse, batch, "b1")
    rejected = {r.rule: r.row_count for r in warehouse.read("dwh/rejected_facts").collect()}
    assert rejected == {"demand_forecast is negative": 1, "primary key is repeated": 1}
    assert marts.forecast_deviation(warehouse.star()).count() == 2


def test_an_older_snapshot_does_not_replace_a_newer_one(spark, warehouse):
    newer = builders.raw_forecast(spark, builders.raw_forecast_row(made="10/03/24"))
    older = builders.raw_forecast(spark, builders.raw_forecast_row(made="09/03/24"))
    assert daily.load_snapshot(warehouse, newer) == 1
    assert daily.load_snapshot(warehouse, older) == 0
    assert [str(r.forecasted_on) for r in warehouse.forecast().collect()] == ["2024-03-10"]


def test_scratch_needs_a_shared_folder(spark):
    class Cluster:
        master = "yarn"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Cluster(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_scoring_default_row(spark):
    row = files.read_scoring_csv(spark).first()
    assert (row.demand_forecast, row.Holiday_Promotion, row.seasonality) == (500.0, "Yes", "Summer")


def test_empty_cells_are_null(spark):
    path = scratch_dir(spark, "csv")
    files.write_csv(builders.raw(spark, builders.raw_row(**{"Weather Condition": None})), path)
    assert files.read_inventory_csv(spark, path).first()["Weather Condition"] is None


def test_orphans_and_duplicates(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dimension = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in quality.orphans(facts, "k", dimension).collect()] == [2, 2]
    assert [tuple(r) for r in quality.duplicate_keys(facts, ["k"]).collect()] == [(2, 2)]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    rows = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    assert [tuple(r) for r in joins.insert_if_absent(target, rows, ["k"]).collect()] == [(2, "new")]


def test_quantile_cuts_are_exact(spark):
    values = [Decimal(v) / 100 for v in (5, 5, 120, 130, 180, 190, 191, 400, 1000, 7)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v decimal(10,2)")
    for share in (0.1, 0.25, 0.5, 0.75, 1.0):
        at = sorted(values)[-(-int(share * 100) * len(values) // 100) - 1]
        assert quantile_cuts(df, "v", [share]).first()["cut_0"] == at


def test_monthly_turnover_drops_fractions_unless_exact(spark):
    days = [builders.DAY.replace(day=d) for d in (1, 2, 3)]
    facts = [{"day": d, "stock": 10 + i, "sold": 9} for i, d in enumerate(days)]
    star = builders.star(spark, facts)
    row = marts.inventory_turnover_monthly(star).first()
    assert (row.avg_inventory_held, row.turnover_ratio) == (Decimal(11), Decimal("2.00"))
    exact = marts.inventory_turnover_monthly(star, exact=True).first()
    assert exact.turnover_ratio == Decimal("2.45")
    empty = marts.inventory_turnover_monthly(builders.star(spark, [{"stock": 0, "sold": 3}])).first()
    assert empty.turnover_ratio is None
