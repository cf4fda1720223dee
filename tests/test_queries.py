import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfline.checks.registry import ORACLES, QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
labels conversations""".split()
COMPARED = [
    "b13_label_ladder",
    "d7_upsert_members",
    "e8_drill_down",
    "g4_priority_list",
    "k4_inventory_velocity",
    "k11_mover_segments",
    "k13_reliability_drill_down",
    "k13_risk_drill_down",
    "k13_velocity_drill_down",
    "m1_inventory_daily_snapshot",
    "m2_inventory_turnover_monthly",
    "m3_inventory_health",
    "m4_forecast_deviation",
    "n2_class_report",
    "q5_lost_skus",
]
PLANNED = ("c3", "c5", "d", "f1", "g4", "k1_", "k4", "k6", "k8", "k11", "m1", "m2", "m3_", "m4_", "q5", "w7", "w9")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"/root/testdata/sf0.001/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return f"{value:.12g}" if isinstance(value, float) else repr(value)


def test_every_comparison_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert not {name for name in QUERIES if name not in ORACLES}


@pytest.mark.parametrize("name", COMPARED)
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = sorted(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
    assert sorted(tuple(plain(row[c]) for c in columns) for row in df.collect()) == expected


def test_entry(spark, sf_dir):
    rows = entry(spark)
    assert rows.columns[:3] == ["full_date", "store_id", "region"] and not rows.isEmpty()


def test_plans_stay_distributed(spark, sf_dir):
    """No cross join and no Python in the plan."""
    for name, build in QUERIES.items():
        if not name.startswith(PLANNED):
            continue
        plan = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert operator not in plan, (name, operator)


def test_health_shuffles_the_forecast_once_for_its_windows(spark, sf_dir):
    """The windows, the join with the facts and the final grouping share one partitioning."""
    plan = queries()["m3_inventory_health"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above_windows = plan.split("Window")[0]
    assert above_windows.count("Exchange hashpartitioning(store_id") <= 1


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    plan = queries()["e1_distinct_members"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    lineitem = next(schema for schema in schemas if "l_shipdate" in schema)
    assert "l_tax" not in lineitem and "l_extendedprice" not in lineitem


def test_first_row_combines_before_the_shuffle(spark, sf_dir):
    from shelfline.operators.aggregates import first_wins
    from shelfline.sources.driver_tables import inventory

    plan = first_wins(inventory(spark, sf_dir), ["store_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
