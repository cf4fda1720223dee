import os

import pytest

import builders
from shelfline.plans import daily, marts
from shelfline.session import scratch_dir
from shelfline.sources import files
from shelfline.sources.warehouse import Warehouse
from shelfline.streaming import feed


def drop(spark, folder, name, *rows):
    files.write_csv(builders.raw(spark, *rows), os.path.join(folder, name))


def facts_of(warehouse):
    return sorted(map(tuple, marts.inventory_daily_snapshot(warehouse.star()).collect()))


def test_feed_equals_batch_loads(spark):
    base = scratch_dir(spark, "feed")
    incoming, checkpoint = os.path.join(base, "incoming"), os.path.join(base, "checkpoint")
    streamed = Warehouse(spark, os.path.join(base, "streamed"))
    batched = Warehouse(spark, os.path.join(base, "batched"))
    deliveries = {
        "20240308.csv": [builders.raw_row(day="8/3/24"), builders.raw_row(day="8/3/24", product="P2")],
        "20240309.csv": [builders.raw_row(), builders.raw_row(day="8/3/24", **{"Units Sold": "99"})],
    }
    for name, rows in deliveries.items():
        drop(spark, incoming, name, *rows)
        feed.load_feed(feed.read_feed(spark, incoming), streamed, checkpoint)
        daily.load_batch(batched, builders.raw(spark, *rows))
    assert facts_of(streamed) == facts_of(batched)
    assert len(facts_of(streamed)) == 3


def test_each_file_lands_once_and_is_archived(spark):
    base = scratch_dir(spark, "feed")
    incoming, archive = os.path.join(base, "incoming"), os.path.join(base, "archive")
    landed, checkpoint = os.path.join(base, "landed"), os.path.join(base, "checkpoint")
    for day in ("8", "9", "10"):
        drop(spark, incoming, f"2024030{day}.csv", builders.raw_row(day=f"{day}/3/24"))
        feed.land_feed(feed.read_feed(spark, incoming, archive), landed, checkpoint)
    assert feed.landed(spark, landed).count() == 3
    archived = [name for _, _, names in os.walk(archive) for name in names if name.endswith(".csv")]
    assert archived  # archiving runs one micro-batch behind


def test_forecast_files_stay_out_of_the_inventory_feed(spark):
    base = scratch_dir(spark, "feed")
    incoming, landed = os.path.join(base, "incoming"), os.path.join(base, "landed")
    drop(spark, incoming, "20240309.csv", builders.raw_row())
    files.write_csv(
        builders.raw_forecast(spark, builders.raw_forecast_row()),
        os.path.join(incoming, "forecast_batch_20240309.csv"),
    )
    feed.land_feed(feed.read_feed(spark, incoming), landed, os.path.join(base, "checkpoint"))
    assert feed.landed(spark, landed).count() == 1


def test_first_row_per_key(spark):
    base = scratch_dir(spark, "feed")
    incoming, landed = os.path.join(base, "incoming"), os.path.join(base, "landed")
    row = builders.raw_row()
    drop(spark, incoming, "20240309.csv", row, row, builders.raw_row(product="P2"))
    checkpoint = os.path.join(base, "checkpoint")
    feed.land_first(feed.read_feed(spark, incoming), landed, checkpoint)
    drop(spark, incoming, "old.csv", row, builders.raw_row(day="1/1/20"))
    feed.land_first(feed.read_feed(spark, incoming), landed, checkpoint)
    assert feed.landed(spark, landed).count() == 3


def test_late_rows_still_reach_the_fact(spark):
    base = scratch_dir(spark, "feed")
    incoming, checkpoint = os.path.join(base, "incoming"), os.path.join(base, "checkpoint")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    for name, day in (("20240309.csv", "9/3/24"), ("20240310.csv", "1/1/23")):
        drop(spark, incoming, name, builders.raw_row(day=day))
        feed.load_feed(feed.read_feed(spark, incoming), warehouse, checkpoint)
    assert warehouse.fact_dates() == [20230101, 20240309]


def test_a_second_feed_keeps_the_raw_rows_of_the_first(spark):
    base = scratch_dir(spark, "feed")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    for name, day in (("one", "1/1/24"), ("two", "2/1/24")):
        drop(spark, os.path.join(base, name), "20240101.csv", builders.raw_row(day=day))
        feed.load_feed(feed.read_feed(spark, os.path.join(base, name)), warehouse, os.path.join(base, "checkpoint", name))
    assert warehouse.read("raw/inventory_dump").count() == 2


def test_a_broken_line_stops_the_feed(spark):
    base = scratch_dir(spark, "feed")
    incoming = os.path.join(base, "incoming")
    drop(spark, incoming, "20240309.csv", builders.raw_row())
    folder = os.path.join(incoming, "20240309.csv")
    part = next(name for name in os.listdir(folder) if name.startswith("part-"))
    with open(os.path.join(folder, part)) as source:
        text = source.read()
    with open(os.path.join(incoming, "short.csv"), "w") as target:
        target.write(text + "09/03/24,S1\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|Malformed"):
        feed.land_feed(feed.read_feed(spark, incoming), os.path.join(base, "landed"), os.path.join(base, "checkpoint"))


def test_no_line_is_read_to_find_a_file(spark):
    base = scratch_dir(spark, "feed")
    drop(spark, base, "20240309.csv", builders.raw_row())
    source = feed.read_feed(spark, base)
    assert source.listing.columns == ["path", "length", "changed"]
    plan = files.listing(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "path" in plan and "content" not in plan.split("ReadSchema")[1]


def test_first_rows_reads_only_dates_that_may_be_known(spark, monkeypatch):
    """Over a growing history a micro-batch of new keys looks up no landed row, a late copy only its own date."""
    folder, looked = scratch_dir(spark, "first"), []
    store = feed.FirstRows(spark, folder)
    real = feed.FirstRows.earlier
    monkeypatch.setattr(feed.FirstRows, "earlier", lambda self, dates, name: (looked.append(dates), real(self, dates, name))[1])
    for number in range(1, 6):
        store.land(builders.raw(spark, builders.raw_row(day=f"{number}/3/24"), builders.raw_row(day=f"{number}/3/24", product="P2")), f"b{number}")
    assert looked == [] and feed.landed(spark, folder).count() == 10
    store.land(builders.raw(spark, builders.raw_row(day="2/3/24"), builders.raw_row(day="1/1/19")), "late")
    assert looked == [[20240302]] and feed.landed(spark, folder).count() == 11
    assert store.known([20240302]).count() <= 2


def test_first_rows_stay_exact_when_the_filters_are_full(spark):
    folder = scratch_dir(spark, "first")
    store = feed.FirstRows(spark, folder, words=1)
    for name in ("a", "b", "b"):
        rows = [builders.raw_row(product=f"P{i}") for i in range(40 if name == "a" else 60)]
        store.land(builders.raw(spark, *rows, builders.raw_row(day=None)), name)
    found = feed.landed(spark, folder)
    assert found.where("Date is not null").count() == 60
    assert sorted(r.batch for r in found.where("Date is null").collect()) == ["a", "b"]


def test_a_micro_batch_that_stopped_before_its_rows_lands_them(spark, monkeypatch):
    folder = scratch_dir(spark, "first")
    store = feed.FirstRows(spark, folder)
    rows = builders.raw(spark, builders.raw_row(), builders.raw_row(product="P2"))
    store.remember(store.split(feed.first_wins(rows.withColumn("date_key", feed.date_key(feed.parse_short_date(rows["Date"]))), feed.RAW_KEY), "a")[0])
    store.land(rows, "a")
    assert feed.landed(spark, folder).count() == 2
