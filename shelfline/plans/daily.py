"""The whole daily job and the first load, on a warehouse folder."""

import uuid
from collections import Counter

from pyspark.sql import functions as F

from shelfline.functions import dates
from shelfline.operators.joins import Star
from shelfline.operators.quality import observe_rows
from shelfline.plans import health_tables, loads, turnover
from shelfline.plans.marts import (
    EXPORT_ORDER,
    EXPORT_PARTS,
    define_views,
    inventory_daily_snapshot,
    forecast_deviation,
    reporting_marts,
)
from shelfline.session import scratch_dir
from shelfline.sources.files import Incoming, export_marts, folder_exists
from shelfline.sources.journal import FILES, OPEN, Journal, open_deliveries


def load_history(warehouse, raw):
    """First load; repeated, or on a warehouse that holds rows, it adds only what is missing.

    Known members keep their keys. The raw folder is named by the rows it holds, so the same
    history lands once and another one replaces nothing. A load that stopped goes on from its journal.
    """
    seen = raw.agg(F.sum(F.xxhash64(*raw.columns).cast("decimal(38,0)")), F.count("*")).first()
    name = f"history-{abs(seen[0] or 0)}-{seen[1]}"
    journal = Journal(warehouse, name)
    if not warehouse.has_raw(name):
        warehouse.append_raw(raw, name)
    raw = warehouse.raw_batch(name)

    def members():
        star = warehouse.star()
        warehouse.replace("dwh/dim_product", loads.history_products(raw, star.dim_product))
        warehouse.replace("dwh/dim_store", loads.history_stores(raw, star.dim_store))
        warehouse.replace("dwh/dim_date", loads.history_dates(raw, dim_date=star.dim_date))

    journal.once("dimensions", members)
    _append_facts(warehouse, raw, name, journal)
    journal.close(keep=False)


def _append_facts(warehouse, batch, name, journal):
    """New facts to the fact, rows that break a constraint to the reject table; touched dates.

    The batch is evaluated once, into a table of the journal with the first row of each key, and so are
    its rejects and its new facts. Where there was no fact yet all first rows are new. The touched
    dates are written before the first row is appended: after a stop in between, the rows that are
    missing still are appended, and the dates are those of all of them.
    """
    star = warehouse.star()
    first = journal.table(
        "first_rows", lambda: loads.first_rows(loads.checked_facts(batch, star.dim_date, star.dim_store, star.dim_product))
    )
    if not journal.done("rejected"):
        rejected = journal.table("rejected_rows", lambda: loads.rejected_rows(first))
        if not rejected.isEmpty():
            warehouse.reject(rejected, name)
        journal.write("rejected")
    if journal.once("no_fact_before", lambda: not warehouse.fact_dates()):
        fresh = loads.good_rows(first)
    else:
        fresh = journal.table("new_facts", lambda: loads.missing_facts(star.fact, loads.good_rows(first)))
    touched = journal.once("touched", lambda: sorted(row["date_key"] for row in fresh.select("date_key").distinct().collect()))
    # Facts that were there before any sums were kept are summed once, as a whole.
    whole = journal.once("sum_all", lambda: bool(warehouse.fact_dates()) and not turnover.versions(warehouse))
    if not journal.done("facts"):
        begun = journal.done("appending")
        if not begun:
            journal.write("appending")
        if touched:
            warehouse.append_fact(loads.missing_facts(warehouse.star().fact, fresh) if begun else fresh)
        journal.write("facts")
    turnover.add_delivery(warehouse, fresh, touched, journal, whole)
    return touched


def _sync_members(warehouse, batch, journal):
    """Each dimension's columns of the batch are read once: its distinct texts are a table of the journal."""
    star = warehouse.star()

    def distinct(step, *columns):
        return journal.table(step, lambda: batch.select(*columns).distinct())

    stores = distinct("batch_stores", "Store ID", "Region")
    products = distinct("batch_products", "Product ID", "Category")
    dates = distinct("batch_dates", "Date", "Seasonality")
    if not loads.changed_stores(star.dim_store, stores).isEmpty():
        warehouse.replace("dwh/dim_store", loads.sync_stores(star.dim_store, stores))
    if not loads.changed_products(star.dim_product, products).isEmpty():
        warehouse.replace("dwh/dim_product", loads.sync_products(star.dim_product, products))
    if not loads.new_dates(star.dim_date, dates).isEmpty():
        warehouse.replace("dwh/dim_date", loads.sync_dates(star.dim_date, dates))


def load_batch(warehouse, batch, name="batch", journal=None):
    """Dimensions and fact for one batch of raw rows; loading it again changes nothing.

    A dimension is written only if the batch brings new or reactivated members. Returns the keys
    of the dates that got new facts. Without a journal of its delivery the batch gets one for the
    time of this call.
    """
    own = journal is None
    journal = Journal(warehouse, f"{name}-{uuid.uuid4().hex[:12]}") if own else journal
    journal.once("dimensions", lambda: _sync_members(warehouse, batch, journal))
    touched = _append_facts(warehouse, batch, name, journal)
    if own:
        journal.close(keep=False)
    return touched


def load_snapshot(warehouse, forecast):
    """The newest forecast of the delivery replaces the stored one unless that is newer.

    The delivery's files are read once. Returns its number of rows, 0 if the stored one stays.
    """
    path = scratch_dir(warehouse.spark, "forecast")
    forecast.write.parquet(path)
    forecast = warehouse.spark.read.schema(forecast.schema).parquet(path)
    newest = loads.newest_snapshot(forecast)
    made_on = loads.forecast_date(forecast)
    stored = loads.forecast_date(warehouse.read("raw/demand_forecast_7d"))
    if made_on is None or (stored is not None and stored > made_on):
        return 0
    counted, seen = observe_rows(newest, "demand_forecast_7d")
    warehouse.replace("raw/demand_forecast_7d", counted)
    warehouse.replace("dwh/demand_forecast_7d", loads.typed_forecast(warehouse.read("raw/demand_forecast_7d")))
    return seen.get["rows"]


def _append_raw(warehouse, incoming):
    counted, seen = observe_rows(incoming.inventory(), "inventory_dump")
    warehouse.append_raw(counted, incoming.name)
    return seen.get["rows"]


def _load_steps(warehouse, incoming, latest_only, journal):
    counts = {"inventory_dump": 0, "demand_forecast_7d": 0}
    touched = []
    if incoming.inventory_paths:
        counts["inventory_dump"] = journal.once("raw", lambda: _append_raw(warehouse, incoming))
        batch = warehouse.raw_batch(incoming.name)
        if latest_only:
            newest_loaded = journal.once("newest_loaded", lambda: max(warehouse.fact_dates(), default=None))
            kept = loads.not_older_than(loads.latest_batch(batch), newest_loaded)
            counts["left_out"] = journal.once("left_out", lambda: batch.count() - kept.count())
            batch = kept
        touched = load_batch(warehouse, batch, incoming.name, journal)
    if incoming.forecast_paths:
        counts["demand_forecast_7d"] = journal.once("forecast", lambda: load_snapshot(warehouse, incoming.forecast()))
    return counts, touched


def load_delivery(warehouse, incoming, latest_only=False):
    """Loads the files of one delivery; returns the counts per target and the touched dates.

    A load that stopped, repeated for the same files, goes on from its journal.
    """
    journal = Journal(warehouse, incoming.name)
    found = _load_steps(warehouse, incoming, latest_only, journal)
    journal.close()
    return found


def touched_marts(warehouse, touched, latest):
    """The marts a daily run exports: snapshots whole, the others for touched dates and months.

    Monthly turnover comes from the stored sums, so no older fact of the month is read.
    """
    star, forecast = warehouse.star(), warehouse.forecast()
    by_day = Star(star.fact.where(F.col("date_key").isin(touched)), *star[1:])
    marts = reporting_marts(star, forecast, latest)
    marts["inventory_daily_snapshot"] = inventory_daily_snapshot(by_day)
    marts["forecast_deviation"] = forecast_deviation(by_day)
    marts["inventory_health"] = health_tables.inventory_health(warehouse) or marts["inventory_health"]
    marts["inventory_turnover_monthly"] = turnover.turnover_from_sums(warehouse, {day // 100 for day in touched})
    return marts


def _begin(spark, warehouse, seen):
    """The journal of a delivery, with its list of files: from now on a repeated run goes on with these."""
    journal = Journal(warehouse, seen.name)
    journal.table(FILES, lambda: spark.createDataFrame(seen.files, "path string, length long, changed string"))
    return journal


def _resumed(spark, warehouse, incoming, name):
    """A delivery that did not end, with the files that were listed when it began."""
    files = spark.read.parquet(warehouse.path(OPEN, name, FILES))
    return Incoming(spark, incoming, files.select("path", "length", "changed").toLocalIterator())


def _run_delivery(spark, warehouse, seen, day, export_folder, archive, latest_only):
    journal = _begin(spark, warehouse, seen)
    if archive is not None:
        target = f"{archive.rstrip('/')}/{day:%Y%m%d}"
        target = journal.once("archive_folder", lambda: target)
    counts, touched = _load_steps(warehouse, seen, latest_only, journal)
    latest = max(warehouse.fact_dates(), default=None)
    journal.once("health_tables", lambda: health_tables.refresh(warehouse, latest))
    marts = reporting_marts(warehouse.star(), warehouse.forecast(), latest)
    marts["inventory_health"] = health_tables.inventory_health(warehouse)
    define_views(marts)
    if export_folder is not None:
        written = touched_marts(warehouse, touched, latest)
        journal.once("export", lambda: export_marts(written, export_folder, EXPORT_ORDER, EXPORT_PARTS))
    if archive is not None:
        seen.archive(target)
    journal.close()
    return counts, touched


def run_daily(spark, warehouse, incoming, run_date=None, export_folder=None, archive=None, latest_only=False):
    """Raw load, transforms, mart views, export and archive; nothing happens without incoming files.

    The files seen at the start are loaded, all their dates, and afterwards moved below
    ``archive`` in a folder of the run date (an ISO date, yesterday by default); files that
    arrive meanwhile wait for the next run. ``latest_only`` loads the newest date alone, and only
    if no newer one was loaded before; rows left out are counted. The export writes only the dates
    and months that got facts. Returns (rows per target, touched dates), or None without files.

    Every step of a delivery is kept in a journal (``sources/journal.py``). A run that follows one
    that stopped, wherever that was, first ends the stopped delivery: with the files, touched dates
    and archive folder noted then, so counts, exports and archive are those of a run that did not
    stop. Then it takes the files that have come since, and returns the sums of both.
    """
    day = spark.range(1).select(dates.run_date(run_date)).first()[0]
    waiting = [_resumed(spark, warehouse, incoming, name) for name in open_deliveries(warehouse)]
    if folder_exists(spark, incoming):
        taken = {file for seen in waiting for file in seen.files}
        new = [file for file in Incoming(spark, incoming).files if file not in taken]
        waiting += [Incoming(spark, incoming, new)] if new else []
    if not waiting:
        return None
    found = [_run_delivery(spark, warehouse, seen, day, export_folder, archive, latest_only) for seen in waiting]
    counts = sum((Counter(count) for count, _ in found), Counter())
    names = {name for count, _ in found for name in count}
    return {name: counts[name] for name in sorted(names)}, sorted({day for _, touched in found for day in touched})
