"""Sources, sinks, warehouse loads, constraint checks and the file feed.

Rows are written to a new folder under the shared checkpoint folder, loaded with the real
readers, writers and streams, and the result is read back.
"""

import os

from pyspark.sql import functions as F

from shelfline.checks import sql
from shelfline.checks.columns import lineitem
from shelfline.checks.model import TRAINING_SQL, label_pairs
from shelfline.checks.registry import query
from shelfline.checks.relational import folded_star
from shelfline.checks.reporting import DEVIATION_SQL, FORECAST_SQL, HEALTH_SQL, MONTHLY, SNAPSHOT_SQL
from shelfline.functions.dates import date_key, run_date
from shelfline.operators import filters, joins, quality
from shelfline.operators.windows import SKU
from shelfline.plans import bias_model, daily, health_tables, loads, marts, turnover
from shelfline.session import scratch_dir
from shelfline.sources import driver_tables as D
from shelfline.sources import files
from shelfline.sources.warehouse import Warehouse
from shelfline.streaming import feed

LAST_DAY = "1995-01-28"
SPLIT_DAY = "1995-01-14"

RAW_INVENTORY_SQL = f"""
SELECT {sql.short_text()} AS full_date, store_id, product_id, category, region,
       CAST(inventory_level AS VARCHAR) AS inventory_level, CAST(units_sold AS VARCHAR) AS units_sold,
       CAST(units_ordered AS VARCHAR) AS units_ordered, {sql.money_text('demand_c')} AS demand_forecast,
       {sql.money_text('price_c')} AS selling_price, CAST(disc AS VARCHAR) || '.00' AS discount_applied,
       weather AS weather_condition, CASE WHEN promo THEN '1' ELSE '0' END AS is_promotion_active,
       {sql.money_text('competitor_c')} AS competitor_price, season"""
RAW_FORECAST_SQL = f"""
SELECT '28/01/95' AS forecasted_on, {sql.short_text()} AS full_date, store_id, product_id, category, region,
       {sql.money_text('price_c')} AS selling_price, CAST(disc AS VARCHAR) || '.00' AS discount_applied,
       weather AS weather_condition, CASE WHEN promo THEN '1' ELSE '0' END AS is_promotion_active,
       {sql.money_text('competitor_c')} AS competitor_price, season, {sql.money_text('demand_c')} AS demand_forecast
FROM forecast"""
FACT_SQL = SNAPSHOT_SQL + " FROM facts"


def day(text):
    return F.lit(text).cast("date")


def written_once(rows, label):
    """The same rows, read from files: a query that loads its input several times computes it once."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class RawFacts:
    """The facts as text columns, computed once, whole or by their dates."""

    def __init__(self, spark, sf_dir):
        self.rows = written_once(D.raw_inventory(D.folded_facts(spark, sf_dir), "full_date"), "raw-facts")

    def where(self, condition):
        return self.rows.where(condition).drop("full_date")

    def all(self):
        return self.rows.drop("full_date")

    def history(self):
        return self.where(F.col("full_date") < day(LAST_DAY))

    def last_day(self):
        return self.where(F.col("full_date") == day(LAST_DAY))


def raw_history(spark, sf_dir):
    return D.raw_inventory(D.folded_facts(spark, sf_dir).where(F.col("full_date") < day(LAST_DAY)))


def raw_forecast(spark, sf_dir):
    return D.raw_forecast(D.folded_forecast(spark, sf_dir))


def readable(raw):
    return raw.withColumnsRenamed(loads.INVENTORY_NAMES)


def reordered(raw):
    """The same rows with their columns in another order."""
    return raw.select(*[f"`{name}`" for name in reversed(raw.columns)])


def write_both_orders(rows, folder):
    """Half of the rows in the usual column order, half in another."""
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
    files.write_csv(rows.where(half), os.path.join(folder, "usual"))
    files.write_csv(reordered(rows.where(~half)), os.path.join(folder, "other"))
    return folder


def write_incoming(spark, sf_dir, folder):
    files.write_csv(D.raw_inventory(D.folded_facts(spark, sf_dir)), os.path.join(folder, "19950128.csv"))
    files.write_csv(raw_forecast(spark, sf_dir), os.path.join(folder, "forecast_batch_19950128.csv"))
    return folder


def write_last_day(spark, sf_dir, raw, folder):
    files.write_csv(raw.last_day(), os.path.join(folder, "19950128.csv"))
    files.write_csv(raw_forecast(spark, sf_dir), os.path.join(folder, "forecast_batch_19950128.csv"))


# Sources and sinks


@query("a1_read_inventory_csv", sql.folded(RAW_INVENTORY_SQL + " FROM facts"))
def read_inventory_csv(spark, sf_dir):
    path = write_both_orders(RawFacts(spark, sf_dir).all(), scratch_dir(spark, "a1"))
    return readable(files.read_inventory_csv(spark, path))


@query("a2_read_forecast_csv", sql.folded(RAW_FORECAST_SQL))
def read_forecast_csv(spark, sf_dir):
    path = write_both_orders(written_once(raw_forecast(spark, sf_dir), "raw-forecast"), scratch_dir(spark, "a2"))
    return files.read_forecast_csv(spark, path).withColumnsRenamed(loads.FORECAST_NAMES)


@query(
    "a3_route_incoming_files",
    sql.folded(
        """SELECT '19950128.csv' AS batch, 'inventory' AS route, COUNT(*) AS rows FROM facts UNION ALL
           SELECT 'forecast_batch_19950128.csv', 'forecast', COUNT(*) FROM forecast"""
    ),
)
def route_incoming_files(spark, sf_dir):
    return files.incoming_batches(spark, write_incoming(spark, sf_dir, scratch_dir(spark, "a3")))


@query(
    "a4_append_raw_inventory",
    sql.folded(
        f"SELECT {sql.short_text()} AS full_date, COUNT(*) AS row_count FROM facts GROUP BY 1"
    ),
)
def append_raw_inventory(spark, sf_dir):
    """Two batches are appended; the second is written twice and still counts once."""
    warehouse = Warehouse(spark, scratch_dir(spark, "a4"))
    raw = RawFacts(spark, sf_dir)
    warehouse.append_raw(raw.history(), "history")
    for _ in range(2):
        warehouse.append_raw(raw.last_day(), "19950128")
    rows = readable(warehouse.read("raw/inventory_dump"))
    return rows.groupBy("full_date").agg(F.count("*").alias("row_count"))


@query("a5_replace_raw_forecast", sql.folded(RAW_FORECAST_SQL))
def replace_raw_forecast(spark, sf_dir):
    """An older snapshot is replaced by the newest one, also when both arrive together."""
    warehouse = Warehouse(spark, scratch_dir(spark, "a5"))
    newest = written_once(raw_forecast(spark, sf_dir), "raw-forecast")
    older = newest.withColumn("Forecasted On", F.lit("27/01/95"))
    warehouse.replace("raw/demand_forecast_7d", older)
    warehouse.replace("raw/demand_forecast_7d", loads.newest_snapshot(older.unionByName(newest)))
    return warehouse.read("raw/demand_forecast_7d").withColumnsRenamed(loads.FORECAST_NAMES)


def write_feed(spark, sf_dir, folder):
    """The facts as two date-named batches of CSV files."""
    raw, early = RawFacts(spark, sf_dir), F.col("full_date") <= day(SPLIT_DAY)
    files.write_csv(raw.where(early), os.path.join(folder, "19950114.csv"))
    files.write_csv(raw.where(~early), os.path.join(folder, "19950128.csv"))


@query(
    "a6_archive_loaded_files",
    sql.folded("SELECT store_id, COUNT(*) AS row_count FROM facts GROUP BY 1"),
)
def archive_loaded_files(spark, sf_dir):
    """Every file loads once although the feed runs twice; loaded files move to the archive."""
    base = scratch_dir(spark, "a6")
    incoming, archive = os.path.join(base, "incoming"), os.path.join(base, "archive")
    landed, checkpoint = os.path.join(base, "landed"), os.path.join(base, "checkpoint")
    write_feed(spark, sf_dir, incoming)
    for _ in range(2):
        feed.land_feed(feed.read_feed(spark, incoming, archive), landed, checkpoint)
    rows = readable(feed.landed(spark, landed).drop("batch"))
    return rows.groupBy("store_id").agg(F.count("*").alias("row_count"))


MART_COUNTS_SQL = sql.outlook(
    """SELECT 'inventory_daily_snapshot' AS mart, COUNT(*) AS rows FROM facts UNION ALL
       SELECT 'forecast_deviation', COUNT(*) FROM facts UNION ALL
       SELECT 'next_7d_demand', COUNT(*) FROM forecast UNION ALL
       SELECT 'inventory_health', COUNT(*) FROM health UNION ALL
       SELECT 'inventory_turnover_monthly', COUNT(*)
       FROM (SELECT DISTINCT month(full_date), store_id, product_id FROM facts)"""
)


def all_marts(spark, sf_dir):
    return marts.reporting_marts(folded_star(spark, sf_dir), D.folded_forecast(spark, sf_dir))


def count_rows(frames):
    """Row count per named frame, as one frame."""
    return quality.all_violations(
        [frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("mart"), "rows")
         for name, frame in frames.items()]
    )


@query("a7_export_marts", MART_COUNTS_SQL)
def export_marts(spark, sf_dir):
    folder = scratch_dir(spark, "a7")
    names = files.export_marts(all_marts(spark, sf_dir), folder, marts.EXPORT_ORDER)
    exported = {name: spark.read.option("header", True).csv(os.path.join(folder, name)) for name in names}
    return count_rows(exported)


@query("a8_list_marts", MART_COUNTS_SQL)
def list_marts(spark, sf_dir):
    defined = marts.define_views(all_marts(spark, sf_dir))
    listed = [table.name for table in spark.catalog.listTables() if table.name in defined]
    return count_rows({name: spark.table(name) for name in listed})


@query(
    "a9_read_mart_by_name",
    sql.outlook(
        """SELECT status AS inventory_health_status, CAST(band AS BIGINT) AS severity_level, COUNT(*) AS skus
           FROM health GROUP BY 1, 2"""
    ),
)
def read_mart_by_name(spark, sf_dir):
    marts.define_views(all_marts(spark, sf_dir))
    return spark.sql(
        """SELECT inventory_health_status, severity_level, COUNT(*) AS skus FROM inventory_health
           GROUP BY inventory_health_status, severity_level"""
    )


@query(
    "a10_rows_of_run_date",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, units_sold FROM flat
            WHERE full_date = DATE '1998-03-05'"""
    ),
)
def rows_of_run_date(spark, sf_dir):
    flat = D.inventory(spark, sf_dir).select("full_date", *SKU, "units_sold")
    return flat.where(F.col("full_date") == run_date("1998-03-05"))


@query(
    "a10_rows_of_yesterday",
    sql.long(
        """SELECT store_id, product_id, units_sold FROM flat WHERE full_date = DATE '1998-03-05'"""
    ),
)
def rows_of_yesterday(spark, sf_dir):
    """All dates are moved so that 5 March 1998 becomes yesterday, the date of a job that names none."""
    flat = D.inventory(spark, sf_dir).select("full_date", *SKU, "units_sold")
    days = F.datediff(F.current_date(), day("1998-03-06"))
    moved = flat.withColumn("full_date", F.date_add("full_date", days))
    return moved.where(F.col("full_date") == run_date()).drop("full_date")


@query("a11_read_training_csv", sql.long(f"SELECT {TRAINING_SQL} FROM flat"))
def read_training_csv(spark, sf_dir):
    rows = bias_model.training_rows(marts.forecast_deviation(D.star(spark, sf_dir)))
    return files.read_training_csv(spark, files.write_csv(rows, scratch_dir(spark, "a11")))


@query("a12_read_scoring_csv", sql.long(f"SELECT {TRAINING_SQL.rsplit(',', 1)[0]} FROM flat"))
def read_scoring_csv(spark, sf_dir):
    rows = bias_model.training_rows(marts.forecast_deviation(D.star(spark, sf_dir)))
    path = files.write_csv(rows.drop(bias_model.LABEL), scratch_dir(spark, "a12"))
    return files.read_scoring_csv(spark, path)


@query(
    "a13_write_scored_csv",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, {sql.flag(10)} AS forecast_accuracy_flag,
                   {sql.flag(5)} AS forecast_predicted_flag FROM flat"""
    ),
)
def write_scored_csv(spark, sf_dir):
    scored = label_pairs(spark, sf_dir)
    path = files.write_csv(scored, scratch_dir(spark, "a13"))
    return spark.read.schema(scored.schema).option("header", True).csv(path)


# Warehouse loads


@query(
    "w1_surrogate_keys",
    """SELECT category, COUNT(*) AS members, COUNT(*) AS keys, TRUE AS above_known FROM (
         SELECT DISTINCT printf('P%04d', p_partkey // 80) AS product_id,
                'C' || CAST((p_partkey // 80) % 5 AS VARCHAR) AS category FROM part) GROUP BY 1""",
)
def surrogate_keys(spark, sf_dir):
    known = F.lit(1000)
    keyed = joins.assign_keys(D.products(spark, sf_dir), "product_id", "product_key", above=known)
    return keyed.groupBy("category").agg(
        F.count("*").alias("members"),
        F.count_distinct("product_key").alias("keys"),
        (F.min("product_key") > known).alias("above_known"),
    )


@query(
    "w2_history_products",
    sql.folded(
        """SELECT DISTINCT product_id, category, 'active' AS product_status FROM facts
           WHERE full_date < DATE '1995-01-28'"""
    ),
)
def history_products(spark, sf_dir):
    return loads.history_products(raw_history(spark, sf_dir)).drop("product_key")


@query(
    "w3_history_stores",
    sql.folded(
        """SELECT DISTINCT store_id, region, 'Active' AS store_status FROM facts
           WHERE full_date < DATE '1995-01-28'"""
    ),
)
def history_stores(spark, sf_dir):
    return loads.history_stores(raw_history(spark, sf_dir)).drop("store_key")


DIM_DATE_SQL = f"""
SELECT DISTINCT CAST(strftime(flat.full_date, '%Y%m%d') AS BIGINT) AS date_key, {sql.text('flat.full_date').replace('AS flat.', 'AS ')},
       CAST(month(flat.full_date) AS BIGINT) AS month, CAST(year(flat.full_date) AS BIGINT) AS year, season,
       FALSE AS is_holiday, dayname(flat.full_date) AS weekday_name FROM flat"""


@query("w4_history_dates", sql.long(DIM_DATE_SQL))
def history_dates(spark, sf_dir):
    return loads.history_dates(D.raw_inventory(D.inventory(spark, sf_dir)))


def named_facts(star):
    return marts.inventory_daily_snapshot(star)


@query(
    "w5_history_facts", sql.folded(FACT_SQL + " WHERE full_date < DATE '1995-01-28'")
)
def history_facts(spark, sf_dir):
    """Each raw row arrives twice, and the history is loaded again: rows load once."""
    copies = F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    twice = RawFacts(spark, sf_dir).history().select("*", copies).drop("copy")
    warehouse = Warehouse(spark, scratch_dir(spark, "w5"))
    daily.load_history(warehouse, twice)
    daily.load_history(warehouse, twice)
    return named_facts(warehouse.star())


@query(
    "w6_latest_batch",
    sql.long(RAW_INVENTORY_SQL + " FROM flat WHERE flat.full_date = (SELECT MAX(full_date) FROM flat)"),
)
def latest_batch(spark, sf_dir):
    return readable(loads.latest_batch(D.raw_inventory(D.inventory(spark, sf_dir))))


# Members known from the first days; those not seen on the last two of them are inactive.
KNOWN_UNTIL, ACTIVE_SINCE = "1995-01-05", "1995-01-04"
SYNC_SQL = """
SELECT id AS {member}_id, attribute AS {attribute},
       CASE WHEN NOT in_batch AND last_seen < DATE '1995-01-04' THEN 'Inactive' ELSE 'Active' END AS {member}_status
FROM (SELECT {member}_id AS id, {attribute} AS attribute,
             MAX(full_date) FILTER (full_date <= DATE '1995-01-05') AS last_seen,
             MAX(full_date) = (SELECT MAX(full_date) FROM flat) AS in_batch FROM flat GROUP BY 1, 2)
WHERE last_seen IS NOT NULL OR in_batch"""


def known_members(flat, member, attribute):
    status = F.when(F.max("full_date") < day(ACTIVE_SINCE), loads.INACTIVE).otherwise(loads.ACTIVE)
    members = (
        flat.where(F.col("full_date") <= day(KNOWN_UNTIL))
        .groupBy(f"{member}_id", attribute)
        .agg(status.alias(f"{member}_status"))
    )
    return joins.assign_keys(members, f"{member}_id", f"{member}_key")


@query("w7_sync_stores", sql.long(SYNC_SQL.format(member="store", attribute="region")))
def sync_stores(spark, sf_dir):
    flat = D.inventory(spark, sf_dir)
    batch = loads.latest_batch(D.raw_inventory(flat))
    return loads.sync_stores(known_members(flat, "store", "region"), batch).drop("store_key")


@query("w8_sync_products", sql.long(SYNC_SQL.format(member="product", attribute="category")))
def sync_products(spark, sf_dir):
    flat = D.inventory(spark, sf_dir)
    batch = loads.latest_batch(D.raw_inventory(flat))
    return loads.sync_products(known_members(flat, "product", "category"), batch).drop("product_key")


@query("w9_sync_dates", sql.long(DIM_DATE_SQL))
def sync_dates(spark, sf_dir):
    """The dates up to 1998 are known; the batch brings all dates, the known ones again."""
    raw = D.raw_inventory(D.inventory(spark, sf_dir))
    known = loads.history_dates(D.raw_inventory(D.inventory(spark, sf_dir))).where(F.col("year") < 1998)
    return loads.sync_dates(known, raw)


@query("w10_daily_facts", sql.folded(FACT_SQL))
def daily_facts(spark, sf_dir):
    """History, then the last day twice; the repetition changes nothing."""
    warehouse, raw = Warehouse(spark, scratch_dir(spark, "w10")), RawFacts(spark, sf_dir)
    daily.load_history(warehouse, raw.history())
    for _ in range(2):
        daily.load_batch(warehouse, raw.last_day())
    return named_facts(warehouse.star())


@query("w11_forecast_snapshot", sql.folded(FORECAST_SQL))
def forecast_snapshot(spark, sf_dir):
    return loads.typed_forecast(raw_forecast(spark, sf_dir))


@query("w12_daily_run", sql.outlook(HEALTH_SQL))
def daily_run(spark, sf_dir):
    """History, then a daily run whose delivery also brings an earlier date; the stock-health mart.

    The loaded files are archived, so a second run finds none.
    """
    base = scratch_dir(spark, "w12")
    incoming = os.path.join(base, "incoming")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    raw = RawFacts(spark, sf_dir)
    daily.load_history(warehouse, raw.history())
    write_last_day(spark, sf_dir, raw, incoming)
    for _ in range(2):
        daily.run_daily(
            spark, warehouse, incoming, "1995-01-28", os.path.join(base, "export"), os.path.join(base, "archive")
        )
    return spark.table("inventory_health")


@query(
    "w13_all_dates_of_a_delivery",
    sql.folded("SELECT CAST(full_date AS VARCHAR) AS full_date, COUNT(*) AS row_count FROM facts GROUP BY 1"),
)
def all_dates(spark, sf_dir):
    """All dates arrive in one delivery, the last one in a file of its own; then a late copy."""
    base = scratch_dir(spark, "w13")
    incoming = os.path.join(base, "incoming")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    raw = RawFacts(spark, sf_dir)
    files.write_csv(raw.last_day(), os.path.join(incoming, "19950128.csv"))
    files.write_csv(raw.history(), os.path.join(incoming, "store_19950127.csv"))
    daily.run_daily(spark, warehouse, incoming, archive=os.path.join(base, "archive"))
    files.write_csv(raw.history(), os.path.join(incoming, "late.csv"))
    daily.run_daily(spark, warehouse, incoming, archive=os.path.join(base, "archive"))
    return named_facts(warehouse.star()).groupBy("full_date").agg(F.count("*").alias("row_count"))


class StopsOnce(Warehouse):
    """A warehouse whose first append of facts writes one half of them and stops."""

    stopped = False

    def append_fact(self, df):
        if self.stopped:
            return super().append_fact(df)
        self.stopped = True
        super().append_fact(df.where(F.col("product_key") % 2 == 0))
        raise InterruptedError("stopped for the query")


@query(
    "w14_restarted_run",
    sql.outlook(
        f"""SELECT 'fact' AS part, COUNT(*) AS row_count, SUM(units_sold) AS total FROM facts UNION ALL
            SELECT 'exported day', COUNT(*), SUM(units_sold) FROM facts WHERE full_date = DATE '{LAST_DAY}' UNION ALL
            SELECT 'exported months', COUNT(*), SUM(sold)
            FROM (SELECT SUM(units_sold) AS sold FROM facts GROUP BY month(full_date), store_id, product_id
                  HAVING month(full_date) = 1) UNION ALL
            SELECT 'archived', COUNT(*), SUM(units_sold) FROM facts WHERE full_date = DATE '{LAST_DAY}'"""
    ),
)
def restarted_run(spark, sf_dir):
    """A daily run that stops halfway through its append, and its repetition: facts, exports and archive."""
    base = scratch_dir(spark, "w14")
    incoming, export, archive = (os.path.join(base, name) for name in ("incoming", "export", "archive"))
    warehouse = StopsOnce(spark, os.path.join(base, "warehouse"))
    warehouse.stopped = True
    raw = RawFacts(spark, sf_dir)
    daily.load_history(warehouse, raw.history())
    warehouse.stopped = False
    write_last_day(spark, sf_dir, raw, incoming)
    try:
        daily.run_daily(spark, warehouse, incoming, LAST_DAY, export, archive)
    except InterruptedError:
        daily.run_daily(spark, warehouse, incoming, LAST_DAY, export, archive)
    sold = F.col("units_sold").cast("long").alias("sold")

    def exported(mart):
        return spark.read.option("header", True).csv(os.path.join(export, mart))

    archived = files.read_inventory_csv(spark, files.Incoming(spark, archive).inventory_paths)
    parts = {
        "fact": warehouse.star().fact.select(sold),
        "exported day": exported("inventory_daily_snapshot").select(sold),
        "exported months": exported("inventory_turnover_monthly").select(F.col("total_units_sold").cast("long").alias("sold")),
        "archived": archived.select(F.col("Units Sold").cast("long").alias("sold")),
    }
    return quality.all_violations(
        [rows.select(F.lit(part).alias("part"), "sold").groupBy("part").agg(F.count("*").alias("row_count"), F.sum("sold").alias("total")) for part, rows in parts.items()]
    )


def stored(spark, sf_dir, name):
    """A warehouse with the history, and the last day loaded twice as a delivery."""
    warehouse, raw = Warehouse(spark, scratch_dir(spark, name)), RawFacts(spark, sf_dir)
    daily.load_history(warehouse, raw.history())
    for _ in range(2):
        daily.load_batch(warehouse, raw.last_day())
    return warehouse


@query(
    "m2_turnover_by_deltas",
    sql.folded(
        """SELECT year, month, store_id, product_id, category, total_units_sold,
                  CAST(stock // days AS DOUBLE) AS avg_inventory_held,
                  CAST(total_units_sold // NULLIF(stock // days, 0) AS DOUBLE) AS turnover_ratio FROM monthly""",
        MONTHLY.replace("FROM flat", "FROM facts"),
    ),
)
def turnover_by_deltas(spark, sf_dir):
    """Monthly turnover from sums that each delivery adds to; no fact is read."""
    return turnover.turnover_from_sums(stored(spark, sf_dir, "m2"))


@query("m3_health_of_buckets", sql.outlook(HEALTH_SQL))
def health_of_buckets(spark, sf_dir):
    """Stock health from the forecast and the latest facts, both bucketed by SKU."""
    warehouse = stored(spark, sf_dir, "m3")
    daily.load_snapshot(warehouse, raw_forecast(spark, sf_dir))
    health_tables.refresh(warehouse, max(warehouse.fact_dates()))
    return health_tables.inventory_health(warehouse)


@query(
    "c5_dashboard_star",
    sql.folded(
        FACT_SQL
        + """ WHERE full_date BETWEEN DATE '1995-01-10' AND DATE '1995-01-28' AND category IN ('C0', 'C2')
              AND product_id IN (SELECT product_id FROM facts WHERE product_id < 'P0008')"""
    ),
)
def dashboard_star(spark, sf_dir):
    """Date, category and product filters on a stored warehouse, as filters of the fact's scan."""
    warehouse = stored(spark, sf_dir, "c5")
    chosen = [f"P{number:04d}" for number in range(8)]
    filtered = filters.dashboard_star(warehouse.star(), "1995-01-10", LAST_DAY, ["C0", "C2"], chosen)
    return named_facts(filtered)


REJECTED_SQL = sql.folded(
    """SELECT 'primary key is repeated' AS rule, COUNT(*) AS keys, COUNT(*) AS row_count FROM facts
       WHERE full_date = DATE '1995-01-28' UNION ALL
       SELECT 'inventory_level is negative', COUNT(*), COUNT(*) FROM facts WHERE full_date = DATE '1995-01-28' UNION ALL
       SELECT 'store_key is not in dim_store', COUNT(DISTINCT product_id), COUNT(*) FROM facts
       WHERE full_date = DATE '1995-01-28'"""
)


@query("q8_rejected_rows", REJECTED_SQL)
def rejected_rows(spark, sf_dir):
    """The last day with each row twice, once with a negative stock and once without a store."""
    warehouse = Warehouse(spark, scratch_dir(spark, "q8"))
    flat = D.folded_facts(spark, sf_dir).where(F.col("full_date") == day(LAST_DAY))
    day_rows = written_once(D.raw_inventory(flat), "last-day")
    negative = day_rows.withColumn("Inventory Level", F.lit("-1"))
    homeless = day_rows.withColumn("Store ID", F.lit(None).cast("string"))
    bad = day_rows.unionByName(day_rows).unionByName(negative).unionByName(homeless)
    daily.load_batch(warehouse, bad, "19950128")
    rejected = warehouse.read("dwh/rejected_facts")
    return rejected.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("row_count").alias("row_count"))


# Constraint checks


@query(
    "q1_null_counts",
    sql.long(
        """SELECT 'region' AS "check", COUNT(*) FILTER (region = 'ASIA') AS violations FROM flat UNION ALL
           SELECT 'store_id', COUNT(*) FILTER (store_id IS NULL) FROM flat"""
    ),
)
def null_counts(spark, sf_dir):
    flat = D.inventory(spark, sf_dir).withColumn("region", F.nullif("region", F.lit("ASIA")))
    return quality.null_counts(flat, ["region", "store_id"])


@query(
    "q2_duplicate_keys",
    """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS full_date, l_suppkey, COUNT(*) AS copies
       FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    lines = lineitem(spark, sf_dir).select(F.col("l_shipdate").cast("date").alias("full_date"), "l_suppkey")
    return quality.duplicate_keys(lines, ["full_date", "l_suppkey"])


@query(
    "q3_too_long_counts",
    """SELECT 'p_name' AS "check", COUNT(*) FILTER (length(p_name) > 10) AS violations FROM part UNION ALL
       SELECT 'p_type', COUNT(*) FILTER (length(p_type) > 5) FROM part""",
)
def too_long_counts(spark, sf_dir):
    return quality.too_long_counts(D.table(spark, sf_dir, "part"), {"p_name": 10, "p_type": 5})


@query(
    "q4_orphans",
    sql.long(
        """SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, COUNT(*) AS row_count FROM flat
           WHERE full_date >= DATE '1998-01-01' GROUP BY 1"""
    ),
)
def orphans(spark, sf_dir):
    star = D.star(spark, sf_dir)
    missing = quality.orphans(star.fact, "date_key", star.dim_date.where(F.col("year") < 1998))
    return missing.groupBy("date_key").agg(F.count("*").alias("row_count"))


@query(
    "q5_lost_skus",
    sql.outlook(
        """SELECT store_id, product_id, CAST(COALESCE(MAX(n.rn), 0) AS BIGINT) AS forecast_rows,
                  CASE WHEN MAX(n.rn) IS NULL THEN 'no forecast' ELSE 'short horizon' END AS reason
           FROM today t LEFT JOIN numbered n USING (store_id, product_id)
           GROUP BY 1, 2
           HAVING COALESCE(MAX(n.rn), 0) < 7
              AND NOT COALESCE(BOOL_OR(100 * (inventory_level + units_ordered) < n.rt), FALSE)"""
    ),
)
def lost_skus(spark, sf_dir):
    facts = joins.latest_facts(folded_star(spark, sf_dir))
    return quality.lost_skus(facts, D.folded_forecast(spark, sf_dir))


@query(
    "q6_row_counts",
    sql.folded(
        """SELECT 'inventory_dump' AS step, COUNT(*) AS rows FROM facts UNION ALL
           SELECT 'demand_forecast_7d', COUNT(*) FROM forecast"""
    ),
)
def row_counts(spark, sf_dir):
    """Counts seen while writing, without another pass over the rows."""
    warehouse = Warehouse(spark, scratch_dir(spark, "q6"))
    inventory, seen_inventory = quality.observe_rows(D.raw_inventory(D.folded_facts(spark, sf_dir)), "inventory_dump")
    forecast, seen_forecast = quality.observe_rows(raw_forecast(spark, sf_dir), "demand_forecast_7d")
    warehouse.append_raw(inventory, "19950128")
    warehouse.replace("raw/demand_forecast_7d", forecast)
    seen = {"inventory_dump": seen_inventory, "demand_forecast_7d": seen_forecast}
    counts = [(step, observation.get["rows"]) for step, observation in seen.items()]
    return spark.createDataFrame(counts, "step string, rows long")


@query(
    "q7_negative_counts",
    sql.long(
        """SELECT 'net_stock' AS "check", COUNT(*) FILTER (inventory_level < units_ordered) AS violations
           FROM flat UNION ALL
           SELECT 'deviation', COUNT(*) FILTER (demand_c < 100 * units_sold) FROM flat"""
    ),
)
def negative_counts(spark, sf_dir):
    measures = D.inventory(spark, sf_dir).select(
        (F.col("inventory_level") - F.col("units_ordered")).alias("net_stock"),
        (F.col("demand_forecast") - F.col("units_sold")).alias("deviation"),
    )
    return quality.negative_counts(measures, ["net_stock", "deviation"])


# File feed


@query("st1_land_feed", sql.folded(RAW_INVENTORY_SQL + " FROM facts"))
def land_feed(spark, sf_dir):
    """Files that arrive between two runs are loaded by the second run only.

    The second file has its columns in another order and a name that does not start with a date.
    """
    base = scratch_dir(spark, "st1")
    incoming, landed = os.path.join(base, "incoming"), os.path.join(base, "landed")
    raw, early = RawFacts(spark, sf_dir), F.col("full_date") <= day(SPLIT_DAY)
    for name, condition, usual in (("19950114.csv", early, True), ("store_19950128.csv", ~early, False)):
        rows = raw.where(condition)
        files.write_csv(rows if usual else reordered(rows), os.path.join(incoming, name))
        feed.land_feed(
            feed.read_feed(spark, incoming, os.path.join(base, "archive")),
            landed,
            os.path.join(base, "checkpoint"),
        )
    return readable(feed.landed(spark, landed).drop("batch"))


ST2_SQL = sql.folded(
    f"""SELECT 'fact' AS part, full_date, COUNT(*) AS row_count, SUM(units_sold) AS total FROM ({FACT_SQL}) GROUP BY 2
        UNION ALL
        SELECT 'forecast', full_date, COUNT(*), SUM(CAST(round(100 * demand_forecast) AS BIGINT))
        FROM ({FORECAST_SQL}) GROUP BY 2"""
)


@query("st4_feed_snapshot", ST2_SQL)
def feed_snapshot(spark, sf_dir):
    """Inventory and forecast files in one feed, the older forecast arriving last: rows per date."""
    base = scratch_dir(spark, "st4")
    incoming = os.path.join(base, "incoming")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    newest = written_once(raw_forecast(spark, sf_dir), "raw-forecast")
    write_feed(spark, sf_dir, incoming)
    files.write_csv(newest, os.path.join(incoming, "part-north_forecast_batch_19950128.csv"))
    feed.load_feed(feed.read_feed(spark, incoming), warehouse, os.path.join(base, "checkpoint"))
    older = newest.withColumns({"Forecasted On": F.lit("27/01/95"), "Demand Forecast": F.lit("1.00")})
    files.write_csv(older, os.path.join(incoming, "forecast_batch_19950127.csv"))
    feed.load_feed(feed.read_feed(spark, incoming), warehouse, os.path.join(base, "checkpoint"))
    facts = named_facts(warehouse.star()).select(F.lit("fact").alias("part"), "full_date", F.col("units_sold").cast("long").alias("n"))
    cents = (F.col("demand_forecast") * 100).cast("long")
    stored = warehouse.forecast().select(F.lit("forecast").alias("part"), "full_date", cents.alias("n"))
    both = facts.unionByName(stored)
    return both.groupBy("part", "full_date").agg(F.count("*").alias("row_count"), F.sum("n").alias("total"))


@query("st2_load_feed", sql.folded(FACT_SQL))
def load_feed(spark, sf_dir):
    """The feed builds dimensions and fact; a feed restarted from scratch changes nothing."""
    base = scratch_dir(spark, "st2")
    incoming = os.path.join(base, "incoming")
    warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
    write_feed(spark, sf_dir, incoming)
    for attempt in ("first", "again"):
        feed.load_feed(
            feed.read_feed(spark, incoming), warehouse, os.path.join(base, "checkpoint", attempt)
        )
    return named_facts(warehouse.star())


@query("st3_first_row_per_key", sql.folded(RAW_INVENTORY_SQL + " FROM facts"))
def first_row_per_key(spark, sf_dir):
    """Every row arrives twice in each of two files and is kept once."""
    base = scratch_dir(spark, "st3")
    incoming, landed = os.path.join(base, "incoming"), os.path.join(base, "landed")
    raw = RawFacts(spark, sf_dir).all()
    for name in ("19950128.csv", "again.csv"):
        files.write_csv(raw.unionByName(raw), os.path.join(incoming, name))
        feed.land_first(feed.read_feed(spark, incoming), landed, os.path.join(base, "checkpoint"))
    return readable(feed.landed(spark, landed).drop("batch"))
