"""Monthly turnover kept up to date by what each delivery adds.

The table ``dwh/turnover_sums`` holds units sold, stock and observed days per month and SKU: sums, so a
delivery's share is added to them and no older fact is read again. A delivery writes a new version of
the months it touches, in one folder ``v=<number>/month=<yyyymm>``; the newest version of a month whose
write has been committed is its current one. Which versions a delivery starts from is noted in its
journal before it writes, so a repeated delivery adds its share to the same sums again.
"""

from pyspark.sql import functions as F

from shelfline.operators.joins import Star
from shelfline.plans.marts import turnover_of

TABLE = "dwh/turnover_sums"
SUMS = ["total_units_sold", "total_inventory_sum", "days_observed"]
KEYS = ["month", "store_key", "product_key"]
SCHEMA = "store_key long, product_key long, total_units_sold long, total_inventory_sum long, days_observed long, month int"


def month_of(date_key):
    return F.floor(F.col(date_key) / 100).cast("int")


def sums_of(facts):
    """The sums per month and SKU of some facts, whose keys are unique."""
    return facts.groupBy(month_of("date_key").alias("month"), "store_key", "product_key").agg(
        F.sum("units_sold").alias(SUMS[0]), F.sum("inventory_level").alias(SUMS[1]), F.count("*").alias(SUMS[2])
    )


def versions(warehouse):
    """{month: number of its newest committed version}, from folder names alone."""
    hadoop, conf = warehouse.spark._jvm.org.apache.hadoop.fs, warehouse._hadoop_conf()

    def names(*pattern):
        glob = hadoop.Path(warehouse.path(TABLE, *pattern))
        return [status.getPath() for status in glob.getFileSystem(conf).globStatus(glob) or []]

    done = {path.getParent().getName() for path in names("v=*", "_SUCCESS")}
    found = {}
    for path in names("v=*", "month=*"):
        if path.getParent().getName() in done:
            month, version = int(path.getName()[6:]), int(path.getParent().getName()[2:])
            found[month] = max(version, found.get(month, 0))
    return found


def read_sums(warehouse, current=None):
    """The current sums; ``current`` ({month: version}) narrows them to some months."""
    current = versions(warehouse) if current is None else current
    paths = [warehouse.path(TABLE, f"v={version}", f"month={month}") for month, version in sorted(current.items())]
    if not paths:
        return warehouse.spark.createDataFrame([], SCHEMA)
    reader = warehouse.spark.read.schema(f"{SCHEMA}, v long").option("basePath", warehouse.path(TABLE))
    return reader.parquet(*paths).select("month", "store_key", "product_key", *SUMS)


def _write(warehouse, sums, version):
    placed = sums.hint("rebalance", "month").write.mode("overwrite").partitionBy("month")
    placed.parquet(warehouse.path(TABLE, f"v={version}"))


def add_delivery(warehouse, fresh, touched, journal, whole=False):
    """Adds the new facts of a delivery, ``fresh``, whose dates are ``touched``, to the sums.

    ``whole`` says that the fact held other rows before there were sums: then all of it is summed once.
    Superseded versions of the touched months go after the new one is committed.
    """
    months = sorted({day // 100 for day in touched})

    def begin():
        current = versions(warehouse)
        return {"version": max(current.values(), default=0) + 1, "from": {str(m): current[m] for m in months if m in current}}

    plan = journal.once("turnover_from", begin)
    start = {int(month): version for month, version in plan["from"].items()}

    def merge():
        if whole:
            _write(warehouse, sums_of(warehouse.star().fact), plan["version"])
            return
        both = read_sums(warehouse, start).unionByName(sums_of(fresh)) if start else sums_of(fresh)
        _write(warehouse, both.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in SUMS]), plan["version"])

    if months or whole:
        journal.once("turnover", merge)
        expire(warehouse, months)


def expire(warehouse, months):
    """Deletes superseded versions of some months, and folders that hold no month any more."""
    hadoop, conf = warehouse.spark._jvm.org.apache.hadoop.fs, warehouse._hadoop_conf()
    current = versions(warehouse)
    for month in months:
        glob = hadoop.Path(warehouse.path(TABLE, "v=*", f"month={month}"))
        fs = glob.getFileSystem(conf)
        for status in fs.globStatus(glob) or []:
            if int(status.getPath().getParent().getName()[2:]) < current.get(month, 0):
                fs.delete(status.getPath(), True)


def turnover_from_sums(warehouse, months=None, exact=False):
    """The monthly turnover mart from the stored sums: no fact is read."""
    current = versions(warehouse)
    if months is not None:
        current = {month: version for month, version in current.items() if month in months}
    sums = read_sums(warehouse, current)
    year, month = F.floor(F.col("month") / 100).cast("int"), (F.col("month") % 100).cast("int")
    sums = sums.withColumns({"year": year, "month": month})
    return turnover_of(sums, Star(None, *warehouse.star()[1:]), exact)
