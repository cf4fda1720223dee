"""Parquet tables under one folder of a shared file system.

Tables that are replaced as a whole (dimensions, forecast snapshot) get a new version folder
on each write; readers take the newest version whose write has been committed, so a failed or
repeated job never leaves a half-written table behind. Growing tables (raw inventory, fact)
are written per batch folder or per date partition.
"""

import hashlib
import os

from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators.joins import Star
from shelfline.operators.quality import enforced

SCHEMAS = {
    "raw/inventory_dump": schemas.RAW_INVENTORY,
    "raw/demand_forecast_7d": schemas.RAW_FORECAST,
    "dwh/dim_date": schemas.DIM_DATE,
    "dwh/dim_store": schemas.DIM_STORE,
    "dwh/dim_product": schemas.DIM_PRODUCT,
    "dwh/fct_inventory_daily": schemas.FACT,
    "dwh/demand_forecast_7d": schemas.FORECAST,
    "dwh/rejected_facts": schemas.REJECTED,
}
FACT_TABLE = "dwh/fct_inventory_daily"
RAW_INVENTORY_TABLE = "raw/inventory_dump"
REJECTED_TABLE = "dwh/rejected_facts"
PER_BATCH = (RAW_INVENTORY_TABLE, REJECTED_TABLE)  # tables of one folder per batch


class Warehouse:
    def __init__(self, spark, root):
        self.spark = spark
        self.root = root

    def path(self, table, *parts):
        return os.path.join(self.root, table, *parts)

    def _hadoop_conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _list(self, path, pattern):
        """Names of the sub-folders that hold an entry of the pattern, oldest first; one listing."""
        glob = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "*", pattern))
        statuses = glob.getFileSystem(self._hadoop_conf()).globStatus(glob) or []
        return sorted({status.getPath().getParent().getName() for status in statuses})

    def _committed(self, table):
        return self._list(self.path(table), "_SUCCESS")

    def _load(self, table, paths):
        if not paths:
            columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in SCHEMAS[table]]
            return self.spark.range(0).select(*columns)
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths)

    def read(self, table):
        """Current rows of a table; empty if it was never written."""
        if table == FACT_TABLE:
            return self._load(table, [self.path(table)] if self.fact_dates() else [])
        folders = self._committed(table)
        if table not in PER_BATCH:
            folders = folders[-1:]
        return self._load(table, [self.path(table, name) for name in folders])

    def has_raw(self, batch):
        """Whether a batch of raw rows has been written to its end."""
        return f"batch-{batch}" in self._committed(RAW_INVENTORY_TABLE)

    def raw_batch(self, batch):
        return self._load(RAW_INVENTORY_TABLE, [self.path(RAW_INVENTORY_TABLE, f"batch-{batch}")])

    def fact_dates(self):
        """Date keys of the fact, from its partition folders: none is listed, no file is opened."""
        glob = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(FACT_TABLE, "date_key=*"))
        statuses = glob.getFileSystem(self._hadoop_conf()).globStatus(glob) or []
        return sorted(int(status.getPath().getName().split("=")[1]) for status in statuses)

    def _checked(self, table, df):
        """The table's columns under its NOT NULL and length constraints."""
        layer, name = table.split("/")
        rows = df.select(*SCHEMAS[table].fieldNames())
        if layer == "raw":
            return rows
        return enforced(rows, schemas.REQUIRED.get(name, ()), schemas.MAX_LENGTHS.get(name))

    def replace(self, table, df):
        """Write a new version of a table; the old one stays readable meanwhile."""
        folders = self._committed(table)
        version = int(folders[-1][1:]) + 1 if folders else 1
        path = self.path(table, f"v{version:08d}")
        self._checked(table, df).write.mode("overwrite").parquet(path)

    def replace_bucketed(self, table, df, keys, buckets=None):
        """Write a new version of a snapshot, bucketed and sorted by ``keys``.

        Tables of equal keys and bucket numbers join, group and window on the keys without a shuffle.
        The number of buckets, by default that of shuffle partitions, is part of the version's name.
        """
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        folders = self._committed(table)
        version = int(folders[-1][1:].split("-")[0]) + 1 if folders else 1
        name = self._attached(table, f"v{version:08d}-{buckets}-{'+'.join(keys)}", df.schema)
        df.select(*df.columns).repartition(buckets, *keys).sortWithinPartitions(*keys).write.insertInto(name, overwrite=True)

    def read_bucketed(self, table, schema):
        """Current rows of a snapshot written by :meth:`replace_bucketed`, None if there is none."""
        folders = self._committed(table)
        return self.spark.table(self._attached(table, folders[-1], schema)) if folders else None

    def _attached(self, table, version, schema):
        """The name of a version in this session's catalog, where Spark looks for bucket specifications.

        The catalog holds no rows: a new session attaches the folder again.
        """
        path = self.path(table, version)
        name = f"shelfline_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            _, buckets, keys = version.split("-")
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
            names = ", ".join(f"`{key}`" for key in keys.split("+"))
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return name

    def expire(self, table, keep=2):
        """Delete all but the newest committed versions of a table that is replaced as a whole.

        Call it when no reader can still hold an older version.
        """
        jvm = self.spark._jvm
        for version in self._committed(table)[:-keep]:
            folder = jvm.org.apache.hadoop.fs.Path(self.path(table, version))
            folder.getFileSystem(self._hadoop_conf()).delete(folder, True)

    def append_raw(self, df, batch):
        """Add one batch of raw inventory; writing the same batch again replaces it."""
        path = self.path(RAW_INVENTORY_TABLE, f"batch-{batch}")
        self._checked(RAW_INVENTORY_TABLE, df).write.mode("overwrite").parquet(path)

    def reject(self, df, batch):
        """Add the rows of one batch that break a constraint; the same batch again replaces them."""
        path = self.path(REJECTED_TABLE, f"batch-{batch}")
        self._checked(REJECTED_TABLE, df).write.mode("overwrite").parquet(path)

    def append_fact(self, df):
        """Add new facts, partitioned by date.

        The rebalance hint lets AQE size the files: a small batch becomes one file per date,
        a date that holds most of the rows is split over many tasks. Within a file rows are sorted by
        product and its key has a Bloom filter, so a filter on products skips row groups and pages.
        """
        facts = self._checked(FACT_TABLE, df).hint("rebalance", "date_key").sortWithinPartitions("date_key", "product_key")
        writer = facts.write.mode("append").option("parquet.bloom.filter.enabled#product_key", True)
        writer.partitionBy("date_key").parquet(self.path(FACT_TABLE))

    def star(self):
        names = ("fct_inventory_daily", "dim_date", "dim_store", "dim_product")
        return Star(*[self.read(f"dwh/{name}") for name in names])

    def forecast(self):
        return self.read("dwh/demand_forecast_7d")
