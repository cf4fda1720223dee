"""The daily file feed as a stream of micro-batches.

The stream finds new files exactly once, by their listing alone; each micro-batch reads its files as the
batch job does: routed by the same rule, columns by header name, a broken line being an error.
"""

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from shelfline.functions.dates import date_key, parse_short_date
from shelfline.operators.aggregates import first_wins
from shelfline.operators.joins import insert_if_absent
from shelfline.operators.key_filter import WORDS, filter_of, marked, united
from shelfline.plans.daily import load_delivery
from shelfline.schemas import RAW_INVENTORY
from shelfline.session import scratch_dir
from shelfline.sources.files import Incoming, folder_exists

# The columns of Spark's binary file source.
LISTED = "path string, modificationTime timestamp, length long, content binary"
RAW_KEY = ["date_key", "Store ID", "Product ID"]
FIRST_ROWS, FIRST_KEYS = "rows", "keys"


class Feed:
    """The files of a folder as a stream of listings (path, length, time); processed files move to ``archive``.

    The content column of the source is never asked for, so no file is opened to find it: the offsets
    kept in the checkpoint are listings. Archiving runs one micro-batch behind: the checkpoint alone
    makes each file load once.
    """

    def __init__(self, spark, folder, archive=None, files_per_batch=None):
        self.spark, self.folder = spark, folder
        reader = spark.readStream.format("binaryFile").schema(LISTED).option("recursiveFileLookup", True)
        if archive is not None:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        listed = reader.load(folder).where("length > 0")
        self.listing = listed.select("path", "length", F.col("modificationTime").cast("string").alias("changed"))

    def each(self, handle, checkpoint):
        """Calls ``handle`` with the :class:`Incoming` of each micro-batch, until none waits."""

        def run(rows, _):
            found = Incoming(self.spark, self.folder, rows.toLocalIterator())
            if found.files:
                handle(found)

        writer = self.listing.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query


def read_feed(spark, folder, archive=None, files_per_batch=None):
    return Feed(spark, folder, archive, files_per_batch)


def land_feed(feed, folder, checkpoint):
    """Write the inventory of the feed to Parquet exactly once, one folder per micro-batch.

    The folder's name depends on the files, so a repeated micro-batch replaces itself alone.
    """

    def land(incoming):
        if incoming.inventory_paths:
            incoming.inventory().write.mode("overwrite").parquet(os.path.join(folder, f"batch={incoming.name}"))

    return feed.each(land, checkpoint)


def landed(spark, folder):
    """The rows that :func:`land_feed` or :func:`land_first` has written so far, with their ``batch``."""
    rows = os.path.join(folder, FIRST_ROWS)
    schema = StructType([*RAW_INVENTORY, StructField("batch", StringType())])
    path = rows if folder_exists(spark, rows) else folder
    return spark.read.schema(schema).parquet(path).select(*[f"`{name}`" for name in schema.fieldNames()])


class FirstRows:
    """Landed rows by event date, the first of each key only, and a bounded key filter per date.

    A micro-batch asks the filters of its own dates first. Rows that none of them knows are new for sure;
    for the others the landed rows of their dates are read, so what is read depends on the micro-batch and
    its dates, not on how much has landed. The filters are written before the rows: a filter that knows too
    much costs a look at the rows, no row. Rows of any age are handled alike, and nothing expires.
    """

    def __init__(self, spark, folder, words=WORDS):
        self.spark, self.words = spark, words
        self.rows, self.keys = os.path.join(folder, FIRST_ROWS), os.path.join(folder, FIRST_KEYS)

    def _of_dates(self, root, dates, schema):
        """The rows below the folders of some dates; other folders are not even listed."""
        paths = [os.path.join(root, f"date_key={day}") for day in dates]
        paths = [path for path in paths if folder_exists(self.spark, path)]
        if not paths:
            schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
            return self.spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in schema])
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    def known(self, dates):
        """The filters of some dates, all their versions united."""
        schema = "word int, bits long, date_key int, version string"
        return united(self._of_dates(self.keys, dates, schema).select("date_key", "word", "bits"), "date_key")

    def earlier(self, dates, name):
        """Keys of the rows that other micro-batches have landed on some dates."""
        schema = StructType([*RAW_INVENTORY, StructField("date_key", IntegerType()), StructField("batch", StringType())])
        return self._of_dates(self.rows, dates, schema).where(F.col("batch") != name).select(*RAW_KEY)

    def split(self, rows, name):
        """(rows that are new by the filters, rows to look up, their dates)."""
        dates = [row["date_key"] for row in rows.where("date_key is not null").select("date_key").distinct().collect()]
        if not any(folder_exists(self.spark, os.path.join(self.keys, f"date_key={day}")) for day in dates):
            return rows, rows.limit(0), []
        judged = marked(rows, self.known(dates), "date_key", RAW_KEY, self.words)
        path = scratch_dir(self.spark, f"judged-{name}")
        judged.write.parquet(path)
        judged = self.spark.read.parquet(path)
        maybe = judged.where("maybe_known").drop("maybe_known")
        return judged.where("not maybe_known").drop("maybe_known"), maybe, [row["date_key"] for row in maybe.select("date_key").distinct().collect()]

    def remember(self, rows):
        """Adds the keys of new rows to the filters of their dates: one new version each, older ones go."""
        dates = [row["date_key"] for row in rows.where("date_key is not null").select("date_key").distinct().collect()]
        both = self.known(dates).unionByName(filter_of(rows.where("date_key is not null"), "date_key", RAW_KEY, self.words))
        version = uuid.uuid4().hex
        united(both, "date_key").withColumn("version", F.lit(version)).write.mode("append").partitionBy("date_key", "version").parquet(self.keys)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for day in dates:
            path = hadoop.Path(os.path.join(self.keys, f"date_key={day}"))
            fs = path.getFileSystem(conf)
            for status in fs.listStatus(path):
                if not status.getPath().getName().endswith(version):
                    fs.delete(status.getPath(), True)

    def land(self, rows, name):
        """Lands the rows of one micro-batch whose keys no other one has landed.

        The files are read once: all later passes read the first row of each key, or a part of these.
        """
        path = scratch_dir(self.spark, f"first-{name}")
        first_wins(rows.withColumn("date_key", date_key(parse_short_date(F.col("Date")))), RAW_KEY).write.parquet(path)
        new, maybe, dates = self.split(self.spark.read.parquet(path), name)
        if dates:
            new = new.unionByName(insert_if_absent(self.earlier(dates, name), maybe, RAW_KEY).select(*new.columns))
        self.remember(new)
        placed = new.withColumn("batch", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        placed.partitionBy("date_key", "batch").parquet(self.rows)


def land_first(feed, folder, checkpoint, words=WORDS):
    """As :func:`land_feed`, with the first row per date, store and product only.

    Rows of any age count: within a micro-batch the smallest row wins, and rows whose key an earlier
    micro-batch has landed are left out (:class:`FirstRows`). A repeated micro-batch replaces itself.
    """
    store = FirstRows(feed.spark, folder, words)

    def land(incoming):
        if incoming.inventory_paths:
            store.land(incoming.inventory(), incoming.name)

    return feed.each(land, checkpoint)


def load_feed(feed, warehouse, checkpoint):
    """Load each micro-batch into raw, dimensions, fact and forecast snapshot.

    A micro-batch that is repeated after a failure goes on from its journal.
    """
    return feed.each(lambda incoming: load_delivery(warehouse, incoming), checkpoint)
