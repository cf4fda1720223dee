"""CSV sources and sinks."""

import hashlib
import os
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.operators.ordering import export_order
from shelfline.schemas import RAW_FORECAST, RAW_INVENTORY, SCORING, TRAINING

# Files with this mark in their path hold forecasts, all others inventory,
# and the row that is scored when no file is given.
FORECAST_MARK = "forecast_batch"
DEFAULT_SCORING_ROW = (500.0, 29.99, 10.0, "Yes", "Sunny", "Summer")

FILES_AT_ONCE = 16


def listing(spark, path):
    """Rows (path, length, changed) of the files below ``path``, from the file system alone: none is opened."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return source.load(path).select("path", "length", F.col("modificationTime").cast("string").alias("changed"))


def on_files(action, paths):
    """``action`` for each path, ``FILES_AT_ONCE`` at a time: each is a call to the file system, no data pass."""
    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        return list(pool.map(action, paths))


def first_line(spark, conf, path):
    """The first line of a file, unpacked if its name says that it is compressed."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    plain = stream if codec is None else codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def layouts(spark, path, schema):
    """{column order of the header: [files]} of the files below ``path``.

    Only the first line of each file is read here, so the scan that follows is the one pass over the
    bytes. Raises for a file whose header is not a permutation of the schema's columns.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    paths = [row["path"] for row in listing(spark, path).where("length > 0").select("path").toLocalIterator()]
    found = {}
    for file, line in zip(paths, on_files(lambda file: first_line(spark, conf, file), paths)):
        names = tuple(name.strip().strip('"') for name in line.lstrip("\ufeff").split(","))
        if sorted(names) != sorted(schema.fieldNames()):
            raise ValueError(f"{file}: its columns are {names}, not {schema.fieldNames()}")
        found.setdefault(names, []).append(file)
    return found


def _read(spark, path, schema, *more):
    """Rows of all files below ``path``, columns taken by the name in each file's header.

    Files of one column order are one scan, which checks every header and stops at a broken line.
    """
    frames = []
    for names, paths in sorted(layouts(spark, path, schema).items()):
        ordered = StructType([schema[name] for name in names])
        reader = spark.read.schema(ordered).option("header", True).option("enforceSchema", False)
        rows = reader.option("mode", "FAILFAST").csv(sorted(paths))
        frames.append(rows.select(*[F.col(f"`{name}`") for name in schema.fieldNames()], *more))
    if not frames:
        return spark.createDataFrame([], schema).select("*", *[F.lit(None).cast("string").alias("file") for _ in more])
    return reduce(lambda left, right: left.unionByName(right), frames)


def read_inventory_csv(spark, path):
    return _read(spark, path, RAW_INVENTORY)


def read_forecast_csv(spark, path):
    return _read(spark, path, RAW_FORECAST)


class Incoming:
    """The files below a folder at one moment: their paths, routes and a name for the lot.

    A file holds forecasts if the path below the folder contains the mark, else inventory; the
    batch job and the stream both route by this rule. ``name`` depends on paths, sizes and
    times of change, so another delivery never gets the name of an earlier one.
    """

    def __init__(self, spark, folder, files=None):
        self.spark, self.folder = spark, folder
        if files is None:
            files = listing(spark, folder).where("length > 0").toLocalIterator()
        self.files = sorted(tuple(row) for row in files)
        self.name = hashlib.sha256(repr(self.files).encode()).hexdigest()[:16]
        self.forecast_paths = [path for path, _, _ in self.files if FORECAST_MARK in self.below(path)]
        self.inventory_paths = [path for path, _, _ in self.files if FORECAST_MARK not in self.below(path)]

    def below(self, path):
        """The path of a file below the folder."""
        plain, root = _plain(path), _plain(self.folder).rstrip("/") + "/"
        return plain[plain.index(root) + len(root) :] if root in plain else os.path.basename(plain)

    def inventory(self):
        if not self.inventory_paths:
            return self.spark.createDataFrame([], RAW_INVENTORY)
        return read_inventory_csv(self.spark, self.inventory_paths)

    def forecast(self):
        if not self.forecast_paths:
            return self.spark.createDataFrame([], RAW_FORECAST)
        return read_forecast_csv(self.spark, self.forecast_paths)

    def archive(self, target):
        """Moves these files, and no later ones, below ``target``, keeping their paths.

        A file that an earlier attempt has moved is left where it is, so this may be repeated.
        """
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()

        def move(path):
            source = jvm.org.apache.hadoop.fs.Path(path)
            goal = jvm.org.apache.hadoop.fs.Path(os.path.join(target, self.name, self.below(path)))
            fs = source.getFileSystem(conf)
            if not fs.exists(source) and fs.exists(goal):
                return
            fs.mkdirs(goal.getParent())
            if not fs.rename(source, goal):
                raise OSError(f"{path} could not be moved to {goal}")

        on_files(move, [path for path, _, _ in self.files])


def folder_exists(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def _plain(path):
    """A path without its scheme and host."""
    return "/" + path.split(":", 1)[1].lstrip("/") if ":" in path.split("/", 1)[0] else path


def read_incoming(spark, folder):
    """The inventory rows and the forecast rows of all incoming files, routed by file path."""
    seen = Incoming(spark, folder)
    return seen.inventory(), seen.forecast()


def incoming_batches(spark, folder):
    """Incoming batches (files or folders right below the folder) with their route and row count.

    One scan per route and column order; the batch of a row is taken from its file's path.
    """
    seen = Incoming(spark, folder)
    routes = (("inventory", seen.inventory_paths, RAW_INVENTORY), ("forecast", seen.forecast_paths, RAW_FORECAST))
    root = re.escape(_plain(folder).rstrip("/"))
    # A file's URI is percent-encoded but for its plus signs.
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    batch = F.regexp_extract(plain, f"{root}/([^/]+)", 1)
    counted = spark.createDataFrame([], "batch string, route string, rows long")
    for route, paths, schema in routes:
        if paths:
            rows = _read(spark, paths, schema, batch.alias("batch"))
            named = rows.groupBy("batch").agg(F.count("*").alias("rows")).select("batch", F.lit(route).alias("route"), "rows")
            counted = counted.unionByName(named)
    return counted


def write_csv(df, path, mode="errorifexists"):
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_training_csv(spark, path):
    return _read(spark, path, TRAINING)


def read_scoring_csv(spark, path=None):
    """Rows to score from a file, or the single default row."""
    if path is None:
        return spark.createDataFrame([DEFAULT_SCORING_ROW], SCORING)
    return _read(spark, path, SCORING)


def export_marts(marts, folder, order=None, parts=None):
    """Write every mart as CSV files with headers below ``folder``.

    A mart named in ``parts`` is written into one folder per value of the given columns, and
    only the folders of the values it holds are replaced. If ``order`` names columns, too, its rows
    are range-partitioned over folder and order columns by sampled bounds: a folder of many rows
    holds several files, whose numbers follow the order, and no task has to hold a whole folder.
    Without an order, AQE splits a large folder over tasks. Other marts are replaced as a whole.
    """
    for name, mart in marts.items():
        columns, split = (order or {}).get(name), (parts or {}).get(name)
        path = os.path.join(folder, name)
        if split:
            if columns:
                ordering = [F.col(c).asc_nulls_last() for c in dict.fromkeys([*split, *columns])]
                placed = mart.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
            else:
                placed = mart.hint("rebalance", *split)
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
            writer.partitionBy(*split).csv(path)
        else:
            write_csv(export_order(mart, *columns) if columns else mart, path, "overwrite")
    return sorted(marts)
