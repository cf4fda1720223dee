"""Session settings and the shared scratch folder."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(master=None, app_name="shelfline", **conf):
    """A session with adaptive execution on; cluster managers supply the master.

    Joins carry no broadcast hints: Spark broadcasts a side only below
    ``spark.sql.autoBroadcastJoinThreshold`` (checked against file statistics when planning
    and against real shuffle sizes by AQE) and otherwise shuffles, splitting skewed
    partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark, label):
    """A new folder name under the shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, a local master gets a
    temporary folder, removed at exit; any other master raises, because executors could not
    read each other's local files.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="shelfline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set(CHECKPOINT_DIR, base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex[:12]}")
