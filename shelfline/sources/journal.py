"""The journal of a delivery: which steps of its load are done, and what they found.

A step that is done is one small JSON file, moved into place when the step has ended; rows that a
later step needs are a Parquet table beside it. A run that stopped is repeated from its journal: steps
that are done keep their results, the one that was broken off runs again. So every step may be run
twice, and what must not change by a second run (the files of the delivery, its touched dates, its
archive folder) is written before the step that would change it.

An open journal lies in ``journal/open/<name>``; closing it moves it to ``journal/done/<name>``.
"""

import json
import os

OPEN, DONE, FILES = "journal/open", "journal/done", "files"


class Journal:
    def __init__(self, warehouse, name):
        self.warehouse, self.spark, self.name = warehouse, warehouse.spark, name
        self.folder = warehouse.path(OPEN, name)

    def _hadoop(self, *parts):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.folder, *parts))
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def done(self, step):
        fs, path = self._hadoop(f"{step}.json")
        return fs.exists(path)

    def found(self, step):
        """What a step that is done has found."""
        fs, path = self._hadoop(f"{step}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, step, found=None):
        """Marks a step as done; the file appears whole or not at all."""
        fs, path = self._hadoop(f"{step}.json")
        _, draft = self._hadoop(f"_{step}.json")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(found).encode()))
        stream.close()
        if not fs.rename(draft, path):
            raise OSError(f"{draft} could not be moved to {path}")

    def once(self, step, action):
        """What ``action`` returns (JSON values), run only if the step is not done yet."""
        if not self.done(step):
            self.write(step, action())
        return self.found(step)

    def has_table(self, step):
        fs, path = self._hadoop(step, "_SUCCESS")
        return fs.exists(path)

    def table(self, step, make):
        """The rows of ``make()``, computed and written only if that was not done yet."""
        path = os.path.join(self.folder, step)
        if not self.has_table(step):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def close(self, keep=True):
        """The delivery is done. Its notes and list of files move away, in place of those of an earlier
        delivery of the same name; the tables of its steps go. Without ``keep`` all of it goes.
        """
        fs, path = self._hadoop()
        if not keep:
            fs.delete(path, True)
            return
        for status in fs.listStatus(path) if fs.exists(path) else []:
            if status.isDirectory() and status.getPath().getName() != FILES:
                fs.delete(status.getPath(), True)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.warehouse.path(DONE, self.name))
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if fs.exists(path) and not fs.rename(path, target):
            raise OSError(f"{path} could not be moved to {target}")


def open_deliveries(warehouse):
    """Names of the deliveries whose run began, with its files listed, and did not end."""
    pattern = warehouse.spark._jvm.org.apache.hadoop.fs.Path(warehouse.path(OPEN, "*", FILES, "_SUCCESS"))
    fs = pattern.getFileSystem(warehouse.spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(status.getPath().getParent().getParent().getName() for status in fs.globStatus(pattern) or [])
