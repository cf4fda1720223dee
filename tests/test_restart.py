"""A daily run that stops at any step and is repeated equals one that does not stop."""

import csv
import os

import pytest

import builders
from shelfline.plans import daily, marts
from shelfline.session import scratch_dir
from shelfline.sources import files, journal
from shelfline.sources.warehouse import Warehouse


class Stop(Exception):
    pass


def deliver(spark, folder, name="20240309.csv"):
    rows = [builders.raw_row(), builders.raw_row(day="8/3/24"), builders.raw_row(day="8/3/24", product="P2"), builders.raw_row(store=None)]
    files.write_csv(builders.raw(spark, *rows).coalesce(1), os.path.join(folder, name))
    made = [builders.raw_forecast_row(day=f"{10 + i}/3/24") for i in range(7)]
    files.write_csv(builders.raw_forecast(spark, *made).coalesce(1), os.path.join(folder, f"forecast_batch_{name}"))


class Job:
    """One warehouse with history, one delivery and the folders of a daily run."""

    def __init__(self, spark):
        self.spark, base = spark, scratch_dir(spark, "job")
        self.incoming, self.export, self.archive = (os.path.join(base, name) for name in ("incoming", "export", "archive"))
        self.warehouse = Warehouse(spark, os.path.join(base, "warehouse"))
        daily.load_batch(self.warehouse, builders.raw(spark, builders.raw_row(day="7/3/24")))
        deliver(spark, self.incoming)

    def run(self, day="2024-03-09"):
        return daily.run_daily(self.spark, self.warehouse, self.incoming, day, self.export, self.archive)

    def state(self):
        """Facts, rejects, exported lines, archived files and waiting files."""
        exported = []
        for folder, _, names in os.walk(self.export):
            for name in names:
                if name.endswith(".csv"):
                    with open(os.path.join(folder, name)) as source:
                        exported += [(os.path.relpath(folder, self.export), *line) for line in csv.reader(source)]
        facts = sorted(map(tuple, marts.inventory_daily_snapshot(self.warehouse.star()).collect()))
        rejected = sorted(map(repr, self.warehouse.read("dwh/rejected_facts").collect()))
        days = sorted(os.listdir(self.archive)) if os.path.isdir(self.archive) else []
        return facts, rejected, sorted(exported), days, self.files(self.archive), self.files(self.incoming)

    @staticmethod
    def files(folder):
        return sum(name.endswith(".csv") for _, _, names in os.walk(folder) for name in names)


@pytest.fixture(scope="module")
def straight(spark):
    job = Job(spark)
    return job.run(), job.state()


def stop_at(monkeypatch, owner, name, before=True, count=1):
    """The ``count``-th call of a method raises, before or after it did its work."""
    real, calls = getattr(owner, name), []

    def stopped(*args, **kwargs):
        calls.append(name)
        if before and len(calls) == count:
            raise Stop(name)
        result = real(*args, **kwargs)
        if len(calls) == count:
            raise Stop(name)
        return result

    monkeypatch.setattr(owner, name, stopped)


STEPS = ["raw", "rejected", "facts", "turnover", "export"]


def check(job, monkeypatch, straight):
    with pytest.raises(Stop):
        job.run()
    monkeypatch.undo()
    assert job.run("2024-03-10") == straight[0]
    facts, rejected, exported, archived, moved, waiting = job.state()
    assert (facts, rejected, exported, moved, waiting) == (*straight[1][:3], *straight[1][4:])
    assert job.run("2024-03-11") is None
    assert archived == ["20240309"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_stopped_before_a_step_is_noted(spark, monkeypatch, straight, step):
    """The step's work is done, its note is not: the repeated run does it again."""
    job, real = Job(spark), journal.Journal.write

    def write(self, name, found=None):
        if name == step:
            raise Stop(name)
        real(self, name, found)

    monkeypatch.setattr(journal.Journal, "write", write)
    check(job, monkeypatch, straight)


def test_a_run_stopped_in_its_append(spark, monkeypatch, straight):
    job, real = Job(spark), Warehouse.append_fact

    def half(self, df):
        real(self, df.where("date_key = 20240308 and product_key = 1"))
        raise Stop("append")

    monkeypatch.setattr(Warehouse, "append_fact", half)
    check(job, monkeypatch, straight)


def test_a_run_stopped_while_it_closes_its_journal(spark, monkeypatch, straight):
    """The tables of the journal are gone, its notes are not: nothing is done twice, and only notes stay."""
    job = Job(spark)

    def half(self, keep=True):
        fs, path = self._hadoop("checked")
        fs.delete(path, True)
        raise Stop("close")

    monkeypatch.setattr(journal.Journal, "close", half)
    check(job, monkeypatch, straight)
    name = os.listdir(job.warehouse.path(journal.DONE))[0]
    kept = job.warehouse.path(journal.DONE, name)
    assert [entry for entry in os.listdir(kept) if os.path.isdir(os.path.join(kept, entry))] == [journal.FILES]


def test_a_run_stopped_after_its_append(spark, monkeypatch, straight):
    job = Job(spark)
    stop_at(monkeypatch, Warehouse, "append_fact", before=False)
    check(job, monkeypatch, straight)


def test_a_run_stopped_while_it_moves_files(spark, monkeypatch, straight):
    """One of the files is in the archive; it is neither lost nor loaded again."""
    job = Job(spark)

    def first_only(action, paths):
        action(paths[0])
        raise Stop("archive")

    monkeypatch.setattr(files, "on_files", lambda action, paths: first_only(action, paths) if action.__name__ == "move" else [action(p) for p in paths])
    check(job, monkeypatch, straight)


def test_files_that_came_meanwhile_are_loaded_after(spark, monkeypatch):
    job = Job(spark)
    stop_at(monkeypatch, Warehouse, "append_fact")
    with pytest.raises(Stop):
        job.run()
    monkeypatch.undo()
    late = builders.raw(spark, builders.raw_row(day="6/3/24"))
    files.write_csv(late.coalesce(1), os.path.join(job.incoming, "20240306.csv"))
    counts, touched = job.run()
    assert counts == {"demand_forecast_7d": 7, "inventory_dump": 5} and touched == [20240306, 20240308, 20240309]
    assert job.state()[5] == 0


def test_without_an_archive_a_delivery_loads_again_and_changes_nothing(spark):
    job = Job(spark)
    job.archive = None
    counts, touched = job.run()
    assert touched == [20240308, 20240309]
    assert job.run() == (counts, [])
