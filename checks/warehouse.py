"""Tables of the warehouse built from the base tables of one folder."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import BASE_TABLES, RECIPES, RUN_DATE, staging
from switchboard.plans.daily import STEPS, VIEWS
from switchboard.session import apply_settings, drop_shuffles, store


class Warehouse:
    """Resolves table names. Staging tables are read from the base tables each time; tables of
    the upper layers are written to the shared folder once, as the daily batch does, and
    read back by what builds on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.base = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in BASE_TABLES}
        self.steps = {s.target: s for s in STEPS}
        self.stored: dict[str, DataFrame] = {}
        self.raw: dict[str, DataFrame] = {}

    def build(self, name: str) -> DataFrame:
        """The query for ``name``; only its inputs are stored."""
        if name in RECIPES:
            if name not in self.raw:
                self.raw[name] = staging(self.spark, self.base, name)
            return self.raw[name]
        if name in VIEWS:
            fn, inputs = VIEWS[name]
            return fn(*[self.get(i) for i in inputs])
        return self.steps[name].run(self.get, RUN_DATE)

    def get(self, name: str) -> DataFrame:
        """Table ``name``, stored if it is not a staging table."""
        if name in RECIPES:
            return self.build(name)
        if name not in self.stored:
            # All tables stay until the session ends: at the same CPU time, zstd takes about a third less disk than snappy.
            self.stored[name] = store(self.build(name), name, "zstd")
        return self.stored[name]

    def fill(self, names: Iterable[str], at_once: int = 4) -> None:
        """Store the tables ``names`` and all they are built from, in load order.

        Up to ``at_once`` tables that do not build on each other are built at the same time: the tasks of one fill the
        cores that the plan and the last tasks of another leave idle. The shuffles of so many are on disk together.
        """
        wanted, todo = set(), list(names)
        while todo:
            name = todo.pop()
            if name in RECIPES:
                self.build(name)  # only a plan, made here so that no two threads make it
            elif name not in wanted and name not in self.stored:
                wanted.add(name)
                todo += self.steps[name].inputs
        waiting = {t: wanted.intersection(s.inputs) for t, s in self.steps.items() if t in wanted}
        running = {}
        get = inheritable_thread_target(self.spark)(self.get)
        with ThreadPoolExecutor(at_once) as pool:
            while waiting or running:
                for name in [t for t, inputs in waiting.items() if not inputs][: at_once - len(running)]:
                    del waiting[name]
                    running[pool.submit(get, name)] = name
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(done)
                    done.result()
                    drop_shuffles(self.spark)
                    for inputs in waiting.values():
                        inputs.discard(name)


_open: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Warehouse(spark, folder)
    return _open[key]
