"""Registry of runnable queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyscope.functions.exprs import round_doubles
from tallyscope.functions.lineage import cut_lineage
from tallyscope.plans import views


class Data:
    """Lazy access to the driver tables of one folder and to the input views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._table(name) if name in views.TABLES else self._view(name)
        return self._frames[name]

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Result of a stage that several later steps read: written once, as between the jobs of a pipeline."""
        if name not in self._frames:
            self._frames[name] = cut_lineage(build())
        return self._frames[name]

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        text, inputs = views.spark_text(name)
        return self.spark.sql(text, **{i: self[i] for i in inputs})


QUERIES: dict[str, Callable[[Data], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, places: int = 12):
    """Register a query and, where there is one, its SQL counterpart."""

    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda d: round_doubles(fn(d), places)
        if sql is not None:
            ORACLES[name] = views.with_views(sql)
        return fn

    return register
