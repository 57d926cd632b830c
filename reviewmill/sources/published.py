"""Published serving tables as the place that reads come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators import aggregates as agg
from reviewmill.schemas import SERVING_TABLES
from reviewmill.sources.tables import overwrite_partition, serving_table

STAMPS = ("generated_at", "load_batch_id", "model_version")


class Published:
    """The serving tables of one batch and model below ``root``.

    A table that has not been published is built by its function and written as the partition of this
    batch and model, once; every read scans that partition's files and nothing else. Functions may use
    other tables of the same catalogue, which are published first and then read.
    """

    def __init__(self, spark: SparkSession, root: str, batch: str, model: str, builders: dict[str, Callable[[Published], DataFrame]] | None = None):
        unknown = set(builders or {}) - set(SERVING_TABLES)
        if unknown:
            raise ValueError(f"unknown serving tables {sorted(unknown)}")
        self.spark, self.root, self.batch, self.model, self.builders = spark, root, batch, model, builders or {}

    @property
    def spec(self) -> dict[str, str]:
        return {"load_batch_id": self.batch, "model_version": self.model}

    def has(self, name: str) -> bool:
        """Whether the partition of this batch and model is there, by listing folders; no file is opened."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/load_batch_id={self.batch}/model_version={self.model}")
        return bool(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path))

    def publish(self, *names: str) -> list[str]:
        """Build and write the named tables anew, all that can be built if none is named."""
        for name in names or self.builders:
            stamped = agg.stamp(self.builders[name](self), self.batch, self.model)
            overwrite_partition(stamped, f"{self.root}/{name}", self.spec)
        return list(names or self.builders)

    def table(self, name: str) -> DataFrame:
        """The published table without its scope columns."""
        if name in self.builders and not self.has(name):
            self.publish(name)
        return serving_table(self.spark, self.root, name, self.batch, self.model).drop(*STAMPS)
