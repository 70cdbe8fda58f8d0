"""A keyed table fed by micro-batches: deltas per epoch, folded into a base from time to time.

Folders under the log's path: ``delta/epoch=N`` holds the aggregated rows of micro-batch N, ``base/upto=N``
the aggregate of all epochs to N, ``bases`` one row per finished base.  A read takes the newest finished
base and the deltas after it, so it does not grow with the number of micro-batches.  A base is listed only
when it is written whole, and a replayed epoch writes its own folder anew: after either, the view is the
same.  ``merge`` must be associative, as last-wins and smallest-first are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLD_AFTER = 16


class KeyedLog:
    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], fold_after: int = FOLD_AFTER):
        self.spark, self.path, self.merge, self.fold_after = spark, path.rstrip("/"), merge, fold_after

    def _bases(self) -> int:
        """The last epoch of the newest finished base; -1 if there is none."""
        try:
            found = self.spark.read.schema("upto long").parquet(f"{self.path}/bases").agg(F.max("upto")).first()[0]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            found = None
        return -1 if found is None else found

    def append(self, rows: DataFrame, epoch: int) -> None:
        """The rows of one micro-batch; an epoch that is run again replaces its own rows."""
        self.merge(rows).write.mode("overwrite").parquet(f"{self.path}/delta/epoch={epoch}")
        if epoch - self._bases() >= self.fold_after:
            self.fold(epoch)

    def fold(self, upto: int) -> None:
        """Make the base of all epochs to ``upto``."""
        if upto <= self._bases():
            return
        self._rows(upto).write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        self.spark.createDataFrame([(upto,)], "upto long").coalesce(1).write.mode("append").parquet(f"{self.path}/bases")

    def _rows(self, upto: int | None = None) -> DataFrame:
        done = self._bases()
        delta = self.spark.read.parquet(f"{self.path}/delta").where(F.col("epoch") > done)
        if upto is not None:
            delta = delta.where(F.col("epoch") <= upto)
        rows = delta.drop("epoch")
        if done >= 0:
            rows = self.spark.read.schema(rows.schema).parquet(f"{self.path}/base/upto={done}").unionByName(rows)
        return self.merge(rows)

    def read(self) -> DataFrame:
        return self._rows()
