"""Incremental copies of a keyed table.

Each micro-batch is reduced to its newest row per key and appended as its own change set, so a trigger costs as
much as what has changed, not as much as the table. Readers merge the change sets, newest row per key first.
``compact`` folds them into a new base from time to time. A change set is named after its batch, so a replayed
batch overwrites itself, and nothing is ever overwritten while it is read.

A deleted row is a change like others: a row of its key, marked in the ``tombstone`` column. It hides the rows before it and
stays until ``compact`` is told that nothing older can come any more, so changes may arrive in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from formtide.operators.changes import latest_per_key
from formtide.sources.versions import is_missing


@dataclass(frozen=True)
class SyncedTable:
    """The copy of a keyed table below ``root``: ``base`` and ``changes`` folders by batch number, finished ``bases``.

    ``order`` decides which row of a key is newest. It should end in a unique column. ``tombstone`` names a boolean column
    of ``schema`` that is true where a row tells that its key was deleted; null counts as false.
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    tombstone: str | None = None

    def start_from(self, snapshot: DataFrame) -> None:
        """Begin with the rows of a snapshot, before any change. Once per root; columns it lacks are null."""
        if self._newest_base() is not None:
            raise ValueError(f"{self.root} has a base already")
        whole = [F.col(f.name) if f.name in snapshot.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        self._publish_base(snapshot.select(*whole), -1)

    def sync(self, source: DataFrame, available_now: bool = True) -> StreamingQuery:
        """Apply what is new in the stream ``source`` since the last trigger. A fresh root starts from nothing."""
        writer = source.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", f"{self.root}/progress")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        changes = latest_per_key(batch.select(*self.schema.fieldNames()), self.keys, self.order)
        changes.write.mode("overwrite").parquet(f"{self.root}/changes/batch={batch_id}")

    def read(self) -> DataFrame:
        """The newest row per key, without keys whose newest row is a tombstone."""
        rows = self._newest()
        return rows if self.tombstone is None else rows.where(~self._deleted()).drop(self.tombstone)

    def _newest(self) -> DataFrame:
        base_id = self._newest_base()
        changes = self._pending(base_id).drop("batch")
        if base_id is not None:
            changes = self.spark.read.schema(self.schema).parquet(f"{self.root}/base/upto={base_id}").unionByName(changes)
        return latest_per_key(changes, self.keys, self.order)

    def _deleted(self) -> Column:
        return F.coalesce(F.col(self.tombstone), F.lit(False))

    def compact(self, settled: Column | None = None) -> int | None:
        """Fold all change sets into a new base and return the number of the last one.

        Run it between triggers. The base counts once it is listed, which happens after it is complete. Older
        folders stay valid until their owner removes them. Tombstones are kept but for those where ``settled`` is true:
        a condition on a row, such as a version up to which all changes are known to have arrived.
        """
        base_id = self._newest_base()
        last = self._pending(base_id).agg(F.max("batch").alias("n")).first()["n"]
        if last is None:
            return base_id
        rows = self._newest()
        if self.tombstone is not None and settled is not None:
            rows = rows.where(~(self._deleted() & F.coalesce(settled, F.lit(False))))
        self._publish_base(rows, last)
        return last

    def _publish_base(self, rows: DataFrame, last: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/base/upto={last}")
        self.spark.createDataFrame([(last,)], "upto bigint").write.mode("append").parquet(f"{self.root}/bases")

    def _newest_base(self) -> int | None:
        return self._folder("bases", StructType().add("upto", LongType())).agg(F.max("upto").alias("n")).first()["n"]

    def _pending(self, base_id: int | None) -> DataFrame:
        changes = self._folder("changes", StructType([*self.schema.fields]).add("batch", LongType()))
        return changes if base_id is None else changes.where(F.col("batch") > base_id)

    def _folder(self, name: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return self.spark.createDataFrame([], schema)
