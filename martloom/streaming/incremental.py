"""Incremental cleaning of a file stream: new raw files are labelled and applied, each once.

The file source's checkpoint takes the place of a stored high-water mark: it commits after
the batch function returns, and it tracks files rather than clocks, so late rows with an
older load time are not skipped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from martloom.operators.label import METRICS, label
from martloom.sources import paths
from martloom.sources.appended import control_rows
from martloom.sources.batched_table import BATCH, BatchedTable
from martloom.sources.registry import TableSpec


class IncrementalTable(BatchedTable):
    """A cleaned table fed by appended raw files.

    ``storage`` holds the batches, their quality counts and the checkpoint, which numbers the
    batches, so it must be kept or dropped together with the rest.
    """

    def __init__(
        self,
        spark: SparkSession,
        spec: TableSpec,
        storage: str,
        *,
        keep: str = "latest",
        order: Sequence[Column] | None = None,
        null_safe: bool = False,
    ):
        super().__init__(spark, storage, spec.key, null_safe=null_safe)
        self.spec, self.keep, self.order = spec, keep, order
        self._quality = paths.join(storage, "quality")
        self.checkpoint = paths.join(storage, "checkpoint")

    def load(
        self, raw_dir: str, schema: T.StructType, *, max_file_age: str = "36500d"
    ) -> dict[str, int]:
        """Process all files that arrived since the last call; returns their quality counts.

        The checkpoint remembers the files of ``max_file_age``; files older than that, measured
        from the newest one, are taken for done, which bounds what a start has to list.
        """
        counts: Counter[str] = Counter()

        def apply(batch: DataFrame, batch_id: int) -> None:
            counts.update(self.apply(batch, batch_id))

        raw = self.spark.readStream.schema(schema).option("maxFileAge", max_file_age).parquet(raw_dir)
        query = (
            raw.writeStream.foreachBatch(apply)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return {m: counts[m] for m in METRICS}

    def apply(self, batch: DataFrame, batch_id: int) -> dict[str, int]:
        """Label and add one batch; all is written under its number, so a replay overwrites it."""
        labelled = label(batch, self.spec, keep=self.keep, order=self.order)
        metrics = self.add(labelled, batch_id)
        row = (self.spec.name, *(metrics[m] for m in METRICS))
        control_rows(self.spark, [row], self._quality_ddl()).write.mode("overwrite").json(
            self._folder(self._quality, batch_id)
        )
        return metrics

    def quality(self) -> DataFrame:
        """Quality counts per batch."""
        return self.spark.read.schema(f"{self._quality_ddl()}, {BATCH} long").json(self._quality)

    @staticmethod
    def _quality_ddl() -> str:
        return "table_name string, " + ", ".join(f"{m} long" for m in METRICS)
