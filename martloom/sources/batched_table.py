"""A keyed table kept as appended batches: a load costs what its batch costs.

Every batch's labelled rows lie under its number; readers take each key's newest valid row, and
each key's newest rejects. ``compact`` folds the batches up to a number into a base: valid rows
bucketed and sorted by key, rows without a key beside them, and the newest rejects. A reader then
shuffles the later batches only; the base is scanned bucket by bucket where it lies, and the folded
batches are not read again and may be deleted. A batch or base counts once its last write has
succeeded (``_SUCCESS``); repeating a batch overwrites its own rows. One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import any_null
from martloom.operators.label import STATUS, rejected_rows, valid_rows, write_labelled
from martloom.operators.rejects import latest_rejects
from martloom.sources import paths

BATCH = "_batch_id"
# Buckets of a base: its tasks when it is read or folded, whatever its size; some hundred megabytes
# each serve best, and a fold may choose another number.
BUCKETS = 64
# Parts of a base. The keyed rows are written last and make it complete.
KEYED, UNKEYED, REJECTS = "keyed", "unkeyed", "rejects"


def newest_per_key(
    rows: DataFrame, keys: Sequence[str], batch: str = BATCH, *, null_safe: bool = False
) -> DataFrame:
    """Of rows unique per key and batch, each key's row of the newest batch, without the number.

    The newest number is a hash aggregate of keys and numbers, combined map-side; rows meet it by a
    semi join. NULL keys match nothing, so all their rows stay, outside of the shuffle; with
    ``null_safe`` they equal each other.
    """
    keyed = rows if null_safe else rows.where(~any_null(keys))
    newest = keyed.groupBy(*keys).agg(F.max(batch).alias(batch))
    current = keyed.join(_marked(newest), _same([*keys, batch], null_safe), "left_semi")
    return (current if null_safe else current.unionByName(rows.where(any_null(keys)))).drop(batch)


def _marked(side: DataFrame) -> DataFrame:
    return side.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in side.columns])


def _same(columns: Sequence[str], null_safe: bool):
    pairs = [(F.col(f"`{c}`"), F.col(f"`_of_{c}`")) for c in columns]
    return reduce(
        lambda x, y: x & y, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    )


class BatchedTable:
    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], *, null_safe: bool = False
    ):
        self.spark, self.keys, self.null_safe = spark, list(keys), null_safe
        self._batches, self._base = paths.join(path, "batches"), paths.join(path, "base")

    def add(self, labelled: DataFrame | Sequence[DataFrame], batch_id: int) -> dict[str, int]:
        """Write a batch of labelled rows (or of its slices), once evaluated; returns its quality counts."""
        return write_labelled(labelled, self._folder(self._batches, batch_id), keep_schema=False)

    def batch_ids(self) -> list[int]:
        return self._complete(self._batches)

    def read(self, only: Iterable[int] | None = None) -> DataFrame | None:
        """The current valid rows of all (or the given) batches; None before the first row."""
        chosen = self._chosen(only)
        base = self._base_below(chosen)
        labelled = self._rows([b for b in chosen if base is None or b > base])
        later = None if labelled is None else valid_rows(labelled)
        if base is None:
            return None if later is None else newest_per_key(later, self.keys, null_safe=self.null_safe)
        keyed = self.base_table(base)
        unkeyed = self.spark.read.schema(keyed.schema).parquet(self._part(base, UNKEYED))
        if later is None:
            return keyed.unionByName(unkeyed)
        replaced = _marked(later.select(*self.keys).distinct())
        kept = keyed.join(replaced, _same(self.keys, self.null_safe), "left_anti")
        newest = newest_per_key(later, self.keys, null_safe=self.null_safe)
        return kept.unionByName(unkeyed).unionByName(newest)

    def rejects(self, only: Iterable[int] | None = None) -> DataFrame | None:
        """Rejected rows with their batch; None before the first row.

        Of the batches folded into a base, each key's newest rejects; all of the later ones.
        """
        chosen = self._chosen(only)
        base = self._base_below(chosen)
        labelled = self._rows([b for b in chosen if base is None or b > base])
        later = None if labelled is None else rejected_rows(labelled)
        if base is None:
            return later
        folded = self.spark.read.parquet(self._part(base, REJECTS))
        return folded if later is None else folded.unionByName(later, allowMissingColumns=True)

    def compact(
        self, upto: int | None = None, only: Iterable[int] | None = None, buckets: int = BUCKETS
    ) -> int | None:
        """Fold the batches up to a number into a base; returns the number, None without batches.

        Batches left out of ``only`` (of failed runs) are left out for good, so nothing up to that
        number may be added later.
        """
        chosen = [b for b in self._chosen(only) if upto is None or b <= upto]
        current, rejects = (self.read(chosen), self.rejects(chosen)) if chosen else (None, None)
        if current is None or rejects is None:
            return None
        number = max(chosen)
        if self._base_below(chosen) == number:
            return number
        latest_rejects(rejects, self.keys).write.mode("overwrite").parquet(self._part(number, REJECTS))
        no_key = F.lit(False) if self.null_safe else any_null(self.keys)
        current.where(no_key).write.mode("overwrite").parquet(self._part(number, UNKEYED))
        # Dealt as the buckets are, so that each is written by one task as one file.
        keyed = current.where(~no_key).repartition(buckets, *self.keys)
        path, name = self._part(number, f"{KEYED}-{buckets}"), self._table_name(number)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        keyed.write.mode("overwrite").format("parquet").bucketBy(buckets, *self.keys).sortBy(
            *self.keys
        ).option("path", path).saveAsTable(name)
        return number

    def folded(self, only: Iterable[int] | None = None) -> tuple[str, str, str]:
        """Folders of a base's keyed rows, rows without a key and rejects, folded now if need be."""
        number = self.compact(only=only)
        if number is None:
            raise LookupError("nothing to fold yet")
        (keyed,) = paths.glob(self.spark, self._part(number, f"{KEYED}-*"))
        return keyed, self._part(number, UNKEYED), self._part(number, REJECTS)

    def base_table(self, number: int) -> DataFrame:
        """The keyed rows of a base as a bucketed table; its buckets are told by the folder's name."""
        name = self._table_name(number)
        if not self.spark.catalog.tableExists(name):
            (path,) = paths.glob(self.spark, self._part(number, f"{KEYED}-*"))
            schema = self.spark.read.parquet(path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys})"
                f" SORTED BY ({keys}) INTO {path.rsplit('-', 1)[1]} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def _table_name(self, number: int) -> str:
        return f"base_{hashlib.md5(self._base.encode()).hexdigest()}_{number}"

    def _base_below(self, chosen: Sequence[int]) -> int | None:
        marks = paths.glob(self.spark, paths.join(self._base, f"{BATCH}=*", f"{KEYED}-*", "_SUCCESS"))
        known = [int(m.rsplit("/", 3)[1].split("=")[1]) for m in marks]
        return max([b for b in known if b <= max(chosen, default=-1)], default=None)

    def _part(self, number: int, part: str) -> str:
        return paths.join(self._folder(self._base, number), part)

    def _chosen(self, only: Iterable[int] | None) -> list[int]:
        known = self.batch_ids()
        return known if only is None else sorted(set(known) & set(only))

    def _rows(self, batch_ids: Sequence[int]) -> DataFrame | None:
        """Labelled rows of batches; those without a row have no files to read."""
        folders = [self._folder(self._batches, b) for b in batch_ids]
        filled = [f for f in folders if paths.glob(self.spark, paths.join(f, f"{STATUS}=*"))]
        if not filled:
            return None
        rows = self.spark.read.option("basePath", self._batches).parquet(*filled)
        return rows.withColumn(BATCH, F.col(BATCH).cast("long"))

    def _complete(self, base: str) -> list[int]:
        marks = paths.glob(self.spark, paths.join(base, f"{BATCH}=*", "_SUCCESS"))
        return sorted(int(m.rsplit("/", 2)[1].split("=")[1]) for m in marks)

    @staticmethod
    def _folder(base: str, batch_id: int) -> str:
        return paths.join(base, f"{BATCH}={batch_id}")
