"""Tables laid out by a hash of their keys: for joins without a shuffle, and for merges that touch few files."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starfold.operators.dims import first_per_key
from starfold.sinks.files import write_parquet
from starfold.sources.files import read_if_present


def save_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), location: str | None = None
) -> DataFrame:
    """Save ``df`` as the table ``name``, distributed by ``keys`` and sorted within each bucket; return the table.

    Unlike a plain clustered layout this one is known to Spark: tables with the same number of buckets on
    the keys that they are joined on join bucket by bucket, without moving either. A bucket is written by one
    task as one file, so rows that come together in a bucket are never spread over many small files.
    Spark takes rows apart by all the ``keys``; the columns keep their types, which must agree
    between tables that are to be joined.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*(sort or keys))
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table in folders by a hash of its keys, merged batch by batch.

    A merge reads and writes the folders that the batch's keys fall in and no others, so a small batch costs a
    small part of the table whatever the table's size. ``folders`` is fixed with the first batch; another number
    is refused later. Null keys are equal. Writes replace whole folders at the end of a job, so a lost
    executor changes nothing; two writers at once are not provided for.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    folders: int = 64

    @property
    def _root(self) -> str:
        return f"{self.path}/folders={self.folders}"

    def _folder(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.folders)).cast("int")

    def _stored(self) -> DataFrame:
        others = read_if_present(self.spark, self.path, "folders INT").select("folders").distinct().limit(2).collect()
        if any(row[0] != self.folders for row in others):
            raise ValueError(f"{self.path} is laid out in {others[0][0]} folders, not in {self.folders}")
        fields = StructType.fromDDL(self.schema).fields
        return read_if_present(self.spark, self._root, StructType([*fields, StructField("folder", IntegerType())]))

    def rows(self) -> DataFrame:
        """The whole table."""
        return self._stored().drop("folder")

    def _touched(self, batch: DataFrame) -> list[int]:
        # as many numbers as there are folders at most
        return sorted(row[0] for row in batch.select(self._folder()).distinct().collect())

    def part(self, batch: DataFrame) -> DataFrame:
        """The rows of the folders that the keys of ``batch`` fall in: the scan is pruned to these."""
        return self._stored().where(F.col("folder").isin(self._touched(batch)))

    def merge(self, batch: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the folders of the batch's keys by ``merged(their rows, batch)``; returns their number.

        ``merged`` is an upsert or the like: it must keep the rows of keys that the batch lacks.
        """
        touched = self._touched(batch)
        if touched:
            base = self._stored().where(F.col("folder").isin(touched)).drop("folder")
            new = merged(base, batch).withColumn("folder", self._folder())
            columns = [f.name for f in StructType.fromDDL(self.schema).fields]
            write_parquet(new.select(*columns, "folder"), self._root, ["folder"], dynamic=True)
        return len(touched)

    def insert_absent(self, batch: DataFrame, order: Sequence[str]) -> int:
        """Add the first row by ``order`` of each key that the table lacks; returns the number of folders read.

        Only keys are read, and only new rows are written, as further files of their folders.
        """
        touched = self._touched(batch)
        if touched:
            stored = self._stored().where(F.col("folder").isin(touched))
            known = stored.select("folder", *[F.col(k).alias(f"__known_{k}") for k in self.keys])
            incoming = first_per_key(batch, self.keys, order).withColumn("__folder", self._folder())
            same = [F.col("__folder") == F.col("folder"), *(F.col(k).eqNullSafe(F.col(f"__known_{k}")) for k in self.keys)]
            new = incoming.join(known, same, "left_anti").withColumnRenamed("__folder", "folder")
            columns = [f.name for f in StructType.fromDDL(self.schema).fields]
            write_parquet(new.select(*columns, "folder"), self._root, ["folder"], mode="append")
        return len(touched)

    def compact(self, most: int = 1) -> int:
        """Write the folders of more than ``most`` files anew, in the same table; returns their number.

        Inserts add files to folders, merges do not. A folder beyond the advisory size keeps several files, so
        ``most`` should be set above the number that its size asks for.
        """
        stored = self._stored()
        files = Counter(int(re.search(r"/folder=(\d+)/", f).group(1)) for f in stored.inputFiles())
        many = sorted(folder for folder, n in files.items() if n > most)
        if many:
            write_parquet(stored.where(F.col("folder").isin(many)), self._root, ["folder"], dynamic=True)
        return len(many)
