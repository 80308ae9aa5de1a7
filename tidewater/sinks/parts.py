"""Tables in parts, each rewritten as a whole by the batches that touch it.

Rows lie in parts: buckets of a hash of their key, or months. A batch reads the parts its rows
fall into, folds its rows in, and writes these parts anew as its generation; others stay as
they are. So a batch costs what its parts cost, however many batches came before, and readers
take one folder a part. Superseded folders are removed, except the last few, which readers
that have begun, and a repeated batch, still need.

A repeated batch folds its rows into what was there before its own generation, so it leaves
the same rows, also where rows are added up. Batches of a stream carry the id of their
checkpoint as ``run``; a fresh checkpoint goes on above all that is stored. Only folders that
Spark has completed count. One job at a time may write a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sinks.tables import CODEC, latest_by_key
from tidewater.sources.tables import empty_table

# Generations of a part that stay.
KEEP = 3
_FOLDER = re.compile(r"/generation=(\d+)/run=([^/]*)/batch=(\d+)/(?:[^/=]+)=([^/]+)$")


@dataclass(frozen=True)
class Stored:
    """One part as one batch has left it."""

    generation: int
    run: str
    batch: int
    part: str
    folder: str


@dataclass(frozen=True)
class PartTable:
    """A table of ``ddl`` with one row a key, in buckets of the key or by the text column ``by`` of it, such as a month."""

    path: str
    ddl: str
    keys: tuple[str, ...]
    by: str | None = None
    buckets: int = 16

    @property
    def column(self) -> str:
        return self.by or "bucket"

    @property
    def root(self) -> str:
        return f"{self.path}/by={self.by or self.buckets}"

    def with_part(self, rows: DataFrame) -> DataFrame:
        if self.by:
            return rows
        hashed = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
        return rows.withColumn(self.column, F.pmod(hashed, F.lit(self.buckets)).cast("int"))

    def parts_of(self, rows: DataFrame) -> list[str]:
        """Names of the parts that hold the keys of ``rows``; at most as many as there are parts."""
        return [str(r[0]) for r in self.with_part(rows).select(self.column).distinct().collect()]

    def listing(self, spark: SparkSession) -> list[Stored]:
        """Complete parts of all generations, as many as parts times :data:`KEEP` and those of the last batch."""
        other = [f for f in _glob(spark, f"{self.path}/by=*") if not f.endswith(self.root.rsplit("/", 1)[1])]
        if other:
            raise ValueError(f"{self.path} is stored otherwise: {other}")
        done = {f.rsplit("/", 1)[0] for f in _glob(spark, f"{self.root}/generation=*/run=*/batch=*/_SUCCESS")}
        found = []
        for folder in _glob(spark, f"{self.root}/generation=*/run=*/batch=*/{self.column}=*"):
            if folder.rsplit("/", 1)[0] in done:
                generation, run, batch, part = _FOLDER.search(folder).groups()
                found.append(Stored(int(generation), run, int(batch), part, folder))
        return found

    def generation_of(self, listing: Iterable[Stored], run: str, batch_id: int) -> int:
        """Number of a batch: batches of a run follow each other, and a new run follows all that is stored."""
        own = max((s for s in listing if s.run == run), key=lambda s: s.batch, default=None)
        if own is not None:
            return own.generation + batch_id - own.batch
        return max((s.generation for s in listing), default=-1) + 1

    def read(
        self, spark: SparkSession, parts: Sequence[str] | None = None, before: tuple[str, int] | None = None
    ) -> DataFrame:
        """Current rows, of some parts if named, or as they were before a batch ``(run, number)``."""
        listing = self.listing(spark)
        below = None if before is None else self.generation_of(listing, *before)
        return self._rows(spark, listing, parts, below)

    def _rows(self, spark: SparkSession, listing: list[Stored], parts: Sequence[str] | None, below: int | None) -> DataFrame:
        newest: dict[str, Stored] = {}
        for s in listing:
            if (parts is None or s.part in parts) and (below is None or s.generation < below):
                if s.part not in newest or newest[s.part].generation < s.generation:
                    newest[s.part] = s
        names = StructType.fromDDL(self.ddl).names
        if not newest:
            return empty_table(spark, self.ddl)
        schema = self.ddl if self.by else f"{self.ddl}, {self.column} int"
        folders = sorted(s.folder for s in newest.values())
        return spark.read.schema(schema).option("basePath", self.root).parquet(*folders).select(*names)

    def rewrite(
        self,
        rows: DataFrame,
        run: str,
        batch_id: int,
        fold: Callable[[DataFrame, DataFrame], DataFrame],
        parts: Sequence[str] | None = None,
    ) -> None:
        """Write the parts of a batch anew: ``fold`` makes their rows of those stored and those of the batch.

        ``parts`` names the parts of the batch's keys where that is known, so that the batch runs once.
        """
        spark = rows.sparkSession
        rows = rows.select(*StructType.fromDDL(self.ddl).names)
        listing = self.listing(spark)
        generation = self.generation_of(listing, run, batch_id)
        parts = self.parts_of(rows) if parts is None else parts
        if not parts:
            return
        folded = fold(self._rows(spark, listing, parts, generation), rows)
        # One task and file a part, so that a part is there as a whole or not at all.
        folder = f"{self.root}/generation={generation}/run={run}/batch={batch_id}"
        whole = folded if self.column in folded.columns and not self.by else self.with_part(folded).repartition(self.column)
        whole = whole.sortWithinPartitions(self.column, *self.keys)
        whole.write.mode("overwrite").option("compression", CODEC).partitionBy(self.column).parquet(folder)
        self._remove_superseded(spark, self.listing(spark), generation)

    def _remove_superseded(self, spark: SparkSession, listing: list[Stored], generation: int) -> None:
        by_part: dict[str, list[Stored]] = {}
        for s in listing:
            by_part.setdefault(s.part, []).append(s)
        live = set()
        for stored in by_part.values():
            live |= set(sorted(stored, key=lambda s: -s.generation)[:KEEP])
        used = {s.folder.rsplit("/", 3)[0] for s in live}
        for s in set(listing) - live:
            whole = s.folder.rsplit("/", 3)[0]
            _delete(spark, s.folder if whole in used else whole)

    def upsert(
        self, rows: DataFrame, run: str, batch_id: int, order_by: Sequence[str], parts: Sequence[str] | None = None
    ) -> None:
        """Keep the latest row a key by ``order_by``; of equal ones the batch's."""

        def latest(stored: DataFrame, new: DataFrame) -> DataFrame:
            """The batch's versions of a key become one by the key; that and the stored one meet in their part."""
            new = latest_by_key(new, self.keys, order_by)
            both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
            dealt = self.with_part(both).repartition(self.column)
            return latest_by_key(dealt, (self.column, *(k for k in self.keys if k != self.column)), [*order_by, "_new"]).drop("_new")

        self.rewrite(rows, run, batch_id, latest, parts)

    def add(self, rows: DataFrame, run: str, batch_id: int) -> None:
        """Add the other columns of rows up by key."""

        def summed(stored: DataFrame, new: DataFrame) -> DataFrame:
            fields = StructType.fromDDL(self.ddl).fields
            totals = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in fields if f.name not in self.keys]
            return stored.unionByName(new).groupBy(*self.keys).agg(*totals)

        self.rewrite(rows, run, batch_id, summed)


def _path(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    files, path = _path(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(path) or ()]


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.delete(path, True)
