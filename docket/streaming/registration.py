"""Keep a fold of an event log current from a stream, exactly, in whatever order events arrive (O-64, S3).

A fold such as ``registration_state`` cannot be carried as a running value: a late upload changes the
file of applications seen before it, a newer copy of an event takes back what the older one said.
So the log itself is kept, and the fold is made anew for the keys that a micro-batch touches:

* the batch is written to ``log/__batch=<id>/__bucket=<hash of the key>`` (a replay overwrites its own
  folder, so its effect is exactly once);
* the log's folders of the touched buckets, and of these the rows of the touched keys, are folded;
* the result is merged into a ``KeyedTable`` within the touched keys, which rewrites their buckets only.

A batch costs the log of its buckets and never the whole state. Nothing is held in memory for a key; a hot
key's rows are spread over tasks by the fold's own plan. ``compact`` replaces the batches so far by the newest
copy of each event.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docket.functions.scan import null_safe_join
from docket.sources.keyed import KeyedTable
from docket.sources.snapshots import SnapshotTable, path_exists

BATCH, BUCKET, THROUGH = "__batch", "__bucket", "__through"


class FoldedLog:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], id_cols: Sequence[str],
                 fold: Callable[[DataFrame], DataFrame], buckets: int = 64):
        """``schema``: columns of the log; ``id_cols`` with ``keys`` name an event, whose copies are ordered by the
        other columns as the schema has them. ``fold`` gives at most one row for each of ``keys`` and
        must not depend on the rows of other keys. ``buckets`` counts for a new log only."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.id_cols, self.fold = list(keys), list(id_cols), fold
        self.state = KeyedTable(spark, f"{self.root}/state", keys, buckets)
        self._bases = SnapshotTable(spark, f"{self.root}/base")

    @property
    def _log(self) -> str:
        return f"{self.root}/log"

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take a micro-batch in. Applying one again, or events that were seen before, changes nothing."""
        n = self.state.buckets()
        own = batch.select(*self.schema.names).withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int"))
        folder = f"{self._log}/{BATCH}={batch_id}"
        own.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        touched = self._read(folder).select(*self.keys, BUCKET).distinct()
        buckets = [r[0] for r in touched.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        if buckets:
            keys = touched.select(*self.keys)
            rows = null_safe_join(self.events(buckets), keys, self.keys, "left_semi")
            self.state.merge(self.fold(rows), within=keys)

    def _read(self, path: str) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(path)

    def events(self, buckets: Sequence[int] | None = None, until: int | None = None) -> DataFrame:
        """All copies of events kept, of some buckets or of all (other buckets' folders are not read), of all
        batches or those up to ``until``."""
        base, parts = self._bases.read(), []
        if base is not None:
            parts.append(base.select(*self.schema.names, BUCKET))
        if path_exists(self.spark, self._log):
            late = F.col(BATCH) > (-1 if base is None else base.select(THROUGH).first()[0])
            parts.append(self._batches().filter(late if until is None else late & (F.col(BATCH) <= until)).select(*self.schema.names, BUCKET))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))).select(*self.schema.names)

    def _batches(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(self._log)

    def read(self) -> DataFrame:
        """The fold's rows of all keys."""
        if not self.state.version():
            raise LookupError("no state yet")
        return self.state.read()

    def compact(self) -> int:
        """One file set with the newest copy of each event of all batches but the newest (which alone a stream may
        replay); returns the batch that it reaches, -1 if none. That number is a column of it, so both become
        visible in one commit; folders of batches up to it are no longer read and need a retention rule."""
        newest = self._batches().agg(F.max(BATCH)).first()[0] if path_exists(self.spark, self._log) else None
        if not newest:
            return -1
        names = [*self.keys, *self.id_cols]
        rest = [c for c in self.schema.names if c not in names]
        kept = self.events(until=newest - 1).groupBy(*names).agg(F.max(F.struct(*rest)).alias("__r"))
        rows = kept.select(*names, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*self.schema.names)
        rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.state.buckets())).cast("int"))
        self._bases.commit(rows.withColumn(THROUGH, F.lit(newest - 1).cast("long")).sortWithinPartitions(BUCKET))
        return newest - 1


def stream_fold(source_dir: str, source_schema: T.StructType, prepare: Callable[[DataFrame], DataFrame], log: FoldedLog,
                checkpoint: str, max_files_per_trigger: int | None = None) -> int:
    """Take in what has arrived (``availableNow``); the last batch's id, -1 if there was none. ``prepare``
    makes the log's columns of a row, each by itself."""
    reader = log.spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (prepare(reader.parquet(source_dir)).writeStream.foreachBatch(log.apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q.lastProgress["batchId"] if q.lastProgress else -1
