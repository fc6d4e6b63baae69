"""Keep latest-event state current from an event stream (O-64, a re-aim of
the batch refresh: the reference itself has no streaming).

Plan: file-source stream -> keyed streaming aggregation holding
``max(struct(order..., payload...))`` per key in the state store (checkpointed,
so executor loss and restarts are survived) -> ``update`` output mode, so each
micro-batch emits only the keys that changed -> ``foreachBatch`` writes those
rows to ``changes/batch_id=<id>``. A replayed micro-batch overwrites its own
folder, so the effect is exactly once. The cost per micro-batch is the size
of the change, not of the state.

Readers merge on read: max per key over the last compacted snapshot plus the
change folders written after it (partition pruning on ``batch_id``).
``compact()`` folds them into a new snapshot version. Because the state is an
event-time max, late events are accepted and replaying files in any order
converges to the batch answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docket.sources.snapshots import SnapshotTable, path_exists


THROUGH = "__through"


class LatestState:
    """Latest row per key, kept as a compacted snapshot plus change folders."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], cols: Sequence[str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.cols = list(keys), list(cols)
        self.snapshots = SnapshotTable(spark, f"{self.root}/snapshot")

    @property
    def changes_path(self) -> str:
        return f"{self.root}/changes"

    def write_changes(self, batch: DataFrame, batch_id: int) -> None:
        batch.select(*self.keys, *self.cols).write.mode("overwrite") \
             .parquet(f"{self.changes_path}/batch_id={batch_id}")

    def _compacted_through(self, snapshot: DataFrame | None) -> int:
        """Newest change batch that a snapshot holds: a column of the snapshot itself, so that both
        become visible in one commit."""
        row = None if snapshot is None else snapshot.select(THROUGH).first()
        return -1 if row is None else row[0]

    def _merge(self, parts: list[DataFrame]) -> DataFrame:
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        best = F.max(F.struct(*[F.col(c) for c in self.cols])).alias("__b")
        return both.groupBy(*self.keys).agg(best).select(*self.keys, *[F.col(f"__b.{c}").alias(c) for c in self.cols])

    def read(self) -> DataFrame:
        parts = []
        base = self.snapshots.read()
        through = self._compacted_through(base)
        if base is not None:
            parts.append(base.select(*self.keys, *self.cols))
        if path_exists(self.spark, self.changes_path):
            ch = self.spark.read.parquet(self.changes_path).filter(F.col("batch_id") > through)
            parts.append(ch.select(*self.keys, *self.cols))
        if not parts:
            raise LookupError("no state yet")
        return self._merge(parts)

    def compact(self) -> int:
        """Fold all changes into a new snapshot version; returns the version.

        One commit makes the rows and the batch they reach visible together: a crash or a reader
        in between sees the old snapshot and its changes. Change folders that already the
        snapshot before held are removed, so readers of that one still find the later ones.
        """
        if not path_exists(self.spark, self.changes_path):
            return self.snapshots.current_version() or 0
        folded = self._compacted_through(self.snapshots.read())
        ids = self.spark.read.parquet(self.changes_path).agg(F.max("batch_id").alias("m")).first().m
        if ids is None or ids <= folded:
            return self.snapshots.current_version() or 0
        v = self.snapshots.commit(self.read().withColumn(THROUGH, F.lit(int(ids)).cast("long")))
        self._expire(folded)
        return v

    def _expire(self, through: int) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.changes_path)
        fs = root.getFileSystem(conf)
        for st in fs.listStatus(root):
            kind, _, number = st.getPath().getName().partition("=")
            if kind == "batch_id" and int(number) <= through:
                fs.delete(st.getPath(), True)


def stream_latest_state(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
                        order: Sequence[str], payload: Sequence[str], state_root: str, checkpoint: str,
                        max_files_per_trigger: int | None = None) -> LatestState:
    """Run the stream over what has arrived (``availableNow``) and return the state.

    The state holds one row per key: ``order`` columns then ``payload``
    columns of the newest event.
    """
    cols = [*order, *payload]
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source_dir)
    changed = (events.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("__b"))
                     .select(*keys, *[F.col(f"__b.{c}").alias(c) for c in cols]))
    state = LatestState(spark, state_root, keys, cols)
    q = (changed.writeStream.outputMode("update").foreachBatch(state.write_changes)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return state
