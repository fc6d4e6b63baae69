"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.session import scratch_path

SPACE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows in one Arrow batch handed to Python: bounds a worker's memory by so many texts.
BATCH_ROWS = 512


def load(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Batches of at most ``rows`` rows for the Arrow stages that follow in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, whatever the session's setting."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: lineage ends here, and a
    lost executor costs no more than its running tasks."""
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


SLOTS = 1 << 22


def _slot(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SLOTS).cast("long"))


def _sieve(df: DataFrame, col: str, ids: DataFrame, id_col: str) -> tuple[DataFrame, Column, DataFrame, Column]:
    """(slots of the ids for a broadcast, their match with ``df``, the ids, their match). Slots are at
    most ``SLOTS`` numbers, however many ids there are. The names are new, so that none can clash."""
    slot, own = f"s{uuid.uuid4().hex}", f"i{uuid.uuid4().hex}"
    return (F.broadcast(ids.select(_slot(F.col(id_col)).alias(slot)).distinct()), _slot(F.col(col)) == F.col(slot),
            ids.select(F.col(id_col).alias(own)), F.col(col) == F.col(own))


def only(df: DataFrame, col: str, ids: DataFrame, id_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``col`` is among ``ids``: a semi join before which most rows that are
    not are dropped where they stand, by the slots, so that wide rows need no shuffle."""
    slots, near, ids, same = _sieve(df, col, ids, id_col or col)
    return df.join(slots, near, "left_semi").join(ids, same, "left_semi")


def without(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not among ``ids`` (a null is not): rows of other slots stay
    where they are, only the rest is shuffled for the anti join."""
    slots, near, ids, same = _sieve(df, col, ids, col)
    return df.join(slots, near, "left_anti").unionByName(df.join(slots, near, "left_semi").join(ids, same, "left_anti"))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def sha(c: Column) -> Column:
    """sha256 in lower-case hex."""
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """A value with its bytes counted before it, so that neighbouring fields cannot run into each
    other; ``-`` for a null."""
    t = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))


def row_digest(*fields: Column) -> Column:
    return sha(F.concat(*[field(c) for c in fields]))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text has this remainder; a null id is hashed as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
