"""Landing control, processed-file split and sync status (O-01, O-04, O-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTROL_SCHEMA = T.StructType([
    T.StructField("schema_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("load_type", T.StringType()),   # FULL | INCR
    T.StructField("key_columns", T.StringType()),  # comma separated, INCR only
])


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The loader control file: CSV with header, explicit schema."""
    return spark.read.schema(CONTROL_SCHEMA).option("header", True).csv(path)


def split_processed(files: DataFrame, errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct files with ``processed`` = not in the error list (O-04).

    NOT EXISTS semantics, not NOT IN: a NULL in the error list does not empty the result
    (trap T6), and a file with a NULL key matches no error. One aggregation over both lists
    instead of an anti and a semi join.
    """
    both = (files.select(*keys, F.lit(True).alias("__file"), F.lit(False).alias("__bad"))
            .unionByName(errors.select(*keys, F.lit(False).alias("__file"), F.lit(True).alias("__bad"))))
    x = both.groupBy(*keys).agg(F.max("__file").alias("__file"), F.max("__bad").alias("__bad")).filter("__file")
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    return x.select(*keys, (~(F.col("__bad") & named)).alias("processed"))


def sync_status(df: DataFrame, ts_col: str, probe: Column) -> DataFrame:
    """High-water mark and an arrival flag in one aggregate (O-05)."""
    return df.agg(F.max(ts_col).alias("high_water"), F.count(F.lit(1)).alias("n_rows"),
                  (F.count(F.when(probe, 1)) > 0).alias("arrived"))
