"""The corpus pipeline over ``documents``: toxicity, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``. The dedup stages judge rows, not ids: rows that repeat an id, and rows
without one, are documents of their own, so one row of each group stays. Empty tables give empty
results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from docket.llm import exact_dedup, minhash_dedup, mixing, packing, toxicity
from docket.llm.common import load, only, saved, without
from docket.llm.queries import learn_from

TOXIC = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"), learn_from())
    return toxicity.with_score(docs, model).filter(F.col("score") < TOXIC).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one that the exact dedup keeps."""
    return _one_of_each(docs, exact_dedup.exact_groups)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies link."""
    return _one_of_each(docs, minhash_dedup.near_groups)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, so that domains get their shares of the tokens."""
    out, _ = mixing.mix(docs, load(spark, sf_dir, "labels", "doc_id", "quality"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return out.filter("copies > 0").select("row", times.alias("copy")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack(docs)


def _one_of_each(docs: DataFrame, groups: Callable[..., DataFrame]) -> DataFrame:
    number = f"r{uuid.uuid4().hex}"  # new, so that it cannot clash
    own = _numbered(docs, number)
    dropped = saved(groups(own, id_col=number).filter("NOT kept").select(number).distinct(), "dropped")
    return without(own, number, dropped).drop(number)


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """``docs`` with a number of each row: its id where no other row has it. Rows that repeat an id or have
    none get numbers of their own below all ids. Ids that are not whole numbers give way to numbers for all."""
    at, times = f"{number}_at", f"{number}_times"  # of the number's own name, so that they cannot clash either
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return saved(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    ids = saved(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias(times)), "ids")
    odd = ids.filter(F.col("doc_id").isNull() | (F.col(times) > 1)).select("doc_id")
    if odd.isEmpty():
        return docs.withColumn(number, F.col("doc_id").cast("long"))
    low = F.lit(ids.agg(F.min("doc_id")).first()[0] or 0).cast("long") - 1
    rest = docs.filter("doc_id IS NOT NULL")
    some = docs.filter("doc_id IS NULL").unionByName(only(rest, "doc_id", odd))
    some = saved(some.withColumn(at, F.monotonically_increasing_id()), "numbered").withColumn(number, low - F.col(at)).drop(at)
    return without(rest, "doc_id", odd).withColumn(number, F.col("doc_id").cast("long")).unionByName(some)


STAGES = [("toxicity", reject_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("mixing", mix_to_targets), ("packing", pack_sequences)]

# Trained models, hashes and a tokenizer decide: not expressible in SQL. tests/llm holds every
# stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
