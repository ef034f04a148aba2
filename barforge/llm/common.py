"""Helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.session import scratch_path

LAST_ID = 2**63 - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read again:
    cuts the lineage, survives lost executors, and gives both sides of a
    later join plain exchanges, which adaptive execution can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def id_key(c: str) -> Column:
    """A null id counts as one id that sorts after all others."""
    return F.coalesce(F.col(c).cast("long"), F.lit(LAST_ID))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def total_bytes(df: DataFrame, c: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(c))).first()[0] or 0


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

