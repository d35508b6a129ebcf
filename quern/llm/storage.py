"""Reading tables; durable(), settled() and release() keep and drop results in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.operators.durable import durable, release, settled

__all__ = ["durable", "release", "settled", "table", "unused"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, df: DataFrame) -> str:
    """name, with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
