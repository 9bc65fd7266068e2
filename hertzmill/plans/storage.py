"""Tables that are written once and read several times, below spark.checkpoint.dir."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which the driver and all executors share; an error where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/hertzmill-io-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
