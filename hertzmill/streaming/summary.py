"""Summaries of sightings as they arrive."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.lookup import summary_segments
from ..plans.intervals import MANY, highest_edge, segment_lookup
from ..plans.storage import stored

_VERSIONS = "version long, top long, n long"


def summary_stream(stream: DataFrame, channels: DataFrame, bands: DataFrame, services: DataFrame) -> DataFrame:
    """The columns of a streaming DataFrame of sightings (hz) and each one's summary.

    Stateless: each point meets exactly one of the disjoint segments, so an inner
    stream-static join keeps every row, in append mode. The segments are computed once and
    written to the shared folder; micro-batches only read them. Where channels change while
    the stream runs, see publish_segments().
    """
    segments = stored(summary_segments(channels, bands, services), "segments")
    return segment_lookup(stream, segments, highest_edge(channels, bands), segments.count() <= MANY)


def publish_segments(path: str, channels: DataFrame, bands: DataFrame, services: DataFrame) -> int:
    """Writes a new version of the segments below path, for streams that summaries_of() started; returns its number.

    A version is announced by one row when all of it is written, so a reader sees all or
    nothing of it. Versions are numbered by the clock of the one that publishes them.
    """
    spark, version = channels.sparkSession, time.time_ns()
    where = f"{path}/segments/{version}"
    summary_segments(channels, bands, services).write.parquet(where)
    n = spark.read.schema("s_lo long, s_hi long, summary string").parquet(where).count()
    row = spark.createDataFrame([(version, highest_edge(channels, bands), n)], _VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/published")
    return version


def current_segments(spark: SparkSession, path: str) -> tuple[DataFrame, int, bool]:
    """The last published segments, their highest edge, and whether they are few enough to be broadcast."""
    last = spark.read.schema(_VERSIONS).parquet(f"{path}/published").orderBy(F.desc("version")).first()
    return spark.read.schema("s_lo long, s_hi long, summary string").parquet(f"{path}/segments/{last['version']}"), last["top"], last["n"] <= MANY


def summaries_of(stream: DataFrame, path: str, sink: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A writer that hands each micro-batch with its summaries to sink(df, batch_id), by the segments that are current when it begins.

    Set a trigger and a checkpointLocation on it and start it. A batch that is run again
    after a failure has its old number, so the sink should overwrite by that number.
    """

    def with_current(batch: DataFrame, batch_id: int) -> None:
        segments, top, few = current_segments(batch.sparkSession, path)
        sink(segment_lookup(batch, segments, top, few), batch_id)

    return stream.writeStream.foreachBatch(with_current)
