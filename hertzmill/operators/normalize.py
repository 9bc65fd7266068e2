"""Nested bands to normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordered import numbered
from .validate import class_of


def number_bands(bands: DataFrame, order: list[str]) -> DataFrame:
    """Dense band_id from 1 in document order, numbered by ranges of equal depth; nulls come first."""
    rows = numbered(bands, "_place", *[F.asc_nulls_first(c) for c in order])
    return rows.select(*bands.columns, (F.col("_place") + 1).alias("band_id"))


def service_rows(bands: DataFrame) -> DataFrame:
    """(band_id, ordinal from 0, name, is_primary)."""
    return bands.select("band_id", F.posexplode("services").alias("ordinal", "s")).select("band_id", "ordinal", "s.name", "s.is_primary")


def band_footnote_rows(bands: DataFrame) -> DataFrame:
    """(band_id, footnote_id, scope, service_ordinal); repeats kept."""
    own = bands.select("band_id", F.posexplode("services").alias("service_ordinal", "s")).select("band_id", F.explode("s.footnotes").alias("footnote_id"), F.lit("service").alias("scope"), "service_ordinal")
    whole = bands.select("band_id", F.explode("footnotes").alias("footnote_id"), F.lit("band").alias("scope"), F.lit(None).cast("int").alias("service_ordinal"))
    return own.unionByName(whole)


def footnote_dim(bridge: DataFrame, definitions: DataFrame) -> DataFrame:
    """All ids cited or defined; an undefined one has no text and the class of its first character (itu if unknown)."""
    every = bridge.select(F.col("footnote_id").alias("id")).union(definitions.select("id")).distinct()
    joined = every.join(definitions.select("id", "class", "text"), "id", "left")
    return joined.select("id", F.coalesce("class", class_of(F.col("id")), F.lit("itu")).alias("class"), "text")


def meta_rows(spark: SparkSession, counts: dict[str, int], revision: str = "unknown") -> DataFrame:
    """Key and value from counts that are known."""
    fixed = {"source_revision": revision, "frequency_unit": "hertz", "interval_convention": "half-open [lo_hz, hi_hz)"}
    return spark.createDataFrame([*fixed.items(), *((k, str(n)) for k, n in counts.items())], "key string, value string")


def meta(bands: DataFrame, channels: DataFrame, definitions: DataFrame, rule_parts: DataFrame, revision: str = "unknown") -> DataFrame:
    """Key and value: counts, revision and conventions. Where tables are written, write_build() counts them as they pass."""
    out = meta_rows(bands.sparkSession, {}, revision)
    for key, df in (("band_count", bands), ("channel_count", channels), ("footnote_count", definitions), ("rule_part_count", rule_parts)):
        out = out.unionByName(df.agg(F.count("*").cast("string").alias("value")).select(F.lit(key).alias("key"), "value"))
    return out
