"""Numeric and text rules of frequencies: integer hertz, half-open intervals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = r"^[\s\u00a0\u2009]+|[\s\u00a0\u2009]+$"
SCALE = {"kHz": 1e3, "MHz": 1e6, "GHz": 1e9}
#: The jurisdictions, in the order of their compact codes.
JURISDICTIONS = (
    ("itu-r1", "ITU Region 1", "ITU", None, 1),
    ("itu-r2", "ITU Region 2", "ITU", None, 2),
    ("itu-r3", "ITU Region 3", "ITU", None, 3),
    ("us-federal", "United States (Federal)", "FCC/NTIA", "US", 2),
    ("us-non-federal", "United States (non-Federal)", "FCC", "US", 2),
    ("us", "United States (general)", "FCC", "US", 2),
    ("eu", "Europe (CEPT)", "CEPT/ECC", None, 1),
)


def strip(text: Column) -> Column:
    """Without white space, no-break spaces included, at both ends."""
    return F.regexp_replace(text, BLANK, "")


def mhz_to_hz(text: Column) -> Column:
    """Decimal MHz text to hertz, half-even, no binary float on the way. Unreadable text is null."""
    return F.bround(strip(text.cast("string")).try_cast("decimal(28,12)") * F.lit(1000000).cast("decimal(7,0)"), 0).cast("long")


def query_mhz_to_hz(value: Column) -> Column:
    """MHz as a double to hertz, half-even on the double product."""
    return F.rint(value.cast("double") * F.lit(1e6)).cast("long")


def center_hz(lo: str = "lo_hz", hi: str = "hi_hz") -> Column:
    """Middle of an interval, rounded down."""
    return F.col(lo) + F.expr(f"({hi} - {lo}) div 2")


def _shown(hz: pd.Series) -> pd.Series:
    """Texts of whole hertz, a batch at a time."""

    def one(x: float) -> str | None:
        if pd.isna(x):
            return None
        x = int(x)
        size = next((k for k in ("GHz", "MHz", "kHz") if abs(x) >= SCALE[k]), None)
        return f"{x / SCALE[size]:g} {size}" if size else f"{x} Hz"

    return hz.map(one)


def fmt_hz(hz: Column | str) -> Column:
    """L19: '162.55 MHz', '77.5 kHz' or 'n Hz' with six significant digits, as printf's %g.

    An Arrow-batched helper: Spark's own format keeps trailing zeros and rounds ties up.
    """
    return F.pandas_udf(_shown, "string")(hz)


def channel_from_center(df: DataFrame, center_mhz: str, bw_khz: str) -> DataFrame:
    """lo_hz and hi_hz of a centre in decimal MHz and a bandwidth in decimal kHz."""
    center = F.col(center_mhz).cast("decimal(28,12)")
    half = (F.col(bw_khz).cast("decimal(20,6)") / F.lit(2000).cast("decimal(4,0)")).cast("decimal(28,12)")
    million = F.lit(1000000).cast("decimal(7,0)")
    return df.withColumn("lo_hz", F.bround((center - half) * million, 0).cast("long")).withColumn("hi_hz", F.bround((center + half) * million, 0).cast("long"))


def raster(spark: SparkSession, prefix: str, base_mhz: str, step_khz: str, n: int, bw_khz: str) -> DataFrame:
    """A regular grid of n channels; ids are zero-padded from 1."""
    width = max(2, len(str(n)))
    rows = spark.range(n).select(
        F.concat(F.lit(f"{prefix}-"), F.lpad((F.col("id") + 1).cast("string"), width, "0")).alias("id"),
        (F.lit(base_mhz).cast("decimal(20,9)") + F.col("id").cast("decimal(10,0)") * (F.lit(step_khz).cast("decimal(12,6)") / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,9)")).cast("decimal(28,12)").alias("center_mhz"),
        F.lit(bw_khz).alias("bw_khz"),
    )
    return channel_from_center(rows, "center_mhz", "bw_khz").select("id", "lo_hz", "hi_hz")


def jurisdictions(spark: SparkSession) -> DataFrame:
    """The dimension of jurisdictions, with their compact codes."""
    return spark.createDataFrame(
        [(*j, code) for code, j in enumerate(JURISDICTIONS)], "id string, name string, authority string, country string, itu_region int, code int"
    )
