"""Reading inputs and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.hertz import JURISDICTIONS, jurisdictions, mhz_to_hz, strip
from ..operators.lookup import services_label
from ..operators.normalize import meta_rows

CSV_COLUMNS = ("id", "lo_mhz", "hi_mhz", "name", "service", "description", "mode", "tags", "source")
GRID = "doc_id long, table_index long, row_index long, cell_index int, span int, merged_up boolean, text string"
BLOCKS = "doc_id long, block_index int, kind string, text string"
#: The first tables of a document are allocation tables, later ones belong to the prose.
MAX_TABLES = 61


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """<path>/<jurisdiction>/*.csv with a header; fields are trimmed, rows with a blank id go, MHz become hertz."""
    rows = spark.read.schema(", ".join(f"{c} string" for c in CSV_COLUMNS)).csv(f"{path}/*/*.csv", header=True, quote='"', escape='"')
    rows = rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("jurisdiction"), *[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in CSV_COLUMNS])
    rows = rows.where("id != ''")
    return rows.select("id", "jurisdiction", mhz_to_hz(F.col("lo_mhz")).alias("lo_hz"), mhz_to_hz(F.col("hi_mhz")).alias("hi_hz"), "name", "service", "description", "mode", "tags", "source")


def read_grid(spark: SparkSession, path: str, max_tables: int = MAX_TABLES) -> DataFrame:
    """Grid cells of allocation tables."""
    return spark.read.schema(GRID).parquet(path).where(F.col("table_index") < max_tables)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Paragraphs and table marks in document order."""
    return spark.read.schema(BLOCKS).parquet(path)


def _by_ranges(df: DataFrame) -> DataFrame:
    return df.repartitionByRange("lo_hz").sortWithinPartitions("lo_hz", "hi_hz") if "lo_hz" in df.columns else df


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """S3: each table as Parquet; bands and channels are dealt by ranges of lo_hz and sorted, so that readers can skip files."""
    for name, df in tables.items():
        _by_ranges(df).write.mode("overwrite").parquet(f"{path}/{name}")


#: Keys of meta and the tables that they count.
COUNTED = {"band_count": "band", "channel_count": "channel", "footnote_count": "footnote", "rule_part_count": "rule_part"}


def write_build(tables: dict[str, DataFrame], path: str, revision: str = "unknown") -> dict[str, str]:
    """S3 and N5 in one pass: write_tables() with the table meta, whose counts are taken while the rows are written. Returns meta."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"rows of {name}")
        _by_ranges(df).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/{name}")
        counts[name] = seen.get["n"]
    spark = next(iter(tables.values())).sparkSession
    meta = meta_rows(spark, {key: counts.get(name, 0) for key, name in COUNTED.items()}, revision)
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return {r["key"]: r["value"] for r in meta.collect()}  # seven rows


def save_tables(tables: dict[str, DataFrame], path: str, prefix: str, buckets: int = 32) -> dict[str, DataFrame]:
    """S3 as tables of the catalog, <prefix>_<name>, stored below path: those with a band_id in buckets by it, bands also in a folder a jurisdiction.

    Operators that join or group by band_id (L9-L11, N2, N3) then move no rows, and a
    filter on the jurisdiction reads its folder alone.
    """
    out = {}
    for name, df in tables.items():
        if "band_id" in df.columns:
            writer = df.repartition(buckets, "band_id").write.bucketBy(buckets, "band_id").sortBy("band_id")
            writer = writer.partitionBy("jurisdiction") if "jurisdiction" in df.columns else writer
        else:
            writer = _by_ranges(df).write
        writer.mode("overwrite").option("path", f"{path}/{name}").saveAsTable(f"{prefix}_{name}")
        out[name] = df.sparkSession.table(f"{prefix}_{name}")
    return out


def nested_bands(bands: DataFrame, services: DataFrame, bridge: DataFrame) -> DataFrame:
    """Bands with services (name, primary, own footnotes, in order) and band-level footnotes."""
    own = bridge.where("scope = 'service'").groupBy("band_id", F.col("service_ordinal").alias("ordinal")).agg(F.sort_array(F.collect_list("footnote_id")).alias("f"))
    none = F.array().cast("array<string>")
    listed = services.join(own, ["band_id", "ordinal"], "left").groupBy("band_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("name"), F.col("is_primary").alias("primary"), F.coalesce("f", none).alias("footnotes")))).alias("s"))
    listed = listed.select("band_id", F.transform("s", lambda x: F.struct(x["name"].alias("name"), x["primary"].alias("primary"), x["footnotes"].alias("footnotes"))).alias("services"))
    whole = bridge.where("scope = 'band'").groupBy("band_id").agg(F.sort_array(F.collect_list("footnote_id")).alias("footnotes"))
    out = bands.join(listed, "band_id", "left").join(whole, "band_id", "left")
    empty = F.array().cast("array<struct<name:string,primary:boolean,footnotes:array<string>>>")
    return out.withColumn("services", F.coalesce("services", empty)).withColumn("footnotes", F.coalesce("footnotes", none))


def export_nested(tables: dict[str, DataFrame], path: str) -> None:
    """JSON lines, a directory a section; tables: bands, services, band_footnote, footnotes, rule_parts, channels, meta."""
    sections = {k: tables[k] for k in ("footnotes", "rule_parts", "channels", "meta") if k in tables}
    sections["bands"] = nested_bands(tables["bands"], tables["services"], tables["band_footnote"]).drop("band_id", "seq")
    sections["jurisdictions"] = jurisdictions(tables["bands"].sparkSession).drop("code")
    for name, df in sections.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def minimal_bands(bands: DataFrame, services: DataFrame) -> DataFrame:
    """J, lo, hi and s, pairs of service name and 0 or 1 in order."""
    listed = services.groupBy("band_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "name", F.col("is_primary").cast("int").alias("p")))).alias("s"))
    pair = F.transform("s", lambda x: F.array(x["name"].cast("variant"), x["p"].cast("variant")))
    out = bands.join(listed, "band_id", "left")
    return out.select(F.col("jurisdiction").alias("j"), F.col("lo_hz").alias("lo"), F.col("hi_hz").alias("hi"), F.coalesce(pair, F.array().cast("array<array<variant>>")).alias("s"))


def minimal_channels(channels: DataFrame) -> DataFrame:
    """Lo, hi, n, sv, d."""
    d = F.col("description") if "description" in channels.columns else F.lit("")
    return channels.select(F.col("lo_hz").alias("lo"), F.col("hi_hz").alias("hi"), F.col("name").alias("n"), F.col("service").alias("sv"), d.alias("d"))


def export_minimal(tables: dict[str, DataFrame], path: str) -> None:
    """Lookup-only JSON lines with short keys."""
    minimal_bands(tables["bands"], tables["services"]).write.mode("overwrite").json(f"{path}/bands")
    minimal_channels(tables["channels"]).write.mode("overwrite").json(f"{path}/channels")


def serving_bands(bands: DataFrame, services: DataFrame) -> DataFrame:
    """lo_hz, hi_hz, label, code of the jurisdiction and not_allocated."""
    codes = F.create_map(*[F.lit(x) for code, j in enumerate(JURISDICTIONS) for x in (j[0], code)])
    empty = F.col("not_allocated") if "not_allocated" in bands.columns else F.lit(False)
    joined = bands.withColumn("not_allocated", empty).join(services_label(services), "band_id", "left")
    return joined.select("lo_hz", "hi_hz", F.coalesce("label", F.lit("")).alias("label"), F.try_element_at(codes, F.col("jurisdiction")).alias("code"), "not_allocated")


def serving_tables(bands: DataFrame, services: DataFrame, channels: DataFrame) -> dict[str, DataFrame]:
    """Bands and channels sorted by (lo_hz, hi_hz), and the widest span of each (0 if empty)."""
    served = {"bands": serving_bands(bands, services), "channels": channels.select("lo_hz", "hi_hz", *[c for c in ("name", "service", "description", "mode") if c in channels.columns])}
    out = {k: df.repartitionByRange("lo_hz", "hi_hz").sortWithinPartitions("lo_hz", "hi_hz") for k, df in served.items()}
    spans = None
    for k, df in served.items():
        row = df.agg(F.coalesce(F.max(F.col("hi_hz") - F.col("lo_hz")), F.lit(0)).cast("long").alias("widest")).select(F.lit(k).alias("layer"), "widest")
        spans = row if spans is None else spans.unionByName(row)
    return out | {"spans": spans}
