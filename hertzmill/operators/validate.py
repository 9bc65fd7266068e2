"""Checks of bands, footnotes and channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hertz import center_hz, jurisdictions
from ..plans.intervals import point_join
from ..plans.ordered import scan

#: Class of a footnote by the first character of its id.
CLASS_OF = {"5": "itu", "U": "us", "N": "ng", "G": "g"}


def class_of(footnote_id: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CLASS_OF.items() for x in pair])
    return F.try_element_at(known, F.substring(footnote_id, 1, 1))


def dedupe_restated(bands: DataFrame, *by: str) -> DataFrame:
    """V1: one row per (by, jurisdiction, lo, hi), the first in document order (seq)."""
    keys = [*by, "jurisdiction", "lo_hz", "hi_hz"]
    rest = [c for c in bands.columns if c not in keys]
    return bands.groupBy(*keys).agg(F.min_by(F.struct(*rest), "seq").alias("x")).select(*keys, "x.*")


def _with_previous(bands: DataFrame, *by: str) -> DataFrame:
    """Restated bands gone; adds prev, the band before in (lo, hi) order of the jurisdiction, which may hold most rows."""
    keys = [*by, "jurisdiction"]
    unique = dedupe_restated(bands, *by)
    own = F.struct("lo_hz", "hi_hz", *[c for c in unique.columns if c not in (*keys, "lo_hz", "hi_hz")])
    return scan(unique, keys, ["lo_hz", "hi_hz"], previous={"prev": own})


def tiling_summary(bands: DataFrame, *by: str) -> DataFrame:
    """V2: bands, gaps, overlaps and span of each jurisdiction. The span ends with the last band in (lo, hi) order."""
    rows = _with_previous(bands, *by)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    order = F.struct("lo_hz", "hi_hz")
    return rows.groupBy(*by, "jurisdiction").agg(
        F.count("*").alias("bands"),
        n(F.col("lo_hz") > F.col("prev.hi_hz"))("gaps"),
        n(F.col("lo_hz") < F.col("prev.hi_hz"))("overlaps"),
        F.min_by("lo_hz", order).alias("span_lo"),
        F.max_by("hi_hz", order).alias("span_hi"),
    )


def tiling_issues(bands: DataFrame, *by: str) -> DataFrame:
    """V3: each gap and overlap with both neighbours (ranges, source and first 80 characters, where there are)."""
    rows = _with_previous(bands, *by).where(F.col("lo_hz") != F.col("prev.hi_hz"))
    out = [*by, "jurisdiction", F.when(F.col("lo_hz") > F.col("prev.hi_hz"), "GAP").otherwise("OVERLAP").alias("kind"), F.col("prev.lo_hz").alias("prev_lo"), F.col("prev.hi_hz").alias("prev_hi"), "lo_hz", "hi_hz"]
    for c in ("source", "raw_text"):
        if c in rows.columns:
            out += [F.substring(f"prev.{c}", 1, 80).alias(f"prev_{c}"), F.substring(c, 1, 80).alias(c)]
    return rows.select(*out)


def malformed(intervals: DataFrame) -> DataFrame:
    """V4: rows whose low edge isn't below the high one."""
    return intervals.where("lo_hz >= hi_hz")


def coverage(bands: DataFrame, lo: int = 0, hi: int = 275_000_000_000) -> DataFrame:
    """V5: whether each jurisdiction starts at lo and ends at hi."""
    return tiling_summary(bands).select("jurisdiction", (F.col("span_lo") == lo).alias("starts"), (F.col("span_hi") == hi).alias("ends"))


def dangling_footnotes(bridge: DataFrame, definitions: DataFrame) -> DataFrame:
    """V6: ids that a band or service cites and nothing defines, with the number of citations."""
    cited = bridge.groupBy("footnote_id").agg(F.count("*").alias("citations"))
    return cited.join(definitions.select(F.col("id").alias("footnote_id")), "footnote_id", "left_anti")


def footnote_class_mismatch(footnotes: DataFrame) -> DataFrame:
    """V7: footnotes whose class isn't that of their id's first character."""
    return footnotes.where(~class_of(F.col("id")).eqNullSafe(F.col("class")))


class ChannelError(ValueError):
    """Raised by channel_errors(strict=True)."""


def channel_errors(channels: DataFrame, strict: bool = False) -> DataFrame:
    """V8: (id, reason) for ids in several rows, unknown jurisdictions, unreadable frequencies, lo >= hi and blank sources.

    An unreadable frequency is a null edge, which mhz_to_hz() gives. strict: raises if
    there is any but a blank source.
    """
    known = jurisdictions(channels.sparkSession).select(F.col("id").alias("jurisdiction"))

    def reason(df: DataFrame, text: str) -> DataFrame:
        return df.select("id", F.lit(text).alias("reason"))

    found = [
        reason(channels.groupBy("id").agg(F.count("*").alias("n")).where("n > 1"), "duplicate id"),
        reason(channels.join(F.broadcast(known), "jurisdiction", "left_anti"), "unknown jurisdiction"),  # seven rows
        reason(channels.where("lo_hz is null or hi_hz is null"), "unreadable frequency"),
        reason(malformed(channels), "lo >= hi"),
    ]
    errors = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    if strict and (first := errors.orderBy("reason", "id").first()):
        raise ChannelError(f"{first['reason']}: {first['id']}")
    if "source" in channels.columns:
        errors = errors.unionByName(reason(channels.where(F.coalesce(F.trim("source"), F.lit("")) == ""), "blank source"))
    return errors


def population(rows: DataFrame, least: int = 0) -> DataFrame:
    """V9: rows of each jurisdiction, 0 included, and whether there are at least so many."""
    every = jurisdictions(rows.sparkSession).select(F.col("id").alias("jurisdiction"))
    counted = every.join(rows.groupBy("jurisdiction").agg(F.count("*").alias("n")), "jurisdiction", "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return counted.select("jurisdiction", n.alias("n_rows"), (n >= least).alias("enough"))


def raster_check(channels: DataFrame, grid: Column, step_hz: int) -> DataFrame:
    """For each grid, channels, first centre, and neighbours whose centres aren't step_hz apart."""
    rows = channels.withColumn("grid", grid).where("grid is not null").withColumn("center", center_hz())
    step = F.col("center") - F.lag("center").over(Window.partitionBy("grid").orderBy("lo_hz", "hi_hz", "id"))
    return rows.withColumn("step", step).groupBy("grid").agg(F.count("*").alias("channels"), F.min("center").alias("first_center"), F.sum(F.when(F.col("step") != step_hz, 1).otherwise(0)).alias("off_raster"))


def expect_at(expectations: DataFrame, bands: DataFrame, services: DataFrame) -> DataFrame:
    """Adds passed to (hz, jurisdiction, want_lo, want_hi, contains).

    The first band in document order that covers hz in the jurisdiction must have those
    edges, and its service names, joined by spaces, the text. No band: not passed.
    """
    names = services.groupBy("band_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]), " ").alias("names"))
    keys = ["hz", "jurisdiction", "want_lo", "want_hi", "contains"]
    met = point_join(expectations.select(*keys).distinct(), bands, on=("jurisdiction",))
    first = met.groupBy(*keys).agg(F.min_by(F.struct("band_id", "lo_hz", "hi_hz"), "seq").alias("b")).select(*keys, "b.*").join(names, "band_id", "left")
    fits = (F.col("lo_hz") == F.col("want_lo")) & (F.col("hi_hz") == F.col("want_hi")) & F.coalesce(F.contains("names", "contains"), F.lit(False))
    told = first.withColumn("passed", fits).select(*[F.col(k).alias(f"_{k}") for k in keys], "passed")
    same = [expectations[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
    return expectations.join(told, same, "left").select(*[expectations[c] for c in expectations.columns], F.coalesce("passed", F.lit(False)).alias("passed"))


def diff_builds(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one build of a table that the other lacks, repeats counted; side is a or b."""
    b = b.select(a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


#: Ranges that diff_by_ranges() cuts the key, and each range that differs, into.
RANGES = 64


def _within(key: str, parts: list[tuple]) -> Column:
    """Whether key lies in one of the parts [lo, hi); None is open, and a null key belongs to the part that begins with None."""
    out = F.lit(False)
    for lo, hi in parts:
        out = out | (F.lit(True) if lo is None else F.col(key) >= lo) & (F.lit(True) if hi is None else F.coalesce(F.col(key) < hi, F.lit(lo is None)))
    return F.coalesce(out, F.lit(False))


def differing_ranges(a: DataFrame, b: DataFrame, key: str) -> list[tuple]:
    """Ranges [lo, hi) of key outside of which the builds are equal, by digests: of RANGES ranges, then of as many in each that differs.

    A digest is a count and a sum of 64-bit hashes of whole rows, so repeats count and the order
    doesn't. The driver sees a digest a range. The first cut follows the quantiles of a.
    """
    parts: list[tuple] = [(None, None)]
    for _ in range(2):
        if len(parts) > RANGES // 2:  # most of the table differs
            return parts
        some = a.where(_within(key, parts))
        cuts = some.agg(F.percentile_approx(key, [i / (RANGES * len(parts)) for i in range(1, RANGES * len(parts))], 100 * RANGES).alias("c")).first()["c"] or []
        edges = sorted({*cuts, *(x for p in parts for x in p if x is not None)})
        if not edges:
            return parts
        place = F.size(F.filter(F.array(*[F.lit(x) for x in edges]), lambda x: x <= F.col(key)))
        digest = lambda df: df.where(_within(key, parts)).groupBy(F.coalesce(place, F.lit(0)).alias("r")).agg(F.count("*").alias("n"), F.sum(F.xxhash64(*a.columns).cast("decimal(38,0)")).alias("h"))  # noqa: E731, B023
        both = digest(a).withColumn("side", F.lit(1)).unionByName(digest(b).withColumn("side", F.lit(-1)))
        odd = both.groupBy("r").agg(F.sum(F.col("side") * F.col("n")).alias("n"), F.sum(F.col("side") * F.col("h")).alias("h")).where("n != 0 or h != 0")
        bounds = [None, *edges, None]
        parts = [(bounds[r["r"]], bounds[r["r"] + 1]) for r in odd.orderBy("r").collect()]
        if not parts:
            return []
    return parts


def diff_by_ranges(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """V12 for large builds that differ in few places: diff_builds() of the ranges of key that differ, the others being read for digests alone.

    Tables that are sorted by key (S3 by lo_hz) skip row groups outside of those ranges.
    """
    b = b.select(a.columns)
    parts = differing_ranges(a, b, key)
    return diff_builds(a.where(_within(key, parts)), b.where(_within(key, parts)))


def parse_problems(chunks: DataFrame) -> DataFrame:
    """Source and problem of parsed chunks that say nothing or whose range doesn't increase."""
    empty = chunks.where("lo_hz is null and size(services) = 0 and size(footnotes) = 0").select("source", F.concat(F.lit("unparsed cell "), F.substring("raw_text", 1, 60)).alias("problem"))
    turned = chunks.where("lo_hz >= hi_hz").select("source", F.concat(F.lit("non-increasing range "), F.col("lo_hz").cast("string"), F.lit("-"), F.col("hi_hz").cast("string")).alias("problem"))
    return empty.unionByName(turned)
