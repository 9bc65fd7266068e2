"""Ordered work over all rows without one task that sees them all.

Rows are dealt to range partitions of equal depth by sampled quantiles, whatever the
values are, and stored. Windows work inside a partition; one row for each partition (and
group) carries on what the partitions before it leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

_PLACE_BITS = 33


def dealt(df: DataFrame, *order: str | Column, inside: tuple[str, ...] = ()) -> DataFrame:
    """df, stored by ranges of the order: adds _part, the partition in that order, and _at, the place inside it.

    inside: further columns of the order; rows that differ in these alone stay in one partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order, *inside).withColumn("_id", F.monotonically_increasing_id())
    rows = stored(ranged, "dealt")
    return rows.select(*df.columns, F.shiftright("_id", _PLACE_BITS).cast("int").alias("_part"), F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_at"))


def _offsets(rows: DataFrame) -> DataFrame:
    """_part and _before, the rows of the partitions before it; a row a partition."""
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    return counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))


def numbered(df: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """Adds name, the place of each row in the order, from 0."""
    rows = dealt(df, *order)
    return rows.join(F.broadcast(_offsets(rows)), "_part").select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))


def following(df: DataFrame, column: str, name: str, number: str | None = None) -> DataFrame:
    """Adds name, the next larger value of column, whose values differ; null for the largest. number: its place, too."""
    rows = dealt(df, column)
    firsts = rows.groupBy("_part").agg(F.min(column).alias("_first"), F.count("*").alias("_n"))
    all_parts = Window.orderBy("_part")
    parts = firsts.select("_part", F.lead("_first").over(all_parts).alias("_after"), (F.sum("_n").over(all_parts) - F.col("_n")).alias("_before"))
    inside = rows.withColumn(name, F.lead(column).over(Window.partitionBy("_part").orderBy("_at")))
    out = inside.join(F.broadcast(parts), "_part").withColumn(name, F.coalesce(name, "_after"))
    return out.select(*df.columns, name, *([(F.col("_before") + F.col("_at")).alias(number)] if number else []))


def scan(
    df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None,
    before: dict[str, Column] | None = None, firsts: dict[str, Column] | None = None, previous: dict[str, Column] | None = None,
) -> DataFrame:
    """Running values in the order inside each group of by, in two passes, so that a group of any size spreads over tasks.

    sums: running sums, the row's own value included; nulls add nothing. lasts: the last
    value so far that isn't null, the row's own included. before: the same without the row's
    own. firsts: the first value so far that isn't null, without the row's own.
    previous: the value of the row before, null or not; null at the start of a group.
    """
    sums, lasts, before, firsts, previous = sums or {}, lasts or {}, before or {}, firsts or {}, previous or {}
    ready = {f"_v_{n}": v for group in (sums, lasts, before, firsts, previous) for n, v in group.items()}
    rows = dealt(df.select("*", *[v.alias(n) for n, v in ready.items()]), *[F.asc_nulls_first(c) for c in (*by, *order)])
    here = Window.partitionBy("_part", *by).orderBy("_at")
    upto, earlier = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    filled = lambda c: F.struct(F.col(c).alias("x"))  # noqa: E731  tells a null value from none
    ends = rows.groupBy("_part", *by).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col("_at"))).alias(f"_t_{n}") for n in (*lasts, *before)],
        *[F.min_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col("_at"))).alias(f"_t_{n}") for n in firsts],
        *[F.max_by(filled(f"_v_{n}"), "_at").alias(f"_t_{n}") for n in previous],
    )
    behind = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_k_{c}") for c in by],
        *[F.sum(f"_t_{n}").over(behind).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(behind).alias(f"_c_{n}") for n in (*lasts, *before, *previous)],
        *[F.first(f"_t_{n}", ignorenulls=True).over(behind).alias(f"_c_{n}") for n in firsts],
    )
    inside = rows.select(
        "*", *[F.sum(f"_v_{n}").over(upto).alias(f"_i_{n}") for n in sums],
        *[F.last(f"_v_{n}", ignorenulls=True).over(upto).alias(f"_i_{n}") for n in lasts],
        *[F.last(f"_v_{n}", ignorenulls=True).over(earlier).alias(f"_i_{n}") for n in before],
        *[F.first(f"_v_{n}", ignorenulls=True).over(earlier).alias(f"_i_{n}") for n in firsts],
        *[F.lag(filled(f"_v_{n}")).over(here).alias(f"_i_{n}") for n in previous],
    )
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    out = inside.join(carried if by else F.broadcast(carried), same)  # without groups it is a row a partition
    none = F.lit(0)
    return out.select(
        *df.columns, *[(F.coalesce(f"_i_{n}", none) + F.coalesce(f"_c_{n}", none)).alias(n) for n in sums],
        *[F.coalesce(f"_i_{n}", f"_c_{n}").alias(n) for n in (*lasts, *before)],
        *[F.coalesce(f"_c_{n}", f"_i_{n}").alias(n) for n in firsts],
        *[F.coalesce(f"_i_{n}", f"_c_{n}")["x"].alias(n) for n in previous],
    )
