"""Mixing sources to target weights by hash thresholds.

Every row gets a 52-bit hash. Tokens are summed by source and hash bucket; the budget of
a source falls into one bucket, which alone is refined by the next bits of the hash,
until the threshold is exact to the hash. A row is then taken if its hash is below the
threshold of its source: no sort, and a larger budget takes a superset of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAK, fresh, materialize, numbered

LEVELS, LEVEL_BITS = 4, 13
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text: runs of characters other than space, tab, LF, VT, FF and CR; null has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text, WORD_BREAK, -1), "")), F.lit(0)).cast("long")


def row_hash(key: Column) -> Column:
    """The first 52 bits of the MD5 of a key's text; null hashes like an empty one."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("long")


def shares(sizes: DataFrame, weights: tuple = WEIGHTS, amount: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds weight and target to (source, source_size), one row a source.

    Sources by code point, null last, weigh as given, repeating. They share amount times
    all sizes by weight; what exceeds most times a source's size is shared again among the
    others until none exceeds. Each round of that is one aggregate over the sources.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = numbered(sizes, "place", F.col("source").asc_nulls_last()).withColumn("weight", weight).drop("place")
    rows = materialize(rows, "sources")
    rate, held = 0.0, -1
    while True:
        full = F.col("source_size") * F.lit(float(most)) <= F.lit(rate) * F.col("weight")
        total, capped, n, rest = rows.agg(F.sum("source_size"), F.sum(F.when(full, F.col("source_size"))), F.count_if(full), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest or n == held:
            break
        rate, held = (amount * total - most * (capped or 0)) / rest, n
    target = F.least(F.col("source_size") * F.lit(float(most)), F.lit(rate) * F.col("weight"))
    return rows.withColumn("target", F.col("source_size") * F.lit(float(most)) if not rest else target)


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, below): rows with a smaller hash sum up to the source's budget, or just miss it.

    budgets: source, budget. One aggregate by level; only rows of the boundary bucket go
    on, and of the two ends of the last bucket the nearer one is chosen.
    """
    state = budgets.select(F.col("source").alias("s"), F.col("budget").cast("double"), F.lit(0).cast("long").alias("prefix"))
    for level in range(1, LEVELS + 1):
        rest = LEVEL_BITS * (LEVELS - level)
        inside = rows.join(state, rows["source"].eqNullSafe(state["s"])).where(F.shiftright("hash", rest + LEVEL_BITS) == F.col("prefix"))
        buckets = inside.groupBy("s", "budget", F.shiftright("hash", rest).alias("bucket")).agg(F.sum("size").alias("size"))
        order = Window.partitionBy("s").orderBy("bucket")  # at most 2^13 buckets a source
        buckets = buckets.withColumn("before", F.sum("size").over(order) - F.col("size")).withColumn("last", F.lead("bucket").over(order).isNull())
        at = buckets.where("before <= budget and (budget < before + size or last)")
        found = at.groupBy("s").agg(F.max(F.struct("bucket", "before", "size", "budget")).alias("x"))
        if level < LEVELS:
            state = found.select("s", (F.col("x.budget") - F.col("x.before")).alias("budget"), F.col("x.bucket").alias("prefix"))
        else:
            state = found.select("s", (F.col("x.bucket") + (F.col("x.budget") - F.col("x.before") >= F.col("x.size") / 2).cast("long")).alias("below"))
        state = materialize(state, "thresholds")
    return state


def mixing_plan(docs: DataFrame, weights: tuple = WEIGHTS, amount: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(rows, plan). rows: doc_id, source, size and hash of every row of docs, a scratch table.

    plan, one row a source: s, source_size, target, times (whole rounds that every row is
    taken) and below (rows with a smaller hash are taken once more; null: none).
    """
    words, h = word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id")).alias("hash")
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words, h), "sizes")
    plan = shares(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, amount, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = materialize(plan.select("source", "source_size", "target", times.alias("times")), "targets")
    below = _thresholds(rows, plan.where("source_size > 0").select("source", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget")))
    # written, so that Spark knows its size when it chooses how to join it
    return rows, materialize(plan.join(below, plan["source"].eqNullSafe(below["s"]), "left").drop("s").withColumnRenamed("source", "s"), "plan")


def _copies(hashed: Column) -> Column:
    return F.col("times") + F.coalesce(hashed < F.col("below"), F.lit(False)).cast("long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, amount: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row.

    size: the row's words (null text: 0). A source with target t and size z takes every
    row floor(t / z) times, and once more the rows whose hash is below its threshold.
    Hashes come from doc_id, so reruns agree and equal ids stand or fall together.
    A null source is a source of its own; a source without words takes nothing. Only
    doc_id, source and text are read. No rows: no rows.
    """
    rows, plan = mixing_plan(docs, weights, amount, most)
    out = rows.join(plan, rows["source"].eqNullSafe(plan["s"]), "left")
    copies = _copies(F.col("hash"))
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, amount: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of docs as often as the mix takes them, all columns as they were."""
    _, plan = mixing_plan(docs, weights, amount, most)
    names = {c: fresh(docs, f"mix_{c}") for c in ("s", "times", "below")}
    plan = plan.select(*names).withColumnsRenamed(names)
    source, times, below = (F.col(x) for x in names.values())
    copies = times + F.coalesce(row_hash(F.col("doc_id")) < below, F.lit(False)).cast("long")
    repeated = docs.join(plan, docs["source"].eqNullSafe(source), "left").where(copies > 0)
    copy = fresh(docs, "mix_copy")
    return repeated.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(copy)).drop(copy)
