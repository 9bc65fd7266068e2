"""Merkle manifest of a dataset: nodes carry the interval of leaf ranks that they cover.

Leaves are ranked per source, runs of three become their digest, level by level, up to a
subroot per source; subroots are the leaves of one more tree. A node is found by source,
level and bucket (the first rank over the span of its level) and contains what its
interval contains. Going down, a node joins its parent that way: the parent's parts less
its own interval are its siblings, and the siblings of all its ancestors are its parent's
path. Each level is a third of the one below, so all joins together are half as many rows
again as there are leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, numbered

ARITY = 3
_NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field of a leaf: its UTF-8 length, a colon and the value; - for null."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def is_tampered() -> Column:
    """Which documents the check alters: 2 divides the CRC-32 of the decimal id. A null id is left alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves_of(docs: DataFrame) -> DataFrame:
    """key (a number for each source, in order of the sources), lo, hi, n (leaves of the source), digest; doc_id and altered.

    Ranks ascend by doc_id inside a source, nulls first; rows that repeat an id by digest.
    A source of any size is spread over range partitions: a row a source and partition
    tells how many leaves lie before.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang")], F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    altered = F.when(is_tampered(), leaf_digest(F.translate(F.col("text"), "\n", "")))
    leaves = materialize(docs.select("doc_id", "source", leaf_digest(F.col("text")).alias("digest"), altered.alias("altered")), "leaves")
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("digest")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "leaves")
    discard(leaves)
    rows = rows.withColumn("part", F.shiftright("at", 33))
    of_source = Window.partitionBy("source")
    earlier = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    runs = runs.select(
        F.col("part").alias("p"), F.col("source").alias("s"), F.min("first").over(of_source).alias("key"), F.sum("here").over(of_source).alias("n"),
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    rows = rows.join(runs, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    return rows.select("key", (F.col("at") + F.col("shift")).alias("lo"), (F.col("at") + F.col("shift") + 1).alias("hi"), "n", "digest", "doc_id", "altered")


def grow(leaves: DataFrame) -> list[DataFrame]:
    """The levels of the trees, leaves first: key, lo, hi, n, digest and, above the leaves, parts (lo, hi, digest).

    A tree of n leaves ends at the first level whose span holds them all.
    """
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while ARITY ** (len(levels) - 1) < most:
        below, span = ARITY ** (len(levels) - 1), ARITY ** len(levels)
        runs = levels[-1].where(F.col("n") > below).groupBy("key", "n", F.expr(f"lo div {span}").alias("bucket"))
        nodes = runs.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("parts"))
        nodes = nodes.select("key", (F.col("bucket") * span).alias("lo"), F.element_at("parts", -1)["hi"].alias("hi"), "n", digest(F.array_join("parts.digest", "")).alias("digest"), "parts")
        levels.append(materialize(nodes, "nodes"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """key and digest of the last node of each tree."""
    out = None
    for level, nodes in enumerate(levels):
        some = nodes.where(F.col("n") <= ARITY**level).select("key", "digest")
        out = some if out is None else out.unionByName(some)
    return out


def descend(levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """The leaves with path, the (left, right) digests of siblings of each ancestor from the leaf up, and the columns of start.

    start: key, path (what follows the tree's own path) and other columns, a row a tree.
    """
    carried = [c for c in start.columns if c not in ("key", "path")]
    above = None
    for level in reversed(range(len(levels))):
        nodes = levels[level]
        placed = nodes.where(F.col("n") <= ARITY**level).join(start, "key")
        if above is not None:
            span = ARITY ** (level + 1)
            parent = above.select(F.col("key").alias("p_key"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("parts").alias("p_parts"), F.col("path").alias("p_path"), *carried)
            within = (F.col("key") == F.col("p_key")) & (F.expr(f"lo div {span}") == F.expr(f"p_lo div {span}")) & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            left = F.filter("p_parts", lambda x: x["hi"] <= F.col("lo"))
            right = F.filter("p_parts", lambda x: x["lo"] >= F.col("hi"))
            step = F.struct(F.array_join(left["digest"], "").alias("left"), F.array_join(right["digest"], "").alias("right"))
            met = nodes.where(F.col("n") > ARITY**level).join(parent, within).withColumn("path", F.concat(F.array(step), "p_path"))
            placed = placed.unionByName(met.select(placed.columns))
        above = placed
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """A leaf for each row of docs with its proof, and what the proof says of a tampered copy.

    doc_id, leaf, subroot (of the source), root (of the dataset), proof (array of the left
    and right siblings' digests, concatenated, from the leaf up), altered (the digest of
    the tampered row, null where none is tampered), folded_root (from altered, else from
    leaf, along the proof) and verified. A null source is a source of its own, before all
    others. Nulls in any column are written as -; a null doc_id comes first and is never
    tampered. Repeated rows are leaves of their own. Only doc_id, source, lang, n_chars
    and text are read. No rows: no rows.
    """
    sources = grow(leaves_of(docs))
    subroots = materialize(tops(sources), "subroots")
    ranked = numbered(subroots, "lo", "key").withColumn("n", F.lit(subroots.count()).cast("long"))
    ranked = ranked.select(F.lit(0).cast("long").alias("key"), "lo", (F.col("lo") + 1).alias("hi"), "n", "digest", F.col("key").alias("source_key"))
    whole = grow(ranked)
    root = materialize(tops(whole).select("key", F.array().cast(_NO_PATH).alias("path"), F.col("digest").alias("root")), "root")
    start = materialize(descend(whole, root).select(F.col("source_key").alias("key"), "path", F.col("digest").alias("subroot"), "root"), "starts")
    out = descend(sources, start)
    folded = F.aggregate("path", F.coalesce("altered", "digest"), lambda below, x: digest(x["left"], below, x["right"]))
    out = out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), "altered", folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, from the leaf up and left to right."""
    return digest(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""))
