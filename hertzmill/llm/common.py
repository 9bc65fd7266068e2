"""What several operators share: scratch tables, components, whole-text hashing.

Scratch tables are Parquet below ``spark.checkpoint.dir``, so that lineage is cut in
storage that every executor sees and a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that part words; everything else belongs to a word.
WORD_BREAK = r"[ \t-\r]+"


# --------------------------------------------------------------------------- scratch
def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of this application, below spark.checkpoint.dir; an error where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/hertzmill-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: With it Spark deletes the shuffle files of a query when that has ended.
DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, partition_by: str | None = None, free: bool = False) -> DataFrame:
    """Write to a scratch table and read it back: later readers start from storage.

    free: the shuffle files of the write are deleted when it is done, not when the driver
    happens to collect its garbage. Nothing reads them any more.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    writer, before = df.write, conf.get(DELETE_SHUFFLES, None)
    try:
        if free:
            conf.set(DELETE_SHUFFLES, "true")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        if free and before is None:
            conf.unset(DELETE_SHUFFLES)
        elif free:
            conf.set(DELETE_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a scratch table that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str, *order) -> DataFrame:
    """Adds name, the place of each row in the order, from 0. The driver sees one count for each partition."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    before, total = [], 0
    for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        before.append((r["part"], total))
        total += r["n"]
    before = spark.createDataFrame(before, "_part long, _before long")
    out = rows.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row a partition
    return out.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).select(*df.columns, name)


# ------------------------------------------------------------------------ components
def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within one task: replace edges by stars around the smallest node of each local tree."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        for a, b in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["u", "v"]
        )


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Alternating large-star and small-star steps until no edge changes. Each step is a
    partially aggregated minimum and an equi-join; no neighbour list is collected.
    Null ends are dropped.
    """
    e = (
        edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .mapInArrow(_forest, "u long, v long")
        .distinct()
    )
    e = materialize(e, "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        nxt = materialize(small.distinct(), "edges")
        discard(e)
        e = nxt
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


MOST_SLOTS = 1 << 24


def likely_in(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of df whose key may be among ids; a few others may stay. Shrinks what a join shuffles.

    A bit map over hash slots, about eight slots an id, is broadcast as words of 64 bits:
    at most 2^18 rows whatever the number of ids. Null keys go.
    """
    slots = 1 << 16
    n = ids.count()
    while slots < min(8 * n, MOST_SLOTS):
        slots *= 2

    def slot(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(slots))

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("_slot"), F.lit(64)).cast("int"))
    words = ids.where(F.col(id_col).isNotNull()).select(slot(id_col).alias("_slot")).groupBy(F.floor(F.col("_slot") / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    tested = df.where(F.col(key).isNotNull()).withColumn("_slot", slot(key)).withColumn("_word", F.floor(F.col("_slot") / 64))
    return tested.join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0).drop("_slot", "_word", "_bits")


# ------------------------------------------------------------------------ whole texts
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_ODD = np.uint64(_BASE)
_rng = np.random.default_rng(20240917)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[32, 9, 10, 11, 12, 13]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            step = np.full(size, np.uint64(base))
            step[0] = 1
            _powers[key] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h ^= h >> np.uint64(29)
    h *= _ODD
    return h ^ (h >> np.uint64(32))


#: Bytes that are hashed at once; a longer text is cut between words.
AT_ONCE = 1 << 21


def hash_words(data: np.ndarray, fold: bool = True, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of every word of UTF-8 bytes.

    ``fold`` lower-cases A-Z. ``bounds``: sorted byte offsets at which a text ends and the
    next begins, so that words of several texts can be hashed in one go. A word's value
    is a polynomial in an odd base over random byte values, taken from running sums.
    """
    parts, lo, n = [], 0, len(data)
    while lo < n:
        hi = min(n, lo + AT_ONCE)
        while hi < n and not (at := np.flatnonzero(_IS_BREAK[data[hi : hi + AT_ONCE]])).size:
            hi = min(n, hi + AT_ONCE)
        hi = n if hi >= n else hi + int(at[0])
        h, first, last = _hash_part(data[lo:hi], fold, None if bounds is None else bounds - lo)
        parts.append((h, first + lo, last + lo))
        lo = hi
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _hash_part(data: np.ndarray, fold: bool, bounds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    word = ~_IS_BREAK[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    if bounds is not None:
        inner = bounds[(bounds > 0) & (bounds < n)]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _VALUE)[data] * up[:n], out=total[1:])
    return mix((total[last] - total[first]) * down[first]), first, last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), offsets


def texts_in_slices(column: pa.Array, fold: bool = True, slice_bytes: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word hashes, index of each text's first word) by slices.

    A slice holds whole texts: as many as fit in ``slice_bytes``, and one at least. The
    third array has one entry more than the slice has texts.
    """
    data, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + slice_bytes, "right")) - 1)
        lo = offsets[i]
        cut = offsets[i : j + 1] - lo
        hashes, first, _ = hash_words(data[lo : offsets[j]], fold, cut)
        yield i, hashes, np.searchsorted(first, cut)
        i = j


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; none if there are fewer."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    out = words[: len(words) - k + 1].copy()
    for i in range(1, k):
        out *= _ODD
        out += words[i : len(words) - k + 1 + i]
    return mix(out)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with equal key, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if held and held[-1][key][-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)
