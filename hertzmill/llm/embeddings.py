"""Near-duplicate vectors by sorted projection passes.

Each pass concatenates the signs of 64 random projections to a key, sorts all vectors by
key, and compares every vector with its neighbours in a window of fixed width. Verified
pairs of all passes are united to components. The number of passes first follows from the
number of vectors; then the pairs that one half of the passes found are looked up in the
components of the other half, and as long as too many are missing there, as in dense
regions, more passes follow. Within a component all vectors are then compared in blocks,
so that links that the windows had no room for (dense groups) are counted too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, numbered, runs

WINDOW = 32
BLOCK = 2048
MEMBERS = 256


def passes_for(n: int, threshold: float, window: int = WINDOW, recall: float = 0.995) -> int:
    """Passes after which a pair at the threshold has met in a window with this probability."""
    bits = max(1.0, math.log2(max(2, n) / window))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return max(8, math.ceil(math.log(1 - recall) / math.log1p(-p)))


def _unit(column: pa.Array) -> np.ndarray:
    x = np.stack([np.frombuffer(b, np.float64) for b in column.to_pylist()])
    # scaled first, so that squares of very large or small components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.asarray(v, np.float64).tobytes() for v in batch["v"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["rep"], batch["copies"], batch["dim"], pa.array(vectors, pa.binary())], ["rep", "copies", "dim", "x"])


def _keys(first: int, passes: int, centre: dict, seed: int = 7):
    """Rows dim, pass, key and rep of the passes from first on; centre: by dimension, what vectors are measured from."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict = {}
        for batch in batches:
            dims, reps = batch["dim"].to_numpy(), batch["rep"].to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = _unit(batch["x"].take(pa.array(at))) - centre[dim]
                for p in range(first, first + passes):
                    if (dim, p) not in planes:
                        planes[dim, p] = np.random.default_rng([seed, dim, p]).standard_normal((dim, 64)).astype(np.float32)
                    keys = np.packbits(x.astype(np.float32) @ planes[dim, p] > 0, axis=1).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim), pa.int32()), pa.array(np.full(n, p), pa.int32()), pa.array(keys.view(np.int64)), pa.array(reps[at])], ["dim", "pass", "key", "rep"])

    return task


class _Forest:
    def __init__(self) -> None:
        self.up: dict = {}
        self.edges: list = []

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[max(ra, rb)] = min(ra, rb)
            self.edges.append((a, b))


def _windows(threshold: float, window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "block"):
            x, reps, forest, pass_no = _unit(run["x"]), run["rep"].to_numpy(), _Forest(), run["pass"][0].as_py()
            for k in range(1, min(window, len(x) - 1) + 1):
                for i in np.flatnonzero(np.einsum("ij,ij->i", x[k:], x[:-k]) >= threshold).tolist():
                    forest.join(int(reps[i]), int(reps[i + k]))
            out = [pa.array([e[0] for e in forest.edges], pa.int64()), pa.array([e[1] for e in forest.edges], pa.int64()), pa.array(np.full(len(forest.edges), pass_no), pa.int32())]
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "pass"])

    return task


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By dimension: number and sum of the unit vectors."""
    total: dict = {}
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            x = _unit(batch["x"].take(pa.array(np.flatnonzero(dims == dim))))
            n, old = total.get(dim, (0, 0.0))
            total[dim] = n + len(x), old + x.sum(axis=0)
    for dim, (n, x) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim), pa.int32()), pa.array(np.arange(dim), pa.int32()), pa.array(np.full(dim, n), pa.int64()), pa.array(x)], ["dim", "at", "n", "x"])


def _centres(vectors: DataFrame) -> dict:
    """Mean unit vector by dimension: so many numbers as all dimensions that occur have together."""
    rows = vectors.mapInArrow(_sums, "dim int, at int, n long, x double").groupBy("dim", "at").agg((F.sum("x") / F.sum("n")).alias("mean")).orderBy("dim", "at").collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r["dim"], []).append(round(r["mean"], 9))
    return {dim: np.array(x) for dim, x in out.items()}


def _found(vectors: DataFrame, first: int, passes: int, centre: dict, threshold: float, window: int) -> DataFrame:
    """a, b and pass of the links that join two trees of a block, of the passes from first on."""
    keys = vectors.mapInArrow(_keys(first, passes, centre), "dim int, pass int, key long, rep long")
    placed = numbered(keys, "place", "dim", "pass", "key", "rep")
    # the last rows of a block also open the next one, so no window is cut
    own, nxt = F.floor(F.col("place") / BLOCK), F.floor((F.col("place") + window) / BLOCK)
    placed = placed.select("dim", "pass", "rep", "key", F.explode(F.array_distinct(F.array(own, nxt))).alias("no"))
    blocks = placed.select(F.xxhash64("dim", "pass", "no").alias("block"), "pass", "key", "rep").join(vectors.select("rep", "x"), "rep").select("block", "pass", "key", "rep", "x")
    return materialize(blocks.repartition("block").sortWithinPartitions("block", "key", "rep").mapInArrow(_windows(threshold, window), "a long, b long, pass int"), "pairs")


def _all_found(vectors: DataFrame, threshold: float, window: int, recall: float) -> DataFrame:
    """Links of as many passes as the recall takes, judged by what either half of them finds."""
    centre, passes = _centres(vectors), passes_for(vectors.count(), threshold, window, recall)
    edges = _found(vectors, 0, passes, centre, threshold, window)
    while True:
        even = connected_components(edges.where("pass % 2 = 0"), "a", "b")
        odd = edges.where("pass % 2 = 1")
        side = even.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        both = odd.join(side, "a", "left").join(side.toDF("b", "cb"), "b", "left")
        n, hit = both.agg(F.count("*"), F.count_if(F.col("ca") == F.col("cb"))).first()
        missed = 1 - hit / n if n else 0.0
        if missed**2 <= 1 - recall:
            return edges
        # a half of the passes misses as much as one pass to the power of their number
        wanted = math.ceil(math.log(1 - recall) / math.log(min(missed, 0.999)) * passes / 2)
        more = min(max(2, wanted - passes), 3 * passes)
        edges = edges.unionByName(_found(vectors, passes, more, centre, threshold, window))
        passes += more


def _count(threshold: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "key"):
            x, copies, block, reps = _unit(run["x"]), run["copies"].to_numpy(), run["block"].to_numpy(), run["rep"].to_numpy()
            first = block == block.min()
            total = np.zeros(len(x), np.int64)
            if first.all():
                for i in range(0, len(x), 256):
                    near = x[i : i + 256] @ x.T >= threshold
                    near[np.arange(len(near)), np.arange(i, i + len(near))] = False
                    total[i : i + 256] = near @ copies
            else:
                near = x[first] @ x[~first].T >= threshold
                total[first], total[~first] = near @ copies[~first], copies[first] @ near
            if run["paired"][0].as_py() and first.all():
                continue
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(total)], ["rep", "linked"])

    return task


def near_duplicates(rows: DataFrame, threshold: float = 0.95, window: int = WINDOW, recall: float = 0.995) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (vec_id, embedding).

    Links join vectors of one length whose cosine, in doubles, is at least threshold.
    n_links counts the other rows linked directly; component_id is the smallest vec_id
    reachable; kept: vec_id is component_id. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. Equal vectors are compared once. A
    null vec_id is counted as a link of others and gets the component of its equals and
    links (null if none of them has an id). Rows that repeat a vec_id are rows of their
    own: each is linked by its own vector. No other column is read. No rows: no rows.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(good, F.col("v"))).withColumn("h", F.when(good, F.sha2(F.array_join(F.transform("v", lambda x: F.hex(F.xxhash64(x))), ""), 256)))
    groups = rows.where("h is not null").groupBy("h").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    # a number for each different vector; written, so it stays
    groups = materialize(groups.select("h", "least", "copies", F.size("v").alias("dim"), "v", F.monotonically_increasing_id().alias("rep")), "vectors")
    vectors = materialize(groups.select("rep", "copies", "dim", "v").mapInArrow(_to_bytes, "rep long, copies long, dim int, x binary"), "bytes")
    edges = _all_found(vectors, threshold, window, recall)
    found = connected_components(edges, "a", "b").withColumnRenamed("node", "rep").join(groups.select("rep", "least"), "rep")
    found = materialize(found.join(found.groupBy("component").agg(F.count("*").alias("size"), F.min("least").alias("least_id")), "component"), "components")
    n = F.ceil(F.col("size") / MEMBERS).cast("int")
    members = found.withColumn("n", n).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("n")).cast("int")).join(vectors, "rep")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.struct(F.xxhash64("component", F.least("block", j), F.greatest("block", j)).alias("key"), (j != F.col("block")).alias("paired"))))
    members = members.select("rep", "copies", "x", "block", pair.alias("pair")).select("pair.key", "pair.paired", "rep", "copies", "x", "block")
    linked = members.repartition("key").sortWithinPartitions("key", "block", "rep").mapInArrow(_count(threshold), "rep long, linked long").groupBy("rep").agg(F.sum("linked").alias("linked"))
    named = groups.select("h", "rep", "copies", "least").join(found.select("rep", "least_id"), "rep", "left").join(linked, "rep", "left")
    named = named.select("h", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("least_id", "least").alias("component_id"), F.lit(True).alias("valid"))
    out = rows.select("vec_id", "h").join(named, "h", "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
