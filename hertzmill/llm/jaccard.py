"""Prefix-tree join: documents whose n-gram sets have a high Jaccard similarity.

1. A fixed-width count table over every n-gram of every text ranks 2^17 hash buckets by
   frequency; renaming buckets by rank makes plain integer order the global order, rare
   n-grams first. The table is a bounded summary whatever the corpus size, and any order
   gives right results: a better one only gives fewer candidates.
2. Each text becomes an ordered set. Equal sets collapse to one representative.
3. Sets that meet the threshold share an n-gram in their prefixes. Representatives that
   share one, whose sizes are compatible and whose parity maps (as many bits as elements)
   do not already prove too large a difference, are joined to clusters (a superset of the answer).
4. In a cluster the ordered sets are stored in a path-compressed trie; each set walks it
   once, sharing the overlap of common paths, and leaves a subtree as soon as overlap so
   far plus what can still come is below what the lengths in it require. Overlaps are
   exact. Only links that join two components are emitted, so output is linear.

Hot tokens and clusters are cut into blocks. Sets are first compared within their block;
of what that joins one set stands for all, and these are compared among each other; only
sets that are then still apart from the largest part of their group meet all its blocks.
So a large group of near copies takes work in proportion to its size, and nothing that
could be a link is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, discard, fresh, likely_in, materialize, runs, shingle_hashes, texts_in_slices

BUCKET_BITS = 17
_LOW = np.uint64(64 - BUCKET_BITS)
_SIGN = np.uint64(1 << 63)
LEAST_MAP_BITS = 512
TOKEN_BLOCK = 2048
CLUSTER_BLOCK = 256
#: Tokens from buckets with more than one in HOT_SHARE of all n-grams, and LEAST_HOT, are counted by partial sums instead of in one window.
HOT_SHARE, LEAST_HOT = 1 << 15, 4096


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes); fewer than n words give the whole sequence as one."""
    for at, words, cut in texts_in_slices(column):
        for k in range(len(cut) - 1):
            own = words[cut[k] : cut[k + 1]]
            if not len(own):
                continue
            s = shingle_hashes(own, min(n, len(own)))
            if len(own) < n:
                s = s ^ np.uint64(len(own))
            s.sort()
            if len(s) > 1:
                s = s[np.r_[True, s[1:] != s[:-1]]]
            yield at + k, s


def need(a: int, b: int, percent: int) -> int:
    """Least overlap of sets of a and b elements whose Jaccard is at least percent/100."""
    return -(-percent * (a + b) // (100 + percent))


def _bucket_counts(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            held, size = [], 0
            for _, s in _sets(batch["text"], n):
                held.append((s >> _LOW).astype(np.int64))
                size += len(s)
                if size > 1 << 16:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=len(total))
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 15):
            part = at[i : i + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["bucket", "n"])

    return task


def bucket_ranks(docs: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """New number of each hash bucket, ascending by frequency, and the first that is hot: at most 2^17 counts reach the driver."""
    rows = docs.select("text").mapInArrow(_bucket_counts(n), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    ranks = np.empty(len(counts), np.uint64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    return ranks, int((counts <= max(LEAST_HOT, counts.sum() // HOT_SHARE)).sum())


def _ordered(s: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    out = (ranks[(s >> _LOW).astype(np.int64)] << _LOW) | (s & np.uint64((1 << int(_LOW)) - 1))
    out.sort()
    return out


def _parity_map(s: np.ndarray) -> bytes:
    """Parity of the elements by hash slot. Two maps differ in at most as many bits as the sets do."""
    bits = max(LEAST_MAP_BITS, 1 << (len(s) - 1).bit_length())
    slot = ((s * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _fold(m: np.ndarray, words: int) -> np.ndarray:
    """The map of the same set with fewer bits."""
    while len(m) > words:
        m = m[: len(m) // 2] ^ m[len(m) // 2 :]
    return m


def _describe(n: int, percent: int, ranks_of):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        for batch in batches:
            rows = batch.num_rows
            size, f1, f2 = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            prefixes: list = [None] * rows
            maps: list = [None] * rows
            for i, s in _sets(batch["text"], n):
                s = _ordered(s, ranks)
                size[i] = len(s)
                mark = xxhash.xxh3_128_digest(s.tobytes())
                f1[i], f2[i] = np.frombuffer(mark, np.int64)
                prefixes[i] = s[: len(s) - -(-percent * len(s) // 100) + 1].view(np.int64)
                maps[i] = _parity_map(s)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(size), pa.array(f1), pa.array(f2), pa.array(prefixes, pa.list_(pa.int64())), pa.array(maps, pa.binary())],
                ["doc_id", "n", "f1", "f2", "prefix", "map"],
            )

    return task


class _Union:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _candidates(percent: int):
    """Runs of one token block: edges between sets that lengths and parity maps let pass."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for run in runs(batches, "key"):
            ids, n, home = run["rep"].to_numpy(), run["n"].to_numpy(), run["home"].to_numpy()
            maps = [np.frombuffer(x, np.uint64) for x in run["map"].to_pylist()]
            width = np.array([len(x) for x in maps])
            step = np.flatnonzero(np.r_[True, width[1:] != width[:-1], True])  # sizes ascend, so widths do
            levels = [(int(a), int(b), np.stack(maps[a:b])) for a, b in zip(step[:-1], step[1:], strict=True)]
            sets = _Union()
            for own, comp in zip(ids.tolist(), run["comp"].to_pylist(), strict=True):
                if comp is not None:
                    sets.join(own, comp)
            for j in range(1, len(ids)):
                i = int(np.searchsorted(n[:j], -(-percent * n[j] // 100)))
                hits: list = []
                for a, b, level in levels:
                    lo, hi = max(a, i), min(b, j)
                    if lo < hi:
                        differ = np.bitwise_count(level[lo - a : hi - a] ^ _fold(maps[j], level.shape[1])).sum(axis=1)
                        both = n[lo:hi] + n[j]
                        hits += (lo + np.flatnonzero(differ <= both - 2 * -(-percent * both // (100 + percent)))).tolist()
                for h in hits:
                    if (home[h] or home[j]) and sets.join(int(ids[h]), int(ids[j])):
                        left.append(int(ids[h]))
                        right.append(int(ids[j]))
            if len(left) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return task


class _Node:
    """A path of a prefix tree: tokens, what follows, the sets that end here, lengths below."""

    __slots__ = ("ends", "least", "most", "next", "path")

    def __init__(self, path: np.ndarray, size: int) -> None:
        self.path, self.next, self.ends, self.least, self.most = path, {}, [], size, size


class PrefixTree:
    """Ordered sets with shared beginnings stored once."""

    def __init__(self, percent: int) -> None:
        self.percent, self.top = percent, _Node(np.empty(0, np.uint64), 1 << 60)
        self.top.most = 0

    def add(self, s: np.ndarray, name: int) -> None:
        node, at, size = self.top, 0, len(s)
        node.least, node.most = min(node.least, size), max(node.most, size)
        while at < size:
            child = node.next.get(int(s[at]))
            if child is None:
                child = node.next[int(s[at])] = _Node(s[at:], size)
                child.ends.append(name)
                return
            k = min(len(child.path), size - at)
            differ = np.flatnonzero(child.path[:k] != s[at : at + k])
            same = int(differ[0]) if len(differ) else k
            if same < len(child.path):
                rest = _Node(child.path[same:], 0)
                rest.next, rest.ends, rest.least, rest.most = child.next, child.ends, child.least, child.most
                child.path, child.next, child.ends = child.path[:same], {int(rest.path[0]): rest}, []
            child.least, child.most = min(child.least, size), max(child.most, size)
            node, at = child, at + same
        node.ends.append(name)

    def near(self, s: np.ndarray, skip) -> Iterator[int]:
        """Names of the stored sets that meet the threshold with s; skip(name) leaves one out."""
        size, percent = len(s), self.percent
        stack = [(child, 0, 0, 0) for child in self.top.next.values()]
        while stack:
            node, shared, at, depth = stack.pop()
            if not node.next and len(node.ends) == 1 and skip(node.ends[0]):
                continue
            if node.most * 100 < percent * size or size * 100 < percent * node.least:
                continue
            wanted = need(size, max(node.least, -(-percent * size // 100)), percent)
            if shared + min(size - at, node.most - depth) < wanted:
                continue
            path = node.path
            found = np.searchsorted(s[at:], path)
            inside = found < size - at
            shared += int((s[at:][found[inside]] == path[inside]).sum())
            at, depth = at + int(np.searchsorted(s[at:], path[-1], "right")), depth + len(path)
            if node.ends and shared >= need(size, depth, percent):
                yield from (x for x in node.ends if not skip(x))
            if node.next and shared + min(size - at, node.most - depth) >= wanted:
                stack.extend((child, shared, at, depth) for child in node.next.values())


def _verified(percent: int):
    """Runs of one cluster block: a spanning forest of the exact links in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "key"):
            ids = run["rep"].to_numpy()
            grams = [np.frombuffer(x, np.uint64) for x in run["grams"].to_pylist()]
            order = sorted(range(len(ids)), key=lambda i: (len(grams[i]), ids[i]))
            tree, sets, out, home = PrefixTree(percent), _Union(), [], run["home"].to_numpy()
            for own, comp in zip(ids.tolist(), run["comp"].to_pylist(), strict=True):
                if comp is not None:
                    sets.join(own, comp)
            for i in sorted(order, key=lambda i: not home[i]):  # sets from other blocks only look up those of this one
                own = int(ids[i])
                for other in tree.near(grams[i], lambda x, own=own: sets.root(x) == sets.root(own)):
                    if sets.join(own, other):
                        out.append((own, other))
                if home[i]:
                    tree.add(grams[i], own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return task


def _grams(n: int, ranks_of):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        for batch in batches:
            out: list = [None] * batch.num_rows
            for i, s in _sets(batch["text"], n):
                out[i] = _ordered(s, ranks).tobytes()
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([part["rep"], part["keys"], part["comp"], pa.array(out[i : i + 512], pa.binary())], ["rep", "keys", "comp", "grams"])

    return task


def _keyed(rows: DataFrame, blocks, everywhere) -> DataFrame:
    """Adds keys, an array of (key, home): the row's own block of its group, or all blocks of it. rows: rep, group, ..."""
    own = F.pmod(F.xxhash64("rep", F.lit(11)), blocks).cast("int")
    every = F.when(everywhere, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    return rows.withColumn("keys", F.transform(every, lambda j: F.struct(F.xxhash64("group", j).alias("key"), (j == own).alias("home"))))


def spanning(members: DataFrame, block: int, compare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (a, b) that join all members of a group that compare() links, directly or by others.

    members: rep, group and size (rows of the group). compare takes rep, keys (an array of
    key and home) and comp (what rep is known to be joined with, or null), and gives edges
    between rows that meet under a key, one of them at home there. Groups of up to
    ``block`` rows are done at once. See the head of the module for the others.
    """
    one = F.ceil(F.col("size") / block).cast("int")
    edges = materialize(compare(_keyed(members, one, F.lit(False)).select("rep", "keys", F.lit(None).cast("long").alias("comp"))), "near")
    large = members.where(F.col("size") > block)
    if large.isEmpty():
        return edges
    for last in (False, True):
        parts = connected_components(edges, "a", "b").withColumnRenamed("node", "rep").withColumnRenamed("component", "comp")
        rows = large.select("rep", "group").join(parts, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        sized = rows.groupBy("group", "comp").agg(F.count("*").alias("n"), F.min("rep").alias("hub"))
        groups = sized.groupBy("group").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n")).where("parts > 1")
        if last:
            # what isn't in the largest part of its group meets all blocks of it
            rows = rows.join(groups, "group").select("rep", "group", "comp", F.ceil(F.col("n") / block).cast("int").alias("blocks"), (F.col("comp") != F.col("main")).alias("apart"))
        else:
            rows = sized.join(groups.select("group", "parts"), "group").select(F.col("hub").alias("rep"), "group", "comp", F.ceil(F.col("parts") / block).cast("int").alias("blocks"), F.lit(True).alias("apart"))
        rows = materialize(_keyed(rows, F.col("blocks"), F.col("apart")).select("rep", "keys", "comp"), "apart")
        if rows.isEmpty():
            break
        edges = materialize(edges.unionByName(compare(rows)), "near")
    return edges


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links.

    Two rows link when their sets of distinct n-word shingles (A-Z lower-cased) have a
    Jaccard similarity of at least percent/100. A text with fewer than n words is one
    shingle of all its words. Null, empty and word-free texts have no shingles and link
    with nothing: their component is their own id. Equal texts share a component through
    the smallest id that any of them carries; rows that repeat a doc_id are each
    returned, and count as one node; a null doc_id gives a null component unless a row
    with an equal set has an id. Only doc_id and text are read. No rows: no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    ranks, first_hot = bucket_ranks(docs, n)
    ranks_of = spark.sparkContext.broadcast(ranks)  # 2^17 numbers: 1 MB
    described = materialize(docs.mapInArrow(_describe(n, percent, ranks_of), "doc_id long, n long, f1 long, f2 long, prefix array<long>, map binary"), "sets")
    groups = materialize(described.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "groups")
    reps = materialize(
        described.where("doc_id is not null and n > 0").join(groups.select("f1", "f2", F.col("rep").alias("doc_id")), ["f1", "f2", "doc_id"], "left_semi").dropDuplicates(["f1", "f2", "doc_id"])
        .select(F.col("doc_id").alias("rep"), "n", "prefix", "map"),
        "reps",
    )
    tokens = reps.select("rep", "n", F.explode("prefix").alias("group"))
    rank = F.shiftrightunsigned("group", 64 - BUCKET_BITS)
    # without a set of compatible size next to it in order of size, a set has none under this token
    group = Window.partitionBy("group")
    below, above = F.lag("n").over(group.orderBy("n", "rep")), F.lead("n").over(group.orderBy("n", "rep"))
    sized = tokens.where(rank < first_hot).withColumn("size", F.count("*").over(group)).withColumn("below", below).withColumn("above", above)
    near = sized.where((F.col("below") * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.col("above") * percent)).select("rep", "group", "size")
    hot = tokens.where(rank >= first_hot)
    counted = hot.groupBy("group").agg(F.count("*").alias("size")).where("size > 1")
    near = materialize(near.unionByName(hot.join(counted, "group").select("rep", "group", "size")), "members")

    def alike(members: DataFrame) -> DataFrame:
        rows = members.select("rep", "comp", F.explode("keys").alias("k")).join(reps.select("rep", "n", "map"), "rep").select("k.key", "k.home", "rep", "comp", "n", "map")
        return rows.repartition("key").sortWithinPartitions("key", "n", "rep").mapInArrow(_candidates(percent), "a long, b long").distinct()

    edges = spanning(near, TOKEN_BLOCK, alike)
    clusters = connected_components(edges, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("group"))
    sizes = clusters.groupBy("group").agg(F.count("*").alias("size"))
    clusters = materialize(clusters.join(sizes, "group"), "clusters")

    def exact(members: DataFrame) -> DataFrame:
        texts = likely_in(docs, "doc_id", members, "rep").withColumnRenamed("doc_id", "rep").join(members, "rep")
        grams = texts.mapInArrow(_grams(n, ranks_of), "rep long, keys array<struct<key:long,home:boolean>>, comp long, grams binary").where("grams is not null")
        rows = grams.select("rep", "comp", F.explode("keys").alias("k"), "grams").select("k.key", "k.home", "rep", "comp", "grams")
        return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_verified(percent), "a long, b long")

    links = spanning(clusters, CLUSTER_BLOCK, exact)
    found = connected_components(links, "a", "b").select(F.col("node").alias("rep"), "component")
    named = groups.join(found, "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    out = described.join(named, ["f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )
    discard(edges)
    return out


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that carry their component's smallest doc_id, all columns as they were.

    A row whose doc_id is null stays unless its set equals that of a row with an id.
    """
    name = fresh(docs, "linked_id")
    linked = jaccard_components(docs, n, percent).where("component_id is not null and not component_id <=> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(linked, docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")
