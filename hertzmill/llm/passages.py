"""Substring near-duplicates by compact windows.

A text is its sequence of word shingles. For each of a few hash functions a Cartesian
tree over the hashed shingles groups all subsequences that share their minimum: the node
at position c stands for every [i, j] with left <= i <= c <= j <= right. Only nodes at
least as wide as the least passage are kept, about two for every passage length. Texts
whose windows share a minimum under enough of the functions are candidates; the passages
around the shared positions are then compared shingle by shingle.

A window meets the first window of its value and the first one of each of six kinds of
alike surroundings, so a passage in any number of documents gives a linear number of
pairs. Windows are joined in one sorted shuffle that is read as a stream: by value, but for
values of frequent shingles (a line or passage that many documents have; a count table
over all shingles of all texts tells them beforehand). Windows of these
are dealt by value and surroundings, after each task has paired its own, so that of
windows that are alike only the first of a task's chunk is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, hash_words, likely_in, materialize, mix, runs, shingle_hashes, text_bytes, texts_in_slices

SHINGLE = 5
LEAST_WORDS = 50
HASHES = 4
LEAST_HASHES = 2
#: Shingles to either side of a minimum that are sent along for comparing. What two texts share has a
#: common minimum at least every LEAST_WORDS words, so what is sent around all of them covers passages of any length.
REACH = 160
#: How far aside of its minimum a window's surroundings are looked at.
ASIDE = 20
#: Windows of one value that are paired in memory; those of a value with more are sorted a second time.
MOST_HELD = 1 << 16
_WINDOW = ["value", "doc", "c", "ends", "sides", "rest"]
_MET = ["doc", "src", "a", "b", "sure", "key"]
_POSITION_BITS = 20
_CHUNK = 1 << 19
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64))
_TOP = ~np.uint64((1 << _POSITION_BITS) - 1)
_MOST = np.uint64((1 << 64) - 1)
#: A passage goes on over the shingles that two changed words spoil, or if that makes it unlike, one, or none.
GAPS = (2 * SHINGLE + 1, SHINGLE + 1, 1)
#: Pairs of one source in a task.
MOST_PAIRS = 256
#: Shingles are counted in so many buckets; windows around those of a bucket with more than one of HOT_SHARE of all, and LEAST_HOT, aren't dealt by value.
COUNT_BITS, HOT_SHARE, LEAST_HOT = 17, 1 << 12, 1 << 15
#: In place of ends, rows of frequent values have a mark: dealt by a key (value) with sides telling if it is sure, or paired with sides (source) at rest.
_BY_KEY, _PAIRED, _PAIRED_SURE = -1, -2, -3


def compact_windows(shingles: np.ndarray, width: int, hashes: int = HASHES) -> tuple[np.ndarray, ...]:
    """(hash function, value, c, left, right) of all nodes at least ``width`` wide, inclusive ends.

    A node that wide is the minimum of a window of just that width, so sliding minima find
    the nodes and a stack over these alone gives their bounds: the next smaller value of a
    wide node is itself the minimum of the window that ends with it. Very long texts
    go in chunks that overlap by a width.
    """
    which, centre, left, right, value = [], [], [], [], []
    for base, n, k, keys, h in _minima(shingles, width, hashes):
        at = (keys & ~_TOP).astype(np.int64)
        values, places, m = keys.tolist(), at.tolist(), len(at)
        lefts, rights, stack = [0] * m, [n - 1] * m, []
        for i in range(m):
            v = values[i]
            while stack and values[stack[-1]] > v:
                rights[stack.pop()] = places[i] - 1
            lefts[i] = places[stack[-1]] + 1 if stack else 0
            stack.append(i)
        which.append(np.full(m, k, np.int64))
        centre.append(at + base)
        left.append(np.array(lefts, np.int64) + base)
        right.append(np.array(rights, np.int64) + base)
        value.append(h[at])
    if not which:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    return np.concatenate(which), np.concatenate(value), np.concatenate(centre), np.concatenate(left), np.concatenate(right)


def _minima(shingles: np.ndarray, width: int, hashes: int) -> Iterator[tuple]:
    """(base, length, hash function, minima as hash and place, all hashes) of each chunk and function."""
    step = _CHUNK - width
    for base in range(0, max(1, len(shingles) - width + 1), step):
        s = shingles[base : base + _CHUNK]
        n = len(s)
        if n < width:
            return
        h = mix(s[None, :] ^ _SEEDS[:hashes, None])
        padded = np.full((hashes, -(-n // width) * width), _MOST, np.uint64)
        padded[:, :n] = (h & _TOP) | np.arange(n, dtype=np.uint64)
        blocks = padded.reshape(hashes, -1, width)
        ahead = np.minimum.accumulate(blocks, axis=2).reshape(hashes, -1)
        back = np.minimum.accumulate(blocks[:, :, ::-1], axis=2)[:, :, ::-1].reshape(hashes, -1)
        low = np.minimum(back[:, : n - width + 1], ahead[:, width - 1 : n])
        for k in range(hashes):
            yield base, n, k, low[k][np.r_[True, low[k][1:] != low[k][:-1]]], h[k]


def _counts(width: int):
    """Shingles by bucket, of all texts of a task that are long enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(1 << COUNT_BITS, np.int64), [], 0
        for batch in batches:
            for _, words, cut in texts_in_slices(batch["text"]):
                for j in range(len(cut) - 1):
                    if cut[j + 1] - cut[j] < width + SHINGLE - 1:
                        continue
                    held.append((shingle_hashes(words[cut[j] : cut[j + 1]], SHINGLE) >> np.uint64(64 - COUNT_BITS)).astype(np.int64))
                    size += len(held[-1])
                    if size > 1 << 17:
                        total += np.bincount(np.concatenate(held), minlength=len(total))
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return task


def _hot_buckets(docs: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Whether each bucket holds more shingles than the limit, so that windows around them mustn't be dealt by value, and that limit.

    The driver gets 2^17 counts at most.
    """
    rows = docs.select("text").mapInArrow(_counts(width), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << COUNT_BITS, np.int64)
    total[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    limit = max(LEAST_HOT, int(total.sum()) // HOT_SHARE)
    return total > limit, limit


def _pack_rows(held: list) -> pa.RecordBatch:
    """Rows of a chunk; windows of frequent shingles are paired here as far as they meet, what is left is dealt by key."""
    *columns, frequent = [np.concatenate(x) for x in zip(*held, strict=True)]
    if frequent.any():
        doc, place, sure, key = _with_keys(*[x[frequent] for x in columns])
        order = np.lexsort((place, doc, key))
        doc, place, sure, key = (x[order] for x in (doc, place, sure, key))
        start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
        src, b, met = doc[start], place[start], doc != doc[start]
        own = ~met
        cold = [x[~frequent] for x in columns]
        marks = np.where(sure[met], _PAIRED_SURE, _PAIRED)
        spread = mix(doc[met].view(np.uint64) ^ np.uint64(77)).view(np.int64)
        paired = [spread, doc[met], place[met], marks, src[met], b[met]]
        keyed = [key[own], doc[own], place[own], np.full(int(own.sum()), _BY_KEY), sure[own].astype(np.int64), np.zeros(int(own.sum()), np.int64)]
        columns = [np.concatenate(x) for x in zip(cold, paired, keyed, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], _WINDOW)


def _windows(width: int, hashes: int, hot: np.ndarray):
    """Rows value, doc, c, ends, sides and rest of all compact windows.

    ends packs the hash function (4 bits), the reach to the right and left (8 each), and 16
    bits each of the shingles a little before and after, which tell alike surroundings.
    sides and rest hold hashes of all shingles over two thirds of a passage before, around
    (32 bits each) and after the minimum (32), and over one third before and after (16
    each); 0 where the window ends before that. Wherever the minimum stands in a passage,
    one of the first three lies inside.
    """
    third = width // 3

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            held: list = []
            rows = 0
            for at, words, cut in texts_in_slices(batch["text"]):
                for j in range(len(cut) - 1):
                    if cut[j + 1] - cut[j] < width + SHINGLE - 1:
                        continue
                    s = shingle_hashes(words[cut[j] : cut[j + 1]], SHINGLE)
                    k, value, c, left, right = compact_windows(s, width, hashes)
                    near = [(s[np.clip(c + d, 0, len(s) - 1)] & np.uint64(0xFFFF)).astype(np.int64) for d in (-ASIDE, ASIDE)]
                    ends = (near[1] << 36) | (near[0] << 20) | (np.minimum(c - left, REACH) << 12) | (np.minimum(right - c, REACH) << 4) | k
                    sums = np.zeros(len(s) + 1, np.uint64)
                    np.cumsum(mix(s), out=sums[1:])

                    def over(before: int, after: int, bits: int) -> np.ndarray:
                        inside = (c - before >= left) & (c + after <= right)  # noqa: B023
                        own = sums[np.minimum(c + after + 1, len(s))] - sums[np.maximum(c - before, 0)]  # noqa: B023
                        return np.where(inside, np.maximum(mix(own) >> np.uint64(64 - bits), np.uint64(1)), np.uint64(0))

                    sides = over(2 * third, 0, 32) | over(third, third, 32) << np.uint64(32)
                    rest = over(0, 2 * third, 32) | over(third, 0, 16) << np.uint64(32) | over(0, third, 16) << np.uint64(48)
                    held.append(((value ^ (k.astype(np.uint64) << np.uint64(60))).view(np.int64), np.full(len(c), ids[at + j]), c, ends, sides.view(np.int64), rest.view(np.int64), hot[(s[c] >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]))
                    rows += len(c)
                if rows > 20_000:
                    yield _pack_rows(held)
                    held, rows = [], 0
            if held:
                yield _pack_rows(held)

    return task


_ENDS = (1 << 20) - 1


def _contexts(value: np.ndarray, ends: np.ndarray, sides: np.ndarray, rest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, keys, whether sharing a key is enough) for each kind of surroundings; rows whose window doesn't reach that far are left out."""
    low, high = sides.view(np.uint64) & np.uint64(0xFFFFFFFF), sides.view(np.uint64) >> np.uint64(32)
    back = rest.view(np.uint64)
    kinds = [(low, True), (high, True), (back & np.uint64(0xFFFFFFFF), True), (back >> np.uint64(32) & np.uint64(0xFFFF), False), (back >> np.uint64(48), False)]
    base = mix(mix(value.view(np.uint64)))
    yield np.arange(len(value)), base ^ mix((ends >> 20).view(np.uint64)), False
    for no, (x, sure) in enumerate(kinds, 1):
        at = np.flatnonzero(x)
        yield at, base[at] ^ mix(x[at] ^ np.uint64(no << 40)), sure


def _first(keys: np.ndarray) -> np.ndarray:
    """Index of the first row of equal key, for every row."""
    _, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return index[inverse]


def _pairs_of(value: np.ndarray, doc: np.ndarray, c: np.ndarray, ends: np.ndarray, sides: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
    """doc, src, a, b, sure and key (null here) of windows whose values are all complete."""
    n = len(value)
    new = np.r_[True, value[1:] != value[:-1]] if n else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = np.diff(np.r_[np.flatnonzero(new), n])
    many = np.flatnonzero(np.repeat(size, size) > 2)
    codes: dict = {True: [], False: [np.arange(n) * n + start]}
    for at, keys, sure in _contexts(value, ends, sides, rest) if n else ():
        use = at if sure else many if len(at) == n else np.intersect1d(at, many, assume_unique=True)
        kept = keys if sure else keys[np.searchsorted(at, use)]
        codes[sure].append(use * n + use[_first(kept)])
    both = np.concatenate([*codes[True], *codes[False]])
    both, index = np.unique(both, return_index=True)
    i, j = np.divmod(both, max(n, 1))
    place = (c << 20) | (ends & _ENDS)
    other = doc[i] != doc[j]
    i, j, index = i[other], j[other], index[other]
    return [doc[i], doc[j], place[i], place[j], index < sum(map(len, codes[True]))]


def _with_keys(value: np.ndarray, doc: np.ndarray, c: np.ndarray, ends: np.ndarray, sides: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """doc, place, sure and key: each window once for its value and once for each kind of its surroundings."""
    place, all_of = (c << 20) | (ends & _ENDS), np.arange(len(value))
    kinds = [(all_of, mix(~value.view(np.uint64)), False), *_contexts(value, ends, sides, rest)]
    at, key = np.concatenate([x[0] for x in kinds]), np.concatenate([x[1] for x in kinds]).view(np.int64)
    return doc[at], place[at], np.repeat([x[2] for x in kinds], [len(x[0]) for x in kinds]), key


def _meet(most: int = MOST_HELD):
    """Sorted windows -> pairs of each with the first window of its value, and with the first of each kind of alike surroundings.

    a and b are the places in doc and src: c, and the ends in the low 20 bits; sure: they
    are alike over a third of a passage to either or two thirds to one side. Windows of a
    value that has more than ``most`` are given with their keys instead, one row each, for
    a second sort.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        rows, hot, carried = 0, None, None

        def keyed(*columns: np.ndarray) -> pa.RecordBatch:
            doc, place, sure, key = _with_keys(*columns)
            none = pa.nulls(len(doc), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(doc), none, pa.array(place), none, pa.array(sure), pa.array(key)], _MET)

        def frequent(key: np.ndarray, doc: np.ndarray, a: np.ndarray, mark: np.ndarray, sides: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
            """Pairs that tasks have made as they are, and rows dealt by key with the first of their key."""
            nonlocal carried
            by_key = np.flatnonzero(mark == _BY_KEY)
            src, b, sure = sides.copy(), rest.copy(), mark == _PAIRED_SURE
            if len(by_key):
                own = key[by_key]
                start = by_key[np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]], np.arange(len(own)), 0))]
                src[by_key], b[by_key], sure[by_key] = doc[start], a[start], sides[by_key] == 1
                if carried and own[0] == carried[0]:
                    again = by_key[own == own[0]]
                    src[again], b[again] = carried[1:]
                carried = (own[-1], src[by_key[-1]], b[by_key[-1]])
            other = np.flatnonzero(src != doc)
            return pa.RecordBatch.from_arrays([*[pa.array(x[other]) for x in (doc, src, a, b, sure)], pa.nulls(len(other), pa.int64())], _MET)

        def paired(columns: list) -> pa.RecordBatch:
            out = _pairs_of(*columns)
            return pa.RecordBatch.from_arrays([*[pa.array(x) for x in out], pa.nulls(len(out[0]), pa.int64())], _MET)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch[x].to_numpy(zero_copy_only=False) for x in _WINDOW]
            marked = now[3] < 0
            if marked.any():
                yield frequent(*[x[marked] for x in now])
                now = [x[~marked] for x in now]
                if not len(now[0]):
                    continue
            if hot is not None:
                cut = int(np.searchsorted(now[0], hot, "right"))
                if cut:
                    yield keyed(*[x[:cut] for x in now])
                    now = [x[cut:] for x in now]
                    if not len(now[0]):
                        continue
                hot = None
            if held and held[0][0][-1] == now[0][-1]:
                held.append(now)  # one value only, so far
            else:
                last = int(np.searchsorted(now[0], now[0][-1]))
                yield paired([np.concatenate(x) for x in zip(*held, [x[:last] for x in now], strict=True)])
                held, rows = [[x[last:] for x in now]], 0
            rows += len(held[-1][0])
            if rows > most:
                hot = held[0][0][-1]
                for x in held:
                    yield keyed(*x)
                held, rows = [], 0
        if held:
            yield paired([np.concatenate(x) for x in zip(*held, strict=True)])

    return task


def _meet_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs as they are; rows with keys, sorted by key, doc and place -> pairs with the first of their key."""
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        done = pa.compute.is_valid(batch["src"])
        yield batch.filter(done).select(_MET[:5])
        rest = batch.filter(pa.compute.invert(done))
        if not rest.num_rows:
            continue
        key, doc, place = (rest[x].to_numpy(zero_copy_only=False) for x in ("key", "doc", "a"))
        start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
        src, b = doc[start], place[start]
        if carried and key[0] == carried[0]:
            src[start == 0], b[start == 0] = carried[1:]
        carried = (key[-1], src[-1], b[-1])
        other = np.flatnonzero(src != doc)
        yield pa.RecordBatch.from_arrays([pa.array(doc[other]), pa.array(src[other]), pa.array(place[other]), pa.array(b[other]), rest["sure"].take(pa.array(other))], _MET[:5])


def _spans(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c, first and last shingle of packed places."""
    c = place >> 20
    return c, c - ((place >> 12) & 0xFF), c + ((place >> 4) & 0xFF)


def _shingles_of(text: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(text)
    return shingle_hashes(hash_words(data[offsets[0] : offsets[1]])[0], SHINGLE).astype(np.uint32)


def _anchors(part: pa.Table) -> Iterator[np.ndarray]:
    """Places (a, b) of each row, by place in doc."""
    for chunk in part["anchors"].chunks:
        flat, offsets = chunk.flatten(), chunk.offsets.to_numpy()
        both = np.stack([flat.field("a").to_numpy(), flat.field("b").to_numpy()], axis=1) if len(flat) else np.empty((0, 2), np.int64)
        for x, y in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0], strict=True):
            own = both[x:y]
            yield own[np.argsort(own[:, 0], kind="stable")]


def _cuts(part: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The source's shingles of each row, one cut after the other, and the place of each in the source."""
    for starts, cuts in zip(part["starts"].chunks, part["cuts"].chunks, strict=True):
        first, flat, rows = starts.flatten().to_numpy(), cuts.flatten(), cuts.offsets.to_numpy()
        _, ends, data = flat.buffers()
        ends = np.frombuffer(ends, np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64) // 4 if len(flat) else np.zeros(1, np.int64)
        whole = np.frombuffer(data, np.uint32, ends[-1]) if ends[-1] else np.empty(0, np.uint32)
        place = np.repeat(first - ends[:-1], np.diff(ends)) + np.arange(ends[0], ends[-1])
        for x, y in zip(ends[rows[:-1] - rows[0]].tolist(), ends[rows[1:] - rows[0]].tolist(), strict=True):
            yield whole[x:y], place[x - ends[0] : y - ends[0]]


def _texts(run: pa.Table) -> list[str]:
    """Distinct texts of a run; rows that repeat an id may have several."""
    return pa.compute.unique(run["text"].drop_null()).to_pylist()


def _cut_sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per source: its texts, then pairs. Adds to each pair the source's shingles around the shared places, once for each of its texts."""
    for run in runs(batches, "key"):
        pairs = run.filter(pa.compute.is_valid(run["doc"]))
        if not len(pairs):
            continue
        for text in _texts(run):
            s = _shingles_of(pa.array([text]))
            for at in range(0, len(pairs), 500):
                part = pairs.slice(at, 500)
                starts, cuts = [], []
                for own in _anchors(part):
                    _, lo, hi = _spans(np.sort(own[:, 1]))
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    new = np.r_[True, lo[1:] > hi[:-1] + 1]
                    begin, end = lo[new], hi[np.r_[new[1:], True]]
                    starts.append(begin)
                    cuts.append([s[x : y + 1].tobytes() for x, y in zip(begin.tolist(), end.tolist(), strict=True)])
                yield _with_cuts(part["doc"].to_pylist(), part["src"].to_pylist(), part["anchors"], starts, cuts)


def _with_cuts(docs: list, srcs: list, anchors: pa.ChunkedArray, starts: list, cuts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(srcs, pa.int64()), anchors.slice(0, len(docs)).combine_chunks(), pa.array(starts, pa.list_(pa.int64())), pa.array(cuts, pa.list_(pa.binary()))],
        ["doc", "src", "anchors", "starts", "cuts"],
    )


def _distinct(x: np.ndarray) -> int:
    """How many different values there are; sorting is quicker than np.unique for a few hundred."""
    x = np.sort(x)
    return int(np.count_nonzero(x[1:] != x[:-1])) + (len(x) > 0)


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Places of x whose values are in a sorted array."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x)


def _similarity(m: np.ndarray, s: np.ndarray) -> float:
    """Jaccard similarity of two sequences as sets."""
    if len(m) == len(s) and (m == s).all():
        return 1.0
    either = _distinct(np.concatenate([m, s]))
    return (_distinct(m) + _distinct(s) - either) / either


def _stretches(at: np.ndarray, places: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits at ascending places, parted where places jump by more than gap: label of each hit, first and last index by label."""
    apart = places[1:] - places[:-1] > gap
    label = np.zeros(len(at), np.int64)
    np.cumsum(apart, out=label[1:])
    cuts = np.flatnonzero(apart)
    return label, at[np.concatenate([[0], cuts + 1])], at[np.concatenate([cuts, [len(at) - 1]])]


def _verify(m: np.ndarray, ordered: np.ndarray, c: np.ndarray, s: np.ndarray, place: np.ndarray, i: np.ndarray, width: int, percent: int) -> list[tuple]:
    """Pairs of stretches that hold a shared shingle and are long and similar enough.

    m, s: shingles of both texts; ordered: m, sorted; place: where each of s stands in its text;
    c, i: the shared shingles' indexes in m and s. A stretch is a run of shingles that the other
    side has too, over gaps of a few. Gives (first, last) in m, in the source, similarity.
    """
    if not len(c):
        return []
    at_m, at_s = _among(m, np.sort(s)), _among(s, ordered)
    out = []
    for gap in GAPS:
        if not len(c):
            break
        of_m, first_m, last_m = _stretches(at_m, at_m, gap)
        of_s, first_s, last_s = _stretches(at_s, place[at_s], gap)
        x, y = of_m[np.searchsorted(at_m, c)], of_s[np.searchsorted(at_s, i)]
        both = x * len(first_s) + y
        settled = np.zeros(len(c), bool)
        for pair in sorted(set(both.tolist())):
            k, j = divmod(pair, len(first_s))
            a, b, p, q = int(first_m[k]), int(last_m[k]), int(first_s[j]), int(last_s[j])
            if min(b - a, q - p) + 1 < width:
                continue
            share = _similarity(m[a : b + 1], s[p : q + 1])
            if 100 * share >= percent:
                out.append((a, b, int(place[p]), int(place[q]), share))
                settled |= both == pair
        c, i = c[~settled], i[~settled]
    return out + _verify_near(m, at_m, c, s, place, at_s, i, width, percent) if len(c) else out


def _verify_near(m: np.ndarray, at_m: np.ndarray, c: np.ndarray, s: np.ndarray, place: np.ndarray, at_s: np.ndarray, i: np.ndarray, width: int, percent: int) -> list[tuple]:
    """Passages around shared shingles in long stretches that are too unlike as a whole.

    One shared shingle is looked at for each half passage of m and each diagonal (how far
    the source's place is off). First all that lies within a passage's length of it; if
    that is too unlike, windows of a passage's length along the diagonal, every sixth of
    it, of which the first that is alike grows on while it stays so.
    """
    of_m, first_m, last_m = _stretches(at_m, at_m, GAPS[0])
    of_s, first_s, last_s = _stretches(at_s, place[at_s], GAPS[0])
    x, y = of_m[np.searchsorted(at_m, c)], of_s[np.searchsorted(at_s, i)]
    long = np.flatnonzero((last_m[x] - first_m[x] + 1 >= width) & (last_s[y] - first_s[y] + 1 >= width))
    off, half = (place[i[long]] - c[long]) // (2 * SHINGLE), c[long] // (width // 2)
    order = np.lexsort((half, off))
    off, half = off[order], half[order]
    one = order[np.concatenate([[True], (off[1:] != off[:-1]) | (half[1:] != half[:-1])])[: len(order)]]
    shared = np.zeros(len(m) + 1, np.int64)
    shared[at_m + 1] = 1
    shared = np.cumsum(shared)
    least = 2 * percent * width / (100 + percent)  # so many of its shingles an alike window shares, if they all differ
    out, done, on = [], -1, None
    for k in long[one].tolist():  # by diagonal, then by place
        diagonal = int(place[i[k]] - c[k]) // (2 * SHINGLE)
        if diagonal == on and c[k] <= done:
            continue
        done, on = -1, diagonal
        ends = []
        for hits, at, lo, hi in ((at_m, c[k], first_m[x[k]], last_m[x[k]]), (at_s, i[k], first_s[y[k]], last_s[y[k]])):
            near = hits[np.searchsorted(hits, max(lo, at - width)) : np.searchsorted(hits, min(hi, at + width), "right")]
            ends += [int(near[0]), int(near[-1])]
        a, b, p, q = ends
        if min(b - a, q - p) + 1 >= width and 100 * (share := _similarity(m[a : b + 1], s[p : q + 1])) >= percent:
            out.append((a, b, int(place[p]), int(place[q]), share))
            continue
        for back in range(width - 1, -1, -max(1, width // 6)):
            a, p, n = int(c[k]) - back, int(i[k]) - back, width
            if a < 0 or p < 0 or a + n > len(m) or shared[a + n] - shared[a] < least and _distinct(m[a : a + n]) == n:
                continue
            found = 0.0
            while a + n <= len(m) and p + n <= len(s) and place[p + n - 1] - place[p] == n - 1 and 100 * (share := _similarity(m[a : a + n], s[p : p + n])) >= percent:
                found, n = share, n + SHINGLE
            if found:
                n -= SHINGLE
                out.append((a, a + n - 1, int(place[p]), int(place[p + n - 1]), found))
                done = a + n - 1
                break
    return out


def _verified(width: int, percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "end", "match_doc_id", "match_start", "match_end", "similarity"]
        for run in runs(batches, "key"):
            pairs, out = run.filter(pa.compute.is_valid(run["src"])), []
            texts = _texts(run)
            if not len(pairs):
                continue
            doc = pairs["doc"][0].as_py()
            sources = list(zip(pairs["src"].to_pylist(), _anchors(pairs), _cuts(pairs), strict=True))
            for text in texts:
                whole = _shingles_of(pa.array([text]))
                ordered = np.sort(whole)
                for src, own, (s, place) in sources:
                    c, sc = own[:, 0] >> 20, own[:, 1] >> 20
                    i = np.minimum(np.searchsorted(place, sc), len(place) - 1)
                    good = (c < len(whole)) & (len(place) > 0)
                    c, i, sc = c[good], i[good], sc[good]
                    good = (place[i] == sc) & (whole[c] == s[i])  # rows that repeat an id may have another text
                    for a, b, p, q, share in _verify(whole, ordered, c[good], s, place, i[good], width, percent):
                        out.append((doc, a, b + SHINGLE, src, p, q + SHINGLE, share))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.float64())], names)

    return task


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, percent: int = 80, hashes: int = HASHES, least_hashes: int = LEAST_HASHES) -> DataFrame:
    """doc_id, start, end, match_doc_id, match_start, match_end, similarity of repeated passages.

    Words start to end (excluded; A-Z lower-cased) of doc_id repeat words of
    match_doc_id, a smaller id: at least ``least_words`` words whose five-word shingles
    have a Jaccard similarity of percent/100 or more. A passage in many documents is
    matched with an early one of them, and with one that is like it further around, so that
    every document but the first appears. Texts that are null or shorter give
    nothing, nor do rows with a null doc_id. Of rows that repeat a doc_id every text is
    looked at; places are those in the text where the passage was found, and rows of one
    id aren't compared with each other. No other column is read. No rows: no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    width = least_words - SHINGLE + 1
    hot, limit = _hot_buckets(docs, width)
    windows = docs.mapInArrow(_windows(width, hashes, hot), ", ".join(f"{x} long" for x in _WINDOW))
    met = windows.repartition("value").sortWithinPartitions("value", "doc", "c").mapInArrow(_meet(), "doc long, src long, a long, b long, sure boolean, key long")
    if limit > MOST_HELD:  # else no value dealt as such has so many windows: a shingle gives one a function at most
        met = met.sortWithinPartitions("key", "doc", "a").mapInArrow(_meet_sorted, "doc long, src long, a long, b long, sure boolean")
    # a word of a passage lies in windows of several functions: enough of them must agree on the pair, or most of a passage around one
    anchors = met.groupBy("doc", "src").agg(F.collect_list(F.struct("a", "b")).alias("anchors"), F.max("sure").alias("sure"))
    enough = F.size(F.array_distinct(F.transform("anchors", lambda x: x["a"].bitwiseAND(15)))) >= least_hashes
    pairs = materialize(anchors.where(enough | F.col("sure")).drop("sure"), "passage_pairs", free=True)
    # a source of many pairs is dealt to several keys, each with a copy of its text; such sources are few
    sources = materialize(pairs.groupBy("src").agg(F.ceil(F.count("*") / MOST_PAIRS).cast("int").alias("deals")), "sources", free=True)
    hot = sources.where("deals > 1")
    keyed = pairs.join(hot, "src", "left").select(F.xxhash64("src", F.pmod(F.xxhash64("doc", F.lit(17)), F.coalesce("deals", F.lit(1)))).alias("key"), "doc", "src", "anchors")
    texts = likely_in(docs, "doc_id", sources, "src").withColumnRenamed("doc_id", "src").join(hot, "src", "left")
    texts = texts.select(F.explode(F.transform(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1), lambda i: F.xxhash64("src", i.cast("long")))).alias("key"), "src", "text")
    both = keyed.withColumn("text", F.lit(None).cast("string")).unionByName(texts, allowMissingColumns=True)
    cut = both.repartition("key").sortWithinPartitions("key").mapInArrow(
        _cut_sources, "doc long, src long, anchors array<struct<a:long,b:long>>, starts array<long>, cuts array<binary>"
    )
    members = materialize(pairs.select("doc").distinct(), "members", free=True)
    texts = likely_in(docs, "doc_id", members, "doc").select(F.col("doc_id").alias("key"), "text")
    both = cut.withColumn("key", F.col("doc")).withColumn("text", F.lit(None).cast("string")).unionByName(texts, allowMissingColumns=True)
    return both.repartition("key").sortWithinPartitions("key").mapInArrow(
        _verified(width, percent), "doc_id long, start long, end long, match_doc_id long, match_start long, match_end long, similarity double"
    )


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs without the words that repeat an earlier document; n_chars follows.

    All columns and rows stay, but rows of which nothing is left. Rows without a passage
    are as they were, nulls included. Rows that repeat a doc_id are all cut, by word position.
    """
    cut_id, cuts = fresh(docs, "cut_id"), fresh(docs, "cuts")
    spans = passages.groupBy(F.col("doc_id").alias(cut_id)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts))
    joined = docs.join(spans, docs["doc_id"] == F.col(cut_id), "left").drop(cut_id)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans_of = batch["text"].to_pylist(), batch[cuts].to_pylist()
            keep = np.ones(len(texts), bool)
            for i, spans_here in enumerate(spans_of):
                if not spans_here or texts[i] is None:
                    continue
                raw = texts[i].encode()
                _, first, last = hash_words(np.frombuffer(raw, np.uint8))
                out, at = [], 0
                for span in spans_here:
                    if span["start"] < len(first):
                        begin = max(at, int(first[span["start"]]))
                        out.append(raw[at:begin])
                        at = max(at, int(last[min(span["end"], len(last)) - 1]))
                out.append(raw[at:])
                texts[i] = b"".join(out).decode()
                keep[i] = bool(texts[i].strip())
            columns = {n: batch[n] for n in batch.schema.names if n != cuts} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                lengths = [None if x is None else len(x) for x in texts]
                old = batch["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([n if s else o for n, s, o in zip(lengths, spans_of, old, strict=True)], pa.int64())
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(keep))

    return joined.mapInArrow(task, docs.schema)
