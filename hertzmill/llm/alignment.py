"""Alignment of two tokenizers by coalescing byte intervals.

The tokens of both over the same bytes are sorted by start; where a start reaches the
running maximum of the ends, a group begins: there both tokenizers have an edge. Inside
groups overlaps are expanded to pairs, and pairs that end together are the links.

Documents are read once, in blocks of a few megabytes. A block lists its different id
pairs once and each document only names places in that list, so that counts over the
corpus meet blocks instead of tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Bytes of text that are aligned at once, and bytes of a block; a longer text is cut where both tokenizers have an edge.
AT_ONCE = 1 << 20
BLOCK = 1 << 23
#: Words remembered before a reader begins anew; those of the round before are still looked up.
REMEMBERED = 1 << 17
#: An edge of both: no token of either joins a letter or digit with a space after it.
_CUT = re.compile(r"(?<=[^\W_]) ")
_PART = re.compile(r"[ \n\t]*[^ \n\t]+|[ \n\t]+")
_OTHER_SPACE = re.compile(r"[^\S \n\t]")
_readers: dict = {}


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 ones themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


#: How a byte-level tokenizer parts a text before merging (fixed value: the pattern that the libraries have built in).
PARTING = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Ids by a byte-level tokenizers file, strings of special tokens being plain text.

    Where the file is a plain one whose ids follow its merges, ASCII texts, on whose
    characters all versions of Unicode agree, are encoded by tiktoken from the same vocabulary.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core's work
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        own = _byte_of_char()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        special = {x["id"] for x in told.get("added_tokens") or []}
        vocabulary = self.model.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes[i] = piece.encode() if i in special else bytes(own[c] for c in piece)
        merges = ["".join(x.split(" ") if isinstance(x, str) else x) for x in told["model"].get("merges") or []]
        first = told.get("pre_tokenizer") or {}
        plain = not told.get("normalizer") and first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True)
        plain = plain and not told["model"].get("ignore_merges") and [vocabulary.get(x) for x in merges] == list(range(256, 256 + len(merges))) and special.isdisjoint(range(256 + len(merges)))
        self.fast = tiktoken.Encoding("own", pat_str=PARTING, mergeable_ranks={x: i for i, x in enumerate(self.bytes) if i not in special}, special_tokens={}).encode_ordinary if plain else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [self.fast(x) if self.fast and x.isascii() else None for x in texts]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.model.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False) if rest else [], strict=True):
            out[k] = x.ids
        return out


class Pieces:
    """Ids by a sentencepiece file that puts a space before the text.

    parted: no piece goes on with white space after another character, so that a text is the
    sequence of its words with the white space before them.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.space = self.model.piece_to_id("▁")
        self.parted = not any(re.search("[^▁]▁|[ \n\t]", x) for x in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with white space. The model's own space stands for a first one; else it is left out, as nothing joins it."""
        found = self.model.encode([x[1:] if x[0] == " " else x for x in texts], num_threads=1)
        return [(i or [self.space]) if x[0] == " " else i[1:] for x, i in zip(texts, found, strict=True)]


class Reader:
    """Alignment of texts by both tokenizers.

    At white space after another character both have an edge, so a text is aligned word by
    word, each with the white space before it, and words are remembered: (n_a, n_b, n_groups,
    the groups as text, the links' id pairs), or None if either tokenizer doesn't spell the
    word byte for byte. Texts with rarer white space are one word.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.length = [np.array([len(x) for x in m.bytes], np.int64) for m in (self.a, self.b)]
        self.inner = [np.array([f"{i}," for i in range(len(m.bytes))], object) for m in (self.a, self.b)]
        self.last = [np.array([f"{i}{end}" for i in range(len(m.bytes))], object) for m, end in ((self.a, "|"), (self.b, ";"))]
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _align(self, parts: list[str]) -> Iterator[tuple | None]:
        """Records of words, all of them coalesced at once."""
        ids = [m.encode(parts) for m in (self.a, self.b)]
        spelt = [[b"".join([m.bytes[i] for i in x]) for x in own] for m, own in zip((self.a, self.b), ids, strict=True)]
        good = [x == y == part.encode() for part, x, y in zip(parts, *spelt, strict=True)]
        ids = [[x for x, fine in zip(own, good, strict=True) if fine] for own in ids]
        tokens = [np.fromiter(chain.from_iterable(own), np.int64) for own in ids]
        if not len(tokens[0]):
            yield from [None] * len(parts)
            return
        cut_a, cut_b = (np.cumsum([0, *map(len, own)]) for own in ids)
        ends_a, ends_b = (np.cumsum(n[x]) for n, x in zip(self.length, tokens, strict=True))
        order, begins, i, j = coalesce(ends_a, ends_b)
        shown = _shown(self, tokens, order, np.cumsum(begins) - 1)
        n_groups = np.add.reduceat(begins, (cut_a + cut_b)[:-1], dtype=np.int64).tolist()
        together = ends_a[i] == ends_b[j]
        pairs = ((tokens[1][j[together]] << 32) | tokens[0][i[together]]).astype("<i8").tobytes()
        linked = (8 * np.searchsorted(i[together], cut_a)).tolist()
        cut_a, cut_b = cut_a.tolist(), cut_b.tolist()
        k = 0
        for fine in good:
            if not fine:
                yield None
                continue
            yield cut_a[k + 1] - cut_a[k], cut_b[k + 1] - cut_b[k], n_groups[k], "".join(shown[cut_a[k] + cut_b[k] : cut_a[k + 1] + cut_b[k + 1]]), pairs[linked[k] : linked[k + 1]]
            k += 1

    def words(self, text: str) -> list[tuple | None]:
        """Records of the words of a text that begins with a space."""
        if not self.b.parted or _OTHER_SPACE.search(text):
            return list(self._align([text]))
        parts, known = _PART.findall(text), self.known
        here = {x: self.older[x] if x in self.older else None for x in set(parts).difference(known)}
        new = [x for x in here if x not in self.older]
        here.update(zip(new, self._align(new), strict=True))
        found = [here[x] if x in here else known[x] for x in parts] if here else list(map(known.__getitem__, parts))
        known.update((x, i) for x, i in here.items() if len(x) <= 64)
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return found


def reader(path_a: str, path_b: str) -> Reader:
    if (path_a, path_b) not in _readers:
        _readers[path_a, path_b] = Reader(path_a, path_b)
    return _readers[path_a, path_b]


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and overlaps of two tilings of the same bytes, given by the ends of their intervals.

    Order (all intervals by start, A before B), whether each in that order begins a group,
    and the pairs (place in A, place in B) that overlap.
    """
    start_a, start_b = (np.concatenate(([0], e[:-1])) for e in (ends_a, ends_b))
    starts, ends = np.concatenate((start_a, start_b)), np.concatenate((ends_a, ends_b))
    side = np.repeat(np.array([0, 1], np.int8), [len(ends_a), len(ends_b)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    begins = np.ones(len(order), bool)
    begins[1:] = starts[order][1:] >= reached[:-1]
    first = np.searchsorted(ends_b, start_a, "right")
    many = np.searchsorted(start_b, ends_a, "left") - first
    a = np.repeat(np.arange(len(ends_a)), many)
    b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return order, begins, a, b


def _stretches(text: str) -> Iterator[str]:
    """The text with a space before it, in stretches that begin with a space and end at an edge of both tokenizers."""
    text, lo = " " + text, 0
    while len(text) - lo > AT_ONCE:
        cut = _CUT.search(text, lo + AT_ONCE)
        if not cut:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:]


def _shown(tools: "Reader", tokens: list[np.ndarray], order: np.ndarray, group: np.ndarray) -> list[str]:
    """Decimal ids in order of group, A before B in each, with what follows each: a comma, a bar or a semicolon."""
    n_a = len(tokens[0])
    of = np.empty(len(order), np.int64)
    of[order] = group  # the group of each token of A, then of B
    text = np.concatenate([tools.inner[0][tokens[0]], tools.inner[1][tokens[1]]])
    for side, part in ((0, slice(0, n_a)), (1, slice(n_a, None))):
        ends = np.append(np.flatnonzero(np.diff(of[part])), len(of[part]) - 1)
        text[part][ends] = tools.last[side][tokens[side][ends]]
    by_group = np.argsort(of, kind="stable")  # A before B, as they are concatenated so
    return text[by_group].tolist()


def _aligned(tools: Reader, text: str | None):
    """n_a, n_b, n_groups, digest of the groups and the links' id pairs (B id times 2^32 plus A id) of a text."""
    none = 0, 0, 0, "", np.empty(0, np.int64)
    if not text:
        return none
    n_a, n_b, groups, held, links, sha = 0, 0, 0, "", [], hashlib.sha256()
    for stretch in _stretches(text):
        words = tools.words(stretch)
        if None in words:
            return none
        a, b, n, shown, pairs = zip(*words, strict=True)
        n_a, n_b, groups = n_a + sum(a), n_b + sum(b), groups + sum(n)
        sha.update(held.encode())
        held = "".join(shown)
        links.append(np.frombuffer(b"".join(pairs), "<i8"))
    sha.update(held[:-1].encode())
    return n_a, n_b, groups, sha.hexdigest(), np.concatenate(links)


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, width int, wide int"
_PAIR = "pair long, place int, here long"
SCHEMA = f"kind int, block long, {_DOC}, {_PAIR}"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_ARROW = pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in SCHEMA.split(", ")])
_DOC_NAMES = [x.split()[0] for x in _DOC.split(", ")]


def _narrow(values: np.ndarray) -> tuple[bytes, int]:
    """Unsigned integers in as few bytes each as the largest needs, and that number."""
    width = next(w for w in (1, 2, 4) if w == 4 or not values.size or values.max() < 1 << (8 * w))
    return values.astype(f"<u{width}").tobytes(), width


def _wide(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}").astype(np.int64)


def _align(path_a: str, path_b: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = reader(path_a, path_b)
        number, rows, pairs, held = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            every, times = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True)
            counts = np.bincount(times, np.concatenate([n for _, n in pairs]), len(every)).astype(np.int64)
            out = {f: [] for f in _DOC_NAMES}
            for row, (p, n) in zip(rows, pairs, strict=True):
                at = np.searchsorted(every, p)
                places, width = _narrow(np.diff(at, prepend=0))  # ascending, as differences
                repeats, wide = _narrow(n)
                for f, x in zip(_DOC_NAMES, (*row, places, repeats, width, wide), strict=True):
                    out[f].append(x)
            for kind, n, columns in ((0, len(rows), out), (1, len(every), {"pair": every, "place": np.arange(len(every)), "here": counts})):
                fixed = {"kind": np.full(n, kind), "block": np.full(n, number)}
                yield pa.RecordBatch.from_arrays([pa.array((fixed | columns)[f.name], f.type) if f.name in fixed or f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = text.as_py()
                n_a, n_b, groups, sha, links = _aligned(tools, text)
                rows.append((doc_id, n_a, n_b, groups, len(links), sha))
                pairs.append(np.unique(links, return_counts=True))
                held += len(text or "") + 256
                if held >= BLOCK:
                    yield from close()
                    number, rows, pairs, held = number + 1, [], [], 0
        if rows:
            yield from close()

    return task


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """A block's documents with the counts of its pairs summed over their links."""
    counts = counts.sort_values("place")
    total, best = counts["total"].to_numpy(np.int64), counts["best"].to_numpy(bool)
    n_best, sums = [], []
    for places, times, width, wide in zip(docs["places"], docs["times"], docs["width"], docs["wide"], strict=True):
        at, n = np.cumsum(_wide(places, width)), _wide(times, wide)
        n_best.append(int(n[best[at]].sum()))
        sums.append(int((n * total[at]).sum()))
    return docs.assign(n_best=n_best, count_sum=sums)[[x.split()[0] for x in _OUT.split(", ")]]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each text: a row for each row of docs.

    Texts have a space before them, which tokenizer B (sentencepiece) adds itself; A is a
    byte-level tokenizers file. n_a and n_b tokens; n_groups, the stretches between edges
    that both have; n_links, pairs of tokens that end together; n_best, links whose id pair
    is the most frequent one of its B id in the corpus (ties included); count_sum, the
    corpus-wide counts of the links' pairs; groups_sha256. A null or empty text, and one
    that either tokenizer doesn't spell byte for byte, has zeros and '' and counts nowhere.
    Repeated rows count as often as they come; doc_id may be null. Only doc_id and text are
    read. No rows: no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = materialize(docs.mapInArrow(_align(path_a, path_b), SCHEMA), "aligned", partition_by="kind")
    rows = both.where("kind = 0").select("block", *_DOC_NAMES)
    listed = both.where("kind = 1").select("block", "pair", "place", "here")
    totals = listed.groupBy("pair").agg(F.sum("here").alias("total"))
    most = totals.groupBy(F.shiftright("pair", 32).alias("b")).agg(F.max("total").alias("most"))
    scored = totals.join(most, F.shiftright("pair", 32) == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    counts = listed.join(scored, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    return rows.groupBy("block").cogroup(counts.groupBy("of")).applyInPandas(_counted, _OUT)
