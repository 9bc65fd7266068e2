"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A piece goes where it leaves the least
room (best fit); when no window takes it and none may be opened, the fullest is emitted,
topped up with the front of the piece if that leaves no sliver. What is open at the end
of the tasks is merged in rounds, by groups of 64 tasks of the round before: a merge holds
the open windows of one group, whatever number of groups its task has.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .alignment import ByteLevel
from .common import materialize, runs

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open boolean"
_ARROW = pa.schema([(x.split()[0], pa.bool_() if x.endswith("boolean") else pa.int64()) for x in SCHEMA.split(", ")])
FAN_IN = 64
#: Words whose ids an encoder remembers before it begins anew; those of the round before are still looked up.
REMEMBERED = 1 << 18
#: Characters that are given to tiktoken at once; a longer text goes by words.
AT_ONCE = 1 << 17
_PART = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_OTHER_SPACE = re.compile(r"[^\S \n\t\r]")
_encoders: dict = {}


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian 32-bit integers.

    Where the file is plain enough (ByteLevel), texts of the characters up to U+017F, which
    all versions of Unicode class alike, are encoded by tiktoken from the same vocabulary if
    they hold no special token. Other texts go by words: byte-level BPE never joins a character
    other than white space with white space after it, so a text is the sequence of its words,
    each with the white space before it. Ids of short ones are remembered, as a worker sees
    them again. Texts with rarer white space are encoded as a whole by tokenizers.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core's work
        self.model, self.known, self.older = Tokenizer.from_file(path), {}, {}
        self.fast = ByteLevel(path).fast
        added = (re.escape(x.content) for x in self.model.get_added_tokens_decoder().values())
        self.other = re.compile("|".join(["[^\\x00-\\u017f]", *added]))

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Texts or words without rarer white space."""
        fast, other = self.fast, self.other.search
        found = [fast(x) if fast and len(x) <= AT_ONCE and not other(x) else None for x in texts]
        rest = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(rest, self.model.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False) if rest else [], strict=True):
            found[k] = x.ids
        return [struct.pack(f"<{len(x)}I", *x) for x in found]

    def ids(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text):
            found = self.model.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(found)}I", *found)
        if self.fast and len(text) <= AT_ONCE and not self.other.search(text):
            found = self.fast(text)
            return struct.pack(f"<{len(found)}I", *found)
        parts = _PART.findall(text)
        new = set(parts).difference(self.known)
        if not new:
            return b"".join(map(self.known.__getitem__, parts))
        here = {x: self.older[x] for x in new if x in self.older}
        new = [x for x in new if x not in here]
        here.update(zip(new, self._encode(new), strict=True))
        known = self.known
        if len(new) < 1 << 12:
            known.update(here)
            out = b"".join(map(known.__getitem__, parts))
        else:
            out = b"".join([here[x] if x in here else known[x] for x in parts])
        for part in new:
            if len(part) > 64:
                known.pop(part, None)
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return out


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@dataclass
class Packer:
    """Open windows, ordered by room. Pieces are (doc_id, start, length, crc, doc_tokens)."""

    size: int
    most_open: int
    first_id: int
    sliver: int = 16
    rooms: list = field(default_factory=list)  # (room, number), ascending
    held: dict = field(default_factory=dict)
    out: list = field(default_factory=list)
    opened: int = 0

    def _open(self) -> int:
        self.opened += 1
        self.held[self.opened] = []
        return self.opened

    def emit(self, number: int, still_open: bool = False) -> None:
        at = 0
        for piece in self.held.pop(number):
            self.out.append((*piece, self.first_id + number, at, still_open))
            at += piece[2]

    def place(self, piece: tuple, cut) -> None:
        """cut(piece, n) gives the first n tokens and the rest of a piece, or None if it can't be cut."""
        while True:
            i = bisect_left(self.rooms, (piece[2], 0))
            if i < len(self.rooms):
                room, number = self.rooms.pop(i)
            elif len(self.rooms) < self.most_open:
                room, number = self.size, self._open()
            else:
                room, number = self.rooms.pop(0)
                parts = cut(piece, room) if room >= self.sliver and piece[2] - room >= self.sliver else None
                if parts:
                    self.held[number].append(parts[0])
                    piece = parts[1]
                self.emit(number)
                continue
            self.held[number].append(piece)
            if room == piece[2]:
                self.emit(number)
            else:
                insort(self.rooms, (room - piece[2], number))
            return

    def drain(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_ARROW), _ARROW, strict=True)], schema=_ARROW)


def _pack(size: int, most_open: int, path: str, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        packer = Packer(size, most_open, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for no, (name, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"], strict=True), 1):
                raw = encode.ids(text.as_py() or "") + end
                total = len(raw) // 4

                def piece(start: int, length: int, raw=raw, name=name, total=total) -> tuple:
                    return name, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), total

                def cut(p: tuple, n: int, piece=piece) -> tuple:
                    return piece(p[1], n), piece(p[1] + n, p[2] - n)

                whole = total - total % size
                for start in range(0, whole, size):
                    number = packer._open()
                    packer.held[number].append(piece(start, size))
                    packer.emit(number)
                if total > whole:
                    packer.place(piece(whole, total - whole), cut)
                if not no % 128:
                    yield packer.drain()
            yield packer.drain()
        for _, number in packer.rooms:
            packer.emit(number, True)
        yield packer.drain()

    return task


def _merge(size: int, most_open: int, round_no: int, last: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "group"):
            packer = Packer(size, most_open, (round_no << 56) | (group["group"][0].as_py() << 32))
            pieces = zip(*(group[f].to_pylist() for f in _ARROW.names[:5]), strict=True)
            for p in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[3])):
                packer.place(p, lambda p, n: None)
            for _, number in packer.rooms:
                packer.emit(number, not last)
            yield packer.drain()

    return task


def pack(docs: DataFrame, path: str, size: int = 1024, most_open: int = 64, end_id: int = 0) -> DataFrame:
    """Pieces of all documents, each in exactly one place of one sequence.

    doc_id, start and length (tokens before the piece and in it), ids_crc32 (CRC-32 of
    its ids as little-endian 32-bit words), doc_tokens (with the end id), sequence_id and
    offset. Ids are those of the tokenizers file at path, special tokens found in a text
    included, none added. A null text is an empty one: a single end id. Rows are packed
    one by one, so repeated rows give repeated pieces; a null doc_id stays null. No rows:
    no rows. Only doc_id and text are read. Ids of sequences depend on the partitions of
    the input alone, so a task that is run again gives the same rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = materialize(docs.mapInArrow(_pack(size, most_open, path, end_id), SCHEMA), "pieces")
    done, left, round_no = packed.where("not open"), packed.where("open"), 0
    origin = F.shiftright("sequence_id", 32).bitwiseAND((1 << 24) - 1)
    parts = (left.agg(F.max(origin)).first()[0] or 0) + 1
    while True:
        round_no, parts = round_no + 1, -(-parts // FAN_IN)
        grouped = left.withColumn("group", F.floor(origin / FAN_IN).cast("long"))
        merged = grouped.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_merge(size, most_open, round_no, parts == 1), SCHEMA)
        if parts == 1:
            return done.unionByName(merged).drop("open")
        merged = materialize(merged, "pieces")
        done, left = done.unionByName(merged.where("not open")), merged.where("open")
