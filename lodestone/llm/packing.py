"""Best-fit packing of tokenized documents into sequences: hierarchical residual packing.

A document is its byte-level ids followed by the end id.  One longer than a sequence is
cut into full sequences, of which the first piece may be shorter; full pieces are
sequences of their own.  The rest is packed in rounds: every partition packs its pieces
best-fit (longest first, into the fullest sequence with room), emits the sequences that
are nearly full, and hands the underfull ones up as items.  Groups of ``FAN_IN``
partitions merge in each round, until one group is left or every group would hold more
than ``GROUP_ITEMS`` items; then the last groups emit all, which leaves at most about one
sequence of each such group less than nearly full (figures in the README).  A sequence has at most as many
pieces as tokens, so an item's row is bounded; a partition packs ``GROUP_ITEMS`` items at a
time, so a task is bounded too.

Each round is a table in the shared folder: a lost executor repeats part of one round only.

Edge cases: a null text is empty and its sequence is the end id alone; a piece of exactly
the sequence length is its own sequence; equal lengths are taken by (doc_id, start, crc);
repeated rows are packed as rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, give_back, materialize, partitions, ranges, table, text_or_empty
from lodestone.llm.tokens import BYTE_FILE, encoder

LENGTH, END_ID = 2048, 0
#: A sequence with no more free places is nearly full.
SLACK = 4
FAN_IN = 4
GROUP_ITEMS = 100_000

_PIECE = "doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint"
_ITEM = f"seq long, fill int, pieces array<struct<{_PIECE}>>"
_ARROW_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

def best_fit(fills: Iterable[int], length: int = LENGTH) -> np.ndarray:
    """The sequence of each item, taken in the order given, each into the fullest sequence with room."""
    open_by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r: some sequence has r free places
    number, out = 0, []
    for fill in fills:
        fitting = rooms >> fill
        if fitting:
            room = fill + (fitting & -fitting).bit_length() - 1
            found = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
            room -= fill
        else:
            found, room = number, length - fill
            number += 1
        if room:
            open_by_room[room].append(found)
            rooms |= 1 << room
        out.append(found)
    return np.array(out, dtype=np.int64)


class Pieces(NamedTuple):
    """Columns of pieces; ``doc_id`` is 0 where ``no_id``."""

    doc_id: np.ndarray
    no_id: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    length: np.ndarray
    ids_crc32: np.ndarray

    def take(self, at: np.ndarray) -> Pieces:
        return Pieces(*(x[at] for x in self))


def _joined(parts: list[Pieces]) -> Pieces:
    return Pieces(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def pieces_of(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> Pieces:
    """Cut documents (``sizes`` of the flat ``ids``, the end id of each among them)."""
    n = -(-sizes // length)
    owner = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    first = (sizes - 1) % length + 1
    start = np.where(piece > 0, first[owner] + (piece - 1) * length, 0)
    own = np.where(piece > 0, length, first[owner])
    at = (np.cumsum(sizes) - sizes)[owner] + start
    flat = np.ascontiguousarray(ids, dtype="<u4")
    crc = np.array([zlib.crc32(flat[a:b]) for a, b in zip(at.tolist(), (at + own).tolist(), strict=True)], dtype=np.int64)
    no_id = np.asarray(doc_ids.is_null())
    return Pieces(np.asarray(doc_ids.fill_null(0))[owner], no_id[owner], piece.astype(np.int32), start, own, crc)


def _batch(seq: np.ndarray, fill: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> pa.RecordBatch:
    """Rows of sequences; a negative number stands for none."""
    kinds = [f.type for f in _ARROW_PIECES.value_type]
    own = [pa.array(pieces.doc_id, kinds[0], mask=pieces.no_id), *(pa.array(x, k) for x, k in zip(pieces[2:], kinds[1:], strict=True))]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.StructArray.from_arrays(own, fields=list(_ARROW_PIECES.value_type)))
    return pa.RecordBatch.from_arrays([pa.array(seq, pa.int64(), mask=seq < 0), pa.array(fill, pa.int32()), lists], ["seq", "fill", "pieces"])


class _Packer:
    """Packs the items of one task, ``GROUP_ITEMS`` or a few more at a time, and numbers what is emitted."""

    def __init__(self, base: int, length: int, slack: int, last: bool, most: int):
        self.next, self.length, self.slack, self.last, self.most = base, length, slack, last, most
        self.waiting: list[tuple[np.ndarray, Pieces]] = []
        self.n = 0

    def numbers(self, n: int) -> np.ndarray:
        self.next += n
        return np.arange(self.next - n, self.next)

    def add(self, sizes: np.ndarray, pieces: Pieces) -> Iterator[pa.RecordBatch]:
        """Items of ``sizes`` pieces each; packed when there are enough."""
        self.waiting.append((sizes, pieces))
        self.n += len(sizes)
        if self.n >= self.most:
            yield from self.pack()

    def pack(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        sizes, pieces = np.concatenate([s for s, _ in self.waiting]), _joined([p for _, p in self.waiting])
        self.waiting, self.n = [], 0
        first = np.cumsum(sizes) - sizes
        fill = np.add.reduceat(pieces.length, first)
        # Longest first, equal ones by the first piece.
        order = np.lexsort((pieces.ids_crc32[first], pieces.start[first], pieces.doc_id[first], -fill))
        which = best_fit(fill[order].tolist(), self.length)
        order = order[np.argsort(which, kind="stable")]
        which.sort()
        total, counts = (np.bincount(which, x[order]).astype(np.int64) for x in (fill, sizes))
        done = np.ones(len(total), bool) if self.last else total >= self.length - self.slack
        seq = np.full(len(total), -1)
        seq[done] = self.numbers(int(done.sum()))
        yield _batch(seq, total, counts, pieces.take(ranges(first[order], sizes[order])))


def _first_round(docs: DataFrame, name: str, length: int, end_id: int, slack: int, most: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        packer = _Packer(TaskContext.get().partitionId() << 40, length, slack, False, most)
        for b in byte_slices(batches, "t", 1 << 20):
            ids, sizes = enc.encode(b.column("t"))
            p = pieces_of(b.column("doc_id"), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1, length)
            full = p.length == length
            n = int(full.sum())
            yield _batch(packer.numbers(n), np.full(n, length), np.ones(n, np.int64), p.take(full))
            yield from packer.add(np.ones(len(full) - n, np.int64), p.take(~full))
            give_back()
        yield from packer.pack()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, _ITEM)


def _next_round(items: DataFrame, groups: int, number: int, length: int, slack: int, last: bool, most: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(number << 58 | TaskContext.get().partitionId() << 40, length, slack, last, most)
        for b in batches:
            lists = b.column("pieces")
            flat = lists.flatten()
            doc_id, *rest = (flat.field(f.name) for f in _ARROW_PIECES.value_type)
            pieces = Pieces(np.asarray(doc_id.fill_null(0)), np.asarray(doc_id.is_null()), *(np.asarray(x) for x in rest))
            yield from packer.add(np.asarray(lists.value_lengths()).astype(np.int64), pieces)
        yield from packer.pack()
        give_back()

    # An item's first piece names it, so a repeated task gets the same items; they are sorted before packing.
    key = F.xxhash64(F.lit(number), F.col("pieces")[0]["doc_id"], F.col("pieces")[0]["start"])
    return items.select("fill", "pieces").repartition(groups, key).mapInArrow(run, _ITEM)


def pack(docs: DataFrame, name: str = BYTE_FILE, length: int = LENGTH, end_id: int = END_ID, slack: int = SLACK, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rounds = [materialize(_first_round(docs, name, length, end_id, slack, group_items), "packed")]
    groups = partitions(docs.sparkSession) * FAN_IN
    while True:
        rest = rounds[-1].where("seq IS NULL")
        left = rest.count()
        if not left:
            break
        least = -(-left // group_items)
        groups = max(least, min(-(-groups // FAN_IN), -(-left // 500)))
        last = groups == least
        rounds.append(materialize(_next_round(rest, groups, len(rounds), length, slack, last, group_items), "packed"))
        if last:
            break
    out = None
    for r in rounds:
        done = r.where("seq IS NOT NULL")
        out = done if out is None else out.unionByName(done)
    rows = out.select("seq", F.posexplode("pieces").alias("place", "p"), "pieces")
    before = F.aggregate(F.slice("pieces", F.lit(1), F.col("place")), F.lit(0).cast("long"), lambda a, p: a + p["length"])
    return rows.select("p.*", F.col("seq").alias("sequence_id"), before.alias("offset"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
