"""Removal of long strings that an earlier document holds: a logarithmic family of suffix arrays.

A byte goes if a string of ``WINDOW`` bytes around it also starts in a document with a smaller
doc_id.  Strings are dealt to buckets, and every bucket keeps a family of sparse suffix arrays:

* every string has an anchor, its ``KEY`` bytes of least hash, so equal strings have equal
  anchors.  Neighbouring strings with one anchor travel together, as one entry (their joint
  text); an entry's bucket is a hash of its anchor;
* texts are held in slices, a table of its own; a slice sends each distinct entry once, with its
  smallest doc_id, so a passage that a third of all documents share is sent once per slice;
* in a bucket each slice is a batch: its suffix array is its anchors' suffixes, sorted by
  their first ``KEY`` bytes.  It is merge-scanned against the levels of the family for equal anchors,
  becomes a level, and levels of one size merge, like the digits of a binary counter;
* for anchors that met another document the strings themselves are compared: sorted by a hash
  of all their bytes, equal hashes compared byte by byte, the smallest doc_id of each kept;
* a slice gets back one bit per string and turns them into removed runs.

Slices and the family (``index``) are tables in the shared folder.  A family can be kept and
given to the next call, whose documents are judged against it and added to it.  Slices are
bucketed by their number, so texts aren't shuffled when the bits come back.  A task holds a
slice or a bucket; the number of buckets follows the bytes of the corpus.

Edge cases: null texts are empty; texts shorter than a string keep everything; rows of one doc_id
don't judge each other; a null doc_id is neither smaller nor greater than another, so its row keeps
everything and judges none; an empty table gives no rows; other columns are ignored.  All texts are
compared byte by byte; only the choice of anchors trusts a hash: were two different anchors of one string
to have one 64-bit hash (a chance under 1e-16 a string), that string might be overlooked.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, byte_slices, materialize, partitions, ranges, scratch, table, text_or_empty
from lodestone.llm.tokens import gather

WINDOW = 50
#: Bytes of an anchor, a power of two.
KEY = 16
#: Strings of an entry.
MOST = 128
#: Text of a slice, and text of the entries that a bucket is meant for.
SLICE, BUCKET = 4 << 20, 16 << 20
#: An entry's text for each byte of a document.
SPREAD = 4
#: Windows hashed together (their arrays stay in a core's cache).
BLOCK = 1 << 17

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD
    return h ^ (h >> np.uint64(32))


def _grams(text: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place (doubling; the last two parts overlap)."""
    h, n, factor = text.astype(np.uint64) + np.uint64(1), 1, np.array([_ODD])
    while 2 * n <= size:
        h = h[:-n] * factor + h[n:]
        n, factor = 2 * n, factor * factor
    if n < size:
        h = h[: len(h) - (size - n)] * factor + h[size - n :]
    return _mix(h)


def _slide(x: np.ndarray, size: int) -> np.ndarray:
    """Least of the ``size`` values from each place."""
    n = 1
    while 2 * n <= size:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    return np.minimum(x[: len(x) - (size - n)], x[size - n :])


def words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a big-endian number."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))[at].astype(np.uint64)


class Entries(NamedTuple):
    """Runs of strings with one anchor: first string, strings, anchor's place behind the first, hash of the anchor."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    least: np.ndarray


def entries(text: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> Entries:
    """Entries of the documents of ``sizes`` that make up ``text``, in order; they hold every string once."""
    parts = [Entries(*(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64)))]
    ends, width = np.cumsum(sizes), window - KEY + 1
    for a in range(0, len(text) - window + 1, BLOCK):
        b = min(a + BLOCK, len(text) - window + 1)
        h = _grams(text[a : b + window - 1], KEY)
        least = _slide(h, width)
        # Strings that end behind their document aren't any.
        crossing = np.zeros(b - a + 1, np.int32)
        near = ends[(ends > a) & (ends < b + window)]
        np.add.at(crossing, np.clip(near - window + 1 - a, 0, b - a), 1)
        np.add.at(crossing, np.clip(near - a, 0, b - a), -1)
        valid = np.cumsum(crossing)[:-1] == 0
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        start = np.flatnonzero(first)
        seen = np.concatenate([np.cumsum(valid) - valid, [valid.sum()]])
        count = np.diff(np.append(seen[start], seen[-1]))
        many = -(-count // MOST)
        if len(many) and many.max() > 1:
            rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            start, count = np.repeat(start, many) + rank * MOST, np.minimum(np.repeat(count, many) - rank * MOST, MOST)
        anchor, open_ = np.full(len(start), width - 1), np.arange(len(start))
        for o in range(width - 1, -1, -1):
            hit = h[start[open_] + o] == least[start[open_]]
            anchor[open_[hit]] = o
            open_ = open_[~hit]
        parts.append(Entries(start + a, count, anchor, least[start]))
    return Entries(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _same(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings of ``size`` bytes (8 at least) from places a and b are equal."""
    same = np.ones(len(a), bool)
    for k in range(0, int(size.max(initial=0)), 8):
        some = np.flatnonzero(same & (size > k))
        o = np.minimum(k, size[some] - 8)
        same[some] = words(text, a[some] + o) == words(text, b[some] + o)
    return same


def distinct(text: np.ndarray, found: Entries, docs: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chosen, which, least doc): the first entry of each text, each entry's place among them, smallest of its docs."""
    size = found.count + window - 1
    h = found.least ^ _mix(found.count.astype(np.uint64))
    for o in (0, 8, 16, 24, 32, 40):
        if o + 8 <= window:
            h = _mix(h ^ words(text, found.start + o)) + words(text, found.start + size - 8 - o)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    own = np.arange(len(h))
    other = np.flatnonzero(first[which] != own)
    differs = other[~_same(text, found.start[first[which[other]]], found.start[other], size[other])]
    if len(differs):  # a hash for two texts: they stay apart
        which[differs] = len(first) + np.arange(len(differs))
        first = np.concatenate([first, differs])
    order = np.argsort(first)
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, place[which], docs)
    return first[order], place[which], least


def _press(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(x.tobytes())


def _opened(x: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


_BATCH = "bucket long, slice long, level int, text binary, count binary, anchor binary, doc binary"
_BATCH_NAMES = [c.split()[0] for c in _BATCH.split(", ")]
_BITS = "slice long, bucket long, bits binary"


def _batches(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], _BATCH_NAMES)


def _pack(bucket: int, slice_: int, level: int, text: np.ndarray, start: np.ndarray, count: np.ndarray, anchor: np.ndarray, doc: np.ndarray, window: int) -> tuple:
    joint = gather(text, start, count + window - 1)
    return bucket, slice_, level, _press(joint), _press(count.astype(np.uint8)), _press(anchor.astype(np.uint8)), _press(np.diff(doc, prepend=0))


class Slice:
    """A slice's entries by bucket, made anew wherever they are needed."""

    def __init__(self, texts: pa.Array, doc_ids: np.ndarray, buckets: int, window: int):
        raw = texts.cast(pa.large_binary())
        ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        self.text = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        self.sizes, self.docs, self.window = np.diff(ends), doc_ids, window
        self.all = entries(self.text, self.sizes, window)
        self.owner = self.docs[np.searchsorted(np.cumsum(self.sizes), self.all.start, side="right")]
        self.chosen, self.which, self.least = distinct(self.text, self.all, self.owner, window) if len(self.owner) else (np.zeros(0, np.int64),) * 3
        bucket = (self.all.least[self.chosen] >> np.uint64(8)) % np.uint64(buckets)
        #: Chosen entries by bucket, in each in order of place.
        self.order = np.argsort(bucket, kind="stable")
        self.buckets, first = np.unique(bucket[self.order], return_index=True)
        self.runs = list(zip(self.buckets.tolist(), first.tolist(), np.append(first[1:], len(bucket)).tolist(), strict=True))

    def packed(self, number: int) -> Iterator[tuple]:
        for bucket, a, b in self.runs:
            k = self.order[a:b]
            at = self.chosen[k]
            yield _pack(bucket, number, -1, self.text, self.all.start[at], self.all.count[at], self.all.anchor[at], self.least[k], self.window)

    def removed(self, bits: dict[int, bytes]) -> np.ndarray:
        """Bytes that go."""
        count = self.all.count[self.chosen]
        first = np.cumsum(count) - count
        hit = np.zeros(int(count.sum()), bool)
        for bucket, a, b in self.runs:
            if bucket in bits:
                k = self.order[a:b]
                flat = np.unpackbits(_opened(bits[bucket], np.uint8), count=int(count[k].sum())).view(bool)
                hit[ranges(first[k], count[k])] = flat
        n = self.all.count
        gone = gather(hit, first[self.which], n) | np.repeat(self.owner > self.least[self.which], n)
        at = ranges(self.all.start, n)[gone]
        step = np.zeros(len(self.text) + 1, np.int32)
        step[at] += 1
        step[at + self.window] -= 1
        return np.cumsum(step)[:-1] > 0


class Level(NamedTuple):
    """Suffixes (numbers of a bucket's entries) in order of their anchors' bytes, and whether an equal anchor was met."""

    high: np.ndarray
    low: np.ndarray
    entry: np.ndarray
    met: np.ndarray


class Family:
    """Levels of one bucket, of falling sizes; equal sizes (by power of two) merge."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, batch: Level) -> None:
        """Scan a sorted batch against every level, then make it a level."""
        for level in self.levels:
            self._scan(batch, level)
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-1].entry).bit_length() >= len(self.levels[-2].entry).bit_length():
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(merge(a, b))

    @staticmethod
    def _scan(batch: Level, level: Level) -> None:
        """Mark equal anchors on both sides."""
        at = place(level, batch)
        hit = at < len(level.high)
        hit[hit] = (level.high[at[hit]] == batch.high[hit]) & (level.low[at[hit]] == batch.low[hit])
        batch.met[hit] = True
        level.met[at[hit]] = True


def place(level: Level, batch: Level) -> np.ndarray:
    """For each suffix of a sorted batch, how many of the level's come before it."""
    lo, hi = np.searchsorted(level.high, batch.high, "left"), np.searchsorted(level.high, batch.high, "right")
    # Between equal high words, a search for the low word.
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) // 2
        less = level.low[mid] < batch.low[open_]
        lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def merge(a: Level, b: Level) -> Level:
    """One level of two."""
    at = place(a, b) + np.arange(len(b.entry))
    mine = np.ones(len(a.entry) + len(b.entry), bool)
    mine[at] = False
    out = []
    for x, y in zip(a, b, strict=True):
        both = np.empty(len(mine), x.dtype)
        both[mine], both[at] = x, y
        out.append(both)
    return Level(*out)


def sort_level(high: np.ndarray, low: np.ndarray, entry: np.ndarray, met: np.ndarray) -> Level:
    order = np.lexsort((low, high))
    return Level(high[order], low[order], entry[order], met[order])


def _equal_before(level: Level) -> np.ndarray:
    same = np.zeros(len(level.entry), bool)
    same[1:] = (level.high[1:] == level.high[:-1]) & (level.low[1:] == level.low[:-1])
    return same


class Bucket:
    """All entries of a bucket: those of a kept family first, then a batch per slice."""

    def __init__(self, rows: list[dict], window: int):
        self.rows, self.window = sorted(rows, key=lambda r: (r["level"] < 0, -r["level"], r["slice"])), window
        opened = [tuple(_opened(r[c], t) for c, t in (("text", np.uint8), ("count", np.uint8), ("anchor", np.uint8), ("doc", np.int64))) for r in self.rows]
        text, count, anchor, doc = zip(*opened, strict=True)
        self.text = np.concatenate(text)
        self.count, self.anchor = (np.concatenate(x).astype(np.int64) for x in (count, anchor))
        self.doc = np.concatenate([np.cumsum(d) for d in doc])
        size = self.count + window - 1
        self.start = np.cumsum(size) - size
        self.edges = np.cumsum([0, *map(len, count)]).tolist()
        self.family = Family()
        at = self.start + self.anchor
        self.high, self.low = words(self.text, at), words(self.text, at + KEY - 8)
        for a, b in zip(self.edges, self.edges[1:], strict=False):
            own = np.arange(a, b)
            self.family.add(sort_level(self.high[a:b], self.low[a:b], own, np.zeros(b - a, bool)))

    def met(self) -> np.ndarray:
        """Whether an entry's anchor is that of another entry."""
        met = np.zeros(len(self.count), bool)
        for level in self.family.levels:
            same = _equal_before(level)
            # What one of equal anchors met, all have met.
            group = np.cumsum(~same) - 1
            hit = np.bincount(group, level.met) + (np.bincount(group) > 1) > 0
            met[level.entry] = hit[group]
        return met

    def hits(self) -> np.ndarray:
        """For each string of each entry, in order: whether a smaller doc has it."""
        out = np.zeros(int(self.count.sum()), bool)
        chosen = np.flatnonzero(self.met())
        n = self.count[chosen]
        if not len(n):
            return out
        at = ranges(self.start[chosen], n)
        doc = np.repeat(self.doc[chosen], n)
        h = _mix(words(self.text, at))
        for o in [*range(8, self.window - 8, 8), self.window - 8]:
            h = _mix(h ^ words(self.text, at + o))
        order = np.argsort(h)
        h = h[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = h[1:] != h[:-1]
        heads = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        head, rest = order[heads][group], np.flatnonzero(~fresh)
        bad = rest[~_same(self.text, at[head[rest]], at[order[rest]], np.full(len(rest), self.window))]
        least = np.minimum.reduceat(doc[order], heads)
        hit = np.empty(len(h), bool)
        hit[order] = least[group] < doc[order]
        for g in np.unique(group[bad]):  # one hash, several strings
            mine = order[group == g]
            by: dict[bytes, int] = {}
            named = [self.text[at[k] : at[k] + self.window].tobytes() for k in mine]
            for k, s in zip(mine, named, strict=True):
                by[s] = min(by.get(s, doc[k]), doc[k])
            hit[mine] = [by[s] < doc[k] for k, s in zip(mine, named, strict=True)]
        out[ranges((np.cumsum(self.count) - self.count)[chosen], n)] = hit
        return out

    def bits(self) -> Iterator[tuple[int, int, bytes]]:
        hit, ends = self.hits(), np.concatenate([[0], np.cumsum(self.count)])
        for r, a, b in zip(self.rows, self.edges, self.edges[1:], strict=False):
            own = hit[ends[a] : ends[b]]
            if r["level"] < 0 and own.any():
                yield r["slice"], r["bucket"], _press(np.packbits(own))

    def kept(self) -> Iterator[tuple]:
        """Rows of the family, a level each."""
        for k, level in enumerate(reversed(self.family.levels)):
            e = level.entry
            yield _pack(self.rows[0]["bucket"], -1, k, self.text, self.start[e], self.count[e], self.anchor[e], self.doc[e], self.window)


def _by_bucket(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[Bucket]:
    """Buckets of a partition sorted by bucket, one at a time."""
    held: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and r["bucket"] != held[0]["bucket"]:
                yield Bucket(held, window)
                held = []
            held.append(r)
    if held:
        yield Bucket(held, window)


def write_slices(docs: DataFrame, label: str = "slices") -> DataFrame:
    """(slice, docs, texts, n_bytes), bucketed by slice: about ``SLICE`` bytes of whole texts each."""
    spark = docs.sparkSession
    bound_batches(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            n, number, held = whole.num_rows, number + 1, []
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), whole.column(c)) for c in ("doc_id", "t")]
            size = sum(len(x) for x in whole.column("t").buffers()[2:] if x)
            return pa.RecordBatch.from_arrays([pa.array([number - 1]), *lists, pa.array([size])], ["slice", "docs", "texts", "n_bytes"])

        waiting = 0
        for b in byte_slices(batches, "t", SLICE // 4):
            held.append(b)
            waiting += b.column("t").nbytes
            if waiting >= SLICE:
                yield flush()
                waiting = 0
        if held:
            yield flush()

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text_or_empty(), "UTF-8").alias("t"))
    name, path = f"slices_{uuid.uuid4().hex}", scratch(spark, label)
    made = rows.mapInArrow(run, "slice long, docs array<bigint>, texts array<binary>, n_bytes long")
    made.write.bucketBy(max(8, partitions(spark)), "slice").option("path", path).option("compression", "zstd").saveAsTable(name)
    slices = spark.table(name)
    slices.schema  # resolved before its name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return slices


def _list(batch: pa.RecordBatch, name: str, k: int) -> pa.Array:
    return batch.column(name).slice(k, 1).flatten()


def send(slices: DataFrame, buckets: int, window: int = WINDOW) -> DataFrame:
    """A row per slice and bucket: the distinct entries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = Slice(_list(batch, "texts", k), _list(batch, "docs", k).to_numpy(), buckets, window)
                yield _batches(list(s.packed(batch.column("slice")[k].as_py())))

    return slices.select("slice", "docs", "texts").mapInArrow(run, _BATCH)


def dedupe(docs: DataFrame, window: int = WINDOW, buckets: int | None = None, index: DataFrame | None = None, keep: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(rows, family): per document doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left).

    ``window``: bytes of a string, 24 at least.  ``index``: the family of an earlier call with as many ``buckets``;
    its documents judge these ones.  The family with these documents is returned if ``keep``.
    """
    if not KEY + 8 <= window < 128:
        raise ValueError("strings of 24 to 127 bytes")
    spark = docs.sparkSession
    slices = write_slices(docs)
    if buckets is None:
        total = slices.agg(F.sum("n_bytes")).first()[0] or 0
        buckets = max(1, -(-SPREAD * total // BUCKET))
    sent = send(slices, buckets, window)
    if index is not None:
        sent = sent.unionByName(index)
    dealt = sent.repartition(max(partitions(spark), min(buckets, 4 * partitions(spark))), "bucket").sortWithinPartitions("bucket")
    if keep:
        dealt = materialize(dealt, "dealt").repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _by_bucket(batches, window):
            rows = list(bucket.bits())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["slice", "bucket", "bits"])

    def level(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _by_bucket(batches, window):
            yield _batches(list(bucket.kept()))

    bits = dealt.mapInArrow(judge, _BITS).groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                docs_, texts = _list(batch, "docs", k), _list(batch, "texts", k)
                s = Slice(texts, docs_.to_numpy(), buckets, window)
                gone = s.removed({x["bucket"]: x["bits"] for x in batch.column("bits")[k].as_py() or ()})
                ends = np.cumsum(s.sizes)
                begins = ends - s.sizes
                rise = gone.copy()
                rise[1:] &= ~gone[:-1]
                full = begins[s.sizes > 0]
                rise[full] = gone[full]
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, rise)]
                n_removed, n_spans = (x[ends] - x[begins] for x in sums)
                left = [s.text[a:b].tobytes() if not n else s.text[a:b][~gone[a:b]].tobytes() for a, b, n in zip(begins.tolist(), ends.tolist(), n_removed.tolist(), strict=True)]
                digests = [hashlib.sha256(x).hexdigest() for x in left]
                yield pa.RecordBatch.from_arrays([docs_, pa.array(s.sizes), pa.array(n_removed), pa.array(n_spans), pa.array(digests), pa.array(left, pa.binary())], _NAMES)

    rows = slices.select("slice", "docs", "texts").join(bits, "slice", "left").drop("slice").mapInArrow(finish, _OUT)
    text = text_or_empty()
    zero = F.lit(0).cast("long")
    loose = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"), F.encode(text, "UTF-8").alias("kept"))
    return rows.unionByName(loose), materialize(dealt.mapInArrow(level, _BATCH), "family") if keep else None


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "documents").select("doc_id", "text"))[0].drop("kept")


ORACLE = f"""WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, range(0, greatest(octet_length(encode(coalesce(text, ''))) - {WINDOW - 1}, 0)) AS places FROM documents),
s AS MATERIALIZED (SELECT doc_id, unnest(places) AS i, unnest(list_transform(places, lambda k: hash(substr(x, 2 * k + 1, {2 * WINDOW})))) AS w FROM h),
m AS (SELECT w, min(doc_id) AS d FROM s GROUP BY w HAVING min(doc_id) < max(doc_id)),
f AS (SELECT s.doc_id, s.i, coalesce(s.i - lag(s.i) OVER (PARTITION BY s.doc_id ORDER BY s.i) > {WINDOW}, true) AS first FROM s JOIN m USING (w) WHERE m.d < s.doc_id),
n AS (SELECT doc_id, i, sum(CAST(first AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM f),
r AS (SELECT doc_id, span, min(i) AS a, max(i) + {WINDOW} AS b FROM n GROUP BY doc_id, span),
g AS (SELECT r.doc_id, r.a, r.b, substr(h.x, 2 * coalesce(lag(r.b) OVER (PARTITION BY r.doc_id ORDER BY r.a), 0) + 1, 2 * (r.a - coalesce(lag(r.b) OVER (PARTITION BY r.doc_id ORDER BY r.a), 0))) AS gap FROM r JOIN h USING (doc_id)),
k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(gap, '' ORDER BY a) AS gaps, max(b) AS last FROM g GROUP BY doc_id)
SELECT h.doc_id, CAST(len(h.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
 sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h.x ELSE k.gaps || substr(h.x, 2 * k.last + 1) END)) AS kept_sha256 FROM h LEFT JOIN k USING (doc_id)"""
