"""Token-id files: documents in ascending doc_id order, compressed by Re-Pair grammars.

Format: a Parquet table with one row per shard.  A shard holds whole documents in order,
about ``SHARD_IDS`` ids.  Its ids are compressed by Re-Pair (Larsson and Moffat 1999):
frequent adjacent pairs are repeatedly replaced by new symbols, until no pair is left that is
replaced ``LEAST_COUNT`` times.  A shard stores, each at its own bit width (``pack_bits``),

* ``part``, ``shard``: its place in the order; ``n_ids``: its ids;
* ``terms``: its distinct ids, ascending; symbol k below their number T is terms[k];
* ``left``, ``right``: the rules, symbol T + k standing for left[k] right[k];
* ``lengths``: how many ids each rule expands to;
* ``symbols``: the compressed sequence;
* ``doc_ids`` and ``sizes``: its documents and their ids.

A document is decoded without the rest of its shard: expansion lengths give the symbols
that cover its ids, and only those are expanded (``decode_range``, ``read_document``).

One pass replaces many pairs: every place takes its pair unless an overlapping one is more
frequent, so the grammar is one that Re-Pair makes, but for the order of near ties.  A rule
costs two symbols and may widen all of them, hence a ``LEAST_COUNT`` over three.

Order without one task: rows are dealt by ranges of doc_id and sorted inside; the start of
a document is its part's first id, plus its shard's, plus its place.  Only one sum per part
(a fixed number of parts) is handled together.

Edge cases: a null text is empty and stored as the end id alone; rows with one doc_id are
ordered by a hash of their text; a null doc_id comes first; a text longer than a shard
makes a longer shard; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, partitions, scratch, table, text_or_empty
from lodestone.llm.tokens import WORD_FILE, encoder, gather

END_ID = 1
SHARD_IDS = 1 << 20
#: A pair gets a rule if so many places take it in a pass.
LEAST_COUNT = 8

_SCHEMA = "part int, shard int, n_ids long, terms binary, left binary, right binary, lengths binary, symbols binary, doc_ids array<bigint>, sizes array<bigint>"

_BLOBS = ("terms", "left", "right", "lengths", "symbols")


class Grammar(NamedTuple):
    """Numbers of a shard, as described above."""

    terms: np.ndarray
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray


def pack_bits(values: np.ndarray) -> bytes:
    """Count and bit width (8 bytes each), then the values at that width, 64 to a row of words."""
    width = max(1, int(values.max(initial=0)).bit_length())
    v = np.zeros((-(-len(values) // 64), 64), dtype=np.uint64)
    v.reshape(-1)[: len(values)] = values
    v, words = np.ascontiguousarray(v.T), np.zeros((width, len(v)), dtype=np.uint64)
    for j in range(64):
        at, shift = divmod(j * width, 64)
        words[at] |= v[j] << np.uint64(shift)
        if shift + width > 64:
            words[at + 1] |= v[j] >> np.uint64(64 - shift)
    return np.array([len(values), width], dtype="<u8").tobytes() + words.T.astype("<u8").tobytes()


def unpack_bits(stored: bytes) -> np.ndarray:
    count, width = np.frombuffer(stored[:16], dtype="<u8").tolist()
    words = np.ascontiguousarray(np.frombuffer(stored, dtype="<u8", offset=16).reshape(-1, width).T)
    v, mask = np.empty((64, words.shape[1]), dtype=np.int64), np.uint64((1 << width) - 1)
    for j in range(64):
        at, shift = divmod(j * width, 64)
        x = words[at] >> np.uint64(shift)
        if shift + width > 64:
            x = x | words[at + 1] << np.uint64(64 - shift)
        v[j] = x & mask
    return v.T.reshape(-1)[:count]


def _number(symbols: np.ndarray, at: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs at ``at`` that are frequent there, each place's number among them from ``first`` on, -1 for others)."""
    keys = symbols[at].astype(np.int64) << 32 | symbols[at + 1]
    number = np.full(len(keys), -1, np.int32)
    # Only pairs in a frequent hashed bucket can be frequent.
    hashed = _bucket(keys)
    some = np.flatnonzero((np.bincount(hashed, minlength=1 << 20) >= LEAST_COUNT)[hashed]) if len(keys) > 1 << 14 else np.arange(len(keys))
    keys, hashed = keys[some], hashed[some]
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    pairs = ordered[starts[np.diff(starts, append=len(ordered)) >= LEAST_COUNT]]
    if len(pairs):
        # Looked up by hash, and by search where two frequent pairs have one.
        place = np.zeros(1 << 20, np.int32)
        place[_bucket(pairs)] = np.arange(len(pairs))
        which = place[hashed]
        miss = np.flatnonzero(pairs[which] != keys)
        which[miss] = np.minimum(np.searchsorted(pairs, keys[miss]), len(pairs) - 1)
        number[some] = np.where(pairs[which] == keys, which + first, -1)
    return pairs, number


def _bucket(keys: np.ndarray) -> np.ndarray:
    """A 20-bit hash."""
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).view(np.int64)


def compress(ids: np.ndarray) -> Grammar:
    """Re-Pair grammar of the ids.

    Counts of pairs only fall, but for pairs with a new symbol: pairs are numbered once, a
    rare one (-1) stays rare, and after a pass only the pairs beside new symbols are looked up.
    """
    seen = np.bincount(ids, minlength=1) > 0
    terms, symbols = np.flatnonzero(seen), (np.cumsum(seen) - 1).astype(np.int32)[ids]
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lengths = np.ones(len(terms), dtype=np.int64)
    number = np.full(len(symbols), -1, np.int32)
    pairs = np.zeros(0, np.int64)
    if len(symbols) > 1:
        pairs, number[:-1] = _number(symbols, np.arange(len(symbols) - 1), 0)
    while len(pairs):
        counts = np.bincount(number + 1, minlength=len(pairs) + 1)[1:]
        order = np.argsort(counts, kind="stable")
        rank = np.zeros(len(pairs) + 1, np.int32)  # the last place is number -1
        rank[order] = np.where(counts[order] >= LEAST_COUNT, np.arange(1, len(pairs) + 1), 0)
        own = rank[number]
        # Of overlapping pairs the most frequent is taken, of equal ones (a, a, a) the first.
        hit = np.flatnonzero((own > np.concatenate([[0], own[:-1]])) & (own >= np.concatenate([own[1:], [0]])))
        pays = np.bincount(number[hit], minlength=len(pairs)) >= LEAST_COUNT
        chosen = np.flatnonzero(pays)
        if not len(chosen):
            break
        hit = hit[pays[number[hit]]]
        name = np.zeros(len(pairs), np.int32)
        name[chosen] = len(lengths) + np.arange(len(chosen))
        lefts.append(pairs[chosen] >> 32)
        rights.append(pairs[chosen] & 0xFFFFFFFF)
        lengths = np.concatenate([lengths, lengths[lefts[-1]] + lengths[rights[-1]]])
        symbols[hit] = name[number[hit]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[hit + 1] = False
        symbols, number = symbols[keep], number[keep]
        new = hit - np.arange(len(hit))
        beside = np.zeros(len(symbols) + 1, dtype=bool)
        beside[new] = beside[new - 1] = True  # place -1 is the spare one
        near = np.flatnonzero(beside[: len(symbols) - 1])
        number[-1] = -1
        more, number[near] = _number(symbols, near, len(pairs))
        pairs = np.concatenate([pairs, more])
    return Grammar(terms.astype(np.int64), np.concatenate(lefts), np.concatenate(rights), lengths[len(terms) :], symbols.astype(np.int64))


def expand(g: Grammar, symbols: np.ndarray | None = None) -> np.ndarray:
    """Ids of the grammar's sequence, or of some symbols: the rules are expanded once, then looked up."""
    symbols, base = g.symbols if symbols is None else symbols, len(g.terms)
    rules, owner = np.arange(base, base + len(g.left)), np.arange(len(g.left))
    while (rule := rules >= base).any():
        at = np.cumsum(rule + 1) - (rule + 1)
        out = np.empty(len(rules) + int(rule.sum()), dtype=np.int64)
        out[at[~rule]] = rules[~rule]
        k = rules[rule] - base
        out[at[rule]], out[at[rule] + 1] = g.left[k], g.right[k]
        rules, owner = out, np.repeat(owner, rule + 1)
    sizes = np.ones(base + len(g.left), dtype=np.int32)
    sizes[base:] = g.lengths
    starts = np.arange(len(sizes), dtype=np.int32)
    starts[base:] = base + np.cumsum(sizes[base:]) - sizes[base:]
    flat = g.terms[np.concatenate([np.arange(base), rules])]
    return gather(flat, starts[symbols], sizes[symbols])


def decode_range(g: Grammar, start: int, size: int) -> np.ndarray:
    """``size`` ids from place ``start``: only the symbols that cover them are expanded."""
    ends = np.cumsum(np.concatenate([np.ones(len(g.terms), np.int64), g.lengths])[g.symbols])
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + size, side="left")
    before = int(ends[a - 1]) if a else 0
    base, out, todo = len(g.terms), [], g.symbols[a : b + 1][::-1].tolist()
    while todo:
        x = todo.pop()
        if x < base:
            out.append(x)
        else:
            todo += (g.right[x - base], g.left[x - base])
    return g.terms[np.array(out, dtype=np.int64)][start - before : start - before + size]


def _grammar(row: dict) -> Grammar:
    return Grammar(*(unpack_bits(row[c]) for c in _BLOBS))


def write_ids(docs: DataFrame, path: str, name: str = WORD_FILE, end_id: int = END_ID) -> None:
    """Write the shards of all documents, in ascending doc_id order, to ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        part, shard = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard
            row = [[part], [shard], [sum(sizes)], *([pack_bits(x)] for x in compress(np.concatenate(held))), [list(doc_ids)], [list(sizes)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * len(_BLOBS), pa.list_(pa.int64()), pa.list_(pa.int64())]
            shard += 1
            for x in (held, doc_ids, sizes):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "shard", "n_ids", *_BLOBS, "doc_ids", "sizes"])

        waiting = 0
        for b in byte_slices(batches, "t", 4 << 20):
            ids, counts = enc.encode(b.column("t"))
            # The end id goes behind each document's ids.
            held.append(np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32))
            doc_ids += b.column("doc_id").to_pylist()
            sizes += (counts + 1).tolist()
            waiting += len(held[-1])
            if waiting >= SHARD_IDS:
                yield flush()
                waiting = 0
        if sizes:
            yield flush()

    rows = docs.select("doc_id", text_or_empty().alias("t"))
    tie = F.xxhash64("t")
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(run, _SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers)."""
    shards = spark.read.schema(_SCHEMA).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("total"))  # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", "n_ids").withColumn("shard_start", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    places = places.join(first, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("start"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                ids = expand(_grammar(r)).astype("<u4")
                sizes = np.array(r["sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                place = [pa.array(np.full(len(sizes), r[c], dtype=np.int32)) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays([*place, pa.array(r["doc_ids"], pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())], ["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"])

    decoded = shards.mapInArrow(run, "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return decoded.join(places, ["part", "shard"]).select("doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """Rows (doc_id, ids) of one document: only its shard is read, and only its symbols are expanded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.cumsum(r["sizes"])
                places = [k for k, d in enumerate(r["doc_ids"]) if d == doc_id]
                ids = [decode_range(_grammar(r), int(ends[k]) - r["sizes"][k], r["sizes"][k]) for k in places]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(ids), pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    shards = spark.read.schema(_SCHEMA).parquet(path).where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    return shards.mapInArrow(run, "doc_id long, ids array<bigint>")


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_ids(spark, path)
