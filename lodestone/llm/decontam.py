"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are lower-case runs of letters and digits.  Every document is searched for the word
``SEED``-grams of the benchmark items; a hit's surroundings (as numbers of the item's
words, other words being -1) are kept as a passage, unless it shares too few words with
the item to reach ``THRESHOLD`` in whatever order they stand.  Every passage kept is aligned
with the item (match 2, other word -1, gap -1), and a document is contaminated if the best
score is at least ``THRESHOLD`` of a full match.

The documents of the kept passages are counted by seed.  Rarity decides only how a passage
is aligned: with a seed in at most ``RARE_FLOOR`` documents it has few equals and is aligned
at once; the others are aligned once per distinct item and passage, and the score is joined
back, so an edited copy in very many documents is found and stays cheap.

Benchmark items go to the tasks in blocks of at most ``BLOCK_WORDS`` words (one pass over
the documents per block; benchmarks of a million words are one pass), so what is broadcast is
bounded; what is counted per seed of a block is bounded by its words, too, and broadcast.  An
alignment spans at most three times its item's words, so long chains of hits are cut into
windows that overlap by as much.

Edge cases: an item with fewer words than a seed matches documents of just these words; null or
wordless items or texts match nothing; an item given twice matches under both ids; repeated
documents give one row per doc_id and item; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, materialize, table, text_or_empty

SEED = 3
RARE_FLOOR = 50
THRESHOLD = 0.5
BLOCK_WORDS = 1_000_000
#: A passage has at most so many times its item's words; an alignment spans three times at most.
WINDOW, SPAN = 12, 3
MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Items:
    """A block of benchmark items: numbered words and sorted seeds."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.number = {w: k for k, w in enumerate(sorted({w for _, ws in rows for w in ws}))}
        self.ids = [i for i, _ in rows]
        self.words = [np.array([self.number[w] for w in ws], dtype=np.int64) for _, ws in rows]
        keys, item, place = [], [], []
        for k, ws in enumerate(self.words):
            own = self.keys(ws)
            keys.append(own)
            item.append(np.full(len(own), k))
            place.append(np.arange(len(own)))
        keys, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, item, place))
        order = np.argsort(keys, kind="stable")
        self.keys_, self.item, self.place = keys[order], item[order], place[order]
        self.bags = [np.unique(ws, return_counts=True) for ws in self.words]
        self.short: dict[tuple[int, ...], list[int]] = {}
        for k, ws in enumerate(self.words):
            if len(ws) < SEED:
                self.short.setdefault(tuple(ws.tolist()), []).append(k)

    def keys(self, ws: np.ndarray) -> np.ndarray:
        """Number of each seed; meaningless where a word is -1."""
        key = np.zeros(max(0, len(ws) - SEED + 1), dtype=np.int64)
        for k in range(SEED):
            key = key * len(self.number) + ws[k : len(ws) - SEED + 1 + k]
        return key

    def numbers(self, text: str) -> np.ndarray:
        get = self.number.get
        return np.array([get(w, -1) for w in words(text)], dtype=np.int64)

    def own_words(self, k: int, passage: np.ndarray) -> tuple[int, np.ndarray]:
        """Most matches an alignment with the item can have, and the passage with other words as -1, none at the ends."""
        known, most = self.bags[k]
        at = np.minimum(np.searchsorted(known, passage), len(known) - 1)
        own = known[at] == passage
        inner = np.flatnonzero(own)
        if not len(inner):
            return 0, passage[:0]
        matches = int(np.minimum(np.bincount(at[own], minlength=len(known)), most).sum())
        return matches, np.where(own, passage, -1)[inner[0] : inner[-1] + 1]

    def passages(self, text: str, threshold: float = 0.0) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(item, first word, seeds hit, words) of the places that share seeds with an item and can score ``threshold``."""
        ws = self.numbers(text)
        if len(ws) < SEED:
            return [(k, 0, np.zeros(0, np.int64), ws) for k in self.short.get(tuple(ws.tolist()), ())]
        if len(self.keys_) == 0:
            return []
        known = np.ones(len(ws) - SEED + 1, dtype=bool)
        for k in range(SEED):
            known &= ws[k : len(ws) - SEED + 1 + k] >= 0
        at = np.flatnonzero(known)
        key = self.keys(ws)[at]
        low, high = np.searchsorted(self.keys_, key, "left"), np.searchsorted(self.keys_, key, "right")
        at, low, high = at[low < high], low[low < high], high[low < high]
        if not len(at):
            return []
        counts = high - low
        entry = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        pos, item, place = np.repeat(at, counts), self.item[entry], self.place[entry]
        begin = pos - place
        found = []
        for k in np.unique(item).tolist():
            mine = np.flatnonzero(item == k)
            mine = mine[np.argsort(begin[mine], kind="stable")]
            size, b = len(self.words[k]), begin[mine]
            for group in np.split(mine, np.flatnonzero(np.diff(b) > size) + 1):
                first, last = max(0, int(begin[group].min()) - size // 2), int(begin[group].max()) + size + size // 2
                seeds = np.unique(self.keys_[entry[group]])
                for start in range(first, max(first + 1, min(last, len(ws)) - SPAN * size), (WINDOW - SPAN) * size):
                    matches, passage = self.own_words(k, ws[start : min(last, start + WINDOW * size)])
                    if matches / size >= threshold:
                        found.append((k, start, seeds, passage))
        return found


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """Best local alignment score (Smith and Waterman 1981) with linear gaps."""
    steps = np.arange(len(passage) + 1) * GAP
    row, best = np.zeros(len(passage) + 1, dtype=np.int64), 0
    for w in item.tolist():
        new = np.zeros(len(passage) + 1, dtype=np.int64)
        new[1:] = np.maximum(row[:-1] + np.where(passage == w, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        # A gap in the item's direction: the best earlier cell less its distance.
        row = np.maximum(new, np.maximum.accumulate(new - steps) + steps)
        best = max(best, int(row.max()))
    return best


def find_passages(docs: DataFrame, items: Items, threshold: float = THRESHOLD) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_WORDS words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in byte_slices(batches, "t"):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("t").to_pylist(), strict=True):
                for k, first, seeds, passage in known.passages(text, threshold):
                    for x, v in zip(out, (doc_id, k, first, seeds, passage.astype(np.int32)), strict=True):
                        x.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "item", "first", "seeds", "passage"])

    return docs.select("doc_id", text_or_empty().alias("t")).mapInArrow(run, "doc_id long, item int, first long, seeds array<bigint>, passage array<int>")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score from 0 to 1, first word) of every document that holds an item."""
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark):
        found = _contaminated_block(docs, Items(block), threshold)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, score double, first long")


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, list[str]]]]:
    """Items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        ws = words(r.text)
        if not ws:
            continue
        if size + len(ws) > BLOCK_WORDS and block:
            yield block
            block, size = [], 0
        block.append((r.item_id, ws))
        size += len(ws)
    if block:
        yield block


def _contaminated_block(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    passages = materialize(find_passages(docs, items, threshold), "passages")
    # One row per seed and item of the block at most: no more than its words.
    hits = passages.select("doc_id", "item", F.explode("seeds").alias("seed")).groupBy("item", "seed").agg(F.count("*").alias("n"))
    rare = hits.where(F.col("n") <= RARE_FLOOR).groupBy("item").agg(F.collect_list("seed").alias("rare"))
    routed = passages.join(F.broadcast(rare), "item", "left").withColumn("few", F.coalesce(F.arrays_overlap("seeds", "rare"), F.lit(False)))
    shared = spark.sparkContext.broadcast(items)  # at most BLOCK_WORDS words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            pairs = zip(b.column("item").to_pylist(), b.column("passage").to_pylist(), strict=True)
            score = [align(known.words[k], np.array(p, dtype=np.int64)) / (MATCH * len(known.words[k])) for k, p in pairs]
            ids = pa.array([known.ids[k] for k in b.column("item").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, ids, pa.array(score, pa.float64())], [*b.schema.names, "item_id", "score"])

    alone = routed.where("few").select("doc_id", "item", "first", "passage")
    alone = alone.mapInArrow(run, "doc_id long, item int, first long, passage array<int>, item_id long, score double").where(F.col("score") >= threshold)
    many = routed.where("NOT few").select("doc_id", "item", "first", "passage")
    once = many.select("item", "passage").distinct().mapInArrow(run, "item int, passage array<int>, item_id long, score double")
    # Written first, so Spark broadcasts it only when it is small and otherwise splits a frequent passage's rows.
    once = materialize(once.where(F.col("score") >= threshold), "scores")
    columns = ["doc_id", "item_id", "score", "first"]
    scored = alone.select(columns).unionByName(many.join(once, ["item", "passage"]).select(columns))
    best = F.max_by(F.col("first"), F.struct("score", -F.col("first"))).alias("first")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark"))
