"""N-gram Jaccard join: partitioned signatures by the pigeonhole principle, exact verification.

A document's set is its distinct word shingles (64-bit hashes; two different shingles of
one pair of documents agree with a chance of about 1e-13).  Equal sets are one node.

Candidates.  Node sizes are split into bands.  Within band b a similar pair differs in at
most H(b) shingles.  The universe of shingles is hashed into segments, each indexed whole (it
covers one difference) or with its one-deletion neighbourhood (it covers two).  Where the
segments cover H(b) + c, the agreeing ones of a similar pair weigh c or more.  So a node with
fewer than c empty whole segments indexes only the subset of the others: at least one of them
still agrees.  Nodes with c or more index all.  A cost model with the band's node count chooses
the kinds and c (signatures written against chance agreements of unrelated nodes, which are
mostly those of empty segments).  A node is indexed in its own band, and in the next lower one
if a similar smaller node may be there.

Links.  Signatures that at least two nodes share form buckets; buckets with the same nodes are
one.  Nodes of a bucket are compared by sketches (a parity bit per hashed shingle, a few bits
a shingle: the differing bits are never more than the differing shingles, so nothing similar
is lost, and dissimilar sets rarely pass at any length).  The first round compares each node in
two of its buckets, the other two the open pairs of all buckets: the nodes outside a bucket's
largest component with all others.  The first two rounds verify a spanning forest of what
passes, closest pairs first; the last one verifies every open pair that passes, so no link
that would join two components is missed.  Pairs inside a component are never expanded.  Large
buckets are handled in blocks of ``BUCKET_BLOCK`` nodes.

Everything between rounds is a table in the shared folder; nothing is collected but counts.

Edge cases: null or wordless text has the empty set, and links with nothing; a text with
fewer words than a shingle is one shingle; equal texts are one node, so repeated rows stay
rows and share a component; rows that share a doc_id but not the text are nodes of their own;
a group of null ids alone has a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, discard, hash_filter, materialize, maybe_in, partitions, table, text_or_empty

#: Band limits grow by this ratio.
BAND_RATIO = 1.4
#: Nodes of a bucket compared at a time, and their shingles.
BUCKET_BLOCK, BLOCK_SHINGLES = 1024, 8 << 20
#: A sketch has the least power of two of parity bits that is so many a shingle, and so many in all.
SKETCH_RATIO, SKETCH_LEAST = 2, 256
#: Words (and set fingerprints) remembered by a task.
REMEMBER = 100_000
_U = np.uint64
_GOLD, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBER:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _Words()


def forget_words() -> None:
    """Free the word cache at the end of a task: its worker lives on."""
    _WORDS.clear()


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word k-shingles; only A-Z are lower-cased."""
    known = _WORDS
    words = np.array([known[w] for w in text.encode().lower().split()], dtype=_U)
    if not len(words):
        return words
    h = mix(words[: max(1, len(words) - k + 1)] + _GOLD)
    for j in range(1, min(k, len(words))):
        h = mix(h * _GOLD + words[j : j + len(h)])
    return np.unique(h + _U(min(k, len(words))))


class Bands:
    """Size bands, and in each the numbers of whole and of one-deletion segments and their slack."""

    def __init__(self, num: int, den: int, allocation: dict[int, tuple[int, int, int]] | None = None):
        self.num, self.den, self.allocation = num, den, allocation or {}
        self.upper = [1]
        while self.upper[-1] < 1 << 40:
            self.upper.append(int(self.upper[-1] * BAND_RATIO) + 1)
        self.edges = np.array(self.upper)

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size))

    def least(self, size: int) -> int:
        """Smallest size that may be similar to ``size``."""
        return -(-size * self.num // self.den)

    def differences(self, band: int) -> int:
        """Most differences of a similar pair whose smaller node is in the band."""
        small = self.upper[band]
        return (self.den - self.num) * (small + small * self.den // self.num) // (self.den + self.num)

    def segments(self, band: int) -> tuple[int, int, int]:
        """(whole, one-deletion, slack): whole + 2 * one-deletion = differences + slack."""
        return self.allocation.get(band, (self.differences(band) + 1, 0, 1))

    def allocate(self, counts: dict[int, int]) -> Bands:
        """Choose the kinds and the slack by cost: signatures of the band's nodes plus chance agreements."""
        chosen = {}
        for band, n in counts.items():
            most = self.differences(band)
            size = max(1, self.upper[band - 1] if band else 1)
            options = []
            for slack in [1, *(2**k for k in range(1, most.bit_length()))]:
                cover = most + slack
                load, all_deletions = size / cover, cover // 2
                for deletions in sorted({0, all_deletions // 4, all_deletions // 2, all_deletions}):
                    whole = cover - 2 * deletions
                    empties = whole * np.exp(-load)
                    # Chance that a node has ``slack`` empty segments and so indexes them (Poisson).
                    terms = -empties + np.arange(slack) * np.log(max(empties, 1e-300)) - np.cumsum(np.log(np.maximum(np.arange(slack), 1)))
                    indexed = max(0.0, 1 - float(np.exp(terms).sum()))
                    signatures = n * (whole + deletions * (2 * load + 1))
                    chance = n * n / 2 * (indexed**2 * whole * np.exp(-2 * load) + deletions * (np.exp(-2 * load) * (1 + 2 * load)) ** 2)
                    options.append((signatures + chance, whole, deletions, slack))
            chosen[band] = min(options)[1:]
        return Bands(self.num, self.den, chosen)

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """Signatures of a set, in its own band and perhaps in lower ones."""
        found = []
        for band in range(self.band(self.least(len(tokens))), self.band(len(tokens)) + 1):
            if self.differences(band):  # else similar sets are equal
                found.append(self._signatures(tokens, band, *self.segments(band)))
        return np.concatenate(found) if found else np.zeros(0, _U)

    @staticmethod
    def _signatures(tokens: np.ndarray, band: int, whole: int, deletions: int, slack: int) -> np.ndarray:
        salt = mix(np.array([band + 1], dtype=_U))[0]
        # One-deletion segments are twice as wide.
        slot = (mix(tokens ^ salt) >> _U(11)) % _U(whole + 2 * deletions)
        segment = np.where(slot < whole, slot, whole + (slot - _U(whole)) // _U(2)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        value = mix(tokens[order] * _GOLD + salt)
        ends = np.searchsorted(segment[order], np.arange(whole + deletions), side="right")
        sums = np.concatenate([[_U(0)], np.cumsum(value, dtype=_U)])
        total = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
        name = mix(np.arange(whole + deletions, dtype=_U) * _GOLD + salt)
        whole_name = mix(total + name)
        empty = (np.diff(ends, prepend=0) == 0) & (np.arange(whole + deletions) < whole)
        if 0 < empty.sum() < slack:
            whole_name = whole_name[~empty]
        out = [whole_name]
        if deletions:
            at = segment[order]
            inner = at >= whole
            out.append(mix(total[at[inner]] - value[inner] + name[at[inner]]))
        return np.unique(np.concatenate(out))


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the shingles on each of the hashed bits; the halves of a sketch, xored, are the sketch half as wide."""
    bits = SKETCH_LEAST
    while bits < SKETCH_RATIO * len(tokens):
        bits *= 2
    parity = np.bincount((mix(tokens + _MIX1) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _sketch_rows(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of 64-bit words, folded to the narrowest of them."""
    least = min(map(len, sketches))
    rows = np.empty((len(sketches), least // 8), dtype=_U)
    for k, stored in enumerate(sketches):
        rows[k] = np.bitwise_xor.reduce(np.frombuffer(stored, dtype=_U).reshape(-1, least // 8), axis=0)
    return rows


def _fingerprint(tokens: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def describe(docs: DataFrame, k: int) -> DataFrame:
    """Per row: doc_id, n, set fingerprint (two longs), text_hash, sketch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "t"):
            sizes, prints, sketches = [], [], []
            for text in b.column("t").to_pylist():
                tokens = shingles(text, k)
                sizes.append(len(tokens))
                prints.append(_fingerprint(tokens))
                sketches.append(sketch(tokens))
            both = np.frombuffer(b"".join(prints), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), b.column("text_hash"), pa.array(sketches, pa.binary())], ["doc_id", "n", "fp1", "fp2", "text_hash", "sketch"])
        forget_words()

    rows = docs.select("doc_id", text_or_empty().alias("t")).withColumn("text_hash", F.xxhash64("t"))
    return rows.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, text_hash long, sketch binary")


def sign(docs: DataFrame, k: int, bands: Bands) -> DataFrame:
    """(sig, fp1) of the sets; of equal sets in one task the first is signed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in byte_slices(batches, "t", 4 << 20):
            sigs, prints = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text in b.column("t").to_pylist():
                tokens = shingles(text, k)
                name = _fingerprint(tokens)
                if name in seen or not len(tokens):
                    continue
                if len(seen) >= REMEMBER:
                    seen.clear()
                seen.add(name)
                sigs.append(bands.signatures(tokens).view(np.int64))
                prints.append(np.full(len(sigs[-1]), np.frombuffer(name, dtype=np.int64)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(prints))], ["sig", "fp1"])
        forget_words()

    return docs.select(text_or_empty().alias("t")).mapInArrow(run, "sig long, fp1 long")


def node_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, tokens: sorted 64-bit hashes as bytes) of the wanted nodes (node, own: doc_id, text_hash).

    A filter of bounded size, whatever the number of nodes, keeps nearly all other texts from
    being shingled and shuffled; the join behind it is exact.
    """
    rows = docs.select(F.col("doc_id").alias("own"), text_or_empty().alias("t")).withColumn("text_hash", F.xxhash64("t"))
    rows = maybe_in(rows, F.col("text_hash"), hash_filter(wanted.select("text_hash"))).where("_maybe").select("own", "text_hash", "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "t", 4 << 20):
            sets = [shingles(t, k) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("own"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["own", "text_hash", "n", "tokens"])
        forget_words()

    sets = rows.mapInArrow(run, "own long, text_hash long, n long, tokens binary").withColumnsRenamed({"own": "_own", "text_hash": "_hash"})
    same = F.col("_own").eqNullSafe(F.col("own")) & (F.col("_hash") == F.col("text_hash"))
    return sets.join(wanted, same).select("node", "n", "tokens")


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * intersection >= num * union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices([batch], "ta"):
                a_ids, b_ids = [], []
                for a, c, ta, tc in zip(*(b.column(x).to_pylist() for x in ("a", "b", "ta", "tb")), strict=True):
                    x, y = np.frombuffer(ta, _U), np.frombuffer(tc, _U)
                    both = np.sort(np.concatenate([x, y]), kind="stable")
                    shared = int((both[1:] == both[:-1]).sum())
                    if den * shared >= num * (len(both) - shared):
                        a_ids.append(a)
                        b_ids.append(c)
                yield pa.RecordBatch.from_arrays([pa.array(a_ids, pa.int64()), pa.array(b_ids, pa.int64())], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    near = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable, for every node of an edge.

    Labels fall to the least label of the neighbours and then to that label's own label,
    so long chains shorten quickly; each step is a table in the shared folder.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        # A label's own label, and the least label seen by any node that carries it (hooking).
        seen = labels.join(near, "node").withColumn("low", F.least("comp", "c"))
        hook = seen.groupBy(F.col("comp").alias("l")).agg(F.min("low").alias("hooked"))
        up = labels.select(F.col("node").alias("l"), F.col("comp").alias("own"))
        step = hook.join(up, "l", "left").select("l", F.least("hooked", F.coalesce("own", "hooked")).alias("to"))
        new = materialize(seen.join(step.withColumnRenamed("l", "comp"), "comp").select("node", F.least("low", "to").alias("comp")), "labels")
        changed = new.join(labels.withColumnRenamed("comp", "old"), "node").where("comp <> old").limit(1).count()
        discard(labels)
        labels = new
        if not changed:
            discard(both)
            return labels


def _compare(nodes: np.ndarray, sizes: np.ndarray, comps: np.ndarray, sides: np.ndarray, rows: np.ndarray, num: int, den: int, forest: bool) -> list[tuple[int, int]]:
    """Pairs of one bucket block whose sketches allow a link and that aren't connected.

    ``sides``: 0 is compared with all later rows; otherwise 1 (outside the bucket's largest
    component) with 2 (any) and 3 (also outside; each such pair is met twice and taken once).
    With ``forest`` a spanning forest of those pairs, closest first.
    """
    one, two, far = [], [], []
    for i in np.flatnonzero(sides < 2).tolist():
        if sides[i]:
            j = np.flatnonzero((sides == 2) | ((sides == 3) & (nodes > nodes[i])))
        else:
            j = np.arange(i + 1, len(nodes))
        j = j[(comps[j] != comps[i]) & (sizes[j] * den >= sizes[i] * num) & (sizes[i] * den >= sizes[j] * num)]
        if len(j):
            apart = np.bitwise_count(rows[j] ^ rows[i]).sum(axis=1, dtype=np.int64) * (num + den)
            most = (den - num) * (sizes[j] + sizes[i])
            near = apart <= most
            j = j[near]
            one.append(np.full(len(j), i))
            two.append(j)
            far.append(apart[near] / most[near])
    if not one:
        return []
    one, two, far = np.concatenate(one), np.concatenate(two), np.concatenate(far)
    if forest:
        order = np.lexsort((np.maximum(nodes[one], nodes[two]), np.minimum(nodes[one], nodes[two]), far))
        one, two = one[order], two[order]
        top: dict[int, int] = {}

        def find(c: int) -> int:
            while top.setdefault(c, c) != c:
                top[c] = c = top[top[c]]
            return c

        taken, left = [], len(np.unique(comps[np.concatenate([one, two])])) - 1
        for k, (x, y) in enumerate(zip(comps[one].tolist(), comps[two].tolist(), strict=True)):
            x, y = find(x), find(y)
            if x != y:
                top[x] = y
                taken.append(k)
                left -= 1
                if not left:
                    break
        one, two = one[taken], two[taken]
    return list(zip(np.minimum(nodes[one], nodes[two]).tolist(), np.maximum(nodes[one], nodes[two]).tolist(), strict=True))


def _near_pairs(rows: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """(a, b, bucket) of ``_compare`` for rows dealt by (bucket, other) and sorted: bucket, other, side, node, n, comp, sketch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            bucket, other = t["bucket"].to_numpy(), t["other"].to_numpy()
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (other[1:] != other[:-1])) + 1
            starts = [0, *cuts.tolist()]
            ends = [*cuts.tolist(), len(bucket)]
            if not last:  # the last block may go on in the next batch
                held[:] = t.slice(starts[-1]).to_batches()
                starts, ends = starts[:-1], ends[:-1]
            else:
                held.clear()
            nodes, sizes, comps, sides = (t[c].to_numpy() for c in ("node", "n", "comp", "side"))
            found: list[tuple[int, int, int]] = []
            for s, e in zip(starts, ends, strict=True):
                if e - s > 1:
                    sketches = _sketch_rows(t["sketch"].slice(s, e - s).to_pylist())
                    found += ((*x, bucket[s]) for x in _compare(nodes[s:e], sizes[s:e], comps[s:e], sides[s:e], sketches, num, den, forest))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], ["a", "b", "bucket"])

        for b in batches:
            held.append(b)
            yield from flush(False)
        yield from flush(True)

    return rows.mapInArrow(run, "a long, b long, bucket long")


def _blocks(count: Column, shingles_: Column) -> Column:
    return F.ceil(F.greatest(count / F.lit(BUCKET_BLOCK), shingles_ / F.lit(BLOCK_SHINGLES))).cast("int")


def _dealt(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows for ``_near_pairs`` with their sketches: (bucket, other) is one block."""
    with_sketch = rows.join(nodes.select("node", "sketch"), "node")
    return with_sketch.select("bucket", "other", "side", "node", "n", "comp", "sketch").repartition(partitions(rows.sparkSession), "bucket", "other").sortWithinPartitions("bucket", "other", "node")


def _first_blocks(buckets: DataFrame) -> DataFrame:
    """Each node in the least and the greatest of its buckets, those cut into blocks that are compared inside."""
    ends = buckets.groupBy("node", "n").agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    rows = ends.select("node", "n", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"), F.count("*").alias("k")).where("k > 1").drop("k")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    return rows.join(sizes, "bucket").select("bucket", block.alias("other"), F.lit(0).alias("side"), "node", "n", F.col("node").alias("comp"))


def _open_blocks(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets with several components: nodes outside the largest one against all, in blocks."""
    rows = buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by_comp = rows.groupBy("bucket", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    largest = F.max(F.struct("k", "s", "comp"))
    whole = by_comp.groupBy("bucket").agg(F.count("*").alias("several"), F.sum("k").alias("k"), F.sum("s").alias("s"), largest.alias("m")).where("several > 1")
    whole = whole.select("bucket", F.col("m.comp").alias("most"), _blocks(F.col("k"), F.col("s")).alias("all_blocks"), _blocks(F.col("k") - F.col("m.k"), F.col("s") - F.col("m.s")).alias("out_blocks"))
    rows = rows.join(whole, "bucket").withColumn("outside", F.col("comp") != F.col("most"))
    h = F.xxhash64("node")
    small = rows.where("all_blocks = 1").select("bucket", F.lit(0).cast("long").alias("other"), F.lit(0).alias("side"), "node", "n", "comp")
    large = rows.where("all_blocks > 1")
    place = lambda own, to: (own.cast("long") * F.lit(1 << 31) + to + 1).alias("other")
    one = large.where("outside").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)))
    one = one.select("bucket", place(F.pmod(h, F.col("out_blocks")), F.col("to")), F.lit(1).alias("side"), "node", "n", "comp")
    two = large.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)))
    two = two.select("bucket", place(F.col("to"), F.pmod(h, F.col("all_blocks"))), F.when(F.col("outside"), 3).otherwise(2).alias("side"), "node", "n", "comp")
    return small.unionByName(one).unionByName(two)


def link_components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, text_hash (``xxhash64`` of the text, null as empty).

    Two rows link when den * intersection >= num * union.
    """
    docs = docs.select("doc_id", "text")
    described = materialize(describe(docs, k), "described")
    bands = Bands(num, den)
    edges = F.array(*(F.lit(x) for x in bands.upper))
    band = F.size(F.filter(edges, lambda e: e < F.col("n")))
    # One row per band.
    counts = {r.band: r.c for r in described.where("n > 0").groupBy(band.alias("band")).agg(F.count("*").alias("c")).collect()}
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = described.where("n > 0").groupBy("fp1", "fp2").agg(first.alias("s"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).select("fp1", "fp2", "s.doc_id", "s.text_hash", "n", "sketch")
    # A node is named by its doc_id, or by its set where the doc_id is null or has several texts.
    alone = F.count("*").over(Window.partitionBy("doc_id")) == 1
    nodes = nodes.withColumn("node", F.when(F.col("doc_id").isNotNull() & alone, F.col("doc_id")).otherwise(F.xxhash64("fp1", "fp2")))
    nodes = materialize(nodes, "nodes")

    same = Window.partitionBy("sig")
    signed = sign(docs, k, bands.allocate(counts))
    shared = signed.withColumn("low", F.min("fp1").over(same)).withColumn("high", F.max("fp1").over(same)).where("low < high").select("sig", "fp1", "low", "high").distinct()
    # Signatures with the same nodes are one bucket.
    shared = shared.withColumn("all", F.bit_xor(F.xxhash64("fp1")).over(same)).select(F.xxhash64("low", "high", "all").alias("bucket"), "fp1").distinct()
    buckets = materialize(shared.join(nodes.select("fp1", "node", "n"), "fp1").select("bucket", "node", "n"), "buckets")
    tested = links = labels = None
    used, open_buckets = [buckets], buckets
    for number in range(3):  # two buckets of each node, then all: a forest, and every open pair
        rows = _first_blocks(buckets) if number == 0 else _open_blocks(open_buckets, labels)
        near = materialize(_near_pairs(_dealt(rows, nodes), num, den, number < 2), "near")
        if number == 1:  # a bucket where nothing passes now has nothing left to pass
            open_buckets = buckets.join(near.select("bucket").distinct(), "bucket", "left_semi")
        pairs = near.select("a", "b").distinct()
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = materialize(nodes.join(ends, "node", "left_semi").select("node", F.col("doc_id").alias("own"), "text_hash"), "wanted")
        sets = materialize(node_sets(docs, wanted, k), "tokens")
        more = materialize(verify(pairs, sets, num, den), "links")
        if labels is None or more.limit(1).count():
            links = more if links is None else links.unionByName(more)
            used += [] if labels is None else [labels]
            labels = components(links)
        tested = pairs if tested is None else tested.unionByName(pairs)
        discard(wanted, sets)
        used += [near, pairs, more]
    discard(*used)
    smallest = nodes.join(labels, "node").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(labels, "node", "left").join(smallest, "comp", "left").select("fp1", "fp2", F.coalesce("component_id", F.col("doc_id")).alias("component_id"))
    ids = described.join(named, ["fp1", "fp2"], "left")
    return ids.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"), 3, 90, 100).drop("text_hash")


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                                     WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 90 * (na.n + nb.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
