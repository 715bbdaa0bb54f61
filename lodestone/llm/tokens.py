"""Fast, exact token ids and token counts with the public tokenizer files.

Texts of an Arrow slice are cut at white space into chunks that the tokenizer treats
independently, and each distinct chunk of the slice is encoded once:

* whole-token shortcut: a vocabulary string that encodes alone as exactly one token is
  proved so offline, once per worker, by encoding the whole vocabulary; chunks among
  those strings are counted directly;
* the rest is merged: chunks of proved characters are cut into pre-tokens and all
  pre-tokens of the slice are merged together, rank by rank, with numpy;
* chunks with other characters, apostrophes or special strings go through the library.

Cutting is exact because no pre-token of these files spans the cut: the word file
drops white space, and in the byte-level file a single space between two non-space
characters always begins a pre-token (texts with other spacing are cut by a pattern).
A character is proved by comparing its ids in several surroundings with the library's.

Edge cases: null is the empty text, with no tokens; a special string inside a text is
one special token, as the library has it by default; repeated rows stay rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, table, text_or_empty

WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"

#: Token limit of the registered count query.
LIMIT = 2048

_NONE = np.int64(2**62)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (a path with a separator is taken as it is)."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def prove_whole_tokens(tok) -> dict[str, int]:
    """Plain strings that ``tok`` encodes alone as one token, with that token's id.

    For every vocabulary entry the bytes it stands for are decoded, encoded again as a
    text of their own, and kept if exactly one token comes back.
    """
    back = {c: b for b, c in enumerate(byte_letters())}
    plain = set()
    for entry in tok.get_vocab(with_added_tokens=False):
        try:
            plain.add(bytes(back[c] for c in entry.removesuffix("</w>")).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    names = sorted(x for x in plain if x and not any(c.isspace() for c in x.lstrip(" ")))
    return {x: e.ids[0] for x, e in zip(names, tok.encode_batch_fast(names, add_special_tokens=False), strict=True) if len(e.ids) == 1}


def gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenate the runs ``ids[start : start + size]``."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class PairTable:
    """(left id, right id) -> (rank, merged id), by open addressing on numpy arrays."""

    def __init__(self, merges: Iterable[tuple[int, int, int]]):
        rows = np.array(list(merges), dtype=np.int64).reshape(-1, 3)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(rows) + 1))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.rank = np.full(1 << self.bits, _NONE, dtype=np.int64)
        self.merged = np.zeros(1 << self.bits, dtype=np.int64)
        wanted, rank = (rows[:, 0] << 32) | rows[:, 1], np.arange(len(rows))
        left, self.probes = np.arange(len(rows)), 0
        while len(left):
            at = self._slot(wanted[left], self.probes)
            empty = self.keys[at] < 0
            self.keys[at[empty]] = wanted[left[empty]]
            won = self.keys[at] == wanted[left]
            self.rank[at[won]], self.merged[at[won]] = rank[left[won]], rows[left[won], 2]
            left, self.probes = left[~won], self.probes + 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, or the slot of no pair."""
        keys = (left << 32) | right
        at = self._slot(keys, 0)
        found = self.keys[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = self._slot(keys[open_], probe)
            found = self.keys[at[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        at[self.keys[at] != keys] = -1
        return at

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.slots(left, right)
        return np.where(at < 0, _NONE, self.rank[at])

    def merge_all(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every word (run of ``ids``) as byte-pair encoding does: its lowest rank first, from the left."""
        done_ids, done_sizes, done_words = [], [], []
        words = np.arange(len(sizes))
        rank = np.full(len(ids), _NONE, dtype=np.int64)
        if len(ids) > 1:
            rank[:-1] = self.ranks(ids[:-1], ids[1:])
        rank[np.cumsum(sizes) - 1] = _NONE
        while len(sizes):
            least = np.minimum.reduceat(rank, np.cumsum(sizes) - sizes)
            going = least < _NONE
            if not going.all():
                keep = np.repeat(going, sizes)
                done_ids.append(ids[~keep])
                done_sizes.append(sizes[~going])
                done_words.append(words[~going])
                ids, rank, sizes, words, least = ids[keep], rank[keep], sizes[going], words[going], least[going]
            if not len(sizes):
                break
            owner = np.repeat(np.arange(len(sizes)), sizes)
            hit = np.flatnonzero(rank == least[owner])
            # Of overlapping pairs (a, a, a) every second one counts, from the left.
            fresh = np.ones(len(hit), dtype=bool)
            fresh[1:] = hit[1:] != hit[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            ids[hit] = self.merged[self.slots(ids[hit], ids[hit + 1])]
            sizes = sizes - np.bincount(owner[hit], minlength=len(sizes))
            keep = np.ones(len(ids), dtype=bool)
            keep[hit + 1] = False
            ids, rank = ids[keep], rank[keep]
            # Only the pairs beside a merged id change; the last id of a word has no pair.
            at = hit - np.arange(len(hit))
            last = np.zeros(len(ids) + 1, dtype=bool)
            last[np.cumsum(sizes) - 1] = True
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near[last[near]]] = _NONE
            near = near[~last[near]]
            rank[near] = self.ranks(ids[near], ids[near + 1])
        if not done_words:
            return ids, sizes
        all_ids, all_sizes, all_words = map(np.concatenate, (done_ids, done_sizes, done_words))
        order = np.empty(len(all_words), dtype=np.int64)
        order[all_words] = np.arange(len(all_words))
        starts = np.cumsum(all_sizes) - all_sizes
        return gather(all_ids, starts[order], all_sizes[order]), all_sizes[order]


class Encoder:
    """Exact ids of many texts at once."""

    def __init__(self, name: str):
        import json

        self.tok = load_tokenizer(name)
        self.byte_level = type(self.tok.pre_tokenizer).__name__ == "ByteLevel"
        with open(tokenizer_path(name), encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = PairTable((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)
        letters = byte_letters()
        self.first = np.array([vocab.get(c, 0) for c in letters], dtype=np.int64)
        self.last = self.first if self.byte_level else np.array([vocab.get(c + "</w>", 0) for c in letters], dtype=np.int64)
        kind = np.full(256, 2, dtype=np.int8)  # 0 letter, 1 digit, 2 other
        kind[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = 0
        kind[ord("0") : ord("9") + 1] = 1
        kind[ord("\n")] = 3
        self.kind = kind
        whole = prove_whole_tokens(self.tok)
        lead = " " if self.byte_level else ""
        self.whole = {x.removeprefix(" ") if self.byte_level else x: i for x, i in whole.items() if x.startswith(lead) and x != " "}
        self.whole_names = pa.array(list(self.whole), pa.string())
        self.whole_ids = np.array(list(self.whole.values()), dtype=np.int64)
        proved = "".join(re.escape(c) if ord(c) < 0x80 else c for c in self._prove_characters())
        #: Byte-level chunks may hold single line ends, each a pre-token of its own.
        self.proved = rf"^[{proved}]+(?:\n[{proved}]+)*$" if self.byte_level else f"^[{proved}]+$"
        spaces = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
        self.loose = rf"^ | $|{spaces} | {spaces}"

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _prove_characters(self) -> list[str]:
        """ASCII characters and letters beyond of which our own cutting and merging gives the library's ids."""
        tried = [chr(c) for c in range(0x21, 0x250) if chr(c) not in "'|" and not chr(c).isspace() and (c < 0x7F or chr(c).isalpha())]
        forms = [f(c) for c in tried for f in (str, "x{0}y".format, "{0}1{0}".format, ",{0}{0},".format)]
        lead = " " if self.byte_level else ""
        theirs = self._library([lead + x for x in forms])
        ids, sizes = self._merge(pa.array(forms, pa.string()))
        ends = np.cumsum(sizes)
        same = [ids[e - n : e].tolist() == t for e, n, t in zip(ends, sizes, theirs, strict=True)]
        return [c for k, c in enumerate(tried) if all(same[4 * k : 4 * k + 4])]

    def _merge(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number per chunk; chunks of proved characters only."""
        if not self.byte_level:
            chunks = pc.utf8_lower(chunks)
        else:
            chunks = pc.binary_join_element_wise(pa.scalar(" "), chunks, "")
        raw = chunks.cast(pa.large_binary())
        ends = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        kind = self.kind[data]
        begins = np.ones(len(data), dtype=bool)
        begins[1:] = kind[1:] != kind[:-1]
        if self.byte_level:
            begins[ends[:-1] + 1] = False  # the leading space belongs to the first pre-token
        else:
            begins |= kind == 1
        begins[ends[:-1]] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(data)))
        ids = self.first[data]
        ids[starts + sizes - 1] = self.last[data[starts + sizes - 1]]
        ids, merged = self.pairs.merge_all(ids, sizes)
        tokens = np.concatenate([[0], np.cumsum(merged)])
        return ids, np.diff(tokens[np.searchsorted(starts, ends)])

    def _encode_distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and sizes of distinct chunks; a chunk stands for itself after a space if byte-level."""
        n = len(chunks)
        found = pc.index_in(chunks, value_set=self.whole_names).fill_null(-1).to_numpy(zero_copy_only=False)
        sizes = np.ones(n, dtype=np.int64)
        rest = np.flatnonzero(found < 0)
        some = chunks.take(pa.array(rest))
        plain = pc.match_substring_regex(some, self.proved).to_numpy(zero_copy_only=False).astype(bool)
        own, odd = rest[plain], rest[~plain]
        own_ids, own_sizes = self._merge(some.filter(pa.array(plain))) if len(own) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        lead = " " if self.byte_level else ""
        odd_ids = self._library([lead + x for x in some.filter(pa.array(~plain)).to_pylist()])
        sizes[own] = own_sizes
        sizes[odd] = [len(x) for x in odd_ids]
        flat = np.concatenate([self.whole_ids, own_ids, np.array([i for x in odd_ids for i in x], dtype=np.int64)])
        starts = found.astype(np.int64)
        starts[own] = len(self.whole_ids) + np.cumsum(own_sizes) - own_sizes
        starts[odd] = len(self.whole_ids) + len(own_ids) + np.cumsum(sizes[odd]) - sizes[odd]
        return gather(flat, starts, sizes), sizes

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Chunks of all texts, flat, and their number per text."""
        lists = pc.ascii_split_whitespace(texts)
        flat, counts = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        if pc.any(pc.equal(pc.binary_length(flat), 0)).as_py():  # white space at an end gives an empty chunk
            full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[full], minlength=len(counts))
            flat = flat.filter(pa.array(full))
        return flat, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, flat, and their number per text."""
        return self._encode_bytes(texts) if self.byte_level else self._join(*self._cut(texts))

    def _join(self, chunks: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coded = chunks.dictionary_encode()
        ids, sizes = self._encode_distinct(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        tokens = np.concatenate([[0], np.cumsum(sizes[at])])
        return gather(ids, starts[at], sizes[at]), np.diff(tokens[np.concatenate([[0], np.cumsum(counts)])])

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens per text, without building the ids of the texts (word file)."""
        chunks, counts = self._cut(texts)
        coded = chunks.dictionary_encode()
        _, sizes = self._encode_distinct(coded.dictionary)
        tokens = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy(zero_copy_only=False)])])
        return np.diff(tokens[np.concatenate([[0], np.cumsum(counts)])])

    def _encode_bytes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        loose = pc.match_substring_regex(texts, self.loose).to_numpy(zero_copy_only=False).astype(bool)
        between = re.compile(r"(?<=\S) (?=\S)")
        if loose.any():
            cut = [between.split(t) if o else t.split(" ") for t, o in zip(texts.to_pylist(), loose, strict=True)]
            counts = np.array([len(c) for c in cut])
            flat = pa.array([x for c in cut for x in c], pa.string())
        else:
            lists = pc.split_pattern(texts, " ")
            flat, counts = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        # A text's first chunk has no space before it: encoded by the library, in place of the chunk's own ids.
        firsts = np.cumsum(counts) - counts
        heads = self._library(flat.take(pa.array(firsts)).to_pylist())
        coded = flat.dictionary_encode()
        ids, sizes = self._encode_distinct(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        head_sizes = np.array([len(h) for h in heads], dtype=np.int64)
        run_starts, run_sizes = starts[at], sizes[at]
        run_starts[firsts] = len(ids) + np.cumsum(head_sizes) - head_sizes
        run_sizes[firsts] = head_sizes
        ids = np.concatenate([ids, np.array([i for h in heads for i in h], dtype=np.int64)])
        tokens = np.concatenate([[0], np.cumsum(run_sizes)])
        return gather(ids, run_starts, run_sizes), np.diff(tokens[np.concatenate([[0], np.cumsum(counts)])])


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per worker and file."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


def count_tokens(docs: DataFrame, name: str = WORD_FILE, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        for b in byte_slices(batches, "t"):
            n = enc.encode(b.column("t"))[1] if enc.byte_level else enc.counts(b.column("t"))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("t")).withColumn("n_bytes", F.octet_length("t").cast("long"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
