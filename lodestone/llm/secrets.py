"""Secret scan: three fixed patterns, and random-looking strings by two character Markov models.

Base kinds (leftmost, non-overlapping per kind; failing matches are dropped):
``assign`` (a named value of 12 or more characters), ``access`` (access key of 18 or more)
and ``hex`` (16 or more hexadecimal digits).

The method adds ``random`` spans.  Two first-order Markov chains over characters, with a
start and an end symbol, are trained: one on random strings, one on ordinary identifiers.  Every
run of ``LEAST`` or more key characters that no base span covers is scored, and is a secret if
the log-likelihood ratio per step of random against ordinary is above ``THRESHOLD``.

Labelled samples, each chain an even mixture of two:

* random: seeded strings (``SEEDED`` of each alphabet), and the base spans of the corpus;
* ordinary: seeded identifiers (camel case, snake case, paths, versions of the words in
  ``IDENTIFIER_WORDS``), and the corpus's own words in the same forms (``identifier_forms``).

What looks random but has a form is ordinary, too: chains of UUIDs (for candidates with a hyphen) and of runs and
repeats of the alphabet, digits and keyboard rows are trained on seeded samples, and a candidate that one of them explains as well
(``is_random``) is no secret.  Keys of hexadecimal digits in groups joined by hyphens are therefore not found.

The corpus's counts of character pairs cover every document and word outside base spans and
unlabelled candidates; only the two count tables (alphabet squared) reach the driver.  Rows of
the chains are mixed as probabilities, so the size of the corpus doesn't shift the balance.

Edge cases: null and empty texts have no spans (empty strings, zero counts); offsets are
code points, ends exclusive; repeated rows stay rows; an empty table trains on the seeded
samples alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, give_back, table, text_or_empty

_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")

KINDS = ("assign", "access", "hex", "random")
ALPHABETS = ("0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: Seeded samples: random strings per alphabet and their length, and identifiers.
SEEDED, SEEDED_LENGTH, SEEDED_IDENTIFIERS = 2000, 32, 20_000
#: Labelled sample: words of which ordinary identifiers are made.
IDENTIFIER_WORDS = (
    "account action active address app array async auth base batch block body browser buffer build button cache call check child class click client cloud code column config count create current "
    "data date debug default delete detail device disk docs edit element email enable engine entity error event example export factory field file filter flag font format frame from function get graph group "
    "handler has hash header height host html http icon id image index init input install is item java job join json key label last layout length level library limit line list load local login main manager map max "
    "memory menu message method mode model module name network node number object offset option order output owner package page parent parse path plugin point policy port post prefix process profile public query queue "
    "read record region remote report request reset resource result role root route row run save schema scope search server service session set shape size source src start state status step stream string "
    "system table target task test text thread time title token tool tree type unit update upload url user util value version view volume web width window word work wrapper www xml zone"
)
#: Rows of keys that are typed in order.
KEY_ROWS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Shortest run of key characters that the chains score.
LEAST = 16
#: Log-likelihood ratio per step (nats) from which a candidate is random.
THRESHOLD = 0.6
#: Share of a chain's probability that is spread evenly over all characters.
SMOOTH = 0.01
#: Characters 0..127, one class for all others, the start and the end.
SIZE, START, END = 131, 129, 130

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the fixed patterns, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _candidates(text: str, base: list[Span]) -> list[re.Match]:
    """Runs of at least ``LEAST`` key characters that no base span covers."""
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    found = []
    for m in _CANDIDATE.finditer(text):
        if m.end() - m.start() >= LEAST:
            k = bisect_right(starts, m.start())
            if not k or reach[k - 1] < m.end():
                found.append(m)
    return found


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans with overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _codes(word: str) -> np.ndarray:
    return np.minimum(np.frombuffer(word.encode("utf-32-le"), dtype="<u4"), 128).astype(np.int64)


def _pairs(text: str) -> np.ndarray:
    """Numbers of the steps of every word (run without white space), with start and end."""
    c = np.concatenate([[32], _codes(text), [32]])
    inside = c > 32
    begins, ends = ~inside[:-1] & inside[1:], inside[:-1] & ~inside[1:]
    before, after = np.where(begins, START, c[:-1]), np.where(ends, END, c[1:])
    return (before * SIZE + after)[inside[:-1] | inside[1:]]


#: What stands between two words of an identifier; "" begins the next word with a capital.
_JOINTS = ("_", "", "/", "", ".", "-", "", "_", "7", "", "/", "2", "", "_", "-", "")


def identifier_forms(words: list[str]) -> str:
    """The words as identifiers of three: joined by ``_JOINTS``; every fifth identifier is all capitals."""
    out = []
    for k in range(0, len(words), 3):
        part = [words[k], *((j if j else "") + (w if j else w[:1].upper() + w[1:]) for w, j in zip(words[k + 1 : k + 3], (_JOINTS[k % 16], _JOINTS[(k // 3) % 16]), strict=False))]
        whole = "".join(part)
        out.append(whole.upper() if k % 5 == 4 else whole)
    return " ".join(out)


def _seeded() -> np.ndarray:
    """Step counts of the seeded samples: ordinary identifiers, random strings."""
    rng = random.Random(20)
    known = IDENTIFIER_WORDS.split()
    number = (lambda: str(rng.randrange(100)), lambda: f"{rng.randrange(100):02}", lambda: str(rng.randrange(1990, 2030)), lambda: str(rng.randrange(100, 20000)))
    part = lambda: rng.choice(number)() if rng.random() < 0.12 else rng.choice(known) if rng.random() < 0.9 else rng.choice(known).title()
    ordinary = identifier_forms([part() for _ in range(3 * SEEDED_IDENTIFIERS)])
    strings = " ".join("".join(rng.choices(letters, k=SEEDED_LENGTH)) for letters in ALPHABETS for _ in range(SEEDED))
    return np.stack([np.bincount(_pairs(x), minlength=SIZE * SIZE) for x in (ordinary, strings)])


_LETTERS = re.compile(r"[A-Za-z]+")


def pair_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(label, pair, n) over all documents: label 1 for base spans, 0 for words in the forms of identifiers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), dtype=np.int64)
        for b in byte_slices(batches, "t"):
            for text in b.column("t").to_pylist():
                found = base_spans(text)
                # A candidate that no base pattern covers has no label: it trains neither side.
                labelled = [(s, e) for s, _, e in found] + [m.span() for m in _candidates(text, found)]
                at, rest = 0, []
                for start, end in _union(labelled):
                    rest.append(text[at:start])
                    at = end
                words = _LETTERS.findall(" ".join([*rest, text[at:]]))
                if words:
                    total[0] += np.bincount(_pairs(identifier_forms(words)), minlength=SIZE * SIZE)
                for start, kind, end in found:
                    if kind:  # an assignment also holds its name
                        total[1] += np.bincount(_pairs(text[start:end]), minlength=SIZE * SIZE)
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[label, pair], pa.int64())], ["label", "pair", "n"])

    counts = docs.select(text_or_empty(text_column).alias("t")).mapInArrow(run, "label int, pair int, n long")
    return counts.groupBy("label", "pair").agg(F.sum("n").alias("n"))


def _chain(counts: np.ndarray) -> np.ndarray:
    """Step probabilities of each row; an unseen row is even."""
    seen = counts.sum(axis=1, keepdims=True)
    return SMOOTH / SIZE + (1 - SMOOTH) * np.where(seen > 0, counts / np.maximum(seen, 1), 1 / SIZE)


def train(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Log-likelihood ratio (random against ordinary) of each step, SIZE x SIZE.

    The driver receives at most 2 * SIZE ** 2 counts, whatever the size of the corpus.
    """
    total = np.zeros((2, SIZE, SIZE))
    for r in pair_counts(docs, text_column).collect():
        total[r.label].flat[r.pair] += r.n
    chains = []
    for seeded, own in zip(_seeded().reshape(2, SIZE, SIZE), total, strict=True):
        both = (seeded.sum(axis=1, keepdims=True) > 0) & (own.sum(axis=1, keepdims=True) > 0)
        # A row that only one sample has is that sample's.
        chains.append(np.where(both, (_chain(seeded) + _chain(own)) / 2, _chain(seeded + own)))
    # What random strings never hold says nothing of the next character.
    seen = chains[1].max(axis=1, keepdims=True) > 1 / SIZE + 1e-12
    return np.where(seen, np.log(chains[1] / chains[0]), 0.0)


def score(word: str, ratio: np.ndarray) -> float:
    """Log-likelihood ratio per step, start and end included."""
    c = np.concatenate([[START], _codes(word), [END]])
    return float(ratio[c[:-1], c[1:]].mean())


def _uuids(rng: random.Random) -> list[str]:
    """Random UUIDs, every other one in capitals."""
    groups = (8, 4, 4, 4, 12)
    out = ["-".join("".join(rng.choices(ALPHABETS[0], k=n)) for n in groups) for _ in range(SEEDED)]
    return [u.upper() if k % 2 else u for k, u in enumerate(out)]


def _rows_of_keys() -> list[str]:
    """Every key row forwards, backwards and each of its keys repeated, as it is and in capitals."""
    rows = [x for row in KEY_ROWS for x in (row * 3, row[::-1] * 3)] + [c * SEEDED_LENGTH for row in KEY_ROWS[:2] for c in row]
    return rows + [x.upper() for x in rows]


@lru_cache(maxsize=1)
def formed() -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratios (random against UUIDs, random against rows of keys) of each step, from seeded samples alone."""
    strange = _chain(_seeded()[1].reshape(SIZE, SIZE))
    chains = (_chain(np.bincount(_pairs(" ".join(x)), minlength=SIZE * SIZE).reshape(SIZE, SIZE)) for x in (_uuids(random.Random(21)), _rows_of_keys()))
    uuids, rows = (np.log(strange / c) for c in chains)
    return uuids, rows


def is_random(word: str, ratio: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether neither ordinary identifiers nor UUIDs nor rows of keys explain the word."""
    if score(word, ratio) <= threshold:
        return False
    uuids, rows = formed()
    return score(word, rows) > threshold and ("-" not in word or score(word, uuids) > threshold)


def scan_text(text: str, ratio: np.ndarray, threshold: float = THRESHOLD) -> list[Span]:
    """Base spans and the random ones, by start and then kind."""
    base = base_spans(text)
    extra = [(m.start(), 3, m.end()) for m in _candidates(text, base) if is_random(m[0], ratio, threshold)]
    return sorted(base + extra)


def find_secrets(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, found array<struct<kind, start, end>>."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # SIZE x SIZE numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "t"):
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan_text(t, shared.value, threshold)] for t in b.column("t").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, kind)], ["id", "found"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed("id", id_column)


def redact(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, mask: str = "[secret]", text_column: str = "text") -> DataFrame:
    """The rows with every found span replaced by ``mask``; overlapping spans are one; nulls stay."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # SIZE x SIZE numbers

    def clean(text: str) -> str:
        parts, at = [], 0
        for start, _, end in scan_text(text, shared.value, threshold):
            if start >= at:
                parts += [text[at:start], mask]
            at = max(at, end)
        return "".join([*parts, text[at:]]) if parts else text

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, text_column):
            k = b.schema.get_field_index(text_column)
            texts = [t if t is None else clean(t) for t in b.column(k).to_pylist()]
            yield b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type))
            give_back()

    return docs.mapInArrow(run, docs.schema)


def _joined(kinds: tuple[str, ...]):
    spans = F.col("found") if kinds == KINDS else F.filter("found", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train(docs))
    counts = [F.size(F.expr(f"filter(found, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(_joined(KINDS[:3]), 256).alias("base_sha256"), _joined(KINDS).alias("spans"), counts[3])


def digest(spans: str) -> str:
    """Lower-case hexadecimal SHA-256, as in the query."""
    return hashlib.sha256(spans.encode()).hexdigest()
