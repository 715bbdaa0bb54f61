"""Language identification by compression with per-language raw-content dictionaries.

A text is reduced to its lower-case words (runs of letters alone, joined by spaces) and cut into
blocks of ``BLOCK`` bytes.  For each language a zstandard raw-content dictionary is made
of a bounded sample of labelled texts; each block is compressed with each dictionary and
the language with the smallest total wins.  A text is rejected (``rejected``; the smallest
language is still given) when the second smallest total is less than ``MARGIN`` larger.

Sample (the only bounded part of the fit): of each language the labelled texts in the order of
a hash, those of at most ``SHORT`` characters before longer ones, each whole, as many as
``SAMPLE`` texts and ``DICT_BYTES`` bytes hold (one text at least).  Counts per language come
first, so the candidates kept by the hash are a few times ``SAMPLE`` per language at any corpus
size.  Languages are assumed to be a short list; the dictionaries go to every task.

Edge cases: a null text or one without letters is ``und`` with score 0 and rejected; an
empty table, or one without labels, gives ``und`` everywhere; equal sizes are decided by
the language's name; a very long text is read whole, block by block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, give_back, table

#: The fit: labelled texts per language, length from which a text is a last resort, bytes of a language's dictionary.
SAMPLE, SHORT, DICT_BYTES = 256, 4096, 64 << 10
#: Bytes of a text compressed at a time.
BLOCK = 512
#: Least excess of the second smallest size over the smallest, as a share: of sf0.1's held-out documents
#: all that is this near is of a few words (README).
MARGIN = 0.003
#: The score is 1 - exp(-excess / SCALE).
SCALE = 0.04
LEVEL = 12
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> bytes:
    found = _WORD.findall(text.lower())
    if not all(map(str.isalpha, found)):  # numerals that aren't digits, such as fractions
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    return " ".join(found).encode()


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE, most_bytes: int = DICT_BYTES) -> DataFrame:
    """(lang, k, text): at most ``per_language`` rows of each language by (long, hash), of ``most_bytes`` together or one."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("doc_id", "lang", "text")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows.select("lang", F.lit(1).alias("k"), "text").where("false")
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * per_language / n))))
    unit = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = rows.where(unit < share[F.col("lang")]).select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    few = few.groupBy("lang", "h").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.length("text") > SHORT, "h")
    few = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
    sums = Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    few = few.withColumn("bytes", F.sum(F.octet_length("text") + 1).over(sums))
    return few.where((F.col("bytes") <= most_bytes) | (F.col("k") == 1)).select("lang", "k", "text")


def fit(docs: DataFrame, per_language: int = SAMPLE, most_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw-content dictionary per language: the words of its sample, whole texts."""
    texts: dict[str, list[bytes]] = {}
    for r in sorted(labelled_sample(docs, per_language, most_bytes).collect(), key=lambda r: (r.lang, r.k)):
        texts.setdefault(r.lang, []).append(words(r.text))
    return {lang: b"\n".join(parts) for lang, parts in sorted(texts.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.names = sorted(dictionaries)
        self.coders = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[int]:
        blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]

    def predict(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, rejected)."""
        data = words(text or "")
        if not data or not self.names:
            return "und", 0.0, True
        sizes = np.array(self.sizes(data), dtype=float)
        order = np.argsort(sizes, kind="stable")
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        excess = float(sizes[order[1]] / sizes[order[0]] - 1)
        return self.names[order[0]], float(1 - np.exp(-excess / SCALE)), excess < margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, extra: Iterable[str] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The columns ``extra`` with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages x DICT_BYTES
    extra = list(extra)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for b in byte_slices(batches, "_text"):
            lang, score, rejected = zip(*(model.predict(t, margin) for t in b.column("_text").to_pylist()), strict=True)
            kept = [b.column(f"_{k}") for k in range(len(extra))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)], [*(f"_{k}" for k in range(len(extra))), "lang_pred", "score", "rejected"])

    cols = [F.col(c).alias(f"_{k}") for k, c in enumerate(extra)]
    kinds = ", ".join(f"_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(extra))
    rows = docs.select(*cols, F.col(text_column).alias("_text"))
    out = rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")
    return out.withColumnsRenamed({f"_{k}": c for k, c in enumerate(extra)})


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, text_column: str = "text") -> DataFrame:
    """The rows that aren't rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages x DICT_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for b in byte_slices(batches, text_column):
            yield b.filter(pa.array([not model.predict(t, margin)[2] for t in b.column(text_column).to_pylist()], pa.bool_()))
            give_back()

    return docs.mapInArrow(run, docs.schema)


def held_out():
    """Rows never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = fit(docs.where(~F.col("held_out")))
    return identify(docs, model, extra=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score", "rejected")
