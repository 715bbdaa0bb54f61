"""Corpus pipeline: language ID, near duplicates, decontamination, secrets, packing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its
predecessor kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``; the last returns the packing.

* ``language_id``: documents the classifier rejects (no letters, or a narrow margin) go;
* ``near_duplicates``: of documents linked by a Jaccard similarity of five-word shingles of
  0.8 or more, the one with the smallest doc_id stays (wordless texts are all kept);
* ``decontamination``: documents that hold a benchmark item go;
* ``secret_scan``: found secrets are replaced by a mask in the text, n_chars follows;
* ``packing``: one row per piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontam, langid, packing, secrets, setjoin
from lodestone.llm.common import materialize, table, without


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(~F.coalesce(langid.held_out(), F.lit(False))))
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = setjoin.link_components(docs, 5, 80, 100)
    # By text as well: of rows that share a doc_id only those with the copied text go.
    gone = materialize(linked.where("component_id <> doc_id").select("doc_id", "text_hash").distinct(), "gone")
    return without(docs, [docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit("")))], gone)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontam.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    gone = materialize(leaks.select("doc_id").distinct(), "leaks")
    return without(docs, [docs["doc_id"]], gone)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Compression, hashing and tokenizing aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
