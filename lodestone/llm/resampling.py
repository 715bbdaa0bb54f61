"""Importance resampling towards a target distribution, by hashed n-grams, in Spark SQL.

Words of a text are runs of digits, letters and characters beyond ASCII, A-Z lower-cased; its
features are all runs of one to ``orders`` words.  A feature's bucket is its crc32 modulo
``buckets``.  One pass over the corpus and the target explodes the n-gram arrays and counts buckets
(summed before the shuffle, so what is shuffled is at most ``buckets`` rows a task).  A bucket's
gain is the floored log ratio of its shares in target and corpus.  A second pass
joins every feature with the table of gains, which has ``buckets`` rows and so can be broadcast, and
sums a document's features; a document is one row, hence no key is hot.

A document's weight is the floored mean of its gains and its score the weight plus Gumbel
noise from a hash of its doc_id.  The share ``percent`` of the documents with ``least_words`` words is
drawn by highest score.  Ranks come from a distributed sort: score and doc_id are dealt by
ranges and sorted inside, and a row's rank is its place behind the rows of the partitions before it;
only one count per partition is summed together.

Edge cases: null and wordless texts have no features and weight 0; ties go to the smaller doc_id;
repeated rows stay rows, with ranks of their own; a null doc_id is hashed as an empty text and comes
last of equals; an empty table gives no rows, an empty target counts as even shares; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import materialize, partitions, table, text_or_empty

BUCKETS, ORDERS, SEED = 10_000, 2, 7
PERCENT, LEAST_WORDS = 25, 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a word: no ASCII but digits and lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), 0)


def n_grams(words: Column, orders: int = ORDERS) -> Column:
    """All runs of 1 to ``orders`` words, joined by one space."""
    grams = [words]
    for k in range(2, orders + 1):
        n = F.greatest(F.size(words) - (k - 1), F.lit(0))
        grams.append(F.zip_with(F.slice(grams[-1], F.lit(1), n), F.slice(words, F.lit(k), n), lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.concat(*grams)


def bucket_of(feature: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.crc32(feature), F.lit(buckets)).cast("int")


def _features(texts: DataFrame, *keys: str | Column, orders: int, buckets: int) -> DataFrame:
    """Keys and a bucket for each feature of ``text``; a null one for texts without.

    ``explode`` would have Spark filter by the array's size first and so make every array twice.
    """
    words = texts.select(*keys, words_of(text_or_empty()).alias("_w"))
    kept = [c for c in words.columns if c != "_w"]
    grams = words.select(*kept, F.size("_w").alias("n_words"), n_grams(F.col("_w"), orders).alias("_g"))
    return grams.select(*kept, "n_words", F.explode_outer("_g").alias("_f")).select(*kept, "n_words", bucket_of(F.col("_f"), buckets).alias("bucket"))


def gain_table(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """(bucket, s, t, gain): at most ``buckets`` rows, those that the corpus or the target has."""
    sides = [_features(x, F.lit(k).alias("side"), orders=orders, buckets=buckets) for x, k in ((docs, 0), (target, 1))]
    count = lambda k: F.sum((F.col("side") == k).cast("long"))
    counts = materialize(sides[0].unionByName(sides[1]).where("bucket IS NOT NULL").groupBy("bucket").agg(count(0).alias("s"), count(1).alias("t")), "buckets")
    total = counts.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    part = lambda own, other: (F.col(own) + 1).cast("double") * F.lit(float(other + buckets))
    return counts.withColumn("gain", F.floor(1000 * F.log(part("t", total[0]) / part("s", total[1]))))


def weigh(docs: DataFrame, gains: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS, seed: int = SEED) -> DataFrame:
    """Per row: _row (its number), doc_id, n_words, n_features, weight, score."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    found = _features(rows, "_row", "doc_id", orders=orders, buckets=buckets)
    # No more rows than buckets.
    joined = found.join(F.broadcast(gains.select("bucket", "gain")), "bucket", "left")
    sums = joined.groupBy("_row", "doc_id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("gains"))
    h = F.conv(F.substring(F.sha2(F.concat_ws("", F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    weight = F.expr("CASE WHEN n_features > 0 THEN (gains - pmod(gains, n_features)) div n_features ELSE 0L END")
    return sums.withColumn("weight", weight).select("_row", "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rank`` from 1 by a distributed sort; rows must differ in ``order`` for one rank each."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    # The number holds the partition above bit 33 and the place inside it below.
    placed = materialize(dealt.withColumn("_n", F.monotonically_increasing_id()), "sorted")
    part, place = F.shiftright("_n", 33), F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + place + 1).drop("_n", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, orders: int = ORDERS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank (null if not drawn)."""
    docs, target = docs.select("doc_id", "text"), target.select("text")
    gains = gain_table(docs, target, buckets, orders)
    scored = materialize(weigh(docs, gains, buckets, orders, seed), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    # The row number splits a doc_id with very many rows.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    best = ranked(scored.where(able), order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return best.unionByName(rest).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = rf"""WITH RECURSIVE bit(n, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bit WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bit WHERE k = 8),
texts AS (SELECT 0 AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM texts),
f AS (SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
d AS (SELECT DISTINCT f FROM f),
x AS (SELECT f, list_transform(range(0, len(hex(encode(f))) // 2), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS b FROM d),
c AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda a, v: xor(a // 256, t[xor(a, v) % 256 + 1])), 4294967295) % {BUCKETS} AS bucket FROM x, crc),
n AS (SELECT side, id, bucket FROM f JOIN c USING (f)),
k AS (SELECT bucket, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) AS t FROM n GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM k) + {BUCKETS}) / ((s + 1) * ((SELECT sum(t) FROM k) + {BUCKETS})))) AS BIGINT) AS gain FROM k),
m AS (SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM n JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
e AS (SELECT doc_id, len(w.w) AS n_words, coalesce(m.n, 0) AS n_features, CASE WHEN m.n > 0 THEN (total - ((total % m.n) + m.n) % m.n) // m.n ELSE 0 END AS weight, CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) AS h
 FROM documents JOIN w ON w.side = 0 AND w.id = doc_id LEFT JOIN m ON m.id = doc_id),
z AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM e),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_words >= {LEAST_WORDS})
SELECT z.doc_id, n_features, weight, score, CASE WHEN r.rank <= {PERCENT} * (SELECT count(*) FROM r) // 100 THEN r.rank END AS rank FROM z LEFT JOIN r USING (doc_id)"""
