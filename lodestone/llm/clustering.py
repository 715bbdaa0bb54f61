"""Centroid clustering of embeddings by weighted deduplication.

Vectors are quantised to integers; equal ones are grouped once, with their number as weight
(counted before the shuffle, so a vector that a third of all rows share is a row per task).
Lloyd's rounds run on the distinct vectors alone: each task assigns its vectors and
returns one row of weighted integer sums per centroid, which are summed by centroid; the
next centroids (k rows) are exact floored means, made on the driver.  At the end assignments are
joined back to the rows by the vector.  A vector with more than one in ``HEAVY`` of all rows is joined
by broadcast (there are fewer than ``HEAVY`` of them, whatever the input), all others by shuffle.

Edge cases: vectors with another number of components, or with a null or non-finite one, are
left out (as are null vectors); quantised components are held to +-2**27, so distances fit a long; ties go to
the smaller centroid; fewer distinct rows than centroids give fewer centroids, equal ones stay
(the later ones empty); seeds with one vec_id are ordered by their vectors; rows with a null vec_id are
clustered, but seed last; repeated rows stay rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import materialize, table

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
BOUND = 1 << 27
HEAVY = 1024


def quantised(embedding: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """Integer vector; null if a component is missing or not finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(BOUND))), F.lit(float(BOUND)))).cast("int"))
    return F.when((F.size(embedding) == dimensions) & ~bad, whole)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each integer row."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = max(int(np.abs(x).max()), int(np.abs(centroids).max()))
    # Floats are exact while every sum stays under 2**53.
    kind = np.float64 if 4 * x.shape[1] * most * most < 1 << 53 else np.int64
    a, c = x.astype(kind), centroids.astype(kind)
    d = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best].astype(np.int64)


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().reshape(-1, dimensions).astype(np.int64)


def centroid_sums(distinct: DataFrame, centroids: list[list[int]], dimensions: int) -> list:
    """One row per non-empty centroid: cluster, n, and the sum of each component."""
    held = np.array(centroids, dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((len(held), dimensions), np.int64), np.zeros(len(held), np.int64)
        for b in batches:
            x, weight = _matrix(b, dimensions), b.column("weight").to_numpy()
            best, _ = nearest(x, held)
            np.add.at(n, best, weight)
            np.add.at(sums, best, x * weight[:, None])
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = distinct.select("vector", "weight").mapInArrow(run, "cluster int, n long, sums array<bigint>")
    exact = "decimal(38,0)"
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k].cast(exact)).alias(f"s{k}") for k in range(dimensions))).collect()


def assigned(distinct: DataFrame, centroids: list[list[int]], dimensions: int) -> DataFrame:
    """vector, weight, cluster, distance."""
    held = np.array(centroids, dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, d = nearest(_matrix(b, dimensions), held)
            yield pa.RecordBatch.from_arrays([b.column("vector"), b.column("weight"), pa.array(best, pa.int32()), pa.array(d)], ["vector", "weight", "cluster", "distance"])

    return distinct.select("vector", "weight").mapInArrow(run, "vector array<int>, weight long, cluster int, distance long")


def cluster(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Per kept row: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid (its components)."""
    kept = rows.select("vec_id", quantised(F.col("embedding"), dimensions, scale).alias("vector")).where("vector IS NOT NULL")
    spark = rows.sparkSession
    distinct = materialize(kept.groupBy("vector").agg(F.count("*").alias("weight")), "distinct")
    key = F.when(F.col("vec_id").isNotNull(), F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    # The first few rows of a sort: each task keeps that many.
    seeds = kept.orderBy(F.asc_nulls_last(key), "vector").limit(clusters).select("vector").collect()
    if not seeds:
        empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>"
        return spark.createDataFrame([], empty).withColumn("vec_id", F.col("vec_id").cast(rows.schema["vec_id"].dataType))
    centroids = [list(r.vector) for r in seeds]
    for _ in range(rounds):
        for r in centroid_sums(distinct, centroids, dimensions):
            centroids[r.cluster] = [int(r[f"s{k}"]) // r.n for k in range(dimensions)]
    found = materialize(assigned(distinct, centroids, dimensions), "assigned")
    total = F.sum(F.col("weight") * F.col("distance"))
    sums = {r.cluster: (r.n, int(r.total)) for r in found.groupBy("cluster").agg(F.sum("weight").alias("n"), total.alias("total")).collect()}
    n, inertia = sum(x[0] for x in sums.values()), sum(x[1] for x in sums.values())
    digests = [(c, sums.get(c, (0, 0))[1], inertia, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest(), v) for c, v in enumerate(centroids)]
    report = spark.createDataFrame(digests, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>")
    heavy = F.col("weight") * HEAVY > n
    match = found.select("vector", "cluster", "distance", heavy.alias("_heavy"))
    # Fewer than HEAVY rows.
    common = kept.join(F.broadcast(match.where("_heavy")), "vector", "left")
    rest = common.where("_heavy IS NULL").select("vec_id", "vector").join(match.where("NOT _heavy"), "vector")
    names = ["vec_id", "cluster", "distance"]
    out = common.where("_heavy").select(*names).unionByName(rest.select(*names))
    # One row per centroid.
    return out.join(F.broadcast(report), "cluster").select(*names, "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def _oracle() -> str:
    near = "{n} AS (SELECT v, x.w, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT q.v, any_value(q.w) AS w, k.c, sum((q.x - k.x) * (q.x - k.x)) AS d FROM q JOIN {k} k USING (p) GROUP BY q.v, k.c) x GROUP BY v, x.w)"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(near.format(n=f"a{r}", k=f"k{r}"))
        if r < ROUNDS:
            sums = f"SELECT a.c, q.p, CAST(sum(q.x * q.w) AS BIGINT) AS t, CAST(sum(q.w) AS BIGINT) AS n FROM a{r} a JOIN q USING (v) GROUP BY a.c, q.p"
            mean = f"SELECT c, p, (t - ((t % n) + n) % n) // n AS x FROM ({sums})"
            steps.append(f"m{r} AS ({mean})")
            steps.append(f"k{r + 1} AS (SELECT k.c, k.p, coalesce(m.x, k.x) AS x FROM k{r} k LEFT JOIN m{r} m USING (c, p))")
    last, final = f"a{ROUNDS}", f"k{ROUNDS}"
    return f"""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT v, count(*) AS w FROM e GROUP BY v), q AS MATERIALIZED (SELECT v, w, unnest(v) AS x, unnest(range(1, {DIMENSIONS + 1})) AS p FROM u),
i AS (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS c FROM e QUALIFY c < {CLUSTERS}),
k0 AS (SELECT c, unnest(v) AS x, unnest(range(1, {DIMENSIONS + 1})) AS p FROM i), {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
z AS (SELECT c, sum(w * d) AS s FROM {last} GROUP BY c), g AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS h FROM {final} GROUP BY c)
SELECT e.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(z.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM z) AS BIGINT) AS inertia, g.h AS centroid_sha256
 FROM e JOIN {last} a USING (v) JOIN z USING (c) JOIN g USING (c)"""


ORACLE = _oracle()
