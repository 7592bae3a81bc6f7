"""Registered queries over vectors: profile, duplicates, clusters and choice of k."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpuslab.functions import vectors as vx
from corpuslab.functions.vectors import to_matrix
from corpuslab.operators import cluster as cl
from corpuslab.operators import dedup, profile
from corpuslab.operators import select_k as sk
from corpuslab.operators.bounded import assign_to_table, run_bounded
from corpuslab.operators.ordering import hash_sample, id_block
from corpuslab.plans import jobs
from corpuslab.plans import standins as st
from corpuslab.plans.standins import norm_sql, rounded, rounded_sql, square_sql, table
from corpuslab.sources import comments as src

QUERIES: dict[str, tuple] = {}
LLOYD_K, LLOYD_ROUNDS, SCAN_K = 5, 2, 12
BOUNDED_K, BOUNDED_ROUNDS = 20, 4


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


def _round(df, *columns, digits: int = 6):
    return df.withColumns({c: rounded(F.col(c), digits) for c in columns})


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


@register("embedding_norms", f"SELECT vec_id, {rounded_sql(norm_sql('embedding'))} AS norm FROM embeddings")
def embedding_norms(spark, sf):
    return _round(profile.norms(_emb(spark, sf), "vec_id"), "norm")


@register("norm_range", f"""
WITH n AS (SELECT {norm_sql('embedding')} * (1 + label) AS v FROM embeddings)
SELECT {rounded_sql('min(v)')} AS min_norm, {rounded_sql('max(v)')} AS max_norm, {rounded_sql('avg(v)')} AS mean_norm FROM n""")
def norm_range(spark, sf):
    norms = _emb(spark, sf).select((vx.norm(F.col("embedding")) * (1 + F.col("label"))).alias("v"))
    out = norms.agg(F.min("v").alias("min_norm"), F.max("v").alias("max_norm"), F.avg("v").alias("mean_norm"))
    return _round(out, "min_norm", "max_norm", "mean_norm")


@register("l2_normalize", f"""
WITH scaled AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3 * label) AS v FROM embeddings),
sized AS (SELECT vec_id, v, {norm_sql('v')} AS n FROM scaled),
cells AS (SELECT vec_id, n, unnest(range(0, len(v))) AS dim, unnest(v) AS x FROM sized)
SELECT vec_id, dim, {rounded_sql('CAST(CAST(CASE WHEN n > 0 THEN x / n ELSE x END AS FLOAT) AS DOUBLE)')} AS value FROM cells""")
def l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3 * F.col("label"))
    unit = cl.l2_normalize(_emb(spark, sf).select("vec_id", scaled.alias("embedding")))
    cells = unit.select("vec_id", F.posexplode("embedding").alias("dim", "value"))
    return cells.withColumn("value", rounded(F.col("value").cast("double")))


@register("sanity_checks", f"""
WITH {st.DOUBLED_SQL}, cells AS (SELECT unnest(embedding)::DOUBLE AS x FROM doubled),
elements AS (
  SELECT count(*) FILTER (WHERE isnan(x)) AS nan_count, count(*) FILTER (WHERE isinf(x)) AS inf_count,
    min(x) AS lo, max(x) AS hi, avg(x) AS mu, stddev_pop(x) AS sd, count(*) AS cells FROM cells),
rows AS (
  SELECT count(*) AS n, count(DISTINCT embedding) AS u, count(DISTINCT vec_id) AS ids, min(len(embedding)) AS d0,
    max(len(embedding)) AS d1, min({norm_sql('embedding')}) AS n0, max({norm_sql('embedding')}) AS n1,
    avg({norm_sql('embedding')}) AS nm FROM doubled)
SELECT n AS total_embeddings, nan_count, inf_count, nan_count > 0 OR inf_count > 0 AS has_missing,
  d0 = 64 AND d1 = 64 AS expected_dim, true AS length_match, {rounded_sql('lo')} AS min_value, {rounded_sql('hi')} AS max_value,
  {rounded_sql('mu')} AS mean_value, {rounded_sql('sd')} AS std_value, {rounded_sql('n0')} AS min_norm,
  {rounded_sql('n1')} AS max_norm, {rounded_sql('nm')} AS mean_norm, u AS unique_embeddings, n - u AS duplicate_count,
  u < n AS has_duplicates, ids AS unique_ids, n - ids AS duplicate_ids, ids < n AS has_duplicate_ids,
  {rounded_sql('cells * 4 / 1048576.0')} AS memory_mb
FROM elements, rows""")
def sanity_checks(spark, sf):
    checks = profile.sanity_checks(st.doubled(spark, sf), "vec_id", expected_dim=64)
    return _round(
        checks, "min_value", "max_value", "mean_value", "std_value", "min_norm", "max_norm", "mean_norm", "memory_mb"
    )


@register("recommendations", f"""
WITH {st.DOUBLED_SQL}, facts AS (
  SELECT count(*) AS n, count(*) - count(DISTINCT embedding) AS dup, avg({norm_sql('embedding')}) * 2 AS mean_norm,
    sum(len(embedding)) * 4 / 1048576.0 AS mb FROM doubled),
lines AS (
  SELECT 1 AS o, 'INFO: Embeddings may not be normalized. Consider normalizing before clustering.' AS message
    FROM facts WHERE abs(mean_norm - 1) > 0.1
  UNION ALL SELECT 2, 'WARNING: ' || printf('%.1f', dup * 100.0 / n) || '% duplicate embeddings found. Consider deduplication.'
    FROM facts WHERE dup > 0
  UNION ALL SELECT 3, 'WARNING: Dataset is very small for clustering. Consider gathering more data.' FROM facts WHERE n < 1000
  UNION ALL SELECT 3, 'INFO: Large dataset detected. Consider using batch processing or sampling for initial experiments.'
    FROM facts WHERE n > 100000
  UNION ALL SELECT 4, 'INFO: High memory usage. Consider using float32 instead of float64 for memory efficiency.'
    FROM facts WHERE mb > 1000)
SELECT row_number() OVER (ORDER BY o) - 1 AS position, message FROM lines""")
def recommendations(spark, sf):
    twice = F.transform("embedding", lambda x: x * F.lit(2).cast("float"))
    rows = st.doubled(spark, sf).withColumn("embedding", twice)
    return profile.recommendations(profile.sanity_checks(rows, "vec_id", expected_dim=64))


@register("dimension_stats", f"""
WITH cells AS (SELECT unnest(range(0, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT dim, {rounded_sql('avg(x)')} AS mean, {rounded_sql('stddev_pop(x)')} AS std FROM cells WHERE dim < 50 GROUP BY dim""")
def dimension_stats(spark, sf):
    return _round(profile.dimension_stats(_emb(spark, sf)), "mean", "std")


PAIRS_SQL = """heads AS (SELECT vec_id, unnest(range(0, 10)) AS i, unnest(embedding[1:10])::DOUBLE AS x FROM embeddings),
pairs AS (SELECT a.i AS i, b.i AS j, a.x AS x, b.x AS y FROM heads a JOIN heads b USING (vec_id))"""


@register("dimension_corr", f"WITH {PAIRS_SQL} SELECT i, j, {rounded_sql('corr(x, y)')} AS r FROM pairs GROUP BY i, j")
def dimension_corr(spark, sf):
    return _round(profile.dimension_corr(_emb(spark, sf)), "r")


@register("covariance", f"WITH {PAIRS_SQL.replace('range(0, 10)', 'range(0, 64)').replace('[1:10]', '')} SELECT i, j, {rounded_sql('covar_samp(x, y)', 8)} AS cov FROM pairs GROUP BY i, j")
def covariance(spark, sf):
    return _round(profile.covariance(_emb(spark, sf)), "cov", digits=8)


def _histogram_sql(value: str) -> str:
    return f"""
WITH data AS (SELECT {value} AS x FROM embeddings), lim AS (SELECT min(x) AS a, max(x) AS b FROM data),
counts AS (SELECT least(CAST(floor((x - a) / ((b - a) / 50)) AS BIGINT), 49) AS bin, count(*) AS n FROM data, lim GROUP BY 1)
SELECT s.bin, {rounded_sql('a + s.bin * ((b - a) / 50)')} AS lo, coalesce(n, 0) AS n
FROM (SELECT unnest(range(0, 50)) AS bin) s CROSS JOIN lim LEFT JOIN counts USING (bin)"""


@register("norm_histogram", _histogram_sql(f"{norm_sql('embedding')} * (1 + label) * (2 + embedding[1]::DOUBLE)"))
def norm_histogram(spark, sf):
    value = vx.norm(F.col("embedding")) * (1 + F.col("label")) * (2 + F.col("embedding")[0].cast("double"))
    return _round(profile.histogram(_emb(spark, sf), value), "lo")


@register("dimension_histogram", _histogram_sql("embedding[1]::DOUBLE"))
def dimension_histogram(spark, sf):
    return _round(profile.histogram(_emb(spark, sf), F.col("embedding")[0]), "lo")


@register("sample_describe", f"""
WITH s AS (SELECT {norm_sql('embedding')} AS n, embedding FROM embeddings),
cells AS (SELECT 'embedding_norm' AS c, n AS x FROM s
  UNION ALL SELECT 'emb_dim_' || unnest(range(0, 5)), unnest(embedding[1:5])::DOUBLE FROM s)
SELECT c AS "column", count(*) AS "count", {rounded_sql('avg(x)')} AS mean, {rounded_sql('stddev_samp(x)')} AS std,
  {rounded_sql('min(x)')} AS min, {rounded_sql('quantile_cont(x, 0.25)')} AS p25, {rounded_sql('quantile_cont(x, 0.5)')} AS p50,
  {rounded_sql('quantile_cont(x, 0.75)')} AS p75, {rounded_sql('max(x)')} AS max FROM cells GROUP BY c""")
def sample_describe(spark, sf):
    heads = [F.col("embedding")[i].cast("double").alias(f"emb_dim_{i}") for i in range(5)]
    frame = _emb(spark, sf).select(vx.norm(F.col("embedding")).alias("embedding_norm"), *heads)
    return _round(profile.describe(frame, frame.columns), "mean", "std", "min", "p25", "p50", "p75", "max")


SAMPLE_SQL = "SELECT * FROM embeddings ORDER BY md5('42' || vec_id), vec_id LIMIT {0}"


@register("sample_frame", f"""
WITH s AS ({SAMPLE_SQL.format(300)})
SELECT vec_id AS comment_id, {rounded_sql(norm_sql('embedding'))} AS embedding_norm,
  {', '.join(f"{rounded_sql(f'embedding[{i + 1}]::DOUBLE')} AS emb_dim_{i}" for i in range(5))} FROM s""")
def sample_frame(spark, sf):
    drawn = profile.sample_frame(_emb(spark, sf), 300, "vec_id")
    return _round(drawn, "embedding_norm", *[f"emb_dim_{i}" for i in range(5)])


@register("uniform_sample", f"SELECT vec_id, label FROM ({SAMPLE_SQL.format(123)})")
def uniform_sample(spark, sf):
    return hash_sample(_emb(spark, sf).select("vec_id", "label"), "vec_id", F.lit(123))


@register("processing_summary", """
WITH c AS (SELECT source AS file, count(*) AS comments FROM documents GROUP BY 1),
v AS (SELECT 'src' || (vec_id % 20) AS file, count(*) AS vectors, max(len(embedding)) AS dim FROM embeddings GROUP BY 1)
SELECT file, comments, coalesce(vectors, 0) AS vectors, dim FROM c LEFT JOIN v USING (file)""")
def processing_summary(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("source").alias("file"))
    return profile.processing_summary(docs, st.vectors(spark, sf))


@register("dedup_embeddings", f"""
WITH {st.DOUBLED_SQL}
SELECT min(vec_id) AS vec_id, count(*) AS copies FROM doubled GROUP BY embedding""")
def dedup_embeddings(spark, sf):
    return dedup.first_occurrences(st.doubled(spark, sf), ["vec_id"])


@register("dedup_rows", f"""
WITH {st.DOUBLED_SQL}, kept AS (SELECT min(vec_id) AS vec_id, count(*) AS copies FROM doubled GROUP BY embedding)
SELECT vec_id, copies, label, {rounded_sql('embedding[1]::DOUBLE')} AS first_value FROM kept JOIN doubled USING (vec_id)""")
def dedup_rows(spark, sf):
    kept = dedup.dedup_vectors(st.doubled(spark, sf), ["vec_id"])
    return kept.select("vec_id", "copies", "label", rounded(F.col("embedding")[0].cast("double")).alias("first_value"))


@register("dedup_summary", f"""
WITH {st.DOUBLED_SQL}, f AS (SELECT count(*) AS n, count(DISTINCT embedding) AS u, max(len(embedding)) AS d FROM doubled)
SELECT n AS original_count, u AS unique_count, d AS embedding_dim, n - u AS duplicate_count,
  {rounded_sql('(n - u) * 100.0 / n')} AS duplicate_percentage, {rounded_sql('(n - u) * 100.0 / n')} AS size_reduction_percentage,
  {rounded_sql('n / u')} AS compression_ratio, {rounded_sql('n * d * 2 / 1048576.0')} AS original_mb,
  {rounded_sql('u * d * 2 / 1048576.0')} AS deduplicated_mb FROM f""")
def dedup_summary(spark, sf):
    return _round(
        dedup.dedup_summary(st.doubled(spark, sf)),
        "duplicate_percentage", "size_reduction_percentage", "compression_ratio", "original_mb", "deduplicated_mb",
    )


@register("verify_dedup", """
SELECT count(*) AS rows, count(DISTINCT embedding) AS unique_rows, 0 AS unknown_rows,
  count(*) = count(DISTINCT embedding) AS all_unique, true AS is_subset FROM embeddings""")
def verify_dedup(spark, sf):
    both = st.doubled(spark, sf)
    return dedup.verify_dedup(both, dedup.dedup_vectors(both, ["vec_id"]))


@register("centroids", f"""
WITH {st.CENTERS_SQL} SELECT label AS cluster, d - 1 AS dim, {rounded_sql('m')} AS value FROM means""")
def centroids(spark, sf):
    means = cl.centroids(_emb(spark, sf), "label").select("cluster", F.posexplode("center").alias("dim", "value"))
    return _round(means, "value")


MEASURED_SQL = f"""{st.CENTERS_SQL}, measured AS (
  SELECT vec_id, embeddings.label AS cluster, {square_sql('embedding', 'center')} AS sq FROM embeddings JOIN centers USING (label))"""


def _measured(spark, sf):
    emb = _emb(spark, sf)
    centers = cl.centroids(emb, "label").select("cluster", "center")
    return cl.with_distance(emb, centers, "label")


@register("cluster_extremes", f"""
WITH {MEASURED_SQL}, ranked AS (
  SELECT cluster, 'nearest' AS kind, row_number() OVER (PARTITION BY cluster ORDER BY sq, vec_id) AS rank, vec_id, sq FROM measured
  UNION ALL
  SELECT cluster, 'farthest', row_number() OVER (PARTITION BY cluster ORDER BY sq DESC, vec_id DESC), vec_id, sq FROM measured)
SELECT cluster, kind, rank, vec_id, {rounded_sql('sqrt(sq)')} AS distance, {rounded_sql('sq')} AS sq_distance FROM ranked
WHERE rank <= CASE WHEN kind = 'nearest' THEN 10 ELSE 25 END""")
def cluster_extremes(spark, sf):
    return _round(cl.extremes(_measured(spark, sf), 10, 25, "label", "vec_id"), "distance", "sq_distance")


@register("cluster_files_manifest", """
WITH s AS (SELECT label AS cluster, count(*) AS members FROM embeddings GROUP BY label), k AS (SELECT count(*) AS k FROM s),
c AS (SELECT cluster, members, least(members, 10) AS closest_saved, least(members, 25) AS farthest_saved, k FROM s, k)
SELECT cluster, members, closest_saved, farthest_saved,
  'corpus_kmeans' || k || '_cluster_' || cluster || '_nearest_' || closest_saved || '.json' AS closest_path,
  'corpus_kmeans' || k || '_cluster_' || cluster || '_farthest_' || farthest_saved || '.json' AS farthest_path FROM c""")
def cluster_files_manifest(spark, sf):
    picked = cl.extremes(_measured(spark, sf), 10, 25, "label", "vec_id")
    sizes = cl.cluster_sizes(_emb(spark, sf).withColumnRenamed("label", "cluster"))
    return cl.files_manifest(picked, sizes, "corpus")


@register("cluster_results", f"""
SELECT vec_id AS comment_id, label AS cluster_label, {rounded_sql(norm_sql('embedding'))} AS embedding_norm,
  count(*) OVER (PARTITION BY label) AS cluster_size FROM embeddings""")
def cluster_results(spark, sf):
    out = cl.cluster_results(_emb(spark, sf), "vec_id", "label")
    return _round(out.select("comment_id", "cluster_label", "embedding_norm", "cluster_size"), "embedding_norm")


@register("cluster_stats", f"""
WITH s AS (SELECT count(*) AS n FROM embeddings GROUP BY label)
SELECT CAST(sum(n) AS BIGINT) AS total_points, count(*) AS n_clusters, min(n) AS min_size, max(n) AS max_size,
  {rounded_sql('avg(n)')} AS mean_size, {rounded_sql('median(n)')} AS median_size, {rounded_sql('stddev_pop(n)')} AS std_size FROM s""")
def cluster_stats(spark, sf):
    return _round(cl.cluster_stats(_emb(spark, sf), "label"), "mean_size", "median_size", "std_size")


@register("cluster_inertia", f"WITH {MEASURED_SQL} SELECT {rounded_sql('sum(sq)')} AS inertia FROM measured")
def cluster_inertia(spark, sf):
    emb = _emb(spark, sf)
    centers = cl.centroids(emb, "label").select("cluster", "center")
    return _round(cl.inertia(emb, centers, "label"), "inertia")


@register("assign_nearest_centroid", f"""
WITH {st.CENTERS_SQL}, gaps AS (
  SELECT vec_id, centers.label AS cluster, {square_sql('embedding', 'center')} AS sq FROM embeddings CROSS JOIN centers)
SELECT vec_id, arg_min(cluster, (sq, cluster)) AS cluster FROM gaps GROUP BY vec_id""")
def assign_nearest_centroid(spark, sf):
    emb = _emb(spark, sf)
    return assign_to_table(emb.select("vec_id", "embedding"), cl.centroids(emb, "label")).select("vec_id", "cluster")


def lowest_ids(emb, k: int) -> np.ndarray:
    """Starting points: the vectors with the k smallest ids (k is a constant)."""
    rows = emb.select("vec_id", "embedding").orderBy("vec_id").limit(k).collect()
    return np.array([r.embedding for r in rows], dtype=np.float64)


def _lloyd_sql(k: int, rounds: int) -> str:
    parts = [
        f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, embedding::DOUBLE[] AS center "
        f"FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT {k}))"
    ]
    for i in range(rounds + 1):
        parts.append(
            f"g{i} AS (SELECT vec_id, embedding, cluster, {square_sql('embedding', 'center')} AS sq FROM embeddings CROSS JOIN c{i}), "
            f"a{i} AS (SELECT vec_id, any_value(embedding) AS embedding, arg_min(cluster, (sq, cluster)) AS cluster, min(sq) AS sq FROM g{i} GROUP BY vec_id)"
        )
        if i < rounds:
            parts.append(
                f"e{i} AS (SELECT cluster, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE AS x FROM a{i}), "
                f"m{i} AS (SELECT cluster, d, avg(x) AS m FROM e{i} GROUP BY cluster, d), "
                f"c{i + 1} AS (SELECT cluster, list(m ORDER BY d) AS center FROM m{i} GROUP BY cluster)"
            )
    return (
        "WITH " + ", ".join(parts)
        + f" SELECT cluster, count(*) AS n, {rounded_sql('sum(sq)')} AS inertia FROM a{rounds} GROUP BY cluster"
    )


@register("kmeans_lloyd", _lloyd_sql(LLOYD_K, LLOYD_ROUNDS))
def kmeans_lloyd(spark, sf):
    emb = _emb(spark, sf)
    fit = cl.run_lloyd(emb, {(LLOYD_K, 0): lowest_ids(emb, LLOYD_K)}, LLOYD_ROUNDS, -1.0)[0]
    labelled = cl.assign(emb, fit.centers)
    measured = cl.with_distance(labelled, cl.centers_frame(spark, fit.centers))
    out = measured.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("sq_distance").alias("inertia"))
    return _round(out, "inertia")


@register("kmeans_bounded", _lloyd_sql(BOUNDED_K, BOUNDED_ROUNDS))
def kmeans_bounded(spark, sf):
    """Lloyd rounds from given seeds with bounds kept between the rounds."""
    emb = _emb(spark, sf)
    found = run_bounded(emb, lowest_ids(emb, BOUNDED_K), BOUNDED_ROUNDS, id_col="vec_id")
    measured = cl.with_distance(found.labelled, cl.centers_frame(spark, found.fit.centers), "label")
    out = measured.groupBy(F.col("label").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), F.sum("sq_distance").alias("inertia"))
    return _round(out, "inertia")


@register("silhouette_cosine", f"""
WITH gaps AS (
  SELECT a.vec_id AS i, a.label AS own, b.label AS other,
    sum(1 - list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / ({norm_sql('a.embedding')} * {norm_sql('b.embedding')})) AS total,
    count(*) AS n
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
parts AS (
  SELECT i, max(total / n) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b FROM gaps GROUP BY i)
SELECT {rounded_sql('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS score FROM parts""")
def silhouette_cosine(spark, sf):
    score = sk.silhouette(_emb(spark, sf), "label")
    return spark.createDataFrame([(score,)], "score DOUBLE").select(rounded(F.col("score")).alias("score"))


@register("elbow_select", f"""
WITH seeds AS (SELECT row_number() OVER (ORDER BY vec_id) AS s, embedding AS center
               FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT {SCAN_K})),
gaps AS (SELECT vec_id, s, {square_sql('embedding', 'center')} AS sq FROM embeddings CROSS JOIN seeds),
best AS (SELECT s AS k, min(sq) OVER (PARTITION BY vec_id ORDER BY s) AS sq FROM gaps),
curve AS (SELECT k, sum(sq) AS inertia FROM best WHERE k >= 2 GROUP BY k),
ends AS (SELECT min(k) AS k1, max(k) AS k2, arg_min(inertia, k) AS y1, arg_max(inertia, k) AS y2 FROM curve),
dist AS (SELECT k, inertia, abs((y2 - y1) * k - (k2 - k1) * inertia + k2 * y1 - y2 * k1)
           / sqrt((k2 - k1) * (k2 - k1) + (y2 - y1) * (y2 - y1)) AS distance FROM curve, ends)
SELECT k, {rounded_sql('inertia')} AS inertia, {rounded_sql('distance')} AS distance,
  row_number() OVER (ORDER BY distance DESC, k) = 1 AS selected FROM dist""")
def elbow_select(spark, sf):
    emb = _emb(spark, sf)
    values = sk.seeded_inertia(emb, lowest_ids(emb, SCAN_K), list(range(2, SCAN_K + 1)))
    return _round(sk.elbow_distances(sk.curve(spark, values, "inertia")), "inertia", "distance")


@register("fixed_k_guard", f"""
WITH {st.DOUBLED_SQL}
SELECT label, count(DISTINCT embedding) AS unique_count, least(50, count(DISTINCT embedding)) AS k FROM doubled GROUP BY label""")
def fixed_k_guard(spark, sf):
    return cl.fixed_k_guard(st.doubled(spark, sf), ["label"], 50)


@register("npz_import", f"""
WITH cells AS (SELECT vec_id // 200 AS file_no, vec_id, label, embedding,
  row_number() OVER (PARTITION BY vec_id // 200 ORDER BY vec_id) - 1 AS pos FROM embeddings)
SELECT 'part' || file_no || '.npz' AS file, pos, CAST(vec_id AS VARCHAR) AS id, vec_id AS original_pos,
  {rounded_sql('embedding[1]::DOUBLE')} AS first_value, {rounded_sql(norm_sql('embedding'))} AS norm FROM cells""")
def npz_import(spark, sf):
    emb = _emb(spark, sf).select("vec_id", "embedding").withColumn("part", id_block("vec_id", 200))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        buffer, ids = io.BytesIO(), rows.column("vec_id").to_numpy()
        np.savez_compressed(
            buffer, embeddings=to_matrix(rows.column("embedding")).astype(np.float32), ids=ids, original_indices=ids
        )
        return pa.table({"path": [f"/archives/part{key[0].as_py()}.npz"], "content": [buffer.getvalue()]})

    archives = emb.groupBy("part").applyInArrow(pack, "path STRING, content BINARY")  # at most 200 rows per group
    return src.import_npz(archives).select(
        "file", "pos", "id", "original_pos",
        rounded(F.col("embedding")[0].cast("double")).alias("first_value"),
        rounded(vx.norm(F.col("embedding"))).alias("norm"),
    )


@register("pca_project")
def pca_project(spark, sf):
    out = cl.pca_project(cl.l2_normalize(_emb(spark, sf)), 10)
    return out.select("vec_id", *[rounded(F.abs(F.col("embedding")[i].cast("double")), 4).alias(f"p{i}") for i in range(10)])


@register("kmeans_fit")
def kmeans_fit(spark, sf):
    emb = st.vectors(spark, sf)
    fit = cl.fit_kmeans(emb, 5)
    return cl.cluster_sizes(cl.assign(emb.drop("cluster"), fit.centers)).withColumn("inertia", rounded(F.lit(fit.inertia)))


@register("kmeans_sampled")
def kmeans_sampled(spark, sf):
    emb = st.vectors(spark, sf).drop("cluster")
    fit = cl.fit_minibatch(emb, [5], cl.batch_size(emb.count()))[5]
    return cl.cluster_sizes(cl.assign(emb, fit.centers)).withColumn("inertia", rounded(F.lit(fit.inertia)))


@register("elbow_scan")
def elbow_scan(spark, sf):
    scan = sk.elbow_scan(st.vectors(spark, sf))
    return _round(sk.elbow_distances(sk.curve(spark, scan.values, "inertia")), "inertia", "distance")


@register("silhouette_select")
def silhouette_select(spark, sf):
    scan = sk.silhouette_choice(st.vectors(spark, sf))
    out = sk.curve(spark, scan.values, "score").withColumn("selected", F.col("k") == scan.k)
    return _round(out, "score")


def _register_job(name: str) -> None:
    @register(f"cluster_job_{name}")
    def run(spark, sf):
        vectors = st.vectors(spark, sf).drop("cluster")
        outcome = jobs.run_cluster_job(vectors, st.comments(spark, sf).drop("doc_id"), jobs.PRESETS[name])
        return _round(outcome.extremes.drop("file", "original_pos"), "distance", "sq_distance")


for _name in jobs.PRESETS:
    _register_job(_name)
