"""End-to-end jobs: embed, profile, deduplicate, cluster."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.operators import cluster as cl
from corpuslab.operators import select_k as sk
from corpuslab.operators.dedup import dedup_summary, dedup_vectors, verify_dedup
from corpuslab.operators.enrich import enrich_per_file, enrich_priority
from corpuslab.operators.encode import Encoder, embed
from corpuslab.operators.profile import analysis_report, processing_summary
from corpuslab.session import written_table
from corpuslab.sources import sinks


@dataclass(frozen=True)
class ClusterJob:
    """What to do with a vector table before, during and after k-means."""

    k: int = rules.FALLBACK_K
    choose: str = "given"  # given, silhouette, elbow or guarded (k cut to the distinct vectors)
    adaptive: bool = True
    k_max: int = rules.K_MAX
    dedup: bool = False
    normalize: bool = False
    pca_dims: int = 0
    sample: int | None = None  # rows to fit on; None fits on all rows
    n_init: int = 10
    max_iter: int = 300
    seed: int = 42
    nearest: int = 100
    farthest: int = 500
    tag: str = "kmeans"
    texts: str = "file"  # comment text by id or position in the own file; "index": by original position first


# The seven variants of the analysis.
PRESETS = {
    "raw": ClusterJob(k=10, nearest=100, farthest=500),
    "dedup": ClusterJob(k=3, dedup=True, nearest=1000, farthest=1000),
    "silhouette": ClusterJob(choose="silhouette", adaptive=False, dedup=True, nearest=500, farthest=500),
    "silhouette_fast": ClusterJob(
        choose="silhouette", dedup=True, normalize=True, pca_dims=100, n_init=3, nearest=1000, farthest=1000
    ),
    "elbow": ClusterJob(
        choose="elbow", k_max=rules.K_MAX_ELBOW, dedup=True, normalize=True, n_init=3,
        nearest=100, farthest=100, tag="elbow_kmeans",
    ),
    "fixed": ClusterJob(k=3, choose="guarded", dedup=True, normalize=True, nearest=1000, farthest=1000, tag="fixed_k"),
    "report": ClusterJob(k=10, nearest=100, farthest=500, texts="index"),
}


@dataclass(frozen=True)
class ClusterOutcome:
    """Tables of a finished job; all but ``scan`` and ``fit`` are lazy."""

    scan: sk.Scan
    fit: cl.Fit
    labelled: DataFrame
    results: DataFrame
    stats: DataFrame
    extremes: DataFrame
    manifest: DataFrame
    summary: DataFrame
    texts: DataFrame | None = None  # every row's label with its comment


def prepare_features(vectors: DataFrame, job: ClusterJob) -> DataFrame:
    """Deduplicate, normalise and project as the job asks; ``file, pos`` identify a row, repeats are refused."""
    again = vectors.groupBy("file", "pos").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if again is not None:
        raise ValueError(f"{again.n} vectors share file {again.file!r} and position {again.pos}")
    named = vectors.withColumn("file", F.coalesce("file", F.lit("")))
    out = dedup_vectors(named, ["file", "pos"]).drop("copies") if job.dedup else named
    if job.normalize:
        out = cl.l2_normalize(out)
    return cl.pca_project(out, job.pca_dims)


def choose_k(features: DataFrame, job: ClusterJob, n: int) -> sk.Scan:
    if job.choose == "guarded":
        return sk.Scan(min(job.k, n), {})
    if job.choose == "given":
        return sk.Scan(job.k, {})
    if job.choose == "elbow":
        return sk.elbow_scan(features, rules.K_MIN, job.k_max, job.sample, n, job.seed, n_init=job.n_init)
    return sk.silhouette_choice(
        features, rules.K_MIN, job.k_max, job.adaptive, job.sample, n, job.seed, n_init=job.n_init
    )


def final_fit(features: DataFrame, job: ClusterJob, n: int, scan: sk.Scan) -> cl.Fit:
    """The scan's own model for the chosen k (a refit with equal seeds would repeat it), else a fresh fit."""
    if scan.k in scan.fits:
        return scan.fits[scan.k]
    options = {"n_init": job.n_init, "max_iter": job.max_iter, "seed": job.seed}
    if job.sample is None or n <= job.sample:
        return cl.fit_kmeans(features, scan.k, **options)
    fit = cl.fit_on_sample(features, [scan.k], job.sample, **options)[scan.k]
    whole = cl.lloyd_pass(features, {0: fit.centers})[0]
    return replace(fit, counts=whole.counts, inertia=whole.inertia)


def run_cluster_job(vectors: DataFrame, comments: DataFrame | None, job: ClusterJob, base: str = "corpus") -> ClusterOutcome:
    """Vectors (``file, pos, id, embedding, original_pos``) to labels, reports and per-cluster lists."""
    spark = vectors.sparkSession
    features = written_table(prepare_features(vectors, job), "features")  # scanned many times below
    n = features.count()
    original = vectors.count() if job.dedup else n
    scan = choose_k(features, job, n)
    fit = final_fit(features, job, n, scan)
    labelled = written_table(cl.assign(features, fit.centers), "labelled")  # one assignment for all reports
    centers = cl.centers_frame(spark, fit.centers)
    measured = cl.with_distance(labelled, centers)
    picked = cl.extremes(measured, job.nearest, job.farthest, keep=["id", "file", "original_pos"])
    results = cl.cluster_results(labelled)
    texts = None
    if comments is not None:
        texts = enrich_per_file(labelled.drop("embedding"), comments)
        picked = written_table(picked, "picked")
        by_index = job.texts == "index"
        picked = enrich_priority(picked, comments, ["file", "pos", "kind"], few=True) if by_index else enrich_per_file(picked, comments)
    sizes = cl.cluster_sizes(labelled)
    manifest = cl.files_manifest(picked, sizes, base, job.tag)
    counts = F.map_from_entries(F.collect_list(F.struct(
        F.col("cluster").cast("string"), F.struct("members", "closest_saved", "farthest_saved")
    )))
    outputs = F.sort_array(F.collect_list(F.struct("cluster", "closest_path", "farthest_path")))
    summary = manifest.agg(counts.alias("per_cluster_counts"), outputs.alias("outputs")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("clustering_timestamp"),
        F.lit(original).alias("num_points_original"),
        F.lit(n).alias("num_points"),
        F.lit(original - n).alias("duplicates_removed"),
        F.lit((original - n) / original * 100 if original else 0.0).alias("duplicate_percentage"),
        F.lit(int(fit.centers.shape[1])).alias("embedding_dim"),
        F.lit(int((fit.counts > 0).sum())).alias("num_clusters"),
        F.lit(float(fit.inertia)).alias("inertia"),
        F.array(*[F.lit(k) for k in scan.values]).cast("array<int>").alias("scan_ks"),
        F.array(*[F.lit(float(v)) for v in scan.values.values()]).cast("array<double>").alias("scan_values"),
        "per_cluster_counts",
        "outputs",
    )
    return ClusterOutcome(scan, fit, labelled, results, cl.cluster_stats(labelled), picked, manifest, summary, texts)


def write_cluster_job(outcome: ClusterOutcome, path: str) -> None:
    sinks.write_csv(outcome.results, f"{path}/results")
    if outcome.texts is not None:
        sinks.write_csv(outcome.texts, f"{path}/results_with_text")
    sinks.write_csv(outcome.extremes.drop("embedding"), f"{path}/cluster_extremes")
    sinks.write_extremes(outcome.extremes, f"{path}/clusters")
    sinks.write_report(outcome.stats, f"{path}/statistics")
    sinks.write_report(outcome.summary, f"{path}/summary")


def run_dedup_job(vectors: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Write the distinct vectors and the report; returns the verification row."""
    kept = dedup_vectors(vectors, order)
    sinks.write_vectors(kept, f"{path}/vectors")
    sinks.write_report(dedup_summary(vectors), f"{path}/summary")
    return verify_dedup(vectors, vectors.sparkSession.read.parquet(f"{path}/vectors"))


def run_embed_job(comments: DataFrame, factory: Callable[[], Encoder], path: str) -> DataFrame:
    """Encode comments, write vectors, a row per file and the totals; returns the totals."""
    sinks.write_vectors(embed(comments, "text", factory).withColumn("original_pos", F.lit(None).cast("bigint")), f"{path}/vectors")
    files = processing_summary(comments, comments.sparkSession.read.parquet(f"{path}/vectors"))
    sinks.write_report(files, f"{path}/files")
    totals = files.agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if(F.col("vectors") == F.col("comments")).alias("complete_files"),
        F.coalesce(F.sum("comments"), F.lit(0)).alias("total_comments"), F.coalesce(F.sum("vectors"), F.lit(0)).alias("total_vectors"),
        F.max("dim").alias("embedding_dim"),
    )
    sinks.write_report(totals, f"{path}/processing_report")
    return totals


def run_profile_job(vectors: DataFrame, source: str, path: str, expected_dim: int) -> None:
    sinks.write_report(analysis_report(vectors, source, expected_dim=expected_dim), path)
