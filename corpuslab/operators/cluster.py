"""k-means on a shared scan, assignment, cluster statistics and distance extremes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.functions import vectors as vx
from corpuslab.functions.vectors import pairwise_squared, to_matrix
from corpuslab.operators.joins import attach_bounded
from corpuslab.operators.ordering import hash_sample, top_per_group
from corpuslab.session import remove_table, scratch_path

MAX_CLUSTERS = 4096
NEGLIGIBLE = 1e-12  # share of the spread of the data below which two vectors count as one
SEED_ROUNDS = 5
MOST_SEED_ROUNDS = 30
CELLS = 1 << 20  # distances held at once by a task
MOST_SLICES = 20
MOST_ROUNDS = 100
LEAST_SHARE = 0.01  # of the largest centre's rows; below it a centre is replaced
PATIENCE = 10  # rounds without a lower smoothed cost


@dataclass
class Stats:
    """Outcome of one scan for one model; ``partials`` counts the rows the tasks sent."""

    sums: np.ndarray
    counts: np.ndarray
    inertia: float
    partials: int


@dataclass(frozen=True)
class Fit:
    """One fitted model: ``centers`` is k x d."""

    k: int
    restart: int
    centers: np.ndarray
    counts: np.ndarray
    inertia: float
    iterations: int


def spread_seeds(points: np.ndarray, k: int, rng: np.random.Generator, weights: np.ndarray | None = None) -> np.ndarray:
    """k-means++ seeding on weighted points; fewer seeds if there are fewer distinct points."""
    weights = np.ones(len(points)) if weights is None else np.asarray(weights, dtype=np.float64)
    chosen = [points[rng.choice(len(points), p=weights / weights.sum())]]
    gap = pairwise_squared(points, chosen[0][None, :])[:, 0]
    same = NEGLIGIBLE * gap.max()
    gap[gap <= same] = 0.0
    while len(chosen) < k and gap.any():
        share = gap * weights
        chosen.append(points[rng.choice(len(points), p=share / share.sum())])
        gap = np.minimum(gap, pairwise_squared(points, chosen[-1][None, :])[:, 0])
        gap[gap <= same] = 0.0
    return np.array(chosen)


def first_look(vectors: DataFrame, restarts: int, seed: int, id_col: str, vec: str) -> tuple[int, float, list[np.ndarray], list[float]]:
    """Rows, mean variance per dimension, a random vector per restart and the rows' total cost around it.

    Raises on vectors with NaN or infinite values: distances to them mean nothing.
    """
    odd = F.max(F.exists(vec, lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    mean = vector_to_array(Summarizer.mean(array_to_vector(vx.as_double(F.col(vec)))))
    picked = [F.min_by(vec, F.xxhash64(id_col, F.lit(f"{seed}/{r}"))).alias(f"v{r}") for r in range(restarts)]
    row = vectors.agg(
        F.count(F.lit(1)).alias("n"), odd.alias("odd"), mean.alias("mean"), F.avg(vx.sum_squares(F.col(vec))).alias("square"), *picked
    ).first()
    if row.n == 0:
        raise ValueError("no vectors to cluster")
    if row.odd:
        raise ValueError("vectors with NaN or infinite values cannot be clustered")
    center = np.array(row.mean)
    spread = max(0.0, row.square - float(center @ center))
    starts = [np.array(row[f"v{r}"], dtype=np.float64) for r in range(restarts)]
    costs = [row.n * (spread + float(((v - center) ** 2).sum())) for v in starts]
    return row.n, spread / len(center), starts, costs


def oversample_pass(
    vectors: DataFrame, centers: dict[int, np.ndarray], costs: dict[int, float], wanted: int, salt: str, id_col: str, vec: str, same: float
) -> dict[int, tuple[float, np.ndarray]]:
    """One scan: cost of all rows around each set of centres, and about ``wanted`` rows drawn by their share of ``costs``.

    Squared distances up to ``same`` count as none.
    """
    schema = "model INT, cost DOUBLE, picked ARRAY<ARRAY<DOUBLE>>"

    def draw(batches):
        totals, picked = dict.fromkeys(centers, 0.0), {m: [] for m in centers}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points = to_matrix(batch.column(0))
            luck = batch.column(1).to_numpy().view(np.uint64)
            for m, known in centers.items():
                gaps = pairwise_squared(points, known).min(1)
                gaps[gaps <= same] = 0.0
                totals[m] += float(gaps.sum())
                turned = (luck + np.uint64((m + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ (luck >> np.uint64(29))
                turned = turned * np.uint64(0xBF58476D1CE4E5B9)
                u = ((turned ^ (turned >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
                picked[m] += list(points[u * costs[m] < wanted * gaps])
        yield pa.record_batch(
            [pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.float64()),
             pa.array([picked[m] for m in totals], pa.list_(pa.list_(pa.float64())))],
            names=["model", "cost", "picked"],
        )

    luck = F.xxhash64(id_col, F.lit(salt)).alias("_luck")
    drawn = vectors.select(vec, luck).mapInArrow(draw, schema).groupBy("model").agg(
        F.sum("cost").alias("cost"), F.flatten(F.collect_list("picked")).alias("picked"))  # about ``wanted`` in all
    return {r.model: (r.cost, np.array(r.picked, dtype=np.float64)) for r in drawn.collect()}


def seed_candidates(
    vectors: DataFrame, most: int, restarts: int, seed: int, id_col: str, vec: str
) -> tuple[float, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Mean variance, and per restart candidate centres with the number of rows nearest to each.

    Scalable k-means++: every round draws about ``2 * most`` rows by squared distance to the candidates so far, from all
    rows, so a far or rare vector is as likely to be found in a large table as in a small one.
    """
    rows, variance, starts, costs = first_look(vectors, restarts, seed, id_col, vec)
    found = {r: v[None, :] for r, v in enumerate(starts)}
    same = NEGLIGIBLE * max(costs) / rows  # relative to the spread of the data, whatever its scale
    left = {r: c for r, c in enumerate(costs) if c > same * rows}
    for turn in range(MOST_SEED_ROUNDS):
        if not left or (turn >= SEED_ROUNDS and all(len(found[r]) >= most for r in left)):
            break
        drawn = oversample_pass(vectors, {r: found[r] for r in left}, left, 2 * most, f"{seed}:{turn}", id_col, vec, same)
        for r, (cost, picked) in drawn.items():
            left[r] = cost
            if len(picked):
                found[r] = np.unique(np.vstack([found[r], picked]), axis=0)
        left = {r: c for r, c in left.items() if c > 0}
    weights = lloyd_pass(vectors, found, vec)
    return variance, {r: (found[r][weights[r].counts > 0], weights[r].counts[weights[r].counts > 0]) for r in found}


class Assigner:
    """Nearest centres of many models at once: one matrix product for all distances and one for all sums.

    Models of equal size lie side by side, so that a step of the search for the least distance serves all of them.
    """

    def __init__(self, models: dict[int, np.ndarray]):
        sizes: dict[int, list[int]] = {}
        for m, c in models.items():
            sizes.setdefault(len(c), []).append(m)
        self.groups = []  # first row, centres and models of a block
        blocks, at = [], 0
        for k, names in sizes.items():
            stacked = np.stack([models[m] for m in names], axis=1)  # k x models x d
            blocks.append(stacked.reshape(k * len(names), -1))
            self.groups.append((at, k, names))
            at += k * len(names)
        centers = np.concatenate(blocks)
        self.origin = centers.mean(0)  # so that an offset of the data does not cancel digits
        moved = centers - self.origin
        self.known = np.hstack([-2.0 * moved, (moved * moved).sum(1)[:, None]])
        self.sums = np.zeros_like(centers)
        self.counts = np.zeros(len(centers), dtype=np.int64)
        self.costs = {m: 0.0 for m in models}
        self.rows = int(min(4096, max(64, CELLS // len(centers))))

    def add(self, points: np.ndarray) -> None:
        for begin in range(0, len(points), self.rows):
            self._add(points[begin:begin + self.rows])

    def _add(self, points: np.ndarray) -> None:
        moved = points - self.origin
        square = (moved * moved).sum(1)
        gaps = self.known @ np.hstack([moved, np.ones((len(moved), 1))]).T  # less the square of the point, equal for all
        own = np.empty_like(gaps)
        for at, k, names in self.groups:
            block = gaps[at:at + k * len(names)].reshape(k, len(names), -1)
            least, label = block[0].copy(), np.zeros(block.shape[1:], dtype=np.int32)
            for c in range(1, k):  # the first of equal distances wins
                np.copyto(label, c, where=block[c] < least)
                np.minimum(least, block[c], out=least)
            mine = own[at:at + k * len(names)].reshape(block.shape)
            mine[...] = label[None] == np.arange(k, dtype=np.int32)[:, None, None]
            for m, cost in zip(names, np.maximum(least + square, 0.0).sum(1).tolist()):
                self.costs[m] += cost
        self.sums += own @ points
        self.counts += own.sum(1).astype(np.int64)

    def partials(self) -> pa.RecordBatch:
        """A row per model and cluster that has rows; a model's cost stands in its first one."""
        rows = []
        for at, k, names in self.groups:
            for j, m in enumerate(names):
                cost = self.costs[m]
                for c in range(k):
                    place = at + c * len(names) + j
                    if self.counts[place]:
                        rows.append((m, c, int(self.counts[place]), cost, place))
                        cost = 0.0
        model, cluster, n, cost, place = zip(*rows)
        totals = self.sums[list(place)]
        return pa.record_batch(
            [
                pa.array(model, pa.int32()),
                pa.array(cluster, pa.int32()),
                pa.array(n, pa.int64()),
                pa.array(cost, pa.float64()),
                pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * totals.shape[1], totals.ravel()),
            ],
            names=["model", "cluster", "n", "cost", "total"],
        )


def lloyd_pass(vectors: DataFrame, models: dict[int, np.ndarray], vec: str = "embedding") -> dict[int, Stats]:
    """One scan that assigns every vector in every model.

    Tasks reduce their rows to one partial sum per (model, cluster); only those are shuffled, and the
    driver receives one row per (model, cluster), whatever the number of tasks.
    """
    schema = "model INT, cluster INT, n BIGINT, cost DOUBLE, total ARRAY<DOUBLE>"
    tables = {m: np.asarray(c, dtype=np.float64) for m, c in models.items()}
    if not tables:
        return {}

    def partial(batches):
        found = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = found or Assigner(tables)
            found.add(to_matrix(batch.column(0)))
        if found is not None:
            yield found.partials()

    total = vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
    rows = vectors.select(vec).mapInArrow(partial, schema).groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), total, F.count(F.lit(1)).alias("parts")
    ).toArrow().combine_chunks()
    out = {m: Stats(np.zeros_like(c), np.zeros(len(c), dtype=np.int64), 0.0, 0) for m, c in tables.items()}
    if rows.num_rows == 0:
        return out
    totals = to_matrix(rows.column("total"))
    for at, (m, c, n, cost, parts) in enumerate(zip(*(rows.column(name).to_pylist() for name in ("model", "cluster", "n", "cost", "parts")))):
        found = out[m]
        found.sums[c] = totals[at]
        found.counts[c] = n
        found.inertia += cost
        found.partials += parts
    return out


def run_lloyd(
    vectors: DataFrame, starts: dict[tuple[int, int], np.ndarray], max_iter: int, tol: float, vec: str = "embedding"
) -> list[Fit]:
    """Iterate all models together until each converges; one scan per round, whatever their number.

    An empty cluster keeps its centre. The last scan scores the final centres.
    """
    keys = list(starts)
    centers = {i: np.array(starts[key], dtype=np.float64) for i, key in enumerate(keys)}
    rounds = dict.fromkeys(centers, 0)
    active = set(centers)
    for _ in range(max_iter):
        if not active:
            break
        stats = lloyd_pass(vectors, {m: centers[m] for m in active}, vec)
        for m, found in stats.items():
            means = found.sums / np.maximum(found.counts, 1)[:, None]
            moved = np.where(found.counts[:, None] > 0, means, centers[m])
            shift = float(((moved - centers[m]) ** 2).sum())
            centers[m] = moved
            rounds[m] += 1
            if shift <= tol:
                active.discard(m)
    final = lloyd_pass(vectors, centers, vec)
    return [
        Fit(len(centers[i]), key[1], centers[i], final[i].counts, final[i].inertia, rounds[i]) for i, key in enumerate(keys)
    ]


def fit_kmeans_scan(
    vectors: DataFrame,
    ks: list[int],
    n_init: int = 10,
    max_iter: int = 300,
    seed: int = 42,
    tol: float = 1e-4,
    id_col: str = "id",
    vec: str = "embedding",
) -> dict[int, Fit]:
    """Best of ``n_init`` restarts for every requested k, all fitted on the same scans.

    The scans read a narrow copy with a file per core: a small table in one row group would be worked on by one task.
    """
    vectors = vectors.select(id_col, vec)
    copy = scratch_path(vectors.sparkSession, "points")
    vectors.repartition(vectors.sparkSession.sparkContext.defaultParallelism, id_col, vec).write.parquet(copy)
    points = vectors.sparkSession.read.parquet(copy)
    try:
        return _fit_kmeans_scan(points, ks, n_init, max_iter, seed, tol, id_col, vec)
    finally:
        remove_table(vectors.sparkSession, copy)


def _fit_kmeans_scan(vectors, ks, n_init, max_iter, seed, tol, id_col, vec):
    variance, candidates = seed_candidates(vectors, max(ks), n_init, seed, id_col, vec)
    starts = {}
    for k in ks:
        for restart in range(n_init):
            points, weights = candidates[restart]
            starts[(k, restart)] = spread_seeds(points, k, np.random.default_rng([seed, k, restart]), weights)
    scaled_tol = tol * variance
    fits = run_lloyd(vectors, starts, max_iter, scaled_tol, vec)
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(starts, fits):
        if k not in best or fit.inertia < best[k].inertia:
            best[k] = fit
    return best


def fit_kmeans(vectors: DataFrame, k: int, **options) -> Fit:
    return fit_kmeans_scan(vectors, [k], **options)[k]


def batch_size(n: int) -> int:
    """Batch size of the fast fit."""
    return min(10_000, max(1_000, n // 20))


def fit_on_sample(vectors: DataFrame, ks: list[int], sample: int, id_col: str = "id", vec: str = "embedding", n_init: int = 3, **options) -> dict[int, Fit]:
    """Fit on a hash sample of ``sample`` rows; callers assign and score all rows afterwards."""
    drawn = hash_sample(vectors.select(id_col, vec), id_col, F.lit(sample)).persist()
    try:
        return fit_kmeans_scan(drawn, ks, n_init=n_init, id_col=id_col, vec=vec, **options)
    finally:
        drawn.unpersist()


def slice_table(vectors: DataFrame, slices: int, id_col: str, vec: str, seed: int) -> tuple[DataFrame, str]:
    """Disjoint hash slices written once as partitions ``slice``, so a round reads its own slice only."""
    place = F.pmod(F.xxhash64(id_col, F.lit(f"slice {seed}")), F.lit(slices)).cast("int")
    path = scratch_path(vectors.sparkSession, "slices")
    vectors.select(id_col, vec, place.alias("slice")).repartition("slice", F.pmod(F.xxhash64(id_col), F.lit(16))).write.partitionBy("slice").parquet(path)
    return vectors.sparkSession.read.parquet(path), path


def _dispensable(centers: np.ndarray, met: np.ndarray, cost: float) -> np.ndarray:
    """Centres whose rows could go to the next centre for less than a centre's mean share of the cost."""
    gaps = pairwise_squared(centers, centers)
    np.fill_diagonal(gaps, np.inf)
    return met * gaps.min(1) <= cost * met.sum() / len(met)


def run_minibatch(
    vectors: DataFrame, starts: dict[tuple[int, int], np.ndarray], slices: int, id_col: str = "id", vec: str = "embedding", seed: int = 42,
    least_share: float = LEAST_SHARE, patience: int = PATIENCE, most_rounds: int = MOST_ROUNDS,
) -> list[Fit]:
    """Mini-batch rounds of all models together over ``slices`` hash slices, each gone through in turn.

    A centre is the mean of the rows it has met. After a round, centres that met less than ``least_share`` of what the
    largest one did move to rows of the slice (those of the smallest hash), and count like the smallest of the others;
    a small one whose few rows lie far from all other centres stays.
    A model rests when its smoothed cost per row has not fallen for ``patience`` rounds; all slices are shown at least once.
    """
    keys = list(starts)
    centers = {m: np.array(starts[key], dtype=np.float64) for m, key in enumerate(keys)}
    met = {m: np.zeros(len(c), dtype=np.int64) for m, c in centers.items()}
    smooth: dict[int, float] = {}
    best, waited = dict.fromkeys(centers, np.inf), dict.fromkeys(centers, 0)
    rounds, active = dict.fromkeys(centers, 0), set(centers)
    table, path = slice_table(vectors, slices, id_col, vec, seed)
    blend = min(1.0, 2.0 / (slices + 1))
    for turn in range(max(most_rounds, slices)):
        if not active:
            break
        part = table.filter(F.col("slice") == turn % slices).select(id_col, vec)
        low: dict[int, np.ndarray] = {}
        for m, found in lloyd_pass(part, {m: centers[m] for m in active}, vec).items():
            n = int(found.counts.sum())
            if n == 0:
                continue
            met[m] += found.counts
            centers[m] += (found.sums - found.counts[:, None] * centers[m]) / np.maximum(met[m], 1)[:, None]
            rounds[m] += 1
            cost = found.inertia / n
            smooth[m] = cost if m not in smooth else smooth[m] * (1 - blend) + cost * blend
            waited[m] = 0 if smooth[m] < best[m] else waited[m] + 1
            best[m] = min(best[m], smooth[m])
            if turn + 1 >= slices and waited[m] >= patience:
                active.discard(m)
            elif turn + 1 < max(most_rounds, slices) and len(met[m]) > 1:
                few = np.flatnonzero((met[m] < least_share * met[m].max()) & _dispensable(centers[m], met[m], smooth[m]))[: n // 2]
                if len(few):
                    low[m] = few
        if low:
            wanted = max(len(few) for few in low.values())  # at most k rows
            rows = part.orderBy(F.xxhash64(id_col, F.lit(f"replace {seed}/{turn}")), id_col).limit(wanted).collect()
            points = np.array([r[vec] for r in rows], dtype=np.float64)
            for m, few in low.items():
                few = few[:len(points)]
                stay = np.delete(met[m], few)
                centers[m][few] = points[:len(few)]
                met[m][few] = stay.min()
    remove_table(vectors.sparkSession, path)
    final = lloyd_pass(vectors, centers, vec)
    return [Fit(len(centers[m]), key[1], centers[m], final[m].counts, final[m].inertia, rounds[m]) for m, key in enumerate(keys)]


def fit_minibatch(vectors: DataFrame, ks: list[int], batch: int, id_col: str = "id", vec: str = "embedding", n_init: int = 3, seed: int = 42) -> dict[int, Fit]:
    """Mini-batch fit that shows every row to the model; seeds and final scores also come from all rows.

    The slices hold about ``batch`` rows, more in a table of over ``MOST_SLICES`` of them.
    """
    slices = min(MOST_SLICES, max(1, -(-vectors.count() // batch)))
    _, candidates = seed_candidates(vectors, max(ks), n_init, seed, id_col, vec)
    starts = {}
    for k in ks:
        for restart in range(n_init):
            points, weights = candidates[restart]
            starts[(k, restart)] = spread_seeds(points, k, np.random.default_rng([seed, k, restart]), weights)
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(starts, run_minibatch(vectors, starts, slices, id_col, vec, seed)):
        if k not in best or fit.inertia < best[k].inertia:
            best[k] = fit
    return best


def assign(vectors: DataFrame, centers: np.ndarray, vec: str = "embedding", out: str = "cluster", ids=None) -> DataFrame:
    return vectors.withColumn(out, vx.nearest_center(F.col(vec), centers, ids))


def centers_frame(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster INT, center ARRAY<DOUBLE>")


def centroids(vectors: DataFrame, cluster: str = "cluster", vec: str = "embedding") -> DataFrame:
    """Element-wise mean per cluster with its size; one vector buffer per cluster and task."""
    v = array_to_vector(vx.as_double(F.col(vec)))
    return vectors.groupBy(F.col(cluster).alias("cluster")).agg(
        vector_to_array(Summarizer.mean(v)).alias("center"), F.count(F.lit(1)).alias("cluster_size")
    )


def with_distance(vectors: DataFrame, centers: DataFrame, cluster: str = "cluster", vec: str = "embedding") -> DataFrame:
    """Distance and squared distance of each vector to its own centre."""
    named = centers.withColumnRenamed("cluster", cluster)
    joined = attach_bounded(vectors, named, [cluster], MAX_CLUSTERS)
    square = vx.squared_distance(F.col(vec), F.col("center"))
    return joined.withColumn("sq_distance", square).withColumn("distance", F.sqrt("sq_distance"))


def inertia(vectors: DataFrame, centers: DataFrame, cluster: str = "cluster", vec: str = "embedding") -> DataFrame:
    return with_distance(vectors, centers, cluster, vec).agg(F.sum("sq_distance").alias("inertia"))


def cluster_stats(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Sizes and their distribution over non-empty clusters, one row."""
    sizes = labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(
        F.sum("size").alias("total_points"),
        F.count(F.lit(1)).alias("n_clusters"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.avg("size").alias("mean_size"),
        F.median("size").alias("median_size"),
        F.stddev_pop("size").alias("std_size"),
    )


def cluster_sizes(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    return labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))


def cluster_results(labelled: DataFrame, id_col: str = "id", cluster: str = "cluster", vec: str = "embedding") -> DataFrame:
    """Id, label, norm and the size of the row's cluster."""
    rows = labelled.select(F.col(id_col).alias("comment_id"), F.col(cluster).alias("cluster_label"), vx.norm(F.col(vec)).alias("embedding_norm"))
    sizes = cluster_sizes(labelled, cluster).withColumnRenamed(cluster, "cluster_label")
    return attach_bounded(rows, sizes, ["cluster_label"], MAX_CLUSTERS)


def extremes(measured: DataFrame, nearest: int, farthest: int, cluster: str = "cluster", pos: str = "pos", keep: list[str] | None = None) -> DataFrame:
    """``cluster, kind, rank, pos, ...``: the closest and the most distant rows of each cluster.

    Both lists come from one scan: a row enters once per kind with a sign on its sort keys. In small
    clusters a row may be in both.
    """
    keep = [c for c in (keep or []) if c != pos]
    kinds = F.array(
        F.struct(F.lit("nearest").alias("kind"), F.lit(1).alias("sign"), F.lit(nearest).alias("wanted")),
        F.struct(F.lit("farthest").alias("kind"), F.lit(-1).alias("sign"), F.lit(farthest).alias("wanted")),
    )
    rows = measured.select(F.col(cluster).alias("cluster"), pos, *keep, "distance", "sq_distance", F.inline(kinds))
    # ordering by the square gives the same ranks and avoids ties made by the root
    ties = [F.when(F.col("sign") > 0, F.col(c)).asc() for c in keep if c == "file"] + [
        F.when(F.col("sign") < 0, F.col(c)).desc() for c in keep if c == "file"]
    order = [F.col("sq_distance") * F.col("sign"), *ties, F.col(pos) * F.col("sign")]
    ranked = top_per_group(rows, ["cluster", "kind"], order, F.col("wanted"), max(nearest, farthest), [pos])
    return ranked.select("cluster", "kind", "rank", pos, *keep, "distance", "sq_distance")


def files_manifest(picked: DataFrame, sizes: DataFrame, base: str, tag: str = "kmeans") -> DataFrame:
    """Per cluster: members, rows saved per kind and the output names.

    ``tag`` is ``kmeans``, ``elbow_kmeans`` or ``fixed_k``; the number of clusters follows it.
    """
    saved = picked.groupBy("cluster").agg(
        F.count_if(F.col("kind") == "nearest").alias("closest_saved"),
        F.count_if(F.col("kind") == "farthest").alias("farthest_saved"),
    )
    k = sizes.agg(F.count(F.lit(1)).alias("k")).scalar()
    rows = sizes.select("cluster", F.col("cluster_size").alias("members"), k.alias("_k")).join(saved, "cluster")

    def name(kind: str, n: str):
        return F.format_string(f"%s_{tag}%d_cluster_%d_{kind}_%d.json", F.lit(base), F.col("_k"), F.col("cluster"), F.col(n))

    return rows.select(
        "cluster", "members", "closest_saved", "farthest_saved",
        name("nearest", "closest_saved").alias("closest_path"),
        name("farthest", "farthest_saved").alias("farthest_path"),
    )


def pca_project(vectors: DataFrame, dims: int, vec: str = "embedding") -> DataFrame:
    """Replace ``vec`` by its centred projection on the first ``dims`` principal axes.

    No-op when ``dims`` is 0 or not below the width. The d x d covariance is the only matrix the
    driver sees.
    """
    first = vectors.select(F.size(vec).alias("w")).first()
    if not dims or first is None or first.w <= dims:
        return vectors
    dense = vectors.withColumn("_v", array_to_vector(vx.as_double(F.col(vec))))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(dense).transform(dense)
    model = PCA(k=dims, inputCol="_c", outputCol="_p").fit(centred)
    return model.transform(centred).withColumn(vec, vector_to_array("_p", "float32")).drop("_v", "_c", "_p")


def l2_normalize(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    sized = vectors.withColumn("_norm", vx.norm(F.col(vec)))
    return sized.withColumn(vec, vx.unit(F.col(vec), F.col("_norm")).cast("array<float>")).drop("_norm")


def fixed_k_guard(vectors: DataFrame, group: list[str], wanted: int, vec: str = "embedding") -> DataFrame:
    """Usable k per group: never more than the number of distinct vectors."""
    unique = F.count_distinct(vx.identity_key(F.col(vec))).alias("unique_count")
    return vectors.groupBy(*group).agg(unique).select(*group, "unique_count", F.least(F.lit(wanted), "unique_count").alias("k"))
