"""k-means with triangle-inequality bounds that are kept between rounds, and nearest centres among very many.

Every vector carries its label, an upper bound of the distance to its centre and a lower bound of the distance to any
other. When the centres move, the bounds move with them; only where they no longer settle the label are distances
computed. Among many centres those are pruned too: centres lie in groups with a middle and a radius, and a group is
visited only by points that it can still win. Labels equal those of plain Lloyd rounds.

One job per round reads the vectors with their bounds and writes the new ones, together with one partial sum per cluster
and task; the table of the round before is removed then. A lost executor costs at most its part of one round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions.vectors import to_matrix
from corpuslab.operators.cluster import Fit, seed_candidates, spread_seeds
from corpuslab.session import remove_table, scratch_path

DIRECT_CENTERS = 64  # up to this many, all distances of a point are one product
CENTER_BLOCK = 1 << 16  # centres that a task holds at once
POINT_ROWS = 1024
SLACK = 1e-9  # relative; bounds that are closer than this do not settle anything


@dataclass
class Centers:
    """Centres in groups of about their square root: ``order`` lists them group by group."""

    matrix: np.ndarray
    origin: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    middles: np.ndarray = field(init=False)
    radii: np.ndarray = field(init=False)

    def __post_init__(self):
        self.origin = self.matrix.mean(0)  # products of centred numbers cancel less
        shifted = self.matrix - self.origin
        k = len(shifted)
        if k <= DIRECT_CENTERS:
            label = np.zeros(k, np.int64)
        else:
            middles = shifted[np.linspace(0, k - 1, math.isqrt(k)).astype(np.int64)]
            for _ in range(5):
                label = _gaps(shifted, middles).argmin(1)
                for g in np.unique(label):
                    middles[g] = shifted[label == g].mean(0)
            label = _gaps(shifted, middles).argmin(1)
        self.order = np.argsort(label, kind="stable")
        label = label[self.order]
        self.starts = np.append(np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]])), k)
        grouped = shifted[self.order]
        self.middles = np.stack([grouped[a:b].mean(0) for a, b in zip(self.starts[:-1], self.starts[1:])])
        self.radii = np.array([
            np.sqrt(((grouped[a:b] - m) ** 2).sum(1).max()) for a, b, m in zip(self.starts[:-1], self.starts[1:], self.middles)])

    def half_gaps(self) -> np.ndarray:
        """Half the distance of every centre to its nearest other one."""
        if len(self.matrix) == 1:
            return np.full(1, np.inf)
        return np.concatenate([self.nearest(self.matrix[i:i + POINT_ROWS])[2] for i in range(0, len(self.matrix), POINT_ROWS)]) / 2

    def distances(self, points: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - self.matrix[labels]) ** 2).sum(1))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """``label, distance, distance of the next centre, distances computed``; ties go to the lower label."""
        moved = points - self.origin
        n = len(points)
        label = np.full(n, len(self.matrix), np.int64)
        best, second = np.full(n, np.inf), np.full(n, np.inf)
        single = len(self.radii) == 1
        reach = np.zeros((n, 1)) if single else np.sqrt(_gaps(moved, self.middles))
        least = np.zeros((n, 1)) if single else reach - self.radii
        computed = 0 if single else reach.size
        first = reach.argmin(1)
        for turn in range(2):  # the group whose middle is nearest first, so that bounds are tight for the others
            for g in range(len(self.radii)):
                rows = np.flatnonzero(first == g) if turn == 0 else np.flatnonzero((first != g) & (least[:, g] <= second * (1 + SLACK)))
                if not len(rows):
                    continue
                members = self.order[self.starts[g]:self.starts[g + 1]]
                gap = np.sqrt(_gaps(moved[rows], self.matrix[members] - self.origin))
                computed += gap.size
                at = gap.argmin(1)
                near, own = gap[np.arange(len(rows)), at], members[at]
                gap[np.arange(len(rows)), at] = np.inf
                runner = gap.min(1)
                wins = (near < best[rows]) | ((near == best[rows]) & (own < label[rows]))
                loser = np.where(wins, best[rows], near)
                second[rows] = np.minimum(second[rows], np.minimum(loser, runner))
                label[rows] = np.where(wins, own, label[rows])
                best[rows] = np.where(wins, near, best[rows])
        return label, best, second, computed


def _gaps(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (points * points).sum(1)[:, None] - 2.0 * (points @ centers.T) + (centers * centers).sum(1)[None, :]
    return np.maximum(square, 0.0)


@dataclass(frozen=True)
class BoundedFit:
    """A fit with the share of point-centre distances that the bounds saved."""

    fit: Fit
    skipped: float
    labelled: DataFrame


def _round_schema(id_type: str) -> str:
    return (f"id {id_type}, embedding array<double>, label int, upper double, lower double, cluster int, n long, "
            "computed long, total array<double>, sums boolean")


def _update(shared, id_type: pa.DataType):
    """Task of a round: new bounds of its rows, then one row of sums per cluster."""

    def run(batches):
        centers, drift, halves = shared.value
        k, d = centers.matrix.shape
        sums, counts, computed = np.zeros((k, d)), np.zeros(k, np.int64), 0
        far = np.argsort(-drift, kind="stable")[:2] if drift is not None else None
        for batch in batches:
            for begin in range(0, batch.num_rows, POINT_ROWS):
                part = batch.slice(begin, POINT_ROWS)
                points = to_matrix(part.column(1))
                if drift is None:
                    label, upper, lower, done = centers.nearest(points)
                    computed += done
                else:
                    label = part.column(2).to_numpy().astype(np.int64)
                    upper = part.column(3).to_numpy() + drift[label]
                    other = np.where(label == far[0], drift[far[-1]] if k > 1 else 0.0, drift[far[0]])
                    lower = part.column(4).to_numpy() - other
                    limit = np.maximum(lower, halves[label])
                    loose = np.flatnonzero(~(upper < limit * (1 - SLACK)))
                    if len(loose):
                        upper[loose] = centers.distances(points[loose], label[loose])
                        computed += len(loose)
                        loose = loose[~(upper[loose] < limit[loose] * (1 - SLACK))]
                    if len(loose):
                        found = centers.nearest(points[loose])
                        label[loose], upper[loose], lower[loose] = found[:3]
                        computed += found[3]
                counts += np.bincount(label, minlength=k)
                order = np.argsort(label, kind="stable")
                present, first = np.unique(label[order], return_index=True)
                sums[present] += np.add.reduceat(points[order], first, axis=0)
                r = len(label)
                none = pa.nulls(r, pa.int64())
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(label.astype(np.int32)), pa.array(upper), pa.array(lower), pa.nulls(r, pa.int32()),
                     none, none, pa.nulls(r, pa.list_(pa.float64())), pa.array(np.zeros(r, bool))], names=NAMES)
        used = np.flatnonzero(counts)
        for begin in range(0, len(used), POINT_ROWS):
            c = used[begin:begin + POINT_ROWS]
            r, empty = len(c), pa.nulls(len(c), pa.float64())
            spent = np.zeros(r, np.int64)
            spent[0] = computed if begin == 0 else 0
            yield pa.record_batch(
                [pa.nulls(r, id_type), pa.nulls(r, pa.list_(pa.float64())), pa.nulls(r, pa.int32()), empty, empty, pa.array(c.astype(np.int32)),
                 pa.array(counts[c]), pa.array(spent), pa.array(list(sums[c]), pa.list_(pa.float64())), pa.array(np.ones(r, bool))], names=NAMES)

    return run


NAMES = ["id", "embedding", "label", "upper", "lower", "cluster", "n", "computed", "total", "sums"]


def _sums(table: DataFrame, k: int, d: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums and counts per cluster: at most ``k`` rows reach the driver, in blocks of the width."""
    parts = table.filter("sums").select("cluster", "n", "computed", F.posexplode("total").alias("i", "x"))
    merged = parts.groupBy("cluster", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.sum("computed").alias("computed"))
    rows = merged.groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("total"), F.max("n").alias("n"), F.max("computed").alias("computed"))
    sums, counts, computed = np.zeros((k, d)), np.zeros(k, np.int64), 0
    for r in rows.toLocalIterator():
        sums[r.cluster], counts[r.cluster] = r.total, r.n
        computed += r.computed
    return sums, counts, computed


def run_bounded(
    vectors: DataFrame, start: np.ndarray, max_iter: int, tol: float = -1.0, id_col: str = "id", vec: str = "embedding"
) -> BoundedFit:
    """Lloyd rounds from ``start`` until the centres move by ``tol`` (squared, in all) at most.

    ``labelled`` holds ``id, embedding, label, upper`` under the final centres. An empty cluster keeps its centre.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    id_type = dict(vectors.dtypes)[id_col]
    centers = Centers(np.array(start, dtype=np.float64))
    k, d = centers.matrix.shape
    schema = _round_schema(id_type)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("embedding"))
    arrow_id = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()

    def advance(source: DataFrame, model: Centers, drift: np.ndarray | None) -> tuple[DataFrame, str]:
        shared = context.broadcast((model, drift, model.half_gaps() if drift is not None else None))
        path = scratch_path(spark, "bounds")
        source.mapInArrow(_update(shared, arrow_id), schema).write.partitionBy("sums").parquet(path)
        shared.destroy()
        return spark.read.schema(schema).parquet(path), path

    table, path = advance(rows, centers, None)
    sums, counts, computed = _sums(table, k, d)
    done, turn = computed, 0
    while turn < max_iter:
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers.matrix)
        drift = np.sqrt(((moved - centers.matrix) ** 2).sum(1))
        centers = Centers(moved)
        old = path
        table, path = advance(table.filter("NOT sums").select("id", "embedding", "label", "upper", "lower"), centers, drift)
        remove_table(spark, old)
        sums, counts, computed = _sums(table, k, d)
        done += computed
        turn += 1
        if float((drift ** 2).sum()) <= tol:
            break
    labelled = table.filter("NOT sums").select("id", "embedding", "label", "upper")
    exact = context.broadcast(centers)

    def cost(batches):
        total = 0.0
        for batch in batches:
            for begin in range(0, batch.num_rows, POINT_ROWS):
                part = batch.slice(begin, POINT_ROWS)
                total += float((exact.value.distances(to_matrix(part.column(0)), part.column(1).to_numpy()) ** 2).sum())
        yield pa.record_batch([pa.array([total])], names=["cost"])

    inertia = labelled.select("embedding", "label").mapInArrow(cost, "cost double").agg(F.sum("cost")).first()[0] or 0.0
    every = max(1, int(counts.sum()) * k * (turn + 1))
    return BoundedFit(Fit(k, 0, centers.matrix, counts, inertia, turn), 1.0 - done / every, labelled)


def fit_bounded(
    vectors: DataFrame, k: int, max_iter: int = 300, seed: int = 42, tol: float = 1e-4, id_col: str = "id", vec: str = "embedding"
) -> BoundedFit:
    """k-means from one set of scalable k-means++ seeds."""
    variance, candidates = seed_candidates(vectors, k, 1, seed, id_col, vec)
    points, weights = candidates[0]
    return run_bounded(vectors, spread_seeds(points, k, np.random.default_rng([seed, k]), weights), max_iter, tol * variance, id_col, vec)


def assign_to_table(vectors: DataFrame, centers: DataFrame, out: str = "cluster", vec: str = "embedding") -> DataFrame:
    """Nearest row of ``centers`` (``cluster, center``) for every vector, whatever their number; ties to the lower cluster.

    Centres come to the driver and the tasks in blocks of at most ``CENTER_BLOCK``, in order of ``cluster``; each block
    improves the label so far.
    """
    spark = vectors.sparkSession
    label_type = dict(centers.dtypes)["cluster"]
    current, path, last = vectors.withColumns({out: F.lit(None).cast(label_type), "_gap": F.lit(float("inf"))}), None, None
    while True:
        left = centers if last is None else centers.filter(F.col("cluster") > F.lit(last))
        rows = left.orderBy("cluster").limit(CENTER_BLOCK).collect()
        if not rows:
            return current.drop("_gap")
        last = rows[-1].cluster
        names = np.array([r.cluster for r in rows])
        shared = spark.sparkContext.broadcast((Centers(np.array([r.center for r in rows], dtype=np.float64)), names))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in current.schema.fields)
        at, place, gap_at = (current.columns.index(c) for c in (vec, out, "_gap"))

        def improve(batches, shared=shared, at=at, place=place, gap_at=gap_at):
            model, ids = shared.value
            for batch in batches:
                for begin in range(0, batch.num_rows, POINT_ROWS):
                    part = batch.slice(begin, POINT_ROWS)
                    label, gap, _, _ = model.nearest(to_matrix(part.column(at)))
                    before = part.column(gap_at).to_numpy()
                    better = pa.array(gap < before)
                    columns = list(part.columns)
                    columns[place] = pa.compute.if_else(better, pa.array(ids[label]).cast(columns[place].type), columns[place])
                    columns[gap_at] = pa.array(np.minimum(gap, before))
                    yield pa.record_batch(columns, names=part.schema.names)

        improved = current.mapInArrow(improve, fields)
        if len(rows) < CENTER_BLOCK:
            return improved.drop("_gap")
        new = scratch_path(spark, "nearest")
        improved.write.parquet(new)
        shared.destroy()
        if path:
            remove_table(spark, path)
        current, path = spark.read.parquet(new), new
