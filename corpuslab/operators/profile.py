"""Data-quality profile of a vector table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import vectors as vx
from corpuslab.operators.ordering import exact_percentiles, hash_sample

BINS = 50


def norms(vectors: DataFrame, id_col: str = "id", vec: str = "embedding") -> DataFrame:
    return vectors.select(id_col, vx.norm(F.col(vec)).alias("norm"))


def row_stats(vectors: DataFrame, id_col: str = "id", vec: str = "embedding") -> DataFrame:
    """One narrow row per vector: everything the checks need, so the wide column is read once."""
    v = F.col(vec)
    width = F.size(v)
    mean = vx.total(v) / width
    return vectors.select(
        F.col(id_col).alias("id"),
        width.cast("bigint").alias("width"),
        vx.count_nan(v).alias("nans"),
        vx.count_infinite(v).alias("infs"),
        F.array_min(vx.as_double(v)).alias("low"),
        F.array_max(vx.as_double(v)).alias("high"),
        mean.alias("mean"),
        vx.sum_squares(v).alias("squares"),
        vx.identity_key(v).alias("key"),
    )


def _finite(value: Column) -> Column:
    """NaN if any element was NaN, as an array library reports it."""
    return F.when(F.col("nan_count") > 0, F.lit(float("nan"))).otherwise(value)


def sanity_checks(
    vectors: DataFrame, id_col: str = "id", vec: str = "embedding", expected_dim: int = 384, bytes_per_value: int = 4
) -> DataFrame:
    """One row of counts, value statistics, norm range, duplicates, id checks and sizes.

    The population variance over all elements is the mean of the row variances plus the variance of
    the row means (rows of one width), which does not cancel the way a raw sum of squares does.
    """
    rows = row_stats(vectors, id_col, vec)
    row_var = F.col("squares") / F.col("width") - F.col("mean") * F.col("mean")
    distinct = lambda c: F.first(rows.select(c).distinct().agg(F.count(c)).scalar())
    out = rows.agg(
        F.count(F.lit(1)).alias("total_embeddings"),
        F.count("id").alias("total_ids"),
        F.coalesce(F.sum("nans"), F.lit(0)).alias("nan_count"),
        F.coalesce(F.sum("infs"), F.lit(0)).alias("inf_count"),
        F.min("width").alias("min_dim"),
        F.max("width").alias("max_dim"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        (F.sum(F.col("mean") * F.col("width")) / F.sum("width")).alias("mean_value"),
        F.sqrt(F.avg(row_var) + F.var_pop("mean")).alias("std_value"),
        F.min(F.sqrt("squares")).alias("min_norm"),
        F.max(F.sqrt("squares")).alias("max_norm"),
        F.avg(F.sqrt("squares")).alias("mean_norm"),
        # two distinct counts in one aggregate would expand every row; these are two narrow ones
        distinct("key").alias("unique_embeddings"),
        distinct("id").alias("unique_ids"),
        (F.sum("width") * F.lit(bytes_per_value) / F.lit(rules.MEGABYTE)).alias("memory_mb"),
    )
    numeric = ["min_value", "max_value", "mean_value", "std_value", "min_norm", "max_norm", "mean_norm"]
    return out.select(
        "total_embeddings",
        "nan_count",
        "inf_count",
        ((F.col("nan_count") > 0) | (F.col("inf_count") > 0)).alias("has_missing"),
        ((F.col("min_dim") == expected_dim) & (F.col("max_dim") == expected_dim)).alias("expected_dim"),
        (F.col("total_embeddings") == F.col("total_ids")).alias("length_match"),
        *[_finite(F.col(c)).alias(c) for c in numeric],
        "unique_embeddings",
        (F.col("total_embeddings") - F.col("unique_embeddings")).alias("duplicate_count"),
        (F.col("unique_embeddings") < F.col("total_embeddings")).alias("has_duplicates"),
        "unique_ids",
        (F.col("total_ids") - F.col("unique_ids")).alias("duplicate_ids"),
        (F.col("unique_ids") < F.col("total_ids")).alias("has_duplicate_ids"),
        "memory_mb",
    )


def recommendations(checks: DataFrame) -> DataFrame:
    """``position, message`` rows derived from :func:`sanity_checks`."""
    lines = rules.advice(
        F.col("nan_count") + F.col("inf_count"),
        F.col("mean_norm"),
        F.col("duplicate_count"),
        F.col("total_embeddings"),
        F.col("memory_mb"),
    )
    return checks.select(F.posexplode(lines).alias("position", "message"))


def dimension_stats(vectors: DataFrame, vec: str = "embedding", first: int = 50) -> DataFrame:
    """Mean and population deviation per dimension: one aggregation buffer per task, no exploded rows."""
    head = vectors.select(array_to_vector(vx.as_double(F.slice(vec, 1, first))).alias("v"))
    stats = head.select(Summarizer.metrics("mean", "std", "count").summary(F.col("v")).alias("s"))
    shrink = F.sqrt((F.col("s.count") - 1) / F.col("s.count"))
    arrays = stats.select(
        F.arrays_zip(vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("std")).alias("z"),
        shrink.alias("shrink"),
    )
    return arrays.select(F.posexplode("z").alias("dim", "z"), "shrink").select(
        "dim", F.col("z.mean").alias("mean"), (F.col("z.std") * F.col("shrink")).alias("std")
    )


def dimension_corr(vectors: DataFrame, vec: str = "embedding", first: int = 10) -> DataFrame:
    """Pearson matrix of the first dimensions as ``i, j, r``."""
    head = vectors.select(array_to_vector(vx.as_double(F.slice(vec, 1, first))).alias("v"))
    matrix = Correlation.corr(head, "v").first()[0].toArray()
    cells = [(i, j, float(r)) for i, line in enumerate(matrix) for j, r in enumerate(line)]
    return vectors.sparkSession.createDataFrame(cells, "i INT, j INT, r DOUBLE")


def covariance(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Sample covariance of all dimensions as ``i, j, cov``.

    Rows are centred on the mean of the first scan; the second sums one d x d matrix per task.
    """
    mean = vector_to_array(Summarizer.mean(array_to_vector(vx.as_double(F.col(vec))))).alias("mean")
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), mean).first()
    if facts.n < 2:
        return vectors.sparkSession.createDataFrame([], "i INT, j INT, cov DOUBLE")
    center = np.array(facts["mean"])

    def products(batches):
        total = np.zeros((len(center), len(center)))
        for batch in batches:
            if batch.num_rows:
                points = vx.to_matrix(batch.column(0)) - center
                total += points.T @ points
        i, j = np.indices(total.shape)
        yield pa.record_batch(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = vectors.select(vec).mapInArrow(products, "i INT, j INT, s DOUBLE").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return sums.select("i", "j", (F.col("s") / F.lit(facts.n - 1)).alias("cov"))


def histogram(df: DataFrame, value: Column, bins: int = BINS) -> DataFrame:
    """``bin, lo, n`` over equal bins of [min, max]; the last bin is closed, a single value widens by 0.5."""
    data = df.select(value.cast("double").alias("x"))
    low, high = data.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin BIGINT, lo DOUBLE, n BIGINT")
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    slot = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(step)), F.lit(bins - 1)).cast("bigint")
    counts = data.filter("x IS NOT NULL").groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return spine.join(F.broadcast(counts), "bin", "left").select(  # at most `bins` rows
        "bin", (F.lit(low) + F.col("bin") * F.lit(step)).alias("lo"), F.coalesce("n", F.lit(0)).alias("n")
    )


def sample_frame(
    vectors: DataFrame, n: int = 1000, id_col: str = "id", vec: str = "embedding", dims: int = 5, seed: str = "42"
) -> DataFrame:
    """Uniform sample without replacement with the norm and the first dimensions."""
    drawn = hash_sample(vectors.select(id_col, vec), id_col, F.lit(n), seed=seed)
    heads = [F.get(vec, F.lit(i)).cast("double").alias(f"emb_dim_{i}") for i in range(dims)]
    return drawn.select(F.col(id_col).alias("comment_id"), vx.norm(F.col(vec)).alias("embedding_norm"), *heads)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (linear) and maximum per column, exact at any size."""
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(c).alias(f"{kind}_{i}") for i, c in enumerate(columns) for kind, f in kinds.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{kind}_{i}").alias(kind) for kind in kinds]) for i, c in enumerate(columns)
    ]
    base = wide.select(F.inline(F.array(*rows)))
    named = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = exact_percentiles(df, columns, list(named)).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in named.items()]
    )
    return base.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def processing_summary(
    comments: DataFrame, vectors: DataFrame, file: str = "file", vec: str = "embedding"
) -> DataFrame:
    """Per file: comments read, vectors written and their width; each side is reduced before the join."""
    read = comments.groupBy(file).agg(F.count(F.lit(1)).alias("comments"))
    written = vectors.groupBy(file).agg(F.count(F.lit(1)).alias("vectors"), F.max(F.size(vec)).alias("dim"))
    return read.join(written, file, "left").select(file, "comments", F.coalesce("vectors", F.lit(0)).alias("vectors"), "dim")


def analysis_report(vectors: DataFrame, source: str, id_col: str = "id", vec: str = "embedding", **checks) -> DataFrame:
    """One nested row ready for a JSON sink."""
    facts = sanity_checks(vectors, id_col, vec, **checks)
    lines = rules.advice(
        F.col("nan_count") + F.col("inf_count"), F.col("mean_norm"), F.col("duplicate_count"),
        F.col("total_embeddings"), F.col("memory_mb"),
    )
    return facts.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("analysis_timestamp"),
        F.struct(F.lit(source).alias("source"), "total_embeddings", "memory_mb").alias("dataset_info"),
        F.struct(*facts.columns).alias("sanity_checks"),
        lines.alias("recommendations"),
    )
