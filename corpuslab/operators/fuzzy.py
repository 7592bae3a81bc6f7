"""Best match between file names."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions.text import squash_name
from corpuslab.session import cut_lineage

# Least accepted score when looking for comments and for archives.
COMMENTS_THRESHOLD, ARCHIVE_THRESHOLD = 0.5, 0.4
BLOCK_NAMES = 20_000


def _first_by_name(candidates: DataFrame) -> DataFrame:
    """Distinct squashed names, each with its first entry in (directory, name) order."""
    entry = F.struct("dir_rank", "file")
    return candidates.groupBy(squash_name(F.col("stem")).alias("norm")).agg(F.min(entry).alias("entry"))


def containing_name(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """``target, dir_rank, file``: the first candidate whose squashed name contains the target's.

    Candidates are expanded to their substrings of the lengths that occur among targets and each
    substring keeps its first candidate before the shuffle; the containment test is then an equality
    join with one row per match. No pair of names is formed.
    """
    wanted = targets.select("target", squash_name(F.col("target")).alias("norm")).distinct()
    lengths = [r[0] for r in wanted.select(F.length("norm").alias("n")).filter("n > 0").distinct().collect()]
    if not lengths:
        return targets.sparkSession.createDataFrame([], "target STRING, dir_rank INT, file STRING")
    sizes = F.array(*[F.lit(n) for n in sorted(lengths)])
    fitting = F.filter(sizes, lambda n: n <= F.length("norm"))
    pieces = F.flatten(
        F.transform(
            fitting,
            lambda n: F.transform(
                F.sequence(F.lit(1), F.length("norm") - n + 1), lambda at: F.substring(F.col("norm"), at, n)
            ),
        )
    )
    parts = _first_by_name(candidates).select(F.explode(F.array_distinct(pieces)).alias("norm"), "entry")
    firsts = parts.groupBy("norm").agg(F.min("entry").alias("entry"))
    return wanted.join(firsts, "norm").select("target", "entry.dir_rank", "entry.file")


def _letter_counts(names: list[str]) -> np.ndarray:
    table = np.zeros((len(names), 36), dtype=np.int16)
    for row, name in enumerate(names):
        for ch in name:
            table[row, int(ch, 36)] += 1
    return table


def _scorer(names: list[str], threshold: float):
    """Best candidate index and ratio per target among ``names``, in their order.

    Shared letters bound the ratio from above, so candidates are tried in order of that bound until
    it falls below the best ratio found; the result equals trying all of them.
    """
    letters = _letter_counts(names)
    lengths = np.array([len(n) for n in names])

    def best(target: str, matchers: dict) -> tuple[int, float] | None:
        shared = np.minimum(letters, _letter_counts([target])).sum(1)
        size = lengths + len(target)
        bound = np.where(size > 0, 2.0 * shared / np.maximum(size, 1), 1.0)
        top, top_at = threshold, -1
        for at in np.lexsort((np.arange(len(bound)), -bound)):
            if bound[at] < top:
                break
            if at not in matchers:
                matchers[at] = difflib.SequenceMatcher(None, "", names[at])
            matchers[at].set_seq1(target)
            ratio = matchers[at].ratio()
            if ratio > top or (ratio == top and (top_at < 0 or at < top_at)):
                top, top_at = ratio, int(at)
        return None if top_at < 0 else (top_at, top)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers: dict[int, difflib.SequenceMatcher] = {}
        for batch in batches:
            found = [(t, *hit) for t, n in zip(batch["target"], batch["norm"]) if (hit := best(n, matchers))]
            yield pd.DataFrame(found, columns=["target", "idx", "score"])

    return score


def _closest(rest: DataFrame, block: list[tuple[str, int, str]], threshold: float) -> DataFrame:
    """``target, score, dir_rank, file`` of the best candidate within one block."""
    names = [b[0] for b in block]
    # a map step rather than a column function: filters must not move it below the reduction to distinct names
    scored = rest.select("target", "norm").mapInPandas(_scorer(names, threshold), "target STRING, idx INT, score DOUBLE")
    entries = rest.sparkSession.createDataFrame(
        [(i, b[1], b[2]) for i, b in enumerate(block)], "idx INT, dir_rank INT, file STRING"
    )
    return scored.join(F.broadcast(entries), "idx").select(  # at most one block of names
        "target", "score", "dir_rank", "file"
    )


def best_match(
    targets: DataFrame, candidates: DataFrame, threshold: float = COMMENTS_THRESHOLD, block_names: int = BLOCK_NAMES
) -> DataFrame:
    """``target, file, score``: containment scores 1, else the sequence ratio; first candidate on ties.

    ``targets`` has ``target``; ``candidates`` has ``dir_rank, file, stem``. Names not settled by
    containment are scored against candidate names that travel with the function. Up to
    ``block_names`` names are one block; more are taken block by block with the best kept between
    blocks, so memory stays bounded and the result exact.
    """
    contained = containing_name(targets, candidates).withColumn("score", F.lit(1.0))
    everyone = targets.select("target").distinct()
    rest = everyone.join(contained.select("target"), "target", "left_anti").select(
        "target", squash_name(F.col("target")).alias("norm")
    )
    names = _first_by_name(candidates)
    total = names.count()
    blocks = max(1, -(-total // block_names))
    # scoring is bound by the processor and a few names would otherwise share one task
    rest = rest.repartition(targets.sparkSession.sparkContext.defaultParallelism, "target")
    if blocks > 1:
        rest = cut_lineage(rest)
    best: DataFrame | None = None
    for b in range(blocks):
        part = names if blocks == 1 else names.filter(F.pmod(F.xxhash64("norm"), F.lit(blocks)) == b)
        rows = part.select("norm", "entry.dir_rank", "entry.file").orderBy("dir_rank", "file").collect()
        if not rows:
            continue
        found = _closest(rest, [tuple(r) for r in rows], threshold)
        best = found if best is None else cut_lineage(_better(best.unionByName(found)))
    matched = contained.select("target", "score", "dir_rank", "file")
    if best is not None:
        matched = matched.unionByName(best)
    return matched.select("target", "file", "score")


def _better(matches: DataFrame) -> DataFrame:
    scored = matches.withColumn("_order", F.struct((-F.col("score")).alias("s"), "dir_rank", "file"))
    first = F.min_by(F.struct("score", "dir_rank", "file"), "_order").alias("m")
    return scored.groupBy("target").agg(first).select("target", "m.*")
