"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. Raking scales the cells' tokens in turn until every marginal has
its target share; that is the joint distribution closest to the present one with the wanted marginals. A cell's
calibrated probability is its wanted tokens over its present ones, scaled to a token budget and at most one: a cell that
is drawn whole leaves the fit and the others are fitted again, so one rare cell does not set the scale. Without a budget
as many tokens stay as leave at most ``SLACK`` of the wanted shift undone. Every document is drawn by its probability;
:func:`calibrate` also reports the residual and the kept share.

Tokens are summed per cell over all documents. Only that table goes to the driver: it has a row per combination of
values that occurs, not per document; more than ``MOST_CELLS`` combinations are refused. A draw depends on a hash of the
document alone, so no shuffle and no order is involved and a rerun draws the same documents.

Edge cases: null source or language is a value of its own (``(none)``); null and empty texts have no tokens and are
drawn with their cell's probability; a value without a target share gets none; targets for absent values are left out
and the rest is scaled up; targets that cannot all hold at once end at the closest fit, whose residual is
reported; repeated rows are drawn alike; an empty table gives no rows; columns named like the outputs are replaced.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_CELLS = 1_000_000
ROUNDS = 200
TOLERANCE = 1e-9
SLACK = 0.01  # of the largest shift of a marginal that may stay undone without a budget
SEARCH = 30
NONE = "(none)"
SHORT_WORDS = 50
LOG = logging.getLogger(__name__)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("bigint")


def content_topic(text: Column, words: Column) -> Column:
    """Rough kind of content: ``table`` (bars between words), ``data`` (many digits), ``note`` (short), ``prose``."""
    body = F.coalesce(text, F.lit(""))
    size = F.length(body)
    bars = size - F.length(F.translate(body, "|", ""))
    digits = size - F.length(F.translate(body, "0123456789", ""))
    return (
        F.when(bars * 40 >= F.greatest(size, F.lit(1)), "table").when(digits * 20 >= F.greatest(size, F.lit(1)), "data")
        .when(words < SHORT_WORDS, "note").otherwise("prose")
    )


def with_cells(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Adds ``n_tokens, topic`` and the cell columns ``_source, _lang``."""
    docs = docs.drop("n_tokens", "topic", "_source", "_lang").withColumn("n_tokens", word_count(F.col(text)))
    return docs.withColumns({
        "topic": content_topic(F.col(text), F.col("n_tokens")),
        "_source": F.coalesce(F.col(source).cast("string"), F.lit(NONE)),
        "_lang": F.coalesce(F.col(lang).cast("string"), F.lit(NONE)),
    })


DIMENSIONS = ("_source", "_lang", "topic")


def tempered(shares: dict[str, float], power: float) -> dict[str, float]:
    """Shares raised to ``power`` and normalised: 1 keeps them, 0 makes them equal."""
    raised = {k: v**power for k, v in shares.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()}


def rake(
    cells: list[tuple], tokens: np.ndarray, targets: list[dict[str, float]], rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, float]:
    """Wanted share of every cell and the largest difference of a marginal from its target.

    ``cells`` are tuples with one value per target dictionary.
    """
    if not len(cells) or tokens.sum() <= 0:
        return np.zeros(len(cells)), 0.0
    share = tokens / tokens.sum()
    plans = []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells})
        place = {v: i for i, v in enumerate(values)}
        index = np.array([place[c[d]] for c in cells])
        present = np.bincount(index, share, len(values)) > 0
        wanted = np.array([max(0.0, target.get(v, 0.0)) for v in values]) * present
        if wanted.sum() <= 0:
            raise ValueError("a target names none of the values that occur")
        plans.append((index, wanted / wanted.sum()))
    worst = 0.0
    for _ in range(rounds):
        for index, wanted in plans:
            now = np.bincount(index, share, len(wanted))
            share = share * np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)[index]
        worst = max(float(np.abs(np.bincount(i, share, len(w)) - w).max()) for i, w in plans)
        if worst < tolerance:
            break
    return (share / share.sum() if share.sum() else share), worst


def bounded(
    cells: list[tuple], tokens: np.ndarray, targets: list[dict[str, float]], share: np.ndarray, budget: float,
    rounds: int = ROUNDS, tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, float]:
    """Probability per cell for ``budget`` expected tokens and the largest difference of a drawn marginal from its target.

    ``share`` is what :func:`rake` wants. A cell that would need more than its tokens is drawn whole and the others are
    fitted again; a marginal that asks for more than its cells hold gives the rest to the other values.
    """
    room = np.where(share > 0, tokens, 0.0)  # what may be drawn at all
    budget = min(float(budget), float(room.sum()))
    if budget <= 0:
        return np.zeros(len(tokens)), 0.0
    plans = []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells})
        place = {v: i for i, v in enumerate(values)}
        index = np.array([place[c[d]] for c in cells])
        held = np.bincount(index, room, len(values))
        aim = np.array([max(0.0, target.get(v, 0.0)) for v in values]) * (np.bincount(index, tokens, len(values)) > 0)
        aim /= aim.sum()
        wanted, full = aim * budget, np.zeros(len(values), dtype=bool)
        while ((wanted > held) & ~full).any():
            full |= wanted >= held
            spare, rest = budget - held[full].sum(), aim[~full].sum()
            wanted = np.where(full, held, aim * (spare / rest if rest > 0 else 0.0))
        plans.append((index, wanted, aim))
    raw = np.divide(share * budget, tokens, out=np.zeros_like(share), where=room > 0)
    for _ in range(rounds):
        for index, wanted, _ in plans:
            whole = np.zeros(len(raw), dtype=bool)
            while True:  # cells that reach one leave the fit of their value
                free = np.bincount(index, np.where(whole, 0.0, room * raw), len(wanted))
                left = np.maximum(wanted - np.bincount(index, np.where(whole, room, 0.0), len(wanted)), 0.0)
                scaled = raw * np.divide(left, free, out=np.ones_like(free), where=free > 0)[index]
                more = ~whole & (scaled >= 1.0)
                if not more.any():
                    break
                whole |= more
            raw = np.where(whole, 1.0, np.minimum(scaled, 1.0))
        drawn = room * raw
        if max(float(np.abs(np.bincount(i, drawn, len(w)) - w).max()) for i, w, _ in plans) < tolerance * budget:
            break
    drawn = room * raw
    return raw, max(float(np.abs(np.bincount(i, drawn, len(a)) / drawn.sum() - a).max()) for i, _, a in plans)


@dataclass(frozen=True)
class Calibration:
    """Share and probability per cell, the largest difference of a marginal and the share of tokens that stays."""

    share: np.ndarray
    prob: np.ndarray
    residual: float
    kept: float


def calibrate(
    cells: list[tuple], tokens: np.ndarray, targets: list[dict[str, float]], budget: float | None = None
) -> Calibration:
    """Fit of the cells to a token budget; without one the most tokens that leave at most ``SLACK`` of the shift undone."""
    share, unbounded = rake(cells, tokens, targets)
    total = float(tokens.sum())
    if not len(cells) or total <= 0 or share.sum() <= 0:
        return Calibration(share, np.zeros(len(cells)), unbounded, 0.0)
    if budget is None:
        _, present = bounded(cells, tokens, targets, share, total)
        most = max(unbounded, SLACK * present) + TOLERANCE
        rate = np.divide(share, tokens, out=np.zeros_like(share), where=tokens > 0)
        low, high = min(1.0 / rate.max(), total), total  # the fit is whole at the lower end
        if present <= most:
            low = total
        for _ in range(SEARCH):
            if high - low <= 1e-4 * total:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if bounded(cells, tokens, targets, share, middle)[1] <= most else (low, middle)
        budget = low
    prob, residual = bounded(cells, tokens, targets, share, budget)
    drawn = prob * tokens
    return Calibration(drawn / drawn.sum() if drawn.sum() else share, prob, residual, float(drawn.sum() / total))


def cell_tokens(rows: DataFrame) -> tuple[list[tuple], np.ndarray]:
    """Combinations of values and their tokens, in order."""
    counted = rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("t")).limit(MOST_CELLS + 1).collect()
    if len(counted) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} combinations of source, language and topic")
    counted.sort(key=lambda r: tuple(r[:3]))
    return [tuple(r[:3]) for r in counted], np.array([float(r.t) for r in counted])


def wanted_shares(
    cells: list[tuple], tokens: np.ndarray, targets: dict[str, dict[str, float]] | None = None, power: float = 0.9
) -> list[dict[str, float]]:
    """Target shares by source, language and topic; a missing one is the present marginal raised to ``power``."""
    wanted = []
    for d, name in enumerate(("source", "lang", "topic")):
        present: dict[str, float] = {}
        for cell, t in zip(cells, tokens):
            present[cell[d]] = present.get(cell[d], 0.0) + t
        wanted.append((targets or {}).get(name) or tempered(present, power))
    return wanted


def mix(
    docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = 0.9, budget: float | None = None,
    seed: int = 17, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """All rows with ``n_tokens, topic, share, prob, drawn``.

    ``targets``: shares by ``source``, ``lang`` and ``topic``; a missing one is the present marginal raised to ``power``.
    """
    rows = with_cells(docs, text, source, lang)
    cells, tokens = cell_tokens(rows)
    wanted = wanted_shares(cells, tokens, targets, power)
    fit = calibrate(cells, tokens, wanted, budget)
    share, prob = fit.share, fit.prob
    LOG.info("mixing: %d cells, %.4f of the tokens stay, largest residual %.2g", len(cells), fit.kept, fit.residual)
    # a cell without a token follows the average, so that empty documents are neither favoured nor lost
    average = float((prob * tokens).sum() / tokens.sum()) if tokens.sum() else 1.0
    prob = np.where(tokens > 0, prob, average)
    table = docs.sparkSession.createDataFrame(
        [(*c, float(s), float(p)) for c, s, p in zip(cells, share, prob)],
        "_source string, _lang string, topic string, share double, prob double")
    drawn = rows.drop("share", "prob", "drawn").join(F.broadcast(table), list(DIMENSIONS))  # at most MOST_CELLS rows
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    order = [c for c in rows.columns if c not in ("_source", "_lang", "share", "prob", "drawn")]
    return drawn.withColumn("drawn", u < F.col("prob")).select(*order, "share", "prob", "drawn")


def sample(docs: DataFrame, **options) -> DataFrame:
    """The drawn documents with the columns they came with."""
    return mix(docs, **options).filter("drawn").select(*docs.columns)
